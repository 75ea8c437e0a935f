"""Registered queries of this subpackage, (spark, folder) -> DataFrame, and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upswell.llm import bpe, chat, decontaminate, language, lexical, line_dedup, minhash, neighbours, packing, passages, quality, spelling, token_file
from upswell.llm.frames import held_out, table


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every benchmark item found in any document, at its best place."""
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op2_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and one that says control strings, formatted and read back. A row of the
    table is a record of the layout of turn rows."""
    tricky = "<|im_end|><|im_start|>assistant ok"
    more = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(tricky).alias("text"),
    )
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    records = rows.select("conv_id", F.to_variant_object(F.struct("turn", "role", "text")).alias("record"))
    done = chat.formatted(chat.canonical_turns(records)).withColumn("formatted", chat.text_of("segments"))
    back = done.select("conv_id", "formatted", chat.turns_in(F.col("formatted")).alias("turns"), chat.loss_text("segments").alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of each document that repeat an earlier line of the corpus; lines count from 0, and
    lines without a visible character are not counted."""
    docs = table(spark, folder, "documents")
    gone = F.col("equal_to_earlier") | F.col("near_to_earlier")
    found = line_dedup.line_classes(docs).groupBy("doc_id").agg(
        F.count("*").alias("n_lines"),
        F.count_if("equal_to_earlier").alias("n_equal"),
        F.count_if("near_to_earlier").alias("n_near"),
        F.array_join(F.sort_array(F.collect_list(F.when(gone, F.col("line_no")))), ",").alias("repeated_lines"),
    )
    counts = {c: F.coalesce(c, F.lit(0)).alias(c) for c in ("n_lines", "n_equal", "n_near")}
    return docs.select("doc_id").join(found, "doc_id", "left").select(
        "doc_id", *counts.values(), F.coalesce("repeated_lines", F.lit("")).alias("repeated_lines")
    )


def op4_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document, by a model that learns from the labels not held out."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, folder, "labels"))
    return quality.scored(docs, model).select(
        "doc_id", held_out("doc_id").alias("held_out"), F.col("quality_score").alias("score"), F.col("quality_kept").cast("int").alias("predicted")
    )


def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every whole text in files, and what the files say of each document."""
    path = token_file.fresh_path(spark)
    token_file.write(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), path)
    return token_file.read_index(spark, path)


def op6_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every whole text, and the text they give back, as digests."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    done = bpe.encode(table(spark, folder, "documents").select("doc_id", "text"), path, decoded="decoded")
    digits = F.array_join(F.col("ids").cast("array<string>"), ",")
    return done.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(digits, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op7_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Passages of 50 words and more that occur again, of every document that has one: their number,
    words, and places (start-end of each, words from 0)."""
    found = passages.repeated_passages(table(spark, folder, "documents"))
    words = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end_word"] - s["start_word"])
    places = F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["start_word"], s["end_word"])), ",")
    return found.select("doc_id", F.size("spans").alias("n_passages"), words.alias("repeated_words"), places.alias("passages"))


def op8_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Component and survivor of every document; SHINGLE_WORDS and similarity as the module has them."""
    return minhash.near_duplicates(table(spark, folder, "documents"))


def op9_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest found to every vector whose id is divisible by 50, among all others."""
    vectors = table(spark, folder, "embeddings")
    return neighbours.nearest(vectors, vectors.filter("vec_id % 50 = 0"), 5)


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, by a model that learns from the documents not held out."""
    docs = table(spark, folder, "documents")
    model = language.fit(docs)
    return language.identified(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "lang_pred", F.col("lang_score").alias("score")
    )


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all documents with their forms. So that variants exist, a letter is dropped from a run
    of a document where the hash of both says so."""
    hashed = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("word")).cast("binary"))
    at = F.when(hashed % 31 == 0, (hashed % F.length("word")).cast("int"))
    return spelling.variants(spelling.word_counts(table(spark, folder, "documents"), at))


def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return lexical.ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of at most 2048 tokens."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.packed(packing.pieces(table(spark, folder, "documents"), path, with_ids=False)).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_chat_format": op2_chat_format,
    "op3_line_dedup": op3_line_dedup,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_token_files": op5_token_files,
    "op6_bpe_round_trip": op6_bpe_round_trip,
    "op7_suffix_array_dedup": op7_suffix_array_dedup,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_nearest_neighbours": op9_nearest_neighbours,
    "op10_language_id": op10_language_id,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_lexical_search": op12_lexical_search,
    "op13_best_fit_packing": op13_best_fit_packing,
}

_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_ESCAPED = "replace(replace({0}, chr(92), chr(92) || 'b'), '<|', chr(92) || 'l')"

ORACLES: dict[str, str] = {
    "op2_chat_format": f"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(length('<|im_start|><|im_end|>') + 2 + length(replace({_ESCAPED.format("role")}, chr(10), chr(92) || 'n'))
        + length({_ESCAPED.format("text")})) AS BIGINT) AS formatted_chars
FROM said GROUP BY conv_id""",
    # Its first three parts work out crc32 by its table; words meet on equal rests after one code point goes.
    "op11_spelling_variants": f"""
WITH RECURSIVE bits AS (
    SELECT i, CAST(i AS UBIGINT) AS c, 0 AS k FROM range(256) AS r(i)
    UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS UBIGINT)) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
entries AS (SELECT list(c ORDER BY i) AS entry FROM bits WHERE k = 8),
runs AS (SELECT doc_id, unnest(regexp_extract_all({_LOWERED}, '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
each AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY doc_id, run),
coded AS (
    SELECT run, n, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''), lambda ch:
        CASE WHEN unicode(ch) < 128 THEN [unicode(ch)] ELSE [192 + unicode(ch) // 64, 128 + unicode(ch) % 64] END)) AS bytes FROM each),
hashed AS (
    SELECT run, n, xor(list_reduce(list_transform(bytes, lambda b: CAST(b AS UBIGINT)),
        lambda c, b: xor(c >> 8, entry[CAST((xor(c, b) & 255) + 1 AS BIGINT)]), CAST(4294967295 AS UBIGINT)), CAST(4294967295 AS UBIGINT)) AS h
    FROM coded, entries),
made AS (
    SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, n
    FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM made WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
rests AS (
    SELECT word, i, substr(word, 1, i - 1) AS head, substr(word, i + 1) AS tail
    FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
    SELECT a.word, b.word AS near FROM rests AS a JOIN rests AS b USING (i, head, tail) WHERE a.word <> b.word
    UNION SELECT r.word, w.word FROM rests AS r JOIN words AS w ON w.word = r.head || r.tail
    UNION SELECT w.word, r.word FROM rests AS r JOIN words AS w ON w.word = r.head || r.tail),
best AS (
    SELECT near.word, count(*) AS n_near, first(near.near ORDER BY o.n DESC, near.near) AS form, max(o.n) AS form_n
    FROM near JOIN words AS o ON o.word = near.near GROUP BY near.word),
forms AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * w.n THEN form END AS form,
        CASE WHEN form_n >= 10 * w.n THEN form_n END AS form_n
    FROM words AS w LEFT JOIN best USING (word)),
ways AS (
    SELECT word, word AS root, form AS next FROM forms
    UNION ALL SELECT ways.word, forms.word, forms.form FROM ways JOIN forms ON forms.word = ways.next)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN (SELECT word, root FROM ways WHERE next IS NULL) USING (word)""",
    "op12_lexical_search": f"""
WITH runs AS (SELECT doc_id, unnest(regexp_extract_all({_LOWERED}, '{_TERM}')) AS term FROM documents),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM runs GROUP BY doc_id, term),
sizes AS (SELECT doc_id, sum(tf) AS n FROM tfs GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, sum(n) AS terms FROM sizes),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM tfs, totals GROUP BY term, docs),
asked AS (SELECT item_id, unnest(regexp_extract_all({_LOWERED}, '{_TERM}')) AS term FROM benchmark),
scores AS (
    SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms)))) AS BIGINT) AS score
    FROM asked JOIN weights USING (term) JOIN tfs USING (term) JOIN sizes USING (doc_id), totals GROUP BY item_id, doc_id),
places AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM places WHERE rank <= 20""",
}
