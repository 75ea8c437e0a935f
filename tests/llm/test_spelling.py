import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from upswell.llm import queries, spelling


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :]
    longer, shorter = (a, b) if len(a) > len(b) else (b, a)
    return longer[i + 1 :] == shorter[i:]


def wanted(counts):
    out = {}
    for w, n in counts.items():
        near = [v for v in counts if one_edit(w, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        form = best if best and counts[best] >= 10 * n else None
        out[w] = [form, n, len(near), counts[form] if form else None]
    for w, row in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        row.insert(1, root)
    return {w: tuple(row) for w, row in out.items()}


def made(docs):
    """Words of the query, worked out one by one."""
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def rows_of(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_against_brute_force(spark, rng):
    counts = {}
    for _ in range(40):
        word = "".join(rng.choice("abcdeéß") for _ in range(rng.randrange(1, 12)))
        counts[word] = 10 ** rng.randrange(1, 6)
        for _ in range(8):
            i = rng.randrange(len(word))
            other = rng.choice([word[:i] + word[i + 1 :], word[:i] + rng.choice("abxÿ") + word[i:], word[:i] + rng.choice("abxÿ") + word[i + 1 :]])
            counts.setdefault(other, rng.randrange(2, 3000))
    counts |= {"": 5, "日本語": 4, "日本": 40, "x" * 3000: 7, "x" * 2999 + "y": 70}
    df = spark.createDataFrame([(w, n, "x") for w, n in counts.items()], "word string, n long, key string")
    assert rows_of(spelling.variants(df)) == wanted(counts)


def test_neighbours_are_all_that_are_one_edit_away(monkeypatch):
    import itertools

    import numpy as np

    monkeypatch.setattr(spelling, "PLACES", 50)
    every = [s for k in range(5) for s in itertools.product((1, 2, 3, 8), repeat=k)]
    flat = np.array([c for s in every for c in s], np.uint64)
    lengths = np.array([len(s) for s in every])
    reduced = spelling.Reduced(flat, lengths)
    keys = dict(zip(reduced.keys().tolist(), every))
    assert len(keys) == len(every)
    met = {(every[r], keys[k]) for rows, found in reduced.neighbours() for r, k in zip(rows.tolist(), found.tolist()) if k in keys}
    assert met == {(a, b) for a in every for b in every if a == b or one_edit(a, b)}


def test_a_hot_word_and_its_many_variants(spark):
    word = "consultation"
    counts = {word: 10**6} | {word[:i] + c + word[i + 1 :]: 3 for i in range(len(word)) for c in "abcdefgh" if c != word[i]}
    got = rows_of(spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert got == wanted(counts)


def test_query_on_texts(spark, tmp_path, prose, rng):
    words = ["Importante", "importante", "Überraschung", "documents", "document", "short", "conversation"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(200))) for i in range(150)]
    docs += [(None, "Importante importante"), (900, None), (901, ""), (902, "1234 -- \n"), (7, docs[7][1]), (903, "documents " * 5000)]
    rows = [(d, t, "x", "y") for d, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, word string, n string").write.parquet(f"{tmp_path}/documents.parquet")
    df = queries.op11_spelling_variants(spark, str(tmp_path))
    assert df.dtypes == [("word", "string"), ("form", "string"), ("root", "string"), ("n", "bigint"), ("n_near", "bigint"), ("form_n", "bigint")]
    assert rows_of(df) == wanted(made(docs))
    assert any(r[0] for r in rows_of(df).values())


def test_no_rows(spark, frame):
    assert spelling.variants(spelling.word_counts(frame([]))).collect() == []
    assert spelling.word_counts(frame([(1, None), (2, "")])).collect() == []


def test_words_without_a_deleted_letter(frame):
    got = spelling.word_counts(frame([(1, "Letters, LETTERS letterſ lettersé"), (2, "letters")])).collect()
    assert [(r.word, r.n) for r in got] == [("letters", 3)]
    assert spelling.word_counts(frame([(1, "abcdefgh " * 2)]), F.lit(0).cast("int")).collect()[0].word == "bcdefgh"
