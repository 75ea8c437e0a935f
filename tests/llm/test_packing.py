import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from upswell.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def plain_ids(text):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def places(rows):
    """Rows by sequence, in order; every sequence must be gapless from 0."""
    found = {}
    for r in sorted(rows, key=lambda r: r.offset):
        found.setdefault(r.sequence_id, []).append(r)
    for parts in found.values():
        at = 0
        for r in parts:
            assert r.offset == at
            at += r.length
    return found


def test_pieces_and_sequences_against_the_library(frame, prose, rng):
    texts = [prose(rng.choice([1, 3, 20, 60, 300])) for _ in range(60)] + [prose(9000), prose(2500), "", None, "  \n", "naïve – 東京"]
    docs = [(i * 5, t) for i, t in enumerate(texts)] + [(None, "no id"), (5, texts[1]), (5, texts[1])]
    got = packing.packed(packing.pieces(frame(docs), PATH)).collect()
    by_doc = {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
    for i, text in enumerate(texts):
        ids = plain_ids(text)
        parts = sorted(by_doc[i * 5], key=lambda r: r.piece)
        if i == 1:
            assert len(parts) == 3 * len({r.piece for r in parts})
            continue
        assert [x for r in parts for x in r.ids] == ids
        assert [r.piece for r in parts] == list(range(len(parts)))
        assert [r.start for r in parts] == list(np.cumsum([0, *(r.length for r in parts)])[:-1])
        assert all(r.length == 2048 for r in parts[1:]) and (len(ids) > 2048 or len(parts) == 1)
        assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in parts)
    assert len(by_doc[None]) == 1
    found = places(got)
    assert all(sum(r.length for r in parts) <= 2048 for parts in found.values())
    whole = packing.sequences(packing.packed(packing.pieces(frame(docs), PATH))).collect()
    assert sum(len(r.ids) for r in whole) == sum(r.length for r in got) and max(len(r.ids) for r in whole) <= 2048


def test_a_piece_ends_where_a_sequence_does(frame):
    words = " a" * 2047  # one token each, and the end id
    got = packing.pieces(frame([(1, words), (2, words + " a"), (3, words * 2 + " a" * 2)]), PATH, with_ids=False).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length) for r in got) == [(1, 0, 0, 2048), (2, 0, 0, 1), (2, 1, 1, 2048), (3, 0, 0, 1), (3, 1, 1, 2048), (3, 2, 2049, 2048)]


@pytest.mark.parametrize("kind", ["mixed", "small", "large", "half"])
def test_number_of_sequences(spark, rng, kind, monkeypatch):
    """Close to what best fit reaches at once, over several small tasks and rounds."""
    monkeypatch.setattr(packing, "BLOCK", 256)
    monkeypatch.setattr(packing, "FAN_IN", 2)
    sizes = {"mixed": (1, 2048), "small": (1, 90), "large": (1100, 2048), "half": (1024, 1025)}[kind]
    lengths = [rng.randrange(*sizes) for _ in range(3000)]
    items = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "id long, length long")
    got = packing.packed(items).collect()
    assert sorted((r.id, r.length) for r in got) == list(enumerate(lengths))
    found = places(got)
    assert all(sum(r.length for r in parts) <= 2048 for parts in found.values())
    at_once = packing.best_fit(np.array(lengths), 2048)[2]
    assert len(found) <= len(at_once) * 1.03
    if kind == "large":
        assert len(found) == 3000
    if kind == "half":
        assert len(found) == 1500


def test_underfull_sequences_of_many_tasks_meet(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 4)
    monkeypatch.setattr(packing, "FAN_IN", 2)
    items = spark.createDataFrame([(i, 300) for i in range(32)], "id long, length long")  # 8 tasks, 4 each, 6 fit
    assert len(places(packing.packed(items).collect())) <= 7


def test_no_rows_and_bad_lengths(spark, frame):
    assert packing.packed(packing.pieces(frame([]), PATH)).collect() == []
    for bad in (0, 2049, None):
        with pytest.raises(Exception, match="between 1 and 2048|NaN|null"):
            packing.packed(spark.createDataFrame([(bad,)], "length long")).collect()


def test_query(spark, tmp_path):
    from upswell.llm import queries

    spark.createDataFrame([(1, "one two"), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    df = queries.op13_best_fit_packing(spark, str(tmp_path))
    assert df.dtypes == [("doc_id", "bigint"), ("piece", "int"), ("start", "bigint"), ("length", "bigint"), ("ids_crc32", "bigint"), ("sequence_id", "bigint"), ("offset", "bigint")]
    assert df.select(F.countDistinct("sequence_id"), F.sum("length")).first() == (1, len(plain_ids("one two")) + 1)
