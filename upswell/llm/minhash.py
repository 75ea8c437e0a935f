"""Near-duplicate documents by MinHash, banding, signature and full-set verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upswell.llm import arrays
from upswell.llm.buckets import bucket_links, pairs_in_buckets
from upswell.llm.frames import components, in_batches, staged

SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 75
BANDS, ROWS = 32, 4
#: Of the 128 one-bit minima, two documents at the limit differ in 16 on average, with a standard
#: deviation of 3.7; six deviations more are let through to the full sets.
MOST_DIFFERENT_BITS = 38
HUBS = 3
#: Documents not yet connected by hubs are compared by so many more minima, a byte of each. At the
#: limit 0.751 of them agree on average, with a standard deviation of 0.0135; 4.5 less are let through.
SKETCH = 1024
LEAST_EQUAL = 707

_A = arrays.seeds(BANDS * ROWS, 200_000) | np.uint64(1)
_B = arrays.seeds(BANDS * ROWS, 300_000)


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """For every row its distinct shingle hashes, sorted. Fewer words than a shingle: the whole
    sequence as one. No word: an empty set."""
    for _, _, text, ends in arrays.text_slices(column):
        starts, stops, before = arrays.words(text, ends)
        values = arrays.word_hashes(arrays.lowered(text), starts, stops)
        runs = arrays.run_hashes(values, SHINGLE_WORDS)
        for a, b in zip(before[:-1].tolist(), before[1:].tolist()):
            if b - a >= SHINGLE_WORDS:
                yield np.unique(runs[a : b - SHINGLE_WORDS + 1])
            elif b > a:
                yield arrays.run_hashes(values[a:b], b - a)
            else:
                yield values[:0]


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each universal hash function over a set that is not empty."""
    least = np.full(len(_A), np.iinfo(np.uint64).max)
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), 2048):
            values = _A[:, None] * shingles[None, at : at + 2048]
            values += _B[:, None]
            np.minimum(least, values.min(axis=1), out=least)
    return least


def _signed_rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes, prints, bits, bands = [], [], [], []
    for shingles in shingle_sets(batch.column("text")):
        sizes.append(len(shingles))
        if not len(shingles):
            prints.append((0, 0))
            bits.append((0, 0))
            bands.append(np.zeros(0, np.uint64))
            continue
        with np.errstate(over="ignore"):
            prints.append((int(shingles.sum()), int(arrays.mixed(shingles ^ _A[0]).sum())))
        least = minima(shingles)
        flags = np.packbits((arrays.mixed(least) & np.uint64(1)).astype(np.uint8)).view(np.uint64)
        bits.append((int(flags[0]), int(flags[1])))
        with np.errstate(over="ignore"):
            by_band = (least.reshape(BANDS, ROWS) * _A[:ROWS]).sum(axis=1) + _B[:BANDS]
        bands.append(arrays.mixed(by_band))
    column = lambda pairs, i: pa.array(arrays.signed(np.array([p[i] for p in pairs], np.uint64)))
    yield pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id"),
            pa.array(sizes, type=pa.int64()),
            column(prints, 0), column(prints, 1), column(bits, 0), column(bits, 1),
            arrays.list_array(arrays.signed(np.concatenate([*bands, np.zeros(0, np.uint64)])), np.array([len(b) for b in bands], np.int64), pa.int64()),
        ],
        names=["doc_id", "n_shingles", "print_a", "print_b", "bits_a", "bits_b", "bands"],
    )


def signatures(docs: DataFrame) -> DataFrame:
    """Size, 128-bit fingerprint, one-bit minima and band keys of every document's shingle set."""
    return in_batches(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")),
        _signed_rows,
        "doc_id long, n_shingles long, print_a long, print_b long, bits_a long, bits_b long, bands array<long>",
    )


def _set_rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    ids, sets, held = [], [], 0

    def out() -> pa.RecordBatch:
        lengths = np.array([len(s) for s in sets], np.int64)
        values = arrays.signed(np.concatenate([*sets, np.zeros(0, np.uint64)]))
        return pa.RecordBatch.from_arrays([pa.array(ids, type=pa.int64()), arrays.list_array(values, lengths, pa.int64())], names=["id", "shingles"])

    for doc_id, shingles in zip(batch.column("doc_id").to_pylist(), shingle_sets(batch.column("text"))):
        ids.append(doc_id)
        sets.append(shingles)
        held += len(shingles)
        if held > 1_000_000:
            yield out()
            ids, sets, held = [], [], 0
    if ids:
        yield out()


def _sketch_rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    a, b = (arrays.seeds(2 * SKETCH, 400_000).reshape(2, SKETCH, 1) >> np.uint64(32)).astype(np.uint32)
    found = []
    for shingles in batch.column("shingles"):
        values = (shingles.values.to_numpy().view(np.uint64) >> np.uint64(32)).astype(np.uint32)
        least = np.full(SKETCH, np.iinfo(np.uint32).max)
        for at in range(0, len(values), 2048):
            with np.errstate(over="ignore"):
                np.minimum(least, ((a | 1) * values[None, at : at + 2048] + b).min(axis=1), out=least)
        found.append((arrays.mixed(least.astype(np.uint64)) & np.uint64(255)).astype(np.uint8).tobytes())
    yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.binary())], names=["id", "sketch"])


def _near(bucket: dict[str, np.ndarray], i: int) -> np.ndarray:
    """Documents whose size and sketch allow similarity with document i. Two that share several
    bands are let through in the one with the smallest key only."""
    sizes = bucket["n_shingles"]
    good = np.minimum(sizes, sizes[i]) * 100 >= np.maximum(sizes, sizes[i]) * SIMILARITY_PERCENT
    at = np.flatnonzero(good)
    for first in range(0, len(at), 4096):
        some = at[first : first + 4096]
        alike = (bucket["sketch"][some] == bucket["sketch"][i]).sum(axis=1) >= LEAST_EQUAL
        bands = bucket["bands"][some]
        first_band = np.where(bands == bucket["bands"][i], bands, np.iinfo(np.int64).max).min(axis=1)
        good[some] = alike & (first_band == bucket["key"][0])
    return good


def similar(a: Column, b: Column) -> Column:
    """Exact similarity test of two arrays of distinct values."""
    both = F.size(F.array_intersect(a, b))
    return both * 100 >= (F.size(a) + F.size(b) - both) * SIMILARITY_PERCENT


def may_be_similar(a: str, b: str) -> Column:
    """What sizes and one-bit minima allow; ``a`` and ``b`` are aliases of rows of signatures."""
    low, high = F.least(f"{a}.n_shingles", f"{b}.n_shingles"), F.greatest(f"{a}.n_shingles", f"{b}.n_shingles")
    different = F.bit_count(F.col(f"{a}.bits_a").bitwiseXOR(F.col(f"{b}.bits_a"))) + F.bit_count(
        F.col(f"{a}.bits_b").bitwiseXOR(F.col(f"{b}.bits_b"))
    )
    return (low * 100 >= high * SIMILARITY_PERCENT) & (different <= MOST_DIFFERENT_BITS)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Links among candidate pairs (a, b), confirmed on the full sets."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b"))
    return pairs.join(left, "a").join(right, "b").filter(similar(F.col("set_a"), F.col("set_b"))).select("a", "b")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents with equal shingle sets are one class and stand for each other; classes that share a
    band are candidates, links are confirmed on the full sets, and components are the documents
    linked by any chain. At a similarity of exactly 0.75 a single pair escapes all bands with a
    probability of 5e-6, at 0.8 with 5e-8.

    A null or empty text, or one of white space, has no shingles and is linked with nothing, so it
    is kept. A null doc_id is its own component: null, kept. Rows that repeat a doc_id are one
    document with several texts: linked with whatever one of them is linked with; each row comes
    back. Extra columns are ignored. An empty table gives an empty result."""
    signed = staged(signatures(docs))
    linkable = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    by_print = linkable.groupBy("n_shingles", "print_a", "print_b").agg(
        F.min("doc_id").alias("id"), F.first("bits_a").alias("bits_a"), F.first("bits_b").alias("bits_b"), F.first("bands").alias("bands")
    )
    classes = staged(by_print)
    keyed = classes.select("id", "n_shingles", "bits_a", "bits_b", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    rows = staged(keyed.join(shared, "key"))
    needed = rows.select("id").distinct()
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(
        needed.select(F.col("id").alias("doc_id")), "doc_id", "left_semi"
    )
    sets = staged(in_batches(texts, _set_rows, "id long, shingles array<long>"))

    def others(open_rows: DataFrame) -> DataFrame:
        held = sets.join(open_rows.select("id").distinct(), "id", "left_semi")
        sketches = in_batches(held, _sketch_rows, "id long, sketch binary")
        facts_of = open_rows.join(sketches, "id").join(classes.select("id", "bands"), "id")
        return pairs_in_buckets(facts_of, ["n_shingles", "sketch", "bands"], _near)

    # the smallest id of a bucket, and others picked at random but the same each time
    picks = [F.col("id"), *(F.xxhash64("id", F.lit(i)) for i in range(1, HUBS))]
    facts = ["id", "n_shingles", "bits_a", "bits_b"]
    links = bucket_links(rows, facts, picks, may_be_similar, others, lambda pairs: _verified(pairs, sets))
    same = linkable.join(
        classes.select("n_shingles", "print_a", "print_b", "id"), ["n_shingles", "print_a", "print_b"]
    ).select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
    found = components(links.union(same))
    return (
        signed.select("doc_id", "n_shingles")
        .join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """The documents kept: one of each group, with all their columns. Of rows that repeat a kept
    doc_id all stay."""
    gone = near_duplicates(docs).filter("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)
