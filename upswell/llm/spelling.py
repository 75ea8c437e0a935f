"""Spelling variants: words one edit apart, by neighbourhoods over a reduced alphabet.

Letters are hashed to a few symbols. Words one edit apart have reduced words at most one edit apart,
so every distinct reduced word generates its full neighbourhood of one edit (itself, and each place
dropped, replaced or preceded by any symbol), and what of it is in the reduced vocabulary is found by
an equi-join of 64-bit hashes. A bitmap of bounded size, made from that vocabulary, drops most of the
rest before the shuffle; it only ever drops what is not there. Pairs of words that meet are verified
on the original strings, so neither hashes nor symbols can give a wrong pair."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from upswell.llm import arrays
from upswell.llm.frames import in_batches, staged

#: Symbols of the reduced alphabet.
SYMBOLS = 8
#: The bitmap has 2**SLOT_BITS bits (8 MB), built in pieces of 2**PIECE_BITS.
SLOT_BITS, PIECE_BITS = 26, 15
#: Places of reduced words whose neighbours are generated at once.
PLACES = 1 << 17
#: A form has at least so many times the occurrences of its word.
FORM_RATIO = 10
#: What a word consists of, and the letters whose case is dropped.
LETTERS, UPPER = "[A-Za-zÀ-ÿ]", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))


def word_counts(docs: DataFrame, dropped: Column | None = None, min_length: int = 7, min_count: int = 2) -> DataFrame:
    """(word, n) of the words of all texts that are long and frequent enough.

    A word is a maximal run of ``LETTERS`` with A-Z in lower case. ``dropped`` may name the place,
    from 0, of a code point to delete from a run, or NULL; it can refer to ``doc_id`` and ``word``.
    Null and empty texts have no words, texts of any length are read whole, repeated rows count again."""
    lowered = F.translate(F.col("text"), UPPER, UPPER.lower())
    # Shorter runs cannot give a word; a run of enough letters is matched as a whole.
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(lowered, F.lit(f"{LETTERS}{{{min_length},}}"), F.lit(0))).alias("word"))
    if dropped is not None:
        at = F.col("__at")
        cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
        runs = runs.withColumn("__at", dropped).select(F.when(at.isNull(), F.col("word")).otherwise(cut).alias("word")).filter(F.length("word") >= min_length)
    return runs.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)


def symbols_of(codes: np.ndarray) -> np.ndarray:
    """Symbols, from 1, of code points."""
    return arrays.mixed(codes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) % np.uint64(SYMBOLS) + np.uint64(1)


class Reduced:
    """Reduced words as polynomials over a 64-bit ring, one after the other."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray) -> None:
        self.symbols, self.lengths = symbols, lengths
        self.ends = np.concatenate([[0], np.cumsum(lengths)])
        longest = int(lengths.max(initial=0)) + 2
        with np.errstate(over="ignore"):
            self.powers = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(longest, _BASE, np.uint64)]))
            self.place = np.arange(len(symbols)) - np.repeat(self.ends[:-1], lengths)
            self.terms = symbols * self.powers[self.place]
            running = np.concatenate([[np.uint64(0)], np.cumsum(self.terms, dtype=np.uint64)])
            self.before = running[:-1] - np.repeat(running[self.ends[:-1]], lengths)  # of the symbols before a place
            self.whole = running[self.ends[1:]] - running[self.ends[:-1]]

    def keys(self) -> np.ndarray:
        return arrays.mixed(self.whole)

    def neighbours(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row, key) of all reduced words at most one edit away, in runs of bounded size."""
        rows = np.arange(len(self.lengths))
        yield rows, self.keys()
        every = np.arange(1, SYMBOLS + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            # a symbol after the last
            after = self.whole[:, None] + every * self.powers[self.lengths][:, None]
            yield np.repeat(rows, SYMBOLS), arrays.mixed(after.ravel())
            of = np.repeat(rows, self.lengths)
            for a in range(0, len(self.symbols), PLACES):
                part = slice(a, a + PLACES)
                row, before, term, power = of[part], self.before[part], self.terms[part], self.powers[self.place[part]]
                rest = self.whole[row] - before  # this symbol and all after it
                yield row, arrays.mixed(before + (rest - term) * _INVERSE)
                replaced = (self.whole[row] - term)[:, None] + every * power[:, None]
                yield np.repeat(row, SYMBOLS), arrays.mixed(replaced.ravel())
                preceded = (before + rest * np.uint64(_BASE))[:, None] + every * power[:, None]
                yield np.repeat(row, SYMBOLS), arrays.mixed(preceded.ravel())


def _reduce(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for first, last, words in arrays.string_slices(batch.column("word")):
        lengths = np.array([len(w) for w in words], np.int64)
        symbols = symbols_of(np.frombuffer("".join(words).encode("utf-32-le"), "<u4"))
        raw = (symbols + np.uint64(48)).astype(np.uint8).tobytes().decode()  # digits
        ends = np.concatenate([[0], np.cumsum(lengths)]).tolist()
        reduced = [raw[a:b] for a, b in zip(ends[:-1], ends[1:])]
        part = batch.slice(first, last - first)
        yield pa.RecordBatch.from_arrays(
            [part.column("word"), part.column("n"), pa.array(reduced), pa.array(arrays.signed(Reduced(symbols, lengths).keys()))], names=["word", "n", "reduced", "key"]
        )


def _slots(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _bitmap(keys: DataFrame) -> np.ndarray:
    """Bits of the slots of all keys. Executors build its pieces, whose number and size are fixed."""

    def piece(table: pa.Table) -> pa.Table:
        slots = _slots(table.column("key").to_numpy().view(np.uint64)) & ((1 << PIECE_BITS) - 1)
        bits = np.zeros(1 << PIECE_BITS, bool)
        bits[slots] = True
        return pa.table([table.column("piece").slice(0, 1), pa.array([np.packbits(bits).tobytes()])], names=["piece", "bits"])

    pieces = keys.select(F.shiftrightunsigned("key", 64 - SLOT_BITS + PIECE_BITS).alias("piece"), "key").groupBy("piece").applyInArrow(piece, "piece long, bits binary")
    out = np.zeros(1 << (SLOT_BITS - 3), np.uint8)
    size = 1 << (PIECE_BITS - 3)
    for row in pieces.toLocalIterator():
        out[row.piece * size : (row.piece + 1) * size] = np.frombuffer(row.bits, np.uint8)
    return out


def near_words(vocabulary: DataFrame) -> DataFrame:
    """(word, n, near, near_n) for every ordered pair of words of ``vocabulary`` (word, n; distinct)
    that differ by exactly one inserted, deleted or replaced code point. Words of any length take
    part; null words are in no pair."""
    words = staged(in_batches(vocabulary.select("word", "n").filter("word IS NOT NULL"), _reduce, "word string, n long, reduced string, key long"))
    distinct = words.select("reduced", "key").distinct()
    known = words.sparkSession.sparkContext.broadcast(_bitmap(distinct.select("key")))

    def probes(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        bits = known.value
        own = batch.column("key").to_numpy()
        raw, ends = arrays.buffers(batch.column("reduced"))
        raw = raw[ends[0] : ends[-1]].astype(np.uint64) - np.uint64(48)
        kept_rows, kept_keys = [], []
        for row, key in Reduced(raw, np.diff(ends)).neighbours():
            slot = _slots(key)
            hit = (bits[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == 1
            kept_rows.append(row[hit])
            kept_keys.append(key[hit])
        row, key = np.concatenate([*kept_rows, np.zeros(0, np.int64)]), np.concatenate([*kept_keys, np.zeros(0, np.uint64)])
        order = np.lexsort([key, row])
        row, key = row[order], key[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(own[row[new]]), pa.array(arrays.signed(key[new]))], names=["source", "probe"])

    met = in_batches(distinct, probes, "source long, probe long")
    sources = words.select(F.col("key").alias("source"), "word", "n")
    targets = words.select(F.col("key").alias("probe"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    # Inside the join, so pairs that only look alike when reduced are never rows.
    one_edit = (F.abs(F.length("word") - F.length("near")) <= 1) & (F.levenshtein("word", "near", 1) == 1)
    reached = met.join(targets, "probe").drop("probe")
    return reached.join(sources, (reached["source"] == sources["source"]) & one_edit).select("word", "n", "near", "near_n")


def variants(vocabulary: DataFrame) -> DataFrame:
    """Every word of ``vocabulary`` (word, n; distinct) with its form, root and near words.

    ``n_near``: words one edit away. ``form``: the one with most occurrences (ties: first in
    code-point order) if it has ``FORM_RATIO`` times the word's, ``form_n`` its occurrences. ``root``:
    the last word on the way from form to form, the word itself if it has none. A form is always more
    frequent than its word, so the way ends."""
    vocabulary = staged(vocabulary.select("word", "n"))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    near = near_words(vocabulary).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    enough = -F.col("best.less") >= FORM_RATIO * F.col("n")
    out = staged(
        vocabulary.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, F.col("best.form")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"),
        )
    )
    roots = _followed(out.filter("form IS NOT NULL").select("word", F.col("form").alias("to")))
    return out.join(roots.withColumnRenamed("to", "root"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _followed(ways: DataFrame) -> DataFrame:
    """(word, to) with ``to`` at the end of the way: each round doubles how far it reaches."""
    while True:
        further = ways.select(F.col("word").alias("to"), F.col("to").alias("next"))
        seen = Observation()
        step = ways.join(further, "to", "left").observe(seen, F.count("next").alias("moved"))
        ways = staged(step.select("word", F.coalesce("next", "to").alias("to")))
        if not seen.get["moved"]:
            return ways
