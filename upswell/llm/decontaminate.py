"""Benchmark items inside documents, whole or slightly edited.

Texts are sequences of words (A-Z in lower case). A window of a document, as long as an item, is a
candidate when enough of its words, and of its different words, occur in items of that size: bounds
that no window within the edits allowed can miss. Windows also start before a document's first word,
as if blanks stood there, for items whose beginning is missing. Candidates and items are embedded by CGK random walks, which turn edit
distance into Hamming distance; each of several walks is sampled at a few of its positions, and a
window meets an item when one sample agrees. Pairs that meet are confirmed by edit distance."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upswell.llm import arrays
from upswell.llm.frames import in_batches, staged

#: Words of an item that may be inserted, dropped or replaced.
EDIT_SHARE = 0.2
#: Walks of three steps a word; each is sampled at so many positions, and there are so many walks.
SAMPLED, WALKS = 2, 32
#: Items of about the same size share windows of one size; sizes grow by this factor.
SIZE_STEP = 1.06
#: Slots of the word table sent to every task: at most 2 MB, however many items there are.
SLOT_BITS = 18

#: Stands for the words before a document.
_BLANK = np.uint64(1)
_WALK_SEEDS = arrays.seeds(WALKS, 800_000)


def edits_allowed(n_words):
    return np.floor(EDIT_SHARE * np.asarray(n_words)).astype(np.int64)


def size_grid(most: int) -> list[int]:
    """Window sizes up to the longest item."""
    sizes = [1]
    while sizes[-1] < most:
        sizes.append(max(sizes[-1] + 1, int(sizes[-1] * SIZE_STEP)))
    return sizes


def walk_samples(words: np.ndarray, starts: np.ndarray, stops: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sampled embeddings of spans of ``words``: one hash for each span and walk.

    At step j of a walk over a span, the word at the current place is put out and the place moves
    on if a random bit of (walk, step, word) says so; past the end a blank is put out. Positions are
    sampled among the first steps of a walk over ``sizes`` words, where hardly any walk has reached
    the end, so spans compared use the same."""
    out = np.zeros((len(starts), WALKS), np.uint64)
    padded = np.append(words, np.uint64(0))
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        for w in range(WALKS):
            picked = np.sort(arrays.seeds(SAMPLED, 1_000 * (w + 1)) % np.uint64(1 + 3 * int(size) // 2)).astype(np.int64)
            place, ends = starts[rows].copy(), stops[rows]
            hashes = np.full(len(rows), _WALK_SEEDS[w])
            for step in range(int(picked[-1]) + 1):
                inside = place < ends
                shown = np.where(inside, padded[np.minimum(place, len(words))], np.uint64(0))
                with np.errstate(over="ignore"):
                    for _ in range(int((picked == step).sum())):
                        hashes = arrays.mixed(hashes + shown)
                    bit = arrays.mixed(shown ^ (_WALK_SEEDS[w] + np.uint64(step)))
                place += (inside & ((bit & np.uint64(1)) == 1)).astype(np.int64)
            with np.errstate(over="ignore"):
                out[rows, w] = arrays.mixed(hashes ^ np.uint64(size))
    return out


def _words_of(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for first, last, text, ends in arrays.text_slices(column):
        starts, stops, before = arrays.words(text, ends)
        yield first, last, arrays.word_hashes(arrays.lowered(text), starts, stops), before


def _item_rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for first, last, words, before in _words_of(batch.column("text")):
        yield pa.RecordBatch.from_arrays(
            [batch.column("item_id").slice(first, last - first), arrays.list_array(arrays.signed(words), np.diff(before), pa.int64())],
            names=["item_id", "item_words"],
        )


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list column."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False).view(np.uint64)
    return values[offsets[0] : offsets[-1]], offsets - offsets[0]


def _with_samples(batch: pa.RecordBatch, words: str) -> Iterator[pa.RecordBatch]:
    values, offsets = _flat(batch.column(words))
    sizes = batch.column("size").to_numpy()
    samples = walk_samples(values, offsets[:-1], offsets[1:], sizes)
    lengths = np.full(len(batch), WALKS)
    yield pa.RecordBatch.from_arrays(
        [batch.column(0), arrays.list_array(arrays.signed(samples.ravel()), lengths, pa.int64())],
        names=[batch.schema.names[0], "samples"],
    )


def _earlier(words: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Where each word last occurred before in its row; -1 if nowhere."""
    order = np.lexsort((words, row))
    same = (words[order[1:]] == words[order[:-1]]) & (row[order[1:]] == row[order[:-1]])
    out = np.full(len(words), -1)
    out[order[1:][same]] = order[:-1][same]
    return out


def _different(known: np.ndarray, earlier: np.ndarray, at: np.ndarray, stops: np.ndarray, size: int) -> np.ndarray:
    """Different known words of each window."""
    out = np.zeros(len(at), np.int32)
    for first in range(0, len(at), 1 << 15):
        some = at[first : first + (1 << 15), None]
        place = np.minimum(some + np.arange(size), len(known) - 1)
        new = (known[place] > 0) & (earlier[place] < some) & (some + np.arange(size) < stops[first : first + (1 << 15), None])
        out[first : first + (1 << 15)] = new.sum(axis=1)
    return out


def _early_windows(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Windows that start before their documents: for each number of blanks up to the edits allowed,
    that number, where the words end, and the windows' words with their offsets."""
    edits = int(edits_allowed(size))
    for blanks in range(1, edits + 1):
        stops = np.minimum(starts + size + edits - blanks, ends)
        offsets = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(stops - starts + blanks, out=offsets[1:])
        within = np.arange(offsets[-1]) - np.repeat(offsets[:-1], np.diff(offsets))
        place = np.repeat(starts, np.diff(offsets)) + within - blanks
        yield blanks, stops, np.where(within < blanks, _BLANK, words[np.maximum(place, 0)]), offsets


def _window_rows(batch: pa.RecordBatch, sizes: list[int], needs: list[tuple[int, int]], table: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Windows of the batch's documents in which enough words occur in items of that size."""
    ids, seen = batch.column("doc_id"), set()
    for first, _, words, before in _words_of(batch.column("text")):
        masks = table[(words >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]
        if not len(words) or not masks.any():
            continue
        row = arrays.rows_of(before)
        ends = before[1:][row]
        sums, earlier = arrays.prefix_sums(words), None
        for c, (size, (need, different)) in enumerate(zip(sizes, needs)):
            known = ((masks[:, c // 64] >> np.uint64(c % 64)) & np.uint64(1)).astype(np.int32)
            total = np.zeros(len(known) + 1, np.int32)
            np.cumsum(known, out=total[1:])
            heads = before[:-1][before[:-1] < before[1:]]
            stops = np.minimum(heads + size, ends[heads])
            enough = total[stops] - total[heads] >= need
            heads = heads[enough]
            if len(heads):
                earlier = _earlier(words, row) if earlier is None else earlier
                heads = heads[_different(known, earlier, heads, stops[enough], size) >= different]
            if len(heads):
                for blanks, stops, flat, offsets in _early_windows(words, heads, ends[heads], size):
                    keys = arrays.signed(arrays.mixed(arrays.span_hashes(sums, heads, stops) ^ arrays.mixed(np.uint64([size + (blanks << 32)]))))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(keys), ids.take(pa.array(row[heads] + first)), pa.array(np.full(len(heads), -blanks)),
                            pa.array(np.full(len(heads), size)), arrays.list_array(arrays.signed(flat), np.diff(offsets), pa.int64()),
                        ],
                        names=["window", "doc_id", "start_word", "size", "words"],
                    )
            at = np.flatnonzero(known)
            stops = np.minimum(at + size, ends[at])
            enough = total[stops] - total[at] >= need
            at = at[enough]
            if len(at):
                earlier = _earlier(words, row) if earlier is None else earlier
                at = at[_different(known, earlier, at, stops[enough], size) >= different]
            if not len(at):
                continue
            stops = np.minimum(at + size + int(edits_allowed(size)), ends[at])
            keys = arrays.signed(arrays.mixed(arrays.span_hashes(sums, at, stops) ^ np.uint64(size)))
            # the words stand with the first of equal windows
            fresh = np.array([k not in seen and not seen.add(k) for k in keys.tolist()], bool)
            lengths = np.where(fresh, stops - at, 0)
            offsets = np.zeros(len(at) + 1, np.int64)
            np.cumsum(lengths, out=offsets[1:])
            flat = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - at, lengths)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys), ids.take(pa.array(row[at] + first)), pa.array(at - before[row[at]]),
                    pa.array(np.full(len(at), size)), arrays.list_array(arrays.signed(words[flat]), lengths, pa.int64()),
                ],
                names=["window", "doc_id", "start_word", "size", "words"],
            )


def best_places(item: list[np.ndarray], text: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each pair the least edit distance between the item and any stretch of the text, and that
    stretch's start and end (the earliest end, then the latest start)."""
    rows, most = len(item), max((len(t) for t in text), default=0)
    lengths = np.array([len(t) for t in text], np.int64)
    padded = np.zeros((rows, most), np.uint64)
    for i, t in enumerate(text):
        padded[i, : len(t)] = t
    far, out_d = np.int64(1 << 20), np.zeros(rows, np.int64)
    out_a, out_b = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    across = np.arange(most + 1)
    # a cell holds distance * far - start, so the least cell has the least distance, then the latest start
    cell = np.broadcast_to(-across, (rows, most + 1)).copy()
    steps = max((len(p) for p in item), default=0)
    for step in range(steps + 1):
        done = np.flatnonzero(np.array([len(p) for p in item]) == step)
        if len(done):
            valid = np.where(across[None, :] <= lengths[done, None], cell[done], far * far)
            # rounded up, the distance alone; the first column with the least wins
            distance = -(-valid // far)
            end = distance.argmin(axis=1)
            out_d[done] = distance[np.arange(len(done)), end]
            out_b[done] = end
            out_a[done] = out_d[done] * far - valid[np.arange(len(done)), end]
        if step == steps:
            break
        word = np.array([p[step] if step < len(p) else 0 for p in item], np.uint64)
        best = np.minimum(cell[:, 1:] + far, cell[:, :-1] + far * (padded != word[:, None]))
        new = np.concatenate([cell[:, :1] + far, best], axis=1)
        cell = np.minimum.accumulate(new - far * across, axis=1) + far * across
    return out_d, out_a, out_b


def _confirmed_rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(batch), 1024):
        part = batch.slice(at, 1024)
        cut = lambda name: np.split(*(lambda v, o: (v, o[1:-1]))(*_flat(part.column(name))))
        items, texts = cut("item_words"), cut("words")
        distance, start, end = best_places(items, texts)
        good = np.flatnonzero(distance <= edits_allowed([len(p) for p in items]))
        if len(good):
            taken = part.take(pa.array(good))
            yield pa.RecordBatch.from_arrays(
                [taken.column("window"), taken.column("item_id"), pa.array(distance[good]), pa.array(np.array([len(items[i]) for i in good])), pa.array(start[good]), pa.array(end[good])],
                names=["window", "item_id", "distance", "n_item_words", "a", "b"],
            )


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, distance (in words), n_item_words,
    and the place: start_word, end_word (words from 0, end not included) of the best match, the
    earliest of equals.

    An item is found when a stretch of the document differs from it in at most a fifth of its words.
    A single occurrence with all those edits is met with a probability of 0.97 or more in trials with
    38 to 100 words, also at a document's start with the first fifth missing or words missing here and
    there; with all missing words in its first half 0.83 at 80 words. With fewer edits it is met almost
    surely. A null or empty text has no words and is in nothing and found nowhere. Rows
    that repeat a doc_id count as one document, items that repeat a text are each found. A null
    doc_id or item_id comes back as null. Extra columns are ignored."""
    items = in_batches(
        benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")), _item_rows, "item_id long, item_words array<long>"
    )
    counts = F.size("item_words").alias("n"), F.size(F.array_distinct("item_words")).alias("different")
    items = staged(items.filter("size(item_words) > 0").select("item_id", "item_words", *counts))
    most = items.agg(F.max("n")).first()[0] or 0
    grid = size_grid(most)
    # a size is the smallest of the grid that holds the item
    bounds = F.lit(None)
    for s in reversed(grid):
        bounds = F.when(F.col("n") <= s, F.lit(s)).otherwise(bounds)
    items = items.withColumn("size", bounds.cast("long"))
    # one row for each size of the grid
    used = items.groupBy("size").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.min("different").alias("different")).orderBy("size").collect()
    sizes = [r["size"] for r in used]
    needs = [(int(r["least"] - edits_allowed(r["most"])), int(r["different"] - edits_allowed(r["most"]))) for r in used]
    slots = (
        items.select("size", F.explode("item_words").alias("w"))
        .select("size", F.shiftrightunsigned("w", 64 - SLOT_BITS).alias("slot")).distinct()
    )
    table = np.zeros((1 << SLOT_BITS, max(1, -(-len(sizes) // 64))), np.uint64)
    for row in slots.groupBy("size").agg(F.collect_list("slot").alias("slots")).toLocalIterator():
        c = sizes.index(row["size"])
        table[np.array(row["slots"], np.int64), c // 64] |= np.uint64(1 << (c % 64))
    shared = docs.sparkSession.sparkContext.broadcast(table)
    named = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    windows = staged(
        in_batches(
            named, lambda batch: _window_rows(batch, sizes, needs, shared.value),
            "window long, doc_id long, start_word long, size long, words array<long>",
        )
    )
    distinct = staged(windows.filter("size(words) > 0").groupBy("window").agg(F.first("size").alias("size"), F.first("words").alias("words")))
    samples = in_batches(distinct.select("window", "size", "words"), lambda b: _with_samples(b, "words"), "window long, samples array<long>")
    marked = in_batches(
        items.select(F.struct("item_id", "item_words").alias("item"), "size", "item_words"), lambda b: _with_samples(b, "item_words"),
        "item struct<item_id: long, item_words: array<long>>, samples array<long>",
    )
    met = (
        samples.select("window", F.explode("samples").alias("sample"))
        .join(marked.select("item", F.explode("samples").alias("sample")), "sample")
        .select("window", "item").distinct()
    )
    pairs = met.join(distinct.select("window", "words"), "window").select("window", "item.item_id", "item.item_words", "words")
    good = in_batches(pairs, _confirmed_rows, "window long, item_id long, distance long, n_item_words long, a long, b long")
    place = F.struct("distance", (F.col("start_word") + F.col("a")).alias("start_word"), (F.col("start_word") + F.col("b")).alias("end_word"))
    return (
        windows.select("window", "doc_id", "start_word").join(good, "window")
        .groupBy("doc_id", "item_id").agg(F.min(place).alias("best"), F.first("n_item_words").alias("n_item_words"))
        .select("doc_id", "item_id", "best.distance", "n_item_words", "best.start_word", "best.end_word")
    )


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no item is found, with all their columns. Rows without a doc_id stay
    only if no text without a doc_id holds an item."""
    found = staged(contaminated(docs, benchmark).select(F.col("doc_id").alias("found")).distinct())
    return docs.join(found, docs.doc_id.eqNullSafe(found.found), "left_anti")
