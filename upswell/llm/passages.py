"""Passages that repeat across documents, by sparse suffix arrays.

Texts are sequences of words. Of all suffixes only those are kept that start at a minimiser: a place
whose hash is the smallest of the places around it. Every passage of MIN_WORDS words holds the first
CORE words of a kept suffix. Suffixes whose core no other shares are dropped; the others are sorted
by core. A core's suffixes stand in one task and are compared there by every window of MIN_WORDS words
around it. Of a core that more than MOST_TOGETHER have only a batch is held: its suffixes are sorted by
the words after it, and by the words before it, backwards; in either order neighbours are compared and
the match is extended to both sides. Neighbours also bound what any other suffix can share on either
side; where that leaves a window open, the suffixes of the core are compared by that window, which finds
partners that are neighbours in neither order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upswell.llm import arrays
from upswell.llm.frames import in_batches, staged

#: Words of the shortest passage that counts.
MIN_WORDS = 50
#: One place of any so many neighbouring ones is kept.
WINDOW = 16
CORE = MIN_WORDS - WINDOW + 1
#: Words at a place that decide whether it is kept.
GRAM = 4
#: Words to either side of a core that are compared; a longer match goes on at the next kept place.
SIDE = WINDOW
#: Words of the shortest passage beside its core.
MORE = MIN_WORDS - CORE
#: Suffixes of a core that are held in a task at once; a core with more is sorted instead.
MOST_TOGETHER = 4096
_WORD_FACTORS = arrays.seeds(2 * SIDE, 130_000) | np.uint64(1)
_SUFFIXES = "core long, ahead binary, behind binary, doc_id long, text_print long, place int, room_ahead int, room_behind int, heavy boolean, own_start array<long>, own_end array<long>"
TOLD = "core long, doc_id long, text_print long, place int, ahead int, behind int, windows int, led int, start_word long, end_word long"


def kept_places(words: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Places of ``words`` whose GRAM words have the smallest hash of some WINDOW neighbouring places
    of their row, and that have CORE words from there on."""
    grams = arrays.run_hashes(words, GRAM)
    out = []
    n = len(grams)
    if n:
        # the smallest of every window of places, the first of equals; windows that reach over a
        # row's end only add places
        least = np.lib.stride_tricks.sliding_window_view(np.concatenate([grams, np.full(WINDOW - 1, np.iinfo(np.uint64).max)]), WINDOW)
        picked = np.zeros(n, bool)
        for a in range(0, n, 1 << 16):
            part = least[a : a + (1 << 16)]
            picked[np.minimum(a + np.arange(len(part)) + part.argmin(axis=1), n - 1)] = True
        places = np.flatnonzero(picked)
        row = np.searchsorted(before, places, side="right") - 1
        out.append(places[places + CORE <= before[row + 1]])
    return out[0] if out else np.zeros(0, np.int64)


def _words(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for first, last, text, ends in arrays.text_slices(column):
        starts, stops, before = arrays.words(text, ends)
        yield first, last, arrays.word_hashes(text, starts, stops), before


def _core_rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Cores of every document with the places where it has them, so that one that repeats a word
    many times has a row for it, not many."""
    for first, _, words, before in _words(batch.column("text")):
        places = kept_places(words, before)
        if not len(places):
            continue
        row = np.searchsorted(before, places, side="right") - 1
        cores = arrays.span_hashes(arrays.prefix_sums(words), places, places + CORE)
        order = np.lexsort((places, cores, row))
        places, cores, row = places[order], cores[order], row[order]
        heads = np.flatnonzero(np.concatenate([[True], (cores[1:] != cores[:-1]) | (row[1:] != row[:-1])]))
        lengths = np.diff(np.append(heads, len(row)))
        picked = pa.array(row[heads] + first)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(arrays.signed(cores[heads])), batch.column("doc_id").take(picked), batch.column("text_print").take(picked),
                arrays.list_array((places - before[row]).astype(np.int32), lengths, pa.int32()),
            ],
            names=["core", "doc_id", "text_print", "places"],
        )


def _suffix_rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The suffixes asked for with the words around their cores: 4 bytes a word, those before the
    core backwards, 0 beyond the text. Those of a text that are alike in all of these are one row, with
    the first place and what their windows cover. Places of cores that very many suffixes have come
    negated, bit by bit."""
    for first, last, words, before in _words(batch.column("text")):
        asked = batch.column("places").slice(first, last - first)
        counts = np.diff(asked.offsets.to_numpy().astype(np.int64))
        row = np.repeat(np.arange(last - first), counts)
        places = asked.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        if not len(places):
            continue
        heavy = places < 0
        places = np.where(heavy, ~places, places) + before[row]
        short = np.append((words >> np.uint64(32)).astype(np.uint32) | np.uint32(1), np.uint32(0))
        side = np.arange(SIDE)
        ahead = places[:, None] + CORE + side[None, :]
        ahead[ahead >= before[row + 1][:, None]] = len(words)
        behind = places[:, None] - 1 - side[None, :]
        behind[behind < before[row][:, None]] = len(words)
        ahead, behind = short[ahead], short[behind]
        cores = arrays.span_hashes(arrays.prefix_sums(words), places, places + CORE)
        with np.errstate(over="ignore"):
            around = (arrays.mixed(np.concatenate([ahead, behind], axis=1).astype(np.uint64)) * _WORD_FACTORS).sum(axis=1, dtype=np.uint64)
        order = np.lexsort((places, around, cores, row))
        new = np.ones(len(order), bool)
        new[1:] = (row[order[1:]] != row[order[:-1]]) | (cores[order[1:]] != cores[order[:-1]]) | (around[order[1:]] != around[order[:-1]])
        heads, n = order[new], np.diff(np.append(np.flatnonzero(new), len(order)))
        place = places - before[row]
        room_ahead, room_behind = np.minimum(SIDE, before[row + 1] - places - CORE), np.minimum(SIDE, place)
        # where alike ones stand every window repeats: what these cover, touching ones as one
        twice = (np.repeat(n, n) > 1) & (room_ahead + room_behind >= MORE)[order]
        at, group = order[twice], np.cumsum(new)[twice] - 1
        low, high = place[at] - np.minimum(room_behind[at], MORE), place[at] + CORE + np.minimum(room_ahead[at], MORE)
        apart = np.ones(len(at) + 1, bool)
        apart[1:-1] = (group[1:] != group[:-1]) | (low[1:] > high[:-1])
        spans = np.bincount(group[apart[:-1]], minlength=len(heads))
        as_bytes = lambda x: pa.array([r.tobytes() for r in x.astype(">u4")], pa.binary())
        as_int = lambda x: pa.array(x.astype(np.int32))
        picked = pa.array(row[heads] + first)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(arrays.signed(cores[heads])), as_bytes(ahead[heads]), as_bytes(behind[heads]), batch.column("doc_id").take(picked),
                batch.column("text_print").take(picked), as_int(place[heads]), as_int(room_ahead[heads]), as_int(room_behind[heads]), pa.array(heavy[heads]),
                arrays.list_array(low[apart[:-1]], spans, pa.int64()), arrays.list_array(high[apart[1:]], spans, pa.int64()),
            ],
            names=[c.split()[0] for c in _SUFFIXES.split(", ")],
        )


def _shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading words equal in rows of words."""
    same = (a == b) & (a != 0)
    return np.where(same.all(axis=1), same.shape[1], same.argmin(axis=1))


def _repeats(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which windows around a core lie inside a match of ``a`` words ahead and ``b`` behind, as bits:
    bit j stands for the window with j words ahead and MORE - j behind. None where a < 0."""
    j = np.arange(MORE + 1)
    inside = (j <= a[:, None]) & (MORE - j <= b[:, None])
    return (inside * (1 << j)).sum(axis=1)


def _neighbour_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every suffix what its neighbours in the order given tell, in one row: how many words ahead
    and behind they share at most, which windows their matches hold, which of these the row before
    alone holds (``led``), and how far the matches reach. Only the last row of a batch is kept for
    the next."""
    last, carried = None, (-1, -1)

    def told(table: pa.Table, ahead: np.ndarray, behind: np.ndarray) -> pa.RecordBatch:
        """One row for each of ``table`` from what it shares with the row before and the row after."""
        before, after = (ahead[:-1], behind[:-1]), (ahead[1:], behind[1:])
        led = _repeats(*before)
        windows = led | _repeats(*after)
        low, high = np.full(len(table), -1), np.full(len(table), -1)
        for a, b in (before, after):
            match = a + b >= MORE
            low, high = np.where(match, np.maximum(low, b), low), np.where(match, np.maximum(high, a), high)
        place, found = table.column("place").to_numpy().astype(np.int64), windows > 0
        most_ahead, most_behind = np.maximum(*(x[0] for x in (before, after))), np.maximum(*(x[1] for x in (before, after)))
        as_int = lambda x: pa.array(x.astype(np.int32))
        out = pa.table(
            [
                *(table.column(c) for c in ("core", "doc_id", "text_print", "place")), as_int(most_ahead), as_int(most_behind), as_int(windows), as_int(led),
                pa.array(np.where(found, place - low, 0), mask=~found), pa.array(np.where(found, place + CORE + high, 0), mask=~found),
            ],
            names=[c.split()[0] for c in TOLD.split(", ")],
        )
        # neighbours of other cores only: this suffix has no partner here
        return out.filter(pa.array(most_ahead >= 0)).combine_chunks()

    for batch in batches:
        if not len(batch):
            continue
        table = pa.Table.from_batches([batch] if last is None else [last, batch]).combine_chunks()
        held = 0 if last is None else 1
        last = batch.slice(len(batch) - 1)
        columns = {c: table.column(c).to_numpy() for c in ("core", "text_print", "place")}
        words = {c: np.frombuffer(b"".join(table.column(c).to_pylist()), ">u4").reshape(-1, SIDE).astype(np.uint32) for c in ("ahead", "behind")}
        doc, known = table.column("doc_id").combine_chunks(), table.column("doc_id").combine_chunks().is_valid().to_numpy(zero_copy_only=False)
        doc = doc.fill_null(0).to_numpy()
        # the same suffix of a repeated row is no match; the rows between are equal, so it is skipped
        same = (doc[:-1] == doc[1:]) & (known[:-1] == known[1:])
        same &= (columns["text_print"][:-1] == columns["text_print"][1:]) & (columns["place"][:-1] == columns["place"][1:])
        met = (columns["core"][:-1] == columns["core"][1:]) & ~same
        # the pair before the first row is the one carried over; a row without one shares nothing
        first = carried if held else (-1, -1)
        ahead, behind = (
            np.concatenate([[f], np.where(met, _shared(words[c][:-1], words[c][1:]), -1)])
            for f, c in zip(first, ("ahead", "behind"))
        )
        carried = (int(ahead[-1]), int(behind[-1]))
        if len(table) > 1:
            yield from told(table.slice(0, len(table) - 1), ahead, behind).to_batches()
    if last is not None:
        ends = [np.array([c, -1]) for c in carried]
        yield from told(pa.Table.from_batches([last]), *ends).to_batches()


def _together_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For suffixes sorted by core how far those reach that share a window of MIN_WORDS words around it
    with another suffix. A core's suffixes are taken together."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        core = batch.column("core").to_numpy()
        if rest and rest[0].column("core")[0].as_py() == core[-1]:
            rest.append(batch)
            continue
        done = int(np.flatnonzero(core == core[-1])[0])
        yield from _windows_of(pa.Table.from_batches([*rest, batch.slice(0, done)]))
        rest = [batch.slice(done)]
    if rest:
        yield from _windows_of(pa.Table.from_batches(rest))


def _windows_of(table: pa.Table) -> Iterator[pa.RecordBatch]:
    core, prints, place = (table.column(c).to_numpy() for c in ("core", "text_print", "place"))
    ids = table.column("doc_id").combine_chunks()
    known, doc = ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
    # suffixes of a repeated row are one
    order = np.lexsort((place, prints, doc, known, core))
    same = np.ones(max(0, len(order) - 1), bool)
    for column in (core, known, doc, prints, place):
        same &= column[order[1:]] == column[order[:-1]]
    rows = order[np.concatenate([np.ones(min(1, len(order)), bool), ~same])]
    # for each side and number of words a hash of so many words next to the core, and whether the text has them
    sums, there = [], []
    for side, factors in zip(("ahead", "behind"), np.split(_WORD_FACTORS, 2)):
        words = np.frombuffer(b"".join(table.column(side).to_pylist()), ">u4").reshape(-1, SIDE)[rows, :MORE].astype(np.uint64)
        total = np.zeros((len(rows), MORE + 1), np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(arrays.mixed(words) * factors[:MORE], axis=1, out=total[:, 1:])
        sums.append(total)
        there.append((words != 0).sum(axis=1))
    low, high = np.full(len(rows), -1), np.full(len(rows), -1)
    seed = arrays.mixed(core[rows].astype(np.int64).view(np.uint64))
    for j in range(MORE + 1):
        some = np.flatnonzero((there[0] >= j) & (there[1] >= MORE - j))
        with np.errstate(over="ignore"):
            window = arrays.mixed(seed[some] + sums[0][some, j] + sums[1][some, MORE - j])
        by_window = np.argsort(window, kind="stable")
        alike = window[by_window][1:] == window[by_window][:-1]
        again = np.zeros(len(some), bool)
        again[by_window[1:][alike]] = again[by_window[:-1][alike]] = True
        high[some[again]] = j
        low[some[again]] = np.maximum(low[some[again]], MORE - j)
    found = np.flatnonzero(high >= 0)
    if len(found):
        at, picked = place[rows[found]].astype(np.int64), pa.array(rows[found])
        yield pa.RecordBatch.from_arrays(
            [ids.take(picked), pa.array(prints[rows[found]]), pa.array(at - low[found]), pa.array(at + CORE + high[found])],
            names=["doc_id", "text_print", "start_word", "end_word"],
        )


def _by_windows(suffixes: DataFrame, told: DataFrame) -> DataFrame:
    """Spans of the windows of MIN_WORDS words that occur again where no neighbour tells. A suffix
    shares at most as many words ahead with any other as with its neighbours in the first order, and
    behind as with those in the second. A window within both bounds that no match holds is open.

    Of the suffixes that share a window, those that the row before them in the first order shares it
    with need not be looked at: going back from one of them ends at one that must, and never at an
    open suffix, which shares the window with no neighbour. So a passage of very many documents
    gives a few rows. Windows are counted with map-side sums."""
    bits = F.sequence(F.lit(0), F.lit(MORE))
    bit = lambda j: F.call_function("shiftleft", F.lit(1), j)
    bounded = F.aggregate(
        F.filter(bits, lambda j: (j <= F.col("ahead")) & (F.lit(MORE) - j <= F.col("behind"))),
        F.lit(0), lambda mask, j: mask.bitwiseOR(bit(j)),
    )
    one = ["core", "doc_id", "text_print", "place"]
    asked = told.select(*one, bounded.alias("bounded"), "windows", "led").select(
        *one,
        F.col("bounded").bitwiseAND(F.bitwise_not("windows")).alias("open"),
        F.col("bounded").bitwiseAND(F.bitwise_not("led")).alias("looked_at"),
    )
    wanted = staged(asked.filter("open <> 0").groupBy("core").agg(F.bit_or("open").alias("wanted")))
    some = asked.join(wanted, "core").withColumn("looked_at", F.col("looked_at").bitwiseAND(F.col("wanted")))
    some = staged(some.filter("looked_at <> 0").select(F.col("doc_id").alias("d"), "core", "text_print", "place", "looked_at", "open"))
    joined = suffixes.join(some, ["core", "text_print", "place"]).filter(F.col("doc_id").eqNullSafe(F.col("d")))
    rows = joined.withColumn("j", F.explode(F.filter(bits, lambda j: F.col("looked_at").bitwiseAND(bit(j)) != 0))).select(
        "core", "j", "doc_id", "text_print", "place", (F.col("open").bitwiseAND(bit(F.col("j"))) != 0).alias("open"),
        F.xxhash64(F.substring("ahead", F.lit(1), F.col("j") * 4), F.substring("behind", F.lit(1), (F.lit(MORE) - F.col("j")) * 4)).alias("window"),
    )
    rows = staged(rows)
    at = F.struct(F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0)), "text_print", "place")
    keys = ["core", "j", "window"]
    again = rows.groupBy(*keys).agg(F.min(at).alias("low"), F.max(at).alias("high")).filter("low < high").select(*keys)
    return rows.filter("open").join(again, keys).select(
        "doc_id", "text_print", (F.col("place") - MORE + F.col("j")).cast("long").alias("start_word"), (F.col("place") + CORE + F.col("j")).cast("long").alias("end_word")
    )


def _merged_spans(spans: DataFrame) -> DataFrame:
    """Spans of a document that touch or overlap as one."""
    inner = F.sort_array(F.collect_set(F.struct("start_word", "end_word")))
    merge = F.aggregate(
        inner,
        F.array().cast("array<struct<start_word:bigint,end_word:bigint>>"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["end_word"] >= s["start_word"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(F.struct(F.element_at(done, -1)["start_word"].alias("start_word"), F.greatest(F.element_at(done, -1)["end_word"], s["end_word"]).alias("end_word"))),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )
    return spans.groupBy("doc_id", "text_print").agg(merge.alias("spans"))


def repeated_passages(docs: DataFrame) -> DataFrame:
    """doc_id, text_print, spans: for every document with a passage of at least MIN_WORDS words that
    occurs again, in another document or at another place of it, where such passages are (words
    from 0, end not included; touching passages as one).

    Words are runs without white space, compared as they are. Rows equal in doc_id and text are one
    document. A null, empty or short text has no passage; a null doc_id comes back as null and is no
    other document's. Very long texts are read whole, in slices of bounded size. Extra columns are
    ignored."""
    named = docs.select(F.col("doc_id").cast("long"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_print"), F.col("text").cast("string"))
    cores = staged(in_batches(named, _core_rows, "core long, doc_id long, text_print long, places array<int>"))
    twice = cores.groupBy("core").agg(F.sum(F.size("places")).alias("n")).filter("n > 1")
    named_places = F.when(F.col("n") > MOST_TOGETHER, F.transform("places", F.bitwise_not)).otherwise(F.col("places"))
    asked = (
        cores.join(twice, "core").groupBy(F.col("doc_id").alias("d"), F.col("text_print").alias("p"))
        .agg(F.array_distinct(F.flatten(F.collect_list(named_places))).alias("places"))
    )
    same = named.doc_id.eqNullSafe(F.col("d")) & (named.text_print == F.col("p"))
    joined = named.join(asked, same).select("doc_id", "text_print", "text", "places")
    suffixes = staged(in_batches(joined, _suffix_rows, _SUFFIXES))
    together = suffixes.filter("NOT heavy").select("core", "ahead", "behind", "doc_id", "text_print", "place").repartition("core").sortWithinPartitions("core")
    spans = together.mapInArrow(_together_rows, "doc_id long, text_print long, start_word long, end_word long")
    own = suffixes.filter("size(own_start) > 0").select("doc_id", "text_print", F.explode(F.arrays_zip(F.col("own_start").alias("start_word"), F.col("own_end").alias("end_word"))).alias("s"))
    return _merged_spans(spans.union(own.select("doc_id", "text_print", "s.*")).union(_sorted_spans(suffixes.filter("heavy"))))


def _sorted_spans(suffixes: DataFrame) -> DataFrame:
    """Spans of the suffixes of cores that very many have, from two orders of them."""
    by_core = suffixes.select("core", "ahead", "behind", "doc_id", "text_print", "place").repartition("core")
    one = ["doc_id", "text_print", "place"]
    onward = by_core.sortWithinPartitions("core", "ahead", "behind", *one).mapInArrow(_neighbour_rows, TOLD)
    backward = by_core.sortWithinPartitions("core", "behind", "ahead", *one).mapInArrow(_neighbour_rows, TOLD)
    backward = backward.withColumn("led", F.lit(-1))  # all windows: rows before count in the first order only
    # both orders together, and a repeated row's suffixes as one: the bounds hold for all of them
    told = onward.union(backward).groupBy("core", *one).agg(
        F.max("ahead").alias("ahead"), F.max("behind").alias("behind"), F.bit_or("windows").alias("windows"), F.bit_and("led").alias("led"),
        F.min("start_word").alias("start_word"), F.max("end_word").alias("end_word"),
    )
    told = staged(told)
    spans = told.filter("start_word IS NOT NULL").select("doc_id", "text_print", "start_word", "end_word")
    return spans.union(_by_windows(suffixes, told))
