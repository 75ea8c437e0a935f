"""Name similarity at scale: token-sorted likeness, 0-100, twice the longest common subsequence
over the two lengths.

Names are dealt into blocks, by class of length where a cutoff tells which lengths can meet, and a
task compares one block with another. Two names have at most as many letters in order in common as
they have letters in common, so a table of letter counts settles nearly all pairs, a few numpy steps
for millions of them; only what is left is aligned, many pairs in lockstep, one machine word each.
Nothing above the cutoff is missed, and a task holds two blocks however many names there are."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from upswell import settings
from upswell.operators.latest import one_per, top_per
from upswell.staging import spread, staged


def lcs_length(a: str, b: str) -> int:
    """Longest common subsequence, one machine word of column bits per character of ``b``."""
    places: dict[str, int] = {}
    for i, ch in enumerate(a):
        places[ch] = places.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hits = row & places.get(ch, 0)
        row = ((row + hits) | (row - hits)) & full
    return (full ^ row).bit_count()


LOCKSTEP = 4096  # pairs handled together


def _codes(texts: list[str], width: int, blank: int) -> np.ndarray:
    """Code points of short texts, one row each, filled up with a number that is none."""
    lengths = np.array([len(t) for t in texts])
    out = np.full((len(texts), width), blank, np.uint32)
    column = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[np.repeat(np.arange(len(texts)), lengths), column] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    return out


def lcs_lengths(left: list[str], right: list[str]) -> np.ndarray:
    """Longest common subsequences of many pairs in lockstep. The columns of a pair are the bits of
    one machine word, for the shorter text of up to 64 characters; a step takes the next character
    of every longer text. Pairs of like lengths go together; two longer texts go one by one."""
    short = [a if len(a) <= len(b) else b for a, b in zip(left, right)]
    long = [b if len(a) <= len(b) else a for a, b in zip(left, right)]
    sizes = np.array([[len(a), len(b)] for a, b in zip(short, long)]).reshape(-1, 2)
    words = np.searchsorted([16, 32, 64], sizes[:, 0])
    out = np.zeros(len(short), np.int64)
    order = np.lexsort([sizes[:, 1], words])
    for word, bits in enumerate((16, 32, 64)):
        own = order[words[order] == word]
        for first in range(0, len(own), LOCKSTEP):
            rows = own[first : first + LOCKSTEP]
            a = _codes([short[i] for i in rows], bits, 0xFFFFFFFE)
            b = _codes([long[i] for i in rows], int(sizes[rows, 1].max()), 0xFFFFFFFF)
            full = np.left_shift(np.uint64(1), sizes[rows, 0].astype(np.uint64) % np.uint64(64)) - np.uint64(1)
            full[sizes[rows, 0] == 64] = np.uint64(2**64 - 1)
            row = full.copy()
            for ch in b.T:
                hits = np.packbits(a == ch[:, None], axis=1, bitorder="little").view(f"<u{bits // 8}")[:, 0] & row
                row = (row + hits) | (row - hits)  # bits above the text's may change; they count for nothing
            out[rows] = np.bitwise_count(full & ~row)
    for i in np.flatnonzero(words == 3):
        out[i] = lcs_length(short[i], long[i])
    return out


def likeness(a: str | None, b: str | None) -> float | None:
    if a is None or b is None:
        return None
    total = len(a) + len(b)
    return 100.0 if total == 0 else 200.0 * lcs_length(a, b) / total


@pandas_udf(DoubleType())
def likeness_of(left: pd.Series, right: pd.Series) -> pd.Series:
    a, b = left.fillna("").tolist(), right.fillna("").tolist()
    total = np.array([len(x) + len(y) for x, y in zip(a, b)], np.float64)
    with np.errstate(invalid="ignore", divide="ignore"):
        score = np.where(total == 0, 100.0, 200.0 * lcs_lengths(a, b) / total)
    return pd.Series(np.where(left.isna() | right.isna(), np.nan, score))


def sorted_tokens(form: Column) -> Column:
    """Word order does not count: compare names with their words sorted."""
    return F.array_join(F.array_sort(F.split(form, " ")), " ")


def lost_share(q: int, cutoff: float) -> float:
    """Most ``q``-letter groups a name can miss in a partner, as a share of its length. Deleting
    a letter breaks up to q groups and inserting one q - 1; the partner may be shorter by the
    ratio below, or longer by its inverse, and still reach the cutoff."""
    r = 1 - cutoff / 100
    shortest = (1 - r) / (1 + r)
    own, other = (q - 0.5) * r + 0.5, (q - 0.5) * r - 0.5
    return own + other * (shortest if other < 0 else 1 / shortest)


def shortest_text(q: int, cutoff: float) -> int:
    """From this length on, partners that reach the cutoff are sure to share a group."""
    share = lost_share(q, cutoff)
    if share >= 1:
        raise ValueError(f"a cutoff of {cutoff} is too low for {q}-letter groups")
    enough = int(q / (1 - share)) + 1
    while enough > q and enough - q > math.floor((enough - 1) * share):
        enough -= 1
    return enough


HOT_GROUP = 1 << 14  # texts a block holds on average; what exceeds it is dealt over several
LONG = 64  # a block of longer texts holds fewer, as if each were cut into pieces of this length
BINS = 24  # letters are counted in so many bins, the most frequent ones apart
CELL = 1 << 18  # pairs of texts whose common letters are counted at once
PAIRS, LETTERS = 1 << 16, 1 << 24  # pairs aligned at once, and letters of them
MASKS = 1 << 22  # letter masks held at once
FIRST_LOOK = 4  # times as many as asked for are aligned before the mark is set


class _Spelled:
    """Two lists of texts as numbers: letters by frequency, in rows filled up with a number that is
    none, and how many letters fall in each bin."""

    def __init__(self, left: list[str], right: list[str]) -> None:
        flat = [np.frombuffer("".join(t).encode("utf-32-le", "surrogatepass"), "<u4") for t in (left, right)]
        seen = np.bincount(np.concatenate([*flat, np.zeros(1, "<u4")]))
        place = np.empty(len(seen), np.int64)
        place[np.argsort(-seen, kind="stable")] = np.arange(len(seen))
        self.alphabet = int((seen > 0).sum())
        self.texts = (left, right)
        self.sizes = tuple(np.array([len(t) for t in texts], np.int64) for texts in (left, right))
        self.longest = max((int(s.max(initial=0)) for s in self.sizes), default=0)
        self.narrow = 2 * self.longest < 256  # sums of counts then fit in a byte
        self.letters, self.bags = [], []
        for codes, sizes in zip(flat, self.sizes):
            rows, ids = np.repeat(np.arange(len(sizes)), sizes), place[codes]
            table = np.full((len(sizes), int(sizes.max(initial=0))), self.alphabet, np.uint16 if self.alphabet < 65535 else np.int32)
            table[rows, np.arange(len(ids)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = ids
            counts = np.bincount(rows * BINS + ids % BINS, minlength=len(sizes) * BINS).reshape(-1, BINS)
            self.letters.append(table)
            self.bags.append(counts.astype(np.uint8 if self.narrow else np.int32))
        self.columns = np.ascontiguousarray(self.bags[1].T)

    def in_common(self, first: int, last: int) -> np.ndarray:
        """Letters that texts ``first`` to ``last`` of the left share with every right text, whatever
        their order: at least as many as they share in order."""
        rows = self.bags[0][first:last]
        total = np.minimum(rows[:, 0, None], self.columns[0][None, :])
        step = np.empty_like(total)
        for k in range(1, BINS):
            np.minimum(rows[:, k, None], self.columns[k][None, :], out=step)
            np.add(total, step, out=total)
        return total

    def aligned(self, i: np.ndarray, j: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Longest common subsequences of left texts ``i`` and right texts ``j``; for a pair that
        has less than ``least`` any smaller number may come."""
        out = np.zeros(len(i), np.int64)
        many = max(1, min(PAIRS, LETTERS // max(1, self.longest)))
        for first in range(0, len(i), many):
            part = slice(first, first + many)
            out[part] = self._aligned(i[part], j[part], least[part])
        return out

    def _aligned(self, i: np.ndarray, j: np.ndarray, least: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i), np.int64)
        fits = self.sizes[0][i] <= 64
        other = ~fits & (self.sizes[1][j] <= 64)
        for side, some in ((0, np.flatnonzero(fits)), (1, np.flatnonzero(other))):
            own, theirs = (i[some], j[some]) if side == 0 else (j[some], i[some])
            some = some[order := np.argsort(own, kind="stable")]
            own, theirs = own[order], theirs[order]
            texts, at = np.unique(own, return_inverse=True)
            group = at // max(1, MASKS // (self.alphabet + 1))
            cuts = np.searchsorted(group, np.arange(int(group.max(initial=-1)) + 2))
            for x, y in zip(cuts[:-1], cuts[1:]):
                low = at[x]
                out[some[x:y]] = self._lockstep(side, texts[low : at[y - 1] + 1], at[x:y] - low, theirs[x:y], least[some[x:y]])
        for k in np.flatnonzero(~fits & ~other):
            out[k] = lcs_length(self.texts[0][i[k]], self.texts[1][j[k]])
        return out

    def _lockstep(self, side: int, texts: np.ndarray, at: np.ndarray, theirs: np.ndarray, least: np.ndarray) -> np.ndarray:
        """One machine word for each pair, a bit for each letter of the text of ``side``; a step takes
        the next letter of every other text. Pairs that can no longer reach ``least`` drop out."""
        width, sizes = self.alphabet + 1, self.sizes[1 - side][theirs]
        masks = np.zeros((len(texts), width), np.uint64)
        for k, letters in enumerate(self.letters[side][texts][:, :64].T):
            masks[np.arange(len(texts)), letters] |= np.uint64(1 << k)
        masks[:, -1] = 0
        flat, base = masks.ravel(), at * width
        steps = np.ascontiguousarray(self.letters[1 - side][theirs].T)
        out, alive = np.zeros(len(at), np.int64), np.arange(len(at))
        row = np.full(len(at), np.uint64(2**64 - 1))
        for k in range(int(sizes.max(initial=0))):
            hits = row & flat[base + steps[k]]
            row = (row + hits) | (row - hits)
            if k % 8 == 7:
                far = np.bitwise_count(~row) + np.maximum(sizes - k - 1, 0) >= least
                if far.sum() < 0.8 * len(far):
                    alive, row, base, sizes, least, steps = alive[far], row[far], base[far], sizes[far], least[far], steps[:, far]
        out[alive] = np.bitwise_count(~row)
        return out


def _pieces(texts: DataFrame, block: int) -> DataFrame:
    """Blocks each class of length is dealt over."""
    most = F.greatest(F.count("*"), F.sum(F.length("text")) / LONG)
    return texts.groupBy("kind").agg(F.ceil(most / block).cast("int").alias("pieces"))


def _cells(left: DataFrame, right: DataFrame, near: int, block: int = 1):
    """Both with a ``kind``, grouped by cell: every block of the left meets every block of the right
    whose kind differs by ``near`` at most. Blocks of the left hold ``block`` times fewer texts."""
    own, other = _pieces(left, max(1, HOT_GROUP // block)), _pieces(right, HOT_GROUP)

    def dealt(texts: DataFrame, mine: DataFrame, theirs: DataFrame, names: list[str]) -> DataFrame:
        # A row for each length class: few, whatever the texts.
        meets = theirs.select(F.explode(F.sequence(F.col("kind") - near, F.col("kind") + near)).alias("kind"), F.struct("kind", "pieces").alias("met"))
        rows = texts.join(F.broadcast(mine), "kind").withColumn("piece", F.pmod(F.xxhash64("text"), "pieces").cast("int")).drop("pieces")
        rows = rows.join(F.broadcast(meets), "kind").withColumn("met_piece", F.explode(F.sequence(F.lit(0), F.col("met.pieces") - 1)))
        rows = rows.select(*[F.col(c).alias(n) for c, n in zip(("kind", "piece", "met.kind", "met_piece"), names)], *[c for c in texts.columns if c != "kind"])
        return spread(rows, *names)

    a, b = ["lk", "lp", "rk", "rp"], ["lk2", "lp2", "rk2", "rp2"]
    return dealt(left, own, other, a).groupBy(*a).cogroup(dealt(right, other, own, [b[2], b[3], b[0], b[1]]).groupBy(*b))


def _reaching(left: list[str], right: list[str], cutoff: float, best: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and scores of all pairs that score at least ``cutoff``, or of each left text's best,
    the first of equals."""
    both, ll, lr = _Spelled(left, right), len(left), len(right)
    sizes = both.sizes
    least = np.ceil(np.arange(2 * both.longest + 1) * (cutoff / 200) - 1e-9)
    kinds, kind = np.unique(sizes[0], return_inverse=True)
    needs = least[kinds[:, None] + sizes[1][None, :]].astype(np.uint8 if both.narrow else np.int32)
    found, waiting, held = [], [], 0

    def settle() -> None:
        i, j = (np.concatenate(x) for x in zip(*waiting))
        total = sizes[0][i] + sizes[1][j]
        common = both.aligned(i, j, least[total])
        with np.errstate(invalid="ignore", divide="ignore"):
            score = 200.0 * common / total
        good = np.flatnonzero(score >= cutoff)
        if best:
            good = good[np.lexsort([j[good], -score[good], i[good]])]
            good = good[np.flatnonzero(np.diff(i[good], prepend=-1))]
        found.append((i[good], j[good], score[good]))

    step = max(1, CELL // max(1, lr))
    for first in range(0, ll, step):
        last = min(ll, first + step)
        near = np.flatnonzero((both.in_common(first, last) >= needs[kind[first:last]]).ravel())
        waiting.append((first + near // lr, near % lr))
        held += len(near)
        if held >= PAIRS or last == ll:
            settle()
            waiting, held = [], 0
    return tuple(np.concatenate(x) for x in zip(*found))


def _compared(left: DataFrame, right: DataFrame, cutoff: float, best: bool) -> DataFrame:
    """``left_text``, ``right_text``, ``score`` of the pairs that reach ``cutoff``, from all cells."""
    # Lengths of two that reach the cutoff differ by this ratio at most, so by one class at most.
    ratio = max((2 - cutoff / 100) / (cutoff / 100), 1.05) * 1.001
    kind = F.floor(F.log(F.length("text")) / math.log(ratio)).cast("int")
    left = staged(left.select("text").filter("text <> ''").withColumn("kind", kind))
    right = staged(right.select("text", *(["label"] if best else [])).filter("text <> ''").withColumn("kind", kind))

    def pairs(a: pa.Table, b: pa.Table) -> pa.Table:
        i = j = np.zeros(0, np.int64)
        score = np.zeros(0)
        if len(a) and len(b):
            if best:
                b = b.take(pc.sort_indices(b, sort_keys=[("label", "ascending")], null_placement="at_start"))
            i, j, score = _reaching(a.column("text").to_pylist(), b.column("text").to_pylist(), cutoff, best)
        return pa.table([a.column("text").take(pa.array(i)), b.column("text").take(pa.array(j)), pa.array(score)], names=["left_text", "right_text", "score"])

    return _cells(left, right, 1).applyInArrow(pairs, "left_text string, right_text string, score double")


def similar_texts(
    left: DataFrame, right: DataFrame, cutoff: float = settings.REVIEW_THRESHOLD
) -> DataFrame:
    """All (left text, right text) pairs that score at least ``cutoff``: columns ``left_text``,
    ``right_text``, ``score``. Inputs have one distinct ``text`` column; empty texts match nothing."""
    shortest_text(3, cutoff)  # refuses what is too low to be told from chance
    if shortest_text(2, cutoff) > 3:
        raise ValueError(f"a cutoff of {cutoff} is too low to find short names by letter pairs")
    return _compared(left, right, cutoff, False)


def most_similar(left: DataFrame, right: DataFrame, cutoff: float = settings.REVIEW_THRESHOLD) -> DataFrame:
    """For each left ``text`` the right ``text`` that scores highest, and at least ``cutoff``: columns
    as in :func:`similar_texts`. Equal scores go to the smaller ``label``, a column of the right.
    No block sends on more than one row for a left text, however many are alike."""
    found = _compared(left, right, cutoff, True).join(right.select(F.col("text").alias("right_text"), "label"), "right_text")
    return one_per(found, ["left_text"], [F.col("score").desc(), F.col("label"), F.col("right_text")]).select("left_text", "right_text", "score")


def _nearest(asked: list[str], entries: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of each asked text and its ``n`` best entries, the first of equals.

    Entries that share most letters are aligned first; the n-th best sets the mark, and only those
    whose letters reach it are aligned too."""
    both, count = _Spelled(asked, entries), len(entries)
    found = []
    step = max(1, CELL // max(1, count))
    for first in range(0, len(asked), step):
        last = min(len(asked), first + step)
        total = (both.sizes[0][first:last, None] + both.sizes[1][None, :]).astype(np.float32)
        bound = both.in_common(first, last).astype(np.float32)
        none = bound == 0
        with np.errstate(invalid="ignore", divide="ignore"):
            bound = np.where(total == 0, np.float32(100), 200 * bound / total)

        def scores(i: np.ndarray, j: np.ndarray, mark: np.ndarray) -> np.ndarray:
            sizes = both.sizes[0][first + i] + both.sizes[1][j]
            common = both.aligned(first + i, j, np.ceil(mark * sizes / 200 - 1e-6))
            return np.where(sizes == 0, 100.0, 200.0 * common / np.maximum(sizes, 1))

        some = min(count, FIRST_LOOK * n)
        tops = np.argpartition(bound, count - some, axis=1)[:, count - some :] if some < count else np.tile(np.arange(count), (last - first, 1))
        i, j = np.repeat(np.arange(last - first), some), tops.ravel()
        score = scores(i, j, np.zeros(len(i)))
        mark = np.sort(score.reshape(-1, some), axis=1)[:, -n] if some >= n else np.zeros(last - first)
        # What shares no letter scores 0; only the first of those can count.
        reach = (bound >= (mark - 1e-3)[:, None].astype(np.float32)) & (~none | (total == 0))
        reach[i, j] = False
        more_i, more_j = np.nonzero(reach)
        blank = [(np.full(len(k), r), k) for r in np.flatnonzero(mark <= 0) for k in [np.flatnonzero(none[r] & (total[r] > 0))[:n]]]
        zero_i, zero_j = (np.concatenate(x) for x in zip(*blank)) if blank else (np.zeros(0, np.int64),) * 2
        i, j, score = np.concatenate([i, more_i, zero_i]), np.concatenate([j, more_j, zero_j]), np.concatenate([score, scores(more_i, more_j, mark[more_i]), np.zeros(len(zero_i))])
        order = np.lexsort([j, -score, i])
        i, j = i[order], j[order]
        fresh = np.flatnonzero((np.diff(i, prepend=-1) != 0) | (np.diff(j, prepend=-1) != 0))
        i, j = i[fresh], j[fresh]
        heads = np.flatnonzero(np.diff(i, prepend=-1))
        best = np.arange(len(i)) - np.repeat(heads, np.diff(np.append(heads, len(i)))) < n
        found.append((first + i[best], j[best]))
    return tuple(np.concatenate(x) for x in zip(*found))


def closest(asked: DataFrame, entries: DataFrame, n: int = 4) -> DataFrame:
    """The ``n`` of ``entries`` (text, label) most alike to every asked ``text``, exactly and without a
    cutoff: columns ``asked``, ``text``, ``label``, ``score``, ``place``; equal scores by label.

    Every block of asked texts meets every block of entries, and sends on its ``n`` best for each
    asked text (:func:`_nearest`). Any number of texts may be asked for."""
    # Very long texts stand in blocks of their own, as a block's rows are filled up to its longest.
    size = F.length("text")
    kind = F.when(size <= 4 * LONG, 0).otherwise(F.floor(F.log2(size / (2 * LONG)))).cast("int")
    asked = staged(asked.select("text").filter("text IS NOT NULL").distinct().withColumn("kind", kind))
    entries = staged(entries.select("text", "label").filter("text IS NOT NULL").distinct().withColumn("kind", kind))
    label = entries.schema["label"].dataType.simpleString()

    def page(a: pa.Table, b: pa.Table) -> pa.Table:
        i = j = np.zeros(0, np.int64)
        if len(a) and len(b):
            b = b.take(pc.sort_indices(b, sort_keys=[("label", "ascending"), ("text", "ascending")], null_placement="at_start"))
            i, j = _nearest(a.column("text").to_pylist(), b.column("text").to_pylist(), n)
        b = b.take(pa.array(j))
        return pa.table([a.column("text").take(pa.array(i)), b.column("text"), b.column("label")], names=["asked", "text", "label"])

    found = _cells(asked, entries, 32, 4).applyInArrow(page, f"asked string, text string, label {label}")
    scored = found.withColumn("score", likeness_of("asked", "text"))
    return top_per(scored, ["asked"], [F.col("score").desc(), F.col("label"), F.col("text")], n, "place").select("asked", "text", "label", "score", "place")
