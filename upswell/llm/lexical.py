"""Ranked lexical search: the best documents for each of a set of items, exactly.

Items go in blocks of bounded size. Documents are reduced to the terms of a block's items, with how
often each occurs (tf), and put in the order of the terms' frequency, the rarest first. Within a task
a bounded run of them forms a tree in which documents with the same first terms share a path (paths
without a branch are one node). Each node keeps the largest tf of every term below it and the
smallest m, a document's length factor, so what any document below can score is bounded. An item
walks the tree depth first, the most promising nodes first, and leaves out nodes whose bound is below
its k-th best score so far. A leaf is one document, and its bound is its score."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upswell.llm import arrays
from upswell.llm.frames import in_batches, staged
from upswell.operators.latest import top_per

#: Items of one block, on average; and (document, term) entries of one tree.
ITEMS_PER_BLOCK, TREE_ENTRIES = 512, 1 << 20
#: Nodes whose children are looked at together.
STEP = 32

#: Bytes of terms: ASCII letters and digits, and all of UTF-8 beyond ASCII.
_INSIDE = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


def spans(text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms within rows of UTF-8 bytes: starts, ends, and the terms before each row."""
    inside = np.zeros(len(text) + 1, bool)
    inside[:-1] = _INSIDE[text]
    begins = inside.copy()
    borders = np.zeros(len(text) + 1, bool)
    borders[ends] = True
    begins[1:] &= ~inside[:-1] | borders[1:]
    stops = np.zeros(len(text) + 1, bool)
    stops[1:] = inside[:-1] & (~inside[1:] | borders[1:])
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops), np.searchsorted(starts, ends)


def _terms(text: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> pa.Array:
    """Terms as an Arrow array over the bytes themselves; every other entry is what lies between."""
    offsets = np.empty(2 * len(starts) + 1, np.int64)
    offsets[0] = 0
    offsets[1::2], offsets[2::2] = starts, stops
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(text)])


class Block:
    """The terms of a block of items. ``terms`` are numbered from the rarest on once ``weigh`` knows them."""

    def __init__(self, rows: list[tuple]) -> None:
        self.ids = [item for item, _ in rows]
        column = pa.array([t or "" for _, t in rows], pa.large_string())
        text, ends = arrays.buffers(column)
        starts, stops, counts = spans(text, ends)
        found = _terms(arrays.lowered(text), starts, stops).take(pa.array(np.arange(len(starts)) * 2 + 1))
        self.terms = found.unique()
        self._item = arrays.rows_of(counts)
        self._term = pc.index_in(found, self.terms).to_numpy(zero_copy_only=False).astype(np.int64)

    def weigh(self, df: np.ndarray, n_docs: int) -> None:
        """Weights, order by frequency, and each item's terms with how often it has them."""
        self.place = np.empty(len(df), np.int64)
        self.place[np.argsort(df, kind="stable")] = np.arange(len(df))
        self.weights = np.empty(len(df), np.int64)
        self.weights[self.place] = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()]
        keys, times = np.unique(self._item * max(1, len(df)) + self.place[self._term], return_counts=True)
        cuts = np.searchsorted(keys, np.arange(len(self.ids) + 1) * max(1, len(df)))
        self.items = [(keys[a:b] % max(1, len(df)), times[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]


def restricted(docs: DataFrame, terms: pa.Array) -> DataFrame:
    """doc_id, n (terms of the whole text, with repeats) and, of ``terms``, which occur and how often."""

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for first, last, text, ends in arrays.text_slices(batch.column("text"), 8 << 20):
            starts, stops, counts = spans(text, ends)
            at = pc.index_in(_terms(arrays.lowered(text), starts, stops), terms).to_numpy(zero_copy_only=False)[1::2]
            row = arrays.rows_of(counts)
            known = ~np.isnan(at) if at.dtype.kind == "f" else np.ones(len(at), bool)
            keys, tfs = np.unique(row[known] * max(1, len(terms)) + at[known].astype(np.int64), return_counts=True)
            sizes = np.bincount(keys // max(1, len(terms)), minlength=last - first)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(first, last - first), pa.array(np.diff(counts)),
                    arrays.list_array(keys % max(1, len(terms)), sizes, pa.int32()), arrays.list_array(tfs, sizes, pa.int32()),
                ],
                names=["doc_id", "n", "terms", "tfs"],
            )

    return in_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), step, "doc_id long, n long, terms array<int>, tfs array<int>")


class Tree:
    """Documents' terms (numbered by frequency) as a tree. Nodes stand level by level, so that the
    children of a node are neighbours; leaves are documents."""

    def __init__(self, sizes: np.ndarray, terms: np.ndarray, tfs: np.ndarray, m: np.ndarray, weights: np.ndarray) -> None:
        n_terms = len(weights)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        raw = terms.astype(">u4").tobytes()
        paths = [raw[4 * a : 4 * b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        self.docs = np.array(sorted(range(len(paths)), key=paths.__getitem__), np.int64)
        shared = self._shared(terms, ends)
        # levels: where each node's documents begin and end, and which node above it is
        levels = [(np.array([0]), np.array([len(self.docs)]), np.array([-1]))]
        while True:
            lo, hi, _ = levels[-1]
            inner = np.flatnonzero(hi - lo > 1) if len(levels) > 1 else np.zeros(1, np.int64)
            if not len(inner):
                break
            lengths = (hi - lo)[inner]
            at = np.repeat(lo[inner] - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))
            depth = shared[at].copy()
            heads = np.cumsum(lengths) - lengths
            depth[heads] = np.iinfo(np.int64).max
            splits = depth == np.repeat(np.minimum.reduceat(depth, heads), lengths)
            splits[heads] = True
            begin = np.flatnonzero(splits)
            stop = np.append(begin[1:], len(at))
            levels.append((at[begin], at[stop - 1] + 1, np.repeat(inner, lengths)[begin]))
        sizes_of = np.array([len(lo) for lo, _, _ in levels])
        offset = np.concatenate([[0], np.cumsum(sizes_of)])
        self.lo = np.concatenate([lo for lo, _, _ in levels])
        self.is_leaf = np.concatenate([hi - lo for lo, hi, _ in levels]) == 1
        self.is_leaf[0] = False
        above = np.concatenate([up + (offset[k - 1] if k else 0) for k, (_, _, up) in enumerate(levels)])
        self.child_from = np.searchsorted(above[1:], np.arange(len(above))) + 1
        self.child_to = np.searchsorted(above[1:], np.arange(len(above)), side="right") + 1
        # largest tf of each term and smallest m below every node, from the lowest level up
        self.m = np.zeros(len(above), np.int64)
        leaves = self.docs[self.lo]
        found = []
        below = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        for k in range(len(levels) - 1, -1, -1):
            nodes = np.arange(offset[k], offset[k + 1])
            ends_here = nodes[self.is_leaf[nodes]]
            docs = leaves[ends_here]
            count = sizes[docs]
            pick = np.repeat(ends[docs] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
            keys = np.concatenate([below[0], np.repeat(ends_here, count) * n_terms + terms[pick]])
            most = np.concatenate([below[1], tfs[pick]])
            self.m[ends_here] = m[docs]
            if k < len(levels) - 1:
                inner = nodes[~self.is_leaf[nodes]]
                self.m[inner] = self._least(inner)
            order = np.argsort(keys, kind="stable")
            keys, most = keys[order], most[order]
            head = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
            if len(head):
                keys, most = keys[head], np.maximum.reduceat(most, head)
            found.append((keys, most))
            up = above[keys // n_terms] if k else np.zeros(0, np.int64)
            below = (up * n_terms + keys % n_terms, most) if k else below
        keys, most = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
        node, term = keys // n_terms, keys % n_terms
        order = np.lexsort([node, term])
        self.node, term = node[order], term[order]
        self.value = weights[term] * ((1_000_000_000 * most[order]) // (1000 * most[order] + 12 * self.m[self.node]))
        self.key = term * len(above) + self.node

    def _least(self, inner: np.ndarray) -> np.ndarray:
        """Smallest m among the children of each of these neighbouring nodes."""
        if not len(inner):
            return np.zeros(0, np.int64)
        first, last = self.child_from[inner], self.child_to[inner]
        return np.minimum.reduceat(self.m[first[0] : last[-1]], first - first[0])

    def _shared(self, terms: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How many first terms each document shares with the one before it in order."""
        out = np.zeros(len(self.docs), np.int64)
        a, b = self.docs[:-1], self.docs[1:]
        lengths = np.minimum(np.diff(ends)[a], np.diff(ends)[b]) + 1  # one more, where they differ at the latest
        heads = np.cumsum(lengths) - lengths
        step = np.arange(int(lengths.sum())) - np.repeat(heads, lengths)
        left, right = np.repeat(ends[a], lengths) + step, np.repeat(ends[b], lengths) + step
        padded = np.append(terms, -1)
        differs = (step == np.repeat(lengths - 1, lengths)) | (padded[np.minimum(left, len(terms))] != padded[np.minimum(right, len(terms))])
        if len(heads):
            out[1:] = np.minimum.reduceat(np.where(differs, step, np.iinfo(np.int64).max), heads)
        return out

    def bounds(self, parents: np.ndarray, terms: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Children of these nodes, and what an item can score there at most."""
        first, last = self.child_from[parents], self.child_to[parents]
        lengths = last - first
        shift = first - (np.cumsum(lengths) - lengths)  # from a place among all these children to a node
        children = np.repeat(shift, lengths) + np.arange(int(lengths.sum()))
        base = terms[:, None] * len(self.lo)
        a, b = np.searchsorted(self.key, base + first).ravel(), np.searchsorted(self.key, base + last).ravel()
        count = b - a
        entry = np.repeat(a - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        place = self.node[entry] - np.repeat(np.tile(shift, len(terms)), count)
        out = np.zeros(len(children), np.int64)
        np.add.at(out, place, self.value[entry] * np.repeat(np.repeat(times, len(parents)), count))
        return children, out


class Best:
    """The k best documents of an item so far: higher scores, then smaller ids (null ids last)."""

    def __init__(self, k: int) -> None:
        self.k, self.least = k, 1
        self.scores, self.ids, self.null = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        scores, ids, null = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids]), np.concatenate([self.null, null])
        order = np.lexsort([ids, null, -scores])[: self.k]
        self.scores, self.ids, self.null = scores[order], ids[order], null[order]
        if len(order) == self.k:
            self.least = max(1, int(self.scores[-1]))


def search(tree: Tree, ids: np.ndarray, null: np.ndarray, terms: np.ndarray, times: np.ndarray, best: Best) -> int:
    """Walks the tree for one item, depth first; the number of nodes whose bound was worked out."""
    seen = 0
    stack = [(np.array([0]), np.array([np.iinfo(np.int64).max]))]
    while stack:
        nodes, bound = stack.pop()
        nodes = nodes[bound >= best.least]
        if not len(nodes):
            continue
        children, reach = tree.bounds(nodes, terms, times)
        seen += len(children)
        good = reach >= best.least
        children, reach = children[good], reach[good]
        leaf = tree.is_leaf[children]
        if leaf.any():
            docs = tree.docs[tree.lo[children[leaf]]]
            best.add(reach[leaf], ids[docs], null[docs])
        children, reach = children[~leaf], reach[~leaf]
        order = np.argsort(reach, kind="stable")
        children, reach = children[order], reach[order]
        # the best on top; the first step is short, so that it sets a mark early
        cuts = [*range(0, max(0, len(children) - 4), STEP), max(0, len(children) - 4), len(children)]
        stack += [(children[a:b], reach[a:b]) for a, b in zip(cuts[:-1], cuts[1:]) if b > a]
    return seen


def _best_in_tasks(vectors: DataFrame, block: Block, n_docs: int, n_terms: int, k: int, kind: str) -> DataFrame:
    """(item, doc_id, score) of each item's k best documents of every task."""
    place, weights, items, item_ids, most = block.place, block.weights, block.items, block.ids, TREE_ENTRIES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in items]
        held: list[pa.RecordBatch] = []
        entries = 0

        def look() -> None:
            table = pa.Table.from_batches(held)
            held.clear()
            sizes = table.column("n_terms").to_numpy().astype(np.int64)
            flat = lambda c: np.concatenate([x.flatten().to_numpy(zero_copy_only=False) for x in table.column(c).chunks]).astype(np.int64)
            terms, tfs = place[flat("terms")], flat("tfs")
            order = np.lexsort([terms, np.repeat(np.arange(len(sizes)), sizes)])
            null = table.column("doc_id").is_null().to_numpy()
            ids = table.column("doc_id").fill_null(0).to_numpy()
            m = 75 + (25 * table.column("n").to_numpy() * n_docs) // n_terms
            tree = Tree(sizes, terms[order], tfs[order], m, weights)
            for (own, times), kept in zip(items, best):
                if len(own):
                    search(tree, ids, null, own, times, kept)

        for batch in batches:
            for first in range(0, len(batch), 1024):
                part = batch.slice(first, 1024)
                held.append(part)
                entries += pc.sum(part.column("n_terms")).as_py()
                if entries >= most:
                    look()
                    entries = 0
        if held:
            look()
        for item, kept in zip(item_ids, best):
            if len(kept.ids):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(kept.ids)).cast(arrow_kind) if item is not None else pa.nulls(len(kept.ids), arrow_kind), pa.array(kept.ids, mask=kept.null), pa.array(kept.scores)],
                    names=["item_id", "doc_id", "score"],
                )

    arrow_kind = pa.string() if kind == "string" else pa.int64() if kind == "bigint" else pa.int32()
    some = vectors.select("doc_id", "n", "terms", "tfs", F.size("terms").alias("n_terms")).filter("n_terms > 0")
    return some.mapInArrow(run, f"item_id {kind}, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score): for every item its ``k`` documents with the highest score above
    0, ties by doc_id, null doc_ids last among equals; each row of ``docs`` is a document.

    Terms are maximal runs of ASCII letters and digits and of anything beyond ASCII, A-Z in lower case.
    The score is a BM25 in whole numbers: for an item's term with weight w = floor(1000 ln((2N + 2) /
    (2 df + 1))), each time the item has it, w * (10**9 tf div (1000 tf + 12 m)), with m = 75 + (25 n N)
    div L. N counts the documents with a term, L all their terms, n a document's terms.

    Rows of ``items`` with one item_id are one item, with the terms of all its different texts; an item
    without terms has no row, and neither has one no document answers. Null and empty texts have no
    terms, very long ones are read whole, other columns are ignored. Item ids are strings, longs or ints."""
    kind = dict(items.dtypes)["item_id"]
    asked = staged(items.select("item_id", F.col("text").cast("string")).groupBy("item_id").agg(F.array_sort(F.collect_set("text")).alias("texts")))
    blocks = max(1, math.ceil(asked.count() / ITEMS_PER_BLOCK))
    number = F.pmod(F.xxhash64(F.col("item_id").cast("string")), F.lit(blocks))
    out, totals = None, None
    for b in range(blocks):
        rows = asked.filter(number == b).select("item_id", F.array_join("texts", " ").alias("text")).orderBy("item_id").collect()
        block = Block([tuple(r) for r in rows])
        vectors = staged(restricted(docs, block.terms))
        if totals is None:
            totals = vectors.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        if not len(block.terms) or not totals.docs:
            found = vectors.sparkSession.createDataFrame([], f"item_id {kind}, doc_id long, score long")
        else:
            df = np.zeros(len(block.terms), np.int64)
            for r in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # a row for each term of the block
                df[r["t"]] = r["count"]
            block.weigh(df, totals.docs)
            found = _best_in_tasks(vectors, block, totals.docs, totals.terms, k, kind)
        out = found if out is None else out.unionByName(found)
    best_first = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    return top_per(out, ["item_id"], best_first, k, "rank").select("item_id", "rank", "doc_id", "score")
