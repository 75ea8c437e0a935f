"""Documents in sequences of a fixed number of tokens, by hierarchical best fit.

A text's ids and an end id are one piece, or, if longer than a sequence, several whole sequences
after a shorter first piece. Pieces are dealt to tasks of bounded size. Each task puts the longest
pieces first, each into the open sequence with the least room that holds it. Sequences that are
nearly full are final; of the others, those with the most room go up a tree, where best fit joins
them as items with those of other tasks, until one group is left.

After best fit at most one sequence of a task is at most half full, and what fits anywhere fits the
one with the most room, so a bounded number of each task's sequences goes up and nothing is lost."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from upswell.llm import arrays
from upswell.llm.bpe import RUN_BYTES, model
from upswell.llm.frames import in_batches, staged

CAPACITY = 2048
#: Pieces a task packs at once, pieces a task gets at most, and sequences of it that go up.
BLOCK, MOST_IN_TASK, GOING_UP = 1 << 14, 1 << 20, 64
#: Groups joined in one step up the tree.
FAN_IN = 16
#: A sequence with at most this share of its room left is nearly full.
NEARLY_FULL = 1 / 64


def cut(counts: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, number, start and length of every piece of texts of so many tokens (one at least)."""
    whole, rest = counts // capacity, counts % capacity
    pieces = whole + (rest > 0)
    row = np.repeat(np.arange(len(counts)), pieces)
    number = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = np.where(rest > 0, rest, capacity)[row]
    return row, number, np.where(number == 0, 0, first + (number - 1) * capacity), np.where(number == 0, first, capacity)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, ids of every piece of every text.

    A null or empty text is the end id alone. A text longer than ``capacity`` is cut so that only its
    first piece may be shorter; very long texts give many pieces. Null and repeated doc_ids are kept
    as they are, other columns are left out, an empty table gives none."""

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        bpe = model(tokenizer)
        for first, last, texts in arrays.string_slices(batch.column("text"), RUN_BYTES):
            ids, counts = bpe.encoded(texts)
            ids = np.insert(ids, np.cumsum(counts), end_id)
            row, number, start, length = cut(counts + 1, capacity)
            raw = memoryview(ids.astype("<u4").tobytes())
            begin = np.cumsum(length) - length  # pieces stand one after the other
            sums = [zlib.crc32(raw[a:b]) for a, b in zip((4 * begin).tolist(), (4 * (begin + length)).tolist())]
            doc = batch.column("doc_id").slice(first, last - first).take(pa.array(row))
            columns = [doc, pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(sums, pa.int64())]
            if with_ids:
                columns.append(arrays.list_array(ids, length, pa.int32()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    schema = T._parse_datatype_string("doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids)
    return in_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), step, schema)


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and place of every item, and the fill of every bin: largest first, each into the open bin
    with the least room that holds it."""
    bins, places, fills = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), []
    with_room: dict[int, list[int]] = {}
    rooms = 0  # bit r is set when an open bin has room for r
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = with_room[room].pop()
            if not with_room[room]:
                rooms ^= 1 << room
        else:
            room, b = capacity, len(fills)
            fills.append(0)
        bins[i], places[i] = b, capacity - room
        fills[b] += size
        left = room - size
        if left:
            with_room.setdefault(left, []).append(b)
            rooms |= 1 << left
    return bins, places, np.array(fills, np.int64)


def rises(fills: np.ndarray, capacity: int) -> np.ndarray:
    """Which bins go up: those not nearly full, the ones with the most room."""
    out = np.zeros(len(fills), bool)
    emptiest = np.argsort(fills, kind="stable")[:GOING_UP]
    out[emptiest] = fills[emptiest] < capacity * (1 - NEARLY_FULL)
    return out


def packed(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``items`` (a table with a ``length`` of 1 to ``capacity``) with ``sequence_id`` and ``offset``,
    without gaps or overlaps. Other columns may have any name but those two; rows may be repeated;
    an empty table stays one. A length that is null, below 1 or above ``capacity`` ends the job."""
    items = staged(items)
    spark, n = items.sparkSession, items.count()
    tasks = min(max(1, math.ceil(n / BLOCK)), int(spark.conf.get("spark.sql.shuffle.partitions")))
    tasks = max(tasks, math.ceil(n / MOST_IN_TASK))

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []

        def block() -> Iterator[pa.RecordBatch]:
            nonlocal made
            sizes = pa.chunked_array([b.column("length") for b in held]).to_numpy()
            if len(sizes) == 0:
                return
            if not ((sizes >= 1) & (sizes <= capacity)).all():
                raise ValueError(f"lengths must be between 1 and {capacity}")
            sizes = sizes.astype(np.int64)
            bins, places, fills = best_fit(sizes, capacity)
            up = (places == 0) & rises(fills, capacity)[bins]
            ids = (task << 32) + made + bins
            made += len(fills)
            first = 0
            for b in held:
                part = slice(first, first + len(b))
                first += len(b)
                new = [pa.array(ids[part]), pa.array(places[part]), pa.array(fills[bins[part]], mask=~up[part])]
                yield pa.RecordBatch.from_arrays([*b.columns, *new], names=[*b.schema.names, "sequence_id", "offset", "__rising"])
            held.clear()

        for batch in batches:
            for first in range(0, len(batch), BLOCK):
                part = batch.slice(first, BLOCK)
                if held and sum(map(len, held)) + len(part) > 2 * BLOCK:
                    yield from block()
                held.append(part)
        if held:
            yield from block()

    more = [T.StructField(c, T.LongType()) for c in ("sequence_id", "offset", "__rising")]
    placed = staged(items.repartition(tasks).mapInArrow(local, T.StructType([*items.schema.fields, *more])))
    moves = _joined_bins(placed.filter("__rising IS NOT NULL").select("sequence_id", F.col("__rising").alias("fill")), tasks, capacity)
    placed = placed.drop("__rising")
    if moves is None:
        return placed
    return placed.join(moves, F.col("sequence_id") == F.col("__bin"), "left").select(
        *[F.col(c) for c in items.columns],
        F.coalesce("__to", "sequence_id").alias("sequence_id"),
        (F.col("offset") + F.coalesce("__shift", F.lit(0))).alias("offset"),
    )


_MERGED = "grp long, fill long, members array<struct<bin:long,shift:long>>, rising boolean"


def _joined_bins(rising: DataFrame, tasks: int, capacity: int) -> DataFrame | None:
    """(__bin, __to, __shift) of every bin that was put into another, from the bins that go up."""

    def merge(table: pa.Table) -> pa.Table:
        group, members = table.column("grp")[0], table.column("members").to_pylist()
        sizes = table.column("fill").to_numpy().astype(np.int64)
        order = np.lexsort([np.array([m[0]["bin"] for m in members]), sizes])  # the same whatever the order of rows
        bins, places, fills = best_fit(sizes[order], capacity)
        joined: list[list[dict]] = [[] for _ in fills]
        for i, b, at in zip(order.tolist(), bins.tolist(), places.tolist()):
            joined[b] += [{"bin": m["bin"], "shift": m["shift"] + at} for m in members[i]]
        # the bin at the start gives the sequence its id
        joined = [sorted(j, key=lambda m: m["shift"]) for j in joined]
        return pa.table([pa.array([group.as_py()] * len(fills), pa.int64()), pa.array(fills), pa.array(joined, _MEMBERS), pa.array(rises(fills, capacity))], names=["grp", "fill", "members", "rising"])

    one = F.array(F.struct(F.col("sequence_id").alias("bin"), F.lit(0).cast("long").alias("shift")))
    open_bins = rising.select(F.shiftright("sequence_id", 32).alias("grp"), "fill", one.alias("members"))
    done, groups = None, tasks
    while True:
        groups = math.ceil(groups / FAN_IN)
        step = staged(open_bins.withColumn("grp", F.floor(F.col("grp") / FAN_IN).cast("long")).groupBy("grp").applyInArrow(merge, _MERGED))
        final = step.filter(F.col("rising") & F.lit(groups <= 1) | ~F.col("rising")).filter(F.size("members") > 1).select("members")
        done = final if done is None else done.unionByName(final)
        if groups <= 1:
            break
        open_bins = step.filter("rising").select("grp", "fill", "members")
    return done.select(F.col("members")[0]["bin"].alias("__to"), F.explode("members").alias("m")).select(
        F.col("m.bin").alias("__bin"), "__to", F.col("m.shift").alias("__shift")
    )


_MEMBERS = pa.list_(pa.struct([("bin", pa.int64()), ("shift", pa.int64())]))


def sequences(placed: DataFrame) -> DataFrame:
    """sequence_id and ids of every sequence, its pieces' ids in their places."""
    parts = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"))
