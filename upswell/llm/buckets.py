"""Confirmed links among rows that share a bucket, without pairing all of a bucket."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upswell.llm.frames import components, staged

#: About so many rows of a bucket, and so many of those outside its largest component, meet in one task.
MOST_TOGETHER = 4096
#: Buckets up to this size can be compared many at once.
SMALL = 64


def bucket_links(
    rows: DataFrame,
    facts: Sequence[str],
    picks: Sequence[Column],
    may_link: Callable[[str, str], Column],
    others: Callable[[DataFrame], DataFrame],
    confirmed: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Links (a, b) that connect all ids any chain of confirmed bucket pairs connects.

    ``rows`` have key, id and the columns ``facts`` (id among them); ``may_link`` tests two aliases
    of rows, ``confirmed`` gives the pairs (a, b) that are links. A bucket's members are first
    compared with a few hubs of it, one by each of ``picks``; buckets that are one component then
    need no more pairs. For the rows (with component) of other buckets ``others`` gives the pairs
    of one bucket in different components that may be links. So a group of g copies costs about g
    comparisons, and nothing is left out: two ids that meet in a bucket are compared, or already
    connected."""
    hubs = rows.groupBy("key").agg(F.array_distinct(F.array(*(F.min_by(F.struct(*facts), p) for p in picks))).alias("hubs"))
    met = rows.alias("m").join(hubs.select("key", F.explode("hubs").alias("h")).select("key", "h.*").alias("h"), "key")
    met = met.filter((F.col("m.id") != F.col("h.id")) & may_link("m", "h"))
    pairs = met.select(F.least("m.id", "h.id").alias("a"), F.greatest("m.id", "h.id").alias("b")).distinct()
    links = staged(confirmed(pairs))
    named = rows.join(components(links), "id", "left").withColumn("component", F.coalesce("component", "id"))
    named = staged(named)
    open_ = named.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"))
    named = with_cuts(named.join(open_.filter("low < high").select("key", "n"), "key"))
    return links.union(confirmed(others(named).distinct()))


def with_cuts(rows: DataFrame) -> DataFrame:
    """The rows of a bucket of more than MOST_TOGETHER (n) with its largest component, and into how
    many parts and turns it is cut; null for smaller ones."""
    large = rows.filter(F.col("n") > MOST_TOGETHER).groupBy("key", "component").agg(F.count("*").alias("some"))
    count = lambda n: F.greatest(F.lit(1), F.ceil(n / MOST_TOGETHER)).cast("int")
    most = large.groupBy("key").agg(F.max(F.struct("some", "component")).alias("most"), F.sum("some").alias("all"))
    cut = most.select("key", F.col("most.component").alias("main"), count(F.col("all")).alias("parts"), count(F.col("all") - F.col("most.some")).alias("turns"))
    return rows.join(cut, "key", "left").drop("n")


def cells(rows: DataFrame) -> DataFrame:
    """The rows with the cells they meet in: part, turn, and whether they are compared there (asked)
    or are among what these are compared with (listed). A bucket that is not cut is one cell.

    A large bucket's rows are cut by a hash into parts, and those outside its largest component into
    turns; every turn meets every part. So a row of the largest component is sent once for each turn,
    and a bucket of any size, with a few foreign rows, is spread over as many tasks as it has parts."""
    part, turn = (F.pmod(F.xxhash64("id", F.lit(n)), n).cast("int") for n in ("parts", "turns"))
    named = rows.withColumn("apart", F.coalesce(F.col("component") != F.col("main"), F.lit(False))).withColumn("own_part", part).withColumn("own_turn", turn)
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    cell = lambda part, turn, asked, listed: F.struct(part.alias("part"), turn.alias("turn"), asked.alias("asked"), listed.alias("listed"))
    listed = F.transform(every("turns"), lambda t: cell(F.col("own_part"), t, F.col("apart") & (t == F.col("own_turn")), F.lit(True)))
    asked = F.transform(F.filter(every("parts"), lambda p: F.col("apart") & (p != F.col("own_part"))), lambda p: cell(p, F.col("own_turn"), F.lit(True), F.lit(False)))
    whole = F.array(cell(F.lit(0), F.lit(0), F.lit(False), F.lit(True)))
    out = named.withColumn("cell", F.explode(F.when(F.col("main").isNull(), whole).otherwise(F.concat(listed, asked))))
    return out.select(*(c for c in rows.columns if c not in ("main", "parts", "turns")), F.col("main").isNull().alias("whole"), "apart", "cell.part", "cell.turn", "cell.asked", "cell.listed")


def pairs_in_buckets(
    rows: DataFrame,
    columns: Sequence[str],
    near: Callable[[dict[str, np.ndarray], int], np.ndarray],
    near_pairs: Callable[[dict[str, np.ndarray], np.ndarray, np.ndarray], np.ndarray] | None = None,
) -> DataFrame:
    """Pairs (a, b) of one bucket in different components that ``near`` lets through.

    ``near`` tests one row of a bucket against all; ``near_pairs``, if given, makes the same test of
    pairs of rows, and small buckets are compared with it, all at once. Else only rows outside a bucket's largest component
    are compared, with all others, a cell in one task; what is sent on are the pairs found."""
    place = ["key", "part", "turn"]
    names = [*place, "id", "component", "whole", "apart", "asked", "listed", *columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            done = int(_heads(batch, place)[-1])
            if rest and done == 0 and all(rest[0].column(n)[0].as_py() == batch.column(n)[0].as_py() for n in place):
                rest.append(batch)
                continue
            yield from _found(pa.Table.from_batches([*rest, batch.slice(0, done)]), names, near, near_pairs)
            rest = [batch.slice(done)]
        if rest:
            yield from _found(pa.Table.from_batches(rest), names, near, near_pairs)

    placed = cells(rows.select("key", "id", "component", "main", "parts", "turns", *columns)).select(names)
    return placed.repartition(*place).sortWithinPartitions(*place).mapInArrow(run, "a long, b long")


def _heads(rows: pa.RecordBatch | pa.Table, place: Sequence[str]) -> np.ndarray:
    """Where runs of rows of one cell start."""
    new = np.zeros(len(rows), bool)
    new[0] = True
    for n in place:
        values = rows.column(n).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def _array(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    if pa.types.is_binary(column.type):  # values of one length
        return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)
    if pa.types.is_list(column.type):
        return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    return column.to_numpy(zero_copy_only=False)


def _found(table: pa.Table, names: Sequence[str], near: Callable, near_pairs: Callable | None = None) -> Iterator[pa.RecordBatch]:
    if not len(table):
        return
    columns = {n: _array(table.column(n)) for n in names}
    key, starts = columns["key"], _heads(table, names[:3])
    a, b, held = [], [], 0
    sizes = np.diff(starts, append=len(key))
    small = columns["whole"][starts] & (sizes <= SMALL) & (near_pairs is not None)
    active, stop, ahead = np.flatnonzero(np.repeat(small, sizes)), np.repeat(starts + sizes, sizes), 1
    while len(active := active[active + ahead < stop[active]]):  # every row with the one so far after it
        some = active[columns["component"][active] != columns["component"][active + ahead]]
        some = some[near_pairs(columns, some, some + ahead)]
        one, two = columns["id"][some], columns["id"][some + ahead]
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(one, two)), pa.array(np.maximum(one, two))], names=["a", "b"])
        ahead += 1
    starts, stops = starts[~small], (starts + sizes)[~small]
    for first, last in zip(starts.tolist(), stops.tolist()):
        bucket = {n: c[first:last] for n, c in columns.items()}
        ids, component = bucket["id"], bucket["component"]
        apart, asked = bucket["apart"], bucket["asked"]
        if bucket["whole"][0]:
            found, sizes = np.unique(component, return_counts=True)
            apart = asked = component != found[np.argmax(sizes)]
        for i in np.flatnonzero(asked).tolist():
            # pairs of two rows outside the largest component once
            other = bucket["listed"] & (component != component[i]) & ~(apart & (ids <= ids[i]))
            if not other.any():
                continue
            good = ids[other & near(bucket, i)]
            if len(good):
                a.append(np.minimum(good, ids[i]))
                b.append(np.maximum(good, ids[i]))
                held += len(good)
        if held > 100_000:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])
            a, b, held = [], [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])
