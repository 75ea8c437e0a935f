"""Small Spark helpers the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from upswell.staging import staged

__all__ = ["components", "held_out", "in_batches", "staged", "table"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def in_batches(df: DataFrame, step: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: StructType | str) -> DataFrame:
    """``step`` on every Arrow batch, with nothing kept between batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from step(batch)

    return df.mapInArrow(run, schema)


def held_out(doc_id: Column | str) -> Column:
    """Rows no classifier learns from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges in the shared folder, and their number with a sum over their hashes: both the
    same for the same set. Counted while writing, so it takes no pass of its own."""
    seen = Observation()
    facts = (F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("hashes"))
    out = staged(edges.observe(seen, *facts))
    return out, (seen.get["n"], seen.get["hashes"])


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b); component is the smallest id reachable.

    Alternating large-star and small-star: each step links neighbours to the smallest one around
    them, until every component is a star. All steps are equi-joins of edges with one row per
    node, so a node with very many neighbours can be split. Each round is written to the shared
    folder. Links from an id to itself count as none; the result has no row then."""
    both = links.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a <> b")
    edges, before = _written(both.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while before[0]:
        turned = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = turned.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large-star: neighbours above a node go to the smallest around it
        large = (
            turned.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        # small-star: neighbours below a node, and the node, go to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
            .select(F.col("e.v").alias("u"), F.col("e.m").alias("v"))
            .filter("u <> v")
            .distinct()
        )
        edges, after = _written(small)
        if after == before:
            break
        before = after
    found = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return found.union(found.select(F.col("component").alias("id"), "component")).distinct()
