"""Which entities to track: keep who is tracked, add seeds, neighbours and billed performers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upswell import settings
from upswell.functions.text import entity_key, normalize_name
from upswell.operators.latest import one_per

POOL_COLUMNS = "artist_key name mbid source added_date pool_date".split()


def is_seed(source: Column) -> Column:
    return source.startswith("geo:") | source.startswith("tag:")


def pool_is_stale(
    pool: DataFrame, today: Column, max_age_days: int = settings.POOL_MAX_AGE_DAYS
) -> DataFrame:
    """One row: the day the pool was built and whether it must be rebuilt (an empty pool must)."""
    return pool.agg(F.max("pool_date").alias("built")).withColumn(
        "stale", F.coalesce(F.datediff(today, "built") >= max_age_days, F.lit(True))
    )


def neighbour_votes(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """How many seed links point at each entity that is no seed."""
    return (
        edges.join(seeds.select(F.col("artist_key").alias("to_key")), "to_key", "left_anti")
        .groupBy(F.col("to_key").alias("artist_key"))
        .agg(F.count("*").alias("votes"))
    )


def numbered(df: DataFrame, order: list[Column], most: int) -> DataFrame:
    """The first ``most`` rows with their place. ``most`` is a configured pool size, so the
    one-task window behind it holds no more rows than that."""
    return df.orderBy(*order).limit(most).withColumn(
        "_place", F.row_number().over(Window.orderBy(*order))
    )


def room_left(pool: DataFrame, cap: int, counted: Column) -> Column:
    return pool.select(F.greatest(F.lit(cap) - F.count_if(counted), F.lit(0))).scalar()


def fresh_by_name(candidates: DataFrame, pool: DataFrame, order: list[Column]) -> DataFrame:
    """Candidates whose normalized name is not in the pool, the first per name: the same act
    can arrive with and without an ID."""
    named = candidates.withColumn("_name", normalize_name(F.col("name")))
    taken = pool.select(normalize_name(F.col("name")).alias("_name")).distinct()
    return one_per(named, ["_name"], order).join(taken, "_name", "left_anti").drop("_name")


def dated(added: DataFrame, pool_date: Column) -> DataFrame:
    return added.withColumn("added_date", pool_date).withColumn("pool_date", pool_date)


def merge_pool(
    existing: DataFrame,
    seeds: DataFrame,
    neighbours: DataFrame,
    pool_date: Column,
    max_size: int = settings.MAX_POOL_SIZE,
    seed_share: float = settings.MAX_SEED_SHARE,
) -> DataFrame:
    """The pool after a rebuild. Members stay always; up to ``max_size`` join them: seeds within
    their share first, then neighbours by votes, then the other seeds.

    existing: pool rows; seeds: artist_key, name, mbid, source, position; neighbours: the same
    and votes. The seed share counts seeds before names are compared."""
    share = int(max_size * seed_share)
    keys = existing.select("artist_key")
    new_seeds = seeds.join(keys, "artist_key", "left_anti")
    by_position = [F.col("position"), F.col("artist_key")]
    first = (
        numbered(new_seeds.select("artist_key", "position"), by_position, share)
        .filter(F.col("_place") <= room_left(existing, share, is_seed(F.col("source"))))
        .select("artist_key", F.lit(0).alias("_tier"))
    )
    tiered = new_seeds.join(first, "artist_key", "left").select(
        "artist_key",
        "name",
        "mbid",
        "source",
        "position",
        F.lit(0).cast("bigint").alias("votes"),
        F.coalesce("_tier", F.lit(2)).alias("_tier"),
    )
    others = (
        neighbours.join(keys, "artist_key", "left_anti")
        .join(seeds.select("artist_key"), "artist_key", "left_anti")
        .select("artist_key", "name", "mbid", "source", "position", "votes", F.lit(1).alias("_tier"))
    )
    order = [F.col("_tier"), F.col("votes").desc(), *by_position]
    fresh = fresh_by_name(tiered.unionByName(others), existing, order)
    added = numbered(fresh, order, max_size).filter(
        F.col("_place") <= room_left(existing, max_size, F.lit(True))
    )
    return (
        existing.withColumn("pool_date", pool_date)
        .select(*POOL_COLUMNS)
        .unionByName(dated(added, pool_date).select(*POOL_COLUMNS))
    )


def billed_performers(bill: DataFrame, events: DataFrame) -> DataFrame:
    """Distinct performers of events as pool candidates, the earliest billing first. Events read out of
    VARIANT lines look far smaller to Spark than they are, so the join says not to send all of them to every task."""
    acts = bill.join(events.select("event_id", "city").hint("merge"), "event_id").select(
        entity_key(F.col("performer_name"), F.col("performer_mbid")).alias("artist_key"),
        F.col("performer_name").alias("name"),
        F.col("performer_mbid").alias("mbid"),
        F.concat(F.lit("event:"), F.coalesce("city", F.lit(""))).alias("source"),
        F.struct("event_id", "billing_order").alias("position"),
    )
    return one_per(acts, ["artist_key"], [F.col("position")])


def add_event_performers(
    pool: DataFrame,
    performers: DataFrame,
    pool_date: Column,
    cap: int = settings.MAX_EVENT_ENTITIES,
) -> DataFrame:
    """The pool and the performers it lacks by key and by name, under a cap of their own."""
    order = [F.col("position"), F.col("artist_key")]
    unknown = performers.join(pool.select("artist_key"), "artist_key", "left_anti")
    fresh = fresh_by_name(unknown, pool, order)
    from_events = F.col("source").startswith("event:")
    added = numbered(fresh, order, cap).filter(
        F.col("_place") <= room_left(pool, cap, from_events)
    )
    return pool.select(*POOL_COLUMNS).unionByName(dated(added, pool_date).select(*POOL_COLUMNS))
