"""Keep one row per key, keep the newest day, first source wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upswell.functions.text import strip_anchors


def one_per(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key group in the given order. Spark limits each group before the
    shuffle (window group limit), so a key repeated in a third of the rows stays cheap."""
    pick = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_pick", F.row_number().over(pick)).filter("_pick = 1").drop("_pick")


def top_per(
    df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column], n: int, rank: str
) -> DataFrame:
    """The first ``n`` rows per key, numbered from 1 in ``rank``."""
    pick = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(pick)).filter(F.col(rank) <= n)


def on_latest_day(df: DataFrame, day: str = "snapshot_date") -> DataFrame:
    """Rows of the newest day; the scalar subquery prunes partitions when ``day`` is one."""
    return df.filter(F.col(day) == df.select(F.max(day)).scalar())


def since_nth_latest_day(df: DataFrame, n: int, day: str = "snapshot_date") -> DataFrame:
    """Rows of the last ``n`` days that have any rows (not calendar days)."""
    days = df.select(day).distinct().orderBy(F.col(day).desc()).limit(n)
    return df.filter(F.col(day) >= days.select(F.min(day)).scalar())


def first_source_wins(sources: Sequence[DataFrame], key: str) -> DataFrame:
    """Union of sources by key, keeping each key's row from the earliest source, then its
    earliest ``position`` there."""
    stacked = None
    for i, source in enumerate(sources):
        tagged = source.withColumn("_source", F.lit(i))
        stacked = tagged if stacked is None else stacked.unionByName(tagged)
    return one_per(stacked, [key], [F.col("_source"), F.col("position")]).drop("_source")


def artist_daily(parsed: DataFrame) -> DataFrame:
    """One row per (name, day) with a known size, preferring ID keys, then key, then newest."""
    return one_per(
        parsed.filter("lastfm_listeners IS NOT NULL"),
        [F.lower("name"), "snapshot_date"],
        [
            F.col("artist_key").startswith("mbid:").desc(),
            F.col("artist_key"),
            F.col("fetched_at").desc(),
        ],
    ).select(
        "artist_key",
        "name",
        "mbid",
        "snapshot_date",
        "lastfm_listeners",
        "lastfm_playcount",
        "tags",
        "on_tour",
    )


def artist_profile(parsed: DataFrame, daily: DataFrame) -> DataFrame:
    """Newest descriptive row per entity, taken on its latest clean day."""
    latest = daily.groupBy("artist_key").agg(F.max("snapshot_date").alias("snapshot_date"))
    return one_per(
        parsed.join(latest, ["artist_key", "snapshot_date"]),
        ["artist_key"],
        [F.col("fetched_at").desc()],
    ).select(
        "artist_key",
        "name",
        "mbid",
        "tags",
        "on_tour",
        "lastfm_url",
        strip_anchors(F.col("bio_summary_html")).alias("bio_summary"),
        "similar_names",
        F.col("snapshot_date").alias("profile_date"),
    )


def newer_rows(kept: DataFrame, fresh: DataFrame, key: str, day: str) -> DataFrame:
    """One row per key out of two tables that hold one each: the later day's, the fresh one on
    the same day. Folding days in one after the other gives what all days at once would."""
    both = kept.withColumn("_fresh", F.lit(0)).unionByName(fresh.withColumn("_fresh", F.lit(1)))
    return one_per(both, [key], [F.col(day).desc(), F.col("_fresh").desc()]).drop("_fresh")


def newest_chart_rows(charts: DataFrame) -> DataFrame:
    """The newest row per (day, country, rank)."""
    return one_per(charts, ["snapshot_date", "country", "rank"], [F.col("fetched_at").desc()])


def tracked_names(profile: DataFrame) -> DataFrame:
    """Lower-cased name and the entity it stands for: ``lname``, ``tracked``. The minimum
    combines map-side; one row per name joins without fan-out."""
    return profile.groupBy(F.lower("name").alias("lname")).agg(F.min("artist_key").alias("tracked"))


def renamed(before: DataFrame, now: DataFrame) -> DataFrame:
    """``lname`` of every name that stands for another entity, or for one only before or now."""
    old = before.select("lname", F.col("tracked").alias("_before"))
    return old.join(now, "lname", "full").filter(~F.col("_before").eqNullSafe(F.col("tracked"))).select("lname")


def resolve_chart_names(charts: DataFrame, profile: DataFrame) -> DataFrame:
    """Give chart rows the tracked entity's key where the name is tracked, ignoring case.
    Keeps the newest row per (day, country, rank); ``charts`` has ``chart_artist_key``."""
    return with_tracked(newest_chart_rows(charts), tracked_names(profile))


def with_tracked(newest: DataFrame, names: DataFrame) -> DataFrame:
    """Chart rows of :func:`newest_chart_rows` with the keys of :func:`tracked_names`."""
    names = names.select(F.col("lname").alias("_lname"), F.col("tracked").alias("_tracked"))
    return newest.join(names, F.lower("name") == F.col("_lname"), "left").select(
        "snapshot_date",
        "country",
        "rank",
        F.coalesce("_tracked", "chart_artist_key").alias("artist_key"),
        F.col("_tracked").isNotNull().alias("in_pool"),
        "name",
        "country_listeners",
    )
