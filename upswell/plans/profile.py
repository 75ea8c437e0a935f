"""Everything known about each requested entity, one row apiece."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upswell import settings
from upswell.operators.growth import trend_summary
from upswell.operators.latest import one_per, top_per
from upswell.plans.shows import lineups
from upswell.staging import staged


def latest_briefs(briefs: DataFrame) -> DataFrame:
    """The newest brief per entity that has text."""
    return one_per(
        briefs.filter("brief_md IS NOT NULL"), ["artist_key"], [F.col("generated_at").desc()]
    )


def entity_profiles(
    requests: DataFrame,
    signals: DataFrame,
    history: DataFrame,
    briefs: DataFrame,
    shows: DataFrame,
    performers: DataFrame,
    today: Column,
    max_shows: int = settings.MAX_LIMIT,
) -> DataFrame:
    """Signals, trend, daily totals, newest brief, the first ``max_shows`` coming shows by date and
    how many there are (``upcoming_total``).

    ``requests`` has ``artist_key``. Daily totals are one value per day and a page of shows is
    listed, so no list grows with the data."""
    keys = requests.select("artist_key").distinct()
    signals = signals.join(keys, "artist_key", "left_semi")
    history = history.join(keys, "artist_key", "left_semi")
    trend = trend_summary(history, "lastfm_listeners", "listeners_change")
    fields = [c for c in trend.columns if c != "artist_key"]
    trend = trend.select("artist_key", F.struct(*fields).alias("trend"))
    daily = history.groupBy("artist_key").agg(
        F.array_sort(
            F.collect_list(
                F.struct(F.col("snapshot_date").alias("date"), F.col("lastfm_listeners").alias("listeners"))
            )
        ).alias("daily_listeners")
    )
    brief = latest_briefs(briefs).select(
        "artist_key",
        F.struct("brief_md", "signing_status", "label_mentioned", "generated_at").alias("scout_brief"),
    )
    as_of = signals.select(F.max("as_of_date")).scalar()
    ahead = shows.join(keys, "artist_key", "left_semi").filter(F.col("event_date") >= F.greatest(as_of, today))
    totals = ahead.groupBy("artist_key").agg(F.count("*").alias("upcoming_total"))
    coming = top_per(ahead, ["artist_key"], [F.col("event_date"), F.col("event_id")], max_shows, "_place")
    coming = staged(coming)  # read for its bills and for itself
    more = [c for c in ("local_time", "event_name", "max_price", "currency", "ticket_url", "status") if c in shows.columns]
    bills = lineups(performers.join(coming.select("event_id"), "event_id", "left_semi"))
    listed = (
        coming.join(bills, "event_id", "left")
        .groupBy("artist_key")
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct(
                        "_place",
                        "event_date",
                        "city",
                        "venue",
                        "event_id",
                        "min_price",
                        F.col("min_price").isNotNull().alias("price_known"),
                        F.when(F.col("is_headliner"), "headliner").otherwise("support").alias("role"),
                        "headliner",
                        "lineup",
                        "lineup_size",
                        *more,
                    )
                )
            ).alias("upcoming_shows")
        )
    )
    out = signals.withColumn("tags", F.slice("tags", 1, 10))
    for part in (trend, daily, brief, listed, totals):
        out = out.join(part, "artist_key", "left")
    return out.withColumn("upcoming_total", F.coalesce("upcoming_total", F.lit(0)))
