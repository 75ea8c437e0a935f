"""The growth signals table: how fast each entity grows compared with others of its size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upswell import settings
from upswell.functions import arrays, numbers
from upswell.functions.text import match_form
from upswell.operators.growth import chart_entries, growth_points
from upswell.operators.robust import with_ranks, with_robust_z
from upswell.staging import staged


def latest_day(daily: DataFrame, day: str = "snapshot_date") -> Column:
    return daily.select(F.max(day)).scalar()


def possible_aliases(profile: DataFrame) -> DataFrame:
    """Entities with a similar act whose name differs yet has the same match form: most likely
    one act restyled. Columns ``artist_key``, ``possible_alias_of`` (the first such name)."""
    return (
        profile.select("artist_key", "name", F.posexplode("similar_names").alias("pos", "other"))
        .filter(F.col("other") != F.col("name"))
        .filter(match_form(F.col("other")) == match_form(F.col("name")))
        .groupBy("artist_key")
        .agg(F.min_by("other", "pos").alias("possible_alias_of"))
    )


def growth_signals(
    daily: DataFrame,
    charts: DataFrame,
    as_of: Column | None = None,
    profile: DataFrame | None = None,
    extra_views: DataFrame | None = None,
    bands: Sequence[tuple[int, str]] = settings.SIZE_BANDS,
    min_band_size: int = settings.MIN_BAND_SIZE,
    short: int = settings.SHORT_WINDOW_DAYS,
    long: int = settings.LONG_WINDOW_DAYS,
    chart_days: int = settings.CHART_WINDOW_DAYS,
) -> DataFrame:
    """One row per entity seen on ``as_of`` (default: the latest day).

    daily: artist_key, name, snapshot_date, lastfm_listeners, lastfm_playcount (cumulative)
    charts: artist_key, snapshot_date, country
    profile: artist_key, tags, on_tour, lastfm_url, similar_names
    extra_views: artist_key, snapshot_date, yt_views (cumulative)

    Sources refresh cached totals on their own schedule, so totals that stand still across a
    window are "no measurement", not zero growth."""
    as_of = latest_day(daily) if as_of is None else as_of
    points = growth_points(
        daily,
        as_of,
        windows=[
            ("short", "lastfm_listeners", short),
            ("long", "lastfm_listeners", long),
            ("plays", "lastfm_playcount", short),
        ],
        changed=["lastfm_listeners", "lastfm_playcount"],
        carry=["name", "lastfm_listeners", "lastfm_playcount"],
    )

    def unmoved(prefix: str) -> Column:
        same = F.col(f"{prefix}_now") == F.col(f"{prefix}_then")
        return F.coalesce(same, F.lit(False))

    stale = unmoved("short") & unmoved("plays")
    measured = points.select(
        "artist_key",
        "name",
        "as_of_date",
        "lastfm_listeners",
        "lastfm_playcount",
        numbers.size_band(F.col("lastfm_listeners"), bands).alias("size_band"),
        (F.datediff("as_of_date", "first_seen") + 1).alias("history_days"),
        F.col("last_changed").alias("stats_last_changed"),
        F.when(~stale, F.col("short_rate")).alias("listener_rate"),
        F.when(~unmoved("long"), F.col("long_rate")).alias("listener_rate_long"),
        F.when(~stale, F.col("plays_rate")).alias("play_rate"),
        (F.col("short_now") - F.col("short_then")).alias("_gained"),
        F.col("short_span").alias("_span"),
    )
    metrics = {"listener_rate": "listener_growth_z", "play_rate": "play_growth_z"}
    if extra_views is not None:
        views = growth_points(extra_views, as_of, [("views", "yt_views", short)])
        measured = measured.join(
            views.select("artist_key", F.col("views_rate").alias("view_rate")), "artist_key", "left"
        )
        metrics["view_rate"] = "yt_view_growth_z"
    # Read by the histogram, median, spread and scoring branches: write it once.
    measured = staged(measured)

    scored = with_robust_z(measured, "size_band", metrics, min_band_size)
    if extra_views is None:
        scored = scored.withColumn("yt_view_growth_z", F.lit(None).cast("double"))
    entries = chart_entries(charts, as_of, chart_days)
    scored = (
        scored.join(entries, "artist_key", "left")
        .withColumn("new_country_charts_14d", F.coalesce("new_country_charts", F.lit(0)))
        .withColumn("chart_countries", arrays.empty_if_null(F.col("chart_countries")))
        .withColumn(
            "chart_entry_points",
            F.least("new_country_charts_14d", F.lit(settings.CHART_ENTRY_CAP)).cast("double"),
        )
        .withColumn(
            "breakout_z",
            F.when(
                F.col("listener_growth_z").isNotNull(),
                numbers.weighted_mean(settings.SCORE_WEIGHTS),
            ),
        )
    )
    ranked = with_ranks(staged(scored), "breakout_z", "breakout_rank", "breakout_score")

    if profile is None:
        ranked = ranked.select(
            "*",
            F.array().cast("array<string>").alias("tags"),
            F.lit(None).cast("boolean").alias("on_tour"),
            F.lit(None).cast("string").alias("lastfm_url"),
            F.lit(None).cast("string").alias("possible_alias_of"),
        )
    else:
        ranked = ranked.join(
            profile.select("artist_key", "tags", "on_tour", "lastfm_url"), "artist_key", "left"
        ).join(possible_aliases(profile), "artist_key", "left")

    window = F.when(F.col("listener_rate").isNotNull(), F.col("_span"))
    return ranked.select(
        "artist_key",
        "name",
        "as_of_date",
        arrays.top_joined(F.col("tags")).alias("genres"),
        arrays.empty_if_null(F.col("tags")).alias("tags"),
        "lastfm_listeners",
        "lastfm_playcount",
        "size_band",
        "breakout_score",
        "breakout_rank",
        "breakout_z",
        numbers.growth_pct(F.col("listener_rate"), short).alias("listeners_7d_growth_pct"),
        numbers.growth_pct(F.col("listener_rate_long"), long).alias("listeners_14d_growth_pct"),
        numbers.growth_pct(F.col("play_rate"), short).alias("plays_7d_growth_pct"),
        numbers.half_even(F.col("_gained") * short / window).cast("bigint").alias("new_listeners_7d"),
        "new_country_charts_14d",
        "chart_countries",
        "listener_growth_z",
        "play_growth_z",
        "yt_view_growth_z",
        window.alias("growth_window_days"),
        (~F.coalesce(window >= short, F.lit(False))).alias("is_provisional"),
        "history_days",
        "stats_last_changed",
        "on_tour",
        "lastfm_url",
        "possible_alias_of",
    )
