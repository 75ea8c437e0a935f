from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upswell import views
from upswell.functions.numbers import size_band
from upswell.operators import growth, robust
from upswell.plans import signals
from upswell.staging import staged

ROUNDED = (
    "breakout_z",
    "listeners_7d_growth_pct",
    "listeners_14d_growth_pct",
    "plays_7d_growth_pct",
    "listener_growth_z",
    "play_growth_z",
)


def shown(df: DataFrame) -> DataFrame:
    """Arrays as text and rates to six decimals, so both engines print the same."""
    out = df.withColumn("chart_countries", F.array_join("chart_countries", ", "))
    for c in ROUNDED:
        out = out.withColumn(c, F.round(c, 6))
    return out.drop("yt_view_growth_z")


def user_signals(spark: SparkSession, folder: str) -> DataFrame:
    return signals.growth_signals(
        views.user_daily(spark, folder),
        views.user_charts(spark, folder),
        profile=views.user_profile(spark, folder),
        bands=views.USER_BANDS,
    )


def growth_signals(spark: SparkSession, folder: str) -> DataFrame:
    return shown(user_signals(spark, folder)).withColumn("tags", F.array_join("tags", "|"))


def growth_signals_dense(spark: SparkSession, folder: str) -> DataFrame:
    out = signals.growth_signals(
        views.part_polled(spark, folder),
        views.supplier_charts(spark, folder),
        bands=views.PART_BANDS,
    )
    return shown(out).drop("genres", "tags", "on_tour", "lastfm_url", "possible_alias_of")


def growth_signals_compacted(spark: SparkSession, folder: str) -> DataFrame:
    """The same signals from a history folded twice, then the last two weeks day by day."""
    daily = views.user_daily(spark, folder)
    metrics = ["lastfm_listeners", "lastfm_playcount"]
    last = signals.latest_day(daily)
    early, late = F.date_sub(last, 22), F.date_sub(last, 14)
    first = growth.compact_history(daily, early, metrics)
    between = daily.filter((F.col("snapshot_date") > early) & (F.col("snapshot_date") <= late))
    folded = staged(growth.compact_history(growth.with_compacted(first, between), late, metrics))
    out = signals.growth_signals(
        growth.with_compacted(folded, daily.filter(F.col("snapshot_date") > late)),
        views.user_charts(spark, folder),
        profile=views.user_profile(spark, folder),
        bands=views.USER_BANDS,
    )
    return shown(out).withColumn("tags", F.array_join("tags", "|"))


def user_history(spark: SparkSession, folder: str) -> DataFrame:
    return growth.growth_history(
        views.user_daily(spark, folder),
        {"lastfm_listeners": "listeners_change", "lastfm_playcount": "playcount_change"},
    )


def user_trend(spark: SparkSession, folder: str) -> DataFrame:
    out = growth.trend_summary(user_history(spark, folder), "lastfm_listeners", "listeners_change")
    gap_text = F.transform(
        "gaps", lambda g: F.concat(g["from"], F.lit(">"), g["to"], F.lit(":"), g["days"])
    )
    return out.withColumn("gaps", F.array_join(gap_text, " "))


def history_runs(spark: SparkSession, folder: str) -> DataFrame:
    return growth.history_runs(views.user_daily(spark, folder)).select(
        "artist_key", "snapshot_date", "lastfm_listeners", "pause_from", "run"
    )


def chart_entries(spark: SparkSession, folder: str) -> DataFrame:
    daily = views.user_daily(spark, folder)
    return growth.chart_entries(
        views.user_charts(spark, folder), signals.latest_day(daily), 14
    ).withColumn("chart_countries", F.array_join("chart_countries", ", "))


def robust_scales(spark: SparkSession, folder: str) -> DataFrame:
    daily = views.user_daily(spark, folder)
    points = growth.growth_points(
        daily,
        signals.latest_day(daily),
        [("l", "lastfm_listeners", 7), ("p", "lastfm_playcount", 7)],
        carry=["lastfm_listeners"],
    )
    moved = ~(
        F.coalesce(F.col("l_now") == F.col("l_then"), F.lit(False))
        & F.coalesce(F.col("p_now") == F.col("p_then"), F.lit(False))
    )
    rates = points.select(
        size_band(F.col("lastfm_listeners"), views.USER_BANDS).alias("size_band"),
        F.when(moved, F.col("l_rate")).alias("lr"),
        F.when(moved, F.col("p_rate")).alias("pr"),
    )
    return robust.robust_scales(staged(rates), "size_band", ["lr", "pr"]).select(
        "metric",
        "scope",
        F.round("median", 9).alias("median"),
        F.round("scale", 9).alias("scale"),
        "members",
    )


QUERIES = {
    "growth_signals": growth_signals,
    "growth_signals_compacted": growth_signals_compacted,
    "growth_signals_dense": growth_signals_dense,
    "growth_history": user_history,
    "trend_summary": user_trend,
    "history_runs": history_runs,
    "chart_positions": views.user_charts,
    "chart_entries": chart_entries,
    "robust_scales": robust_scales,
}
