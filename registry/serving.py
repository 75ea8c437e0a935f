from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from registry.growth import user_signals
from registry.ingest import parsed_snapshots
from upswell import views
from upswell.functions import arrays, numbers, text
from upswell.operators import latest
from upswell.operators.growth import growth_history
from upswell.plans import profile, quality, ranking, shows
from upswell.sources import export


def today() -> Column:
    return F.lit("2001-05-20").cast("date")


def joined(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        if c in df.columns:
            df = df.withColumn(c, F.array_join(c, "|"))
    return df


def top_risers(spark: SparkSession, folder: str) -> DataFrame:
    """The users growing fastest for their size, from the full growth signals."""
    out = ranking.top_risers(user_signals(spark, folder), limit=20, superstar_band="80+")
    for c in ("listeners_7d_growth_pct", "listeners_14d_growth_pct", "plays_7d_growth_pct"):
        out = out.withColumn(c, F.round(c, 6))
    return joined(out, "chart_countries")


def top_risers_country(spark: SparkSession, folder: str) -> DataFrame:
    canadian = F.when(F.col("on_tour"), F.array(F.lit("Canadian indie"))).otherwise(F.array())
    signals = views.catalog_signals(spark, folder).withColumn("tags", F.concat("tags", canadian))
    return joined(
        ranking.top_risers(signals, country="canadian", include_superstars=True, limit=50),
        "chart_countries",
    )


def genre_risers(spark: SparkSession, folder: str) -> DataFrame:
    out = ranking.top_risers(views.catalog_signals(spark, folder), genre="RiN", limit=10)
    return joined(out, "chart_countries")


def whole_tag_risers(spark: SparkSession, folder: str) -> DataFrame:
    out = ranking.top_risers(
        views.catalog_signals(spark, folder), genre="Ring", size_band="10k-50k", whole_tag=True
    )
    return joined(out, "chart_countries")


def new_on_charts(spark: SparkSession, folder: str) -> DataFrame:
    return joined(
        ranking.new_on_charts(views.catalog_signals(spark, folder), "Brazil"), "chart_countries"
    )


def country_names(spark: SparkSession, folder: str) -> DataFrame:
    docs = views.table(spark, folder, "documents").select("doc_id", F.upper("lang").alias("place"))
    return ranking.with_country_names(docs, "place")


def data_notes(spark: SparkSession, folder: str) -> DataFrame:
    return joined(ranking.data_notes(views.catalog_signals(spark, folder), today()), "notes")


def data_status(spark: SparkSession, folder: str) -> DataFrame:
    tables = {
        n: views.table(spark, folder, n)
        for n in ("part", "orders", "lineitem", "events", "customer", "documents")
    }
    meta = export.export_meta(tables, "files").drop("exported_at")
    return ranking.freshness(meta, views.catalog_signals(spark, folder), today())


def shows_table(spark: SparkSession, folder: str) -> DataFrame:
    return shows.upcoming_shows(
        views.order_events(spark, folder),
        views.order_bills(spark, folder),
        views.bill_matches(spark, folder),
        views.catalog_signals(spark, folder),
        today(),
    )


def lineups(spark: SparkSession, folder: str) -> DataFrame:
    return joined(shows.lineups(views.order_bills(spark, folder), first=3), "lineup")


def searched(spark: SparkSession, folder: str, **filters) -> DataFrame:
    out = shows.show_search(
        shows_table(spark, folder),
        views.order_bills(spark, folder),
        views.catalog_signals(spark, folder),
        today(),
        **filters,
    )
    return joined(out, "lineup")


def show_search(spark: SparkSession, folder: str) -> DataFrame:
    return searched(spark, folder, max_price=30.0, days_ahead=60, min_score=40.0, limit=50)


def show_search_city(spark: SparkSession, folder: str) -> DataFrame:
    return searched(spark, folder, city="Nation_3", days_ahead=90, genre="ring", limit=50)


def show_search_priced(spark: SparkSession, folder: str) -> DataFrame:
    keys = views.catalog_signals(spark, folder).filter("size_band = '50k-500k'")
    return searched(spark, folder, require_price=True, keys=keys, days_ahead=30)


def cheap_shows(spark: SparkSession, folder: str) -> DataFrame:
    return shows.cheap_shows(shows_table(spark, folder), "NATION_3", today(), 60)


def shows_elsewhere(spark: SparkSession, folder: str) -> DataFrame:
    return shows.shows_elsewhere(shows_table(spark, folder), "nation_3").select(
        "artist_key", "event_id", "event_date", "city", "place"
    )


def weekend_shows(spark: SparkSession, folder: str) -> DataFrame:
    """Shows of the weekend seen from each order's own day: the calendar rule on every day."""
    days = views.order_events(spark, folder).select("event_date").distinct()
    start, end = numbers.weekend_window(F.col("event_date"))
    return days.select("event_date", start.alias("weekend_from"), end.alias("weekend_to"))


def ticket_tables(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, Column]:
    """Orders as shows; about the half that line items mention have a status row."""
    status_rows = views.table(spark, folder, "orders").filter("o_orderpriority <> '2-HIGH'")
    day = F.col("o_orderdate").cast("timestamp")
    statuses = status_rows.select(
        F.col("o_orderkey").alias("event_id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "postponed")
        .when(F.col("o_orderstatus") == "O", "onsale")
        .when(F.col("o_orderstatus") == "F", "offsale")
        .otherwise("canceled")
        .alias("status_code"),
        (day - F.expr("INTERVAL 100 DAYS")).alias("sale_start"),
        (day - F.expr("INTERVAL 1 DAY")).alias("sale_end"),
        F.when(F.col("o_totalprice") > 200000, F.to_date("o_orderdate")).alias("new_date"),
    )
    events = views.order_events(spark, folder).select("event_id", "event_date", "city")
    return events, statuses, F.lit("1998-01-01").cast("timestamp")


def ticket_status(spark: SparkSession, folder: str) -> DataFrame:
    return shows.with_ticket_status(*ticket_tables(spark, folder))


def ticket_recount(spark: SparkSession, folder: str) -> DataFrame:
    """Shows of each city that are still on, and how many were canceled since."""
    return joined(shows.ticket_recount(*ticket_tables(spark, folder), by=["city"]), "notes")


def search_window(spark: SparkSession, folder: str) -> DataFrame:
    """Five days after the newest data, 90 days ahead runs past what is known."""
    return shows.search_window(views.catalog_signals(spark, folder), today(), 90)


def part_history(spark: SparkSession, folder: str) -> DataFrame:
    """Running shipped quantity per part and shipping day, with the change per day."""
    per_day = (
        views.table(spark, folder, "lineitem")
        .groupBy("l_partkey", F.to_date("l_shipdate").alias("snapshot_date"))
        .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("q"))
    )
    totals = views.running(per_day, ["l_partkey"], "snapshot_date", {"lastfm_listeners": "q"})
    return growth_history(
        totals.select(
            F.concat(F.lit("mbid:p"), "l_partkey").alias("artist_key"),
            "snapshot_date",
            "lastfm_listeners",
        ),
        {"lastfm_listeners": "listeners_change"},
    )


def part_briefs(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation turns as briefs of the part numbered like the conversation."""
    return views.table(spark, folder, "conversations").select(
        F.concat(F.lit("mbid:p"), "conv_id").alias("artist_key"),
        F.when(F.col("role") == "assistant", F.col("text")).alias("brief_md"),
        F.lit(None).cast("string").alias("signing_status"),
        F.lit(None).cast("boolean").alias("label_mentioned"),
        F.col("turn").alias("generated_at"),
    )


def entity_profile(spark: SparkSession, folder: str) -> DataFrame:
    signals = views.catalog_signals(spark, folder)
    out = profile.entity_profiles(
        signals.select("artist_key"),
        signals,
        part_history(spark, folder),
        part_briefs(spark, folder),
        shows_table(spark, folder),
        views.order_bills(spark, folder),
        today(),
    )
    return out.select(
        "artist_key",
        "name",
        "breakout_score",
        F.array_join("tags", "|").alias("tags"),
        F.col("trend.pattern").alias("pattern"),
        F.col("trend.days").alias("days"),
        F.col("trend.total_change").alias("total_change"),
        F.col("trend.largest_one_day_date").alias("largest_one_day_date"),
        F.array_join(
            F.transform(
                "daily_listeners", lambda d: F.concat(d["date"], F.lit("="), d["listeners"])
            ),
            " ",
        ).alias("daily_listeners"),
        F.col("scout_brief.brief_md").alias("brief_md"),
        F.array_join(
            F.transform(
                "upcoming_shows",
                lambda s: F.concat_ws(
                    ";",
                    s["event_date"].cast("string"),
                    s["event_id"].cast("string"),
                    s["role"],
                    s["headliner"],
                    F.array_join(s["lineup"], "+"),
                    s["lineup_size"].cast("string"),
                ),
            ),
            " / ",
        ).alias("shows"),
    )


def quality_inputs(spark: SparkSession, folder: str):
    bronze = parsed_snapshots(spark, folder)
    daily = latest.artist_daily(bronze)
    pool = views.table(spark, folder, "events").select("user_id").distinct()
    gold = latest.on_latest_day(daily).select(
        (F.col("lastfm_listeners") * 1.2 - 5).alias("breakout_score")
    )
    return daily, pool, bronze, gold


def quality_metrics(spark: SparkSession, folder: str) -> DataFrame:
    metrics = quality.quality_metrics(*quality_inputs(spark, folder))
    today = F.to_date(F.lit("2024-02-02"))
    return joined(quality.with_failures(metrics, today), "failures")


def duplicate_keys(spark: SparkSession, folder: str) -> DataFrame:
    return quality.duplicate_keys(
        views.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


def scalar_numbers(spark: SparkSession, folder: str) -> DataFrame:
    part = views.table(spark, folder, "part")
    size = F.col("p_size").cast("bigint") * F.col("p_size") * F.col("p_size") * F.col("p_size")
    return part.select(
        "p_partkey",
        numbers.size_band(size).alias("size_band"),
        F.round(numbers.smallness(size), 9).alias("smallness"),
        F.round(numbers.cheapness(F.col("p_retailprice") - 900), 9).alias("cheapness"),
        F.round(numbers.soft_clip((F.col("p_retailprice") - 950) / 5), 9).alias("soft_clip"),
        F.round(
            numbers.growth_pct(numbers.log_rate(size + 10, size, F.lit(7)), 7), 6
        ).alias("growth_pct"),
        numbers.half_even((F.col("p_size") - 25) / 2).alias("half_even"),
        arrays.top_joined(views.part_tags()).alias("genres"),
        arrays.any_contains(views.part_tags(), "RING").alias("has_ring"),
        text.key_to_mbid(F.concat(F.lit("mbid:p"), "p_partkey")).alias("mbid"),
    )


QUERIES = {
    "top_risers": top_risers,
    "top_risers_country": top_risers_country,
    "genre_risers": genre_risers,
    "whole_tag_risers": whole_tag_risers,
    "new_on_charts": new_on_charts,
    "country_names": country_names,
    "data_notes": data_notes,
    "data_status": data_status,
    "upcoming_shows": shows_table,
    "lineups": lineups,
    "show_search": show_search,
    "show_search_city": show_search_city,
    "show_search_priced": show_search_priced,
    "cheap_shows": cheap_shows,
    "shows_elsewhere": shows_elsewhere,
    "weekend_shows": weekend_shows,
    "ticket_status": ticket_status,
    "ticket_recount": ticket_recount,
    "search_window": search_window,
    "entity_profile": entity_profile,
    "quality_metrics": quality_metrics,
    "duplicate_keys": duplicate_keys,
    "scalar_numbers": scalar_numbers,
}
