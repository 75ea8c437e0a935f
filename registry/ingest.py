from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from upswell import views
from upswell.functions import variants
from upswell.operators import latest
from upswell.operators.growth import growth_history
from upswell.sources import catalog, export, landing
from upswell.staging import scratch_path
from upswell.streaming.landing_stream import follow_landing


def event_records(spark: SparkSession, folder: str) -> DataFrame:
    """Events as landing records, their JSON properties nested as text."""
    return views.table(spark, folder, "events").select(
        F.to_date("ts").alias("snapshot_date"),
        F.lit("events").alias("source"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("fetched_at"),
        F.struct("event_id", "user_id", "event_type", "value", "props").alias("payload"),
    )


def read_back(bronze: DataFrame) -> DataFrame:
    return landing.only_parsed(bronze).select(
        variants.at("raw", "$.payload.event_id", "bigint").alias("event_id"),
        variants.at("raw", "$.payload.user_id", "bigint").alias("user_id"),
        variants.at("raw", "$.payload.event_type").alias("event_type"),
        variants.at("raw", "$.payload.value", "double").alias("value"),
        "snapshot_date",
        F.col("_source_file").contains("/events/dt=").alias("from_landing"),
    )


def land_events(spark: SparkSession, folder: str) -> str:
    root = scratch_path(spark, "landing")
    landing.write_landing(event_records(spark, folder), root, "events")
    return root


def raw_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    root = land_events(spark, folder)
    landing.ingest(spark, root, "events", f"{root}/bronze")
    return read_back(spark.read.parquet(f"{root}/bronze"))


def day_replace(spark: SparkSession, folder: str) -> DataFrame:
    """Load every day, then again: only the newest two days are replaced, nothing doubles."""
    root = land_events(spark, folder)
    landing.ingest(spark, root, "events", f"{root}/bronze")
    again = landing.ingest(spark, root, "events", f"{root}/bronze")
    return (
        read_back(spark.read.parquet(f"{root}/bronze"))
        .groupBy("snapshot_date")
        .agg(F.count("*").alias("events"), F.sum("user_id").alias("user_sum"))
        .withColumn("reloaded", F.col("snapshot_date").cast("string").isin(*again))
    )


def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    root = land_events(spark, folder)
    follow_landing(
        spark, root, "events", f"{root}/bronze", f"{root}/progress"
    ).awaitTermination()
    return read_back(spark.read.parquet(f"{root}/bronze"))


def typed_landing(spark: SparkSession, folder: str) -> DataFrame:
    """Artist records written as JSON lines and read with their declared types."""
    records = views.table(spark, folder, "part").select(
        F.lit("2001-05-15").cast("date").alias("snapshot_date"),
        F.concat(F.lit("name:"), "p_name").alias("artist_key"),
        F.struct(
            F.col("p_name").alias("name"),
            F.struct(
                F.col("p_size").cast("string").alias("listeners"),
                F.col("p_partkey").cast("string").alias("playcount"),
            ).alias("stats"),
        ).alias("payload"),
    )
    root = scratch_path(spark, "landing")
    landing.write_landing(records, root, "artists")
    lines = spark.read.text(f"{root}/artists/dt=2001-05-15")
    return landing.typed(lines, landing.ARTIST_ROW).select(
        "artist_key",
        F.col("payload.name").alias("name"),
        F.col("payload.stats.listeners").cast("bigint").alias("listeners"),
        F.col("payload.stats.playcount").cast("bigint").alias("playcount"),
    )


def landed_lines(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Lines of all four contracts, written as text and read back. Some are cut off, lack a needed
    field or hold text where a number belongs."""
    listeners = F.struct(F.col("p_size").cast("string").alias("listeners"))
    artist = F.struct(
        F.concat(F.lit("mbid:p"), "p_partkey").alias("artist_key"),
        F.struct(F.when(F.col("p_size") % 10 != 1, F.col("p_name")).alias("name"), listeners.alias("stats")).alias("payload"),
    )
    country = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("country")
    customer = F.concat(F.lit("customer "), "o_custkey").alias("name")
    entry = F.struct(country, F.col("o_orderkey").alias("rank"), customer, F.col("o_custkey").alias("listeners"))
    edge = F.struct(
        F.concat(F.lit("p"), "l_partkey").alias("from_key"),
        F.when(F.col("l_returnflag") != "R", F.concat(F.lit("s"), "l_suppkey")).alias("to_key"),
        F.col("l_discount").cast("double").alias("match"),
    )

    def event(least: Column) -> Column:
        id_ = F.when(F.col("user_id") % 3 != 0, F.col("event_id").cast("string")).alias("id")
        prices = F.array(F.struct(least.alias("min"))).alias("priceRanges")
        return F.to_json(F.struct(F.struct(id_, F.col("event_type").alias("name"), prices).alias("payload")))

    lines = {
        "artist": ("part", F.when(F.col("p_size") % 10 == 0, F.concat(F.lit("{"), "p_name")).otherwise(F.to_json(artist))),
        "chart": ("orders", F.when(
            F.col("o_orderkey") % 7 == 0, F.to_json(F.struct(country, F.lit("n/a").alias("rank"), customer))
        ).otherwise(F.to_json(entry))),
        "edge": ("lineitem", F.to_json(edge)),
        "event": ("events", F.when(F.col("user_id") % 5 == 0, event(F.lit("free"))).otherwise(event(F.col("value")))),
    }
    root = scratch_path(spark, "landing")
    for contract, (table, value) in lines.items():
        views.table(spark, folder, table).select(value.alias("value")).write.text(f"{root}/{contract}")
    return {contract: spark.read.text(f"{root}/{contract}") for contract in lines}


def landing_contracts(spark: SparkSession, folder: str) -> DataFrame:
    """How many lines of each kind keep their contract, and what is wrong with the others."""
    counts = [landing.contract_counts(lines, kind) for kind, lines in landed_lines(spark, folder).items()]
    return reduce(DataFrame.unionByName, counts)


def landing_kept(spark: SparkSession, folder: str) -> DataFrame:
    """Chart lines that keep their contract, typed."""
    kept, _ = landing.split_landing(landed_lines(spark, folder)["chart"], "chart")
    return kept.select("country", "rank", "name", "listeners")


def dataset_replace(spark: SparkSession, folder: str) -> DataFrame:
    """One dataset loaded twice, first from customers, then from suppliers: the second replaces
    the first whole, other fields and all."""
    root = scratch_path(spark, "landing")
    for table, name, nation in (("customer", "c_name", "c_nationkey"), ("supplier", "s_name", "s_nationkey")):
        fields = F.struct(F.col(name).alias("name"), F.col(nation).alias("nation"), F.lit(table).alias("source"))
        views.table(spark, folder, table).select(F.to_json(fields)).write.text(f"{root}/{table}.jsonl")
        landing.replace_pool(spark, f"{root}/{table}.jsonl", f"{root}/pool")
    return spark.read.parquet(f"{root}/pool").select(
        variants.at("raw", "$.name").alias("name"),
        variants.at("raw", "$.nation", "bigint").alias("nation"),
        variants.at("raw", "$.source").alias("source"),
    )


def days_to_load(spark: SparkSession, folder: str) -> DataFrame:
    """Order days as landed, shipping days as loaded."""
    landed = views.table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("day"))
    loaded = views.table(spark, folder, "lineitem").select(F.to_date("l_shipdate").alias("day"))
    return landing.days_to_load(landed, loaded)


def variant_extract(spark: SparkSession, folder: str) -> DataFrame:
    parsed = views.table(spark, folder, "events").withColumn("raw", F.try_parse_json("props"))
    return parsed.select(
        "event_id",
        variants.at("raw", "$.k", "bigint").alias("k"),
        variants.number_at("raw", "$.k").alias("k_from_text"),
        variants.text_at("raw", "$.missing").alias("missing"),
        variants.date_at("raw", "$.k").alias("not_a_date"),
    )


def variant_array_shapes(spark: SparkSession, folder: str) -> DataFrame:
    """Tags as a list of objects, one bare object or an empty string, all read as an array."""
    listed = F.to_json(
        F.struct(F.transform(views.part_tags(), lambda t: F.struct(t.alias("name"))).alias("tag"))
    )
    bare = F.to_json(F.struct(F.struct(F.col("p_brand").alias("name")).alias("tag")))
    text = (
        F.when(F.col("p_size") > 30, listed).when(F.col("p_size") > 10, bare).otherwise('{"tag":""}')
    )
    return (
        views.table(spark, folder, "part")
        .select("p_partkey", F.try_parse_json(text).alias("raw"))
        .select(
            "p_partkey",
            F.array_join(variants.strings_at("raw", "$.tag", "name"), "|").alias("tags"),
            F.size(variants.strings_at("raw", "$.tag", "name")).alias("n_tags"),
        )
    )


def event_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with their bill as nested ticketing records. A bill has at most one act per line
    number, so the nested list is short."""
    events = views.order_events(spark, folder)
    acts = (
        views.order_bills(spark, folder)
        .groupBy("event_id")
        .agg(
            F.array_sort(
                F.collect_list(F.struct("billing_order", "attraction_id", "performer_name"))
            ).alias("acts")
        )
    )
    attractions = F.transform(
        "acts", lambda a: F.struct(a["attraction_id"].alias("id"), a["performer_name"].alias("name"))
    )
    payload = F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.col("event_name").alias("name"),
        F.struct(
            F.struct(
                F.when(F.col("tm_genre") == "5-LOW", "unknown")
                .otherwise(F.col("event_date").cast("string"))
                .alias("localDate"),
                F.col("local_time").alias("localTime"),
            ).alias("start"),
            F.struct(F.col("status").alias("code")).alias("status"),
        ).alias("dates"),
        F.when(
            F.col("min_price").isNotNull(),
            F.array(
                F.struct(
                    F.col("min_price").alias("min"), F.col("max_price").alias("max"), "currency"
                )
            ),
        ).alias("priceRanges"),
        F.struct(
            F.array(
                F.struct(
                    F.when(F.col("tm_genre") != "2-HIGH", F.col("venue")).alias("name"),
                    F.struct(F.lit("1 Main St").alias("line1")).alias("address"),
                    F.struct(F.col("city").alias("name")).alias("city"),
                )
            ).alias("venues"),
            attractions.alias("attractions"),
        ).alias("_embedded"),
    )
    return events.join(acts, "event_id", "left").select(
        F.try_parse_json(F.to_json(F.struct(payload.alias("payload")))).alias("raw")
    )


def variant_events(spark: SparkSession, folder: str) -> DataFrame:
    return landing.bookable(landing.parse_events(event_lines(spark, folder))).select(
        F.col("event_id").cast("bigint").alias("event_id"),
        "event_name",
        "event_date",
        "status",
        "venue",
        "city",
        "min_price",
        "max_price",
        "currency",
    )


def variant_explode_bill(spark: SparkSession, folder: str) -> DataFrame:
    return landing.parse_bills(event_lines(spark, folder)).select(
        F.col("event_id").cast("bigint").alias("event_id"),
        "billing_order",
        "attraction_id",
        "performer_name",
        "performer_mbid",
    )


def parsed_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Events as parsed snapshot rows: several rows share a (name, day), under ID and name keys."""
    names = views.table(spark, folder, "part").select(
        F.col("p_partkey").alias("user_id"), "p_name", "p_type"
    )
    raw = F.try_parse_json("props")
    return (
        views.table(spark, folder, "events")
        .join(names, "user_id")
        .withColumn("raw", raw)
        .select(
            F.when(
                F.col("value") > 10, F.concat(F.lit("mbid:u"), "user_id")
            )
            .otherwise(F.concat(F.lit("name:"), "p_name"))
            .alias("artist_key"),
            F.when(F.col("value") > 20, F.upper("p_name")).otherwise(F.col("p_name")).alias("name"),
            F.col("user_id").cast("string").alias("mbid"),
            F.to_date("ts").alias("snapshot_date"),
            F.when(F.col("event_type") != "error", variants.at("raw", "$.k", "bigint")).alias(
                "lastfm_listeners"
            ),
            F.col("event_id").alias("lastfm_playcount"),
            F.array("p_type").alias("tags"),
            (F.col("value") > 50).alias("on_tour"),
            F.concat(F.lit("https://example.com/"), "event_id").alias("lastfm_url"),
            F.concat(
                F.lit(" About "), "p_name", F.lit(' <a href="x">Read more</a>. ')
            ).alias("bio_summary_html"),
            F.array("p_name").alias("similar_names"),
            F.col("ts").alias("fetched_at"),
        )
    )


def dedupe_latest(spark: SparkSession, folder: str) -> DataFrame:
    return latest.artist_daily(parsed_snapshots(spark, folder)).drop("tags")


def profile_latest(spark: SparkSession, folder: str) -> DataFrame:
    parsed = parsed_snapshots(spark, folder)
    return latest.artist_profile(parsed, latest.artist_daily(parsed)).drop("tags", "similar_names")


def resolve_chart_names(spark: SparkSession, folder: str) -> DataFrame:
    """Chart rows keyed by their own names, resolved to the profile's keys ignoring case."""
    parsed = parsed_snapshots(spark, folder)
    profile = latest.artist_profile(parsed, latest.artist_daily(parsed))
    parts = views.table(spark, folder, "part").select(
        F.concat(F.lit("user:"), "p_partkey").alias("artist_key"), "p_name", "p_size"
    )
    charts = (
        views.user_charts(spark, folder)
        .join(parts, "artist_key")
        .select(
            "snapshot_date",
            "country",
            "rank",
            F.col("artist_key").alias("chart_artist_key"),
            F.when(F.col("p_size") > 40, F.concat("p_name", F.lit(" live")))
            .otherwise(F.initcap("p_name"))
            .alias("name"),
            "country_listeners",
            F.lit("2024-02-01T00:00:00").alias("fetched_at"),
        )
    )
    return latest.resolve_chart_names(charts, profile)


def latest_day_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.table(spark, folder, "events").withColumn("snapshot_date", F.to_date("ts"))
    return latest.on_latest_day(rows).select("event_id", "snapshot_date")


def export_last_n_days(spark: SparkSession, folder: str) -> DataFrame:
    """Last 30 shipping days that have rows, not calendar days."""
    rows = (
        views.table(spark, folder, "lineitem")
        .groupBy(F.to_date("l_shipdate").alias("snapshot_date"))
        .agg(F.count("*").alias("lines"))
    )
    return latest.since_nth_latest_day(rows, 30)


def export_meta(spark: SparkSession, folder: str) -> DataFrame:
    tables = {n: views.table(spark, folder, n) for n in ("part", "orders", "events", "customer")}
    return export.export_meta(tables, "files").select("table_name", "row_count", "source")


def csv_array_reload(spark: SparkSession, folder: str) -> DataFrame:
    out = scratch_path(spark, "export")
    signals = views.catalog_signals(spark, folder).select(
        "artist_key", "name", "tags", "chart_countries", "breakout_score"
    )
    export.arrays_as_json(signals).write.options(**export.CSV_OPTIONS).csv(
        f"{out}/artist_signals.csv"
    )
    schema = "artist_key STRING, name STRING, tags STRING, chart_countries STRING, breakout_score DOUBLE"
    back = export.read_table(spark, out, "artist_signals", schema)
    return back.select(
        "artist_key",
        "name",
        "breakout_score",
        F.element_at("tags", 2).alias("second_tag"),
        F.size("tags").alias("n_tags"),
        F.array_join("chart_countries", "|").alias("chart_countries"),
    )


def utc_export(spark: SparkSession, folder: str) -> DataFrame:
    zoned = views.table(spark, folder, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("exported_at")
    )
    return export.utc_times(zoned)


def error_rate(spark: SparkSession, folder: str) -> DataFrame:
    lookups = views.table(spark, folder, "events").select(F.col("event_type").alias("status"))
    return landing.error_rate(lookups).withColumn("error_rate", F.round("error_rate", 6))


def update_matched(spark: SparkSession, folder: str) -> DataFrame:
    """Orders whose status is pending take the status and price of a later correction."""
    orders = views.table(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice"
    )
    fixes = (
        views.table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.max("l_linestatus").alias("o_orderstatus"), F.max("l_extendedprice").alias("o_totalprice")
        )
    )
    return catalog.update_matched(orders, fixes, "o_orderkey", ["o_orderstatus", "o_totalprice"])


def rebuilt(spark: SparkSession, folder: str) -> catalog.Names:
    """Parts saved as a described catalog table, twice, in schemas of their own."""
    names = catalog.Names(prefix=f"upswell_{uuid.uuid4().hex[:8]}_")
    catalog.create_schemas(spark, names, scratch_path(spark, "warehouse"))
    parts = views.table(spark, folder, "part")
    catalog.rebuild(parts.select("p_partkey"), names("gold", "parts"))
    catalog.rebuild(
        parts.select("p_partkey", "p_name", "p_size"),
        names("gold", "parts"),
        "One row per part",
        {"p_partkey": "The part's number", "p_size": "Size, 1 to 50"},
    )
    return names


def rebuild_table(spark: SparkSession, folder: str) -> DataFrame:
    return spark.table(rebuilt(spark, folder)("gold", "parts"))


def table_comments(spark: SparkSession, folder: str) -> DataFrame:
    return catalog.descriptions(spark, rebuilt(spark, folder)("gold", "parts"))


def saved_view(spark: SparkSession, folder: str) -> DataFrame:
    names = rebuilt(spark, folder)
    catalog.save_view(
        f"SELECT p_name, count(*) AS parts FROM {names('gold', 'parts')} GROUP BY p_name",
        spark,
        names("gold", "part_names"),
    )
    return spark.table(names("gold", "part_names"))


def export_history(spark: SparkSession, folder: str) -> DataFrame:
    history = growth_history(
        views.user_daily(spark, folder),
        {"lastfm_listeners": "listeners_change", "lastfm_playcount": "playcount_change"},
    )
    return export.prepare("artist_growth_history", history, history_days=10)


def missing_days(spark: SparkSession, folder: str) -> DataFrame:
    """Days with orders that no line shipped on: the set difference of two tables' days."""
    ordered = views.table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("day"))
    shipped = views.table(spark, folder, "lineitem").select(F.to_date("l_shipdate").alias("day"))
    return landing.days_to_load(ordered, shipped, 0)


QUERIES = {
    "rebuild_table": rebuild_table,
    "table_comments": table_comments,
    "saved_view": saved_view,
    "export_history": export_history,
    "missing_days": missing_days,
    "raw_roundtrip": raw_roundtrip,
    "day_replace": day_replace,
    "stream_ingest": stream_ingest,
    "typed_landing": typed_landing,
    "landing_contracts": landing_contracts,
    "landing_kept": landing_kept,
    "dataset_replace": dataset_replace,
    "days_to_load": days_to_load,
    "variant_extract": variant_extract,
    "variant_array_shapes": variant_array_shapes,
    "variant_events": variant_events,
    "variant_explode_bill": variant_explode_bill,
    "dedupe_latest": dedupe_latest,
    "profile_latest": profile_latest,
    "resolve_chart_names": resolve_chart_names,
    "latest_day_rows": latest_day_rows,
    "export_last_n_days": export_last_n_days,
    "export_meta": export_meta,
    "csv_array_reload": csv_array_reload,
    "utc_export": utc_export,
    "error_rate": error_rate,
    "update_matched": update_matched,
}
