"""The library's roles played by the supplied star-schema tables (whole tables, no samples).

Each function takes (spark, folder) and derives a frame shaped like the real input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from upswell.functions.numbers import size_band
from upswell.operators.growth import chart_positions

USER_BANDS = ((0, "<60"), (60, "60-70"), (70, "70-80"), (80, "80+"))
PART_BANDS = ((0, "<100"), (100, "100-250"), (250, "250-400"), (400, "400+"))
POLLED_DAYS = 30


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def running(df: DataFrame, keys: list[str], day: str, totals: dict[str, str]) -> DataFrame:
    upto = (
        Window.partitionBy(*keys)
        .orderBy(day)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return df.select(*keys, day, *[F.sum(c).over(upto).alias(name) for name, c in totals.items()])


def part_tags():
    return F.concat(F.array("p_type", "p_brand"), F.split("p_name", " "))


def user_daily(spark: SparkSession, folder: str) -> DataFrame:
    """Users as entities: running event count and value (in cents) per day with any event."""
    per_day = (
        table(spark, folder, "events")
        .groupBy("user_id", F.to_date("ts").alias("snapshot_date"))
        .agg(
            F.count("*").alias("n"),
            F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("cents"),
        )
    )
    totals = running(
        per_day, ["user_id"], "snapshot_date", {"lastfm_listeners": "n", "lastfm_playcount": "cents"}
    )
    names = table(spark, folder, "part").select(F.col("p_partkey").alias("user_id"), "p_name")
    return totals.join(names, "user_id", "left").select(
        F.concat(F.lit("user:"), F.col("user_id")).alias("artist_key"),
        F.coalesce("p_name", F.concat(F.lit("user "), F.col("user_id"))).alias("name"),
        "snapshot_date",
        "lastfm_listeners",
        "lastfm_playcount",
    )


def user_charts(spark: SparkSession, folder: str, top: int = 10) -> DataFrame:
    """Per day and event type (as the country), the ten users with most events."""
    counts = (
        table(spark, folder, "events")
        .groupBy(F.to_date("ts").alias("snapshot_date"), F.col("event_type").alias("country"), "user_id")
        .agg(F.count("*").alias("n"))
    )
    return chart_positions(
        counts, ["snapshot_date", "country"], [F.col("n").desc(), F.col("user_id")], top
    ).select(
        "snapshot_date",
        "country",
        "rank",
        F.concat(F.lit("user:"), F.col("user_id")).alias("artist_key"),
        F.col("n").alias("country_listeners"),
    )


def user_profile(spark: SparkSession, folder: str) -> DataFrame:
    """The part with the user's number lends its name and tags; similar names hold a restyled
    spelling for one brand, so those users read as aliases."""
    restyled = F.initcap(F.replace(F.col("p_name"), F.lit("e"), F.lit("é")))
    return table(spark, folder, "part").select(
        F.concat(F.lit("user:"), F.col("p_partkey")).alias("artist_key"),
        F.col("p_name").alias("name"),
        part_tags().alias("tags"),
        (F.col("p_size") > 25).alias("on_tour"),
        F.concat(F.lit("https://example.com/"), F.col("p_partkey")).alias("lastfm_url"),
        F.when(
            F.col("p_brand") == "Brand#13", F.array(F.lit("another act"), F.col("p_name"), restyled)
        )
        .otherwise(F.array(F.lit("another act"), F.col("p_name")))
        .alias("similar_names"),
    )


def part_polled(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as entities polled on each of the last 30 days: totals of all shipped quantity up to
    that day (plays) and of the returned part of it (listeners). Most stand still most days."""
    items = table(spark, folder, "lineitem").select(
        "l_partkey",
        F.to_date("l_shipdate").alias("day"),
        F.col("l_quantity").cast("bigint").alias("q"),
        (F.col("l_returnflag") == "R").alias("returned"),
    )
    last = items.select(F.max("day")).scalar()
    first = F.date_sub(last, POLLED_DAYS - 1)
    moved = items.groupBy(
        "l_partkey", F.greatest("day", first).alias("snapshot_date")
    ).agg(
        F.sum(F.when(F.col("returned"), F.col("q")).otherwise(0)).alias("returned_q"),
        F.sum("q").alias("q"),
    )
    grid = table(spark, folder, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        "p_name",
        F.explode(F.sequence(first, last)).alias("snapshot_date"),
    )
    filled = grid.join(moved, ["l_partkey", "snapshot_date"], "left").na.fill(
        0, ["q", "returned_q"]
    )
    return running(
        filled,
        ["l_partkey", "p_name"],
        "snapshot_date",
        {"lastfm_listeners": "returned_q", "lastfm_playcount": "q"},
    ).select(
        F.concat(F.lit("part:"), F.col("l_partkey")).alias("artist_key"),
        F.col("p_name").alias("name"),
        "snapshot_date",
        "lastfm_listeners",
        "lastfm_playcount",
    )


def supplier_charts(spark: SparkSession, folder: str, top: int = 100) -> DataFrame:
    """Parts charting per polled day and return flag, by quantity shipped that day."""
    items = table(spark, folder, "lineitem").select(
        "l_partkey",
        F.to_date("l_shipdate").alias("snapshot_date"),
        F.col("l_returnflag").alias("country"),
        F.col("l_quantity").cast("bigint").alias("q"),
    )
    last = items.select(F.max("snapshot_date")).scalar()
    counts = (
        items.filter(F.col("snapshot_date") >= F.date_sub(last, POLLED_DAYS - 1))
        .groupBy("snapshot_date", "country", "l_partkey")
        .agg(F.sum("q").alias("q"))
    )
    return chart_positions(
        counts, ["snapshot_date", "country"], [F.col("q").desc(), F.col("l_partkey")], top
    ).select(
        "snapshot_date",
        "country",
        "rank",
        F.concat(F.lit("part:"), F.col("l_partkey")).alias("artist_key"),
    )


def catalog_signals(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as an already scored signals table: price gives the score, size the audience."""
    size = (F.col("p_size") * F.col("p_size")).cast("bigint")
    listeners = size * size
    return table(spark, folder, "part").select(
        F.concat(F.lit("mbid:p"), F.col("p_partkey")).alias("artist_key"),
        F.concat_ws(" ", "p_name", "p_brand", F.col("p_size").cast("string")).alias("name"),
        F.lit("2001-05-15").cast("date").alias("as_of_date"),
        F.array_join(F.slice(part_tags(), 1, 3), ", ").alias("genres"),
        part_tags().alias("tags"),
        listeners.alias("lastfm_listeners"),
        (listeners * 7).alias("lastfm_playcount"),
        size_band(listeners).alias("size_band"),
        F.when(F.col("p_type") != "PROMO", F.round(F.col("p_retailprice") - 900, 1)).alias(
            "breakout_score"
        ),
        F.round((F.col("p_retailprice") - 940) / 7, 3).alias("listeners_7d_growth_pct"),
        F.round((F.col("p_retailprice") - 930) / 5, 3).alias("listeners_14d_growth_pct"),
        (F.col("p_size") % 9).alias("growth_window_days"),
        (F.col("p_size") % 9 < 7).alias("is_provisional"),
        (F.col("p_size") % 3).alias("new_country_charts_14d"),
        F.when(F.col("p_size") < 20, F.array(F.lit("Brazil"), F.lit("Canada")))
        .when(F.col("p_size") < 30, F.array(F.lit("Canada")))
        .otherwise(F.array().cast("array<string>"))
        .alias("chart_countries"),
        (F.col("p_size") > 25).alias("on_tour"),
        F.concat(F.lit("https://example.com/"), F.col("p_partkey")).alias("lastfm_url"),
        F.when(F.col("p_brand") == "Brand#13", F.col("p_name")).alias("possible_alias_of"),
    )


def order_events(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as events: the customer's nation is the city (urgent orders spell it in lower
    case), unspecified priority has no listed price, pending orders are canceled."""
    cities = (
        table(spark, folder, "customer")
        .join(
            table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
        )
        .select(F.col("c_custkey").alias("o_custkey"), "n_name")
    )
    urgent = F.col("o_orderpriority") == "1-URGENT"
    unpriced = F.col("o_orderpriority") == "4-NOT SPECIFIED"
    price = F.round(F.col("o_totalprice") / 10000, 2)
    return table(spark, folder, "orders").join(cities, "o_custkey").select(
        F.col("o_orderkey").alias("event_id"),
        F.concat(F.lit("Order "), F.col("o_orderkey")).alias("event_name"),
        F.to_date("o_orderdate").alias("event_date"),
        F.lit("20:00:00").alias("local_time"),
        F.when(F.col("o_orderstatus") == "O", "onsale")
        .when(F.col("o_orderstatus") == "F", "offsale")
        .otherwise("canceled")
        .alias("status"),
        F.concat(F.lit("Venue "), F.col("o_custkey")).alias("venue"),
        F.when(urgent, F.lower("n_name")).otherwise(F.col("n_name")).alias("city"),
        F.when(~unpriced, price).alias("min_price"),
        F.when(~unpriced, price * 2).alias("max_price"),
        F.when(~unpriced, "CAD").alias("currency"),
        F.concat(F.lit("https://example.com/o/"), F.col("o_orderkey")).alias("ticket_url"),
        F.col("o_orderpriority").alias("tm_genre"),
    )


def order_bills(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as the bill, every line an act: the first headlines. Line numbers repeat within an
    order, so part and ship date break ties."""
    order = ["l_linenumber", "l_partkey", "l_shipdate", "l_extendedprice"]
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*order))
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("event_id"),
        (place - 1).alias("billing_order"),
        F.concat(F.lit("p"), F.col("l_partkey")).alias("attraction_id"),
        F.concat(F.lit("Part "), F.col("l_partkey")).alias("performer_name"),
    )


def bill_matches(spark: SparkSession, folder: str) -> DataFrame:
    """Each part as a matched performer; the method follows its type."""
    method = (
        F.when(F.col("p_type") == "STANDARD", "review")
        .when(F.col("p_type") == "SMALL", "fuzzy")
        .when(F.col("p_type") == "ECONOMY", "exact")
        .otherwise("mbid")
    )
    return table(spark, folder, "part").select(
        F.concat(F.lit("p"), F.col("p_partkey")).alias("attraction_id"),
        F.concat(F.lit("Part "), F.col("p_partkey")).alias("performer_name"),
        F.concat(F.lit("mbid:p"), F.col("p_partkey")).alias("artist_key"),
        F.concat_ws(" ", "p_name", "p_brand", F.col("p_size").cast("string")).alias("artist_name"),
        F.lit(100.0).alias("match_score"),
        method.alias("match_method"),
    )


def listening(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as listeners: quantity bought per part, all time and in the last 90 days.
    Columns user, period, name, mbid, playcount."""
    bought = (
        table(spark, folder, "lineitem")
        .select("l_orderkey", "l_partkey", F.col("l_quantity").cast("bigint").alias("q"))
        .join(
            table(spark, folder, "orders").select(
                F.col("o_orderkey").alias("l_orderkey"),
                "o_custkey",
                F.to_date("o_orderdate").alias("day"),
            ),
            "l_orderkey",
        )
    )
    last = table(spark, folder, "orders").select(F.to_date(F.max("o_orderdate"))).scalar()
    recent = F.col("day") > F.date_sub(last, 90)
    plays = bought.groupBy("o_custkey", "l_partkey").agg(
        F.sum("q").alias("overall"), F.sum(F.when(recent, F.col("q"))).alias("recent")
    )
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        F.concat_ws(" ", "p_name", "p_brand", F.col("p_size").cast("string")).alias("name"),
        # Some listeners' apps know the ID, the rest send a name only.
        F.when(F.col("p_type") != "LARGE", F.concat(F.lit("p"), F.col("p_partkey"))).alias("mbid"),
    )
    return (
        plays.join(parts, "l_partkey")
        .select(
            F.col("o_custkey").alias("user"),
            "name",
            "mbid",
            F.explode(
                F.array(
                    F.struct(F.lit("overall").alias("period"), F.col("overall").alias("plays")),
                    F.struct(F.lit("3month").alias("period"), F.col("recent").alias("plays")),
                )
            ).alias("p"),
        )
        .select("user", "p.period", "name", "mbid", F.col("p.plays").alias("playcount"))
        .filter("playcount IS NOT NULL")
    )


def similar_edges(spark: SparkSession, folder: str) -> DataFrame:
    """A weighted graph over parts: each line links its part to the part numbered like its
    supplier; the total quantity gives the strength, 0 to 1."""
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("l_suppkey"), F.col("p_name").alias("to_name")
    )
    return (
        table(spark, folder, "lineitem")
        .filter("l_partkey <> l_suppkey")
        .groupBy("l_partkey", "l_suppkey")
        .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("q"))
        .join(parts, "l_suppkey")
        .select(
            F.concat(F.lit("mbid:p"), F.col("l_partkey")).alias("from_key"),
            F.concat(F.lit("mbid:p"), F.col("l_suppkey")).alias("to_key"),
            "to_name",
            F.least(F.col("q") / 128, F.lit(1.0)).alias("match"),
        )
    )


def title_performers(spark: SparkSession, folder: str) -> DataFrame:
    """Page titles as billed names; the kind of address decides how the name is spelled."""
    title = F.regexp_extract("html", "<title>(.*?)</title>", 1)
    spelled = (
        F.when(F.col("url").contains("utm_source"), F.regexp_replace("title", "^(.*?)e", "$1"))
        .when(F.col("url").contains("?page"), F.concat(F.lit("The "), "title"))
        .when(F.col("url").endswith("/"), F.concat("title", F.lit(" Tribute")))
        .when(F.col("url").endswith(".html"), F.translate("title", "or", ""))
        .when(F.col("url").contains("#top"), F.array_join(F.reverse(F.split("title", " ")), " "))
        .otherwise(F.col("title"))
    )
    return (
        table(spark, folder, "pages")
        .select("page_id", "url", title.alias("title"))
        .select(
            F.concat(F.lit("a"), "page_id").alias("attraction_id"),
            spelled.alias("performer_name"),
            F.when(F.col("url").contains("://blog."), F.concat(F.lit("T"), "page_id")).alias(
                "performer_mbid"
            ),
            F.col("page_id").alias("event_id"),
        )
    )


def title_artists(spark: SparkSession, folder: str) -> DataFrame:
    """Titles of all pages as the tracked names, without their junk signs."""
    title = F.regexp_extract("html", "<title>(.*?)</title>", 1)
    return (
        table(spark, folder, "pages")
        .select(
            F.concat(F.lit("art:"), "page_id").alias("artist_key"),
            F.regexp_replace(title, "[*#%$]", "").alias("name"),
            F.concat(F.lit("t"), "page_id").alias("mbid"),
        )
    )


def tracked_signals(spark: SparkSession, folder: str) -> DataFrame:
    """Scored parts that are tracked (every type but MEDIUM), with finer tags for taste."""
    words = F.split("p_name", " ")
    tags = table(spark, folder, "part").select(
        F.concat(F.lit("mbid:p"), "p_partkey").alias("artist_key"),
        F.array(
            F.concat_ws(" ", words[0], F.col("p_brand")),
            F.lit("Seen Live"),
            F.concat_ws(" ", words[1], F.col("p_size").cast("string")),
            F.concat_ws(" ", F.col("p_type"), F.col("p_brand")),
        ).alias("tags"),
    )
    return (
        catalog_signals(spark, folder)
        .filter("NOT startswith(genres, 'MEDIUM')")
        .drop("tags")
        .join(tags, "artist_key")
    )


def pool_members(spark: SparkSession, folder: str) -> DataFrame:
    """Economy parts as the pool so far."""
    return table(spark, folder, "part").filter("p_type = 'ECONOMY'").select(
        F.concat(F.lit("mbid:p"), "p_partkey").alias("artist_key"),
        F.concat_ws(" ", "p_name", "p_brand").alias("name"),
        F.concat(F.lit("p"), "p_partkey").alias("mbid"),
        F.when(F.col("p_size") > 40, "geo:Canada")
        .when(F.col("p_size") > 30, "event:Toronto")
        .otherwise("similar:x")
        .alias("source"),
        F.lit("2001-05-01").cast("date").alias("added_date"),
        F.lit("2001-05-01").cast("date").alias("pool_date"),
    )


def pool_seeds(spark: SparkSession, folder: str) -> list[DataFrame]:
    """Two seed sources with overlaps: large parts as a chart, then promoted and small types."""
    parts = table(spark, folder, "part").select(
        F.concat(F.lit("mbid:p"), "p_partkey").alias("artist_key"),
        F.concat_ws(" ", "p_name", "p_brand").alias("name"),
        F.concat(F.lit("p"), "p_partkey").alias("mbid"),
        F.col("p_partkey").alias("position"),
        "p_size",
        "p_type",
    )
    charts = parts.filter("p_size > 35").withColumn("source", F.lit("geo:Brazil"))
    tags = parts.filter("p_type IN ('PROMO', 'SMALL')").withColumn("source", F.lit("tag:rock"))
    return [charts.drop("p_size", "p_type"), tags.drop("p_size", "p_type")]


def brief_responses(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation turns as model responses: the first on the part numbered like the conversation,
    each later one on an entity of its own; short ones came back empty, some failed."""
    turns = table(spark, folder, "conversations")
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("conv_id"), "p_name", "p_type"
    )
    section = (
        F.when(F.col("p_type") == "PROMO", F.lit("No label mentioned in the Last.fm bio (not confirmed)."))
        .when(F.col("p_type") == "SMALL", F.lit("  "))
        .otherwise(F.concat(F.lit("Signed to "), "p_name", F.lit(" – Records")))
    )
    result = F.when(
        F.length("text") >= 120,
        F.concat(
            F.lit("### Who they are\n"),
            "text",
            F.lit("\n### Signing status\n"),
            section,
            F.when(F.col("p_type") == "LARGE", "").otherwise("\n### Where\nCharts."),
        ),
    ).when(F.length("text") >= 60, F.lit("  "))
    later = F.when(F.col("turn") > 0, F.concat(F.lit(":"), "turn")).otherwise("")
    name = F.coalesce("p_name", F.concat(F.lit("Talk "), "conv_id"))
    return turns.join(parts, "conv_id", "left").withColumn("p_name", name).select(
        F.concat(F.lit("mbid:p"), "conv_id", later).alias("artist_key"),
        F.col("p_name").alias("name"),
        F.struct(
            result.alias("result"),
            F.when(F.length("text") < 60, "too short").alias("errorMessage"),
        ).alias("response"),
        F.lit("large").alias("model"),
        F.lit("2001-05-15 00:00:00").cast("timestamp_ntz").alias("generated_at"),
    )
