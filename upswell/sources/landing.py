"""Daily JSON-lines snapshots: ``<root>/<dataset>/dt=YYYY-MM-DD/*`` into a raw VARIANT table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from upswell import folders, settings
from upswell.functions.variants import at, date_at, number_at, strings_at, text_at
from upswell.operators.latest import on_latest_day, one_per

# --- fixed values: landing record contracts ---
ARTIST_ROW = """source STRING, snapshot_date STRING, fetched_at STRING, artist_key STRING,
  name STRING, payload STRUCT<name STRING, mbid STRING,
  stats STRUCT<listeners STRING, playcount STRING>, ontour STRING, url STRING,
  bio STRUCT<summary STRING>>"""
CHART_ROW = """snapshot_date STRING, fetched_at STRING, country STRING, rank INT,
  artist_key STRING, name STRING, mbid STRING, listeners BIGINT"""
SIMILAR_ROW = "from_key STRING, to_key STRING, to_name STRING, match DOUBLE"
EVENT_ROW = """source STRING, snapshot_date STRING, fetched_at STRING, city STRING,
  country STRING, payload STRUCT<id STRING, name STRING, url STRING,
  dates STRUCT<start STRUCT<localDate STRING, localTime STRING>, status STRUCT<code STRING>>,
  priceRanges ARRAY<STRUCT<min DOUBLE, max DOUBLE, currency STRING>>>"""

# The declared types of a line and the fields it is of no use without.
CONTRACTS = {
    "artist": (ARTIST_ROW, ("artist_key", "payload.name")),
    "chart": (CHART_ROW, ("country", "rank", "name")),
    "edge": (SIMILAR_ROW, ("from_key", "to_key")),
    "event": (EVENT_ROW, ("payload.id",)),
}


def write_landing(df: DataFrame, root: str, dataset: str, day: str = "snapshot_date") -> None:
    """One JSON line per row under its day's folder. Days present are replaced, others kept."""
    (
        df.withColumn("dt", F.date_format(day, "yyyy-MM-dd"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dt")
        .json(f"{root}/{dataset}")
    )


def landed_days(spark: SparkSession, root: str, dataset: str) -> list[str]:
    """Days that have a folder, oldest first; other names are ignored, a missing dataset is
    empty. Lists folder names only, so it costs one directory listing however much landed."""
    return folders.values(spark, f"{root}/{dataset}", "dt")


def days_to_load(
    landed: DataFrame, loaded: DataFrame, reload_recent: int = settings.RELOAD_RECENT_DAYS
) -> DataFrame:
    """Landed days not loaded yet, and always the newest few. One ``day`` column each."""
    days = landed.select("day").distinct()
    recent = days.orderBy(F.col("day").desc()).limit(reload_recent)
    return days.join(loaded.select("day").distinct(), "day", "left_anti").union(recent).distinct()


def read_landed(
    spark: SparkSession, root: str, dataset: str, days: Sequence[str] | None = None
) -> DataFrame:
    """Whole lines as VARIANT. A line that is not JSON keeps a NULL ``raw`` and its text in
    ``_bad_line``, so a broken line is counted rather than failing the load."""
    base = f"{root}/{dataset}"
    days = landed_days(spark, root, dataset) if days is None else days
    lines = spark.read.option("basePath", base).text([f"{base}/dt={d}" for d in days])
    raw = F.try_parse_json("value")
    return lines.select(
        F.to_date("dt").alias("snapshot_date"),
        raw.alias("raw"),
        F.col("_metadata.file_path").alias("_source_file"),
        F.current_timestamp().alias("_ingested_at"),
        F.when(raw.isNull(), F.col("value")).alias("_bad_line"),
    )


def replace_days(df: DataFrame, path: str, day: str = "snapshot_date", days: Sequence[str] = ()) -> None:
    """Replace the days present in ``df``; repeating it changes nothing. Of ``days``, those that gave
    no row lose what they had, so a day reloaded as empty is empty."""
    seen = Observation()
    (
        df.observe(seen, F.collect_set(F.col(day).cast("string")).alias("days"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )
    for d in set(days) - set(seen.get["days"]):
        folders.delete(df.sparkSession, f"{path}/{day}={d}")


def loaded_days(spark: SparkSession, path: str, day: str = "snapshot_date") -> list[str]:
    """Days of a raw table, read from its partition folders."""
    return folders.values(spark, path, day)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """A raw table; empty while nothing has landed for it."""
    if loaded_days(spark, path):
        return spark.read.parquet(path)
    return spark.sql(
        """SELECT CAST(NULL AS DATE) AS snapshot_date, parse_json('null') AS raw,
                  '' AS _source_file, current_timestamp() AS _ingested_at, '' AS _bad_line
           LIMIT 0"""
    )


def ingest(
    spark: SparkSession,
    root: str,
    dataset: str,
    path: str,
    reload_recent: int = settings.RELOAD_RECENT_DAYS,
) -> list[str]:
    """Load what is missing plus the newest days, all in one job. Returns the days loaded; a
    day list is as long as the calendar, so it may pass through the driver."""
    landed = landed_days(spark, root, dataset)
    recent = landed[len(landed) - min(reload_recent, len(landed)) :]
    todo = sorted((set(landed) - set(loaded_days(spark, path))) | set(recent))
    if todo:
        replace_days(read_landed(spark, root, dataset, todo), path, days=todo)
    return todo


def read_pool(spark: SparkSession, file: str) -> DataFrame:
    """The current candidate pool, one line per member."""
    return spark.read.text(file).select(
        F.try_parse_json("value").alias("raw"), F.current_timestamp().alias("_ingested_at")
    )


def replace_pool(spark: SparkSession, file: str, path: str) -> None:
    """The current candidate pool is one dataset, replaced whole."""
    read_pool(spark, file).write.mode("overwrite").parquet(path)


def typed(lines: DataFrame, contract: str, text: str = "value") -> DataFrame:
    """The typed route beside VARIANT: one struct per line, fields as columns."""
    return lines.select(F.from_json(text, contract).alias("row")).select("row.*")


def against_contract(lines: DataFrame, contract: str, text: str = "value") -> DataFrame:
    """Each line, typed as ``row``, and its ``problem`` with one of the CONTRACTS: text that is not
    JSON, a value of another type, or the first needed field that is missing; NULL for a line that
    keeps the contract. Fields beyond the contract are no problem, blank lines are not JSON."""
    fields, needed = CONTRACTS[contract]
    read = F.from_json(text, f"{fields}, _broken STRING", {"columnNameOfCorruptRecord": "_broken"})
    missing = [F.when(F.col(f"row.{f}").isNull(), F.lit(f"missing {f}")) for f in needed]
    problem = (
        F.when(F.try_parse_json(text).isNull(), F.lit("not JSON"))
        .when(F.col("row._broken").isNotNull(), F.lit("wrong type"))
        .otherwise(F.coalesce(*missing))
    )
    return lines.withColumn("row", read).withColumn("problem", problem)


def split_landing(lines: DataFrame, contract: str, text: str = "value") -> tuple[DataFrame, DataFrame]:
    """The typed rows that keep a contract, and the quarantine: other lines as they came, each with
    its problem. No line is in both or in neither."""
    checked = against_contract(lines, contract, text)
    kept = checked.filter("problem IS NULL").select("row.*").drop("_broken")
    return kept, checked.filter("problem IS NOT NULL").drop("row")


def contract_counts(lines: DataFrame, contract: str, text: str = "value") -> DataFrame:
    """Lines by problem, those without one included: ``contract``, ``problem``, ``lines``."""
    checked = against_contract(lines, contract, text)
    return checked.groupBy("problem").agg(F.count("*").alias("lines")).withColumn("contract", F.lit(contract))


def parse_artists(bronze: DataFrame) -> DataFrame:
    """Artist lines, typed. Persist the result: both the daily and the profile table read it."""
    return bronze.select(
        "snapshot_date",
        at("raw", "$.artist_key").alias("artist_key"),
        at("raw", "$.payload.name").alias("name"),
        text_at("raw", "$.payload.mbid").alias("mbid"),
        number_at("raw", "$.payload.stats.listeners").alias("lastfm_listeners"),
        number_at("raw", "$.payload.stats.playcount").alias("lastfm_playcount"),
        strings_at("raw", "$.payload.tags.tag", "name").alias("tags"),
        (at("raw", "$.payload.ontour") == "1").alias("on_tour"),
        at("raw", "$.payload.url").alias("lastfm_url"),
        at("raw", "$.payload.bio.summary").alias("bio_summary_html"),
        strings_at("raw", "$.payload.similar.artist", "name").alias("similar_names"),
        at("raw", "$.fetched_at", "timestamp").alias("fetched_at"),
    )


def parse_charts(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "snapshot_date",
        at("raw", "$.country").alias("country"),
        at("raw", "$.rank", "int").alias("rank"),
        at("raw", "$.artist_key").alias("chart_artist_key"),
        at("raw", "$.name").alias("name"),
        at("raw", "$.listeners", "bigint").alias("country_listeners"),
        at("raw", "$.fetched_at").alias("fetched_at"),
    )


def parse_edges(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "snapshot_date",
        at("raw", "$.from_key").alias("from_key"),
        at("raw", "$.to_key").alias("to_key"),
        at("raw", "$.to_name").alias("to_name"),
        at("raw", "$.match", "double").alias("match"),
    )


def latest_events(bronze: DataFrame) -> DataFrame:
    """Newest pull only, one line per event ID. The winner is picked on two short columns of
    text before the payload is looked into further."""
    return one_per(
        on_latest_day(bronze).select(
            "raw",
            at("raw", "$.payload.id").alias("_id"),
            at("raw", "$.fetched_at").alias("_fetched"),
        ),
        ["_id"],
        [F.col("_fetched").desc()],
    ).select("raw")


def parse_events(lines: DataFrame, payload: str = "$.payload") -> DataFrame:
    """One row per event line. A missing venue name falls back to its street line."""
    venue, price = f"{payload}._embedded.venues[0]", f"{payload}.priceRanges[0]"
    return lines.select(
        at("raw", f"{payload}.id").alias("event_id"),
        at("raw", f"{payload}.name").alias("event_name"),
        date_at("raw", f"{payload}.dates.start.localDate").alias("event_date"),
        at("raw", f"{payload}.dates.start.localTime").alias("local_time"),
        at("raw", f"{payload}.dates.status.code").alias("status"),
        F.coalesce(text_at("raw", f"{venue}.name"), at("raw", f"{venue}.address.line1")).alias(
            "venue"
        ),
        at("raw", f"{venue}.id").alias("venue_id"),
        at("raw", f"{venue}.city.name").alias("city"),
        at("raw", f"{payload}.classifications[0].genre.name").alias("tm_genre"),
        at("raw", f"{payload}.classifications[0].subGenre.name").alias("tm_subgenre"),
        at("raw", f"{price}.min", "double").alias("min_price"),
        at("raw", f"{price}.max", "double").alias("max_price"),
        at("raw", f"{price}.currency").alias("currency"),
        at("raw", f"{payload}.url").alias("ticket_url"),
    )


def bookable(events: DataFrame) -> DataFrame:
    """Drop events without a valid date and canceled ones; an unknown status stays."""
    canceled = F.coalesce(F.col("status").isin(*settings.CANCELED), F.lit(False))
    return events.filter(F.col("event_date").isNotNull() & ~canceled)


def parse_bills(lines: DataFrame, payload: str = "$.payload") -> DataFrame:
    """One row per billed act, 0 = headliner; an act without an ID goes by its name."""
    acts = at("raw", f"{payload}._embedded.attractions", "array<variant>")
    name = at("act", "$.name")
    return lines.select(
        at("raw", f"{payload}.id").alias("event_id"), F.posexplode(acts).alias("billing_order", "act")
    ).select(
        "event_id",
        "billing_order",
        F.coalesce(text_at("act", "$.id"), name).alias("attraction_id"),
        name.alias("performer_name"),
        text_at("act", "$.externalLinks.musicbrainz[0].id").alias("performer_mbid"),
    )


def error_rate(lookups: DataFrame, status: str = "status") -> DataFrame:
    """Share of failed lookups and whether the run is too incomplete to keep: columns
    ``lookups``, ``errors``, ``error_rate``, ``incomplete``."""
    total, errors = F.count("*"), F.count_if(F.col(status) == "error")
    return lookups.agg(
        total.alias("lookups"),
        errors.alias("errors"),
        (errors / F.nullif(total, F.lit(0))).alias("error_rate"),
        F.coalesce(errors / F.nullif(total, F.lit(0)) > settings.MAX_ERROR_RATE, F.lit(False)).alias(
            "incomplete"
        ),
    )


def only_parsed(bronze: DataFrame) -> DataFrame:
    return bronze.filter(F.col("raw").isNotNull())
