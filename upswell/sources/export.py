"""Column-pruned exports of the serving tables, and reading them back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, TimestampType

from upswell import settings
from upswell.operators.latest import since_nth_latest_day

# --- fixed values: columns of each exported table ---
COLUMNS = {
    "artist_signals": [
        "artist_key",
        "name",
        "as_of_date",
        "genres",
        "tags",
        "lastfm_listeners",
        "lastfm_playcount",
        "size_band",
        "breakout_score",
        "breakout_rank",
        "listeners_7d_growth_pct",
        "listeners_14d_growth_pct",
        "plays_7d_growth_pct",
        "new_listeners_7d",
        "new_country_charts_14d",
        "chart_countries",
        "listener_growth_z",
        "play_growth_z",
        "is_provisional",
        "history_days",
        "growth_window_days",
        "stats_last_changed",
        "on_tour",
        "lastfm_url",
        "possible_alias_of",
    ],
    "artist_growth_history": [
        "artist_key",
        "name",
        "snapshot_date",
        "lastfm_listeners",
        "lastfm_playcount",
        "listeners_change",
        "playcount_change",
    ],
    "upcoming_shows": [
        "event_date",
        "local_time",
        "city",
        "venue",
        "event_name",
        "event_id",
        "artist_key",
        "artist_name",
        "is_headliner",
        "breakout_score",
        "breakout_rank",
        "size_band",
        "lastfm_listeners",
        "genres",
        "listeners_7d_growth_pct",
        "is_provisional",
        "min_price",
        "max_price",
        "currency",
        "ticket_url",
        "tm_genre",
        "status",
        "match_method",
    ],
    "scout_briefs": [
        "artist_key",
        "name",
        "as_of_date",
        "brief_md",
        "signing_status",
        "label_mentioned",
        "model",
        "prompt_version",
        "generated_at",
    ],
    "artist_similar": ["from_key", "to_key", "to_name", "match"],
    "event_performers": ["event_id", "billing_order", "performer_name"],
}
CSV_OPTIONS = {"header": True, "escape": '"', "multiLine": True}  # texts hold quotes and line ends
ARRAY_COLUMNS = {"artist_signals": ("tags", "chart_countries")}


def prepare(
    name: str, df: DataFrame, history_days: int = settings.HISTORY_EXPORT_DAYS
) -> DataFrame:
    """The exported rows and columns of one table: history keeps its last days that have data,
    briefs that failed are left out, zoned times become plain UTC."""
    if name == "artist_growth_history":
        df = since_nth_latest_day(df, history_days)
    if name == "scout_briefs" and "error" in df.columns:
        df = df.filter("error IS NULL")
    return utc_times(df.select(*COLUMNS[name]))


def utc_times(df: DataFrame) -> DataFrame:
    """Zoned timestamps as their UTC wall-clock time without a zone."""
    zone = F.current_timezone()
    return df.select(
        *[
            F.to_utc_timestamp(f.name, zone).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, TimestampType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def write_export(
    tables: dict[str, DataFrame], folder: str, source: str, format: str = "parquet"
) -> DataFrame:
    """Write every table, then return the metadata rows (table, count, time, source), which are
    written last: a reader that sees them sees a whole export."""
    missing = sorted(set(COLUMNS) - set(tables))
    if missing:
        raise ValueError(f"missing tables: {missing}")
    spark = next(iter(tables.values())).sparkSession
    options = CSV_OPTIONS if format == "csv" else {}
    written = {}
    for name, df in tables.items():
        out = prepare(name, df)
        if format == "csv":
            out = arrays_as_json(out)
        path = f"{folder}/{name}.{format}"
        out.write.mode("overwrite").format(format).options(**options).save(path)
        written[name] = spark.read.format(format).options(**options).load(path)
    meta = export_meta(written, source)
    meta.write.mode("overwrite").parquet(f"{folder}/snapshot_meta.parquet")
    return spark.read.parquet(f"{folder}/snapshot_meta.parquet")


def export_meta(tables: dict[str, DataFrame], source: str) -> DataFrame:
    counts = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"),
            "row_count",
            F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
            .cast("timestamp_ntz")
            .alias("exported_at"),
            F.lit(source).alias("source"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def arrays_as_json(df: DataFrame) -> DataFrame:
    """CSV has no arrays: write them as JSON text."""
    return df.select(
        *[
            F.to_json(f.name).alias(f.name) if isinstance(f.dataType, ArrayType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def read_table(
    spark: SparkSession, folder: str, name: str, schema: str | None = None
) -> DataFrame:
    """``<name>.parquet`` if there, else ``<name>.csv`` with JSON-text arrays read back.
    ``schema`` types a CSV without a pass over the data to guess it."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()

    def exists(file: str) -> bool:
        path = jvm.org.apache.hadoop.fs.Path(file)
        return path.getFileSystem(conf).exists(path)

    if exists(f"{folder}/{name}.parquet"):
        return spark.read.parquet(f"{folder}/{name}.parquet")
    if not exists(f"{folder}/{name}.csv"):
        raise FileNotFoundError(f"expected {name}.parquet or {name}.csv in {folder}")
    reader = spark.read.options(**CSV_OPTIONS)
    df = (reader.schema(schema) if schema else reader).csv(f"{folder}/{name}.csv")
    for c in ARRAY_COLUMNS.get(name, ()):
        if c in df.columns:
            df = df.withColumn(c, F.from_json(c, "array<string>"))
    return df
