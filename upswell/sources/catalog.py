"""Schemas per layer, rebuilt tables, descriptions and saved views."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LAYERS = ("bronze", "silver", "gold")


@dataclass(frozen=True)
class Names:
    """Table names ``<prefix><layer>.<table>``; development and production differ in prefix."""

    prefix: str = ""
    catalog: str | None = None

    def schema(self, layer: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"layer must be one of {', '.join(LAYERS)}, not {layer!r}")
        return f"{self.catalog + '.' if self.catalog else ''}{self.prefix}{layer}"

    def __call__(self, layer: str, table: str) -> str:
        return f"{self.schema(layer)}.{table}"


def create_schemas(spark: SparkSession, names: Names, location: str | None = None) -> None:
    for layer in LAYERS:
        where = f" LOCATION '{location}/{names.prefix}{layer}'" if location else ""
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {names.schema(layer)}{where}")


def rebuild(
    df: DataFrame, table: str, comment: str = "", columns: dict[str, str] | None = None
) -> None:
    """Replace a table, schema included, and describe it."""
    df.write.mode("overwrite").format("parquet").saveAsTable(table)
    describe(df.sparkSession, table, comment, columns or {})


def describe(spark: SparkSession, table: str, comment: str, columns: dict[str, str]) -> None:
    def quoted(text: str) -> str:
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    if comment:
        spark.sql(f"COMMENT ON TABLE {table} IS {quoted(comment)}")
    for name, text in columns.items():
        spark.sql(f"ALTER TABLE {table} ALTER COLUMN {name} COMMENT {quoted(text)}")


def descriptions(spark: SparkSession, table: str) -> DataFrame:
    """Column names, types and comments of a table."""
    return spark.sql(f"DESCRIBE TABLE {table}").select("col_name", "data_type", "comment")


def save_view(df_sql: str, spark: SparkSession, view: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS {df_sql}")


def update_matched(
    target: DataFrame, updates: DataFrame, key: str, columns: list[str]
) -> DataFrame:
    """``target`` with ``columns`` taken from the row of ``updates`` that shares its key. A
    matched NULL is taken too; unmatched rows stay. Keys must be unique in ``updates``."""
    fresh = updates.select(
        F.col(key).alias("_key"), *[F.col(c).alias(f"_new_{c}") for c in columns]
    )
    matched = F.col("_key").isNotNull()
    joined = target.join(fresh, target[key] == F.col("_key"), "left")
    return joined.select(
        *[
            F.when(matched, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
            if c in columns
            else F.col(c)
            for c in target.columns
        ]
    )
