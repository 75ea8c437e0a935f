"""Shape-tolerant reading of raw JSON held as VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def at(raw: str, path: str, type_: str = "string") -> Column:
    """One path cast to a type; a missing path or an impossible cast is NULL."""
    return F.try_variant_get(F.col(raw), path, type_)


def number_at(raw: str, path: str) -> Column:
    """A whole number that the source writes as text."""
    return F.expr(f"try_cast(try_variant_get({raw}, '{path}', 'string') AS BIGINT)")


def date_at(raw: str, path: str) -> Column:
    return F.expr(f"try_cast(try_variant_get({raw}, '{path}', 'string') AS DATE)")


def text_at(raw: str, path: str) -> Column:
    """Text at a path, blank read as NULL."""
    return F.nullif(at(raw, path), F.lit(""))


def strings_at(raw: str, path: str, field: str) -> Column:
    """Array of one field, whether the source wrote a list of objects, one bare object or ""."""
    return F.expr(
        f"""CASE
              WHEN try_variant_get({raw}, '{path}', 'array<variant>') IS NOT NULL
              THEN transform(try_variant_get({raw}, '{path}', 'array<variant>'),
                             item -> try_variant_get(item, '$.{field}', 'string'))
              WHEN try_variant_get({raw}, '{path}.{field}', 'string') IS NOT NULL
              THEN array(try_variant_get({raw}, '{path}.{field}', 'string'))
              ELSE CAST(array() AS ARRAY<STRING>)
            END"""
    )
