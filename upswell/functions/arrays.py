"""Expressions over tag and country arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from upswell import settings


def empty_if_null(items: Column) -> Column:
    return F.coalesce(items, F.array().cast("array<string>"))


def top_joined(items: Column, n: int = 3) -> Column:
    return F.array_join(F.slice(empty_if_null(items), 1, n), ", ")


def any_contains(items: Column, text: str) -> Column:
    """Any item holds ``text``, ignoring case. A substring test, so "rap" also finds "trap"."""
    return F.exists(items, lambda t: F.contains(F.lower(t), F.lower(F.lit(text))))


def any_equals(items: Column, text: str) -> Column:
    """The whole-tag reading of :func:`any_contains`."""
    return F.exists(items, lambda t: F.lower(t) == F.lower(F.lit(text)))


def country_evidence(chart_countries: Column, tags: Column, country: str, nationality: str) -> Column:
    """"chart" if the entity charts there, "tag" if its tags name the place, else NULL."""
    by_tag = F.exists(
        tags,
        lambda t: F.lower(t).isin(country.lower(), nationality)
        | F.lower(t).startswith(nationality + " "),
    )
    return F.when(F.array_contains(chart_countries, country), "chart").when(by_tag, "tag")


def tag_weights(tags: Column, top: int) -> Column:
    """The first ``top`` tags that are no junk, lower-cased, weighing 1/position; a tag written
    twice adds up. An array of struct(tag, weight), one entry per tag."""
    kept = F.slice(
        F.filter(
            F.transform(empty_if_null(tags), F.lower),
            lambda t: ~t.isin(*settings.JUNK_TAGS),
        ),
        1,
        top,
    )
    placed = F.transform(
        kept, lambda t, i: F.struct(t.alias("tag"), (F.lit(1.0) / (i + 1)).alias("weight"))
    )
    return F.transform(
        F.array_distinct(kept),
        lambda t: F.struct(
            t.alias("tag"),
            F.aggregate(
                F.filter(placed, lambda p: p["tag"] == t),
                F.lit(0.0),
                lambda total, p: total + p["weight"],
            ).alias("weight"),
        ),
    )


def norm(weights: Column) -> Column:
    """Euclidean length of an array of struct(tag, weight)."""
    return F.sqrt(
        F.aggregate(weights, F.lit(0.0), lambda total, w: total + w["weight"] * w["weight"])
    )
