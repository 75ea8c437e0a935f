"""Exact medians, robust z-scores, ranks and percentiles without one task holding everything.

Values are cut into order-preserving bins. A histogram of the bins is small whatever the data
size (its length depends on the range of a double, not on rows), so prefix sums over it are
cheap; only the bins that hold the answer, or one bin at a time, are looked at row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upswell import settings
from upswell.functions.numbers import half_even, soft_clip
from upswell.staging import staged

BINS_PER_OCTAVE = 512
ALL = "*"  # the scope holding every entity, beside one scope per band


def order_bin(value: Column, per_octave: int = BINS_PER_OCTAVE) -> Column:
    """Bin number that never decreases as ``value`` grows; each bin spans about 0.1 %."""
    magnitude = F.floor((F.log2(F.abs(value)) + 1100) * per_octave)
    return F.when(value > 0, magnitude).when(value < 0, -magnitude).otherwise(0).cast("bigint")


def exact_medians(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    """Exact median and member count per group: columns ``groups``, ``median``, ``members``.

    For few groups of any size (size bands, say). NULL values are left out."""
    binned = df.filter(F.col(value).isNotNull()).select(
        *groups, F.col(value).alias("v"), order_bin(F.col(value)).alias("bin")
    )
    per_group = Window.partitionBy(*groups)
    upto = per_group.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    histogram = (
        binned.groupBy(*groups, "bin")
        .agg(F.count("*").alias("n"))
        .withColumn("members", F.sum("n").over(per_group))
        .withColumn("before", F.sum("n").over(upto) - F.col("n"))
    )
    lower = F.floor((F.col("members") - 1) / 2)
    upper = F.floor(F.col("members") / 2)

    def covers(position: Column) -> Column:
        return (F.col("before") <= position) & (position < F.col("before") + F.col("n"))

    middle_bins = histogram.filter(covers(lower) | covers(upper)).drop("n")
    # At most two rows per group, so the broadcast is bounded by the number of groups.
    in_bin = Window.partitionBy(*groups, "bin").orderBy("v")
    candidates = (
        binned.join(F.broadcast(middle_bins), [*groups, "bin"])
        .groupBy(*groups, "bin", "members", "before", "v")
        .agg(F.count("*").alias("n"))
        .withColumn(
            "before",
            F.col("before")
            + F.sum("n").over(in_bin.rowsBetween(Window.unboundedPreceding, Window.currentRow))
            - F.col("n"),
        )
    )
    return candidates.groupBy(*groups, "members").agg(
        (
            (F.max(F.when(covers(lower), F.col("v"))) + F.max(F.when(covers(upper), F.col("v")))) / 2
        ).alias("median")
    )


def robust_scales(df: DataFrame, band: str, metrics: list[str]) -> DataFrame:
    """Median and scaled MAD per (metric, scope); a scope is a band, or ``*`` for everyone.
    At most metrics x (bands + 1) rows."""
    points = df.select(
        F.col(band).alias("band"),
        F.explode(
            F.array(
                *[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("v")) for m in metrics]
            )
        ).alias("p"),
    ).select("band", "p.metric", "p.v")
    scoped = points.filter("v IS NOT NULL").select(
        "metric", F.explode(F.array_compact(F.array("band", F.lit(ALL)))).alias("scope"), "v"
    )
    medians = exact_medians(scoped, ["metric", "scope"], "v")
    deviations = scoped.join(F.broadcast(medians), ["metric", "scope"]).select(
        "metric", "scope", F.abs(F.col("v") - F.col("median")).alias("deviation")
    )
    spreads = exact_medians(deviations, ["metric", "scope"], "deviation")
    return medians.join(
        spreads.select(
            "metric", "scope", (F.col("median") * settings.MAD_TO_SD).alias("scale")
        ),
        ["metric", "scope"],
    )


def with_robust_z(
    df: DataFrame,
    band: str,
    metrics: dict[str, str],
    min_band_size: int = settings.MIN_BAND_SIZE,
    clip: float = settings.Z_CLIP,
) -> DataFrame:
    """Add one soft-clipped z column per metric (``{metric column: z column}``): distance from
    the band's median in scaled MADs. A band with too few members or no spread uses everyone's
    figures; no spread there either gives 0. No band or no value gives NULL."""
    scales = staged(robust_scales(df, band, list(metrics)))
    out = df
    for metric, z_column in metrics.items():
        own = scales.filter(F.col("metric") == metric)
        everyone = own.filter(F.col("scope") == ALL).select(
            F.struct(F.col("median"), F.col("scale"))
        )
        stats = own.filter(F.col("scope") != ALL).select(
            F.col("scope").alias(band), "median", "scale", "members"
        )
        out = out.join(F.broadcast(stats), band, "left").withColumn("_all", everyone.scalar())
        fits = (F.col("members") >= min_band_size) & (F.col("scale") > 0)
        median = F.when(fits, F.col("median")).otherwise(F.col("_all.median"))
        scale = F.when(fits, F.col("scale")).otherwise(F.col("_all.scale"))
        raw = F.when(scale > 0, (F.col(metric) - median) / scale).otherwise(0.0)
        present = F.col(metric).isNotNull() & F.col(band).isNotNull()
        out = out.withColumn(z_column, F.when(present, soft_clip(raw, clip))).drop(
            "median", "scale", "members", "_all"
        )
    return out


def value_ranks(df: DataFrame, value: str) -> DataFrame:
    """One row per distinct non-NULL value: ``value``, ``rank`` (1 = highest, ties share the
    smallest) and ``pct`` (average rank from the bottom as a share of the count, 0-100).

    Equal values are counted together first, so a value that a third of the rows share is one
    row here. The window over bins is bounded by the number of bins; the window inside a bin
    holds about 0.1 % of the value range."""
    distinct = (
        df.filter(F.col(value).isNotNull())
        .groupBy(value)
        .agg(F.count("*").alias("n"))
        .withColumn("bin", order_bin(F.col(value)))
    )
    below_bin = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bins = (
        distinct.groupBy("bin")
        .agg(F.sum("n").alias("bin_n"))
        .select(
            "bin",
            (F.sum("bin_n").over(below_bin) - F.col("bin_n")).alias("bin_before"),
            F.sum("bin_n").over(Window.partitionBy()).alias("total"),
        )
    )
    below = (
        Window.partitionBy("bin")
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    before = F.col("bin_before") + F.col("below") - F.col("n")
    return (
        distinct.withColumn("below", F.sum("n").over(below))
        .join(bins, "bin")
        .select(
            value,
            (F.col("total") - before - F.col("n") + 1).cast("int").alias("rank"),
            ((before + (F.col("n") + 1) / F.lit(2.0)) / F.col("total") * 100).alias("pct"),
        )
    )


def with_ranks(df: DataFrame, value: str, rank: str, percentile: str) -> DataFrame:
    """Add the rank (1 = highest) and the percentile rounded half-even to one decimal; both are
    NULL where the value is. Rows without a value, which can be most of them, are dealt out by
    their other columns instead of meeting on NULL."""
    ranks = value_ranks(df, value).select(
        F.col(value).alias("_value"),
        F.lit(0).cast("bigint").alias("_deal"),
        F.col("rank").alias(rank),
        half_even(F.col("pct"), 1).alias(percentile),
    )
    others = [c for c, kind in df.dtypes if c != value and not kind.startswith(("map", "variant"))]
    dealt = F.when(F.col(value).isNull(), F.xxhash64(*others)).otherwise(F.lit(0))
    rows = df.withColumn("_deal", dealt)
    return rows.join(ranks, (F.col(value) == F.col("_value")) & (rows["_deal"] == ranks["_deal"]), "left").drop(
        "_value", rows["_deal"], ranks["_deal"]
    )
