"""Growth of cumulative totals as of a day, and what changed when."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upswell.functions.numbers import half_even, log_rate

PointWindow = tuple[str, str, int]  # output prefix, value column, window in days


def changed_on(rows: DataFrame, metrics: Sequence[str], key: str, day: str) -> Column:
    """The row's day if any metric differs from the entity's row before it (a NULL always does;
    the first row never does). Compacted rows carry the answer for the days they stand for."""
    by_day = Window.partitionBy(key).orderBy(day)
    moved = F.lit(False)
    for c in metrics:
        moved = moved | ~F.lag(c).over(by_day).eqNullSafe(F.col(c)) | F.col(c).isNull()
    own = F.when((F.row_number().over(by_day) > 1) & moved, F.col(day))
    if "compacted" not in rows.columns:
        return own
    return F.when(F.col("compacted"), F.col("changed_on")).otherwise(own)


def compact_history(
    daily: DataFrame,
    until: Column,
    metrics: Sequence[str],
    key: str = "artist_key",
    day: str = "snapshot_date",
) -> DataFrame:
    """The few rows per entity that growth as of a later day can ask for: its first and last row
    up to ``until`` and the first and last with each metric known, with the last change in
    ``changed_on``. Growth over these rows and the days after ``until`` equals growth over the
    whole history, for any day at least the longest window after ``until``; so a daily run reads
    some days instead of years. Takes its own output plus newer days as input."""
    rows = daily.filter(F.col(day) <= until)
    whole = Window.partitionBy(key)
    rows = rows.withColumn("_changed_on", changed_on(rows, metrics, key, day))
    keep = (F.col(day) == F.min(day).over(whole)) | (F.col(day) == F.max(day).over(whole))
    for c in metrics:
        known = F.when(F.col(c).isNotNull(), F.col(day))
        ends = (known == F.min(known).over(whole)) | (known == F.max(known).over(whole))
        keep = keep | F.coalesce(ends, F.lit(False))
    kept = rows.withColumn("_keep", keep).withColumn("_last", F.max("_changed_on").over(whole))
    columns = [c for c in daily.columns if c not in ("changed_on", "compacted")]
    return kept.filter("_keep").select(
        *columns, F.col("_last").alias("changed_on"), F.lit(True).alias("compacted")
    )


def with_compacted(compacted: DataFrame, newer: DataFrame) -> DataFrame:
    """Compacted rows and the plain rows of the days after them, ready for growth."""
    plain = newer.withColumn("changed_on", F.lit(None).cast("date")).withColumn(
        "compacted", F.lit(False)
    )
    return compacted.unionByName(plain.select(*compacted.columns))


def growth_points(
    daily: DataFrame,
    as_of: Column,
    windows: Sequence[PointWindow],
    changed: Sequence[str] = (),
    carry: Sequence[str] = (),
    key: str = "artist_key",
    day: str = "snapshot_date",
) -> DataFrame:
    """One row per entity seen on ``as_of``, from one pass over its daily rows.

    For each window: ``<prefix>_now``, the baseline ``<prefix>_then`` (latest point on or before
    ``as_of`` minus the window, else the earliest earlier point), ``<prefix>_span`` in days and
    ``<prefix>_rate``, the log growth per day. NULL totals are no points. ``last_changed`` is the
    latest day on which any of ``changed`` differed from the day before it, ``first_seen`` the
    first day. ``carry`` columns are taken from the ``as_of`` row.

    The window and the aggregate share one shuffle on the entity, and an entity has at most one
    row per day, so no key grows with the number of rows landed. Rows of
    :func:`compact_history` may stand for all days up to some day."""
    rows = daily.withColumn("_as_of", as_of).filter(F.col(day) <= F.col("_as_of"))
    if changed:
        rows = rows.withColumn("_changed_on", changed_on(rows, changed, key, day))
    is_today = F.col(day) == F.col("_as_of")
    aggs = [
        F.max("_as_of").alias("as_of_date"),
        F.min(day).alias("first_seen"),
        F.max(is_today).alias("_seen"),
        *[F.max_by(c, is_today).alias(c) for c in carry],
    ]
    if changed:
        aggs.append(F.max("_changed_on").alias("last_changed"))
    for prefix, value, days in windows:
        point = F.struct(F.col(day).alias("day"), F.col(value).alias("v"))
        known = F.col(value).isNotNull()
        in_window = known & (F.col(day) <= F.date_sub("_as_of", days))
        earlier = known & (F.col(day) < F.col("_as_of"))
        aggs += [
            F.max(F.when(is_today, F.col(value))).alias(f"{prefix}_now"),
            F.coalesce(
                F.max(F.when(in_window, point)), F.min(F.when(earlier, point))
            ).alias(f"{prefix}_base"),
        ]
    out = rows.groupBy(key).agg(*aggs).filter("_seen").drop("_seen")
    for prefix, _, _ in windows:
        base, now = F.col(f"{prefix}_base"), F.col(f"{prefix}_now")
        usable = now.isNotNull()
        out = (
            out.withColumn(f"{prefix}_then", F.when(usable, base["v"]))
            .withColumn(f"{prefix}_span", F.when(usable, F.datediff("as_of_date", base["day"])))
            .drop(f"{prefix}_base")
            .withColumn(
                f"{prefix}_rate",
                log_rate(now, F.col(f"{prefix}_then"), F.col(f"{prefix}_span")),
            )
        )
    return out


def growth_history(
    daily: DataFrame, metrics: dict[str, str], key: str = "artist_key", day: str = "snapshot_date"
) -> DataFrame:
    """Daily totals with the change since the entity's previous day. ``metrics`` maps a total
    to its change column."""
    by_day = Window.partitionBy(key).orderBy(day)
    return daily.select(
        "*", *[(F.col(m) - F.lag(m).over(by_day)).alias(c) for m, c in metrics.items()]
    )


def history_after(
    last: DataFrame, daily: DataFrame, metrics: dict[str, str], key: str = "artist_key", day: str = "snapshot_date"
) -> DataFrame:
    """The days of ``daily`` as :func:`growth_history` gives them, when ``last`` holds each
    entity's last row before them: no earlier day is read."""
    rows = daily.withColumn("_new", F.lit(True)).unionByName(
        last.select(*daily.columns).withColumn("_new", F.lit(False))
    )
    return growth_history(rows, metrics, key, day).filter("_new").drop("_new")


def trend_summary(
    history: DataFrame,
    total: str,
    change: str,
    key: str = "artist_key",
    day: str = "snapshot_date",
) -> DataFrame:
    """Per entity: is its growth spread over many days or one jump? A change across missing days
    is spread over the days it covers, so a catch-up row does not read as a spike."""
    by_day = Window.partitionBy(key).orderBy(day)
    steps = (
        history.withColumn("_prev", F.lag(day).over(by_day))
        .withColumn("_days", F.greatest(F.datediff(day, "_prev"), F.lit(1)))
        .withColumn(
            "_step", F.when(F.col("_prev").isNotNull(), F.coalesce(change, F.lit(0)) / F.col("_days"))
        )
    )
    first, last = F.min(F.struct(day, total)), F.max(F.struct(day, total))
    gap = F.struct(
        F.col("_prev").alias("from"), F.col(day).alias("to"), F.col("_days").alias("days")
    )
    summed = steps.groupBy(key).agg(
        F.count("*").alias("days"),
        first.alias("_first"),
        last.alias("_last"),
        F.max(F.when(F.col("_step").isNotNull(), F.struct("_step", day))).alias("_top"),
        F.coalesce(F.sum(F.when(F.col("_step") > 0, F.col("_days"))), F.lit(0)).alias("_up"),
        F.array_sort(F.collect_list(F.when(F.col("_days") > 1, gap))).alias("_gaps"),
    )
    change_all = F.coalesce(F.col("_last")[total], F.lit(0)) - F.coalesce(
        F.col("_first")[total], F.lit(0)
    )
    biggest = half_even(F.col("_top._step")).cast("bigint")
    share = F.when(F.col("_total") > 0, F.col("_biggest") / F.col("_total"))
    enough = F.col("days") >= 3
    pattern = (
        F.when(~enough, "insufficient_history")
        .when(F.col("_total") <= 0, "flat")
        .when((F.col("_share") > 0.5) | (F.col("_up") < 3), "concentrated")
        .otherwise("steady")
    )
    out = (
        summed.withColumn("_total", change_all)
        .withColumn("_biggest", biggest)
        .withColumn("_share", share)
    )
    return out.select(
        key,
        pattern.alias("pattern"),
        "days",
        *[
            F.when(enough, c).alias(name)
            for name, c in {
                "from": F.col("_first")[day],
                "to": F.col("_last")[day],
                "listeners_start": F.col("_first")[total],
                "listeners_end": F.col("_last")[total],
                "total_change": F.col("_total"),
                "days_with_increase": F.col("_up"),
                "largest_one_day_change": F.col("_biggest"),
                "largest_one_day_date": F.col("_top")[day],
                "largest_one_day_share": half_even(F.col("_share"), 3),
                "gaps": F.col("_gaps"),
            }.items()
        ],
    )


def history_runs(
    history: DataFrame, max_gap_days: int = 3, key: str = "artist_key", day: str = "snapshot_date"
) -> DataFrame:
    """Number the unbroken runs of each entity's days from 0; a longer gap starts the next run.
    ``pause_from`` on the first day of a run is the last day before the pause."""
    by_day = Window.partitionBy(key).orderBy(day)
    paused = F.coalesce(F.datediff(day, F.lag(day).over(by_day)) > max_gap_days, F.lit(False))
    return (
        history.withColumn("_paused", paused)
        .withColumn("pause_from", F.when(F.col("_paused"), F.lag(day).over(by_day)))
        .withColumn(
            "run",
            F.sum(F.col("_paused").cast("bigint")).over(
                by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            ),
        )
        .drop("_paused")
    )


def chart_positions(
    scores: DataFrame, within: Sequence[str], order: Sequence[Column], top: int
) -> DataFrame:
    """The first ``top`` rows of each chart with their 1-based position."""
    chart = Window.partitionBy(*within).orderBy(*order)
    return scores.withColumn("rank", F.row_number().over(chart)).filter(F.col("rank") <= top)


def chart_entries(
    charts: DataFrame,
    as_of: Column,
    window_days: int,
    key: str = "artist_key",
    day: str = "snapshot_date",
    place: str = "country",
) -> DataFrame:
    """Per entity: places whose chart it entered for the first time in the window, and the
    places it charts in on ``as_of``. The first chart day is a baseline and never an entry."""
    seen = charts.withColumn("_as_of", as_of).filter(F.col(day) <= F.col("_as_of"))
    baseline = seen.select(F.min(day)).scalar()
    # One row per (entity, place) first, combined map-side; the place list is short after that.
    first = seen.groupBy(key, place).agg(
        F.min(day).alias("_first"),
        F.max("_as_of").alias("_as_of"),
        F.count_if(F.col(day) == F.col("_as_of")).alias("_today"),
    )
    entered = (F.col("_first") > F.col("_base")) & (
        F.col("_first") >= F.date_sub("_as_of", window_days - 1)
    )
    here = F.when(F.col("_today") > 0, F.array_repeat(F.col(place), F.col("_today").cast("int")))
    return (
        first.withColumn("_base", baseline)
        .groupBy(key)
        .agg(
            F.count_if(entered).cast("int").alias("new_country_charts"),
            F.array_sort(F.flatten(F.collect_list(here))).alias("chart_countries"),
        )
    )
