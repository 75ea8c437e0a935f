import datetime as dt
import math
import random
import statistics

import pandas as pd
import pytest
from pyspark.sql import functions as F

from upswell.functions import numbers
from upswell.operators import growth, robust
from upswell.plans.signals import growth_signals, possible_aliases

DAY = dt.date(2024, 3, 20)
DAILY = (
    "artist_key string, name string, snapshot_date date, lastfm_listeners bigint, "
    "lastfm_playcount bigint"
)
CHARTS = "artist_key string, snapshot_date date, country string"


def ago(days):
    return DAY - dt.timedelta(days=days)


def crowd():
    """Twelve steady acts of one size, each growing a little differently over a week."""
    rng = random.Random(7)
    rows = []
    for i in range(12):
        now = int(20_000 * (1.01 + rng.uniform(-0.004, 0.004)))
        rows += [(f"c{i}", f"Crowd {i}", ago(7), 20_000, 90_000), (f"c{i}", f"Crowd {i}", DAY, now, 91_000 + 13 * i)]
    return rows


def signals(spark, rows, charts=(), **kw):
    out = growth_signals(
        spark.createDataFrame(crowd() + rows, DAILY),
        spark.createDataFrame(list(charts), CHARTS),
        **kw,
    )
    return {r.artist_key: r for r in out.collect()}


def test_size_bands_are_left_closed(spark):
    sizes = [9_999, 10_000, 49_999, 50_000, 500_000, 2_000_000, -1, None]
    df = spark.createDataFrame([(s,) for s in sizes], "n bigint")
    got = [r[0] for r in df.select(numbers.size_band(F.col("n"))).collect()]
    assert got == ["<10k", "10k-50k", "10k-50k", "50k-500k", "500k-2M", "2M+", None, None]


def test_baseline_is_latest_point_before_the_window(spark):
    rows = [("g", "Gap", ago(d), n, 100 + d) for d, n in [(10, 500), (8, 1000), (0, 2000)]]
    df = spark.createDataFrame(rows, DAILY)
    r = growth.growth_points(df, F.lit(DAY), [("w", "lastfm_listeners", 7)]).first()
    assert (r.w_now, r.w_then, r.w_span) == (2000, 1000, 8)
    assert r.w_rate == pytest.approx(math.log(2) / 8)


def test_short_history_extrapolates_and_is_provisional(spark):
    out = signals(spark, [("n", "New", ago(1), 30_000, 900), ("n", "New", DAY, 30_300, 950)])
    assert out["n"].listeners_7d_growth_pct == pytest.approx((1.01**7 - 1) * 100)
    assert out["n"].is_provisional and out["n"].growth_window_days == 1
    assert out["n"].history_days == 2
    assert not out["c1"].is_provisional


def test_stale_totals_are_no_measurement(spark):
    out = signals(
        spark,
        [
            ("still", "Still", ago(7), 20_000, 500), ("still", "Still", DAY, 20_000, 500),
            ("plays", "Plays", ago(7), 20_000, 500), ("plays", "Plays", DAY, 20_000, 600),
        ],
    )
    assert out["still"].breakout_score is None and out["still"].growth_window_days is None
    assert out["still"].is_provisional
    assert out["plays"].listeners_7d_growth_pct == 0.0
    assert out["plays"].listeners_14d_growth_pct is None


def test_zero_baseline_is_unscored_and_decline_is_allowed(spark):
    out = signals(
        spark,
        [
            ("zero", "Zero", ago(7), 0, 0), ("zero", "Zero", DAY, 900, 30),
            ("down", "Down", ago(7), 20_000, 500), ("down", "Down", DAY, 18_000, 600),
            ("gone", "Gone", ago(7), 20_000, 500), ("gone", "Gone", ago(1), 21_000, 600),
        ],
    )
    assert out["zero"].breakout_score is None
    assert out["down"].listeners_7d_growth_pct == pytest.approx(-10.0)
    assert out["down"].new_listeners_7d == -2000
    assert "gone" not in out
    assert out["down"].breakout_rank == 13


def test_chart_entries_skip_the_baseline_day_and_old_ones(spark):
    charts = [
        ("a", ago(20), "Chile"), ("b", ago(20), "Spain"), ("a", DAY, "Chile"),
        ("a", ago(13), "Italy"), ("a", ago(14), "Japan"), ("a", DAY, "Brazil"),
    ]
    out = growth.chart_entries(spark.createDataFrame(charts, CHARTS), F.lit(DAY), 14)
    got = {r.artist_key: (r.new_country_charts, r.chart_countries) for r in out.collect()}
    assert got == {"a": (2, ["Brazil", "Chile"]), "b": (0, [])}


def test_scores_are_average_rank_percentiles(spark):
    values = [0.5, -1.0, 0.5, None, 2.0, 0.0, -1.0, 2.0, 2.0, 3.5]
    df = spark.createDataFrame(list(enumerate(values)), "id int, z double")
    got = robust.with_ranks(df, "z", "rank", "pct").toPandas().set_index("id").sort_index()
    want = pd.Series(values, dtype="float64")
    assert got.pct.tolist() == pytest.approx(
        (want.rank(pct=True) * 100).round(1).tolist(), nan_ok=True
    )
    assert got["rank"].tolist() == pytest.approx(
        want.rank(ascending=False, method="min").tolist(), nan_ok=True
    )


@pytest.mark.parametrize("n", [1, 2, 7, 400])
def test_exact_medians_on_heavy_ties_and_tails(spark, n):
    rng = random.Random(n)
    rows = []
    for group in ("a", "b"):
        for _ in range(n):
            kind = rng.random()
            v = 0.0 if kind < 0.33 else rng.gauss(0, 1e-4) if kind < 0.8 else rng.gauss(0, 1e6)
            rows.append((group, v))
    df = spark.createDataFrame(rows + [("a", None)], "g string, v double")
    got = {r.g: (r.median, r.members) for r in robust.exact_medians(df, ["g"], "v").collect()}
    for group in ("a", "b"):
        values = [v for g, v in rows if g == group]
        assert got[group] == (pytest.approx(statistics.median(values), abs=0), n)


def test_small_or_flat_bands_use_everyone(spark):
    rows = [("big", float(i)) for i in range(20)]
    rows += [("few", 30.0), ("flat", 5.0), (None, 7.0), ("big", None)] + [("flat", 5.0)] * 10
    df = spark.createDataFrame([(i, b, v) for i, (b, v) in enumerate(rows)], "id int, band string, v double")
    got = robust.with_robust_z(df, "band", {"v": "z"}).toPandas().set_index("id").z
    values = pd.Series([v for _, v in rows if v is not None])
    med, mad = values.median(), (values - values.median()).abs().median() * 1.4826
    own = pd.Series([float(i) for i in range(20)])
    own_mad = (own - own.median()).abs().median() * 1.4826
    clip = lambda z: 5 * math.tanh(z / 5)
    assert got[20] == pytest.approx(clip((30 - med) / mad))
    assert got[21] == pytest.approx(clip((5 - med) / mad))
    assert got[0] == pytest.approx(clip((0 - own.median()) / own_mad))
    assert math.isnan(got[22]) and math.isnan(got[23])


def test_no_spread_anywhere_is_zero(spark):
    df = spark.createDataFrame([(i, "b", 1.0) for i in range(12)], "id int, band string, v double")
    assert {r.z for r in robust.with_robust_z(df, "band", {"v": "z"}).collect()} == {0.0}


def test_extra_views_fill_the_fourth_component(spark):
    daily = spark.createDataFrame(crowd(), DAILY)
    views = spark.createDataFrame(
        [(f"c{i}", d, 1000 * (i + 1) + (7 - a) * i * i) for i in range(12) for a, d in ((7, ago(7)), (0, DAY))],
        "artist_key string, snapshot_date date, yt_views bigint",
    )
    charts = spark.createDataFrame([], CHARTS)
    plain = {r.artist_key: r for r in growth_signals(daily, charts).collect()}
    rich = {r.artist_key: r for r in growth_signals(daily, charts, extra_views=views).collect()}
    r, p = rich["c11"], plain["c11"]
    assert p.yt_view_growth_z is None and r.yt_view_growth_z is not None
    parts = 0.45 * r.listener_growth_z + 0.25 * r.play_growth_z
    assert p.breakout_z == pytest.approx(parts / 0.85)
    assert r.breakout_z == pytest.approx(parts + 0.15 * r.yt_view_growth_z)


def test_gap_is_spread_not_a_spike(spark):
    points = [(DAY, 100, None), (DAY + dt.timedelta(31), 410, 310), (DAY + dt.timedelta(32), 420, 10)]
    rows = [("a", d, n, c) for d, n, c in points] + [("b", d, 100, 0) for d, _, _ in points]
    rows += [("c", DAY, 1, None)]
    df = spark.createDataFrame(
        rows, "artist_key string, snapshot_date date, lastfm_listeners bigint, change bigint"
    )
    got = {r.artist_key: r for r in growth.trend_summary(df, "lastfm_listeners", "change").collect()}
    assert got["a"].pattern == "steady" and got["a"].days_with_increase == 32
    assert got["a"].largest_one_day_change == 10
    assert [(g["from"], g["days"]) for g in got["a"].gaps] == [(DAY, 31)]
    assert got["b"].pattern == "flat" and got["b"].largest_one_day_share is None
    assert got["c"].pattern == "insufficient_history" and got["c"].total_change is None


def test_restyled_name_is_a_possible_alias(spark):
    df = spark.createDataFrame(
        [("1", "JAY-Z", ["Nas", "JAŸ-Z", "Jay Z"]), ("2", "Nas", ["Nas"]), ("3", "Sia", None)],
        "artist_key string, name string, similar_names array<string>",
    )
    assert [tuple(r) for r in possible_aliases(df).collect()] == [("1", "JAŸ-Z")]


def test_rank_plan_has_no_cross_join_and_one_bounded_window(spark, capsys):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 97 / 7.0).alias("z"))
    robust.with_ranks(df, "z", "r", "p").explain()
    plan = capsys.readouterr().out
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert plan.count("Exchange SinglePartition") == 1  # the histogram of bins


def test_compacted_history_gives_the_same_points(spark):
    """Random gaps, unknown totals and standstills; folded once, and folded again."""
    rng = random.Random(9)
    rows = []
    for i in range(40):
        total, plays = rng.randint(0, 50), 100
        for d in range(60, -1, -1):
            if rng.random() < (0.5 if i % 3 else 0.9):
                continue
            total += rng.choice([0, 0, 3])
            plays += rng.choice([0, 5])
            rows.append((f"k{i}", f"K {i}", ago(d), total, None if rng.random() < 0.2 else plays))
        rows.append((f"k{i}", f"K {i}", DAY, total, plays))
    daily = spark.createDataFrame(sorted(set(rows), key=lambda r: (r[0], r[2], r[3])), DAILY)
    daily = daily.dropDuplicates(["artist_key", "snapshot_date"])
    metrics = ["lastfm_listeners", "lastfm_playcount"]

    def points(df):
        out = growth.growth_points(
            df,
            F.lit(DAY),
            [("l", "lastfm_listeners", 7), ("m", "lastfm_listeners", 14), ("p", "lastfm_playcount", 14)],
            changed=metrics,
            carry=["name"],
        )
        return sorted(map(str, out.collect()))

    after = lambda n: daily.filter(F.col("snapshot_date") > F.lit(ago(n)))
    once = growth.compact_history(daily, F.lit(ago(14)), metrics)
    assert once.count() < daily.count() / 2
    assert points(growth.with_compacted(once, after(14))) == points(daily)
    first = growth.compact_history(daily, F.lit(ago(35)), metrics)
    between = after(35).filter(F.col("snapshot_date") <= F.lit(ago(14)))
    twice = growth.compact_history(growth.with_compacted(first, between), F.lit(ago(14)), metrics)
    assert points(growth.with_compacted(twice, after(14))) == points(daily)
