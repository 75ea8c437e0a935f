import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from upswell.plans import pipeline, quality

FIRST = dt.date(2024, 3, 1)


def write(root, dataset, day, rows):
    folder = root / dataset / f"dt={day}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "part-0.jsonl").write_text("".join(json.dumps(r) + "\n" for r in rows))


def artist(i, day, listeners, plays, key=None, name=None):
    name = name or f"Act {i}"
    return {
        "fetched_at": f"{day}T05:00:00+00:00",
        "artist_key": key or f"mbid:{i}",
        "payload": {
            "name": name, "mbid": str(i), "stats": {"listeners": str(listeners), "playcount": str(plays)},
            "tags": {"tag": [{"name": "pop"}]}, "similar": {"artist": ""}, "ontour": "0", "url": f"u/{i}",
            "bio": {"summary": f"Bio {i}"},
        },
    }


def land_day(root, n):
    day = FIRST + dt.timedelta(n)
    rows = [artist(i, day, 20_000 + n * (10 + i * i), 90_000 + n * (50 + 7 * i)) for i in range(14)]
    # The same act under a name key: the ID key wins.
    rows.append(artist(3, day, 1, 1, key="name:act 3", name="ACT 3"))
    write(root, "lastfm/artist_info", day, rows)
    charts = [("Brazil", 1, 5), ("Canada", 1, 2)] if n < 6 else [("Brazil", 1, 13), ("Canada", 1, 2)]
    write(
        root, "lastfm/geo_top", day,
        [{"fetched_at": str(day), "country": c, "rank": r, "artist_key": f"name:act {i}", "name": f"act {i}", "listeners": 9}
         for c, r, i in charts],
    )
    write(root, "lastfm/similar", day, [{"from_key": "mbid:1", "to_key": "mbid:2", "to_name": "Act 2", "match": 0.5}])
    acts = [{"id": f"k{i}", "name": f"Act {i}"} for i in (13, 2)] + [{"id": "x", "name": "Nobody Known"}]
    event = {
        "id": "e1", "name": "Night", "dates": {"start": {"localDate": "2024-04-01"}, "status": {"code": "onsale"}},
        "_embedded": {"venues": [{"name": "V", "city": {"name": "Toronto"}}], "attractions": acts},
    }
    write(root, "ticketmaster/events", day, [{"fetched_at": str(day), "city": "Toronto", "payload": event}])
    return day


def test_daily_runs(spark, tmp_path):
    root, lake = tmp_path / "landing", pipeline.Lake(spark, str(tmp_path / "lake"))
    (root / "candidates").mkdir(parents=True)
    (root / "candidates" / "pool.jsonl").write_text('{"artist_key": "k"}\n' * 14)
    for n in range(8):
        day = land_day(root, n)
    metrics = pipeline.run_all(lake, str(root), F.lit(day)).first()
    assert (metrics.latest_date, metrics.latest_rows, metrics.gold_rows) == (day, 14, 14)
    scored = {r.artist_key: r for r in lake.read("gold", "artist_signals").collect()}
    assert max(scored.values(), key=lambda r: r.breakout_score).artist_key == "mbid:13"
    top = scored["mbid:13"]
    assert (top.growth_window_days, top.new_country_charts_14d, top.chart_countries) == (7, 1, ["Brazil"])
    assert top.genres == "pop" and top.history_days == 8
    listed = lake.read("gold", "upcoming_shows").collect()
    assert {(r.artist_key, r.is_headliner) for r in listed} == {("mbid:13", True), ("mbid:2", False)}
    assert pipeline.review_queue(lake).count() == 0

    # The next day only loads itself and the newest days; history grows by one day.
    day = land_day(root, 8)
    loaded = pipeline.run_bronze(lake, str(root))
    assert loaded["lastfm_artist_info_raw"] == [str(day - dt.timedelta(1)), str(day)]
    pipeline.run_silver(lake, loaded)
    pipeline.run_gold(lake, F.lit(day))
    assert lake.read("gold", "artist_growth_history").count() == 14 * 9
    pipeline.run_quality(lake, F.lit(day))

    # Folding old days changes no score.
    def gold():
        return sorted(map(str, lake.read("gold", "artist_signals").collect()))

    before = gold()
    pipeline.compact(lake, str(FIRST))
    assert pipeline.compacted_days(lake) == [str(FIRST)]
    pipeline.run_gold(lake, F.lit(day))
    assert gold() == before
    with pytest.raises(quality.QualityCheckFailed, match="latest day"):
        pipeline.run_quality(lake, F.lit(day + dt.timedelta(5)))


def land_pool(root):
    (root / "candidates").mkdir(parents=True)
    (root / "candidates" / "pool.jsonl").write_text('{"artist_key": "k"}\n' * 14)


def tables(lake):
    """The tables that are carried from day to day, as sorted rows."""
    names = [("silver", "artist_profile"), ("silver", "chart_daily"), ("gold", "artist_growth_history"), ("silver", "artist_counts")]
    return {t: sorted(str(sorted(r.asDict().items())) for r in lake.read(layer, t).collect()) for layer, t in names}


def run_days(lake, root):
    pipeline.run_silver(lake, pipeline.run_bronze(lake, str(root)))
    pipeline.run_history(lake)


def test_day_by_day_is_all_at_once(spark, tmp_path):
    root, lake = tmp_path / "landing", pipeline.Lake(spark, str(tmp_path / "lake"))
    land_pool(root)
    for n in (0, 1, 2, 4):
        land_day(root, n)
    run_days(lake, root)
    # A day older than the kept state lands; act 4 is gone on the last day, act 20 comes.
    for n in (1, 3, 5):
        day = land_day(root, n)
        if n == 5:
            kept = [artist(i, day, 30_000 + n * i, 95_000) for i in range(14) if i != 4]
            write(root, "lastfm/artist_info", day, [*kept, artist(20, day, 5_000 + n, 7, name="ACT 1x")])
        if n > 1:
            run_days(lake, root)
    profile = {r.artist_key: str(r.profile_date) for r in lake.read("silver", "artist_profile").collect()}
    assert profile["mbid:4"] == str(FIRST + dt.timedelta(4)) and profile["mbid:20"] == str(day)
    # The newest day reloaded without act 20: what the day said is gone everywhere.
    write(root, "lastfm/artist_info", day, [artist(i, day, 9, 9) for i in range(3)])
    write(root, "lastfm/artist_info", day - dt.timedelta(1), [artist(i, day - dt.timedelta(1), 8, 8) for i in range(3)])
    run_days(lake, root)
    again = pipeline.Lake(spark, str(tmp_path / "again"))
    run_days(again, root)
    assert tables(lake) == tables(again)
    assert "mbid:20" not in {r.artist_key for r in lake.read("silver", "artist_profile").collect()}


def test_an_extra_day_reads_no_older_day(spark, tmp_path):
    root, lake = tmp_path / "landing", pipeline.Lake(spark, str(tmp_path / "lake"))
    land_pool(root)
    for n in range(5):
        land_day(root, n)
    run_days(lake, root)
    grown = [("silver", "chart_daily", 2), ("gold", "artist_growth_history", 14)]
    assert [lake.read(layer, t).count() for layer, t, _ in grown] == [10, 70]
    # From here on, nobody can read the older days: their files are no Parquet any more.
    old = [str(FIRST + dt.timedelta(n)) for n in range(4)]
    broken = [("bronze", "lastfm_artist_info_raw"), ("bronze", "lastfm_geo_top_raw"), ("silver", "artist_parsed"),
              ("silver", "artist_daily"), ("silver", "chart_rows")]
    for layer, table in broken:
        for day in old:
            for file in (tmp_path / "lake" / layer / table / f"snapshot_date={day}").glob("*.parquet"):
                file.with_name(f".{file.name}.crc").unlink()
                file.write_bytes(b"PAR1 no longer PAR1")
    with pytest.raises(Exception, match="(?i)parquet"):
        lake.of_days("silver", "artist_daily", old).collect()
    day = land_day(root, 5)
    run_days(lake, root)
    for layer, table, n in grown:
        rows = lake.read(layer, table)
        assert (rows.count(), rows.filter(F.col("snapshot_date") == F.lit(day)).count()) == (6 * n, n)
    steps = lake.read("gold", "artist_growth_history").filter("artist_key = 'mbid:3'").collect()
    assert {r.listeners_change for r in steps} == {None, 19}


def test_a_newly_tracked_name_resolves_older_charts(spark, tmp_path):
    root, lake = tmp_path / "landing", pipeline.Lake(spark, str(tmp_path / "lake"))
    land_pool(root)
    for n in range(4):
        day = land_day(root, n)
        write(
            root, "lastfm/geo_top", day,
            [{"fetched_at": str(day), "country": "Chile", "rank": 1, "artist_key": "name:late", "name": "late", "listeners": 9}],
        )
    run_days(lake, root)
    assert {r.in_pool for r in lake.read("silver", "chart_daily").collect()} == {False}
    day = land_day(root, 4)
    write(root, "lastfm/artist_info", day, [artist(30, day, 10, 10, name="Late")])
    run_days(lake, root)
    rows = lake.read("silver", "chart_daily").filter("country = 'Chile'").collect()
    assert len(rows) == 4 and {r.artist_key for r in rows} == {"mbid:30"}


def test_counts_by_day_give_the_metrics(spark, tmp_path):
    schema = "artist_key string, snapshot_date date, name string, breakout_score double"
    a, b, c = (FIRST + dt.timedelta(n) for n in range(3))
    rows = [("k", a, "x", 1.0), ("k", a, "X", 2.0), ("l", a, None, 3.0), ("k", b, "x", -1.0), ("l", b, "y", 101.0)]
    daily = spark.createDataFrame(rows, schema)
    bronze = daily.unionByName(spark.createDataFrame([("m", b, "z", None), ("m", c, "z", None)], schema))
    whole = quality.quality_metrics(daily, daily.select("artist_key").distinct(), bronze, daily).first()
    assert tuple(whole) == (b, 2, 2, 1, 3, 3, 5, 2)
    counts = quality.day_counts(daily.limit(0), bronze.limit(0))
    for day in (a, b, c):
        on_day = F.col("snapshot_date") == F.lit(day)
        counts = counts.unionByName(quality.day_counts(daily.filter(on_day), bronze.filter(on_day)))
    assert quality.metrics_of_days(counts, daily.select("artist_key").distinct(), daily).first() == whole
    none = daily.limit(0)
    assert tuple(quality.quality_metrics(none, none, none, none).first()) == (None, 0, 0, 0, 0, 0, 0, 0)


def test_a_lost_write_leaves_the_table_readable(spark, tmp_path):
    lake = pipeline.Lake(spark, str(tmp_path / "lake"))
    lake.rebuild(spark.range(3), "gold", "t")
    held = lake.read("gold", "t")
    fails = spark.range(5, numPartitions=5).withColumn("id", F.when(F.col("id") == 4, F.raise_error(F.lit("lost")).cast("bigint")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        lake.rebuild(fails, "gold", "t")
    # A run that ends without cleaning up leaves files, but no mark that they are all there.
    half = tmp_path / "lake" / "gold" / "t" / "version=7"
    spark.range(99).write.parquet(str(half))
    (half / "_SUCCESS").unlink()
    assert lake.read("gold", "t").count() == 3
    # A table may be replaced by what is read from itself, and readers under way keep their version.
    assert lake.rebuild(lake.read("gold", "t").filter("id > 0"), "gold", "t").count() == 2
    assert held.count() == 3
    lake.rebuild(lake.read("gold", "t"), "gold", "t")
    assert sorted(p.name for p in half.parent.iterdir()) == ["version=8", "version=9"]


def test_a_first_day_with_artists_only(spark, tmp_path):
    root, lake = tmp_path / "landing", pipeline.Lake(spark, str(tmp_path / "lake"))
    (root / "candidates").mkdir(parents=True)
    (root / "candidates" / "pool.jsonl").write_text('{"artist_key": "k"}\n' * 14)
    write(root, "lastfm/artist_info", FIRST, [artist(i, FIRST, 20_000 + i, 9) for i in range(14)])
    metrics = pipeline.run_all(lake, str(root), F.lit(FIRST)).first()
    assert (metrics.latest_rows, metrics.gold_rows) == (14, 14)
    rows = lake.read("gold", "artist_signals").collect()
    assert all(r.breakout_score is None and r.is_provisional for r in rows)
    assert lake.read("gold", "upcoming_shows").count() == 0
