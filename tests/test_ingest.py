import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from upswell.functions import variants
from upswell.operators import latest
from upswell.sources import catalog, export, landing
from upswell.streaming.landing_stream import follow_landing


def drop(root, day, lines, name="part-0.jsonl"):
    folder = root / "info" / f"dt={day}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def days(spark, path):
    rows = spark.read.parquet(path).groupBy("snapshot_date").count().collect()
    return {str(r.snapshot_date): r["count"] for r in rows}


def test_only_day_folders_count(spark, tmp_path):
    drop(tmp_path, "2024-01-02", ["{}"])
    drop(tmp_path, "2024-01-01", ["{}"])
    (tmp_path / "info" / "_tmp").mkdir()
    (tmp_path / "info" / "notes.txt").write_text("x")
    assert landing.landed_days(spark, str(tmp_path), "info") == ["2024-01-01", "2024-01-02"]
    assert landing.landed_days(spark, str(tmp_path), "missing") == []


def test_reload_replaces_recent_days_and_fills_gaps(spark, tmp_path):
    root, out = str(tmp_path), str(tmp_path / "bronze")
    for day in ("2024-01-01", "2024-01-02", "2024-01-04"):
        drop(tmp_path, day, ['{"a": 1}', "not json"])
    assert landing.ingest(spark, root, "info", out) == ["2024-01-01", "2024-01-02", "2024-01-04"]
    drop(tmp_path, "2024-01-01", ['{"a": 2}'] * 5)  # too old to be read again
    drop(tmp_path, "2024-01-04", ['{"a": 2}'] * 3)
    drop(tmp_path, "2024-01-03", ['{"a": 3}'])
    assert landing.ingest(spark, root, "info", out) == ["2024-01-03", "2024-01-04"]
    assert days(spark, out) == {"2024-01-01": 2, "2024-01-02": 2, "2024-01-03": 1, "2024-01-04": 3}
    assert spark.read.parquet(out).filter("raw IS NULL").select("_bad_line").distinct().collect()[0][0] == "not json"
    (tmp_path / "info" / "dt=2024-01-04" / "part-0.jsonl").write_text("")  # reloaded as empty
    assert landing.ingest(spark, root, "info", out) == ["2024-01-03", "2024-01-04"]
    assert days(spark, out) == {"2024-01-01": 2, "2024-01-02": 2, "2024-01-03": 1}


def test_days_to_load(spark):
    f = lambda *d: spark.createDataFrame([(x,) for x in d], "day string")
    got = landing.days_to_load(f("1", "2", "3", "4"), f("1", "3", "4"), 2).collect()
    assert sorted(r.day for r in got) == ["2", "3", "4"]
    got = landing.days_to_load(f("1", "2"), f("1"), 0).collect()
    assert [r.day for r in got] == ["2"]


def test_stream_keeps_earlier_files_of_a_day(spark, tmp_path):
    root, out, progress = str(tmp_path), str(tmp_path / "bronze"), str(tmp_path / "progress")
    drop(tmp_path, "2024-01-01", ['{"a": 1}'] * 2)
    follow_landing(spark, root, "info", out, progress).awaitTermination()
    assert days(spark, out) == {"2024-01-01": 2}
    drop(tmp_path, "2024-01-01", ['{"a": 2}'], "part-1.jsonl")
    drop(tmp_path, "2024-01-02", ['{"a": 3}'])
    follow_landing(spark, root, "info", out, progress).awaitTermination()
    assert days(spark, out) == {"2024-01-01": 3, "2024-01-02": 1}
    follow_landing(spark, root, "info", out, progress).awaitTermination()
    assert days(spark, out) == {"2024-01-01": 3, "2024-01-02": 1}


RECORD = {
    "snapshot_date": "2024-01-02",
    "fetched_at": "2024-01-02T03:04:05+00:00",
    "artist_key": "mbid:1",
    "name": "A",
    "payload": {
        "name": "A",
        "mbid": "",
        "stats": {"listeners": "12", "playcount": "many"},
        "tags": {"tag": [{"name": "pop"}, {"name": "Indie"}]},
        "similar": {"artist": {"name": "B"}},
        "ontour": "1",
        "url": "u",
        "bio": {"summary": 'Hi <a href="x">Read</a>.'},
    },
}


def test_shapes_of_an_artist_line(spark):
    other = json.loads(json.dumps(RECORD))
    other["payload"]["tags"] = {"tag": ""}
    del other["payload"]["similar"]
    df = spark.createDataFrame([(json.dumps(RECORD),), (json.dumps(other),)], "value string").select(
        F.lit(dt.date(2024, 1, 2)).alias("snapshot_date"), F.try_parse_json("value").alias("raw")
    )
    a, b = landing.parse_artists(df).collect()
    assert (a.mbid, a.lastfm_listeners, a.lastfm_playcount, a.on_tour) == (None, 12, None, True)
    assert (a.tags, a.similar_names) == (["pop", "Indie"], ["B"])
    assert (b.tags, b.similar_names) == ([], [])
    assert a.fetched_at == dt.datetime(2024, 1, 2, 3, 4, 5)


EVENT = {
    "id": "e1",
    "name": "Night",
    "url": "u",
    "dates": {"start": {"localDate": "2024-05-01"}, "status": {"code": "onsale"}},
    "priceRanges": [{"min": 20, "max": 40.5, "currency": "CAD"}],
    "_embedded": {
        "venues": [{"name": "", "address": {"line1": "1 Main St"}, "city": {"name": "Montréal"}}],
        "attractions": [
            {"id": "k1", "name": "Head", "externalLinks": {"musicbrainz": [{"id": "M1"}]}},
            {"name": "Opener"},
        ],
    },
}


def test_event_lines(spark):
    bad_date = {**EVENT, "id": "e2", "dates": {"start": {"localDate": "TBA"}}}
    off = {**EVENT, "id": "e3", "dates": {**EVENT["dates"], "status": {"code": "cancelled"}}}
    bare = {"id": "e4", "dates": {"start": {"localDate": "2024-05-02"}}}
    lines = spark.createDataFrame(
        [(json.dumps({"payload": p}),) for p in (EVENT, bad_date, off, bare)], "value string"
    ).select(F.try_parse_json("value").alias("raw"))
    events = {r.event_id: r for r in landing.bookable(landing.parse_events(lines)).collect()}
    assert set(events) == {"e1", "e4"}
    e = events["e1"]
    assert (e.venue, e.city, e.min_price, e.max_price, e.currency) == ("1 Main St", "Montréal", 20.0, 40.5, "CAD")
    assert events["e4"].min_price is None and events["e4"].venue is None
    bill = landing.parse_bills(lines).filter("event_id = 'e1'").orderBy("billing_order").collect()
    assert [(r.billing_order, r.attraction_id, r.performer_mbid) for r in bill] == [
        (0, "k1", "M1"),
        (1, "Opener", None),
    ]


def test_newest_event_line_wins(spark):
    rows = [("2024-01-01", "a", "9"), ("2024-01-02", "a", "1"), ("2024-01-02", "a", "2"), ("2024-01-02", "b", "1")]
    df = spark.createDataFrame(rows, "snapshot_date string, id string, t string").select(
        "snapshot_date",
        F.try_parse_json(
            F.to_json(F.struct(F.struct("id").alias("payload"), F.col("t").alias("fetched_at")))
        ).alias("raw"),
    )
    got = landing.latest_events(df).select(
        variants.at("raw", "$.payload.id"), variants.at("raw", "$.fetched_at")
    )
    assert sorted(tuple(r) for r in got.collect()) == [("a", "2"), ("b", "1")]


def test_name_day_keeps_the_id_key(spark):
    rows = [
        ("name:a", "A", None, 5, "2024-01-02 01:00:00"), ("mbid:1", "a", "1", 7, "2024-01-02 00:00:00"),
        ("mbid:1", "a", "1", 8, "2024-01-02 02:00:00"), ("name:b", "B", None, None, "2024-01-02 00:00:00"),
    ]
    df = spark.createDataFrame(
        [(*r[:4], r[4]) for r in rows], "artist_key string, name string, mbid string, lastfm_listeners bigint, t string"
    ).selectExpr(
        "*", "DATE'2024-01-02' snapshot_date", "1L lastfm_playcount", "array('x') tags", "true on_tour",
        "CAST(t AS TIMESTAMP) fetched_at",
    )
    got = latest.artist_daily(df).collect()
    assert [(r.artist_key, r.lastfm_listeners) for r in got] == [("mbid:1", 8)]


def test_tables_comments_views(spark, tmp_path):
    names = catalog.Names(prefix="t_dev_")
    catalog.create_schemas(spark, names, str(tmp_path))
    table = names("gold", "artist_signals")
    catalog.rebuild(spark.range(3).toDF("n"), table, "It's a table", {"n": "how many"})
    catalog.rebuild(spark.range(2).selectExpr("id AS m", "'x' AS t"), table, columns={"m": "it's m"})
    assert spark.table(table).columns == ["m", "t"]
    assert {r.col_name: r.comment for r in catalog.descriptions(spark, table).collect()}["m"] == "it's m"
    catalog.save_view(f"SELECT m FROM {table} WHERE m > 0", spark, names("gold", "late"))
    assert [r.m for r in spark.table(names("gold", "late")).collect()] == [1]
    with pytest.raises(ValueError):
        names("platinum", "x")


def test_export_round_trip(spark, tmp_path):
    tables = {}
    for name, columns in export.COLUMNS.items():
        kinds = {
            "tags": "array('a \"q\"', 'b,c')", "chart_countries": "CAST(array() AS ARRAY<STRING>)",
            "generated_at": "TIMESTAMP'2024-01-01 05:00:00+05:00'", "match": "0.5D",
        }
        exprs = [f"{kinds.get(c, repr(c))} AS `{c}`" for c in columns]
        if name == "artist_growth_history":
            exprs[columns.index("snapshot_date")] = "date_add(DATE'2024-01-01', CAST(id * 40 AS INT)) AS snapshot_date"
        if name == "scout_briefs":
            exprs.append("IF(id = 0, 'failed', NULL) AS error")
        tables[name] = spark.range(35).selectExpr(*exprs)
    with pytest.raises(ValueError, match="artist_similar"):
        export.write_export({k: v for k, v in tables.items() if k != "artist_similar"}, str(tmp_path), "x")
    meta = export.write_export(tables, str(tmp_path / "p"), "files:x")
    counts = {r.table_name: r.row_count for r in meta.collect()}
    assert counts["artist_growth_history"] == 30 and counts["scout_briefs"] == 34
    briefs = export.read_table(spark, str(tmp_path / "p"), "scout_briefs")
    assert dict(briefs.dtypes)["generated_at"] == "timestamp_ntz"
    assert briefs.first().generated_at == dt.datetime(2024, 1, 1)
    export.write_export(tables, str(tmp_path / "c"), "files:x", format="csv")
    back = export.read_table(spark, str(tmp_path / "c"), "artist_signals").first()
    assert back.tags == ['a "q"', "b,c"] and back.chart_countries == []
    with pytest.raises(FileNotFoundError):
        export.read_table(spark, str(tmp_path), "artist_signals")


def test_update_matched_takes_nulls_too(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, v string, w int")
    fresh = spark.createDataFrame([(2, None), (3, "z")], "k int, v string")
    got = catalog.update_matched(target, fresh, "k", ["v"]).orderBy("k").collect()
    assert [tuple(r) for r in got] == [(1, "a", 1), (2, None, 2)]


@pytest.mark.parametrize(
    "contract, line, problem",
    [
        ("chart", '{"country": "CA", "rank": 1, "name": "A", "listeners": 5}', None),
        ("chart", '{"country": "CA", "rank": 1, "name": "A", "beyond": [1]}', None),
        ("chart", '{"country": "CA", "rank": "first", "name": "A"}', "wrong type"),
        ("chart", '{"country": null, "rank": 1, "name": "A"}', "missing country"),
        ("chart", '{"country": "CA", "rank": 1, "name"', "not JSON"),
        ("chart", "", "not JSON"),
        ("chart", None, "not JSON"),
        ("edge", '{"from_key": "a", "match": 0.5}', "missing to_key"),
        ("edge", '{"from_key": "a", "to_key": "b", "match": {}}', "wrong type"),
        ("artist", '{"artist_key": "a", "payload": {"name": "A", "stats": {"listeners": "7"}}}', None),
        ("artist", '{"artist_key": "a", "payload": {}}', "missing payload.name"),
        ("artist", '{"artist_key": "a"}', "missing payload.name"),
        ("event", '{"payload": {"id": "e", "priceRanges": [{"min": 1.5}]}}', None),
        ("event", '{"payload": {"id": "e", "priceRanges": [{"min": "free"}]}}', "wrong type"),
    ],
)
def test_landing_contract(spark, contract, line, problem):
    lines = spark.createDataFrame([(line, 1)], "value string, problem_of int")
    assert landing.against_contract(lines, contract).first().problem == problem
    kept, quarantine = landing.split_landing(lines, contract)
    assert (kept.count(), quarantine.count()) == ((1, 0) if problem is None else (0, 1))
    assert [r.asDict() for r in landing.contract_counts(lines, contract).collect()] == [
        {"problem": problem, "lines": 1, "contract": contract}
    ]


def test_quarantine_keeps_the_line(spark):
    lines = spark.createDataFrame([('{"from_key": "a"}', "f1"), ('{"from_key": "a", "to_key": "b"}', "f2")], "value string, file string")
    kept, quarantine = landing.split_landing(lines, "edge")
    assert [tuple(r) for r in quarantine.collect()] == [('{"from_key": "a"}', "f1", "missing to_key")]
    assert kept.columns == ["from_key", "to_key", "to_name", "match"]
    assert landing.contract_counts(lines.limit(0), "edge").count() == 0


def test_dataset_is_replaced_whole(spark, tmp_path):
    for name, lines in (("one", ['{"a": 1}', '{"a": 2}']), ("two", ['{"b": "x"}'])):
        (tmp_path / f"{name}.jsonl").write_text("\n".join(lines))
        landing.replace_pool(spark, str(tmp_path / f"{name}.jsonl"), str(tmp_path / "pool"))
    rows = spark.read.parquet(str(tmp_path / "pool")).select(variants.at("raw", "$.b").alias("b"), variants.at("raw", "$.a").alias("a"))
    assert [tuple(r) for r in rows.collect()] == [("x", None)]
