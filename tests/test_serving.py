import datetime as dt

import pytest
from pyspark.sql import functions as F

from upswell.functions import numbers
from upswell.plans import briefs, pool, profile, quality, ranking, shows

TODAY = dt.date(2024, 5, 1)
SIGNALS = (
    "artist_key string, name string, as_of_date date, genres string, tags array<string>, "
    "lastfm_listeners bigint, size_band string, breakout_score double, "
    "listeners_7d_growth_pct double, growth_window_days int, is_provisional boolean, "
    "new_country_charts_14d int, chart_countries array<string>, possible_alias_of string"
)


def act(key, score, band="10k-50k", tags=(), charts=(), alias=None, size=20_000, new=0):
    return (
        key, f"Act {key}", TODAY, ", ".join(tags[:3]), list(tags), size, band, score, 1.5, 9, False,
        new, list(charts), alias,
    )


@pytest.fixture(scope="module")
def signals(spark):
    rows = [
        act("a", 90.0, tags=["Indie Pop", "canadian"], charts=["Brazil"], new=1),
        act("b", 90.0, tags=["trap"], size=10_000),
        act("c", 95.0, band="2M+", tags=["pop"], charts=["Canada", "Brazil"], new=2),
        act("d", 99.0, tags=["pop"], alias="D real", charts=["Brazil"], new=1),
        act("e", None, tags=["pop"], charts=["Brazil"], new=1),
        act("f", 50.0, tags=["Canadian rock"], band="<10k"),
        act("g", 40.0, tags=["canadiana"], band="<10k"),
    ]
    return spark.createDataFrame(rows, SIGNALS)


def keys(df):
    return [r.artist_key for r in df.collect()]


def test_top_risers(signals):
    assert keys(ranking.top_risers(signals)) == ["b", "a", "f", "g"]
    assert keys(ranking.top_risers(signals, include_superstars=True)) == ["c", "b", "a", "f", "g"]
    assert keys(ranking.top_risers(signals, size_band="2M+")) == ["c"]
    assert keys(ranking.top_risers(signals, genre="rap")) == ["b"]
    assert keys(ranking.top_risers(signals, genre="rap", whole_tag=True)) == []
    assert keys(ranking.top_risers(signals, limit=0)) == ["b"]


def test_country_evidence(signals):
    rows = ranking.top_risers(signals, country="CA", include_superstars=True).collect()
    assert [(r.artist_key, r.country_evidence) for r in rows] == [("c", "chart"), ("a", "tag"), ("f", "tag")]
    assert keys(ranking.new_on_charts(signals, "Brazil")) == ["c", "a", "e"]


@pytest.mark.parametrize(
    "text, name", [("ca", "Canada"), ("Canadian", "Canada"), (" UK ", "United Kingdom"), ("GB", "United Kingdom"),
                   ("south korea", "Korea, Republic of"), ("MÉXICO", "Mexico")]
)
def test_country_names(spark, text, name):
    assert ranking.country_name(text)[0] == name
    df = spark.createDataFrame([(text,)], "t string")
    assert ranking.with_country_names(df, "t").first().country_name == name


def test_bad_arguments():
    with pytest.raises(ranking.BadRequest, match="Narnia"):
        ranking.country_name("Narnia")
    with pytest.raises(ranking.BadRequest):
        ranking.band_name("huge")
    assert ranking.band_name(" 500K-2m ") == "500k-2M"


def test_data_notes(signals):
    r = ranking.data_notes(signals, F.lit(TODAY + dt.timedelta(3))).first()
    assert (r.age_days, r.median_window_days) == (3, 9.0)
    assert len(r.notes) == 2 and "2024-04-22" in r.notes[1]


EVENTS = "event_id string, event_date date, status string, city string, min_price double, venue string, event_name string, local_time string, max_price double, currency string, ticket_url string"


def event(event_id, days, status="onsale", city="Montréal", price=None):
    return (event_id, TODAY + dt.timedelta(days), status, city, price, "V", "N", None, price, "CAD", "u")


@pytest.fixture(scope="module")
def show_rows(spark, signals):
    events = spark.createDataFrame(
        [
            event("e1", 2, price=20.0), event("e2", 5, city="montreal"), event("e3", -1),
            event("e4", 3, status="cancelled"), event("e5", 3, status=None), event("e6", 20, city="Toronto", price=60.0),
            event("e7", 40, city="Toronto", price=0.0),
        ],
        EVENTS,
    )
    bill = spark.createDataFrame(
        [(f"e{i}", n, f"x{n}", f"P{n}") for i in range(1, 8) for n in range(8)],
        "event_id string, billing_order int, attraction_id string, performer_name string",
    )
    matches = spark.createDataFrame(
        [("x0", "a", "A", "exact"), ("x1", "c", "C", "review"), ("x2", "zz", "Untracked", "mbid"), ("x3", "f", "F", "fuzzy")],
        "attraction_id string, artist_key string, artist_name string, match_method string",
    )
    return shows.upcoming_shows(events, bill, matches, signals, F.lit(TODAY)), bill


def test_upcoming_shows(show_rows):
    rows = show_rows[0].collect()
    assert {r.event_id for r in rows} == {"e1", "e2", "e6", "e7"}
    assert {(r.artist_key, r.artist_name, r.is_headliner) for r in rows} == {
        ("a", "Act a", True),
        ("zz", "Untracked", False),
        ("f", "Act f", False),
    }


def search(show_rows, signals, **kw):
    return shows.show_search(show_rows[0], show_rows[1], signals, F.lit(TODAY), **kw).collect()


def test_show_search(show_rows, signals):
    rows = search(show_rows, signals, city="MONTREAL", limit=50)
    assert {r.event_id for r in rows} == {"e1", "e2"} and len(rows) == 6
    assert rows[0].total_matches == 6 and rows[0].priced_matches == 3
    head = next(r for r in rows if r.artist_key == "a")
    assert (head.role, head.headliner, head.lineup_size) == ("headliner", "P0", 8)
    assert head.lineup == ["P0", "P1", "P2", "P3", "P4", "P5"]
    assert {r.event_id for r in search(show_rows, signals, max_price=30.0)} == {"e1", "e2"}
    assert {r.event_id for r in search(show_rows, signals, max_price=30.0, require_price=True)} == {"e1"}
    assert {r.artist_key for r in search(show_rows, signals, min_score=60.0)} == {"a"}
    assert {r.artist_key for r in search(show_rows, signals, genre="ROCK")} == {"f"}
    with pytest.raises(ranking.BadRequest, match="Montréal"):
        search(show_rows, signals, city="Paris")
    for bad in ({"days_ahead": 0}, {"days_ahead": 91}, {"max_price": -1.0}, {"min_score": 101.0}):
        with pytest.raises(ranking.BadRequest):
            search(show_rows, signals, **bad)


def test_shows_elsewhere(show_rows):
    rows = shows.shows_elsewhere(show_rows[0], "toronto").filter("artist_key = 'a'").collect()
    assert sorted((r.place, r.event_id) for r in rows) == [(1, "e1"), (2, "e2")]


NOW = dt.datetime(2024, 5, 1, 12)


@pytest.mark.parametrize(
    "code, start, end, want",
    [
        ("onsale", None, None, "on sale"),
        ("canceled", None, None, "canceled"),
        ("cancelled", None, None, "canceled"),
        ("postponed", None, None, "postponed"),
        ("offsale", NOW + dt.timedelta(1), NOW + dt.timedelta(9), "not on sale yet"),
        ("offsale", NOW - dt.timedelta(1), NOW + dt.timedelta(9), "off sale"),
        ("offsale", NOW - dt.timedelta(9), NOW - dt.timedelta(1), "sales closed"),
        ("offsale", None, None, "sales closed"),
        (None, None, None, "unknown"),
        ("else", None, None, "unknown"),
    ],
)
def test_ticket_status(spark, code, start, end, want):
    df = spark.createDataFrame([("s", code, start, end)], "k string, code string, a timestamp, b timestamp")
    got = df.select(numbers.ticket_status(F.col("code"), F.col("a"), F.col("b"), F.lit(NOW))).first()[0]
    assert got == want


def test_ticket_notes(spark):
    listed = spark.createDataFrame([("e1",), ("e2",), ("e3",), ("e4",)], "event_id string")
    statuses = spark.createDataFrame(
        [("e1", "canceled", None, None, None), ("e2", "rescheduled", None, None, dt.date(2024, 6, 1)),
         ("e3", "offsale", NOW + dt.timedelta(1), None, None)],
        "event_id string, status_code string, sale_start timestamp, sale_end timestamp, new_date date",
    )
    got = {r.event_id: r for r in shows.with_ticket_status(listed, statuses, F.lit(NOW)).collect()}
    assert set(got) == {"e2", "e3", "e4"}
    assert got["e2"].ticket_note == "Listed as rescheduled; date now 2024-06-01."
    assert got["e3"].ticket_note == "Public sale starts 2024-05-02."
    assert got["e4"].ticket_status == "unknown" and got["e4"].ticket_note


def test_recount_after_cancellations(spark):
    listed = spark.createDataFrame([("e1", "X"), ("e2", "X"), ("e3", "Y")], "event_id string, city string")
    statuses = spark.createDataFrame(
        [("e1", "canceled", None, None, None), ("e3", "onsale", None, None, None)],
        "event_id string, status_code string, sale_start timestamp, sale_end timestamp, new_date date",
    )
    whole = shows.ticket_recount(listed, statuses, F.lit(NOW)).first()
    assert (whole["count"], whole.canceled, whole.notes[1:]) == (2, 1, ["1 canceled since and left out"])
    assert whole["count"] == shows.with_ticket_status(listed, statuses, F.lit(NOW)).count()
    cities = {r.city: r for r in shows.ticket_recount(listed, statuses, F.lit(NOW), by=["city"]).collect()}
    assert (cities["X"]["count"], cities["X"].canceled) == (1, 1)
    assert (cities["Y"].canceled, len(cities["Y"].notes)) == (0, 1)
    none = shows.ticket_recount(listed.limit(0), statuses, F.lit(NOW)).first()
    assert (none["count"], none.canceled) == (0, 0)


def test_window_past_what_is_known(signals):
    late = shows.search_window(signals, F.lit(TODAY + dt.timedelta(3)), 90).first()
    assert late.first_day == TODAY + dt.timedelta(3) and late.last_day == TODAY + dt.timedelta(93)
    assert late.note.endswith("2024-07-30")
    assert shows.search_window(signals, F.lit(TODAY), 90).first().note is None


@pytest.mark.parametrize("day, window", [(1, (3, 5)), (3, (3, 5)), (4, (4, 5)), (5, (5, 5)), (6, (10, 12))])
def test_weekend(spark, day, window):
    start, end = numbers.weekend_window(F.lit(dt.date(2024, 5, day)))
    r = spark.range(1).select(start.alias("a"), end.alias("b")).first()
    assert (r.a.day, r.b.day) == window


GOOD = {
    "latest_date": TODAY, "pool_size": 100, "latest_rows": 95, "duplicate_rows": 0, "bronze_latest_rows": 97,
    "bronze_latest_distinct_names": 95, "gold_rows": 95, "gold_bad_scores": 0,
}
METRICS = "latest_date date, pool_size bigint, latest_rows bigint, duplicate_rows bigint, bronze_latest_rows bigint, bronze_latest_distinct_names bigint, gold_rows bigint, gold_bad_scores bigint"


@pytest.mark.parametrize(
    "change, word",
    [
        ({}, None),
        ({"latest_date": TODAY - dt.timedelta(1)}, None),
        ({"latest_date": TODAY - dt.timedelta(2)}, "latest day"),
        ({"latest_date": None}, "no day"),
        ({"latest_rows": 89, "gold_rows": 89, "bronze_latest_distinct_names": 89}, "tracked"),
        ({"pool_size": 0}, None),
        ({"duplicate_rows": 1}, "repeat"),
        ({"bronze_latest_distinct_names": 97}, "parse"),
        ({"gold_rows": 94}, "signal rows"),
        ({"gold_bad_scores": 2}, "within"),
    ],
)
def test_quality_rules(spark, change, word):
    m = {**GOOD, **change}
    df = spark.createDataFrame([tuple(m.values())], METRICS)
    if word is None:
        quality.require_quality(df, F.lit(TODAY))
    else:
        with pytest.raises(quality.QualityCheckFailed, match=word):
            quality.require_quality(df, F.lit(TODAY))


POOL = "artist_key string, name string, mbid string, source string, added_date date, pool_date date"
SEEDS = "artist_key string, name string, mbid string, source string, position bigint"


def merged(spark, existing, seeds, neighbours, size, share=0.4):
    old = dt.date(2024, 1, 1)
    out = pool.merge_pool(
        spark.createDataFrame([(k, n, None, s, old, old) for k, n, s in existing], POOL),
        spark.createDataFrame([(k, n, None, "geo:X", i) for i, (k, n) in enumerate(seeds)], SEEDS),
        spark.createDataFrame(
            [(k, n, None, "similar:x", i, v) for i, (k, n, v) in enumerate(neighbours)], SEEDS + ", votes bigint"
        ),
        F.lit(TODAY),
        size,
        share,
    )
    rows = out.collect()
    assert {r.pool_date for r in rows} <= {TODAY}
    return {r.artist_key for r in rows}


def test_pool_merge(spark):
    seeds = [("s1", "S One"), ("s2", "S Two"), ("s3", "S Three"), ("s4", "S Four")]
    near = [("n1", "N One", 1), ("n2", "N Two", 5), ("n3", "Ñ two", 9)]
    # Two seeds fill their share of five, then neighbours by votes; n2 repeats n3's name.
    assert merged(spark, [], seeds, near, 5) == {"s1", "s2", "n3", "n1", "s3"}
    assert merged(spark, [], seeds, near, 3) == {"s1", "n3", "n1"}
    # Members stay even over the cap; their seeds use up the share.
    old = [("o1", "Old", "geo:Y"), ("o2", "n ONE", "tag:z"), ("o3", "Old 3", "similar:q")]
    assert merged(spark, old, seeds, near, 2) == {"o1", "o2", "o3"}
    assert merged(spark, old, seeds, near, 5) == {"o1", "o2", "o3", "n3", "s1"}


def test_event_performers_have_their_own_cap(spark):
    have = spark.createDataFrame(
        [("k1", "Known", None, "event:T", TODAY, TODAY), ("k2", "Seed", None, "geo:X", TODAY, TODAY)], POOL
    )
    acts = spark.createDataFrame(
        [("k1", "Other", None, "event:T", 0), ("x", "SEED", None, "event:T", 1), ("y", "Yes", None, "event:T", 2),
         ("z", "yes", None, "event:T", 3), ("w", "Last", None, "event:T", 4)],
        SEEDS,
    )
    assert {r.artist_key for r in pool.add_event_performers(have, acts, F.lit(TODAY), 2).collect()} == {"k1", "k2", "y"}
    assert {r.artist_key for r in pool.add_event_performers(have, acts, F.lit(TODAY), 9).collect()} == {"k1", "k2", "y", "w"}
    assert pool.add_event_performers(have, acts, F.lit(TODAY), 0).count() == 2


def test_pool_age(spark):
    def stale(*days):
        rows = [("k", "n", None, "s", d, d) for d in days]
        return pool.pool_is_stale(spark.createDataFrame(rows, POOL), F.lit(TODAY)).first().stale

    assert stale()
    assert not stale(TODAY - dt.timedelta(30), TODAY - dt.timedelta(6))
    assert stale(TODAY - dt.timedelta(7))


RESPONSE = "artist_key string, response struct<result:string,errorMessage:string>, model string, generated_at timestamp_ntz"


def test_brief_columns(spark):
    texts = {
        "label": "### Who they are\nX\n### Signing status\n Signed to “Y” – 2019 \n### Where\nZ",
        "none": "### Signing status\nNo label mentioned in the Last.fm bio (not confirmed unsigned).",
        "missing": "### Who they are\nX",
        "blank": "   ",
        "null": None,
    }
    rows = [(k, (v, "boom" if k == "null" else None), "m1", dt.datetime(2024, 1, 1)) for k, v in texts.items()]
    raw = spark.createDataFrame(rows, RESPONSE)
    got = {r.artist_key: r for r in briefs.parse_briefs(raw, "v2").collect()}
    assert got["label"].signing_status == "Signed to “Y” - 2019" and got["label"].label_mentioned
    assert got["none"].label_mentioned is False
    assert got["missing"].label_mentioned is None and got["missing"].error is None
    assert (got["blank"].brief_md, got["blank"].error) == (None, "empty response")
    assert got["null"].error == "boom"
    again = spark.createDataFrame(
        [(k, ("### Signing status\nSecond", None), "m2", dt.datetime(2024, 1, 2)) for k in ("blank", "label")], RESPONSE
    )
    merged_rows = {r.artist_key: r for r in briefs.merge_retries(raw, again).collect()}
    assert merged_rows["blank"].model == "m2" and merged_rows["blank"].response.result.endswith("Second")
    assert merged_rows["label"].model == "m1" and merged_rows["null"].model == "m1"


def test_prompt_with_nothing_known(spark):
    df = spark.createDataFrame(
        [("k", "Solo", TODAY, None, None, 55.5, None, None, None, None, True, None, None, None, None, None)],
        "artist_key string, name string, as_of_date date, lastfm_listeners bigint, size_band string, "
        "breakout_score double, listeners_7d_growth_pct double, listeners_14d_growth_pct double, "
        "growth_window_days int, bio_summary string, is_provisional boolean, new_country_charts_14d int, "
        "chart_countries array<string>, tags array<string>, similar_names array<string>, "
        "shows array<struct<event_date:date,event_id:string,venue:string,city:string,min_price:double,currency:string>>",
    )
    prompt = briefs.prompts(df).first().prompt
    for line in ("Listeners: n/a", "Tags: none", "Similar: none listed", "Bio: none", "- none found", "Charts today: none", "14 days: 0"):
        assert line in prompt
    with_show = df.withColumn(
        "shows",
        F.expr("array(named_struct('event_date', DATE'2024-06-01', 'event_id', 'e', 'venue', 'V', 'city', 'C', 'min_price', 24.5D, 'currency', 'CAD'))"),
    )
    assert "- 2024-06-01: V, C (from 24 CAD)" in briefs.prompts(with_show).first().prompt
    assert "rank n/a" in prompt and "new listeners n/a" in prompt and "Play growth, 7 days: n/a" in prompt
    more = with_show.withColumns(
        {"n_shows": F.lit(4).cast("bigint"), "breakout_rank": F.lit(3), "new_listeners_7d": F.lit(1234).cast("bigint"),
         "plays_7d_growth_pct": F.lit(-2.25)}
    )
    prompt = briefs.prompts(more).first().prompt
    for line in ("of 100, rank 3", "new listeners 1,234,", "Play growth, 7 days: -2.2%", "(from 24 CAD)\n- and 3 more"):
        assert line in prompt


def test_brief_lists_first_shows_and_counts_all(spark, signals, show_rows):
    profile_rows = spark.createDataFrame([("a", "bio", ["x"])], "artist_key string, bio_summary string, similar_names array<string>")
    got = {r.artist_key: r for r in briefs.brief_facts(signals, profile_rows, show_rows[0], first_shows=2).collect()}
    every = show_rows[0].filter("artist_key = 'a'").orderBy("event_date", "event_id").collect()
    assert len(every) > 2 and got["a"].n_shows == len(every)
    assert [s.event_id for s in got["a"].shows] == [r.event_id for r in every[:2]]
    assert got["b"].shows is None and got["b"].n_shows is None


def test_latest_brief_needs_text(spark):
    df = spark.createDataFrame(
        [("k", "old", 1), ("k", "new", 2), ("k", None, 3)], "artist_key string, brief_md string, generated_at int"
    )
    assert [r.brief_md for r in profile.latest_briefs(df).collect()] == ["new"]
