import random

import pytest
from pyspark.sql import functions as F

from upswell.functions import text
from upswell.operators import fuzzy
from upswell.plans import resolve


def one(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize(
    "raw, want",
    [
        ("  Sigur   Rós ", "sigur ros"),
        ("BJÖRK", "bjork"),
        ("MØ", "mø"),
        ("Straße", "strasse"),
        ("ﬁre", "fire"),
    ],
)
def test_normalize_name(spark, raw, want):
    assert one(spark, text.normalize_name(F.lit(raw))) == want


@pytest.mark.parametrize(
    "raw, want",
    [
        ("The Beatles", "beatles"),
        ("The The", "the"),
        ("the", "the"),
        ("Simon & Garfunkel", "simon and garfunkel"),
        ("Godspeed You! Black Emperor", "godspeed you black emperor"),
        ("Ólafur  Arnalds", "olafur arnalds"),
        ("!!!", ""),
    ],
)
def test_match_form(spark, raw, want):
    assert one(spark, text.match_form(F.lit(raw))) == want


def test_keys(spark):
    df = spark.createDataFrame([("Röyksopp", "AB-1"), ("Röyksopp", ""), ("Röyksopp", None)], "n string, m string")
    got = [r[0] for r in df.select(text.entity_key(F.col("n"), F.col("m"))).collect()]
    assert got == ["mbid:ab-1", "name:royksopp", "name:royksopp"]


ARTISTS = [
    ("mbid:1", "Black Country, New Road", "1"),
    ("name:simon", "Simon & Garfunkel", None),
    ("name:ajr", "AJR", None),
    ("name:abba", "ABBA", None),
    ("mbid:9", "Sigur Rós", "Id-9"),
    ("name:beatles", "The Beatles", None),
]
CASES = [
    ("Black Country, New Roads", None, "mbid:1", "fuzzy"),
    ("Simon and Garfunkle", None, "name:simon", "review"),
    ("AJJ", None, None, "none"),
    ("ABBA Tribute Show", None, None, "tribute"),
    ("A Night of ABBA", None, None, "tribute"),
    ("Some Other Billing", "iD-9", "mbid:9", "mbid"),
    ("sigur ros", "", "mbid:9", "exact"),
    ("Beatles", "unknown-id", "name:beatles", "exact"),
    ("Garfunkel & Simon", None, "name:simon", "fuzzy"),
    ("!!!", None, None, "none"),
]


def test_cascade(spark):
    acts = [(f"a{i}", name, mbid) for i, (name, mbid, _, _) in enumerate(CASES)]
    out = resolve.match_performers(
        spark.createDataFrame(acts + acts[:2], "attraction_id string, performer_name string, performer_mbid string"),
        spark.createDataFrame(ARTISTS, "artist_key string, name string, mbid string"),
    )
    got = {r.performer_name: (r.artist_key, r.match_method) for r in out.collect()}
    assert out.count() == len(CASES)
    assert got == {name: (key, method) for name, _, key, method in CASES}
    score = {r.performer_name: r.match_score for r in out.collect()}
    assert score["AJJ"] == 0.0 and score["sigur ros"] == 100.0
    assert score["Garfunkel & Simon"] == 100.0


def plain_lcs(a, b):
    row = [0] * (len(a) + 1)
    for ch in b:
        new = [0]
        for j, x in enumerate(a):
            new.append(row[j] + 1 if x == ch else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_lcs_against_the_textbook():
    rng = random.Random(3)
    for _ in range(500):
        a, b = ("".join(rng.choices("abcß ", k=rng.randint(0, 40))) for _ in range(2))
        assert fuzzy.lcs_length(a, b) == plain_lcs(a, b)


def test_lcs_of_many_pairs_at_once():
    rng = random.Random(4)
    texts = ["", "a", "\0\0", "naïve", "東京 tower", "x" * 64, "x" * 65, "ab" * 90]
    texts += ["".join(rng.choices(rng.choice(["ab", "abcdefghij ", "äöü\0x"]), k=rng.randint(0, 130))) for _ in range(150)]
    pairs = [(rng.choice(texts), rng.choice(texts)) for _ in range(1500)]
    got = fuzzy.lcs_lengths([a for a, _ in pairs], [b for _, b in pairs])
    assert got.tolist() == [plain_lcs(a, b) for a, b in pairs]
    assert fuzzy.lcs_lengths([], []).tolist() == []


@pytest.mark.parametrize("population", [3, 60, 400])
def test_closest_against_brute_force(spark, population, monkeypatch):
    """Marks from 0 to 100, so groups of every length are used; common groups are split."""
    monkeypatch.setattr(fuzzy, "HOT_GROUP", 50)
    rng = random.Random(population)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(1, 9))) for _ in range(60)]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 4))) for _ in range(population)]
    asked = rng.choices(texts, k=6) + ["".join(rng.choices(t, k=len(t))) for t in rng.choices(texts, k=8)]
    asked += [t[1:] for t in rng.choices(texts, k=8)] + ["", "z", "qqqq", "b", "ab", "東京", "abc " * 30, texts[0], texts[0]]
    entries = [(t, f"{t}/{i % 3}") for i, t in enumerate([*texts, "", "xy", "z"])] + [(texts[0], "0 first"), (None, "none")]
    want = {}
    for a in set(asked):
        scored = {(-fuzzy.likeness(a, t), label, t) for t, label in entries if t is not None}
        want[a] = [(label, t, -s) for s, label, t in sorted(scored)[:4]]
    out = fuzzy.closest(spark.createDataFrame([(a,) for a in [*asked, None]], "text string"), spark.createDataFrame(entries, "text string, label string"))
    got = {}
    for r in sorted(out.collect(), key=lambda r: r.place):
        got.setdefault(r.asked, []).append((r.label, r.text, r.score))
    assert {a: [(label, t) for label, t, _ in rows] for a, rows in got.items()} == {a: [(label, t) for label, t, _ in rows] for a, rows in want.items()}
    assert all(x[2] == pytest.approx(y[2]) for a in want for x, y in zip(got[a], want[a]))


def test_closest_of_nothing(spark):
    none, one = spark.createDataFrame([], "text string, label string"), spark.createDataFrame([("a", "a")], "text string, label string")
    assert fuzzy.closest(none, one).collect() == []
    assert fuzzy.closest(one, none).collect() == []


def test_closest_scores_few_pairs(spark, monkeypatch):
    """Python sees the first look and what can still reach the mark, not every pair."""
    rng = random.Random(9)
    names = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=12)) for _ in range(1500)]
    asked = [n[:5] + "x" + n[6:] for n in names[:20]]
    frame = spark.createDataFrame([(n, n) for n in names], "text string, label string")
    seen = spark.sparkContext.accumulator(0)
    scored = fuzzy.likeness_of.func

    def counted(left, right):
        seen.add(len(left))
        return scored(left, right)

    monkeypatch.setattr(fuzzy, "likeness_of", fuzzy.pandas_udf(counted, "double"))
    rows = fuzzy.closest(spark.createDataFrame([(a,) for a in asked], "text string"), frame, 1).collect()
    assert [r.text for r in sorted(rows, key=lambda r: asked.index(r.asked))] == names[:20]
    assert seen.value < 0.1 * len(asked) * len(names)


def test_similar_texts_miss_nothing(spark):
    """Against brute force: short and long texts, small alphabets, repeats, many near copies."""
    rng = random.Random(11)
    texts = set()
    for alphabet in ("ab", "abcdefghij", "abcdefghijklmnopqrstuvwxyz "):
        for _ in range(25):
            base = "".join(rng.choices(alphabet, k=rng.randint(2, 30)))
            texts.add(base)
            for _ in range(3):
                letters = list(base)
                for _ in range(max(1, len(base) // 9)):
                    spot = rng.randrange(len(letters) + 1)
                    if rng.random() < 0.5 and len(letters) > 2:
                        del letters[min(spot, len(letters) - 1)]
                    else:
                        letters.insert(spot, rng.choice(alphabet))
                texts.add("".join(letters))
    texts = sorted(texts)
    half = texts[::2], texts[1::2]
    want = {
        (a, b): 200 * plain_lcs(a, b) / (len(a) + len(b))
        for a in half[0]
        for b in half[1]
        if 200 * plain_lcs(a, b) / (len(a) + len(b)) >= 85
    }
    frames = [spark.createDataFrame([(t,) for t in h], "text string") for h in half]
    rows = fuzzy.similar_texts(*frames).collect()
    got = {(r.left_text, r.right_text): r.score for r in rows}
    assert len(rows) == len(got)
    assert len(want) > 50
    assert got == pytest.approx(want)


def test_low_cutoffs_are_refused():
    with pytest.raises(ValueError):
        fuzzy.shortest_text(3, 60)


def test_lookup(spark):
    rows = [
        ("k1", "Spoon", "50k-500k", 90_000, None), ("k2", "Spoons", "<10k", 900, None),
        ("k3", "Mitski", "500k-2M", 900_000, None), ("k4", "mitski", "<10k", 10, "Mitski"),
        ("k5", "Phoebe Bridgers", "500k-2M", 800_000, None),
    ]
    df = spark.createDataFrame(
        rows,
        "artist_key string, name string, size_band string, lastfm_listeners bigint, possible_alias_of string",
    )
    found = resolve.find_entities(df, ["MITSKI", "Pheobe Bridgers", "Phoebe Bridger", "Spoonz"])
    got = {r["query"]: r for r in found.collect()}
    assert (got["MITSKI"].method, got["MITSKI"].artist_key) == ("exact", "k3")
    assert got["Phoebe Bridger"].method == "fuzzy" and got["Phoebe Bridger"].artist_key == "k5"
    assert not got["Spoonz"].matched
    assert {a["name"] for a in got["Spoonz"].alternatives} >= {"Spoon", "Spoons"}
    assert not got["Pheobe Bridgers"].matched
    many = spark.range(120).select(F.concat(F.lit("Spoon "), F.col("id") % 60).alias("query"), "id")
    assert resolve.find_entities(df, many).filter("NOT matched AND size(alternatives) = 3").count() == 120


def test_prompt_texts(spark):
    long = "word " * 300
    assert one(spark, text.truncate_words(F.lit("short"))) == "short"
    cut = one(spark, text.truncate_words(F.lit(long)))
    assert cut.endswith("word...") and len(cut) <= 903
    assert one(spark, text.signed_percent(F.lit(12.345))) == "+12.3%"
    assert one(spark, text.signed_percent(F.lit(None).cast("double"))) == "n/a"
    assert one(spark, text.grouped_number(F.lit(1234567))) == "1,234,567"
    assert one(spark, text.pseudonym(F.lit("RJ"))) == one(spark, text.pseudonym(F.lit("rj")))
    assert one(spark, text.strip_anchors(F.lit('Hi. <a href="u">more</a>. '))) == "Hi."
