"""Names compared block by block: against brute force, with small blocks, and what a block sends on."""

import random

import numpy as np
import pytest

from upswell.operators import fuzzy


def plain(a, b):
    return 200 * fuzzy.lcs_length(a, b) / (len(a) + len(b))


def syllables(rng, least, most):
    """Names in which every letter group is common, as in one language."""
    text = "".join(rng.choices(["th", "on", "er", "re", "an", " "], k=rng.randint(least, most)))
    return " ".join(text.split()) or "th"


def near(rng, text):
    letters = list(text)
    for _ in range(max(1, len(letters) // 12)):
        letters[rng.randrange(len(letters))] = rng.choice("thonra東")
    return "".join(letters)


def test_common_letter_groups_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(fuzzy, "HOT_GROUP", 40)
    rng = random.Random(5)
    left = [syllables(rng, 1, 45) for _ in range(150)]
    right = sorted({syllables(rng, 1, 45) for _ in range(150)} | {near(rng, t) for t in left})
    left = sorted(set(left))
    want = {(a, b): plain(a, b) for a in left for b in right if plain(a, b) >= 85}
    assert len(want) > 100 and any(len(a) > 64 and len(b) > 64 for a, b in want)
    frames = [spark.createDataFrame([(t,) for t in texts], "text string") for texts in (left, right)]
    found = fuzzy.similar_texts(*frames)
    # Names are not joined on the groups they share, which here are all of them.
    assert "levenshtein" not in found._jdf.queryExecution().toString()
    rows = found.collect()
    assert len(rows) == len(want)
    assert {(r.left_text, r.right_text): r.score for r in rows} == pytest.approx(want)

    labels = {t: f"{rng.randrange(5)}/{i:03}" for i, t in enumerate(right)}
    best = {}
    for (a, b), score in want.items():
        best[a] = min(best.get(a, (0.0, "", "")), (-score, labels[b], b))
    entries = spark.createDataFrame([(t, labels[t]) for t in right], "text string, label string")
    rows = fuzzy.most_similar(frames[0], entries).collect()
    assert len(rows) == len(best)
    assert {r.left_text: r.right_text for r in rows} == {a: b for a, (_, _, b) in best.items()}


def test_block_sends_one_row_for_each_text():
    """However many are alike; numbered names all are."""
    names = [f"part {i}" for i in range(1000, 1400)]
    i, j, score = fuzzy._reaching(names, names[::-1], 85.0, True)
    assert i.tolist() == list(range(400)) and score.tolist() == [100.0] * 400
    assert [names[::-1][k] for k in j] == names


def test_closest_in_blocks(spark, monkeypatch):
    """Few pairs are aligned, texts of thousands of letters stand in blocks of their own."""
    monkeypatch.setattr(fuzzy, "HOT_GROUP", 64)
    rng = random.Random(6)
    words = sorted({"".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(1, 12))) for _ in range(300)})
    texts = [*words, "long " * 900, "longer " * 1500, ""]
    asked = [*words[::9], "lng " * 900, "zzz", ""]
    entries = spark.createDataFrame([(t, t[:9]) for t in texts], "text string, label string")
    rows = fuzzy.closest(spark.createDataFrame([(t,) for t in asked], "text string"), entries, 3).collect()
    got = {}
    for r in sorted(rows, key=lambda r: r.place):
        got.setdefault(r.asked, []).append((r.text, r.score))
    assert set(got) == set(asked)
    for a in asked:
        scored = sorted((-(100.0 if not a + t else plain(a, t)), t[:9], t) for t in texts)[:3]
        assert got[a] == [(t, pytest.approx(-s)) for s, _, t in scored]


def test_few_pairs_are_aligned(monkeypatch):
    rng = random.Random(7)
    names = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=12)) for _ in range(2000)]
    asked = [n[:5] + "x" + n[6:] for n in names[:50]]
    seen, aligned = [], fuzzy._Spelled.aligned
    monkeypatch.setattr(fuzzy._Spelled, "aligned", lambda self, i, j, least: seen.append(len(i)) or aligned(self, i, j, least))
    i, j = fuzzy._nearest(asked, names, 1)
    assert np.array_equal(i, np.arange(50)) and np.array_equal(j, np.arange(50))
    assert sum(seen) < 0.02 * 50 * 2000
