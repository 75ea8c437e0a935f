import random
import re
from collections import defaultdict

from upswell.llm import minhash
from upswell.llm.frames import components


def shingles(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def grouped(links, ids):
    """Smallest id reachable from each."""
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    return {i: root(i) for i in ids}


def test_against_brute_force(frame, prose, rng):
    rows = []
    for base in (40, 45, 60, 120, 400):
        text = prose(base).split()
        for _ in range(14):  # copies with ever more words replaced
            copy = list(text)
            for _ in range(rng.randrange(0, 1 + base // 25)):
                copy[rng.randrange(base)] = f"new{rng.randrange(9999)}"
            rows.append(" ".join(copy).upper() if rng.random() < 0.3 else "\t".join(copy))
    rows += [prose(30) for _ in range(20)] + ["one two", "ONE  two", "one", "", "  \n", None, "é " * 6]
    docs = [(7 * i + 3, t) for i, t in enumerate(rows)]
    sets = {i: shingles(t) for i, t in docs}
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    want = grouped(links, sets)
    got = {r.doc_id: r for r in minhash.near_duplicates(frame(docs)).collect()}
    assert {i: r.component_id for i, r in got.items()} == want
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())
    kept = minhash.without_near_duplicates(frame(docs))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))
    assert kept.columns == frame(docs).columns


def test_null_ids_repeated_rows_and_no_rows(frame, prose):
    text = prose(30)
    got = minhash.near_duplicates(frame([(5, text), (5, text), (None, text), (4, None)])).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in got) == [(0, 0, True), (4, 4, True), (5, 5, True), (5, 5, True)]
    assert minhash.near_duplicates(frame([])).collect() == []


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(2001, 2200)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = grouped(links, {x for pair in links for x in pair})
    moved = defaultdict(int)
    for a, b in links:
        moved[a] += a != b
        moved[b] += a != b
    assert got == {i: c for i, c in want.items() if moved[i]}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
