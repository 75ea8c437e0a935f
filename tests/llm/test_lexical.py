import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from upswell.llm import lexical, queries

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def wanted(docs, items, k=20):
    own = [(i, Counter(terms(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in own]
    n_docs, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in own for t in c)
    texts = defaultdict(set)
    for item, text in items:
        texts[item].add(text or "")
    out = []
    for item, kinds in texts.items():
        asked = [t for text in kinds for t in terms(text)]
        scored = []
        for (doc, c), n in zip(own, sizes):
            if not n:
                continue
            m = 100 - 25 + (25 * n * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t in asked if c[t])
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out += [(item, r + 1, None if null else doc, -s) for r, (s, null, doc) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def got(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


@pytest.fixture()
def asked(spark):
    def make(rows):
        return spark.createDataFrame([(*r, "x", 1) for r in rows], "item_id string, text string, doc_id string, rank int")

    return make


@pytest.mark.parametrize("entries", [1 << 20, 300])
def test_against_brute_force(frame, asked, prose, rng, entries, monkeypatch):
    monkeypatch.setattr(lexical, "TREE_ENTRIES", entries)
    few = ["the", "a", "Of", "naïve", "東京", "x1", "don't", "end-of"] + [f"w{i}" for i in range(60)]
    docs = []
    for i in range(300):
        n = rng.choice([0, 1, 4, 20, 80, 200])
        docs.append((i * 3, " ".join(few[min(int(rng.expovariate(0.08)), len(few) - 1)] for _ in range(n))))
    docs += [(7000 + i, docs[5][1] + " the the naïve") for i in range(40)]  # copies: equal scores
    docs += [(None, docs[10][1]), (3, docs[1][1]), (8000, None), (8001, ""), (8002, " .,! \n"), (8003, "w3 " * 30_000 + "東京")]
    items = [(f"q{i}", " ".join(rng.choice(few) for _ in range(rng.choice([1, 3, 12, 60])))) for i in range(40)]
    items += [("twice", "w1 w2"), ("twice", "w2 w40"), ("same", "w9"), ("same", "w9"), (None, "東京 the"), ("none", None), ("empty", "..."), ("absent", "zzzz"), ("many", "w3 " * 500)]
    assert got(lexical.ranked(frame(docs), asked(items))) == wanted(docs, items)


def test_blocks_of_items(frame, asked, prose, rng, monkeypatch):
    monkeypatch.setattr(lexical, "ITEMS_PER_BLOCK", 5)
    docs = [(i, prose(60)) for i in range(50)]
    items = [(f"q{i}", " ".join(docs[i][1].split()[:15])) for i in range(23)]
    assert got(lexical.ranked(frame(docs), asked(items), 3)) == wanted(docs, items, 3)


def test_no_rows(frame, asked):
    assert lexical.ranked(frame([]), asked([("a", "b c")])).collect() == []
    assert lexical.ranked(frame([(1, "b")]), asked([])).collect() == []
    assert lexical.ranked(frame([(1, None)]), asked([("a", "b"), ("c", None)])).collect() == []


def test_terms_do_not_cross_rows():
    text = np.frombuffer("ab cdé.x1".encode(), np.uint8)
    starts, stops, counts = lexical.spans(text, np.array([0, 1, 4, len(text)]))
    assert list(zip(starts.tolist(), stops.tolist())) == [(0, 1), (1, 2), (3, 4), (4, 7), (8, 10)] and counts.tolist() == [0, 1, 3, 5]


def test_bounds_hold_and_prune(rng):
    """Whatever stands below a node scores no more than its bound, and few nodes are looked at."""
    n_terms, n_docs = 400, 3000
    sizes = np.array([rng.randrange(5, 30) for _ in range(n_docs)])
    own = [sorted(rng.sample(range(n_terms), s)) for s in sizes]
    tree = lexical.Tree(sizes, np.concatenate(own), np.array([rng.randrange(1, 5) for _ in range(sizes.sum())]), np.array([rng.randrange(80, 300) for _ in range(n_docs)]), np.arange(n_terms, 0, -1) * 20)
    item, times = np.array(sorted(rng.sample(range(n_terms), 12))), np.ones(12, np.int64)
    inner = np.flatnonzero(~tree.is_leaf)
    children, reach = tree.bounds(inner, item, times)
    bound = dict(zip(children.tolist(), reach.tolist()))
    for node in inner[1:].tolist():
        assert max(bound[c] for c in range(tree.child_from[node], tree.child_to[node])) <= bound[node]
    best = lexical.Best(20)
    seen = lexical.search(tree, np.arange(n_docs), np.zeros(n_docs, bool), item, times, best)
    leaves = np.flatnonzero(tree.is_leaf)
    assert sorted(best.scores.tolist()) == sorted(bound[x] for x in leaves.tolist())[-20:]
    assert seen < 0.6 * len(tree.lo)


def test_query(spark, tmp_path):
    docs, items = [(1, "one two three"), (2, "two three")], [("a", "One")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    df = queries.op12_lexical_search(spark, str(tmp_path))
    assert df.dtypes == [("item_id", "string"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert got(df) == wanted(docs, items)
