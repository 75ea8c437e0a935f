import numpy as np

from upswell.llm import arrays, decontaminate


def best(item, words):
    """Least edit distance between an item and any stretch of words."""
    row = [0] * (len(words) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(words, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        at, kind = rng.randrange(len(out)), rng.random()
        if kind < 0.34:
            out[at] = f"other{rng.randrange(999)}"
        elif kind < 0.67:
            out.insert(at, f"other{rng.randrange(999)}")
        else:
            del out[at]
    return out


def test_against_brute_force(spark, frame, prose, rng):
    items = [(i, prose(rng.choice([5, 14, 22, 35, 59, 80])).replace("\n", " ")) for i in range(25)] + [(30, None), (31, ""), (None, "only null id here now"), (0, None)]
    docs = []
    for i in range(120):
        words = prose(rng.randrange(0, 120)).split()
        if i % 2:
            item = items[rng.randrange(25)][1].split()
            at = rng.randrange(len(words) + 1)
            words[at:at] = edited(rng, item, rng.randrange(0, 2 + int(0.25 * len(item))))
        docs.append((i, (" ".join(words)).title() if i % 3 else "\n".join(words)))
    docs += [(500, None), (501, ""), (None, items[3][1]), (1, docs[1][1])]
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, size string")
    want = {}
    for doc, text in docs:
        words = (text or "").lower().split()
        for item, t in items:
            own = (t or "").lower().split()
            if own and words:
                d = best(own, words)
                if d <= int(decontaminate.edits_allowed(len(own))):
                    want[doc, item] = d
    rows = decontaminate.contaminated(frame(docs), benchmark).collect()
    got = {(r.doc_id, r.item_id): r.distance for r in rows}
    assert set(got) <= set(want) and all(got[k] == want[k] for k in got)
    assert len(got) >= 0.97 * len(want) and all(k in got for k, d in want.items() if d == 0)
    texts = dict(docs)
    for r in rows:
        if r.distance == 0 and r.doc_id is not None and r.item_id is not None:
            assert texts[r.doc_id].lower().split()[r.start_word : r.end_word] == dict(items[:25])[r.item_id].lower().split()
    left = decontaminate.without_benchmark(frame(docs), benchmark)
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(d) for d, _ in docs if d not in {k[0] for k in got})
    assert left.columns == frame(docs).columns


def test_words_missing_at_a_documents_start(spark, frame, prose, rng):
    items, docs = [], []
    for i in range(80):
        n = (38, 59, 80, 100)[i % 4]
        words = prose(n).split()
        items.append((i, " ".join(words)))
        most = int(decontaminate.edits_allowed(n))
        gone = set(range(most)) if i % 8 < 4 else {k * n // most + rng.randrange(n // most) for k in range(most)}
        left = [w for k, w in enumerate(words) if k not in gone]
        docs.append((i, " ".join(left + [f"other{rng.randrange(9999)}" for _ in range(60)])))
    rows = decontaminate.contaminated(frame(docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert len({r.doc_id for r in rows if r.doc_id == r.item_id}) >= 78
    for r in rows:
        n, most = r.n_item_words, int(decontaminate.edits_allowed(r.n_item_words))
        assert r.start_word == 0 and r.distance == most and r.end_word == n - most


def test_no_rows(spark, frame):
    none = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontaminate.contaminated(frame([(1, "a b c d e f")]), none).collect() == []
    assert decontaminate.contaminated(frame([]), one).collect() == []
    assert decontaminate.without_benchmark(frame([(1, "a b")]), none).count() == 1


def test_walks_bring_edited_sequences_together():
    rng = np.random.default_rng(5)
    for n in (14, 35, 59):
        items = [list(rng.integers(1, 4000, n)) for _ in range(200)]
        windows = []
        for item in items:
            out = list(item)
            for _ in range(int(decontaminate.edits_allowed(n))):
                at, kind = rng.integers(len(out)), rng.random()
                if kind < 0.5:
                    out[at] = 9000 + rng.integers(500)
                elif kind < 0.75:
                    out.insert(at, 9000 + rng.integers(500))
                else:
                    del out[at]
            windows.append(out)

        def samples(rows):
            ends = np.cumsum([0, *map(len, rows)])
            return decontaminate.walk_samples(arrays.mixed(np.concatenate(rows).astype(np.uint64)), ends[:-1], ends[1:], np.full(len(rows), n))

        met = (samples(items) == samples(windows)).any(axis=1).mean()
        assert met > 0.97
        others = (samples(items) == samples(items[::-1])).any(axis=1).mean()
        assert others < 0.05
