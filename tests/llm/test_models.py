import numpy as np
import pytest

from upswell.llm import language, neighbours, quality
from upswell.llm.frames import held_out


@pytest.fixture()
def labelled(frame, spark, prose, rng):
    docs, labels = [], []
    for i in range(260):
        good = i % 4 != 0
        text = prose(rng.randrange(20, 120)) if good else rng.choice([" | ".join(prose(30).split()), "again " * rng.randrange(20, 90), "".join(w + "%%% " for w in prose(40).split())])
        docs.append((i, text))
        labels.append((i, int(good), 0))
    docs += [(900, None), (901, ""), (None, prose(20)), (3, prose(20))]
    labels += [(5, None, 0), (None, 1, 0)]
    return frame(docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_held_out(labelled):
    docs, labels = labelled
    rows = quality.scored(docs, quality.fit(docs, labels)).withColumn("apart", held_out("doc_id")).collect()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    apart = [r for r in rows if r.apart and r.doc_id in truth]
    assert len(apart) > 30 and np.mean([r.quality_kept == (truth[r.doc_id] == 1) for r in apart]) > 0.9
    assert len(rows) == 264 and all(0 <= r.quality_score <= 1 and r.quality_kept == (r.quality_score >= 0.7) for r in rows)
    good = quality.good_documents(docs.withColumnRenamed("key", "quality_score"), labels)
    assert good.columns == docs.withColumnRenamed("key", "quality_score").columns and {r.quality_score for r in good.collect()} == {"key"}


def test_labels_held_out_teach_nothing(labelled):
    docs, labels = labelled
    other = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, 1 - quality, quality) as quality", "toxic")
    scores = [sorted((r.doc_id or -1, r.quality_score) for r in quality.scored(docs, quality.fit(docs, x)).collect()) for x in (labels, other)]
    assert scores[0] == scores[1]


def test_quality_without_labels_or_rows(frame, labelled):
    docs, labels = labelled
    assert {r.quality_score for r in quality.scored(docs, quality.fit(docs, labels.limit(0))).collect()} == {0.5}
    assert quality.scored(frame([]), quality.fit(frame([]), labels)).collect() == []


SOUNDS = {"aa": ["ken", "lor", "tis", "um"], "bb": ["ñal", "ció", "rre", "os"], "cc": ["sch", "ung", "ein", "keit"]}


def test_language_held_out(spark, rng):
    rows = []
    for i in range(240):
        lang = rng.choice(list(SOUNDS))
        rows.append((i, " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(4, 60))), lang, "x"))
    rows += [(900, None, "aa", "x"), (901, "", None, "x"), (902, "12 % 3", "bb", "x"), (903, "kenlor tisum", None, "x"), (None, "ungkeit ein", "cc", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")
    got = {r.doc_id: r for r in language.identified(docs, language.fit(docs)).withColumn("apart", held_out("doc_id")).collect()}
    apart = [r for r in got.values() if r.apart and r.doc_id is not None and r.doc_id < 900]
    assert len(apart) > 30 and np.mean([r.lang == r.lang_pred for r in apart]) > 0.95
    assert all(got[i].lang_pred == "und" and got[i].lang_score == 0 for i in (900, 901, 902)) and got[903].lang_pred == "aa"
    none = docs.limit(0)
    assert language.identified(none, language.fit(none)).collect() == []
    assert {r.lang_pred for r in language.identified(docs, language.fit(none)).collect()} == {"und"}


def brute(vectors, query_id, k):
    usable = {(i, v) for i, v in vectors if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for own in [v for i, v in usable if i == query_id]:
        a = np.array(own, float)
        for i, v in usable:
            if i != query_id:
                b = np.array(v, float)
                score = float(a @ b / np.sqrt(a @ a) / np.sqrt(b @ b))
                out[i] = max(out.get(i, -2), score)
    return sorted(out.items(), key=lambda x: (-round(x[1], 12), x[0]))[:k]


def test_neighbours_recall_and_odd_vectors(spark):
    rng = np.random.default_rng(4)
    vectors = [(i, tuple(rng.standard_normal(16).astype(np.float32).tolist())) for i in range(600)]
    vectors += [(1000 + i, vectors[50][1]) for i in range(9)]  # copies of a query
    vectors += [(2000, None), (2001, (0.0,) * 16), (2002, (float("nan"),) * 16), (2003, (None,) * 16), (2004, ()), (2005, (float("inf"),) * 16), (None, vectors[3][1]), (7, vectors[7][1])]
    df = spark.createDataFrame([(i, list(v) if v is not None else None, "x") for i, v in vectors], "vec_id long, embedding array<float>, ids string")
    got = {}
    for r in neighbours.nearest(df, df.filter("vec_id % 50 = 0"), 5).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    hits = total = 0
    for query in [i for i, v in vectors if i is not None and i % 50 == 0 and i < 2000]:
        want = brute(vectors, query, 5)
        assert len(got[query]) == 5 and [s for _, s in got[query]] == sorted((s for _, s in got[query]), reverse=True)
        true = dict(brute(vectors, query, 10_000))
        assert all(abs(true[v] - s) < 1e-12 for v, s in got[query])
        hits += len({v for v, _ in want} & {v for v, _ in got[query]})
        total += 5
    assert hits / total >= 0.9 and 2001 not in got
    assert [v for v, _ in got[50]] == [1000, 1001, 1002, 1003, 1004]
    few = df.filter("vec_id in (0, 1, 2)")
    assert neighbours.nearest(few, few.filter("vec_id = 0"), 5).count() == 2
    assert neighbours.nearest(df.limit(0), df.limit(0), 5).collect() == []
