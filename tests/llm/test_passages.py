from collections import defaultdict

import numpy as np
import pytest

from upswell.llm import arrays, passages

M = passages.MIN_WORDS


def covered(docs):
    """Words of each document that a passage found twice covers."""
    at = defaultdict(set)
    for doc, text in set(docs):
        words = (text or "").split()
        for k in range(len(words) - M + 1):
            at[tuple(words[k : k + M])].add((doc, text, k))
    out = defaultdict(set)
    for where in at.values():
        if len(where) > 1:
            for doc, _, k in where:
                out[doc].update(range(k, k + M))
    return out


def found(frame, docs):
    out = defaultdict(set)
    for r in passages.repeated_passages(frame(docs)).collect():
        for s in r.spans:
            out[r.doc_id].update(range(s.start_word, s.end_word))
    return out


def test_against_brute_force(frame, prose, rng):
    shared = [prose(n).split() for n in (49, 50, 51, 55, 70, 200, 50, 64)]
    docs = []
    for i in range(220):
        words = prose(rng.randrange(80)).split()
        for _ in range(rng.randrange(4)):
            part = list(rng.choice(shared))
            if rng.random() < 0.5:
                part[rng.randrange(len(part))] = f"edit{i}"
            words += part + prose(rng.randrange(40)).split()
        docs.append((i, " ".join(words)))
    docs += [(1000, None), (1001, ""), (1002, " ".join(["a"] * 200)), (None, docs[7][1]), docs[0], docs[5]]
    assert found(frame, docs) == covered(docs)


def test_partners_among_many_variants_of_a_core(frame, prose):
    """x and y share 50 words around a core, but every suffix of it has a nearer neighbour in both orders."""

    def places(words):
        text = np.frombuffer(" ".join(words).encode(), np.uint8)
        starts, stops, before = arrays.words(text, np.array([0, len(text)]))
        return passages.kept_places(arrays.word_hashes(text, starts, stops), before).tolist()

    docs = []
    for group in range(6):
        words = prose(50).split()
        while places(words) != [8]:
            words = prose(50).split()
        pre, core, post = words[:8], words[8:43], words[43:]

        def add(behind, ahead):
            docs.append((len(docs), " ".join([*behind, *core, *ahead])))

        for _ in range(2):  # x and y, each with others that share the 16 words ahead alone
            ahead = post + prose(30).split()
            add(prose(30).split() + pre, ahead)
            for _ in range(3):
                add(prose(30).split(), ahead)
        for _ in range(10):  # w: the words behind, and a match ahead of its own
            ahead = prose(30).split()
            add(prose(30).split() + pre, ahead)
            add(prose(30).split(), ahead)
    assert found(frame, docs) == covered(docs)


def test_null_ids_and_long_texts(frame, prose):
    text = prose(60)
    for docs in ([(None, text), (0, text)], [(None, text), (5, text)], [(0, text), (5, text), (0, text), (None, text)]):
        assert found(frame, docs) == covered(docs) and len(found(frame, docs)) == len({d for d, _ in docs})
    part = prose(70)
    docs = [(1, " ".join([prose(30_000), part, prose(5_000)])), (2, part), (3, " ".join([part] * 3))]
    assert found(frame, docs) == covered(docs)


def test_one_passage_in_many_documents(frame, prose, rng):
    """A third of the documents hold a passage of their own or in part, some twice, some rows repeat."""
    part = prose(90).split()
    docs = [(i, prose(60)) for i in range(200)]
    for i in range(200, 300):
        k = rng.randrange(30)
        docs.append((i, " ".join([prose(rng.randrange(20)), *part[k : k + rng.randrange(45, 60)], prose(rng.randrange(20))])))
    docs += [docs[-1], docs[-1], docs[-2], (400, " ".join([*part, "x", *part]))]
    assert found(frame, docs) == covered(docs)


def test_repeated_rows_are_one_document_and_no_rows(frame, prose):
    text = prose(300)
    assert found(frame, [(1, text), (1, text), (2, prose(100))]) == {}
    assert found(frame, []) == {}


@pytest.mark.parametrize("most", [1, 3, 4096])
def test_only_cores_of_very_many_suffixes_are_sorted(frame, prose, rng, monkeypatch, most):
    """Others are compared in one pass. Both ways, and both together, find the same."""
    sorted_, way = [], passages._sorted_spans
    monkeypatch.setattr(passages, "MOST_TOGETHER", most)
    monkeypatch.setattr(passages, "_sorted_spans", lambda suffixes: sorted_.append(suffixes.count()) or way(suffixes))
    parts = [prose(n).split() for n in (49, 50, 52, 66, 90)]
    docs = [(i, " ".join([*prose(i % 40).split(), *rng.choice(parts), *prose(i % 7).split()])) for i in range(80)]
    twin = prose(60)
    docs += [(None, twin), (90, twin), (90, twin), (91, prose(5) + " " + twin + " x " + twin), docs[3], docs[3]]
    assert found(frame, docs) == covered(docs)
    assert (sorted_[0] > 0) == (most < 4096)


def test_alike_suffixes_of_a_text_are_one_row(frame, prose, monkeypatch):
    rows, way = [], passages._sorted_spans
    monkeypatch.setattr(passages, "MOST_TOGETHER", 1)
    monkeypatch.setattr(passages, "_sorted_spans", lambda suffixes: rows.append(suffixes.count()) or way(suffixes))
    pair = prose(2)
    docs = [(i, " ".join([prose(5), *[pair] * (150 + i), prose(9), *[pair] * 40])) for i in range(4)] + [(9, " ".join(["a"] * 400)), (10, "b " * 49)]
    assert found(frame, docs) == covered(docs)
    places = sum(r.n for r in passages.in_batches(frame(docs).selectExpr("doc_id", "1L AS text_print", "text"), passages._core_rows, "core long, doc_id long, text_print long, places array<int>").selectExpr("size(places) AS n").collect())
    assert rows[0] < places / 2
