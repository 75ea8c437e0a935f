import json

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from upswell.llm import bpe, simple8b, token_file

BYTE, WORD = (public_tokenizers.path(f"{n}.json") for n in ("byte_bpe_50k", "word_bpe_49k"))
ODD = [
    "", "a", " ", "  a  b\n\n c", "<|endoftext|>", "x<|endoftext|> <|startoftext|>y", "aaaaaaaaaaaaa", "\x1c\x1d a\x85b\xa0c　d​e",
    "it's I'll WE'VE 'd", "日本語テキスト 한국어 🙂🙂🏽", "é ñ ﬁ ½²３ é", "\t\t\r\n x", "ΑΣ ΣΑΣ İstanbul", "Wort, (Wort) Wort! <|ENDOFTEXT|>",
]


@pytest.fixture()
def texts(rng, prose):
    letters = list("aaabcEHtnr   '\n\t.!1٣é日🙂́\x85\xa0\x1cİΣςÀ÷ÿ") + ["<|endoftext|>", "<|startoftext|>", "'s", "  "]
    return ODD + ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(3000)] + [prose(300)]


def library(path):
    out = Tokenizer.from_file(path)
    out.no_truncation()
    out.no_padding()
    return out


def rows(ids, counts):
    return [r.tolist() for r in np.split(ids, np.cumsum(counts)[:-1])]


def test_byte_level_as_the_library(texts, rng):
    own, lib = bpe.Bpe(BYTE), library(BYTE)
    want = [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
    ids, counts = own.encoded(texts)
    assert rows(ids, counts) == want
    assert own.decoded(ids, counts) == lib.decode_batch(want, skip_special_tokens=False) == texts
    loose = [[rng.randrange(50257) for _ in range(rng.randrange(6))] for _ in range(1500)]
    assert own.decoded(np.array([i for r in loose for i in r]), np.array([len(r) for r in loose])) == lib.decode_batch(loose, skip_special_tokens=False)


def test_merges_that_make_earlier_pairs(tmp_path, rng):
    """Two merges with one result: after the later one, pairs of an earlier rank come up."""
    letters = bpe.byte_letters()
    vocab = {c: i for i, c in enumerate(sorted(letters))}
    for made in ("ab", "abc", "abcd", "bc", "dd", "da"):
        vocab[made] = len(vocab)
    merges = [["a", "b"], ["ab", "c"], ["abc", "d"], ["b", "c"], ["d", "d"], ["a", "bc"], ["d", "a"]]
    spec = json.loads(open(BYTE, encoding="utf-8").read())
    spec["model"] |= {"vocab": vocab, "merges": merges[:2] + merges[2:]}
    spec["added_tokens"] = []
    path = str(tmp_path / "small.json")
    (tmp_path / "small.json").write_text(json.dumps(spec))
    own, lib = bpe.Bpe(path), library(path)
    assert not own.rising
    some = ["".join(rng.choice("abcd") for _ in range(rng.randrange(14))) for _ in range(800)]
    assert rows(*own.encoded(some)) == [e.ids for e in lib.encode_batch(some, add_special_tokens=False)]


def test_units_used_most_stay_known(monkeypatch, texts):
    """A full memory keeps what is used again, so that it is not merged anew in every run."""
    monkeypatch.setattr(bpe, "MOST_UNITS", 40)
    monkeypatch.setattr(bpe, "MOST_KNOWN", 40)
    own, lib, learned = bpe.Bpe(BYTE), library(BYTE), []
    learn = own.merged
    monkeypatch.setattr(own, "merged", lambda words: learned.extend(words) or learn(words))
    for n in range(60):
        run = [f"the same word and the word again {n} {n}x", *texts[n * 20 : n * 20 + 20 * (n % 7 == 0)]]
        assert rows(*own.encoded(run)) == [e.ids for e in lib.encode_batch(run, add_special_tokens=False)]
    assert learned.count(b" word") <= 3
    monkeypatch.setattr(bpe, "UNIT_BYTES", 10)
    assert rows(*own.encoded(texts)) == [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]


def test_frames_both_ways(spark, frame, texts):
    docs = frame([(i, t) for i, t in enumerate(texts[:300])] + [(None, "x"), (7, None)])
    out = bpe.decode(bpe.encode(docs, BYTE), BYTE).collect()
    assert all(r.decoded == (r.text or "") for r in out) and len(out) == 302
    assert bpe.encode(docs, BYTE).columns == [*docs.columns, "ids"]
    once = {(r.doc_id, r.text): (r.ids, r.decoded) for r in bpe.encode(docs, BYTE, decoded="decoded").collect()}
    assert once == {(r.doc_id, r.text): (r.ids, r.decoded) for r in out}
    assert bpe.encode(frame([]), BYTE).collect() == []


def test_cut_words_as_the_library(texts):
    own = token_file.Encoder(WORD)
    assert rows(*own.encoded(texts)) == [e.ids for e in library(WORD).encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("n", [0, 1, 2, 239, 4095, 4096, 4097, 9000])
def test_simple8b_round_trip(n):
    rng = np.random.default_rng(n)
    for values in (
        rng.integers(0, 49408, n), np.zeros(n), rng.integers(0, 2, n) * rng.integers(0, 2, n), 2.0 ** (rng.random(n) * 63),
        np.where(rng.random(n) < 0.1, np.uint64(2**64 - 1), np.uint64(3)), np.where(rng.random(n) < 0.1, np.uint64(2**60 - 1), np.uint64(2**60 - 2)),
    ):
        values = np.asarray(values).astype(np.uint64)
        assert np.array_equal(simple8b.decode(simple8b.encode(values)), values)
    with pytest.raises(ValueError):
        simple8b.decode(b"????")


def test_files_in_order_of_ids(spark, frame, texts):
    docs = [(1000 - 3 * i, t) for i, t in enumerate(texts[:200])] + [(2000, None), (None, "b a"), (None, "a"), (5000, "z"), (5000, "y y")]
    path = token_file.fresh_path(spark)
    token_file.write(frame(docs), WORD, path)
    lib, start = library(WORD), 0
    index = token_file.read_index(spark, path).orderBy("start").collect()
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] or ""))
    assert [r.doc_id for r in index] == [d for d, _ in order]
    for r, (_, text) in zip(index, order):
        assert (r.start, r.n_tokens) == (start, len(lib.encode(text or "", add_special_tokens=False).ids) + 1)
        start += r.n_tokens
    ids = {r.doc_id: r.ids for r in token_file.read_ids(spark, path).collect()}
    assert ids[2000] == [1] and ids[1000 - 3 * 9] == [*lib.encode(texts[9], add_special_tokens=False).ids, 1]
    none = token_file.fresh_path(spark)
    token_file.write(frame([]), WORD, none)
    assert token_file.read_index(spark, none).collect() == []
