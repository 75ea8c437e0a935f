"""Byte-level BPE in both directions, by a pair occurrence index over a run of texts.

Texts are cut into units at single spaces and units into pre-tokens; the distinct pre-tokens of a
run that are not known yet stand in one symbol array. The index maps each pair's rank to all places where it occurs. The smallest active rank is
taken, all its places are merged at once, and the pairs beside them move to their new ranks, until
no rank is active. Every text is then put together from its pre-tokens' ids."""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from upswell.llm import arrays
from upswell.llm.frames import in_batches

#: Bytes of text whose new pre-tokens are merged together.
RUN_BYTES = 4 << 20
#: Pre-tokens a Python worker remembers, it starts afresh beyond that; and units, of which it goes on
#: with those used most.
MOST_KNOWN, MOST_UNITS = 300_000, 600_000
#: Bytes of units a worker remembers; it starts afresh beyond that.
UNIT_BYTES = 64 << 20

#: A space beside other white space or at the end: such a text is not cut at its spaces first. The
#: pattern begins with the space, which is quicker to search for.
UNEVEN = re.compile(r" (?:(?=\s)|(?<=\s )|$)")

#: Fixed value: how byte-level BPE cuts a text.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself if printable in Latin-1, the others
    in order from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + others.index(b)) for b in range(256)]


class Known(dict):
    """Strings numbered in the order they first appear, and the ids of those learned so far."""

    def __init__(self) -> None:
        self.ids = np.zeros(0, np.int32)
        self.counts = np.zeros(0, np.int64)

    def __missing__(self, text: str) -> int:
        number = self[text] = len(self)
        return number

    def numbers(self, texts: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, texts), np.int64, len(texts))

    def new(self) -> list[str]:
        return list(islice(self, len(self.counts), None))

    def learned(self, ids: np.ndarray, counts: np.ndarray) -> None:
        self.ids, self.counts = np.concatenate([self.ids, ids]), np.concatenate([self.counts, counts])


class Units:
    """Units as Arrow strings without the space they begin with, numbered in the order they first
    appear, and the ids of those learned so far. A part of a text cut at spaces holds none, so a unit
    that does not begin with a space is told by one put before it."""

    def __init__(self) -> None:
        self.texts = pa.array([], pa.large_string())
        self.ids = np.zeros(0, np.int32)
        self.counts = np.zeros(0, np.int64)
        self.uses = np.zeros(0, np.int64)

    def numbers(self, *marked: pa.Array) -> list[np.ndarray]:
        coded = pa.chunked_array([self.texts, *marked], pa.large_string()).combine_chunks().dictionary_encode()
        self.texts = coded.dictionary
        rows = coded.indices.to_numpy()[len(self.uses) :]
        uses = np.bincount(rows, minlength=len(self.texts))
        uses[: len(self.uses)] += self.uses
        self.uses = uses
        return np.split(rows, np.cumsum([len(m) for m in marked])[:-1])

    def new(self) -> list[str]:
        return [m[1:] if m[:1] == " " else " " + m for m in self.texts.slice(len(self.counts)).to_pylist()]

    def learned(self, ids: np.ndarray, counts: np.ndarray) -> None:
        self.ids, self.counts = np.concatenate([self.ids, ids]), np.concatenate([self.counts, counts])

    def trimmed(self) -> None:
        """Go on with those used more than once, half of MOST_UNITS at most; their uses so far count half."""
        best = np.argsort(-self.uses, kind="stable")[: MOST_UNITS // 2]
        best = np.sort(best[self.uses[best] > 1])
        self.ids = gathered(self.ids, self.counts, best)
        self.texts, self.counts, self.uses = self.texts.take(pa.array(best)), self.counts[best], self.uses[best] // 2


class Bpe:
    """A vocabulary and its merges, read from a tokenizers file with a byte-level BPE model."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, letters = spec["model"]["vocab"], byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.byte_ids = np.array([vocab[c] for c in letters], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.left, self.right = left, right
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.order = np.argsort((left << 32) | right)
        self.pairs = ((left << 32) | right)[self.order]
        # ranks of pairs of bytes, which a run begins with
        byte_of_id = np.full(max(vocab.values()) + 1, 256)
        byte_of_id[self.byte_ids] = np.arange(256)
        a, b = byte_of_id[left], byte_of_id[right]
        self.byte_ranks = np.full((257, 257), len(pairs), np.int32)
        self.byte_ranks[a, b] = np.arange(len(pairs))
        self.byte_ranks = np.ascontiguousarray(self.byte_ranks[:256, :256])
        # if no merge makes an earlier pair, all places of a rank can be merged at once
        born = np.full(max(vocab.values()) + 1, -1)
        born[self.made] = np.arange(len(pairs))
        self.rising = len(set(self.made.tolist())) == len(pairs) and bool((np.maximum(born[left], born[right]) < np.arange(len(pairs))).all())
        texts = {**{i: bytes(byte_of[c] for c in s) if all(c in byte_of for c in s) else s.encode() for s, i in vocab.items()}, **{i: s.encode() for s, i in self.special.items()}}
        self.lengths = np.zeros(max(texts) + 1, np.int64)
        for i, raw in texts.items():
            self.lengths[i] = len(raw)
        self.begins = np.concatenate([[0], np.cumsum(self.lengths)])
        self.bytes = np.frombuffer(b"".join(texts.get(i, b"") for i in range(len(self.lengths))), np.uint8)
        self.find = regex.compile(PIECES).findall
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in self.special) + ")").split if self.special else None
        self.units, self.known = Units(), Known()

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens; a special token is one, and cannot come about otherwise."""
        if self.cut is None or not any(s in text for s in self.special):
            return self.find(text)
        return [p for part in self.cut(text) for p in ([part] if part in self.special else self.find(part))]

    def numbered_units(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the units of all texts in a row, and how many each text has. Texts are cut at
        single spaces, which begin the units after the first; one that cannot be cut so is cut into
        pre-tokens."""
        apart = [text.startswith(" ") or UNEVEN.search(text) is not None or any(s in text for s in self.special) for text in texts]
        parts = pc.split_pattern(pa.array(["" if alone else text for text, alone in zip(texts, apart)], pa.large_string()), " ")
        begins, flat = parts.offsets.to_numpy().astype(np.int64), parts.flatten()
        follows = np.ones(len(flat), bool)
        follows[begins[:-1]] = False
        # what does not follow a space: a text's first unit, or all pre-tokens of a text that stands apart
        firsts = flat.take(pa.array(begins[:-1])).to_pylist()
        others = [self.pieces(text) if alone else [first] for text, alone, first in zip(texts, apart, firsts)]
        spaced, plain = self.units.numbers(flat.filter(pa.array(follows)), pa.array([" " + u for units in others for u in units], pa.large_string()))
        before = np.array([len(units) for units in others], np.int64)
        sizes = before + np.diff(begins) - 1
        starts = np.cumsum(sizes) - sizes
        numbers = np.zeros(int(sizes.sum()), np.int64)
        at = np.repeat(starts - (np.cumsum(before) - before), before) + np.arange(len(plain))
        rest = np.ones(len(numbers), bool)
        rest[at] = False
        numbers[at], numbers[rest] = plain, spaced
        return numbers, sizes

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs; the number of merges where a pair is none."""
        key = (a << 32) | b
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.order[at], len(self.pairs)) if len(self.pairs) else np.zeros(len(a), np.int64)

    def merged(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and how many each has."""
        lengths = np.array([len(w) for w in words], np.int64)
        raw = np.frombuffer(b"".join(words), np.uint8)
        symbol = self.byte_ids[raw]
        n = len(symbol)
        word = np.repeat(np.arange(len(words)), lengths)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        last = np.cumsum(lengths[lengths > 0]) - 1
        after[last] = -1
        before[np.append(0, last[:-1] + 1) if n else last] = -1
        alive = np.ones(n, bool)
        places: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def note(at: np.ndarray, rank: np.ndarray) -> None:
            """Add the pairs of these ranks that start at these places to the index."""
            good = rank < len(self.left)
            at, rank = at[good], rank[good]
            if not len(at):
                return
            order = np.argsort(rank.astype(np.uint16) if len(self.left) <= 1 << 16 else rank, kind="stable")  # 16 bits sort quicker
            at, rank = at[order], rank[order]
            heads = np.flatnonzero(np.concatenate([[True], rank[1:] != rank[:-1]]))
            for r, group in zip(rank[heads].tolist(), np.split(at, heads[1:])):
                if r in places:
                    places[r].append(group)
                else:
                    places[r] = [group]
                    heapq.heappush(active, r)

        pairs = np.flatnonzero(after >= 0)
        note(pairs, self.byte_ranks[raw[pairs], raw[pairs + 1]])
        while active:
            rank = heapq.heappop(active)
            groups = places.pop(rank)
            at = _distinct(np.concatenate(groups)) if len(groups) > 1 else np.sort(groups[0])
            a, b = self.left[rank], self.right[rank]
            follow = after[at]
            at = at[alive[at] & (follow >= 0) & (symbol[at] == a) & (symbol[np.maximum(follow, 0)] == b)]
            if a == b and len(at) > 1:  # of places that overlap, every other one
                joined = after[at[:-1]] == at[1:]
                head = np.concatenate([[True], ~joined])
                at = at[(np.arange(len(at)) - np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))) % 2 == 0]
            if not len(at):
                continue
            if not self.rising:  # only the first place in each word; the others wait
                first = np.concatenate([[True], word[at[1:]] != word[at[:-1]]])
                if not first.all():
                    places[rank] = [at[~first]]
                    heapq.heappush(active, rank)
                at = at[first]
            gone = after[at]
            beyond = after[gone]
            symbol[at] = self.made[rank]
            alive[gone] = False
            after[at] = beyond
            inner = beyond >= 0
            before[beyond[inner]] = at[inner]
            ahead = before[at]
            ahead = ahead[ahead >= 0]
            touched = _distinct(np.concatenate([ahead, at[inner]]))
            note(touched, self.ranks(symbol[touched], symbol[after[touched]]))
        return symbol[alive].astype(np.int32), np.bincount(word[alive], minlength=len(words))

    def learn_pieces(self) -> None:
        new = self.known.new()
        ids, counts = self.merged([b"" if p in self.special else p.encode() for p in new])
        marks = [i for i, p in enumerate(new) if p in self.special]
        if marks:
            ids = np.insert(ids, np.cumsum(counts)[marks], [self.special[new[i]] for i in marks])
            counts[marks] = 1
        self.known.learned(ids, counts)

    def learn_units(self) -> None:
        # a space and letters are one pre-token, as most units are
        pieces = [[u] if u[u[:1] == " " :].isalpha() or u in self.special else self.find(u) for u in self.units.new()]
        flat = self.known.numbers([p for unit in pieces for p in unit])
        self.learn_pieces()
        sizes = np.array([len(unit) for unit in pieces], np.int64)
        self.units.learned(gathered(self.known.ids, self.known.counts, flat), _sums(self.known.counts[flat], sizes))

    def encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each has."""
        if self.units.texts.nbytes > UNIT_BYTES:
            self.units = Units()
        elif len(self.units.texts) > MOST_UNITS:
            self.units.trimmed()
        if len(self.known) > MOST_KNOWN:
            self.known = Known()
        flat, sizes = self.numbered_units(texts)
        self.learn_units()
        return gathered(self.units.ids, self.units.counts, flat), _sums(self.units.counts[flat], sizes)

    def decoded(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """Texts of rows of ids; bytes that are not UTF-8 become U+FFFD."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.lengths)):
            raise ValueError("an id is not in the vocabulary")
        raw = b"".join(gathered(self.bytes, self.lengths, ids[i : i + (1 << 18)], self.begins).tobytes() for i in range(0, len(ids), 1 << 18))
        ends = np.concatenate([[0], np.cumsum(self.lengths[ids])])[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)].tolist()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:])]


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of neighbouring stretches of so many values each."""
    total = np.concatenate([[0], np.cumsum(values)])
    return np.diff(total[np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)])


def gathered(values: np.ndarray, counts: np.ndarray, rows: np.ndarray, begins: np.ndarray | None = None) -> np.ndarray:
    """The stretches of ``values`` that ``rows`` name, one after the other."""
    if begins is None:
        begins = np.concatenate([[0], np.cumsum(counts)])
    lengths = counts[rows]
    offsets = np.cumsum(lengths) - lengths
    return values[np.repeat(begins[rows] - offsets, lengths) + np.arange(int(lengths.sum()))]


@lru_cache(maxsize=2)
def model(path: str) -> Bpe:
    """The model of a file, kept by each Python worker."""
    return Bpe(path)


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``df`` with its texts' ids, array<int>, as the tokenizers library gives them without added
    tokens. A null or empty text has none. A column already called ``ids`` is replaced. With
    ``decoded``, a column of that name has the texts the ids give back, from the same pass."""
    kept = [c for c in df.columns if c not in (ids, decoded)]

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        bpe = model(path)
        for first, last, texts in arrays.string_slices(batch.column(text), RUN_BYTES):
            found, counts = bpe.encoded(texts)
            new = [arrays.list_array(found, counts, pa.int32())]
            if decoded:
                new.append(pa.array(bpe.decoded(found, counts), pa.string()))
            names = [*kept, ids, *([decoded] if decoded else [])]
            yield pa.RecordBatch.from_arrays([*batch.slice(first, last - first).select(kept).columns, *new], names=names)

    schema = _schema(df, kept, ids, T.ArrayType(T.IntegerType()))
    return in_batches(df, step, schema.add(decoded, T.StringType()) if decoded else schema)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text of its ids, special tokens included. Null ids and none give an empty text."""
    kept = [c for c in df.columns if c != text]

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        bpe = model(path)
        column = batch.column(ids).fill_null([]) if batch.column(ids).null_count else batch.column(ids)
        counts = np.diff(column.offsets.to_numpy().astype(np.int64))
        values = column.flatten().to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(counts)])
        first = 0
        while first < len(counts):
            last = max(first + 1, int(np.searchsorted(ends, ends[first] + (1 << 18), side="right")) - 1)
            texts = bpe.decoded(values[ends[first] : ends[last]], counts[first:last])
            yield pa.RecordBatch.from_arrays([*batch.slice(first, last - first).select(kept).columns, pa.array(texts, pa.string())], names=[*kept, text])
            first = last

    return in_batches(df, step, _schema(df, kept, text, T.StringType()))


def _schema(df: DataFrame, kept: list[str], name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*(f for f in df.schema.fields if f.name in kept), T.StructField(name, kind)])
