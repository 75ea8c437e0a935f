"""Texts as NumPy byte arrays inside Arrow batches: slices, words, hashes. No Spark job is started here."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_LOW, _MIX_A, _MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2**64


def mixed(x: np.ndarray) -> np.ndarray:
    """Well-spread 64-bit values of 64-bit values (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _MIX_A
        x = (x ^ (x >> np.uint64(27))) * _MIX_B
    return x ^ (x >> np.uint64(31))


def seeds(n: int, start: int = 1) -> np.ndarray:
    """n fixed random 64-bit numbers."""
    return seeds_of(np.arange(start, start + n, dtype=np.uint64))


def seeds_of(numbers: np.ndarray) -> np.ndarray:
    """The fixed random numbers of these places."""
    with np.errstate(over="ignore"):
        return mixed(numbers * _LOW + _LOW)


class PerPoint:
    """A number of every code point: from a table of the first 65,536, or worked out."""

    def __init__(self, make: Callable[[np.ndarray], np.ndarray]) -> None:
        self.make, self.table = make, make(np.arange(1 << 16, dtype=np.uint64))

    def __getitem__(self, points: np.ndarray) -> np.ndarray:
        if not len(points) or points.max() < len(self.table):
            return self.table[points]
        out, far = self.table[np.minimum(points, len(self.table) - 1)], np.flatnonzero(points >= len(self.table))
        out[far] = self.make(points[far].astype(np.uint64))
        return out


BYTE_VALUES = seeds(256, 7_000)


class Powers:
    """Powers of one odd number and their inverses, as long as the longest slice so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def grown(self, n: int) -> Powers:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            with np.errstate(over="ignore"):
                steps = np.full(size, _STEP, np.uint64)
                steps[0] = 1
                self.up = np.multiply.accumulate(steps)
                steps[1:] = pow(_STEP, -1, 1 << 64)
                self.down = np.multiply.accumulate(steps)
        return self


_POWERS = Powers()


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Prefix sums of values times rising powers: what ``span_hashes`` needs of a sequence."""
    powers = _POWERS.grown(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(values * powers.up[: len(values)], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of every span, equal for equal spans wherever they stand."""
    with np.errstate(over="ignore"):
        raw = (sums[ends] - sums[starts]) * _POWERS.down[starts]
        return mixed(raw + (ends - starts).astype(np.uint64) * _LOW)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; a null row is empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    text = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return text, ends


def text_slices(column: pa.Array, most: int = SLICE_BYTES, rows: int = 1 << 16) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole rows of about ``most`` bytes (a longer row stands alone) and at most ``rows``:
    first row, last row + 1, bytes, offsets from 0."""
    text, ends = buffers(column)
    first = 0
    while first < len(column):
        last = max(first + 1, min(first + rows, int(np.searchsorted(ends, ends[first] + most, side="right")) - 1))
        yield first, last, text[ends[first] : ends[last]], ends[first : last + 1] - ends[first]
        first = last


def string_slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, list[str]]]:
    """The same runs as Python strings; a null row is empty."""
    for first, last, text, ends in text_slices(column, most):
        raw = text.tobytes()
        yield first, last, [raw[a:b].decode() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def lowered(text: np.ndarray) -> np.ndarray:
    """A-Z in lower case; no other byte changes."""
    return text | (((text >= 65) & (text <= 90)).astype(np.uint8) << 5)


def words(text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of bytes other than space and 9 to 13, within rows: starts, ends, and for each row the
    number of words before it (one more entry than rows)."""
    inside = np.zeros(len(text) + 2, np.int8)
    inside[1:-1] = (text != 32) & ((text < 9) | (text > 13))
    steps = np.diff(inside)
    starts, stops = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
    # a row border inside a run cuts it
    borders = np.unique(ends[1:-1])
    at = np.searchsorted(starts, borders, side="right") - 1
    cut = borders[(at >= 0) & (starts[np.maximum(at, 0)] < borders) & (stops[np.maximum(at, 0)] > borders)] if len(starts) else borders[:0]
    if len(cut):
        starts, stops = np.sort(np.concatenate([starts, cut])), np.sort(np.concatenate([stops, cut]))
    return starts, stops, np.searchsorted(starts, ends, side="left")


def word_hashes(text: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    return span_hashes(prefix_sums(BYTE_VALUES[text]), starts, stops)


def run_hashes(values: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k neighbouring values (len(values) - k + 1 of them)."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i, c in enumerate(seeds(k, 90_000) | np.uint64(1)):
            out += values[i : i + n] * c
    return mixed(out)


def rows_of(counts: np.ndarray) -> np.ndarray:
    """Row number of each entry, given the entries before each row."""
    return np.repeat(np.arange(len(counts) - 1), np.diff(counts))


def list_array(values: np.ndarray | pa.Array, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


def signed(values: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's long."""
    return np.ascontiguousarray(values).view(np.int64)
