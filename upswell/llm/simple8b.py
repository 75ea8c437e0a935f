"""Simple-8b word-aligned coding of non-negative 64-bit numbers in NumPy, a block at a time in lockstep.

A word's upper 4 bits select how many numbers of how many bits its lower 60 hold. A number that
does not fit 60 bits, or equals the escape, is an escape word and a word of its own. Numbers are cut
into blocks; the header has the first word of each, so any block is decoded without the others."""

from __future__ import annotations

import numpy as np

#: Numbers per word and bits per number, by selector.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])

BLOCK = 4096
MAGIC = b"S8B1"
_LOW = np.uint64((1 << 60) - 1)
_ESCAPE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits of each number; 61 for those that need an escape."""
    out = np.zeros(len(values), np.uint8)
    rest = values.copy()
    for shift in (32, 16, 8, 4, 2, 1):
        big = rest >= np.uint64(1) << np.uint64(shift)
        out[big] += shift
        rest[big] >>= np.uint64(shift)
    out += rest > 0
    return np.where(values >= _LOW, 61, out).astype(np.uint8)


def _fits(widths: np.ndarray) -> np.ndarray:
    """For each place the selector that packs the most numbers from there on; 16 for an escape."""
    n = len(widths)
    best = np.full(n, 16, np.uint8)
    widest = {1: widths}

    def over(k: int) -> np.ndarray:
        if k not in widest:
            half = max(j for j in widest if j < k)
            tail = next(j for j in sorted(widest) if half + j >= k)
            a, b = widest[half], widest[tail]
            out = a.copy()
            shift = k - tail
            out[: n - shift] = np.maximum(a[: n - shift], b[shift:])
            widest[k] = out
        return widest[k]

    for selector in range(15, -1, -1):
        best[over(int(COUNTS[selector])) <= BITS[selector]] = selector
    return best


def encode(values: np.ndarray) -> bytes:
    """MAGIC, numbers per block, numbers (8 bytes), word offsets of the blocks and their end, words."""
    values = np.ascontiguousarray(values, np.uint64)
    n_blocks = -(-len(values) // BLOCK)
    # a block's tail may take words that reach past it, over zeros
    padded = np.zeros((n_blocks, BLOCK + 240), np.uint64)
    ends = np.full(n_blocks, BLOCK)
    if n_blocks:
        whole = np.zeros(n_blocks * BLOCK, np.uint64)
        whole[: len(values)] = values
        padded[:, :BLOCK] = whole.reshape(n_blocks, BLOCK)
        ends[-1] = len(values) - (n_blocks - 1) * BLOCK
    flat = padded.ravel()
    choice = _fits(_widths(flat))
    rows, places, selectors, step = [], [], [], 0
    at, live = np.zeros(n_blocks, np.int64), np.arange(n_blocks)
    while len(live):
        place = live * padded.shape[1] + at
        chosen = choice[place]
        rows.append(live)
        places.append(place)
        selectors.append(chosen)
        at = at + COUNTS[np.minimum(chosen, 15)]
        more = at < ends[live]
        live, at = live[more], at[more]
    rows, places, selectors = (np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64) for x in (rows, places, selectors))
    order = np.lexsort((places, rows))
    rows, places, selectors = rows[order], places[order], selectors[order]
    size = np.where(selectors == 16, 2, 1)
    where = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    for selector in range(16):
        some = np.flatnonzero(selectors == selector)
        if not len(some):
            continue
        word = np.full(len(some), np.uint64(selector) << np.uint64(60))
        if BITS[selector]:
            for i in range(int(COUNTS[selector])):
                word |= flat[places[some] + i] << np.uint64(i * int(BITS[selector]))
        words[where[some]] = word
    escaped = np.flatnonzero(selectors == 16)
    words[where[escaped]] = _ESCAPE
    words[where[escaped] + 1] = flat[places[escaped]]
    offsets = np.zeros(n_blocks + 1, "<u4")
    offsets[1:] = np.cumsum(np.bincount(rows, weights=size, minlength=n_blocks)) if n_blocks else 0
    return MAGIC + np.array([BLOCK], "<u4").tobytes() + np.array([len(values)], "<u8").tobytes() + offsets.tobytes() + words.astype("<u8").tobytes()


def decode(data: bytes) -> np.ndarray:
    """The numbers of what ``encode`` made."""
    if data[:4] != MAGIC:
        raise ValueError("not a Simple-8b block file")
    block = int(np.frombuffer(data, "<u4", 1, 4)[0])
    n = int(np.frombuffer(data, "<u8", 1, 8)[0])
    n_blocks = -(-n // block)
    offsets = np.frombuffer(data, "<u4", n_blocks + 1, 16).astype(np.int64)
    words = np.frombuffer(data, "<u8", int(offsets[-1]), 16 + 4 * (n_blocks + 1)).astype(np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    count = COUNTS[selector]
    raw = np.zeros(len(words), bool)  # the second words of escapes
    for i in np.flatnonzero(words == _ESCAPE).tolist():
        if not raw[i]:
            raw[i + 1] = True
    count[raw] = 0
    block_of = np.repeat(np.arange(n_blocks), np.diff(offsets))
    total = np.cumsum(count) - count
    first = total[offsets[:-1]] if n_blocks else total[:0]
    out = np.zeros(n_blocks * block, np.uint64)
    within = total - first[block_of]
    place = block_of * block + within
    for s in range(2, 16):
        some = np.flatnonzero((selector == s) & ~raw)
        mask = np.uint64((1 << int(BITS[s])) - 1)
        for i in range(int(COUNTS[s])):
            inside = some[within[some] + i < block]
            out[place[inside] + i] = (words[inside] >> np.uint64(i * int(BITS[s]))) & mask
    escaped = np.flatnonzero((words == _ESCAPE) & ~raw)
    out[place[escaped]] = words[escaped + 1]
    return out[:n]
