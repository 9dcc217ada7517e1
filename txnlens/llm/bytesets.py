"""Whole texts as arrays inside Arrow batches: UTF-8 bytes, words, hashes.

A batch's text column already is one buffer of UTF-8 bytes with row offsets, so words and hashes of many rows are
computed at once with numpy and no string is built. Null texts count as empty. All hashes are deterministic: tables
come from fixed seeds, so every executor (and a rerun after a lost one) computes the same values.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SEED = np.random.default_rng(20260101)
#: One random 64-bit value for each byte; white space (0x20, 0x09-0x0D) is 0, so it adds nothing to a word's hash.
_BYTE = _SEED.integers(1, 2**64, 256, dtype=np.uint64)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_WORD_BYTE = np.where(IS_SPACE, np.uint64(0), _BYTE)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
#: Most bytes that are looked at together (a longer text is still taken whole).
CHUNK_BYTES = 1 << 19
#: Longest table of powers that stays in memory.
KEPT_POWERS = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


_POWERS: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """The first n powers of a base; tables are kept up to ``KEPT_POWERS``, so that one long text leaves nothing behind."""
    known = _POWERS.get(int(base))
    if known is None or len(known) < n:
        known = np.full(max(n, 1 << 16 if known is None else min(2 * len(known), KEPT_POWERS)), base, np.uint64)
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        if len(known) <= KEPT_POWERS:
            _POWERS[int(base)] = known
    return known[:n]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offset of each row in them (one more than rows)."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def row_chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes, one row at least."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last
        first = last


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of consecutive rows."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, lower: bool = False, breaks: np.ndarray = IS_SPACE):
        """offsets: of the rows in ``raw``, starting at 0; breaks: which bytes stand between words."""
        if lower:
            raw = _LOWER[raw]
        self.raw = raw
        inside = ~breaks[raw]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        cuts = offsets[1:-1]
        cuts = cuts[cuts < len(raw)]
        begins[cuts] = inside[cuts]  # a row's first byte begins a word even right after another row's word
        self.starts = np.flatnonzero(begins)
        ends = inside.copy()
        ends[:-1] &= ~inside[1:] | begins[1:]
        self.ends = np.flatnonzero(ends) + 1
        #: Index of each row's first word (one more than rows).
        self.rows = np.searchsorted(self.starts, offsets)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes: a difference of running sums, shifted back to the word's start."""
        sums = np.zeros(len(self.raw) + 1, np.uint64)
        np.cumsum(_WORD_BYTE[self.raw] * powers(_BASE, len(self.raw)), out=sums[1:])
        own = (sums[self.ends] - sums[self.starts]) * powers(_BASE_INVERSE, len(self.raw) + 1)[self.starts]
        return mix(own + (self.ends - self.starts).astype(np.uint64))


def row_words(raw: np.ndarray, offsets: np.ndarray, lower: bool = False,
              breaks: np.ndarray = IS_SPACE) -> Iterator[tuple[int, int, Words]]:
    """Words of row ranges: first row, end row, words."""
    for first, last in row_chunks(offsets):
        a, b = offsets[first], offsets[last]
        yield first, last, Words(raw[a:b], offsets[first:last + 1] - a, lower, breaks)


def window_hashes(values: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of every ``size`` consecutive values (polynomial in the values, then mixed)."""
    n = len(values)
    if n < size:
        return np.empty(0, np.uint64)
    base = _BASE * np.uint64(2 * seed + 1)
    inverse = np.uint64(pow(int(base), -1, 2**64))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers(base, n), out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * powers(inverse, n - size + 1))


def byte_values(raw: np.ndarray) -> np.ndarray:
    return _BYTE[raw]


def span_hashes(values: np.ndarray, first: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of ``values[first:end]`` for each pair."""
    base = _BASE * np.uint64(2 * seed + 1)
    inverse = np.uint64(pow(int(base), -1, 2**64))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), out=sums[1:])
    back = powers(inverse, len(values) + 1)
    return mix((sums[end] - sums[first]) * back[first] + (end - first).astype(np.uint64))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` consecutive values."""
    n = len(values)
    padded = np.concatenate([values, np.full((-n) % width, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    before = np.minimum.accumulate(padded, axis=1).ravel()
    after = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    m = n - width + 1
    return np.minimum(after[:m], before[width - 1:width - 1 + m])


def union_length_runs(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of half-open intervals; touching ones join."""
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > ends[:-1]])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    return starts[first], ends[last]
