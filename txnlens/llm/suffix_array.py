"""Exact substring deduplication of bytes with a difference-cover suffix array.

Contexts that may hold a repeat come together by anchor (see ``repeats``). Over each bounded piece the suffixes at
places 1 and 2 mod 3 are sorted by their triples, their names are sorted in turn (the recursion), the remaining
suffixes are merged in, and neighbours in the order are compared by their first ``size`` bytes. Only ``size`` bytes
ever matter, so the recursion stops as soon as its names stand for that many.

Defined cases: null and empty texts have nothing to remove; texts shorter than a window keep all; rows equal in key and
text count as one document; other columns are not read; an empty table gives an empty result. Texts are bytes of UTF-8;
a cut may fall inside a character, so results are bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlens.llm.bytesets import byte_values, text_buffer, window_hashes
from txnlens.llm.repeats import GROUP_UNITS, NULL_KEY, kept_parts, keyed, repeated_spans, span_arrays

SIZE = 200
GRAM = 50
_BITS = 21


def _names(keys: np.ndarray) -> tuple[np.ndarray, int]:
    """Dense ranks from 1, and how many there are."""
    order = np.argsort(keys)
    placed = keys[order]
    fresh = np.concatenate([[1], (placed[1:] != placed[:-1]).astype(np.int64)])
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.cumsum(fresh)
    return rank, int(fresh.sum())


def suffix_ranks(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Ranks (from 1) of all suffixes by their first ``depth`` symbols at least; symbols are from 1 to 2^21.

    Suffixes that differ within ``depth`` symbols are ordered by them; others stand next to each other.
    """
    n = len(symbols)
    s = np.concatenate([symbols, np.zeros(3 + (-n) % 3, np.int64)])
    n0 = len(s) - 3  # a multiple of 3
    p0, p1, p2 = (np.arange(k, n0, 3) for k in range(3))
    sample = np.concatenate([p1, p2])
    names, count = _names(s[sample] << 2 * _BITS | s[sample + 1] << _BITS | s[sample + 2])
    if count < len(names) and depth > 3:
        m = len(p1)
        string = np.concatenate([names[:m], names[m:]])
        names = suffix_ranks(string, -(-depth // 3))
    rank = np.zeros(n0 + 3, np.int64)
    rank[sample] = names
    one0, one1 = s[p0] << _BITS | rank[p0 + 1], s[p1] << _BITS | rank[p1 + 1]
    two0 = s[p0] << 2 * _BITS | s[p0 + 1] << _BITS | rank[p0 + 2]
    two2 = s[p2] << 2 * _BITS | s[p2 + 1] << _BITS | rank[p2 + 2]
    smaller = np.concatenate([[0], np.cumsum(np.bincount(names))])  # sampled suffixes below a name
    out = np.zeros(n0 + 3, np.int64)
    out[sample] = smaller[names]
    by_one0, by_one1, by_two0, by_two2 = (np.argsort(x) for x in (one0, one1, two0, two2))
    one0, one1, two0, two2 = one0[by_one0], one1[by_one1], two0[by_two0], two2[by_two2]
    out[p0[by_one0]] = np.searchsorted(one0, one0) + np.searchsorted(one1, one0)
    out[p0[by_two0]] += np.searchsorted(two2, two0)
    out[p1[by_one1]] += np.searchsorted(one0, one1)
    out[p2[by_two2]] += np.searchsorted(two0, two2)
    return out[:n] + 1


def repeated_in_piece(units: np.ndarray, length: np.ndarray, judged: np.ndarray, docs: np.ndarray,
                      size: int) -> np.ndarray:
    """Flags of the places whose first ``size`` bytes start at another place of the piece too."""
    end = np.cumsum(length)
    begin = end - length
    inside = np.zeros(len(units) + 1, np.int64)
    np.add.at(inside, begin, 1)
    np.add.at(inside, end - size + 1, -1)
    starts = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    ranks = suffix_ranks(units.astype(np.int64) + 1, size)
    order = starts[np.argsort(ranks[starts])]
    hashes = window_hashes(byte_values(units), size)
    a, b = order[:-1], order[1:]
    close = np.flatnonzero(hashes[a] == hashes[b])
    flags = np.zeros(len(units), bool)
    view = np.lib.stride_tricks.sliding_window_view(units, size)
    for part in range(0, len(close), 20_000):
        k = close[part:part + 20_000]
        k = k[(view[a[k]] == view[b[k]]).all(axis=1)]
        flags[a[k]] = True
        flags[b[k]] = True
    return flags


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, offsets = text_buffer(batch.column(1))
        out: list[tuple] = []
        for i in range(batch.num_rows):
            own = raw[offsets[i]:offsets[i + 1]]
            a, b = span_arrays(batch.column(2)[i])
            keep = [own[x:y].tobytes() for x, y in zip(np.concatenate([[0], b]), np.append(a, len(own)))]
            out.append((len(own), int((b - a).sum()), len(a), b"".join(keep)))
        yield pa.RecordBatch.from_pydict({
            "d": batch.column(0), "n_bytes": pa.array([o[0] for o in out], pa.int64()),
            "n_removed": pa.array([o[1] for o in out], pa.int64()), "n_spans": pa.array([o[2] for o in out], pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(o[3]).hexdigest() for o in out], pa.string()),
            "kept": pa.array([o[3] for o in out], pa.binary())})


def remove_repeated_bytes(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE,
                          gram: int = GRAM, group_units: int = GROUP_UNITS) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256, kept) of each row; ``kept`` holds the remaining bytes.

    A byte goes if a ``size``-byte string covers it that also starts anywhere else in the table.
    """
    source = keyed(docs, key, text)
    spans = repeated_spans(source, "bytes", size, gram, repeated_in_piece, earlier=False, group_units=group_units)
    cut = kept_parts(source, spans).mapInArrow(
        _cut, "d bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
    return cut.select(F.when(F.col("d") != NULL_KEY, F.col("d")).alias(key), "n_bytes", "n_removed", "n_spans",
                      "kept_sha256", "kept")
