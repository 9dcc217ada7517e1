"""Exact removal of word windows that stand in an earlier document, with prefix-partitioned suffix trees.

Suffixes that may repeat come together by a prefix of variable length: an anchor of ``gram`` words, or all ``size``
words where an anchor has more suffixes than fit in memory (see ``repeats``). Inside a piece the suffixes are split
further by longer prefixes until a group is small, each group's subtree is laid out as its sorted leaves with the depth
of the node above each pair of neighbours, and the internal nodes of ``size`` words or deeper are its maximal repeats;
the smallest document among a node's leaves decides what goes.

Defined cases: null and empty texts have no words; texts of fewer words than a window keep all; rows equal in key and
text count as one document and rows that only share the key never remove each other; other columns are not read; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlens.llm.bytesets import row_words, text_buffer
from txnlens.llm.repeats import GROUP_UNITS, NULL_KEY, kept_parts, keyed, repeated_spans, span_arrays

SIZE = 50
GRAM = 12
#: Leaves of one subtree.
LEAVES = 50_000


def prefix_groups(words: np.ndarray, leaves: np.ndarray, size: int, most: int = LEAVES) -> Iterator[np.ndarray]:
    """Splits leaves (places) by their first word, then by more words where a group is larger than ``most``."""
    waiting = [(leaves, 0)]
    while waiting:
        group, depth = waiting.pop()
        if len(group) < 2:
            continue
        if (len(group) <= most and depth) or depth >= size:
            yield group
            continue
        first = words[group + depth]
        order = np.argsort(first, kind="stable")
        cuts = np.flatnonzero(np.diff(first[order])) + 1
        parts = np.split(group[order], cuts)
        small: list[np.ndarray] = []
        held = 0
        for part in parts:  # neighbouring small groups share a subtree build
            if len(part) > most:
                waiting.append((part, depth + 1))
            elif len(part) > 1:
                small.append(part)
                held += len(part)
                if held > most:
                    yield np.concatenate(small)
                    small, held = [], 0
        if small:
            yield np.concatenate(small)


def subtree(words: np.ndarray, leaves: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The leaves in order, and the depth (up to ``size``) of the node above each leaf and its predecessor."""
    rank = np.zeros(len(leaves), np.int64)
    order = np.arange(len(leaves))
    depth = np.zeros(len(leaves), np.int64)
    live = order  # members of groups that are still together, in order
    for at in range(size):
        word = words[leaves[live] + at]
        inside = np.lexsort((word, rank[live]))
        slots = live_slots(rank, live, order)
        moved = live[inside]
        order[slots] = moved
        w, r = words[leaves[moved] + at], rank[moved]
        fresh = np.concatenate([[True], (r[1:] != r[:-1]) | (w[1:] != w[:-1])])
        same_parent = np.concatenate([[False], r[1:] == r[:-1]])
        depth[slots[fresh & same_parent]] = at
        begin = np.maximum.accumulate(np.where(fresh, np.arange(len(moved)), 0))
        rank[moved] = slots[begin]
        alone = fresh & np.append(fresh[1:], True)
        if at == 0:
            depth[slots[fresh]] = 0
        live = moved[~alone]
        if not len(live):
            break
    if len(live):
        slots = live_slots(rank, live, order)
        later = np.concatenate([[False], rank[live][1:] == rank[live][:-1]])
        depth[slots[later]] = size
    return leaves[order], depth


def live_slots(rank: np.ndarray, live: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Slots in the order that the members of ``live`` hold: a group's rank is its first slot."""
    r = rank[live]
    start = np.concatenate([[True], r[1:] != r[:-1]])
    return r + np.arange(len(r)) - np.maximum.accumulate(np.where(start, np.arange(len(r)), 0))


def earlier_in_piece(units: np.ndarray, length: np.ndarray, judged: np.ndarray, docs: np.ndarray,
                     size: int) -> np.ndarray:
    """Flags of the places whose window of ``size`` words also starts in a smaller document of the piece."""
    words = np.unique(units, return_inverse=True)[1]
    end = np.cumsum(length)
    begin = end - length
    owner = np.repeat(docs, length)
    inside = np.zeros(len(units) + 1, np.int64)
    np.add.at(inside, begin, 1)
    np.add.at(inside, end - size + 1, -1)
    leaves = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    flags = np.zeros(len(units), bool)
    for group in prefix_groups(words, leaves, size):
        ordered, depth = subtree(words, group, size)
        node = np.cumsum(depth < size) - 1  # leaves under one node of full depth
        first = np.full(node[-1] + 1, np.iinfo(np.int64).max)
        np.minimum.at(first, node, owner[ordered])
        flags[ordered[owner[ordered] > first[node]]] = True
    return flags


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, offsets = text_buffer(batch.column(1))
        out: list[tuple] = []
        for first, last, words in row_words(raw, offsets):
            for i in range(first, last):
                lo, hi = words.rows[i - first], words.rows[i - first + 1]
                a, b = span_arrays(batch.column(2)[i])
                keep = []
                for x, y in zip(np.concatenate([[0], b]), np.append(a, hi - lo)):
                    if y > x:
                        keep += words.raw[words.starts[lo + x]:words.ends[lo + y - 1]].tobytes().split()
                kept = b" ".join(keep)
                out.append((hi - lo, int((b - a).sum()), hashlib.sha256(kept).hexdigest(), kept.decode()))
        yield pa.RecordBatch.from_pydict({
            "d": batch.column(0), "n_words": pa.array([o[0] for o in out], pa.int64()),
            "n_removed": pa.array([o[1] for o in out], pa.int64()),
            "kept_sha256": pa.array([o[2] for o in out], pa.string()), "kept": pa.array([o[3] for o in out], pa.string())})


def remove_earlier_windows(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE,
                           gram: int = GRAM, group_units: int = GROUP_UNITS) -> DataFrame:
    """(key, n_words, n_removed, kept_sha256, kept) of each row; ``kept`` joins the remaining words by one space.

    A word goes if a window of ``size`` words covers it that also starts in a document with a smaller key.
    """
    source = keyed(docs, key, text)
    spans = repeated_spans(source, "words", size, gram, earlier_in_piece, earlier=True, group_units=group_units)
    cut = kept_parts(source, spans).mapInArrow(
        _cut, "d bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string")
    return cut.select(F.when(F.col("d") != NULL_KEY, F.col("d")).alias(key), "n_words", "n_removed", "kept_sha256",
                      "kept")
