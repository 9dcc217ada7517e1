"""Periodic runs of words in a text, by the branching-tandem test on an enhanced suffix array.

A text's words become numbers, its suffixes are sorted by doubling (ranks of 1, 2, 4, ... words), and neighbours' common
prefixes follow from the same ranks. Every interval of the suffix array whose members share exactly d words is looked at
once: each suffix i of its children, the largest one left out, is tested for i + d and i - d standing in the interval too.
That finds every place where a stretch of period d and at least 2 d words ends (its last square branches), so no tree
is built. Squares are rotated to the left as far as their period holds, which gives the run; of the periods found for
one stretch the smallest is its period.

Many texts are sorted at once: words of different texts are different numbers, so no interval spans two texts. Texts are
independent of each other, so Spark deals them out and nothing is shuffled; a task holds one text or a chunk of ``CHUNK_WORDS``
words. Time grows with n log^2 n of a text.

Defined cases: null and empty texts have no words and no runs; a null key leaves the text as it is in ``repeated_tails``;
rows are judged one by one, so repeated rows get equal results; other columns are not read; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlens.llm.bytesets import mix, row_words, text_buffer

#: A run has this many words and this many periods at least.
LEAST_WORDS = 6
LEAST_PERIODS = 4
#: Words that are sorted together (a longer text is still taken whole).
CHUNK_WORDS = 150_000

_FIELDS = ("doc_id {kind}, n_words bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
           "runs_sha256 string, collapsed_sha256 string, runs array<struct<start: bigint, length: bigint, period: bigint>>, "
           "collapsed string")


def rank_levels(values: np.ndarray) -> list[np.ndarray]:
    """Ranks of the 1, 2, 4, ... values from each place on, until all differ; one more entry stands for the end."""
    n = len(values)
    rank = np.append(spread_ranks(values), 0)
    levels = [rank]
    width = 1
    live = np.arange(n)  # places that still share their rank
    while True:
        count = np.bincount(rank[live], minlength=n + 2)
        live = live[count[rank[live]] > 1]
        if not len(live):
            return levels
        beyond = np.minimum(live + width, n)
        order = np.lexsort((rank[beyond], rank[live]))
        r, s = rank[live][order], rank[beyond][order]
        new_group = np.append(True, r[1:] != r[:-1])
        new_value = new_group | np.append(True, s[1:] != s[:-1])
        # a group of k members owns k ranks
        slot = np.arange(len(r))
        in_group = slot - np.maximum.accumulate(np.where(new_group, slot, 0))
        first = np.maximum.accumulate(np.where(new_value, slot, 0))
        nxt = rank.copy()
        nxt[live[order]] = r + in_group[first]
        rank = nxt
        levels.append(rank)
        width *= 2


def spread_ranks(values: np.ndarray) -> np.ndarray:
    """Each value's number of smaller ones, plus 1."""
    _, back, count = np.unique(values, return_inverse=True, return_counts=True)
    return (np.cumsum(count) - count + 1)[back]


def common_length(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, back: bool = False) -> np.ndarray:
    """How many values agree from places a and b on (or before them); a and b differ."""
    n = len(levels[0]) - 1
    length = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        step = 1 << k
        if back:
            x, y = a - length - step, b - length - step
            open_ = (x >= 0) & (y >= 0)
        else:
            x, y = a + length, b + length
            open_ = (x < n) & (y < n)
        x, y = np.where(open_, x, 0), np.where(open_, y, 0)
        same = open_ & (levels[k][x] == levels[k][y]) & (x != y)
        length[same] += step
    return length


def smaller_before(values: np.ndarray, strict: bool) -> np.ndarray:
    """For each place with a value above 0, the last one before it with a smaller value (or one not larger).

    The first value is not above 0. All places jump at once, over what their last stop has jumped over.
    """
    at = np.arange(len(values)) - 1
    live = np.flatnonzero(values > 0)
    own = values[live]
    while len(live):
        before = values[at[live]]
        wrong = before >= own if strict else before > own
        live, own = live[wrong], own[wrong]
        at[live] = at[at[live]]
    return at


def squares(levels: list[np.ndarray], most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and periods of branching squares; ``most`` is the largest period looked for from each place."""
    n = len(levels[0]) - 1
    none = np.empty(0, np.int64)
    if n < 2 or len(levels) < 2:
        return none, none
    isa = levels[-1][:n] - 1
    sa = np.empty(n, np.int64)
    sa[isa] = np.arange(n)
    lcp = np.zeros(n + 1, np.int64)
    lcp[1:n] = common_length(levels, sa[:-1], sa[1:])
    lcp[0] = lcp[n] = -1
    # the interval a boundary belongs to: suffixes [low, high] that share lcp[p] values
    low = smaller_before(lcp, True)
    turned = lcp[::-1]
    high = n - smaller_before(turned, True)[::-1] - 1
    after = n - smaller_before(turned, False)[::-1]  # next boundary with a value not larger
    edge = np.flatnonzero(lcp[:n] > 0)
    edge = edge[lcp[edge] <= most[sa[edge]]]
    if not len(edge):
        return none, none
    depth, lo, hi = lcp[edge], low[edge], high[edge]
    # children: the one right of every boundary, and the one left of an interval's first boundary
    before = smaller_before(lcp, False)[edge]
    first = lcp[before] < depth
    c_lo = np.concatenate([edge, lo[first]])
    c_hi = np.concatenate([after[edge] - 1, edge[first] - 1])
    c_depth, c_low, c_high = (np.concatenate([x, x[first]]) for x in (depth, lo, hi))
    size = c_hi - c_lo + 1
    order = np.lexsort((size, c_depth, c_low))
    same_next = np.append((c_low[order][1:] == c_low[order][:-1]) & (c_depth[order][1:] == c_depth[order][:-1]), False)
    small = order[same_next]  # all but the last, the largest, of every interval
    size = size[small]
    total = int(size.sum())
    owner = np.repeat(np.arange(len(small)), size)
    slot = np.arange(total) - np.repeat(np.cumsum(size) - size, size) + np.repeat(c_lo[small], size)
    i = sa[slot]
    d, a, b = (x[small][owner] for x in (c_depth, c_low, c_high))
    out = []
    for start, other in ((i, i + d), (i - d, i - d)):
        inside = (other >= 0) & (other < n)
        at = isa[np.where(inside, other, 0)]
        hit = inside & (at >= a) & (at <= b)
        out.append(np.stack([start[hit], d[hit]]))
    found = np.unique(np.concatenate(out, axis=1), axis=1)
    return found[0], found[1]


def runs_of(words: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of all runs, ordered by start and period; ``rows`` are the texts' first places (one more)."""
    none = np.empty(0, np.int64)
    n = len(words)
    if n < LEAST_WORDS:
        return none, none, none
    length = np.diff(rows)
    text = np.repeat(np.arange(len(length)), length)
    own = mix(words ^ mix(text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    levels = rank_levels(own)
    start, period = squares(levels, length[text] // LEAST_PERIODS)
    if not len(start):
        return none, none, none
    # a branching square ends its run; rotate to the left while the period holds
    end = start + 2 * period
    start = start - common_length(levels, start, start + period, back=True)
    # a square that isn't its run's last one goes on to the right
    end = end + common_length(levels, end - period, np.minimum(end, n))
    keep = end - start >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
    start, end, period = start[keep], end[keep], period[keep]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    smallest = np.append(True, (start[1:] != start[:-1]) | (end[1:] != end[:-1]))[:len(start)]
    start, end, period = start[smallest], end[smallest], period[smallest]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def tail_places(key, n: int) -> np.ndarray:
    """Fixed rule: which original word stands at each place once a text in ten is given a repeating tail."""
    places = np.arange(n)
    if key is None or n == 0:
        return places
    h = zlib.crc32(str(key).encode())
    if h % 10:
        return places
    g = h // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    places[a:] = a + (places[a:] - a) % period
    return places


def _report(tails: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_buffer(batch.column(1))
            keys = batch.column(0)
            for first, last, words in row_words(raw, offsets):
                yield _judged(keys.slice(first, last - first), words, tails)
    return run


def _judged(keys: pa.Array, words, tails: bool) -> pa.RecordBatch:
    known = keys.to_pylist()
    hashes, rows = words.hashes(), words.rows
    place = np.arange(len(hashes))
    if tails:
        for i, key in enumerate(known):
            a, b = rows[i], rows[i + 1]
            place[a:b] = a + tail_places(key, b - a)
    start, end, period = runs_of(hashes[place], rows)
    # words covered after the first period of some run
    step = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(step, start + period, 1)
    np.add.at(step, end, -1)
    kept = np.cumsum(step[:-1]) == 0
    plain = kept & (place == np.arange(len(place)))
    cut = np.searchsorted(start, rows)
    out: dict[str, list] = {c: [] for c in ("n_words", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                                            "collapsed_sha256", "runs", "collapsed")}
    for i in range(len(known)):
        a, b = rows[i], rows[i + 1]
        x, y = cut[i], cut[i + 1]
        runs = list(zip((start[x:y] - a).tolist(), (end[x:y] - start[x:y]).tolist(), period[x:y].tolist()))
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
        text = words.raw[words.starts[a]:words.ends[b - 1]].tobytes().split() if b > a else []
        left = b" ".join(text if plain[a:b].all() else [text[w] for w in (place[a:b][kept[a:b]] - a).tolist()])
        out["n_words"].append(int(b - a))
        out["n_runs"].append(len(runs))
        for c, v in zip(("start", "length", "period", "exponent_milli"),
                        (*best, 1000 * best[1] // best[2]) if best else (None,) * 4):
            out[c].append(v)
        out["runs_sha256"].append(hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest())
        out["collapsed_sha256"].append(hashlib.sha256(left).hexdigest())
        out["runs"].append([{"start": s, "length": n, "period": p} for s, n, p in runs])
        out["collapsed"].append(left.decode())
    kind = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])
    types = {"runs_sha256": pa.string(), "collapsed_sha256": pa.string(), "runs": pa.list_(kind), "collapsed": pa.string()}
    return pa.RecordBatch.from_arrays([keys, *[pa.array(v, types.get(c, pa.int64())) for c, v in out.items()]],
                                      ["doc_id", *out])


def find_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", repeated_tails: bool = False) -> DataFrame:
    """One row for each row: its words, runs, the one with the greatest exponent, and the text with each run cut to a period.

    ``repeated_tails`` first gives the texts of a tenth of the keys a repeating tail by a fixed rule, for trials.
    """
    source = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("t"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(_report(repeated_tails), _FIELDS.format(kind=kind)).withColumnRenamed("doc_id", key)
