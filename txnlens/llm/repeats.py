"""Which stretches of a text repeat elsewhere: the distributed part shared by both substring operators.

A text is a list of units (bytes or words); a window is ``size`` consecutive units. Every window is named by the
smallest hash among its ``gram``-unit pieces, its anchor. Equal windows have equal anchors, so

1. only anchors that stand in two places or more go on (one grouping over all anchors),
2. neighbouring windows with one anchor form a context; contexts that are equal as a whole need no more work,
3. the other contexts meet by anchor in tasks of bounded memory, where a suffix structure over them is exact,
4. anchors with more contexts than fit in memory are split by whole windows, which are grouped and counted.

No step drops, caps or samples anything: what leaves in step 1 cannot repeat. Spark groups, joins and shuffles; numpy
works on one bounded piece. Rows are identified by key and text; rows equal in both count as one document. Null keys
are one key. Contexts travel with their units, texts are read again once for them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlens.llm.bytesets import byte_values, mix, row_words, sliding_min, span_hashes, text_buffer, union_length_runs, \
    window_hashes
from txnlens.session import materialize

NULL_KEY = -2**63
#: Units in one piece of work; names of places then fit 21 bits.
CHUNK_UNITS = 1_000_000
GROUP_UNITS = 900_000
#: Windows in one context; longer runs of one anchor are cut into several.
MOST_WINDOWS = 1 << 18

#: (units, judged, document, context length) of a piece -> flags of windows by place.
Judge = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int], np.ndarray]


def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(d, h, t): key, hash of the text, text. Null texts are empty."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col(key).cast("bigint"), F.lit(NULL_KEY)).alias("d"), F.xxhash64(t).alias("h"),
                       t.alias("t"))


def unit_rows(column: pa.Array, kind: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Row, hashed units and units as they travel."""
    raw, offsets = text_buffer(column)
    if kind == "bytes":
        for i in range(len(column)):
            own = raw[offsets[i]:offsets[i + 1]]
            yield i, byte_values(own), own
    else:
        for first, last, words in row_words(raw, offsets):
            hashes = words.hashes()
            for i in range(first, last):
                own = hashes[words.rows[i - first]:words.rows[i - first + 1]]
                yield i, own, own


def contexts(values: np.ndarray, size: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first and last window of each context of one text."""
    if len(values) < size:
        none = np.empty(0, np.int64)
        return np.empty(0, np.uint64), none, none
    pieces = window_hashes(values, gram)
    anchor = sliding_min(pieces, size - gram + 1)
    # A context ends where the anchor changes, or where its first place leaves the window and another has its value.
    edge = np.flatnonzero((anchor[1:] != anchor[:-1]) | (pieces[:len(anchor) - 1] == anchor[:-1])) + 1
    first = np.concatenate([[0], edge])
    last = np.append(edge, len(anchor)) - 1
    if (last - first >= MOST_WINDOWS).any():
        first = np.concatenate([np.arange(a, b + 1, MOST_WINDOWS) for a, b in zip(first, last)])
        last = np.minimum(np.append(first[1:], len(anchor)) - 1, first + MOST_WINDOWS - 1)
    return anchor[first], first, last


def _anchors(kind: str, size: int, gram: int, whole: bool):
    """Anchors of each row: (g, l) with a hash of the place, or with the place and the context's hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d, h = (batch.column(i).to_numpy().view(np.uint64) for i in (0, 1))
            parts, held = [], 0
            for i, values, _ in unit_rows(batch.column(2), kind):
                g, first, last = contexts(values, size, gram)
                if not len(g):
                    continue
                if whole:
                    w = span_hashes(values, first, last + size)
                    parts.append((g, w, np.full(len(g), d[i]), np.full(len(g), h[i]), first, last))
                else:
                    parts.append((g, mix(mix(d[i:i + 1] ^ mix(h[i:i + 1])) + first.astype(np.uint64))))
                held += len(g)
                if held > 200_000:
                    yield _batch(parts, whole)
                    parts, held = [], 0
            if parts:
                yield _batch(parts, whole)
    return run


def _batch(parts: list[tuple], whole: bool) -> pa.RecordBatch:
    names = ["g", "w", "d", "h", "lo", "hi"] if whole else ["g", "l"]
    return pa.RecordBatch.from_pydict({n: pa.array(np.concatenate(c).view(np.int64)) for n, c in zip(names, zip(*parts))})


def _extract(kind: str, size: int):
    """Contexts with their units, from rows (t, list of places)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d, h, places = batch.column(0), batch.column(1), batch.column(3)
            for i, _, units in unit_rows(batch.column(2), kind):
                wanted = places[i].as_py()
                yield pa.RecordBatch.from_pydict({
                    "g": pa.array([p["g"] for p in wanted], pa.int64()),
                    "d": pa.array([d[i].as_py()] * len(wanted), pa.int64()),
                    "h": pa.array([h[i].as_py()] * len(wanted), pa.int64()),
                    "lo": pa.array([p["lo"] for p in wanted], pa.int64()),
                    "judged": pa.array([p["judged"] for p in wanted], pa.bool_()),
                    "crowded": pa.array([p["crowded"] for p in wanted], pa.bool_()),
                    "units": pa.array([units[p["lo"]:p["hi"] + size].tobytes() for p in wanted], pa.binary())})
    return run


def _pieces(judge: Judge, dtype: type, size: int, limit: int):
    """Runs ``judge`` over anchors in a row until a piece is full; gives runs of repeated windows within judged contexts."""
    def work(rows: list[tuple]) -> pa.RecordBatch:
        units = [np.frombuffer(r[5], dtype) for r in rows]
        length = np.array([len(u) for u in units])
        begin = np.concatenate([[0], np.cumsum(length)[:-1]])
        flags = judge(np.concatenate(units), length, np.array([r[4] for r in rows]), np.array([r[1] for r in rows]), size)
        out: list[tuple] = []
        for row, a, n in zip(rows, begin, length):
            if row[4]:
                hit = np.flatnonzero(flags[a:a + n - size + 1])
                if len(hit):
                    cut = np.flatnonzero(np.diff(hit) > 1)
                    for x, y in zip(hit[np.concatenate([[0], cut + 1])], hit[np.append(cut, len(hit) - 1)]):
                        out.append((row[1], row[2], row[3], int(x), int(y) + size))
        return pa.RecordBatch.from_pydict({n: pa.array([o[k] for o in out], pa.int64())
                                           for k, n in enumerate(("d", "h", "lo", "a", "b"))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        group: list[tuple] = []
        held = grown = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if group and row[0] != group[0][0]:
                    if held and held + grown > limit:
                        yield work(rows)
                        rows, held = [], 0
                    rows += group
                    held += grown
                    group, grown = [], 0
                group.append(row)
                grown += len(row[5]) // np.dtype(dtype).itemsize
        if held and held + grown > limit:
            yield work(rows)
            rows = []
        rows += group
        if rows:
            yield work(rows)
    return run


def _windows(kind: str, size: int):
    """One row for each window of crowded contexts, with two hashes of it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g, d, h, lo, judged, units in zip(*(c.to_pylist() for c in batch.columns)):
                values = byte_values(np.frombuffer(units, np.uint8)) if kind == "bytes" else np.frombuffer(units, np.uint64)
                one, two = window_hashes(values, size, 1), window_hashes(values, size, 2)
                n = len(one)
                yield pa.RecordBatch.from_pydict({
                    "f1": pa.array(one.view(np.int64)), "f2": pa.array(two.view(np.int64)),
                    "d": pa.array(np.full(n, d)), "h": pa.array(np.full(n, h)), "lo": pa.array(np.full(n, lo)),
                    "a": pa.array(np.arange(n)), "judged": pa.array(np.full(n, judged))})
    return run


def repeated_spans(source: DataFrame, kind: str, size: int, gram: int, judge: Judge, earlier: bool,
                   group_units: int = GROUP_UNITS) -> DataFrame:
    """(d, h, spans): the stretches of each row of ``keyed`` that repeated windows cover.

    ``earlier`` False: windows that also start anywhere else. True: that also start in a row with a smaller d.
    """
    flat = source.mapInArrow(_anchors(kind, size, gram, False), "g bigint, l bigint")
    shared = flat.groupBy("g").agg(F.min("l").alias("x"), F.max("l").alias("y")).where("x <> y").select("g")
    shared = materialize(shared, "shared")  # stored, so that the join below can split the places of one hot anchor
    full = source.mapInArrow(_anchors(kind, size, gram, True),
                             "g bigint, w bigint, d bigint, h bigint, lo bigint, hi bigint")
    found = materialize(full.join(shared, "g"), "anchors")
    place = F.struct("d", "h", "lo")
    classes = materialize(found.groupBy("g", "w").agg(
        F.min(place).alias("one"), F.max(place).alias("two"), F.max(F.col("hi") - F.col("lo")).alias("wide")), "classes")
    more = (F.col("one")["d"] < F.col("two")["d"]) if earlier else (F.col("one") != F.col("two"))
    groups = classes.groupBy("g").agg(F.count("*").alias("n"), F.sum(F.when(more, 0).otherwise(1)).alias("single"),
                                      F.sum(F.col("wide") + size).alias("units"))
    groups = groups.where((F.col("n") > 1) & (F.lit(earlier) | (F.col("single") > 0))) \
        .select("g", (F.col("units") > group_units).alias("crowded"))

    # Equal contexts share their verdict: one place a class is judged, whatever the number of its places.
    judged = classes.select("g", "one.*", "wide", (F.lit(True) if earlier else ~more).alias("judged")) \
        .select("g", "d", "h", "lo", (F.col("lo") + F.col("wide")).alias("hi"), "judged")
    if earlier:
        again = found.join(classes.where("one <> two").select("g", "w", "one"), ["g", "w"]).where(place != F.col("one"))
        again = materialize(again.select("d", "h", "lo", "hi", "one"), "again")
        covered = again.where(F.col("d") > F.col("one")["d"])
        alike = again.where(F.col("d") == F.col("one")["d"]).select("d", "h", "lo", "one")
    else:
        covered = found.join(classes.where(more).select("g", "w"), ["g", "w"])
    covered = covered.select("d", "h", F.col("lo").alias("a"), (F.col("hi") + size).alias("b"))

    lists = judged.join(groups, "g").groupBy("d", "h").agg(
        F.collect_list(F.struct("g", "lo", "hi", "judged", "crowded")).alias("places"))
    texts = source.join(lists, ["d", "h"]).select("d", "h", "t", "places")
    pieces = materialize(texts.mapInArrow(_extract(kind, size), "g bigint, d bigint, h bigint, lo bigint, "
                                          "judged boolean, crowded boolean, units binary"), "contexts")
    columns = ["g", "d", "h", "lo", "judged", "units"]
    dtype = np.uint8 if kind == "bytes" else np.uint64
    small = pieces.where("not crowded").dropDuplicates(["g", "d", "h", "lo"]).select(*columns).repartition("g") \
        .sortWithinPartitions("g").mapInArrow(_pieces(judge, dtype, size, CHUNK_UNITS), "d bigint, h bigint, lo bigint, a bigint, b bigint")
    small = materialize(small, "spans")

    windows = pieces.where("crowded").select(*columns).mapInArrow(
        _windows(kind, size), "f1 bigint, f2 bigint, d bigint, h bigint, lo bigint, a bigint, judged boolean")
    at = F.struct("d", "h", (F.col("lo") + F.col("a")).alias("at"))
    known = windows.groupBy("f1", "f2").agg(F.min(at).alias("one"), F.max(at).alias("two"))
    known = known.where((F.col("one")["d"] < F.col("two")["d"]) if earlier else (F.col("one") != F.col("two")))
    hot = windows.where("judged").join(known.select("f1", "f2", F.col("one")["d"].alias("first")), ["f1", "f2"])
    if earlier:
        hot = hot.where(F.col("d") > F.col("first"))
    hot = hot.select("d", "h", "lo", "a", (F.col("a") + size).alias("b"))
    within = small.unionByName(hot)
    if earlier:
        within = materialize(within, "within")
        judged_at = within.select(F.struct("d", "h", "lo").alias("one"), "a", "b")
        within = within.unionByName(alike.join(judged_at, "one").select("d", "h", "lo", "a", "b"))
    spans = covered.unionByName(within.select("d", "h", (F.col("lo") + F.col("a")).alias("a"), (F.col("lo") + F.col("b")).alias("b")))
    return spans.groupBy("d", "h").agg(F.collect_set(F.struct("a", "b")).alias("spans"))


def kept_parts(source: DataFrame, spans: DataFrame) -> DataFrame:
    """Rows of ``keyed`` with their spans (null: none)."""
    return source.join(spans, ["d", "h"], "left").select("d", "t", "spans")


def span_arrays(value) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of one row's maximal covered runs."""
    if value is None or not value.is_valid:
        return union_length_runs(np.empty(0, np.int64), np.empty(0, np.int64))
    flat = value.values
    return union_length_runs(flat.field("a").to_numpy(), flat.field("b").to_numpy())
