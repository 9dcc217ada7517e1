"""Near-duplicate documents by min-max hashing.

Every document becomes the set of its distinct word shingles. Under each permutation both the smallest and the largest
value are kept, so ``PERMUTATIONS`` hash evaluations give twice as many signature values; two documents of similarity J
agree in each with probability J. A band holds two permutations (four values); documents that share a band are
candidates, and every link is confirmed on the full sets. At 0.85 a pair misses all 32 bands with probability 6e-11.

Links are found without listing the pairs of a group:
1. Equal sets are one class; only its smallest document goes on.
2. In each band group, every member is compared with the group's first document.
3. Where a group still has several components, its members outside the largest one are compared with the others, in
   blocks of bounded size that many tasks share; only links between components come out.
So all pairs that share a band are in one component or were compared. Components come from joins.

Defined cases: a null or empty text, or one without words, has an empty set and is linked with nothing; fewer words
than a shingle make the whole sequence the only shingle. A document is a key and a text: rows equal in both are one,
different texts under one key or under a null key are different documents (a null key comes after all others). A
component is named by its smallest key (null if none has a key), and every document with that key is kept in
:func:`near_duplicates`; :func:`keep_one_of_each` keeps one of them. Other columns are not read, whatever their names; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlens.llm.bytesets import mix, row_words, text_buffer
from txnlens.llm.graph import components
from txnlens.session import materialize

PERMUTATIONS = 64
PER_BAND = 2
BANDS = PERMUTATIONS // PER_BAND
#: Shingle values that one block holds at most (a longer document is a block of its own).
BLOCK_VALUES = 200_000
#: Documents that one block holds at most, as queries and as members.
BLOCK_DOCUMENTS = 2_000
#: Stands for a null key: it comes after all others.
_NULL_KEY = 2**63 - 1
_NAME = "struct<k: bigint, h: bigint>"
_RANDOM = np.random.default_rng(77)
_FACTOR = _RANDOM.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSET = _RANDOM.integers(0, 2**64, PERMUTATIONS, dtype=np.uint64)
_PLACE = _RANDOM.integers(0, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SECOND = np.uint64(0xA5A5A5A5C3C3C3C3)


def shingle_arrays(raw: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """First row and the distinct sorted shingle hashes of each row, for ranges of rows. A-Z are lower-cased."""
    for first, last, words in row_words(raw, offsets, lower=True):
        hashes, rows = words.hashes(), words.rows
        out = []
        n = len(hashes)
        joined = np.zeros(max(0, n - size + 1), np.uint64)
        for k in range(size):
            joined += hashes[k:n - size + 1 + k] * _PLACE[k]
        joined = mix(joined)
        for a, b in zip(rows[:-1], rows[1:]):
            if b - a >= size:
                out.append(np.unique(joined[a:b - size + 1]))
            elif b > a:
                whole = hashes[a:b] * _PLACE[8:8 + b - a] if b - a <= 8 else hashes[a:b]
                out.append(mix(np.array([whole.sum(dtype=np.uint64) + np.uint64(b - a)], np.uint64)))
            else:
                out.append(np.empty(0, np.uint64))
        yield first, out


def fingerprint(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums that identify each set."""
    one = np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64)
    two = np.array([mix(s ^ _SECOND).sum(dtype=np.uint64) for s in sets], np.uint64)
    return one, two


def band_hashes(sets: list[np.ndarray]) -> np.ndarray:
    """One row of band hashes for each set that isn't empty."""
    filled = [s for s in sets if len(s)]
    if not filled:
        return np.empty((0, BANDS), np.uint64)
    flat = np.concatenate(filled)
    begin = np.concatenate([[0], np.cumsum([len(s) for s in filled])[:-1]])
    bands = np.zeros((len(filled), BANDS), np.uint64)
    value = np.empty_like(flat)
    for p in range(PERMUTATIONS):
        np.multiply(flat, _FACTOR[p], out=value)
        value += _OFFSET[p]
        low, high = np.minimum.reduceat(value, begin), np.maximum.reduceat(value, begin)
        band, place = divmod(p, PER_BAND)
        bands[:, band] += mix(low) * _PLACE[2 * place] + mix(high) * _PLACE[2 * place + 1]
    return mix(bands + np.arange(BANDS, dtype=np.uint64) * _SECOND)


def _named(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(k, t): a document's name (key and hash of the text) and its text."""
    t = F.col(text).cast("string")
    return docs.select(F.struct(F.coalesce(F.col(key).cast("bigint"), F.lit(_NULL_KEY)).alias("k"),
                                F.xxhash64(t).alias("h")).alias("k"), t.alias("t"))


def signatures(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(k, n, f1, f2, bands) of each row; bands is null for an empty set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_buffer(batch.column(1))
            for first, sets in shingle_arrays(raw, offsets, size):
                one, two = fingerprint(sets)
                rows = iter(band_hashes(sets).view(np.int64))
                yield pa.RecordBatch.from_pydict({
                    "k": batch.column(0).slice(first, len(sets)),
                    "n": pa.array([len(s) for s in sets], pa.int64()),
                    "f1": pa.array(one.view(np.int64)), "f2": pa.array(two.view(np.int64)),
                    "bands": pa.array([next(rows) if len(s) else None for s in sets], pa.list_(pa.int64()))})
    return _named(docs, key, text).mapInArrow(run, f"k {_NAME}, n bigint, f1 bigint, f2 bigint, bands array<bigint>")


def full_sets(docs: DataFrame, wanted: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(k, n, s): the shingle sets of the wanted rows (k, f1, f2)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_buffer(batch.column(3))
            f1, f2 = (batch.column(i).to_numpy() for i in (1, 2))
            for first, sets in shingle_arrays(raw, offsets, size):
                one, two = fingerprint(sets)
                span = slice(first, first + len(sets))
                hit = np.flatnonzero((one.view(np.int64) == f1[span]) & (two.view(np.int64) == f2[span]))
                yield pa.RecordBatch.from_pydict({
                    "k": batch.column(0).take(pa.array(first + hit)), "n": pa.array([len(sets[i]) for i in hit], pa.int64()),
                    "s": pa.array([sets[i].view(np.int64) for i in hit], pa.list_(pa.int64()))})
    found = wanted.join(_named(docs, key, text), "k").select("k", "f1", "f2", "t")
    return found.mapInArrow(run, f"k {_NAME}, n bigint, s array<bigint>").dropDuplicates(["k"])


def _linked(n: str, m: str, both, percent: int):
    return both * 100 >= (F.col(n) + F.col(m) - both) * percent


def _compare_blocks(percent: int):
    """Links between components inside one block of queries and members."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        asked = rows["asked"].to_numpy(bool)
        n, label = rows["n"].to_numpy(), rows[["label_k", "label_h"]].to_numpy(np.int64)
        sets = [np.asarray(s, np.int64) for s in rows["s"]]
        flat = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), n)
        _, place, count = np.unique(flat, return_inverse=True, return_counts=True)
        shared = count[place] > 1
        place = (np.cumsum(count > 1) - 1)[place[shared]]
        owner = owner[shared]
        order = np.argsort(place, kind="stable")
        place, owner = place[order], owner[order]
        q, m = np.flatnonzero(asked), np.flatnonzero(~asked)
        both = np.zeros((len(q), len(m)), np.float32)
        width = 4096
        for start in range(0, int(place[-1]) + 1 if len(place) else 0, width):
            a, b = np.searchsorted(place, [start, start + width])
            grid = np.zeros((len(sets), width), np.float32)
            grid[owner[a:b], place[a:b] - start] = 1
            both += grid[q] @ grid[m].T
        union = n[q][:, None] + n[m][None, :] - both
        i, j = np.nonzero((both * 100 >= union * percent)
                          & (label[q][:, None, :] != label[m][None, :, :]).any(axis=2))
        return pd.DataFrame(np.concatenate([label[q][i], label[m][j]], axis=1),
                            columns=["ak", "ah", "bk", "bh"]).drop_duplicates()
    return run


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3, percent: int = 85,
                    block_values: int = BLOCK_VALUES, block_documents: int = BLOCK_DOCUMENTS) -> DataFrame:
    """(key, n_shingles, component_id, kept) of each row; two documents are linked at ``percent`` similarity or more."""
    found = document_components(docs, key, text, size, percent, block_values, block_documents)
    back = lambda c: F.when(F.col(c) != _NULL_KEY, F.col(c))
    return found.select(back("k.k").alias(key), F.col("n").alias("n_shingles"), back("label.k").alias("component_id"),
                        (F.col("k.k") == F.col("label.k")).alias("kept"))


def document_components(docs: DataFrame, key: str, text: str, size: int, percent: int,
                        block_values: int = BLOCK_VALUES, block_documents: int = BLOCK_DOCUMENTS) -> DataFrame:
    """(k, n, label) of each row: its document's name, shingles, and the name of its component's first document."""
    signed = materialize(signatures(docs, key, text, size), "signed")
    classes = signed.where("n > 0").groupBy("f1", "f2", "n").agg(F.min("k").alias("rep"),
                                                                F.first("bands").alias("bands"))
    classes = materialize(classes, "classes")
    banded = classes.select(F.explode("bands").alias("band"), F.col("rep").alias("k"), "n")
    groups = materialize(banded.groupBy("band").agg(
        F.min("k").alias("center"), F.count("*").alias("size"), F.sum(F.xxhash64("k").cast("decimal(20,0)")).alias("who"),
        F.min_by("n", "k").alias("m")).where("size > 1"), "groups")
    members = materialize(banded.join(groups, "band"), "members")
    wanted = members.select("k").distinct().join(classes.select(F.col("rep").alias("k"), "f1", "f2"), "k")
    sets = materialize(full_sets(docs, wanted, key, text, size), "sets")

    # 2. Every member against the first document of its group.
    pairs = members.where("k <> center").where(
        F.least("n", "m") * 100 >= F.greatest("n", "m") * percent).select("center", "k").distinct()
    left = pairs.join(sets.select("k", "n", "s"), "k")
    right = sets.select(F.col("k").alias("center"), F.col("n").alias("m"), F.col("s").alias("z"))
    both = F.size(F.array_intersect("s", "z"))
    links = left.join(right, "center").where(_linked("n", "m", both, percent)) \
        .select(F.col("center").alias("a"), F.col("k").alias("b"))
    links = materialize(links, "links")
    labels = components(links)

    # 3. What is left inside groups of three or more documents. Groups of the same members are looked at once.
    open_groups = groups.where("size > 2").groupBy("who", "size").agg(F.min("band").alias("band")).select("band")
    inside = members.join(open_groups, "band").join(labels.withColumnRenamed("node", "k"), "k", "left") \
        .select("band", "k", "n", F.coalesce("label", "k").alias("label"))
    parts = inside.groupBy("band", "label").agg(F.count("*").alias("size"), F.sum("n").alias("values"))
    state = parts.groupBy("band").agg(
        F.count("*").alias("parts"), F.max(F.struct("size", "label"))["label"].alias("main"),
        F.sum("values").alias("all_values"), F.max(F.struct("size", "label", "values")).alias("largest"),
        F.sum("size").alias("all_size"))
    blocks = lambda values, size: F.greatest(
        F.lit(1), F.ceil(values / block_values), F.ceil(size / block_documents)).cast("int")
    state = state.where("parts > 1").select(
        "band", "main", blocks(F.col("all_values"), F.col("all_size")).alias("m_blocks"),
        blocks(F.col("all_values") - F.col("largest.values"), F.col("all_size") - F.col("largest.size")).alias("q_blocks"))
    rest = inside.join(state, "band").join(sets.select("k", "s"), "k")
    own = F.pmod(F.xxhash64("k"), F.lit(1 << 30))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    label = [F.col("label.k").alias("label_k"), F.col("label.h").alias("label_h")]
    asked = rest.where("label <> main").select("band", "n", *label, "s", F.lit(True).alias("asked"),
                                               (own % F.col("q_blocks")).cast("int").alias("q"),
                                               each("m_blocks").alias("m"))
    held = rest.select("band", "n", *label, "s", F.lit(False).alias("asked"), each("q_blocks").alias("q"),
                       (own % F.col("m_blocks")).cast("int").alias("m"))
    found = asked.unionByName(held).groupBy("band", "q", "m").applyInPandas(_compare_blocks(percent),
                                                                           "ak bigint, ah bigint, bk bigint, bh bigint")
    name = lambda c: F.struct(F.col(c + "k").alias("k"), F.col(c + "h").alias("h")).alias(c)
    joined = components(materialize(found.distinct().select(name("a"), name("b")), "links"))
    top = labels.join(joined.select(F.col("node").alias("label"), F.col("label").alias("top")), "label", "left") \
        .select("node", F.coalesce("top", "label").alias("label"))
    lone = joined.join(labels.select("node"), "node", "left_anti")
    final = top.unionByName(lone)

    of_class = classes.select("f1", "f2", "n", "rep").join(final.withColumnRenamed("node", "rep"), "rep", "left") \
        .select("f1", "f2", "n", F.coalesce("label", "rep").alias("label"))
    return signed.drop("bands").join(of_class, ["f1", "f2", "n"], "left") \
        .select("k", "n", F.coalesce("label", "k").alias("label"))


def keep_one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5,
                     percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose document is the first of its component; of rows equal in key and text, one stays."""
    first = document_components(docs, key, text, size, percent).where(F.col("k") == F.col("label"))
    first = first.select(F.col("k.k").alias("k"), F.col("k.h").alias("h")).distinct()
    names = docs.select(
        F.coalesce(F.col(f"`{key}`").cast("bigint"), F.lit(_NULL_KEY)).alias("k"),
        F.xxhash64(F.col(f"`{text}`").cast("string")).alias("h"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return names.join(first, ["k", "h"], "left_semi").dropDuplicates(["k", "h"]).select("row.*")
