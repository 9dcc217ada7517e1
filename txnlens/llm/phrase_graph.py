"""Phrase collocations from a weighted de Bruijn graph of word grams.

A node is two consecutive words, an edge the three words of two overlapping nodes, weighted by how often it occurs
within pieces of text. Words travel as 64-bit hashes that depend on the language.

1. One pass counts words outright. Words below the least count are in no phrase that can be listed.
2. Each chunk of text gives its own graph: edges with weights, and as corrections the last node of every piece, which nothing
   leaves. A word that is too rare ends a piece like a mark, told by a bitmap of fixed size (its false hits only keep
   edges that have too low a count anyway).
3. Edges of all chunks meet by node. A node's count is the flow that leaves it plus its ends; a node with one edge and no
   end lies on an unary path, has its edge's weight and shares its row. Rows whose counts are below the least go.
4. Cuts are scored by joins with these counts; only what can be among the listed phrases is spelled out in a last pass.

Defined cases: null and empty texts give nothing, a null language is ``und``, other columns are not read, repeated rows
count each, an empty table gives an empty result. Counts up to 10^15 are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnlens.llm.bytesets import IS_SPACE, mix, row_words, text_buffer
from txnlens.session import materialize

LEAST = 10
TOP = 2000
#: Phrases inside a longer candidate with this share of their count or more go.
INSIDE_PERCENT = 50
SCALE = 1_000_000
UNKNOWN = "und"
#: Words of one local graph.
CHUNK_WORDS = 1_000_000
#: Bits of a bitmap over hashes: 8 MB.
BITMAP_BITS = 26
#: Slots that remember phrases already given by a task.
SEEN = 1 << 16
_PAGE = 32768  # positions in one bitmap that Spark aggregates

_CUTS = np.zeros(256, bool)
_CUTS[list(b".,;:!?\n\x0b\x0c\r")] = True
_BREAKS = _CUTS | IS_SPACE


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def phrase_hash(*words: np.ndarray) -> np.ndarray:
    """Word hashes are well mixed, so turning each by its place keeps phrases apart; ``_phrase_key`` is the same in SQL."""
    return reduce(np.bitwise_xor, [words[0], *(_turned(w, k) for k, w in enumerate(words[1:], 1))])


def _phrase_key(*names: str) -> Column:
    turned = [F.shiftleft(c, k).bitwiseOR(F.shiftrightunsigned(c, 64 - k)) for k, c in enumerate(names[1:], 1)]
    return reduce(lambda a, b: a.bitwiseXOR(b), [F.col(names[0]), *turned])


class Stretch:
    """The words of a range of rows, as hashes, with where pieces go on."""

    def __init__(self, words, tongue: np.ndarray, base: int):
        """tongue: a hash of each row's language; base: the first row's place in its batch."""
        self.words, self.base = words, base
        self.row = np.repeat(np.arange(len(tongue)), np.diff(words.rows))
        self.tongue = tongue[self.row]
        cut = np.cumsum(_CUTS[words.raw])[words.starts]
        self.word = mix(words.hashes() + mix(self.tongue))
        #: Whether the next word, or the next two, are of the same piece.
        self.one = np.append((self.row[1:] == self.row[:-1]) & (cut[1:] == cut[:-1]), False)
        self.two = self.one & np.append(self.one[1:], False)

    def grams(self, at: np.ndarray, size: int) -> list[np.ndarray]:
        return [self.word[at + k] for k in range(size)]

    def spelled(self, at: np.ndarray, size: int) -> list[bytes]:
        raw, starts, ends = self.words.raw, self.words.starts, self.words.ends
        return [b" ".join(raw[starts[i + k]:ends[i + k]].tobytes() for k in range(size)) for i in at]


def stretches(batch: pa.RecordBatch) -> Iterator[Stretch]:
    """From columns text and hash of the language."""
    raw, offsets = text_buffer(batch.column(0))
    tongue = batch.column(1).to_numpy().view(np.uint64)
    for first, last, words in row_words(raw, offsets, lower=True, breaks=_BREAKS):
        if len(words.starts):
            yield Stretch(words, tongue[first:last], first)


def _counted(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows of some columns and how often each occurs."""
    _, first, count = np.unique(phrase_hash(*columns), return_index=True, return_counts=True)
    return [c[first] for c in columns], count


def _by_chunk(give):
    """``give`` of each about ``CHUNK_WORDS`` words; it takes a list of what ``keep`` makes of a stretch."""
    keep, finish = give

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for s in stretches(batch):
                parts.append(keep(s))
                held += len(s.word)
                if held > CHUNK_WORDS:
                    yield finish(parts)
                    parts, held = [], 0
        if parts:
            yield finish(parts)
    return run


def _word_rows(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    (word, tongue), count = _counted([np.concatenate(c) for c in zip(*parts)])
    return pa.RecordBatch.from_pydict({"word": pa.array(word.view(np.int64)), "tongue": pa.array(tongue.view(np.int64)),
                                       "n": pa.array(count)})


def word_counts(source: DataFrame) -> DataFrame:
    """(word, tongue, n) of every word of every language."""
    rows = source.mapInArrow(_by_chunk((lambda s: (s.word, s.tongue), _word_rows)), "word bigint, tongue bigint, n bigint")
    return materialize(rows.groupBy("word", "tongue").agg(F.sum("n").alias("n")), "words")


def _edge_rows(parts: list[tuple]) -> pa.RecordBatch:
    edge, weight = _counted([np.concatenate([p[0][k] for p in parts]) for k in range(3)])
    end, ends = _counted([np.concatenate([p[1][k] for p in parts]) for k in range(2)])
    last = pa.concat_arrays([pa.array(edge[2].view(np.int64)), pa.nulls(len(ends), pa.int64())])
    return pa.RecordBatch.from_pydict({
        "h1": pa.array(np.concatenate([edge[0], end[0]]).view(np.int64)),
        "h2": pa.array(np.concatenate([edge[1], end[1]]).view(np.int64)), "h3": last,
        "n": pa.array(np.concatenate([weight, ends]))})


def gram_counts(source: DataFrame, frequent, least: int) -> DataFrame:
    """(h1, h2, h3, n, flow, leads): edges with their weight ``n``; one row of each node leads and has its count ``flow``.

    Edges and nodes below ``least`` are left out. ``frequent`` is the shared bitmap of words.
    """
    def keep(s: Stretch):
        ok = _listed(frequent.value, s.word)
        pair = s.one & ok & np.append(ok[1:], False)
        edge = pair & s.two & np.append(ok[2:], [False, False])[:len(ok)]
        return s.grams(np.flatnonzero(edge), 3), s.grams(np.flatnonzero(pair & ~edge), 2)

    rows = source.mapInArrow(_by_chunk((keep, _edge_rows)), "h1 bigint, h2 bigint, h3 bigint, n bigint")
    met = rows.repartition("h1", "h2").groupBy("h1", "h2", "h3").agg(F.sum("n").alias("n"))
    node = Window.partitionBy("h1", "h2")
    met = met.withColumn("flow", F.sum("n").over(node)).withColumn("leads", F.row_number().over(node.orderBy("h3")) == 1)
    is_edge = F.col("h3").isNotNull() & (F.col("n") >= least)
    is_node = F.col("leads") & (F.col("flow") >= least)
    return materialize(met.where(is_edge | is_node), "grams")


def _listed(flags: np.ndarray, keys: np.ndarray) -> np.ndarray:
    spot = keys >> np.uint64(64 - BITMAP_BITS)
    return (flags[(spot >> np.uint64(3)).astype(np.int64)] >> (spot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def shared_bitmap(keys: DataFrame, key: str):
    """A bit for the leading bits of each hash: 2^BITMAP_BITS of them, whatever the number of keys; shared with all tasks."""
    spot = F.shiftrightunsigned(key, 64 - BITMAP_BITS)
    pages = keys.groupBy(F.shiftright(spot, 15).alias("page")).agg(
        F.bitmap_construct_agg(spot.bitwiseAND(F.lit(_PAGE - 1))).alias("bits"))
    flags = np.zeros((1 << BITMAP_BITS) // 8, np.uint8)
    for row in pages.toLocalIterator():  # at most 2048 pages of 4 KB
        own = np.frombuffer(bytes(row["bits"]), np.uint8)
        flags[row["page"] * (_PAGE // 8):row["page"] * (_PAGE // 8) + len(own)] = own
    return keys.sparkSession.sparkContext.broadcast(flags)


def _speller(wanted):
    """(key, lang, phrase) of phrases whose hash the bitmap holds; a task gives few of them twice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(SEEN, np.uint64)  # the phrase given last, for each slot
        for batch in batches:
            for s in stretches(batch):
                for size, follows in ((2, s.one), (3, s.two)):
                    place = np.flatnonzero(follows)
                    key = phrase_hash(*s.grams(place, size))
                    slot = (key & np.uint64(SEEN - 1)).astype(np.int64)
                    hit = _listed(wanted.value, key) & (seen[slot] != key)
                    key, first = np.unique(key[hit], return_index=True)
                    if not len(key):
                        continue
                    place = place[hit][first]
                    seen[(key & np.uint64(SEEN - 1)).astype(np.int64)] = key
                    yield pa.RecordBatch.from_pydict({
                        "key": pa.array(key.view(np.int64)),
                        "lang": batch.column(2).take(pa.array(s.base + s.row[place])),
                        "phrase": pa.array(s.spelled(place, size), pa.binary()).cast(pa.string())})
    return run


def scored_phrases(words: DataFrame, grams: DataFrame, least: int, inside_percent: int) -> DataFrame:
    """(key, tongue, a, l, r, score) of the phrases that stay."""
    edges = grams.where("h3 is not null").where(F.col("n") >= least).select(
        _phrase_key("h1", "h2", "h3").alias("key"), "h1", _phrase_key("h1", "h2").alias("p12"),
        _phrase_key("h2", "h3").alias("p23"), "h3", F.col("n").alias("a"))
    nodes = grams.where("leads").where(F.col("flow") >= least).select(
        _phrase_key("h1", "h2").alias("key"), "h1", "h2", F.col("flow").alias("a"))
    # A phrase of two words stands at either end of each phrase of three that holds it.
    longer = edges.select(F.explode(F.array("p12", "p23")).alias("key"), F.col("a").alias("b")) \
        .groupBy("key").agg(F.max("b").alias("b"))
    pairs = nodes.join(longer, "key", "left").where(
        F.col("b").isNull() | (F.col("b") * 100 < F.col("a") * inside_percent))
    cut = lambda k, l, r: F.struct(F.lit(k).alias("k"), F.col(l).alias("left"), F.col(r).alias("right"))
    cuts = pairs.select("key", "a", F.array(cut(1, "h1", "h2")).alias("cuts")).unionByName(
        edges.select("key", "a", F.array(cut(1, "h1", "p23"), cut(2, "p12", "h3")).alias("cuts"))) \
        .select("key", "a", F.inline("cuts"))
    counts = words.where(F.col("n") >= least).select(F.col("word").alias("key"), F.col("n").alias("a"), "tongue").unionByName(
        nodes.select("key", "a", F.lit(None).cast("bigint").alias("tongue")))
    counts = materialize(counts, "counts")
    cuts = cuts.join(counts.select(F.col("key").alias("left"), F.col("a").alias("l"), "tongue"), "left") \
        .join(counts.select(F.col("key").alias("right"), F.col("a").alias("r")), "right")
    big = lambda c: f"cast({c} as decimal(16,0))"
    score = F.expr(f"({SCALE} * ({big('a')} * {big('a')})) div ({big('l')} * {big('r')})")
    return cuts.withColumn("score", score).groupBy("key").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("best"), F.max("tongue").alias("tongue"), F.first("a").alias("a")) \
        .select("key", "tongue", "a", "best.l", "best.r", "best.score")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP,
                 inside_percent: int = INSIDE_PERCENT) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases of two and three words."""
    tongue = F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN))
    source = docs.select(F.col(text).cast("string").alias("t"), F.xxhash64(tongue).alias("h"), tongue.alias("lang"))
    words = word_counts(source.select("t", "h"))
    frequent = shared_bitmap(words.where(F.col("n") >= least), "word")
    grams = gram_counts(source.select("t", "h"), frequent, least)
    scored = scored_phrases(words, grams, least, inside_percent)
    # Ties are told apart by the phrase itself, so all that tie with the last one are spelled.
    order = [F.desc("score"), F.desc("a")]
    best = scored.withColumn("rank", F.rank().over(Window.partitionBy("tongue").orderBy(*order)))
    best = materialize(best.where(F.col("rank") <= top).drop("rank"), "best")
    spelled = source.mapInArrow(_speller(shared_bitmap(best, "key")), "key bigint, lang string, phrase string")
    spelled = spelled.groupBy("key").agg(F.any_value("lang").alias("lang"), F.any_value("phrase").alias("phrase"))
    total = words.groupBy("tongue").agg(F.sum("n").alias("n"))
    ranked = best.join(spelled, "key").withColumn(
        "rank", F.row_number().over(Window.partitionBy("tongue").orderBy(*order, "phrase"))).where(F.col("rank") <= top)
    return ranked.join(total, "tongue").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l",
                                               "r", "n", F.col("score").cast("bigint").alias("score"))
