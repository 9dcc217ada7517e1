"""Language identification of words and texts with a linear-chain conditional random field.

A word's features are its affixes (two and three bytes from either end), its byte trigrams and a lexicon value; the
weights of affixes and trigrams lie in hashed tables, the transitions between languages are learned. Words are labelled
by forward-backward over the whole text, so a switch of language inside a text shows in the words' chances; a text's
language is the one with the most expected words, its score that share.

The lexicon counts the words of every learnable text by language (hashed into a fixed table, added up by Spark). The
weights are fitted by gradient ascent on at most ``MOST_TEXTS`` different learnable texts of at most ``MOST_BYTES``
together, whole ones in the order of a hash; their words are dealt into sequences that switch between texts every
``RUN`` words. Gradients are added up over blocks of texts, so the fit's memory is that of one block and of the
compact feature numbers. Defined cases: null texts and texts
without a letter are ``und`` with score 0; without any learnable text every text is ``und`` with score 0; equal texts
get equal results; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnlens.llm.bytesets import Words, row_chunks, text_buffer
from txnlens.llm.folds import held_out

MOST_TEXTS = 2_000
MOST_BYTES = 8 << 20
BLOCK_BYTES = 1 << 20
RUN = 16
RUNS = 4
TABLE_BITS = 16
LEXICON_BITS = 15
STEPS = 30
RATE = 0.5
UNKNOWN = "und"
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def _bucket(value: np.ndarray, seed: int, bits: int) -> np.ndarray:
    mixed = (value + np.uint64(seed * 7919 + 1)) * _MULTIPLY
    mixed ^= mixed >> np.uint64(29)
    return ((mixed * _MULTIPLY) >> np.uint64(64 - bits)).astype(np.int64)


class WordFeatures:
    """Feature numbers of consecutive words: four affixes each, and the trigrams with their words."""

    def __init__(self, words: Words, order: np.ndarray | None = None):
        """order: of the words, if not that of the text."""
        hashes = words.hashes()
        padded = np.concatenate([words.raw, np.zeros(4, np.uint8)])
        s, e = words.starts, words.ends
        if order is not None:
            s, e, hashes = s[order], e[order], hashes[order]
        length = e - s

        def piece(at: np.ndarray, n: int) -> np.ndarray:
            value = np.zeros(len(at), np.uint64)
            for k in range(n):
                value = value << np.uint64(8) | np.where(k < length, padded[np.clip(at + k, 0, len(padded) - 1)], 0).astype(np.uint64)
            return value
        self.affixes = np.stack([
            _bucket(piece(s, 2), 1, TABLE_BITS), _bucket(piece(s, 3), 2, TABLE_BITS),
            _bucket(piece(np.maximum(e - 2, s), 2), 3, TABLE_BITS), _bucket(piece(np.maximum(e - 3, s), 3), 4, TABLE_BITS)]).astype(np.uint16)
        many = np.maximum(length - 2, 0)
        place = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(s, many)
        value = np.zeros(len(place), np.uint64)
        for k in range(3):
            value = value << np.uint64(8) | padded[place + k].astype(np.uint64)
        self.trigrams = _bucket(value, 5, TABLE_BITS).astype(np.uint16)
        self.edges = np.concatenate([[0], np.cumsum(many)])
        self.lexicon = _bucket(hashes, 6, LEXICON_BITS).astype(np.uint16)
        self.n = len(s)

    def owners(self) -> np.ndarray:
        """The word of each trigram."""
        return np.repeat(np.arange(self.n), np.diff(self.edges))


class Block:
    """Some learnable texts, their words dealt into sequences, with the language number of each word."""

    def __init__(self, texts: list[bytes], languages: list[int], rng: np.random.Generator):
        raw = np.frombuffer(b"".join(texts), np.uint8)
        words = Words(raw, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64), lower=True)
        labels = np.repeat(np.array(languages, np.int32), np.diff(words.rows))
        runs = [np.arange(a, min(a + RUN, z)) for p, z in zip(words.rows[:-1], words.rows[1:]) for a in range(p, z, RUN)]
        runs = [runs[i] for i in rng.permutation(len(runs))]
        order = np.concatenate(runs) if runs else np.empty(0, np.int64)
        self.features, self.labels = WordFeatures(words, order), labels[order]
        starts = np.cumsum([0, *map(len, runs)])[:-1][::RUNS]
        self.rows = np.append(starts, len(order))
        #: Words that have a next one in their sequence.
        inner = np.ones(len(order), bool)
        inner[self.rows[1:] - 1] = False
        self.inner = np.flatnonzero(inner)


class Model:
    """Languages, hashed weights, lexicon values with their weight, and transitions."""

    def __init__(self, names: list[str], lexicon: np.ndarray):
        self.names = names
        k = len(names)
        self.weights = np.zeros((1 << TABLE_BITS, k), np.float32)
        total = lexicon.sum(axis=0) + 1.0
        share = (lexicon + 0.5) / total
        self.lexicon = np.log(share / share.mean(axis=1, keepdims=True)).astype(np.float32) if k else lexicon
        self.lexicon_weight = 0.3
        self.moves = np.zeros((k, k))
        self.first = np.zeros(k)

    def emissions(self, f: WordFeatures) -> np.ndarray:
        out = self.lexicon_weight * self.lexicon[f.lexicon].astype(float)
        for affix in f.affixes:
            out += self.weights[affix]
        if len(f.trigrams):
            sums = np.concatenate([np.zeros((1, out.shape[1])), np.cumsum(self.weights[f.trigrams], axis=0, dtype=float)])
            out += sums[f.edges[1:]] - sums[f.edges[:-1]]
        return out

    def word_chances(self, emissions: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Forward-backward over each row's words; ``rows`` holds the rows' first words and the end."""
        length = np.diff(rows)
        order = np.argsort(-length, kind="stable")
        begin, length = rows[:-1][order], length[order]
        active = np.searchsorted(-length, -np.arange(length[0] if len(length) else 0), side="left")
        local = np.exp(emissions - emissions.max(axis=1, keepdims=True))
        moves = np.exp(self.moves)
        forward = np.empty_like(local)
        for t, n in enumerate(active):
            at = begin[:n] + t
            a = (forward[at - 1] @ moves if t else np.exp(self.first)[None, :]) * local[at]
            forward[at] = a / a.sum(axis=1, keepdims=True)
        back = np.ones_like(local)
        for t in range(len(active) - 2, -1, -1):
            at = begin[:active[t + 1]] + t
            b = (local[at + 1] * back[at + 1]) @ moves.T
            back[at] = b / b.sum(axis=1, keepdims=True)
        both = forward * back
        self.forward, self.back, self.local = forward, back, local
        return both / both.sum(axis=1, keepdims=True)

    def fit(self, blocks: list[Block]) -> None:
        """Gradient ascent on the log-likelihood of the labels, with steps scaled by past gradients."""
        k = len(self.names)
        past = np.full(self.weights.shape, 1e-6)
        past_moves, past_lexicon = np.full((k, k), 1e-6), 1e-6
        for _ in range(STEPS):
            slope, turn, pull = -0.1 * self.weights.astype(float), -0.1 * self.moves, 0.0
            for block in blocks:
                pull += self._add_slopes(block, slope, turn)
            past += slope**2
            past_moves += turn**2
            past_lexicon += pull**2
            self.weights += (RATE * slope / np.sqrt(past)).astype(np.float32)
            self.moves += RATE * turn / np.sqrt(past_moves)
            self.lexicon_weight += 0.1 * pull / np.sqrt(past_lexicon)

    def _add_slopes(self, block: Block, slope: np.ndarray, turn: np.ndarray) -> float:
        """Add a block's part of the gradients of weights and transitions; returns that of the lexicon's weight."""
        k, f, inner = len(self.names), block.features, block.inner
        gap = np.eye(k)[block.labels] - self.word_chances(self.emissions(f), block.rows)
        owner = f.owners()
        for c in range(k):
            for affix in f.affixes:
                slope[:, c] += np.bincount(affix, gap[:, c], len(slope))
            slope[:, c] += np.bincount(f.trigrams, gap[owner, c], len(slope))
        joint = self.forward[inner][:, :, None] * np.exp(self.moves)[None] * \
            (self.local[inner + 1] * self.back[inner + 1])[:, None, :]
        seen = np.bincount(block.labels[inner].astype(np.int64) * k + block.labels[inner + 1], minlength=k * k)
        turn += seen.reshape(k, k) - (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        return float((gap * self.lexicon[f.lexicon]).sum())

    def label(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray]:
        """Words of some texts and the chance of each language for each word."""
        words = Words(raw, offsets, lower=True)
        if not len(words.starts):
            return words, np.empty((0, len(self.names)))
        return words, self.word_chances(self.emissions(WordFeatures(words)), words.rows)


_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True


def has_letter(raw: np.ndarray) -> bool:
    return bool(_ASCII_LETTER[raw].any()) or any(c.isalpha() for c in raw.tobytes().decode())


def sample_texts(known: DataFrame, most: int, most_bytes: int) -> list[tuple[str, bytes]]:
    """Different texts with their languages, as columns ``l`` and ``t``, up to either bound.

    Languages take turns, each in the order of a hash, so a rare one has its examples. Texts longer than a language's
    equal share of the bytes are passed over until the others are taken. Hashes and lengths are ranked first; only then are texts read, so no task and no driver meets more than the bounds.
    """
    keyed = known.withColumn("h", F.xxhash64("t", "l"))
    sizes = keyed.select("l", "h", F.octet_length("t").alias("n")).distinct()
    share = most_bytes // max(1, known.select("l").distinct().count())
    turn = Window.partitionBy("l").orderBy(F.col("n") > share, "h")
    ranked = sizes.withColumn("turn", F.row_number().over(turn)).where(F.col("turn") <= most) \
        .orderBy(F.col("n") > share, "turn", "h").limit(most).collect()
    if not ranked:
        return []
    used = np.cumsum([r["n"] for r in ranked])
    taken = ranked[:max(1, int(np.searchsorted(used, most_bytes, side="right")))]
    place = {r["h"]: i for i, r in enumerate(taken)}
    wanted = known.sparkSession.createDataFrame([(h,) for h in place], "h bigint")  # at most ``most`` rows
    rows = keyed.join(F.broadcast(wanted), "h").dropDuplicates(["h"]).select("h", "l", "t").collect()
    return [(r["l"], r["t"].encode()) for r in sorted(rows, key=lambda r: place[r["h"]])]


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", most: int = MOST_TEXTS,
        most_bytes: int = MOST_BYTES) -> Model:
    """Learns from texts outside the held-out fold whose language is known."""
    known = docs.where(~held_out(key) & F.col(text).isNotNull() & F.col(lang).isNotNull()) \
        .select(F.col(lang).alias("l"), F.col(text).cast("string").alias("t"))
    names = sorted(r["l"] for r in known.select("l").distinct().collect())  # one row a language
    number = {name: i for i, name in enumerate(names)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((1 << LEXICON_BITS) * len(names), np.int64)
        for batch in batches:
            raw, offsets = text_buffer(batch.column(1))
            own = np.array([number[x] for x in batch.column(0).to_pylist()], np.int64)
            for first, last in row_chunks(offsets):
                words = Words(raw[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first], lower=True)
                labels = np.repeat(own[first:last], np.diff(words.rows))
                total += np.bincount(_bucket(words.hashes(), 6, LEXICON_BITS) * len(names) + labels, minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"slot": pa.array(some), "n": pa.array(total[some])})
    lexicon = np.zeros((1 << LEXICON_BITS, len(names)))
    if names:
        sums = known.mapInArrow(count, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
        lexicon.ravel()[sums["slot"].to_numpy(np.int64)] = sums["n"].to_numpy(float)  # a table of fixed size
    model = Model(names, lexicon)
    if len(names) < 2:
        return model
    sample = sample_texts(known, most, most_bytes)
    rng = np.random.default_rng(5)
    place = np.cumsum([0, *(len(t) for _, t in sample)])[:-1] // BLOCK_BYTES
    blocks = []
    for p in np.unique(place):
        part = [sample[i] for i in np.flatnonzero(place == p)]
        blocks.append(Block([t for _, t in part], [number[x] for x, _ in part], rng))
    blocks = [b for b in blocks if len(b.labels)]
    if blocks:
        model.fit(blocks)
    return model


def identify(docs: DataFrame, model: Model, *keys: str, text: str = "text") -> DataFrame:
    """Keys, ``lang_pred``, ``score`` and ``shares`` (expected share of the words by language) of each row."""
    names = model.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_buffer(batch.column(len(keys)))
            guess: list[str] = []
            value: list[float] = []
            shares: list[list[float]] = []
            for first, last in row_chunks(offsets, 2 << 20):
                edge = offsets[first:last + 1] - offsets[first]
                part = raw[offsets[first]:offsets[last]]
                words, chances = model.label(part, edge) if names else (None, None)
                for i in range(last - first):
                    if words is None or not has_letter(part[edge[i]:edge[i + 1]]):
                        guess.append(UNKNOWN)
                        value.append(0.0)
                        shares.append([])
                        continue
                    mean = chances[words.rows[i]:words.rows[i + 1]].mean(axis=0)
                    guess.append(names[int(np.argmax(mean))])
                    value.append(float(min(1.0, mean.max())))
                    shares.append(mean.tolist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(guess, pa.string()), pa.array(value, pa.float64()),
                 pa.array(shares, pa.list_(pa.float64()))], [*keys, "lang_pred", "score", "shares"])
    source = docs.select(*keys, F.col(text).cast("string").alias("_text"))
    kinds = ", ".join(f"`{k}` {source.schema[k].dataType.simpleString()}" for k in keys)
    return source.mapInArrow(run, f"{kinds}, lang_pred string, score double, shares array<double>")
