"""Benchmark decontamination by latent semantic retrieval.

1. Every word of every document is replaced by its number among the benchmark's words and stored; the benchmark is
   taken in blocks of ``BLOCK_ITEMS`` items, so its words stay a table of bounded size.
2. Passages of two neighbouring blocks of ``STEP`` words are TF-IDF rows over those words (document frequencies from all
   passages). A randomised SVD of all rows A is computed where they are: a first pass takes A'A times random columns, a
   few more than the rank, and its orthonormal basis Q; a second one sums (AQ)'AQ, whose small decomposition gives the
   singular values and turns Q to the right singular vectors. Each task adds up its share, shares are summed in two
   levels, and only terms x rank numbers reach the driver. The rarest words of every item have weight however often
   they stand, so an item that leaked often, or a small table, has its cosine.
3. Every passage is compared with every item in the latent space. Those of ``LEAST_COSINE`` or more whose own words hold
   ``LEAST_WEIGHT`` of the item's TF-IDF weight are candidates: items with clauses in another order, or with about half of
   their words replaced.
4. Literal and lightly edited items need no luck in the latent space: a passage is a candidate too if enough of the item's
   words stand around it for ``LEAST_COMMON`` (first counted over the item's rarest words only, then over all). A passage
   of that share always meets this bound. No candidate is capped.
5. A candidate is confirmed by the longest common subsequence of words with the item and with the item's answer (its
   last sentence): ``LEAST_COMMON`` for those of the bound, ``LEAST_PARAPHRASE`` for those of the cosine, whose words
   already agree by weight. Cosines choose among rows with the same common words.

Defined cases: null and empty texts leak nothing; null or empty items are never leaked; equal rows get equal results,
rows with a null key are reported under the null key; an empty benchmark or corpus gives an empty result; other
columns are not read. Words are lower-cased (A-Z) and stripped of ASCII punctuation.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlens.llm.bytesets import Words, row_chunks, text_buffer
from txnlens.session import materialize

BLOCK_ITEMS = 1_000
STEP = 32
RANK = 96
#: Terms in more than this share of the blocks carry no weight, but for the rarest terms of each item.
MOST_SHARE = 0.005
LEAST_COMMON = 0.6
#: How many of an item's rarest words have to stand around a passage before all of them are counted.
PROBES = 3
#: Columns of the random start beyond the rank.
OVERSAMPLE = 16
#: What a passage needs to be a candidate by meaning, and the share of the item that then has to stand there in order.
LEAST_COSINE = 0.4
LEAST_WEIGHT = 0.4
LEAST_PARAPHRASE = 0.35
LEAST_ANSWER = 0.5
#: Terms whose sums travel together.
TERM_RANGE = 256

_LEAKS = "d bigint, item_id bigint, cosine double, common double, answer double, first_word bigint, end_word bigint, h bigint"

_CLEAN = np.arange(256, dtype=np.uint8)
_CLEAN[ord("A"):ord("Z") + 1] += 32
_CLEAN[[c for c in range(33, 127) if not chr(c).isalnum()]] = 0x20


def clean_words(raw: np.ndarray, offsets: np.ndarray) -> Words:
    return Words(_CLEAN[raw], offsets)


class Items:
    """A block of benchmark items: their words as numbers into a sorted table of word hashes."""

    def __init__(self, rows: list[tuple]):
        rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        texts = [t.encode() for _, t in rows]
        raw = np.frombuffer(b"".join(texts), np.uint8)
        words = clean_words(raw, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64))
        hashes = words.hashes()
        self.terms = np.unique(hashes)
        number = np.searchsorted(self.terms, hashes)
        self.ids = [r[0] for r in rows]
        self.words = [number[a:b] for a, b in zip(words.rows[:-1], words.rows[1:])]
        self.answers = []
        for text, own in zip(texts, self.words):
            part = [p for p in text.decode().replace("\n", ". ").split(". ") if any(c.isalnum() for c in p)]
            tail = part[-1].encode() if part else b""
            n = len(clean_words(np.frombuffer(tail, np.uint8), np.array([0, len(tail)])).starts) if tail else 0
            self.answers.append(own[len(own) - n:])
        self.masks = [_masks(w) for w in self.words]
        self.answer_masks = [_masks(w) for w in self.answers]


class Bound:
    """Which items may share ``LEAST_COMMON`` of their words with the text around a row: exact, nothing is missed.

    A common subsequence of ``need`` words leaves out n - need of the item's n words. So of its n - need + p rarest words
    at least p stand around the row.
    """

    def __init__(self, items: Items, seen: np.ndarray):
        n_terms, length = len(items.terms), np.array([len(w) for w in items.words])
        self.length = length
        self.need = np.array([next(k for k in range(1, n + 1) if k / n >= LEAST_COMMON) for n in length.tolist()])
        self.reach = -(-length // STEP)  # blocks before a row and after its second block
        self.padded = np.full((len(length), length.max()), n_terms)
        probes = np.minimum(length, length - self.need + PROBES)
        self.least = probes - (length - self.need)
        most = int(length.max()) * STEP * 2 * (int(self.reach.max()) + 1)
        self.order = np.argsort(self.reach, kind="stable")  # columns of one reach stand together
        self.times = np.zeros((n_terms, len(length)), np.uint16 if most < 1 << 16 else np.int64)
        for column, i in enumerate(self.order):
            w = items.words[i]
            self.padded[i, :len(w)] = w
            np.add.at(self.times, (w[np.argsort(seen[w], kind="stable")[:probes[i]]], column), 1)
        self.probe = self.times.any(axis=1)
        self.slab = max(256, 1_000_000 // max(n_terms, len(length)))  # rows that are looked at together

    def pairs(self, blocks: Blocks) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows and items that meet the bound, by ranges of rows."""
        n_terms, widest = len(self.times), int(self.reach.max())
        edge = np.searchsorted(blocks.block, np.arange(blocks.n + 1))
        for low in range(0, blocks.n, self.slab):
            rows = min(self.slab, blocks.n - low)
            begin, end = max(0, low - widest), min(blocks.n, low + rows + 1 + widest)
            block = blocks.block[edge[begin]:edge[end]] - low + widest
            term = blocks.term[edge[begin]:edge[end]]
            some = self.probe[term]
            if not some.any():
                continue
            count = np.zeros((rows + 1 + 2 * widest, len(self.length)), self.times.dtype)
            at = block[some]
            cut = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            count[at[cut]] = np.add.reduceat(self.times[term[some]], cut, axis=0)
            near, items = [], []
            for r in np.unique(self.reach):
                a, b = np.searchsorted(self.reach[self.order], [r, r + 1])
                own = self.order[a:b]
                around = count[widest - r:widest - r + rows, a:b].copy()
                for k in range(1 - r, r + 2):
                    around += count[widest + k:widest + k + rows, a:b]
                x, y = np.divmod(np.flatnonzero(around >= self.least[own].astype(around.dtype)), len(own))
                near.append(x)
                items.append(own[y])
            near, items = np.concatenate(near), np.concatenate(items)
            present = np.zeros((len(count), n_terms + 1), bool)
            present[block, term] = True
            for start in range(0, len(near), 1 << 14):
                x, y = near[start:start + (1 << 14)], items[start:start + (1 << 14)]
                held = np.zeros((len(x), self.padded.shape[1]), bool)
                for k in range(-widest, widest + 2):
                    use = np.flatnonzero((k >= -self.reach[y]) & (k <= self.reach[y] + 1))
                    held[use] |= present[x[use, None] + widest + k, self.padded[y[use]]]
                good = held.sum(axis=1) >= self.need[y]
                yield x[good] + low, y[good]


def _masks(words: np.ndarray) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, w in enumerate(words.tolist()):
        out[w] = out.get(w, 0) | 1 << i
    return out


def common_length(masks: dict[int, int], n: int, words: list[int]) -> int:
    """Length of the longest common subsequence of n masked words with ``words`` (bits stand for the n words)."""
    every = (1 << n) - 1
    row = every
    for w in words:
        hit = row & masks.get(w, 0)
        row = ((row + hit) | (row - hit)) & every
    return n - row.bit_count()


def numbered(docs: DataFrame, terms: np.ndarray, key: str, text: str) -> DataFrame:
    """(d, w, h): key, the whole text as term numbers (int32, -1 for a word that the benchmark lacks), hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_buffer(batch.column(1))
            for first, last in row_chunks(offsets):
                words = clean_words(raw[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
                hashes = words.hashes()
                at = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
                number = np.where(terms[at] == hashes, at, -1).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first),
                     pa.array([number[a:b].tobytes() for a, b in zip(words.rows[:-1], words.rows[1:])], pa.binary()),
                     batch.column(2).slice(first, last - first)],
                    ["d", "w", "h"])
    t = F.col(text).cast("string")
    source = docs.select(F.col(key).cast("bigint").alias("d"), t.alias("t"), F.xxhash64(t).alias("h"))
    return source.mapInArrow(run, "d bigint, w binary, h bigint")


class Blocks:
    """The blocks of STEP words of some texts, as (block, term) entries without the words the benchmark lacks."""

    def __init__(self, texts: list[np.ndarray]):
        sizes = np.array([len(t) for t in texts], np.int64)
        count = -(-sizes // STEP)
        self.first = np.concatenate([[0], np.cumsum(count)])  # first block of each text
        begin = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        flat = np.concatenate(texts).astype(np.int64) if texts else np.empty(0, np.int64)
        place = np.arange(len(flat)) - np.repeat(begin, sizes)
        block = np.repeat(self.first[:-1], sizes) + place // STEP
        self.n = int(self.first[-1])
        known = flat >= 0
        self.block, self.term = block[known], flat[known]

    def distinct_terms(self, n_terms: int) -> np.ndarray:
        """How many blocks hold each term."""
        both = np.unique(self.block * n_terms + self.term)
        return np.bincount(both % n_terms, minlength=n_terms)

    def passages(self, weight: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of two neighbouring blocks (the second one missing at a text's end) times ``basis``, with unit TF-IDF
        length, and the scale and the next block's place of each row."""
        use = weight[self.term] > 0
        block, term = self.block[use], self.term[use]
        self.used_block, self.used_term = block, term
        value = (weight[term][:, None] * basis[term]).astype(np.float32)
        out = np.zeros((self.n + 1, basis.shape[1]), np.float32)
        if len(block):
            begin = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
            out[block[begin]] = np.add.reduceat(value, begin, axis=0)
        follow = np.arange(1, self.n + 1)
        follow[self.first[1:][np.diff(self.first) > 0] - 1] = self.n  # a text's last block has no next one
        rows = out[:-1] + out[follow]
        n_terms = len(weight)
        pair = np.concatenate([block * n_terms + term, _previous(block, self.first, self.n) * n_terms + term])
        pair = pair[pair >= 0]
        keys, tf = np.unique(pair, return_counts=True)
        norm = np.bincount(keys // n_terms, (tf * weight[keys % n_terms])**2, minlength=self.n)[:self.n]
        scale = np.where(norm > 0, 1 / np.sqrt(np.maximum(norm, 1e-30)), 0)
        return rows * scale[:, None].astype(np.float32), scale, follow


def _previous(block: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """The row before each entry's block that also holds it; negative where the block begins its text."""
    begins = np.zeros(n + 1, bool)
    begins[first[:-1][np.diff(first) > 0]] = True
    return np.where(begins[block], -1, block - 1)


def _texts(batch: pa.RecordBatch, limit: int = 2 << 20) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Row ranges of stored texts of about ``limit`` bytes."""
    rows: list[np.ndarray] = []
    held = start = 0
    for i, value in enumerate(batch.column(1)):
        words = np.frombuffer(value.as_py() or b"", np.int32)
        rows.append(words)
        held += words.nbytes
        if held > limit:
            yield start, rows
            start, rows, held = i + 1, [], 0
    if rows:
        yield start, rows


def term_blocks(stored: DataFrame, n_terms: int) -> tuple[np.ndarray, int]:
    """Blocks that hold each term, and all blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms + 1, np.int64)
        for batch in batches:
            for _, texts in _texts(batch):
                blocks = Blocks(texts)
                total[:-1] += blocks.distinct_terms(n_terms)
                total[-1] += blocks.n
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": pa.array(some), "n": pa.array(total[some])})
    got = stored.mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(n_terms + 1, np.int64)
    total[got["term"].to_numpy(np.int64)] = got["n"].to_numpy(np.int64)  # as many rows as terms
    return total[:-1], int(total[-1])


def gram_times(stored: DataFrame, weight: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """A'A times ``basis`` for the TF-IDF rows A of all passages."""
    width, n_terms = basis.shape[1], len(weight)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n_terms, width))
        for batch in batches:
            for _, texts in _texts(batch):
                blocks = Blocks(texts)
                rows, scale, _ = blocks.passages(weight, basis)
                back = rows * scale[:, None].astype(np.float32)
                before = _previous(blocks.used_block, blocks.first, blocks.n)
                part = back[blocks.used_block]
                inner = np.flatnonzero(before >= 0)
                part[inner] += back[before[inner]]
                order = np.argsort(blocks.used_term, kind="stable")
                term = blocks.used_term[order]
                begin = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(term) else order
                if len(term):
                    total[term[begin]] += np.add.reduceat(part[order], begin, axis=0)
        total *= weight[:, None]
        import pyspark
        task = pyspark.TaskContext.get().partitionId()
        for start in range(0, n_terms, TERM_RANGE):
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([start // TERM_RANGE], pa.int64()), "salt": pa.array([task], pa.int64()),
                "sums": pa.array([total[start:start + TERM_RANGE].astype(np.float32).tobytes()], pa.binary())})

    return _summed(stored, run, np.float32).reshape(n_terms, width).astype(float)


def _summed(stored: DataFrame, run, dtype: type) -> np.ndarray:
    """The sums of what ``run`` yields for each task as (part, salt, sums), in two levels, parts in order."""
    def add(rows: pd.DataFrame) -> pd.DataFrame:
        out = np.zeros(len(rows["sums"].iloc[0]) // np.dtype(dtype).itemsize)
        for s in rows["sums"]:
            out += np.frombuffer(s, dtype)
        return pd.DataFrame({"part": [rows["part"].iloc[0]], "salt": [0], "sums": [out.astype(dtype).tobytes()]})
    kind = "part bigint, salt bigint, sums binary"
    shares = stored.mapInArrow(run, kind)
    levels = max(1, int(stored.rdd.getNumPartitions()**0.5))
    shares = shares.withColumn("salt", F.col("salt") % levels).groupBy("part", "salt").applyInPandas(add, kind)
    got = shares.groupBy("part").applyInPandas(add, kind).toPandas().sort_values("part")
    return np.concatenate([np.frombuffer(s, dtype) for s in got["sums"]]) if len(got) else np.zeros(0, dtype)


def row_gram(stored: DataFrame, weight: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """(AQ)'AQ for the TF-IDF rows A of all passages and a basis Q."""
    width = basis.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for _, texts in _texts(batch):
                rows, scale, _ = Blocks(texts).passages(weight, basis)
                rows = rows[scale > 0].astype(float)
                total += rows.T @ rows
        import pyspark
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([0], pa.int64()), "salt": pa.array([pyspark.TaskContext.get().partitionId()], pa.int64()),
            "sums": pa.array([total.tobytes()], pa.binary())})
    got = _summed(stored, run, np.float64)
    return (got if len(got) else np.zeros(width * width)).reshape(width, width)


def latent_basis(stored: DataFrame, weight: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """(terms x rank right singular vectors, singular values) of all passages by a randomised SVD.

    A'A times ``rank + OVERSAMPLE`` random columns spans nearly the leading space (that is a power pass); within it the
    decomposition is that of the small matrix (AQ)'AQ. Directions that no passage has are left out.
    """
    width = min(len(weight), rank + OVERSAMPLE)
    start = np.random.default_rng(11).standard_normal((len(weight), width)).astype(np.float32)
    q = np.linalg.qr(gram_times(stored, weight, start))[0].astype(np.float32)
    square, turn = np.linalg.eigh(row_gram(stored, weight, q))
    square, turn = square[::-1][:rank], turn[:, ::-1][:, :rank]
    held = square > 1e-10 * max(float(square[0]), 1e-300)
    held[0] = True
    return (q @ turn[:, held]).astype(np.float32), np.sqrt(np.maximum(square[held], 0))


class Nearby:
    """Items near a passage in the latent space whose TF-IDF weight it holds in good part."""

    def __init__(self, items: Items, weight: np.ndarray, basis: np.ndarray, slab: int):
        own = Blocks(items.words)
        rows = own.passages(weight, basis)[0]
        whole = np.ones(own.n, bool)  # a long item's last block alone is a part of the row before it
        whole[own.first[1:][np.diff(own.first) > 1] - 1] = False
        self.vectors = _unit(rows[whole]).T
        self.item = (np.searchsorted(own.first, np.arange(own.n), side="right") - 1)[whole]
        words = [np.unique(w) for w in items.words]
        self.n_terms, self.slab = len(weight), slab
        self.padded = np.full((len(words), max(len(w) for w in words)), self.n_terms)
        for i, w in enumerate(words):
            self.padded[i, :len(w)] = w
        self.weight = np.append(weight, 0.0)
        self.total = np.maximum(self.weight[self.padded].sum(axis=1), 1e-12)

    def pairs(self, blocks: Blocks, unit: np.ndarray, live: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows and items, by ranges of rows. ``unit``: latent rows of ``blocks``; ``live``: rows that have weight."""
        edge = np.searchsorted(blocks.used_block, np.arange(blocks.n + 2))
        place = np.full(blocks.n + 1, -1)
        for start in range(0, len(live), self.slab):
            x = live[start:start + self.slab]
            near, column = np.nonzero(unit[x] @ self.vectors >= LEAST_COSINE)
            if not len(near):
                continue
            pair = np.unique(near * len(self.padded) + self.item[column])
            near, item = np.divmod(pair, len(self.padded))
            place[x] = np.arange(len(x))
            low, high = edge[x[0]], edge[min(x[-1] + 2, blocks.n + 1)]
            block, term = blocks.used_block[low:high], blocks.used_term[low:high]
            present = np.zeros((len(x), self.n_terms + 1), bool)
            for at in (block, _previous(block, blocks.first, blocks.n)):
                use = np.flatnonzero((at >= 0) & (place[at] >= 0))
                present[place[at[use]], term[use]] = True
            place[x] = -1
            for k in range(0, len(near), 1 << 14):
                i, j = near[k:k + (1 << 14)], item[k:k + (1 << 14)]
                words = self.padded[j]
                share = (present[i[:, None], words] * self.weight[words]).sum(axis=1) / self.total[j]
                good = share >= LEAST_WEIGHT
                yield x[i[good]], j[good]


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def leaks_of(stored: DataFrame, items: Items, rank: int = RANK) -> DataFrame:
    """(d, item_id, cosine, common, answer, first_word, end_word, h): every confirmed passage's best row for an item."""
    n_terms = len(items.terms)
    seen, blocks = term_blocks(stored, n_terms)
    bound = Bound(items, seen)
    common_term = (seen > max(1, MOST_SHARE * blocks)) & ~bound.probe
    weight = np.where(common_term, 0, np.log((blocks + 1) / (seen + 1)) + 1)
    basis, _ = latent_basis(stored, weight, rank)
    own = Blocks(items.words)
    latent = _unit(own.passages(weight, basis)[0])
    nearby = Nearby(items, weight, basis, bound.slab)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, hashes = batch.column(0), batch.column(2)
            for start, texts in _texts(batch):
                out: dict[tuple[int, int], tuple] = {}
                part = Blocks(texts)
                rows_of, scale, _ = part.passages(weight, basis)
                unit = _unit(rows_of)

                def confirm(rows: np.ndarray, near: np.ndarray, least: float, known: set) -> None:
                    text_of = np.searchsorted(part.first, rows, side="right") - 1
                    for row, item, text in zip(rows.tolist(), near.tolist(), text_of.tolist()):
                        if (text, item) in known:
                            continue
                        n, m = len(items.words[item]), len(items.answers[item])
                        place = row - int(part.first[text])
                        a, b = max(0, place * STEP - n), min(len(texts[text]), (place + 2) * STEP + n)
                        around = texts[text][a:b].tolist()
                        common = common_length(items.masks[item], n, around) / n
                        if common < least:
                            continue
                        answer = common_length(items.answer_masks[item], m, around) / m if m else 1.0
                        if answer >= LEAST_ANSWER:
                            cosine = float((latent[own.first[item]:own.first[item + 1]] @ unit[row]).max())
                            if (text, item) not in out or (common, cosine) > out[text, item][:2]:
                                out[text, item] = (common, cosine, answer, a, b)
                for rows, near in bound.pairs(part):
                    confirm(rows, near, LEAST_COMMON, set())
                known = set(out)
                for rows, near in nearby.pairs(part, unit, np.flatnonzero(scale > 0)):
                    confirm(rows, near, LEAST_PARAPHRASE, known)
                found = sorted(out.items())
                yield pa.RecordBatch.from_pydict({
                    "d": pa.array([keys[start + t].as_py() for (t, _), _ in found], pa.int64()),
                    "item_id": pa.array([items.ids[i] for (_, i), _ in found], pa.int64()),
                    "cosine": pa.array([v[1] for _, v in found], pa.float64()),
                    "common": pa.array([v[0] for _, v in found], pa.float64()),
                    "answer": pa.array([v[2] for _, v in found], pa.float64()),
                    "first_word": pa.array([v[3] for _, v in found], pa.int64()),
                    "end_word": pa.array([v[4] for _, v in found], pa.int64()),
                    "h": pa.array([hashes[start + t].as_py() for (t, _), _ in found], pa.int64())})
    return stored.mapInArrow(run, _LEAKS)


def find_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
               item_key: str = "item_id", item_text: str = "text", rank: int = RANK) -> DataFrame:
    """One row for each document and item that it holds: key, item, cosine, shares found, and where."""
    found = _all_leaks(docs, benchmark, key, text, item_key, item_text, rank)
    return found.select(F.col("d").alias(key), "item_id", "cosine", "common", "answer", "first_word", "end_word")


def _all_leaks(docs: DataFrame, benchmark: DataFrame, key: str, text: str, item_key: str = "item_id",
               item_text: str = "text", rank: int = RANK) -> DataFrame:
    items = benchmark.select(F.col(item_key).cast("bigint").alias("i"), F.col(item_text).cast("string").alias("t")) \
        .where(F.col("t").rlike("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]"))
    many = -(-items.count() // BLOCK_ITEMS)
    found: DataFrame | None = None
    for k in range(many):
        block = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(many)) == k).distinct()
        rows = [(r["i"], r["t"]) for r in block.collect()]  # about BLOCK_ITEMS items
        if not rows:
            continue
        held = Items(rows)
        got = leaks_of(materialize(numbered(docs, held.terms, key, text), "words"), held, rank)
        found = got if found is None else found.unionByName(got)
    if found is None:
        spark = docs.sparkSession
        found = spark.createDataFrame([], _LEAKS)
    return found


def drop_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text holds no item; other texts under the same key stay."""
    leaked = _all_leaks(docs, benchmark, key, text).select(F.col("d").alias("k"), "h")
    leaked = materialize(leaked.distinct(), "leaks")
    rows = docs.select(F.col(f"`{key}`").alias("own"), F.xxhash64(F.col(f"`{text}`").cast("string")).alias("own_h"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.join(leaked, F.col("own").eqNullSafe(F.col("k")) & (F.col("own_h") == F.col("h")), "left_anti").select("row.*")
