"""Mixing documents to target token weights by soft domain membership.

A classifier learned from the table of labels gives every document its chances of belonging to each domain (here: each
pair of quality and toxicity that the labels hold). Projected-gradient least squares then finds a rate of repetition for
every document, 0 or more, whose expected tokens by domain meet the targets as well as they can, and that stays near 1. The
gradient of a rate is a product of the document's chances with one pull for each domain, so all rates follow from the pulls,
and a step needs one distributed sum: tokens, and the curvature by pairs of domains by whose inverse the step is scaled. Only
numbers by domain pass through the driver, and a lost executor costs nothing.

The fit ends at the optimum. ``balance`` tells for every domain the target, what was reached and the difference, and
``targets_met`` whether all targets are met: documents whose chances can't carry them leave a difference.

The classifier is a softmax over text features and word evidence, both learned from at most ``MOST_ROWS`` different
labelled documents (a documented bound; keys and documents are taken in the order of a hash), which may come from another
table than the documents that are mixed. Tokens are words of the text. Defined cases: null and
empty texts have no tokens and rate 1; without labelled rows there is one domain and all rates meet its total alike;
domains without any expected token are left out of the fit; equal rows get equal rates; a document with several labels
counts with the smallest pair; extra columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlens.llm import quality_model
from txnlens.llm.bytesets import row_words, text_buffer
from txnlens.session import materialize

MOST_ROWS = 20_000
TABLE_BITS = 15
#: Largest difference from a target, as a share of all tokens, that counts as met.
MET = 1e-3
#: Weight of the rates' distance from 1: of all rates that meet the targets, the nearest are taken.
RIDGE = 1e-5
#: The fit ends when misses and pulls differ by this share of all tokens at most.
TOLERANCE = 1e-9
#: Step lengths that are tried together.
LENGTHS = (1.0, 0.5, 0.2, 0.05, 0.01, 0.001)
#: Share of all tokens by domain (quality/toxic); other domains share what is left.
TARGETS = {"1/0": 0.85, "1/1": 0.03, "0/0": 0.10, "0/1": 0.02}


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


class Domains:
    """Names, word evidence and softmax weights of the domains."""

    def __init__(self, names: list[str], counts: np.ndarray):
        self.names = names
        share = (counts + 0.5) / (counts.sum(axis=0, keepdims=True) + 0.5 * len(counts))
        self.evidence = np.log(share / share.mean(axis=1, keepdims=True))
        self.weights = np.zeros((1, len(names)))
        self.center = self.spread = np.zeros(0)

    def inputs(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words and features of each text: text features, and for each domain mean and strongest evidence."""
        plain = quality_model.features(raw, offsets)
        k = len(self.names)
        heard = np.zeros((len(plain), 2 * k))
        count = np.zeros(len(plain), np.int64)
        for first, last, words in row_words(raw, offsets, lower=True):
            n = np.diff(words.rows)
            count[first:last] = n
            some = np.flatnonzero(n)
            if not len(some):
                continue
            found = self.evidence[_slot(words.hashes())]
            begin = words.rows[:-1][some]
            heard[first + some, :k] = np.add.reduceat(found, begin, axis=0) / n[some][:, None]
            heard[first + some, k:] = np.maximum.reduceat(found, begin, axis=0)
        return count, np.concatenate([plain, heard], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> None:
        """Softmax regression by Newton-like steps on standardised features."""
        self.center, self.spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
        z = np.concatenate([(x - self.center) / self.spread, np.ones((len(x), 1))], axis=1)
        want = np.eye(len(self.names))[y]
        self.weights = np.zeros((z.shape[1], len(self.names)))
        curve = np.linalg.inv(z.T @ z / 4 + np.eye(z.shape[1]))
        for _ in range(300):
            self.weights += curve @ (z.T @ (want - self._chances(z)) - 0.5 * self.weights)

    def _chances(self, z: np.ndarray) -> np.ndarray:
        s = z @ self.weights
        e = np.exp(s - s.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def chances(self, x: np.ndarray) -> np.ndarray:
        if not len(self.center):
            return np.full((len(x), len(self.names)), 1 / len(self.names))
        return self._chances(np.concatenate([(x - self.center) / self.spread, np.ones((len(x), 1))], axis=1))


def learn_domains(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                  parts: tuple[str, ...] = ("quality", "toxic"), most: int = MOST_ROWS) -> Domains:
    name = F.concat_ws("/", *[F.col(p).cast("string") for p in parts])
    whole = labels.where(F.col(key).isNotNull())
    for p in parts:
        whole = whole.where(F.col(p).isNotNull())
    known = whole.groupBy(F.col(key).alias("_k")).agg(F.min(name).alias("domain"))
    names = sorted(r["domain"] for r in known.select("domain").distinct().collect()) or ["all"]
    sample = known.orderBy(F.xxhash64("_k"), "_k").limit(most)  # at most ``most`` keys, so it may be broadcast
    rows = materialize(quality_model.labelled_texts(docs, sample, "domain", key, text, most), "labelled")
    number = {n: i for i, n in enumerate(names)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((1 << TABLE_BITS) * len(names), np.int64)
        for batch in batches:
            raw, offsets = text_buffer(batch.column(1))
            own = np.array([number[x] for x in batch.column(0).to_pylist()], np.int64)
            for first, last, words in row_words(raw, offsets, lower=True):
                labels_of = np.repeat(own[first:last], np.diff(words.rows))
                total += np.bincount(_slot(words.hashes()) * len(names) + labels_of, minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"slot": pa.array(some), "n": pa.array(total[some])})
    counts = np.zeros((1 << TABLE_BITS, len(names)))
    sums = rows.mapInArrow(count, "slot bigint, n bigint").groupBy("slot") \
        .agg(F.sum("n").alias("n")).toPandas()  # a table of fixed size
    counts.ravel()[sums["slot"].to_numpy(np.int64)] = sums["n"].to_numpy(float)
    model = Domains(names, counts)

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = model.inputs(*text_buffer(batch.column(1)))[1]
            yield pa.RecordBatch.from_pydict({"domain": batch.column(0), "x": pa.array(list(x), pa.list_(pa.float64()))})
    got = rows.mapInArrow(take, "domain string, x array<double>").toPandas()
    got = got.sort_values(["domain", "x"], key=lambda c: c.map(lambda v: v if isinstance(v, str) else tuple(v)))
    if len(got) and len(names) > 1:
        model.fit(np.array(got["x"].tolist(), float), np.array([number[d] for d in got["domain"]]))
    return model


def memberships(docs: DataFrame, model: Domains, *keys: str, text: str = "text") -> DataFrame:
    """Keys, ``n_tokens`` and ``chances`` (by domain) of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count, x = model.inputs(*text_buffer(batch.column(len(keys))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(count), pa.array(list(model.chances(x)), pa.list_(pa.float64()))],
                [*keys, "n_tokens", "chances"])
    source = docs.select(*keys, F.col(text).cast("string").alias("_text"))
    kinds = ", ".join(f"`{k}` {source.schema[k].dataType.simpleString()}" for k in keys)
    return source.mapInArrow(run, f"{kinds}, n_tokens bigint, chances array<double>")


def _along(vector: Column) -> Column:
    """The product of a document's chances with one number for each domain."""
    return F.aggregate(F.zip_with("chances", vector, lambda p, v: p * v), F.lit(0.0), lambda s, v: s + v)


def rate_of(pull: Column) -> Column:
    """A document's rate under the domains' pulls: from 1 against the slope they make, and projected to 0 or above."""
    return F.greatest(F.lit(0.0), 1.0 - _along(pull))


def _numbers(value) -> Column:
    # one literal, so that the plan is the same for every step
    kind = "array<double>" if not value or isinstance(value[0], float) else "array<array<double>>"
    return F.from_json(F.lit(json.dumps(value)), kind)


def wanted_tokens(names: list[str], everything: float, targets: dict[str, float]) -> list[float]:
    """Tokens by domain; domains without a target share what the targets leave."""
    loose = [n for n in names if n not in targets]
    spread = max(0.0, 1.0 - sum(targets.get(n, 0.0) for n in names)) / len(loose) if loose else 0.0
    shares = [targets.get(n, spread) for n in names]
    return [everything * w / (sum(shares) or 1.0) for w in shares]


def fit_rates(members: DataFrame, names: list[str], targets: dict[str, float]) -> tuple[DataFrame, list[tuple]]:
    """``members`` with the fitted ``rate``, and (domain, target, reached) shares of all tokens.

    The squares of the misses are weighted by 1 over the domain's tokens, those of the rates' distance from 1 by the
    document's tokens and ``RIDGE``. At the optimum a rate is 1 less the slope over ``RIDGE``, or 0; the slope is a product of
    the chances with a pull for each domain, and the pulls are the domains' weighted misses. One pass gives, for pulls at some
    step lengths, the tokens, the curvature and the objective whose top is the optimum; the best gives the next step.
    """
    k = len(names)
    chance = [F.col("chances")[i] for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]

    def measure(pulls: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, float]]:
        """Tokens by domain, curvature over the rates above 0, and squared distance of the rates; a row for each pull."""
        told = members.select("n_tokens", "chances", F.posexplode(F.transform(
            _numbers([u.tolist() for u in pulls]), rate_of)).alias("at", "x"))
        t = F.col("n_tokens")
        rows = told.groupBy("at").agg(
            *[F.sum(t * F.col("x") * c) for c in chance],
            *[F.sum(F.when(F.col("x") > 0, t).otherwise(0) * chance[i] * chance[j]) for i, j in pairs],
            F.sum(t * F.pow(F.col("x") - 1, 2))).collect()
        out = {}
        for r in rows:
            v = [float(x or 0.0) for x in r[1:]]
            curve = np.zeros((k, k))
            for (i, j), c in zip(pairs, v[k:-1]):
                curve[i, j] = curve[j, i] = c
            out[r["at"]] = (np.array(v[:k]), curve, v[-1])
        return [out.get(i, (np.zeros(k), np.zeros((k, k)), 0.0)) for i in range(len(pulls))]

    pull = np.zeros(k)
    start, curve, apart = measure([pull])[0]
    reached, everything = start, float(start.sum())
    wanted = np.array(wanted_tokens(names, everything, targets))
    some = start > 0
    size = np.where(some, start, 1.0)
    # the objective of the pulls: concave, and its slope is what is missing between misses and pulls
    height = lambda u, s, a: float(RIDGE * u @ (s - wanted) - (RIDGE * u) ** 2 @ size / 2 + RIDGE * a / 2)
    while everything > 0:
        slope = np.where(some, reached - wanted - RIDGE * size * pull, 0.0)
        if np.abs(slope).sum() <= TOLERANCE * everything:
            break
        root = 1 / np.sqrt(size)
        step = root * np.linalg.solve(RIDGE * np.eye(k) + root[:, None] * curve * root[None, :], root * slope)
        tried = [pull + a * step for a in LENGTHS]
        found = measure(tried)
        best = max(range(len(tried)), key=lambda i: height(tried[i], found[i][0], found[i][2]))
        if height(tried[best], found[best][0], found[best][2]) <= height(pull, reached, apart):
            break
        pull, (reached, curve, apart) = tried[best], found[best]
    share = lambda s: (s / everything if everything else s * 0).tolist()
    return members.withColumn("rate", rate_of(_numbers(pull.tolist()))), list(zip(names, share(wanted), share(reached)))


def mix_with_balance(docs: DataFrame, labels: DataFrame, *keys: str, key: str = "doc_id", text: str = "text",
                     targets: dict[str, float] | None = None, learn_from: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows as of :func:`mix`, and (domain, target, reached, missed) shares of all tokens.

    ``learn_from`` holds the labelled documents, by default the mixed ones.
    """
    model = learn_domains(docs if learn_from is None else learn_from, labels, key, text)
    members = materialize(memberships(docs, model, *keys, text=text), "members")
    rated, balance = fit_rates(members, model.names, TARGETS if targets is None else targets)
    met = all(abs(r - t) <= MET for _, t, r in balance)
    top = F.get(F.array(*[F.lit(n) for n in model.names]),
                (F.array_position("chances", F.array_max("chances")) - 1).cast("int"))
    rows = rated.select(*keys, "n_tokens", "chances", top.alias("domain"), "rate", F.lit(met).alias("targets_met"))
    table = docs.sparkSession.createDataFrame([(n, t, r, r - t) for n, t, r in balance],
                                              "domain string, target double, reached double, missed double")
    return rows, table


def mix(docs: DataFrame, labels: DataFrame, *keys: str, key: str = "doc_id", text: str = "text",
        targets: dict[str, float] | None = None, learn_from: DataFrame | None = None) -> DataFrame:
    """Keys, ``n_tokens``, ``chances``, the likeliest ``domain``, the fitted ``rate`` and ``targets_met`` of each row."""
    return mix_with_balance(docs, labels, *keys, key=key, text=text, targets=targets, learn_from=learn_from)[0]
