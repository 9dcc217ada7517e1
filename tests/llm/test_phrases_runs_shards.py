"""Phrases, periodic runs, shards, and the contracts of rates and near copies, against brute force."""

import collections
import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnlens.llm import mixing, near_dup, periodic_runs, phrase_graph, sharding

SCHEMA = "doc_id bigint, text string, lang string, key string, phrase string, shard string, rank string"
LONG = "Over and OVER again. " * 4000


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, "x", "y", "z", "r") for i, t, lang in rows], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(4)
    words = ["new", "york", "City", "the", "of", "état", "big", "apple", "a"]
    texts = [None, "", " \n ", "one", LONG, "the big apple; the big apple", "\x0b\x0c the\r\nbig\tapple"]
    texts += [" ".join(rng.choice(words, int(rng.integers(1, 60)), p=rng.dirichlet(np.ones(9)))) +
              str(rng.choice([".", "!", " ", ", new york city"])) for _ in range(150)]
    rows = [(None if i == 9 else i, t, [None, "en", "fr", "und"][i % 4]) for i, t in enumerate(texts)]
    return table(spark, [*rows, rows[20], rows[20]]).repartition(3)


def phrases_brute(rows, least, top, inside):
    count = collections.defaultdict(collections.Counter)
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for r in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (r["text"] or "").translate(lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for size in (1, 2, 3):
                for i in range(len(w) - size + 1):
                    count[r["lang"] or "und"][tuple(w[i:i + size])] += 1
    out = set()
    for lang, f in count.items():
        n = sum(a for p, a in f.items() if len(p) == 1)
        known = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in known.items():
            if any(len(q) > len(p) and 100 * b >= inside * a and p in (q[:2], q[1:]) for q, b in known.items()):
                continue
            score, _, l, r = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(scored)[:top], 1):
            out.add((lang, rank, p.decode(), -a, l, r, n, -s))
    return out


@pytest.mark.parametrize("least,top", [(10, 2000), (2, 7)])
def test_phrases_as_by_brute_force(docs, monkeypatch, least, top):
    monkeypatch.setattr(phrase_graph, "CHUNK_WORDS", 300)  # so that many graphs meet
    got = {tuple(r) for r in phrase_graph.collocations(docs, least=least, top=top).collect()}
    want = phrases_brute(docs.collect(), least, top, 50)
    assert got == want and want
    assert phrase_graph.collocations(docs.limit(0)).count() == 0


def runs_brute(w):
    found = {}
    for p in range(1, len(w) // 4 + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            if j > i and j + p - i >= max(6, 4 * p):
                found.setdefault((i, j + p), p)  # the smallest period comes first
            i = max(j, i + 1)
    return sorted(((s, e - s, p) for (s, e), p in found.items()), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("tails", [False, True])
def test_runs_as_by_brute_force(spark, docs, tails):
    rng = np.random.default_rng(8)
    more = []
    for i in range(120):
        period = rng.integers(0, 3, int(rng.integers(1, 7)))
        parts = [rng.integers(0, 3, int(rng.integers(0, 9))), np.resize(period, int(rng.integers(0, 40))), rng.integers(0, 2, 5)]
        more.append((1000 + i, " ".join(f"w{v}" for v in np.concatenate(parts)), None))
    every = docs.unionByName(table(spark, more))
    got = sorted(periodic_runs.find_runs(every, repeated_tails=tails).drop("runs", "collapsed").collect(), key=str)
    want = []
    for r in every.collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")
        n = len(w)
        h = zlib.crc32(str(r["doc_id"]).encode())
        if tails and r["doc_id"] is not None and h % 10 == 0 and n:
            a, g = (h // 10) % n, h // 10
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = [(0, n, 4)] if n == 16_000 and not tails else runs_brute(w)
        gone = {i for s, size, p in runs for i in range(s + p, s + size)}
        best = max(runs, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=None)
        told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        want.append((r["doc_id"], n, len(runs), *told, sha("".join("%d,%d,%d\n" % x for x in runs)),
                     sha(" ".join(v for i, v in enumerate(w) if i not in gone))))
    assert list(map(str, map(tuple, got))) == sorted(map(str, want)) or sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert periodic_runs.find_runs(docs.limit(0)).count() == 0


def shards_of(rows, shards):
    size, groups, slots = np.zeros(shards), collections.defaultdict(collections.Counter), collections.defaultdict(list)
    for r in rows:
        size[r["shard"]] += r["size"]
        groups[r["text_crc32"]][r["shard"]] += 1
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return size, [g for g in groups.values() if sum(g.values()) > 1]


def test_shards_are_even_and_hold_groups_together(spark):
    rng = np.random.default_rng(3)
    rows = [(i, f"text {i // 3} " + "x" * (i // 3 % 150), None) for i in range(900)]  # groups of three
    rows += [(1000 + i, f"own {i} " + "y" * int(rng.integers(0, 300)), None) for i in range(2000)]
    rows += [(5000 + i, "hot " * 20, None) for i in range(1500)]  # more than one shard holds
    rows += [(None, None, None), (None, "", None), (7, "twice", None), (7, "twice", None)]
    docs = table(spark, rows)
    got = sharding.assign(docs, shards=8).collect()
    want = sorted((len((t or "").encode()) + 16, zlib.crc32((t or "").encode()), -1 if i is None else i) for i, t, _ in rows)
    assert sorted((r["size"], r["text_crc32"], -1 if r["doc_id"] is None else r["doc_id"]) for r in got) == want
    size, groups = shards_of(got, 8)
    assert size.max() / size.mean() < 1.01 and size.min() / size.mean() > 0.99
    assert sum(len(g) > 1 for g in groups if sum(g.values()) < 100) == 0
    assert max(sum(g.values()) for g in groups) == 1500


def test_shards_where_all_is_linked_or_nothing_is_there(spark):
    size, _ = shards_of(sharding.assign(table(spark, [(i, "same", None) for i in range(400)]), shards=8).collect(), 8)
    assert set(size) == {50 * 20}
    linked = [(i, f"group {i // 2 % 150:03d}", None) for i in range(600)]
    size, groups = shards_of(sharding.assign(table(spark, linked), shards=8).collect(), 8)
    assert size.max() - size.min() <= 2 * 25 and sum(len(g) == 1 for g in groups) > 0.6 * len(groups)
    assert sharding.assign(table(spark, []), shards=8).count() == 0
    one = sharding.assign(table(spark, [(1, "a", None)]), shards=8).collect()
    assert len(one) == 1 and one[0]["slot"] == 0


def test_what_shards_are_granted():
    # shard 1 has room for half of what shard 0 sends; shards 2 and 3 swap although they are full
    share = sharding.granted([100.0, 80.0, 100.0, 100.0], {(0, 1): 40.0, (2, 3): 10.0, (3, 2): 10.0}, 100.0)
    assert share[1] == pytest.approx(0.5) and share[2] == share[3] == pytest.approx(1.0)


def test_near_copies_under_null_and_shared_keys(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(5, base), (5, base + " end"), (None, base + " last"), (9, base + " more"), (3, "other words here"), (None, "lone text"),
            (None, "only here a b c"), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"])
           for r in near_dup.near_duplicates(docs).collect()}
    # a component has its smallest key's name, and kept says whether a row has that key
    assert got == {(5, 58, 5, True), (5, 59, 5, True), (None, 59, 5, False), (9, 59, 5, False), (3, 1, 3, True),
                   (None, 1, None, True), (None, 3, None, True), (2, 0, 2, True)}
    kept = near_dup.keep_one_of_each(docs, size=3, percent=85).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == ["2", "3", "5", "None", "None"]


def test_many_short_near_copies_are_compared_in_small_blocks(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(600):
        w = [f"w{k}" for k in range(40)]
        for k in rng.choice(40, int(rng.integers(0, 4)), replace=False):
            w[k] = f"n{i}_{k}"
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    one, two = ({tuple(r) for r in near_dup.near_duplicates(docs, block_documents=n).collect()} for n in (2000, 20))
    assert one == two


def best_rates(tokens, chances, wanted, steps=60_000):
    """Plain projected gradient with momentum."""
    start = (tokens[:, None] * chances).sum(axis=0)
    x = y = np.ones(len(tokens))
    a = 1.0
    for _ in range(steps):
        g = chances @ (((tokens * y) @ chances - wanted) / start) + mixing.RIDGE * (y - 1)
        new, b = np.maximum(0, y - g), (1 + np.sqrt(1 + 4 * a * a)) / 2
        y = new + (a - 1) / b * (new - x)
        x, a = new, b
    return (tokens * x) @ chances


@pytest.mark.parametrize("targets", [{"a": 0.5, "b": 0.3, "c": 0.2}, {"a": 0.05, "b": 0.05, "c": 0.9}])
def test_rates_are_the_best_ones_in_reach_or_not(spark, targets):
    rng = np.random.default_rng(5)
    tokens = rng.integers(0, 200, 40).astype(float)
    chances = rng.dirichlet([4, 2, 0.3], 40)
    frame = spark.createDataFrame([(int(t), p.tolist()) for t, p in zip(tokens, chances)], "n_tokens bigint, chances array<double>")
    rated, balance = mixing.fit_rates(frame, ["a", "b", "c"], targets)
    wanted = tokens.sum() * np.array([targets[n] for n in "abc"])
    want = best_rates(tokens, chances, wanted)
    assert [r for _, _, r in balance] == pytest.approx((want / tokens.sum()).tolist(), abs=1e-6)
    got = rated.collect()
    assert all(r["rate"] >= 0 for r in got)
    told = sum(r["n_tokens"] * r["rate"] * np.array(r["chances"]) for r in got) / tokens.sum()
    assert told == pytest.approx([r for _, _, r in balance], abs=1e-9)


def test_pipeline_rows_with_clashing_columns(spark, sf_dir, tmp_path):
    import corpus_pipeline
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    names = ["domain", "_own", "_before", "_hash", "row", "k", "h", "rate"]
    clashing = docs.select("*", *[F.lit(f"mine {n}").alias(n) for n in names])
    for stage in (corpus_pipeline.near_duplicates, corpus_pipeline.decontamination, corpus_pipeline.secret_scan):
        got = stage(spark, clashing, sf_dir)
        assert got.columns == clashing.columns
        assert got.select(*names).distinct().collect() == [tuple(f"mine {n}" for n in names)]
    mixed = corpus_pipeline.mixing_weights(spark, clashing, sf_dir)
    assert mixed.count() == 60 and mixed.where("_own = 'mine _own' and rate >= 0 and domain <> 'mine domain'").count() == 60
