"""Paraphrased benchmark items by latent semantic retrieval, and the randomised SVD behind it."""

import numpy as np
import pytest

from txnlens.llm import decontaminate as dc
from txnlens.session import materialize

RNG = np.random.default_rng(21)
KINDS = ("literal", "clauses in another order", "every second word replaced", "half of the words replaced")


def words(n):
    """Two of five words from 50 function words, the others from 6,000 content words."""
    return [f"f{RNG.integers(50)}" if RNG.random() < 0.4 else f"v{RNG.integers(6000)}" for _ in range(n)]


def edited(item, kind, d):
    clauses = [list(c) for c in item]
    if kind == 1:
        clauses = clauses[1:] + clauses[:1]
    flat = [w for c in clauses for w in c]
    if kind == 2:
        flat = [w if k % 2 else f"other{d}x{k}" for k, w in enumerate(flat)]
    if kind == 3:
        for k in RNG.choice(len(flat), len(flat) // 2, replace=False):
            flat[k] = f"other{d}x{k}"
    return flat


@pytest.fixture(scope="module")
def case(spark):
    items = {i: [words(8), words(8), words(8)] for i in range(40)}
    texts, planted = {}, {}
    for d in range(400):
        plain = words(int(RNG.integers(150, 500)))
        if d % 2 == 0:
            kind, item = (d // 2) % 4, d // 2 % 40
            at = int(RNG.integers(len(plain)))
            plain[at:at] = edited(items[item], kind, d)
            planted[d] = (item, kind)
        texts[d] = " ".join(plain)
    asked = {i: ". ".join(" ".join(c) for c in clauses) + "." for i, clauses in items.items()}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    bench = spark.createDataFrame(list(asked.items()), "item_id bigint, text string")
    return docs, bench, texts, asked, planted


def held(docs, bench):
    rows = [(r["item_id"], r["text"]) for r in bench.collect()]
    items = dc.Items(rows)
    stored = materialize(dc.numbered(docs, items.terms, "doc_id", "text"), "words")
    seen, blocks = dc.term_blocks(stored, len(items.terms))
    bound = dc.Bound(items, seen)
    weight = np.where((seen > max(1, dc.MOST_SHARE * blocks)) & ~bound.probe, 0, np.log((blocks + 1) / (seen + 1)) + 1)
    return items, stored, weight


def test_singular_values_and_vectors_as_by_numpy(case):
    docs, bench, *_ = case
    items, stored, weight = held(docs, bench)
    vectors, values = dc.latent_basis(stored, weight, 12)
    parts = [np.frombuffer(r["w"], np.int32) for r in stored.collect()]
    rows = dc.Blocks(parts).passages(weight, np.eye(len(weight), dtype=np.float32))[0].astype(float)
    exact = np.linalg.svd(rows, compute_uv=False)[:12]
    assert np.allclose(vectors.T @ vectors, np.eye(12), atol=1e-4)
    assert np.all(np.diff(values) <= 1e-6) and np.all(values <= exact * 1.001)
    assert values[0] == pytest.approx(exact[0], rel=0.01) and np.sum(values**2) > 0.85 * np.sum(exact**2)


def by_brute_force(docs, bench):
    """(document, item) that the weights of the exact words, the subsequence and the answer confirm, all rows tried."""
    items, stored, weight = held(docs, bench)
    out = set()
    for r in stored.collect():
        own = np.frombuffer(r["w"], np.int32)
        for start in range(0, len(own), dc.STEP):
            row = set(own[start:start + 2 * dc.STEP].tolist())
            for i, w in enumerate(items.words):
                distinct = np.unique(w)
                share = sum(weight[t] for t in distinct.tolist() if t in row) / weight[distinct].sum()
                if share < dc.LEAST_WEIGHT:
                    continue
                n, m = len(w), len(items.answers[i])
                around = own[max(0, start - n):start + 2 * dc.STEP + n].tolist()
                if dc.common_length(items.masks[i], n, around) / n >= dc.LEAST_PARAPHRASE \
                        and dc.common_length(items.answer_masks[i], m, around) / m >= dc.LEAST_ANSWER:
                    out.add((r["d"], items.ids[i]))
    return out


def test_paraphrases_are_found_by_kind_of_edit(case):
    docs, bench, texts, asked, planted = case
    got = {(r["doc_id"], r["item_id"]) for r in dc.find_leaks(docs, bench).collect()}
    want = by_brute_force(docs, bench)
    for kind, name in enumerate(KINDS):
        put = {(d, i) for d, (i, k) in planted.items() if k == kind}
        reached = len(put & want & got) / max(1, len(put & want))
        print(f"{name}: planted {len(put)}, by brute force {len(put & want)}, found of them {reached:.2f}, "
              f"found of all {len(put & got) / len(put):.2f}")
        assert reached >= 0.9
        assert kind > 1 or len(put & got) == len(put)
    others = {p for p in got if planted.get(p[0], (None,))[0] != p[1]}
    print(f"found {len(got)}, brute force {len(want)}, without a planted item {len(others)}")
    assert len(others) <= 2


def test_no_passage_and_no_weight_give_no_leak(spark):
    bench = spark.createDataFrame([(1, "only one item of a few words. here")], "item_id bigint, text string")
    for rows in ([(1, "")], [(1, None)], [(2, "nothing alike at all")]):
        docs = spark.createDataFrame(rows, "doc_id bigint, text string")
        assert dc.find_leaks(docs, bench).count() == 0
