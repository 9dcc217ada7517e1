"""Groups that grow with the rows: places of one class of contexts, and matches of one text."""

import hashlib
import re
import time

import numpy as np
from pyspark.sql import functions as F

from txnlens.llm import repeats, secrets, suffix_trees


def windows_removed(rows, size):
    """Brute force over (key, words): kept words of each row; a null key is smaller than all others."""
    first = {}
    order = [(-2**63 if k is None else k, t.split()) for k, t in rows]
    for k, own in order:
        for i in range(len(own) - size + 1):
            w = tuple(own[i:i + size])
            first[w] = min(first.get(w, k), k)
    out = []
    for k, own in order:
        gone = np.zeros(len(own), bool)
        for i in range(len(own) - size + 1):
            if first[tuple(own[i:i + size])] < k:
                gone[i:i + size] = True
        out.append((None if k == -2**63 else k, len(own), int(gone.sum()),
                    hashlib.sha256(" ".join(w for w, g in zip(own, gone) if not g).encode()).hexdigest()))
    return sorted(out, key=str)


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


PASSAGE = " ".join(f"w{i}" for i in range(90))
OTHER = PASSAGE.replace("w70", "v70")


def test_equal_contexts_of_the_first_document_share_their_verdict(spark):
    # the passage stands often in one document, once under smaller keys as a part, and in later documents
    often = " ".join(f"{PASSAGE} s{i}" for i in range(12))
    part = " ".join(PASSAGE.split()[:60])
    rows = [(5, often), (6, OTHER + " end"), (7, "start " + PASSAGE), (3, "a b " + part), (None, "n " + OTHER),
            (None, "m " + OTHER), (None, PASSAGE + " z"), (7, "another " + often), (2**62, OTHER)]
    for limit in (repeats.GROUP_UNITS, 200):
        got = suffix_trees.remove_earlier_windows(table(spark, rows), group_units=limit).drop("kept").collect()
        assert sorted((tuple(r) for r in got), key=str) == windows_removed(rows, 50)


def test_a_null_key_of_many_rows_is_judged_once_a_class(spark):
    rows = [(None, f"{t} n{i}") for i in range(400) for t in (PASSAGE, OTHER)]

    def judge(units, length, judged, keys, size):
        whole = np.split(units, np.cumsum(length)[:-1])
        assert len({w.tobytes() for w in whole}) == len(whole), "a class is judged at more than one place"
        return suffix_trees.earlier_in_piece(units, length, judged, keys, size)
    source = repeats.keyed(table(spark, [*rows, (1, PASSAGE)]), "doc_id", "text")
    spans = repeats.repeated_spans(source, "words", 50, suffix_trees.GRAM, judge, earlier=True)
    assert [(r["d"], len(r["spans"]) > 0) for r in spans.collect()] == [(1, True)]


def test_running_values_as_by_a_loop(spark):
    for n in (0, 1, 2, 3, 10, 97, 400):
        values = [(i * 7919) % 101 - 50 for i in range(n)]
        df = spark.createDataFrame([(values,)], "v array<int>")
        got = df.select(secrets.running(F.col("v"), lambda a, b: a + b, F.lit(0)).alias("s"),
                        secrets.running(F.col("v"), F.greatest, F.lit(-99)).alias("m")).first()
        assert got["s"] == np.cumsum(values).tolist()
        assert got["m"] == np.maximum.accumulate(values).tolist() if n else got["m"] == []


def base_spans(text):
    """The fixed kinds by Python's regular expressions."""
    out = []
    for m in re.finditer(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I):
        if len(m.group(1)) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 24]
    return sorted(out)


def random_hex(rng, n=40):
    return "".join("0123456789abcdef"[i] for i in rng.integers(0, 16, n))


def test_added_spans_and_redaction_as_by_loops(spark):
    rng = np.random.default_rng(3)
    texts = []
    for i in range(30):
        parts = []
        for _ in range(int(rng.integers(1, 12))):
            kind = int(rng.integers(0, 5))
            value = random_hex(rng)
            mixed = "".join(secrets.ALPHABET[k] for k in rng.integers(0, 62, 32))
            parts.append([f"token = '{mixed}'", mixed, f"x{value}+{mixed}", "AKIA" + value.upper()[:20],
                          "some_plain_identifier_of_code"][kind])
        texts.append((i, " and ".join(parts)))
    docs = table(spark, [*texts, (None, None), (99, "")])
    kind = [0 if c.islower() else 1 if c.isupper() else 2 for c in secrets.ALPHABET] + [2]
    model = [1.0 if x != y else -0.2 for x in kind for y in kind]  # changes of case or to digits are random
    found = {r["doc_id"]: r for r in secrets.scan(docs, model, "doc_id").collect()}
    clean = {r["doc_id"]: r["text"] for r in secrets.redact(docs, model=model).collect()}
    added = 0
    for i, t in texts:
        base = [tuple(s) for s in found[i]["base"]]
        spans = [tuple(s) for s in found[i]["spans"]]
        assert base == base_spans(t)
        extra = []
        for m in re.finditer(secrets.CANDIDATE, t):
            codes = [secrets.ALPHABET.find(c) if c in secrets.ALPHABET else secrets.CLASSES - 1 for c in m.group()]
            score = sum(model[a * secrets.CLASSES + b] for a, b in zip(codes, codes[1:])) / max(len(codes) - 1, 1)
            if score >= secrets.LEAST_RATIO and not any(s < m.end() and m.start() < e for s, _, e in base):
                extra.append((m.start(), 3, m.end()))
        added += len(extra)
        assert spans == sorted(base + extra)
        out, at = "", 0
        for s, _, e in spans:
            if s >= at:
                out += t[at:s] + "[secret]"
            at = max(at, e)
        assert clean[i] == out + t[at:]
    assert added and clean[99] == "" and clean[None] is None


def test_many_matches_in_one_text_take_near_linear_time(spark):
    rng = np.random.default_rng(5)
    took = []
    for n in (2_000, 32_000):
        text = " ".join(random_hex(rng, 30) for _ in range(n))
        docs = table(spark, [(1, text)])
        model = [0.1] * secrets.CLASSES**2
        start = time.time()
        row = secrets.scan(docs, [v * 10 for v in model], "doc_id").first()
        took.append(time.time() - start)
        assert len(row["base"]) == n and row["base"] == row["spans"]
        assert row["base"][-1]["end"] == len(text)
    print(f"2,000 and 32,000 matches: {took[0]:.1f} and {took[1]:.1f} s")
    assert took[1] < 12
