"""Secret scans: fixed patterns, and two character Markov models compared by log-likelihood ratio.

Everything is a DataFrame expression. The models hold the chances of each character after each other one, in random
strings and in ordinary identifiers. They are trained from labelled samples that the texts themselves give: values that
the fixed patterns find are random strings, other words and identifiers of the same documents are ordinary. A long run
of token characters whose ratio favours the random model is a secret of kind ``markov``; spans of the fixed kinds stay
and win where they overlap.

Defined cases: a null or empty text has no span; an empty table, or one without any labelled sample, gives smoothed
models that favour nothing, so only the fixed patterns count; equal rows give equal spans; columns with other names
pass through ``redact`` untouched. Positions are code points, the end is exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlens.llm.quality_rules import let

#: The base patterns and their smallest lengths.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # 20 characters or more of AKIA[A-Z0-9]+
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"  # a look behind keeps the search from trying every place inside a run
LEAST_VALUE = 6
KINDS = ("assign", "access", "hex", "markov")

#: Runs that the models judge, and ordinary identifiers to learn from.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
IDENTIFIER = r"[A-Za-z_][A-Za-z0-9_]{3,}"
#: Characters of a token, in the order of their numbers; anything else is one more class.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
CLASSES = len(ALPHABET) + 1
#: Bounds of the training sample: values of the fixed patterns, and different texts whose identifiers are read.
MOST_SECRETS = 20_000
MOST_DOCUMENTS = 2_000
MOST_BYTES = 8 << 20
SMOOTHING = 0.5
#: Least ratio a character (natural logarithm) of a secret.
LEAST_RATIO = 0.5


def possible(text: Column, pattern: str) -> Column:
    """Cheap test that holds for every text with a match."""
    if pattern == ASSIGN:
        return text.contains("=") | text.contains(":")
    return text.contains("AKIA") if pattern == ACCESS else F.lit(True)


def running(values: Column, combine, zero: Column) -> Column:
    """Running values of an associative ``combine`` over an array, the element itself included.

    An array is copied when it is appended to, so n appends cost n squared. Here about sqrt(n) blocks of sqrt(n)
    elements are walked each for itself, then the blocks' last values, and every block is shifted by those before it.
    """
    def walk(part: Column, begin: Column) -> Column:
        start = F.struct(begin.alias("last"), F.filter(F.array(zero), lambda _: F.lit(False)).alias("out"))
        return F.aggregate(part, start, lambda acc, x: let(combine(acc["last"], x), lambda v: F.struct(
            v.alias("last"), F.concat(acc["out"], F.array(v)).alias("out"))))["out"]

    def shifted(blocks: Column) -> Column:
        ends = walk(F.transform(blocks, lambda b: F.element_at(b, -1)), zero)
        before = F.concat(F.array(zero), ends)
        return let(before, lambda own: F.flatten(F.transform(blocks, lambda b, i: F.transform(
            b, lambda v: combine(F.get(own, i), v)))))

    def parted(step: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(values), step)
        return let(F.transform(starts, lambda at: walk(F.slice(values, at, step), zero)), shifted)
    return F.when(F.size(values) > 0, let(F.ceil(F.sqrt(F.size(values))).cast("int"), parted)) \
        .otherwise(F.filter(F.array(zero), lambda _: F.lit(False)))


def matches(text: Column, pattern: str, accept=None) -> Column:
    """(start, end) of the leftmost matches without overlap. The text is split only if there is a match."""
    def place(found: Column) -> Column:
        gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
        steps = F.slice(F.zip_with(gaps, found, lambda g, m: g + F.length(m)), 1, F.size(found))
        ends = let(steps, lambda own: running(own, lambda a, b: a + b, F.lit(0)))
        walked = F.zip_with(ends, found, lambda e, m: F.struct(
            F.struct((e - F.length(m)).alias("start"), e.alias("end")).alias("w"), m.alias("m")))
        if accept is not None:
            walked = F.filter(walked, lambda x: accept(x["m"]))
        return F.transform(walked, lambda x: x["w"])
    none = F.array().cast("array<struct<start:int,end:int>>")
    all_of = F.when(possible(text, pattern), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array())
    return let(all_of, lambda found: F.when(F.size(found) > 0, place(found)).otherwise(none))


def numbers(token: Column) -> Column:
    """Class of each character of a token."""
    return F.transform(F.split(token, ""), lambda c: F.coalesce(F.nullif(F.instr(F.lit(ALPHABET), c), F.lit(0)),
                                                               F.lit(CLASSES)) - 1)


def bigrams(tokens: DataFrame, token: str, label: str) -> DataFrame:
    """Counts of neighbouring classes by label."""
    codes = tokens.select(label, numbers(F.col(token)).alias("c")).where(F.size("c") > 1)
    pairs = codes.select(label, F.explode(F.zip_with(F.slice("c", 1, F.size("c") - 1), F.slice("c", 2, F.size("c")),
                                                     lambda a, b: a * CLASSES + b)).alias("pair"))
    return pairs.groupBy(label, "pair").agg(F.count("*").alias("n"))


def sample_texts(whole: DataFrame, most: int, most_bytes: int) -> DataFrame:
    """(t): different texts in the order of a hash, as many as both bounds allow; a text that does not fit is passed over.

    Hashes and lengths are ranked first; only then are texts read.
    """
    keyed = whole.select("t", F.xxhash64("t").alias("h"))
    ranked = keyed.select("h", F.octet_length("t").alias("n")).distinct().orderBy("h", "n").limit(most).collect()
    taken, left = [], most_bytes
    for r in ranked:
        if r["n"] <= left:
            taken.append((r["h"],))
            left -= r["n"]
    if left == most_bytes and ranked:  # no text fits: the shortest one that isn't empty
        taken.append((min(ranked, key=lambda r: (r["n"] == 0, r["n"]))["h"],))
    wanted = whole.sparkSession.createDataFrame(taken, "h bigint")  # at most ``most`` rows
    return keyed.join(F.broadcast(wanted), "h").dropDuplicates(["h"]).select("t")


def labelled_samples(docs: DataFrame, text: str = "text", most: int = MOST_DOCUMENTS,
                     most_bytes: int = MOST_BYTES) -> DataFrame:
    """(token, random): distinct values of the fixed patterns, and identifiers of a bounded set of different texts."""
    whole = docs.select(F.coalesce(F.col(text), F.lit("")).alias("t"))
    seen = [possible(F.col("t"), p) & F.col("t").rlike(p) for p in (ACCESS, ASSIGN, HEX)]
    hits = whole.where(seen[0] | seen[1] | seen[2])
    values = hits.select(F.explode(F.concat(
        F.filter(F.regexp_extract_all("t", F.lit(ASSIGN), F.lit(1)), lambda v: F.length(v) >= 16),
        F.regexp_extract_all("t", F.lit(ACCESS), F.lit(0)), F.regexp_extract_all("t", F.lit(HEX), F.lit(0)))).alias("token"))
    random = values.distinct().orderBy(F.xxhash64("token"), "token").limit(MOST_SECRETS)
    read = sample_texts(whole, most, most_bytes)
    plain = read.select(F.explode(F.regexp_extract_all(
        F.regexp_replace(F.regexp_replace(F.regexp_replace("t", ASSIGN, " "), ACCESS, " "), HEX, " "),
        F.lit(IDENTIFIER), F.lit(0))).alias("token")).distinct()
    return random.select("token", F.lit(True).alias("random")).unionByName(
        plain.select("token", F.lit(False).alias("random")))


def train(samples: DataFrame) -> list[float]:
    """Log ratio of each pair of classes, random over ordinary; the table has ``CLASSES`` squared entries."""
    import math
    counts = {True: [0.0] * CLASSES**2, False: [0.0] * CLASSES**2}
    for row in bigrams(samples, "token", "random").collect():  # at most 2 * CLASSES ** 2 rows
        counts[row["random"]][row["pair"]] = float(row["n"])
    if not any(counts[True]) or not any(counts[False]):
        return [0.0] * CLASSES**2
    chance = {}
    for label, found in counts.items():
        rows = [found[a * CLASSES:(a + 1) * CLASSES] for a in range(CLASSES)]
        chance[label] = [math.log((n + SMOOTHING) / (sum(row) + SMOOTHING * CLASSES)) for row in rows for n in row]
    return [r - o for r, o in zip(chance[True], chance[False])]


def ratio(token: Column, model: Column) -> Column:
    """Mean log-likelihood ratio a character of a token."""
    def walk(codes: Column) -> Column:
        sums = F.aggregate(codes, F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum")), lambda acc, c: F.struct(
            c.alias("last"), F.when(acc["last"] < 0, acc["sum"]).otherwise(
                acc["sum"] + F.get(model, acc["last"] * CLASSES + c)).alias("sum")))
        return sums["sum"] / F.greatest(F.size(codes) - 1, F.lit(1))
    return let(numbers(token), walk)


def scan(docs: DataFrame, model: list[float], *keys: str, text: str = "text") -> DataFrame:
    """Keys, then ``base`` and ``spans``: (start, rank, end) of the fixed kinds and of all kinds, in order."""
    t = F.col("_text")
    table = F.lit(model).cast("array<double>") if any(model) else None

    def ranked(found: Column, rank: int) -> Column:
        return F.transform(found, lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("kind"),
                                                     x["end"].alias("end")))
    base = F.sort_array(F.concat(
        ranked(matches(t, ASSIGN, lambda m: F.length(F.regexp_extract(m, ASSIGN, 1)) >= LEAST_VALUE), 0),
        ranked(matches(t, ACCESS), 1), ranked(matches(t, HEX), 2)))
    found = docs.select(*keys, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    if table is None:
        return found.select(*keys, base.alias("base")).withColumn("spans", F.col("base"))
    extra = ranked(matches(t, CANDIDATE, lambda m: ratio(m, table) >= LEAST_RATIO), 3)
    both = found.select(*keys, F.struct(base.alias("base"), extra.alias("extra")).alias("_both"))
    return both.select(*keys, F.col("_both.base").alias("base"), F.when(
        (F.size("_both.base") == 0) | (F.size("_both.extra") == 0), F.concat("_both.base", "_both.extra"))
        .otherwise(let(F.sort_array(F.concat("_both.base", "_both.extra")), without_overlaps)).alias("spans"))


def without_overlaps(spans: Column) -> Column:
    """Sorted spans without those of the models that meet a base span.

    A span meets an earlier one that ends behind its start, or a later one that starts before its end; so the greatest
    end so far and the least start to come decide, and no span is held against every other one.
    """
    model = len(KINDS) - 1
    far = F.lit(2**31 - 1)
    ends = running(F.transform(spans, lambda s: F.when(s["kind"] < model, s["end"]).otherwise(0)), F.greatest, F.lit(0))
    starts = F.reverse(running(F.transform(F.reverse(spans), lambda s: F.when(s["kind"] < model, s["start"]).otherwise(far)),
                               F.least, far))
    both = F.zip_with(F.zip_with(spans, ends, lambda s, e: F.struct(s.alias("s"), e.alias("e"))), starts,
                      lambda x, a: F.struct(x["s"].alias("s"), x["e"].alias("e"), a.alias("a")))
    kept = F.filter(both, lambda x: (x["s"]["kind"] < model) | (
        (x["e"] <= x["s"]["start"]) & (x["a"] >= x["s"]["end"])))
    return F.transform(kept, lambda x: x["s"])


def named(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")


def secret_report(docs: DataFrame, *keys: str, text: str = "text") -> DataFrame:
    """Trains on ``docs`` and scans it: keys, counts by kind, ``base`` and ``spans``."""
    found = scan(docs, train(labelled_samples(docs, text)), *keys, text=text)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{KINDS[k]}")
    return found.select(*keys, *[count(k) for k in range(len(KINDS))], "base", "spans")


def redact(docs: DataFrame, text: str = "text", mark: str = "[secret]", model: list[float] | None = None) -> DataFrame:
    """The rows with every span (overlapping ones joined) replaced by ``mark``; a text without spans is unchanged.

    ``model`` is the result of :func:`train`, by default of these rows.
    """
    model = train(labelled_samples(docs, text)) if model is None else model
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(text).alias("_t"))
    found = scan(packed, model, "_row", "_t", text="_t")
    # A span that starts before an earlier one's end goes on with it; the text between the others stays.
    reach = running(F.transform("spans", lambda s: s["end"]), F.greatest, F.lit(0))
    parts = let(F.concat(F.array(F.lit(0)), reach), lambda ends: F.transform(
        F.filter(F.transform(F.col("spans"), lambda s, i: F.struct(F.get(ends, i).alias("a"), s["start"].alias("b"))),
                 lambda x: x["a"] <= x["b"]), lambda x: F.substring(F.col("_t"), x["a"] + 1, x["b"] - x["a"])))
    last = F.substring(F.col("_t"), F.array_max(F.transform("spans", lambda s: s["end"])) + 1, F.lit(2**31 - 1))
    clean = F.array_join(F.concat(parts, F.array(last)), mark)
    value = F.when(F.size("spans") > 0, clean).otherwise(F.col("_t"))
    return found.select("_row", value.alias("_clean")).select(
        *[(F.col("_clean") if c == text else F.col("_row")[c]).alias(c) for c in docs.columns])
