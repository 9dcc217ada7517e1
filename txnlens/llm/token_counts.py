"""Exact token counts for every context limit from one histogram of encoded lengths.

Each text is encoded whole; batches hand on only (length, documents). The histogram has one row for each distinct
length, however many documents there are, and sums from its two ends answer totals, quantiles and truncated totals.
Null and empty texts have length 0; an empty table has an empty histogram; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: A public byte-level vocabulary: a file of ranks, read by each Python worker.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the splitting pattern that belongs to this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Lengths that share one partition of the running sums.
RANGE = 4096

_encoders: dict = {}


def encoder(path: str):
    """The tokenizer of a rank file, kept by the Python worker."""
    if path not in _encoders:
        import base64

        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        _encoders[path] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


def length_histogram(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(n_tokens, n_docs): documents by encoded length."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode_ordinary
        seen: Counter[int] = Counter()
        for batch in batches:
            for value in batch.column(0):
                whole = value.as_py()
                seen[len(encode(whole)) if whole else 0] += 1
        yield pa.RecordBatch.from_pydict({"n_tokens": pa.array(list(seen.keys()), pa.int64()),
                                          "n": pa.array(list(seen.values()), pa.int64())})
    parts = docs.select(F.col(text).cast("string").alias("t")).mapInArrow(count, "n_tokens bigint, n bigint")
    return parts.groupBy("n_tokens").agg(F.sum("n").alias("n_docs"))


def context_table(histogram: DataFrame) -> DataFrame:
    """For every length L as a context limit: documents and tokens up to L, beyond L, cut to L, and L's rank.

    Running sums are taken inside ranges of lengths and shifted by the totals of the ranges below, so no single task
    holds the histogram. ``quantile`` is the share of documents of at most L tokens.
    """
    h = histogram.select(F.col("n_tokens").cast("bigint"), F.col("n_docs").cast("bigint"),
                         (F.col("n_tokens") * F.col("n_docs")).alias("tokens"),
                         F.floor(F.col("n_tokens") / RANGE).alias("range"))
    totals = h.groupBy("range").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    below = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    shifts = totals.select("range", F.coalesce(F.sum("d").over(below), F.lit(0)).alias("d0"),
                           F.coalesce(F.sum("t").over(below), F.lit(0)).alias("t0"),
                           F.sum("d").over(over).alias("d_all"), F.sum("t").over(over).alias("t_all"))
    inside = Window.partitionBy("range").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    run = h.select("*", F.sum("n_docs").over(inside).alias("d_in"), F.sum("tokens").over(inside).alias("t_in"))
    out = run.join(shifts, "range").select(
        F.col("n_tokens").alias("context"), "n_docs", "tokens",
        (F.col("d0") + F.col("d_in")).alias("docs_within"), (F.col("t0") + F.col("t_in")).alias("tokens_within"),
        "d_all", "t_all")
    beyond = F.col("d_all") - F.col("docs_within")
    return out.select(
        "context", "n_docs", "tokens", "docs_within", "tokens_within", beyond.alias("docs_beyond"),
        (F.col("tokens_within") + F.col("context") * beyond).alias("tokens_truncated"),
        (F.col("t_all") - F.col("tokens_within") - F.col("context") * beyond).alias("tokens_lost"),
        F.col("t_all").alias("tokens_total"), (F.col("docs_within") / F.col("d_all")).alias("quantile"))


def totals_at(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """Documents, all tokens and tokens kept at each of the given context limits, in one pass over the histogram."""
    spark = histogram.sparkSession
    rows = histogram.select(F.explode(F.array(*[F.lit(int(x)) for x in limits])).alias("context"), "n_tokens", "n_docs")
    got = rows.groupBy("context").agg(
        F.sum("n_docs").alias("n_docs"), F.sum(F.col("n_tokens") * F.col("n_docs")).alias("tokens_total"),
        F.sum(F.least("n_tokens", "context") * F.col("n_docs")).alias("tokens_truncated"),
        F.sum(F.when(F.col("n_tokens") > F.col("context"), F.col("n_docs")).otherwise(0)).alias("docs_beyond"))
    wanted = spark.createDataFrame([(int(x),) for x in limits], "context int")
    return wanted.join(got, "context", "left").fillna(0)


def quantiles(histogram: DataFrame, shares: list[float]) -> DataFrame:
    """The smallest length that at least each given share of the documents does not exceed."""
    table = context_table(histogram)
    return table.select(F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("share"), "context", "quantile") \
        .where(F.col("quantile") >= F.col("share") - 1e-12).groupBy("share").agg(F.min("context").alias("n_tokens"))
