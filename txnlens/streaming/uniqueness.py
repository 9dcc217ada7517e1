"""Uniqueness over a whole stream: keys are counted in state that outlives micro-batches and restarts.

Without a limit in time the state is a streaming aggregate, one count a key, so rows of one key are condensed before the
shuffle and no Python runs. With ``keep`` a key is forgotten that long after its last row, when the watermark has passed;
then the state is arbitrary keyed state with an event-time timeout, and its size follows the keys of that stretch of time.

Every micro-batch stores what changed and a report over all rows so far, under its number, so that a repeated micro-batch
replaces its own output. Missing values are counted as elements and never as repeated.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from txnlens.operators.distribution import missing
from txnlens.operators.quality import UNIQUE, Rule, uniqueness_row

#: Missing values need no state; their rows are dealt out so that they don't meet in one task.
_SPREAD = 64
_CHANGES = "rule int, kind string, value string, n bigint"
_DELTAS = "rule int, value string, n bigint, n_missing bigint, unexpected bigint"


def _checked(rules: list[Rule]) -> None:
    wrong = sorted({r.expectation for r in rules} - {UNIQUE})
    if wrong:
        raise ValueError(f"not a uniqueness rule: {wrong}")


def key_counts(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """(rule, kind, value, n): rows, missing values and each value's rows, over all that has arrived."""
    parts = []
    for i, r in enumerate(rules):
        gone = missing(rows, r.column)
        parts += [F.struct(F.lit(i).alias("rule"), F.lit("rows").alias("kind"), F.lit(None).cast("string").alias("value")),
                  F.struct(F.lit(i).alias("rule"), F.when(gone, "missing").otherwise("value").alias("kind"),
                           F.when(~gone, F.col(r.column).cast("string")).alias("value"))]
    return rows.select(F.inline(F.array(*parts))).groupBy("rule", "kind", "value").agg(F.count(F.lit(1)).alias("n"))


def _report(totals: DataFrame, rules: list[Rule]) -> DataFrame:
    """Report rows from (rule, n, base, bad)."""
    parts = [uniqueness_row(totals.where(F.col("rule") == i).drop("rule"), i, r) for i, r in enumerate(rules)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _latest(changes: DataFrame) -> DataFrame:
    """Totals from the stored counts: a count only grows, so its largest value is the latest."""
    last = changes.groupBy("rule", "kind", "value").agg(F.max("n").alias("n"))
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0))
    return last.groupBy("rule").agg(of("rows").alias("n"), (of("rows") - of("missing")).alias("base"), of("value").alias("bad"))


def _count_in_state(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState, keep_ms: int) -> Iterator[pd.DataFrame]:
    """One key's rows of a micro-batch, or its timeout: what it adds to rows, missing values and repeated rows."""
    rule, value, _spread = key
    if state.hasTimedOut:
        state.remove()
        return
    n, first, last = 0, 2**62, 0
    for f in frames:
        n += len(f)
        first, last = min(first, int(f["ms"].min())), max(last, int(f["ms"].max()))
    if value is None:
        yield pd.DataFrame({"rule": [rule], "value": [None], "n": [n], "n_missing": [n], "unexpected": [0]})
        return
    before, seen = state.get if state.exists else (0, 0)
    if first - seen > keep_ms:  # its rows came before its timeout was called
        before = 0
    now, last = before + n, max(seen, last)
    state.update((now, last))
    state.setTimeoutTimestamp(max(last + keep_ms, state.getCurrentWatermarkMs() + 1))
    bad = (now if now > 1 else 0) - (before if before > 1 else 0)
    yield pd.DataFrame({"rule": [rule], "value": [value], "n": [n], "n_missing": [0], "unexpected": [bad]})


def key_deltas(rows: DataFrame, rules: list[Rule], time: str, keep: str, delay: str) -> DataFrame:
    """(rule, value, n, n_missing, unexpected): what each key of a micro-batch adds, keys being kept for ``keep``."""
    keep_ms = int(pd.Timedelta(keep).total_seconds() * 1000)
    parts = []
    for i, r in enumerate(rules):
        gone = missing(rows, r.column)
        parts.append(F.struct(F.lit(i).alias("rule"), F.when(~gone, F.col(r.column).cast("string")).alias("value"),
                              F.when(gone, F.pmod(F.xxhash64(time), F.lit(_SPREAD))).otherwise(0).alias("spread")))
    long = rows.withWatermark(time, delay).select(time, F.explode(F.array(*parts)).alias("p")).select(
        time, "p.*", F.unix_millis(F.col(time).cast("timestamp")).alias("ms"))

    def count(key, frames, state):
        return _count_in_state(key, frames, state, keep_ms)

    return long.groupBy("rule", "value", "spread").applyInPandasWithState(
        count, _DELTAS, "n bigint, last bigint", "update", GroupStateTimeout.EventTimeTimeout)


def stream_uniqueness(rows: DataFrame, rules: list[Rule], out: str, checkpoint: str, time: str | None = None,
                      keep: str | None = None, delay: str = "0 seconds") -> StreamingQuery:
    """Judge uniqueness rules over all rows of a stream; reports go to ``out/report/batch=N``.

    ``out/changes`` holds the repeated values with their counts. ``keep`` needs the event time ``time``; rows that are later
    than ``delay`` may come to a key that was forgotten.
    """
    _checked(rules)
    spark = rows.sparkSession
    if keep is not None and time is None:
        raise ValueError("keys can only be forgotten by an event time")

    def store(batch: DataFrame, batch_id: int) -> None:
        if keep is None:
            changes = batch.where((F.col("kind") != "value") | (F.col("n") > 1)).select("rule", "kind", "value", "n")
        else:
            one = batch.groupBy("rule").agg(F.sum("n").alias("rows"), F.sum("n_missing").alias("missing"),
                                            F.sum("unexpected").alias("value"))
            changes = one.unpivot("rule", ["rows", "missing", "value"], "kind", "n") \
                .select(F.col("rule").cast("int").alias("rule"), "kind", F.lit(None).cast("string").alias("value"), "n")
        changes.write.mode("overwrite").parquet(f"{out}/changes/batch={batch_id}")
        so_far = spark.read.schema(_CHANGES + ", batch int").parquet(f"{out}/changes").where(F.col("batch") <= batch_id)
        if keep is None:
            totals = _latest(so_far)
        else:
            of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0))
            totals = so_far.groupBy("rule").agg(of("rows").alias("n"), (of("rows") - of("missing")).alias("base"),
                                                of("value").alias("bad"))
        _report(totals, rules).write.mode("overwrite").parquet(f"{out}/report/batch={batch_id}")

    judged = key_counts(rows, rules) if keep is None else key_deltas(rows, rules, time, keep, delay)
    return (judged.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).foreachBatch(store).start())


def latest_report(spark, out: str) -> DataFrame:
    """The report over all rows so far."""
    every = spark.read.parquet(f"{out}/report")
    last = every.agg(F.max("batch")).first()[0]
    return every.where(F.col("batch") == last).drop("batch")
