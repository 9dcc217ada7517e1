"""Streaming forms of scoring, categorical drift and validation over a growing folder of files."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from txnlens.operators.drift import JS_LIMIT, js_distances
from txnlens.operators.quality import UNIQUE, Rule, run_suite
from txnlens.operators.scoring import score
from txnlens.plans import preprocess
from txnlens.session import materialize
from txnlens.streaming.uniqueness import stream_uniqueness

#: Name of the observed metrics of drift windows: rows that arrived with a value, by column.
INTAKE = "intake"


def stream_score(rows: DataFrame, fitted: preprocess.Fitted, model: PipelineModel, out: str,
                 checkpoint: str) -> StreamingQuery:
    """Prepare and score arriving rows and append them to a Parquet folder, each exactly once."""
    scored = score(preprocess.apply(rows, fitted), model)
    return (scored.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start())


def window_counts(rows: DataFrame, columns, time: str, width: str, delay: str) -> DataFrame:
    """(window, feature, value, n) of closed event-time windows; the state holds counts only."""
    text = rows.select(time, *[F.col(c).cast("string").alias(c) for c in columns])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in columns]))
    long = (text.withWatermark(time, delay).select(time, pairs.alias("p"))
            .select(time, "p.feature", "p.value").where("value is not null"))
    return long.groupBy(F.window(time, width), "feature", "value").agg(F.count(F.lit(1)).alias("n"))


def window_distances(counts: DataFrame, reference: DataFrame, limit: float) -> DataFrame:
    """(window_start, window_end, feature, distance, n, alert) from (window, feature, value, n) of whole windows."""
    parts = counts.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                          "feature", "value", "n")
    by = ["window_start", "window_end"]
    size = parts.groupBy(*by, "feature").agg(F.sum("n").alias("n"))
    scored = js_distances(parts, reference, by).join(size, [*by, "feature"])
    return scored.withColumn("alert", F.col("distance") > limit)


def stream_drift_windows(rows: DataFrame, reference: DataFrame, columns, out: str, checkpoint: str,
                         time: str = "datetime", width: str = "1 day", delay: str = "1 day",
                         limit: float = JS_LIMIT) -> StreamingQuery:
    """Jensen-Shannon distance of each closed window from stored reference shares.

    Append mode hands over all values of a window in one micro-batch, so the distance is taken there. See
    :mod:`txnlens.streaming.windows` for late rows and for the last windows of a finished input.
    """
    def distances(counts: DataFrame, batch_id: int) -> None:
        # stored, since the distances read it twice; one folder per micro-batch: a repeated batch replaces its own output
        scored = window_distances(materialize(counts, "closed"), reference, limit)
        scored.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    watched = rows.observe(INTAKE, *[F.count(c).alias(c) for c in columns])
    return (window_counts(watched, columns, time, width, delay).writeStream.outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(distances).start())


class Running:
    """Streaming queries that belong together."""

    def __init__(self, queries: list[StreamingQuery]):
        self.queries = queries

    def awaitTermination(self) -> None:  # noqa: N802  (as of a single query)
        for q in self.queries:
            q.awaitTermination()

    def stop(self) -> None:
        for q in self.queries:
            q.stop()


def stream_expectations(rows: DataFrame, rules: list[Rule], out: str, checkpoint: str) -> Running:
    """Run a suite on every micro-batch and store its report under the batch number.

    Uniqueness is judged over the whole stream by a second query, under ``out`` with ``-unique`` added (see
    :mod:`txnlens.streaming.uniqueness`).
    """
    each = [r for r in rules if r.expectation != UNIQUE]
    whole = [r for r in rules if r.expectation == UNIQUE]

    def report(batch: DataFrame, batch_id: int) -> None:
        run_suite(batch, each).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    started = []
    if each:
        started.append(rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
                       .foreachBatch(report).start())
    if whole:
        started.append(stream_uniqueness(rows, whole, f"{out}-unique", f"{checkpoint}-unique"))
    return Running(started)
