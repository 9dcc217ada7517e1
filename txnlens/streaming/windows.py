"""Drift by window over an input that ends: late rows are counted and the last windows are closed.

Rows that arrive are observed metrics of the stream, which a listener stores for each micro-batch under its number, so a
repeated micro-batch replaces its own figures. Windows still open when the input is used up are read from the query's
state store. What arrived, less what the windows hold, came too late and was dropped.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from txnlens.operators.drift import JS_LIMIT
from txnlens.session import materialize
from txnlens.streaming.jobs import INTAKE, stream_drift_windows, window_distances

#: Number of the output folder of the windows that were open at the end.
CLOSING = -1
_END_WAIT_SECONDS = 600


class IntakeListener(StreamingQueryListener):
    """Stores the observed intake of one query's micro-batches: (feature, n) under ``folder/batch=N``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.run_id: str | None = None
        self.ended = threading.Event()
        self.failure: Exception | None = None
        self._early: list = []

    def follow(self, run_id: str) -> None:
        self.run_id = str(run_id)

    def onQueryStarted(self, event) -> None:  # noqa: N802
        # one listener per run: the first query started after it was added is its own
        self.run_id = self.run_id or str(event.runId)

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        if str(p.runId) != self.run_id or INTAKE not in p.observedMetrics:
            return
        rows = [(c, int(n)) for c, n in p.observedMetrics[INTAKE].asDict().items()]
        try:
            self.spark.createDataFrame(rows, "feature string, n bigint").coalesce(1) \
                .write.mode("overwrite").parquet(f"{self.folder}/batch={p.batchId}")
        except Exception as error:  # raised again in the thread that waits
            self.failure = error

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        if str(event.runId) == self.run_id:
            self.ended.set()


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(window, feature, value, n) of the windows that the query's state still holds."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select("key.window", "key.feature", "key.value", F.col("value.count").alias("n"))


def drift_windows_to_end(rows: DataFrame, reference: DataFrame, columns, out: str, checkpoint: str,
                         time: str = "datetime", width: str = "1 day", delay: str = "1 day",
                         limit: float = JS_LIMIT, finished: bool = True) -> tuple[DataFrame, DataFrame]:
    """Work off the input; (windows, intake), where intake holds (feature, arrived, counted, waiting, late).

    With ``finished`` the windows still open are closed and written too (``batch`` -1); a later run that brings more rows
    replaces them. Without it they wait, and their rows are ``waiting``. Rows without a value or time are in neither.
    """
    spark = rows.sparkSession
    intake = f"{out}-intake"
    listener = IntakeListener(spark, intake)
    spark.streams.addListener(listener)
    try:
        query = stream_drift_windows(rows.where(F.col(time).isNotNull()), reference, columns, out, checkpoint, time, width,
                                     delay, limit)
        listener.follow(query.runId)
        query.awaitTermination()
        if not listener.ended.wait(_END_WAIT_SECONDS):
            raise TimeoutError("the query's last progress did not arrive")
    finally:
        spark.streams.removeListener(listener)
    if listener.failure is not None:
        raise listener.failure
    left = materialize(open_windows(spark, checkpoint), "open")
    closing = window_distances(left if finished else left.limit(0), reference, limit)
    closing.write.mode("overwrite").parquet(f"{out}/batch={CLOSING}")
    windows = spark.read.parquet(out)
    arrived = spark.read.parquet(intake).groupBy("feature").agg(F.sum("n").alias("arrived"))
    counted = windows.groupBy("feature").agg(F.sum("n").alias("counted"))
    waiting = left.groupBy("feature").agg(F.sum(F.lit(0) if finished else F.col("n")).alias("waiting"))
    none = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    balance = arrived.join(counted, "feature", "left").join(waiting, "feature", "left").select(
        "feature", "arrived", none("counted"), none("waiting"))  # one row a column
    return windows, balance.withColumn("late", F.col("arrived") - F.col("counted") - F.col("waiting"))
