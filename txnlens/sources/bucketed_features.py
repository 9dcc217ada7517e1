"""Feature tables bucketed and sorted by their key: merging, the latest rows and the key checks shuffle nothing stored.

Every batch is dealt by the key once, when it arrives. All groups have the same number of buckets, so equal keys of two
groups, or of a new batch and all earlier ones, lie in buckets of one number and are joined where they are.
"""

from __future__ import annotations

import time
import uuid
from functools import reduce
from hashlib import md5

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from txnlens.roles import EVENT_TIME, KEY
from txnlens.session import scratch_path
from txnlens.sources.feature_tables import BATCH

REPLACE, REFUSE = "replace", "refuse"


class BucketedFeatures:
    """Appended batches under ``root/name=.../version=.../buckets=...``; the number of buckets is part of the table.

    Choose ``buckets`` so that one bucket of the largest group fits a task; tables of different numbers don't meet.
    """

    def __init__(self, spark: SparkSession, root: str, key: str = KEY, event_time: str = EVENT_TIME, buckets: int = 64):
        self.spark, self.root, self.key, self.event_time = spark, root.rstrip("/"), key, event_time
        self.buckets = buckets

    def path(self, name: str, version: int) -> str:
        return f"{self.root}/name={name}/version={version}/buckets={self.buckets}"

    def _save(self, df: DataFrame, table: str, path: str) -> DataFrame:
        df.write.format("parquet").mode("append").bucketBy(self.buckets, self.key).sortBy(self.key) \
            .option("path", path).saveAsTable(table)
        return self.spark.table(table)

    def _table(self, name: str, version: int) -> str:
        return f"features_{md5(self.path(name, version).encode()).hexdigest()}"

    def open(self, name: str, version: int = 1) -> DataFrame | None:
        """All rows with their batch; a table that another session wrote is registered anew. None if there is none."""
        table, path = self._table(name, version), self.path(name, version)
        if not self.spark.catalog.tableExists(table):
            try:
                fields = self.spark.read.parquet(path).schema.fields
            except AnalysisException as error:
                if error.getCondition() != "PATH_NOT_FOUND":
                    raise
                return None
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
            self.spark.sql(f"create table {table} ({columns}) using parquet clustered by (`{self.key}`) "
                           f"sorted by (`{self.key}`) into {self.buckets} buckets location '{path}'")
        return self.spark.table(table)

    def write(self, df: DataFrame, name: str, version: int = 1, repeats: str = REPLACE) -> int:
        """Append one batch and return its rows. Null keys and keys that the batch repeats are refused.

        ``repeats`` says what holds for keys of earlier batches: ``replace`` (the later event is the current row) or
        ``refuse``. The batch is dealt into buckets and stored aside; what fails a check never reaches the table.
        """
        if repeats not in (REPLACE, REFUSE):
            raise ValueError(f"repeats is {REPLACE} or {REFUSE}, not {repeats}")
        known = self.open(name, version)
        aside = f"staged_{uuid.uuid4().hex}"
        dealt = df.withColumn(BATCH, F.lit(time.time_ns())).repartition(self.buckets, self.key)
        try:
            staged = self._save(dealt, aside, scratch_path(self.spark, "staged"))
            found = self.key_counts(staged)
            if found["bad"]:
                raise ValueError(f"{name}: {found['bad']} keys are null or repeated in the batch")
            if repeats == REFUSE and known is not None:
                again = self.known_keys(staged, known).count()
                if again:
                    raise ValueError(f"{name}: {again} keys are in an earlier batch")
            self._save(staged, self._table(name, version), self.path(name, version))
        finally:
            self.spark.sql(f"drop table if exists {aside}")
        return found["n"]

    def key_counts(self, staged: DataFrame):
        keys = staged.groupBy(self.key).agg(F.count(F.lit(1)).alias("_times"))
        return keys.agg(F.coalesce(F.sum("_times"), F.lit(0)).alias("n"),
                        F.count_if((F.col("_times") > 1) | F.col(self.key).isNull()).alias("bad")).first()

    def known_keys(self, staged: DataFrame, known: DataFrame) -> DataFrame:
        """The rows of a stored batch whose key an earlier batch has, found bucket by bucket."""
        return staged.join(known.select(self.key), self.key, "left_semi")

    def read(self, name: str, version: int = 1) -> DataFrame:
        """The latest row of each key by event time, then by batch."""
        raw = self.open(name, version)
        if raw is None:
            raise ValueError(f"no feature table {name}, version {version}, of {self.buckets} buckets")
        if raw.select(BATCH).distinct().limit(2).count() < 2:
            return raw.drop(BATCH)
        rest = [c for c in raw.columns if c not in (self.key, BATCH)]
        latest = raw.groupBy(self.key).agg(F.max_by(F.struct(*rest), F.struct(self.event_time, BATCH)).alias("row"))
        return latest.select(self.key, "row.*")

    def merge(self, names: list[str], version: int = 1) -> DataFrame:
        """Left joins of the groups' current rows on the key; a column both sides have is taken from the left."""
        def join(left: DataFrame, right: DataFrame) -> DataFrame:
            shared = [c for c in right.columns if c in left.columns and c != self.key]
            return left.join(right.drop(*shared), self.key, "left")
        return reduce(join, [self.read(n, version) for n in names])
