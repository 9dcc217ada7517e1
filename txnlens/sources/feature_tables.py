"""Versioned feature tables: appended Parquet batches under ``root/name=.../version=...``."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from txnlens.operators.profile_states import column_states, merge_states, verified_top
from txnlens.operators.profiling import table_statistics
from txnlens.roles import EVENT_TIME, KEY

BATCH = "batch"


class FeatureTables:
    def __init__(self, spark: SparkSession, root: str, key: str = KEY, event_time: str = EVENT_TIME):
        self.spark, self.root, self.key, self.event_time = spark, root.rstrip("/"), key, event_time

    def path(self, name: str, version: int) -> str:
        return f"{self.root}/name={name}/version={version}"

    def states_path(self, name: str, version: int) -> str:
        return f"{self.root}/states/name={name}/version={version}"

    def write(self, df: DataFrame, name: str, version: int = 1) -> int:
        """Append one batch, creating the table if need be; a batch must not repeat a key. Returns its rows.

        The check and the write are two reads of ``df``; pass a stored table where that is dear. The batch's profile
        state is taken from what was written, and no earlier batch is read.
        """
        keys = df.groupBy(self.key).agg(F.count(F.lit(1)).alias("k"))
        found = keys.agg(F.coalesce(F.sum("k"), F.lit(0)).alias("n"),
                         F.count_if((F.col("k") > 1) | F.col(self.key).isNull()).alias("bad")).first()
        if found["bad"]:
            raise ValueError(f"{name}: {found['bad']} keys are null or repeated in the batch")
        batch = time.time_ns()
        written = f"{self.path(name, version)}/{BATCH}={batch}"
        df.write.mode("append").parquet(written)
        column_states(self.spark.read.schema(df.schema).parquet(written)).write.mode("overwrite") \
            .parquet(f"{self.states_path(name, version)}/{BATCH}={batch}")
        return found["n"]

    def write_all(self, groups: dict[str, DataFrame], config: dict) -> dict[str, int]:
        """Write the groups a configuration knows; the others are skipped."""
        return {key: self.write(df, config[key]["name"], config[key]["version"])
                for key, df in groups.items() if key in config}

    def read(self, name: str, version: int = 1) -> DataFrame:
        """The latest row of each key by event time, then by batch.

        The latest row is picked by an aggregate, so a key with very many versions is condensed before the
        shuffle. A table of one batch has unique keys and is read as it is.
        """
        raw = self.spark.read.parquet(self.path(name, version))
        if raw.select(BATCH).distinct().limit(2).count() < 2:
            return raw.drop(BATCH)
        rest = [c for c in raw.columns if c not in (self.key, BATCH)]
        latest = raw.groupBy(self.key).agg(
            F.max_by(F.struct(*rest), F.struct(self.event_time, BATCH)).alias("row"))
        return latest.select(self.key, "row.*")

    def profile(self, name: str, version: int = 1, verified: bool = False) -> DataFrame:
        """The profile of all appended rows, also of those that later ones replace, merged from the batches' states.

        Counts, bounds, mean and deviation are exact; distinct values, quartiles and the most frequent value are estimates.
        ``verified`` counts the most frequent value exactly, which reads the rows once.
        """
        states = self.spark.read.parquet(self.states_path(name, version)).drop(BATCH)
        merged = merge_states(states)
        if not verified:
            return merged
        rows = self.spark.read.parquet(self.path(name, version)).drop(BATCH)
        return merged.drop("top_value", "top_count").join(verified_top(rows, states), "column_name", "left")

    def statistics(self, name: str, version: int = 1, bins: int = 20) -> dict[str, DataFrame]:
        """Profile, histograms and correlations of the current rows, stored beside the table."""
        stats = table_statistics(self.read(name, version), bins)
        for kind, df in stats.items():
            df.write.mode("overwrite").parquet(f"{self.root}/statistics/name={name}/version={version}/{kind}")
        return {kind: self.spark.read.parquet(f"{self.root}/statistics/name={name}/version={version}/{kind}")
                for kind in stats}
