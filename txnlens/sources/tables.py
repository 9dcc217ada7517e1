"""Named stage tables and small report files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

FORMATS = ("parquet", "csv", "json")


@dataclass(frozen=True)
class TableSpec:
    path: str
    format: str = "parquet"
    schema: str | None = None


# Stage tables and where they live under the data root.
STAGE_TABLES = {
    "ingested_data": "02_intermediate/ingested_data",
    "ref_data": "02_intermediate/ref_data",
    "ana_data": "02_intermediate/ana_data",
    "preprocessed_training_data": "03_primary/preprocessed_train_data",
    "preprocessed_batch_data": "03_primary/preprocessed_batch_data",
    "train_data": "05_model_input/train",
    "test_data": "05_model_input/test",
}


class TableCatalog:
    """Tables by name under one root folder; Parquet unless a spec asks for text."""

    def __init__(self, spark: SparkSession, root: str, specs: dict[str, TableSpec] | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.specs = {n: TableSpec(p) for n, p in STAGE_TABLES.items()} | (specs or {})

    def _spec(self, name: str) -> TableSpec:
        if name not in self.specs:
            raise KeyError(f"unknown table {name}")
        spec = self.specs[name]
        if spec.format not in FORMATS:
            raise ValueError(f"unknown format {spec.format}")
        return spec

    def write(self, name: str, df: DataFrame, mode: str = "overwrite") -> DataFrame:
        spec = self._spec(name)
        writer = df.write.mode(mode)
        if spec.format == "csv":
            writer = writer.option("header", True)
        writer.format(spec.format).save(f"{self.root}/{spec.path}")
        return self.read(name)

    def read(self, name: str) -> DataFrame:
        spec = self._spec(name)
        reader = self.spark.read.format(spec.format)
        if spec.schema:
            reader = reader.schema(spec.schema)
        if spec.format == "csv":
            reader = reader.option("header", True)
        return reader.load(f"{self.root}/{spec.path}")


def write_report(df: DataFrame, path: str, format: str = "csv") -> None:
    """A report table, a few rows after aggregation, as one CSV or JSON file."""
    writer = df.coalesce(1).write.mode("overwrite")
    if format == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.json(path)
