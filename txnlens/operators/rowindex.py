"""A global row number without bringing all rows to one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from txnlens.session import materialize

_LOCAL_BITS = 33


def with_row_index(df: DataFrame, order_by, out: str = "row_index", partitions: int | None = None) -> DataFrame:
    """Number the rows from 0 in the given order.

    Rows are range-partitioned on the whole key, so many equal leading values still spread; each partition
    is sorted and numbered on its own, stored once, and shifted by the sizes of the partitions before it.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    local = materialize(
        df.repartitionByRange(n, *order_by).sortWithinPartitions(*order_by)
        .withColumn("_local", F.monotonically_increasing_id()), "rows")
    # the id holds the partition in its upper bits and the row within it in the lower 33
    part = F.shiftright("_local", _LOCAL_BITS)
    local = local.withColumns({"_part": part, "_row": F.col("_local").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))})
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = local.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))  # one row per partition
    offsets = sizes.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))
    numbered = local.join(F.broadcast(offsets), "_part")
    return numbered.withColumn(out, F.col("_offset") + F.col("_row")).drop("_local", "_part", "_row", "_offset")
