"""Text expressions: identifiers, hashes and format checks."""

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType


def id_text(col: str, dtype: DataType) -> Column:
    """An identifier as text; whole floating numbers are printed without a decimal point, others as they are."""
    value = F.col(col)
    if isinstance(dtype, (DoubleType, FloatType)):
        whole = value.try_cast("bigint")
        kept = F.when(~F.isnan(value), value.cast("string"))
        return F.when(whole.cast("double") == value, whole.cast("string")).otherwise(kept)
    return value.cast("string")


def sha256_hex(col: str) -> Column:
    """SHA-256 of the UTF-8 text, null for null."""
    return F.sha2(F.col(col).cast("string"), 256)


def mismatches(col: str, pattern: str) -> Column:
    """1.0 where the text does not match, also where it is missing; else 0.0."""
    return F.coalesce((~F.col(col).cast("string").rlike(pattern)).cast("double"), F.lit(1.0))
