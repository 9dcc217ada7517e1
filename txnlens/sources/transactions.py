"""Raw transactions as delimited text with an explicit schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RAW_SCHEMA = """trans_date_trans_time string, cc_num bigint, merchant string, category string, amt double,
    first string, last string, gender string, street string, city string, state string, zip string, lat double,
    long double, city_pop bigint, job string, dob string, trans_num string, unix_time bigint, merch_lat double,
    merch_long double, is_fraud bigint, merch_zipcode string"""


def read_transactions_csv(spark: SparkSession, path: str, schema: str = RAW_SCHEMA, sep: str = ",") -> DataFrame:
    """Codes such as zips are text, so leading zeros survive."""
    return spark.read.schema(schema).option("header", True).option("sep", sep).csv(path)
