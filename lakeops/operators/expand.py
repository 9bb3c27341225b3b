"""One row per array element, and copies of every row."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakeops.functions.arrays import int_range


def explode_range(df: DataFrame, size: int, name: str = "exploded") -> DataFrame:
    """Repeat every row for 0..size-1; no rows at all when ``size`` is 0 or less."""
    return df.withColumn(name, F.explode(int_range(size)))


def duplicate_rows(df: DataFrame, copies: int, key: str, number: str = "exploded",
                   distinct_id: str = "DISTINCT_ID") -> DataFrame:
    """``copies`` of every row with the copy number and the text id ``<key>_<number>``.

    Runs within each task, without a shuffle.
    """
    return explode_range(df, copies, number).withColumn(
        distinct_id, F.concat(F.col(key).cast("string"), F.lit("_"), F.col(number).cast("string")))
