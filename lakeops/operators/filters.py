"""Filters by SQL text with bound parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

COMPARISONS = ("=", "<>", "<", "<=", ">", ">=")


def filter_table(spark: SparkSession, table: str, column: str, comparison: str, value: object) -> DataFrame:
    """Rows of a table or view where ``column comparison value`` holds.

    Names and values are bound, never pasted into the text; only the comparison sign is, from a
    fixed list.
    """
    if comparison not in COMPARISONS:
        raise ValueError(f"comparison must be one of {COMPARISONS}")
    return spark.sql(f"SELECT * FROM IDENTIFIER(:source) WHERE IDENTIFIER(:name) {comparison} :value",
                     args={"source": table, "name": column, "value": value})
