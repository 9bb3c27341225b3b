"""The given tables, and versions of them with the dirt and the holes the operators deal with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def dirty_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with ``z_`` or ``<`` before the priority and money written as text, some of it unreadable."""
    priority = F.concat(F.when(F.col("o_orderkey") % 3 == 0, "<").otherwise("z_"), F.col("o_orderpriority"))
    money = F.when(F.col("o_orderkey") % 50 == 0, "n/a").otherwise(
        F.concat(F.lit("$"), F.format_number("o_totalprice", 2)))
    return table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", priority.alias("o_orderpriority"), money.alias("o_totalprice"), "o_orderstatus",
        "o_orderdate")


DIRTY_ORDERS_SQL = """
    SELECT o_orderkey, o_custkey,
           CASE WHEN o_orderkey % 3 = 0 THEN '<' ELSE 'z_' END || o_orderpriority AS o_orderpriority,
           CASE WHEN o_orderkey % 50 = 0 THEN 'n/a' ELSE format('${:,.2f}', o_totalprice) END AS o_totalprice,
           o_orderstatus, o_orderdate
    FROM orders"""


def accounts(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with NULL balances and NULL segments in places."""
    return table(spark, folder, "customer").select(
        "c_custkey",
        F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal")).alias("c_acctbal"),
        F.when(F.col("c_custkey") % 11 != 0, F.col("c_mktsegment")).alias("c_mktsegment"))


ACCOUNTS_SQL = """
    SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS c_acctbal,
           CASE WHEN c_custkey % 11 <> 0 THEN c_mktsegment END AS c_mktsegment
    FROM customer"""
