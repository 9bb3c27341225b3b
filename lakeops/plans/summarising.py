"""Queries over group-by summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.functions import text
from lakeops.operators.aggregates import count_by, summary_columns
from lakeops.operators.filters import filter_table
from lakeops.plans.tables import ACCOUNTS_SQL, DIRTY_ORDERS_SQL, accounts, dirty_orders, table

MEAN_ABOVE = 250_000


def count_by_key(spark, folder):
    return count_by(table(spark, folder, "lineitem"), ["l_returnflag"], "n")


def count_by_two_keys(spark, folder):
    counts = count_by(table(spark, folder, "orders"), ["o_orderpriority", "o_orderstatus"], "n")
    return counts.orderBy(F.col("n").desc(), "o_orderpriority", "o_orderstatus")


def mean_by_key(spark, folder):
    accounts(spark, folder).createOrReplaceTempView("lakeops_accounts")
    low = filter_table(spark, "lakeops_accounts", "c_acctbal", "<=", 5000)
    low.createOrReplaceTempView("lakeops_low_accounts")
    return spark.sql("""SELECT c_mktsegment, round(mean(c_acctbal), 2) AS mean_acctbal
                        FROM lakeops_low_accounts GROUP BY c_mktsegment""")


def multi_agg(spark, folder):
    return table(spark, folder, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_extendedprice"), 2).alias("total_price"),
        F.round(F.mean("l_quantity"), 2).alias("mean_quantity"),
        F.round(F.max("l_linenumber"), 2).alias("max_line"),
        F.count("*").alias("members"))


def agg_from_list(spark, folder):
    columns = summary_columns({"l_extendedprice": "total_price"}, {"l_quantity": "mean_quantity"},
                              {"l_linenumber": "max_line"}, "members")
    return table(spark, folder, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(*columns)


def clean_group_having(spark, folder):
    """Clean, summarise and keep the groups with a high mean, in one chain."""
    columns = summary_columns({"o_totalprice": "total_price"}, {"o_totalprice": "mean_price"},
                              {"o_custkey": "max_custkey"}, "members")
    return (text.clean_columns(dirty_orders(spark, folder), {"o_orderpriority": text.PREFIX_OR_LESS_THAN},
                               ["o_totalprice"])
            .groupBy("o_orderpriority").agg(*columns).filter(F.col("mean_price") > MEAN_ABOVE))


QUERIES = {f.__name__: f for f in (
    count_by_key, count_by_two_keys, mean_by_key, multi_agg, agg_from_list, clean_group_having)}

_MULTI = """
    SELECT l_returnflag, l_linestatus, round(sum(l_extendedprice), 2) AS total_price,
           round(avg(l_quantity), 2) AS mean_quantity, max(l_linenumber) AS max_line, count(*) AS members
    FROM lineitem GROUP BY l_returnflag, l_linestatus"""

ORACLES = {
    "count_by_key": "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY l_returnflag",
    "count_by_two_keys": """
        SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders
        GROUP BY o_orderpriority, o_orderstatus ORDER BY n DESC, o_orderpriority, o_orderstatus""",
    "mean_by_key": f"""
        SELECT c_mktsegment, round(avg(c_acctbal), 2) AS mean_acctbal FROM ({ACCOUNTS_SQL})
        WHERE c_acctbal <= 5000 GROUP BY c_mktsegment""",
    "multi_agg": _MULTI,
    "agg_from_list": _MULTI,
    "clean_group_having": f"""
        SELECT * FROM (
            SELECT regexp_replace(o_orderpriority, 'z_|<', '', 'g') AS o_orderpriority,
                   round(sum(TRY_CAST(regexp_replace(o_totalprice, '[$,]', '', 'g') AS DOUBLE)), 2) AS total_price,
                   round(avg(TRY_CAST(regexp_replace(o_totalprice, '[$,]', '', 'g') AS DOUBLE)), 2) AS mean_price,
                   max(o_custkey) AS max_custkey, count(*) AS members
            FROM ({DIRTY_ORDERS_SQL}) GROUP BY 1)
        WHERE mean_price > {MEAN_ABOVE}""",
}
