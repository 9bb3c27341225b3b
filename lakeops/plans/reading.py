"""Queries over sources, sinks, catalog tables and files."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType

from lakeops.operators.expand import duplicate_rows
from lakeops.operators.ordering import top_rows
from lakeops.operators.versions import VersionedTable
from lakeops.plans.tables import table
from lakeops.session import scratch_database, scratch_path
from lakeops.sources import csv, files, tables

PART_COLUMNS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
PART_SCHEMA = csv.build_schema(PART_COLUMNS, {
    LongType(): ["p_partkey"], StringType(): ["p_name", "p_brand", "p_type"], IntegerType(): ["p_size"],
    DoubleType(): ["p_retailprice"]})
CUSTOMER_COLUMNS = ["c_custkey", "c_acctbal", "c_mktsegment"]
INSERT_BATCHES, INSERT_ROWS = 50, 1000
TARGET_BYTES = 128 * files.BYTES_PER_MEGABYTE
# A table in this many times the files it needs, and some more, stands for one written in small pieces.
TIMES_TOO_MANY, AT_LEAST = 4, 16


def _in_many_files(spark, df, name, target_bytes):
    """Write ``df`` in several times the files that its bytes need; returns the folder and the number asked for."""
    once = scratch_path(spark, name)
    df.write.parquet(once)
    _, size = files.size_of(spark, once)
    many, count = scratch_path(spark, f"{name}_many"), AT_LEAST + TIMES_TOO_MANY * files.files_for(size, target_bytes)
    files.spread_rows(spark.read.parquet(once), count).write.parquet(many)
    return many, count


def _part_as_csv(spark, folder):
    path = scratch_path(spark, "part_csv")
    table(spark, folder, "part").select(*PART_COLUMNS).write.option("header", True).csv(path)
    return path


def csv_infer_scan(spark, folder):
    return csv.read_csv(spark, _part_as_csv(spark, folder))


def csv_schema_scan(spark, folder):
    return csv.read_csv(spark, _part_as_csv(spark, folder), PART_SCHEMA)


def save_overwrite(spark, folder):
    name = f"{scratch_database(spark, 'save')}.customer"
    customer = table(spark, folder, "customer").select(*CUSTOMER_COLUMNS)
    tables.save_table(customer.filter("c_custkey < 10"), name)
    return tables.save_table(customer, name)


def ctas_projection(spark, folder):
    table(spark, folder, "customer").createOrReplaceTempView("lakeops_customer")
    name = f"{scratch_database(spark, 'ctas')}.customer"
    return tables.create_table_as(spark, name, "lakeops_customer", CUSTOMER_COLUMNS)


def append_rows(spark, folder):
    name = f"{scratch_database(spark, 'append')}.supplier"
    supplier = table(spark, folder, "supplier")
    tables.save_table(supplier, name)
    return tables.append_to_table(supplier.withColumn("s_suppkey", -1 - F.col("s_suppkey")), name)


def insert_accumulate(spark, folder):
    name = f"{scratch_database(spark, 'insert')}.customer"
    tables.save_table(table(spark, folder, "customer").select(*CUSTOMER_COLUMNS), name)
    grown = tables.insert_batches(spark, name, ["c_custkey"], INSERT_ROWS, INSERT_BATCHES)
    return grown.groupBy("c_custkey").agg(F.count(F.lit(1)).alias("copies"))


def repartition_rows(spark, folder):
    return files.spread_rows(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), 16)


def table_head(spark, folder):
    return top_rows(table(spark, folder, "orders"), [F.col("o_orderkey")], 5)


def top_desc(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return top_rows(orders, [F.col("o_totalprice").desc(), F.col("o_orderkey")], 100)


def count_all(spark, folder):
    return table(spark, folder, "lineitem").agg(F.count(F.lit(1)).alias("n"))


def file_inventory(spark, folder):
    path, count = _in_many_files(spark, table(spark, folder, "orders"), "orders_files", TARGET_BYTES)
    inventory = files.file_inventory(spark, path)
    return inventory.agg((F.count(F.lit(1)) == count).alias("all_listed"), F.min(F.col("bytes") > 0).alias("all_filled"),
                         F.min(F.abs(F.col("megabytes") - F.col("bytes") / 1e6) <= 0.005).alias("sizes_agree"))


def compact_rows(spark, folder, target_bytes=TARGET_BYTES):
    many, _ = _in_many_files(spark, table(spark, folder, "orders"), "orders", target_bytes)
    few = files.compact_parquet(spark, many, scratch_path(spark, "few_files"), target_bytes)
    _, size = files.size_of(spark, many)
    enough = files.count_files(spark, few) <= files.files_for(size, target_bytes)
    return spark.read.parquet(few).groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    ).withColumn("few_files", F.lit(enough or few == many))


def balanced_write(spark, folder):
    """Many copies in many small files, evened out just before they are written again."""
    copies = duplicate_rows(table(spark, folder, "customer").select(*CUSTOMER_COLUMNS), 20, "c_custkey")
    many, _ = _in_many_files(spark, copies, "copies", TARGET_BYTES)
    path = scratch_path(spark, "balanced")
    files.balance_for_write(spark.read.parquet(many)).write.parquet(path)
    return spark.read.parquet(path).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "fewer_files", F.lit(files.count_files(spark, path) < files.count_files(spark, many)))


def compact_inserts(spark, folder):
    """Fifty inserts, each its own version, then a compaction: the history and the copies per row of the last version."""
    customer = table(spark, folder, "customer").select(*CUSTOMER_COLUMNS)
    versioned = VersionedTable.create(spark, f"{scratch_database(spark, 'inserts')}.customer", customer)
    some = customer.orderBy("c_custkey").limit(INSERT_ROWS)
    for _ in range(INSERT_BATCHES):
        versioned.append(some)
    versioned.compact()
    copies = versioned.read().groupBy("c_custkey").count().groupBy(F.col("count").alias("n")).agg(
        F.count(F.lit(1)).alias("keys")).select(F.lit("copies").alias("what"), F.col("n"), "keys")
    operations = versioned.history().groupBy(F.col("operation").alias("what")).agg(
        F.min("version").cast("bigint").alias("n"), F.count(F.lit(1)).alias("keys"))
    return copies.unionByName(operations)


QUERIES = {f.__name__: f for f in (
    csv_infer_scan, csv_schema_scan, save_overwrite, ctas_projection, append_rows, insert_accumulate,
    repartition_rows, table_head, top_desc, count_all, file_inventory, compact_rows,
    balanced_write, compact_inserts)}

ORACLES = {
    "csv_infer_scan": "SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part",
    "csv_schema_scan": "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part",
    "save_overwrite": "SELECT c_custkey, c_acctbal, c_mktsegment FROM customer",
    "ctas_projection": "SELECT c_custkey, c_acctbal, c_mktsegment FROM customer",
    "append_rows": """
        SELECT * FROM supplier
        UNION ALL SELECT -1 - s_suppkey AS s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier""",
    "insert_accumulate": f"""
        SELECT c_custkey,
               CAST(CASE WHEN row_number() OVER (ORDER BY c_custkey) <= {INSERT_ROWS} THEN 1 + {INSERT_BATCHES}
                         ELSE 1 END AS BIGINT) AS copies
        FROM customer""",
    "repartition_rows": "SELECT o_orderkey, o_totalprice FROM orders",
    "table_head": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5",
    "top_desc": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100",
    "count_all": "SELECT count(*) AS n FROM lineitem",
    "file_inventory": "SELECT TRUE AS all_listed, TRUE AS all_filled, TRUE AS sizes_agree",
    "balanced_write": """
        SELECT c_mktsegment, count(*) * 20 AS n, TRUE AS fewer_files FROM customer GROUP BY c_mktsegment""",
    "compact_rows": """
        SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total, TRUE AS few_files
        FROM orders GROUP BY o_orderpriority""",
    "compact_inserts": f"""
        SELECT 'copies' AS what, CAST(n AS BIGINT) AS n, count(*) AS keys
        FROM (SELECT CASE WHEN row_number() OVER (ORDER BY c_custkey) <= {INSERT_ROWS} THEN 1 + {INSERT_BATCHES}
                          ELSE 1 END AS n FROM customer) GROUP BY n
        UNION ALL SELECT 'create', 0, 1 UNION ALL SELECT 'append', 1, {INSERT_BATCHES}
        UNION ALL SELECT 'compact', {INSERT_BATCHES} + 1, 1""",
}
