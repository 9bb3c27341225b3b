"""Catalog tables: save, append, create from a query, repeated inserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.operators.changes import check_append
from lakeops.session import materialize


# Fixed value: what database names start with.
DATABASE_PREFIX = "workshop_"


def database_name(initials: str) -> str:
    """``workshop_<initials>``; the initials must be exactly one word."""
    if len(initials.split()) != 1:
        raise ValueError("give exactly one word")
    return f"{DATABASE_PREFIX}{initials}"


def use_database(spark: SparkSession, name: str) -> None:
    spark.sql("CREATE DATABASE IF NOT EXISTS IDENTIFIER(:name)", args={"name": name})
    spark.catalog.setCurrentDatabase(name)


def save_table(df: DataFrame, table: str) -> DataFrame:
    """Write ``df`` as a parquet table, replacing an older one, and return the table."""
    df.write.mode("overwrite").format("parquet").saveAsTable(table)
    return df.sparkSession.table(table)


def append_to_table(df: DataFrame, table: str) -> DataFrame:
    """Append rows with exactly the table's columns and types."""
    spark = df.sparkSession
    existing = spark.table(table)
    check_append(existing, df)
    df.select(*existing.columns).write.mode("append").format("parquet").saveAsTable(table)
    return spark.table(table)


def create_table_as(spark: SparkSession, table: str, source: str, columns: list[str]) -> DataFrame:
    """``CREATE TABLE ... AS SELECT`` of some columns of a table or view, replacing an older table."""
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", args={"name": table})
    chosen = ", ".join(f"`{c}`" for c in columns)
    spark.sql(f"CREATE TABLE IDENTIFIER(:name) USING parquet AS SELECT {chosen} FROM IDENTIFIER(:source)",
              args={"name": table, "source": source})
    return spark.table(table)


def insert_batches(spark: SparkSession, table: str, order: list[str], sample_rows: int = 1000,
                   batches: int = 50) -> DataFrame:
    """Insert the same first rows of a table into it ``batches`` times, one small insert each.

    The sample is fixed before the first insert: a lazy or cached sample of the table could be
    computed again after it, from more rows.
    """
    target = spark.table(table)
    sample = materialize(target.orderBy(*[F.col(c) for c in order]).limit(sample_rows))
    sample.createOrReplaceTempView("lakeops_insert_sample")
    for _ in range(batches):
        spark.sql("INSERT INTO IDENTIFIER(:name) SELECT * FROM lakeops_insert_sample", args={"name": table})
    spark.catalog.dropTempView("lakeops_insert_sample")
    return spark.table(table)


def drop_tables(spark: SparkSession, tables: list[str], database: str | None = None) -> None:
    """Drop tables, and then the database if given; what does not exist is skipped."""
    for table in tables:
        spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", args={"name": table})
    if database:
        spark.sql("DROP DATABASE IF EXISTS IDENTIFIER(:name)", args={"name": database})
