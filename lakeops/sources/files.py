"""Files under a table, and their compaction."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, functions as F

BYTES_PER_MEGABYTE = 1_000_000


def bytes_to_megabytes(size: float) -> float:
    return round(size / BYTES_PER_MEGABYTE, 2)


def megabytes_to_bytes(megabytes: float) -> float:
    return megabytes * BYTES_PER_MEGABYTE


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Name, bytes and megabytes of every parquet file below ``path``; contents are not read."""
    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
               .load(path).select("path", "length"))
    return (listing.withColumn("name", F.element_at(F.split("path", "/"), -1))
            .filter(F.contains(F.col("name"), F.lit("parquet")))
            .select("path", "name", F.col("length").alias("bytes"),
                    F.round(F.col("length") / BYTES_PER_MEGABYTE, 2).alias("megabytes")))


def count_files(spark: SparkSession, path: str) -> int:
    return file_inventory(spark, path).count()


def size_of(spark: SparkSession, path: str) -> tuple[int, int]:
    """(files, bytes) below ``path``."""
    row = file_inventory(spark, path).agg(F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    return row[0], row[1]


def written_size(spark: SparkSession, path: str) -> tuple[int, int]:
    """(files, bytes) of a folder that Spark has just written, from one listing without a job."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    summary = system.getContentSummary(folder)
    marker = system.exists(spark._jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS"))
    return summary.getFileCount() - int(marker), summary.getLength()


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``, from one listing without a job."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    return sorted(s.getPath().getName() for s in found if s.isDirectory())


def spread_rows(df: DataFrame, files: int) -> DataFrame:
    """Spread rows evenly over ``files`` partitions, so that a write gives that many files."""
    return df.repartition(files)


def balance_for_write(df: DataFrame) -> DataFrame:
    """Let adaptive execution merge small and split large partitions just before a write."""
    return df.hint("rebalance")


def merge_files(df: DataFrame, total_bytes: int, target_bytes: int) -> DataFrame:
    """Join the scan's partitions into about ``total_bytes / target_bytes`` ones, without a shuffle."""
    return df.coalesce(files_for(total_bytes, target_bytes))


def files_for(size: int, target_bytes: int = 128 * BYTES_PER_MEGABYTE) -> int:
    """How many files of about ``target_bytes`` hold ``size`` bytes."""
    return max(1, math.ceil(size / target_bytes))


def compact_parquet(spark: SparkSession, source: str, destination: str,
                    target_bytes: int = 128 * BYTES_PER_MEGABYTE) -> str:
    """The folder to read afterwards: ``destination`` with the rows in few files, or ``source``, left as it is,
    if its files are few already."""
    files, size = size_of(spark, source)
    if files <= files_for(size, target_bytes):
        return source
    merge_files(spark.read.parquet(source), size, target_bytes).write.mode("errorifexists").parquet(destination)
    return destination
