"""Training-text pipeline over the documents table; each stage is written and read again before the next one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.llm import decontaminate, line_windows, packing, simhash, toxicity
from lakeops.llm.common import table
from lakeops.llm.queries import VOCABULARY
from lakeops.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity scorer, fitted on the labelled ones among them, rejects go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines inside later copies of three-line windows go; the length is stated anew."""
    return line_windows.drop_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return simhash.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with at least one word in twenty inside a benchmark window go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left, placed in windows of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]
#: Fitted scores, fingerprints and token ids cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; what passes between them goes through the shared folder."""
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, rows, sf_dir).write.parquet(path)
        rows = spark.read.parquet(path)
    return rows
