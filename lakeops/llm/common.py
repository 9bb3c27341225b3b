"""What the text operators share: reading tables, safe work columns, running Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.operators.names import fresh_name  # noqa: F401

TEXT_ROWS = 256


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(column: str):
    """The column as text, with NULL as the empty text."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str,
                setup: Callable[[], object] | None = None, rows: int = TEXT_ROWS) -> DataFrame:
    """Run ``function`` on slices of at most ``rows`` rows, so that long texts do not pile up in a worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = setup() if setup else None
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                piece = batch.slice(start, rows)
                result = function(piece, state) if setup else function(piece)
                if result is not None:
                    yield result

    return df.mapInArrow(run, schema)
