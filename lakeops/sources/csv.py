"""CSV scans with inferred or declared types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType, StructField, StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Read CSV with a header line; without ``schema`` the types are inferred in an extra pass."""
    reader = spark.read.option("header", True)
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    return reader.csv(path)


def build_schema(order: list[str], types: dict[DataType, list[str]]) -> StructType:
    """A nullable schema from the column order and the columns of each type."""
    by_name: dict[str, DataType] = {}
    for data_type, names in types.items():
        for name in names:
            if name in by_name:
                raise ValueError(f"two types for column {name}")
            by_name[name] = data_type
    unknown = [c for c in order if c not in by_name]
    unused = [c for c in by_name if c not in order]
    if unknown or unused:
        raise ValueError(f"no type for columns {unknown}, no position for columns {unused}")
    return StructType([StructField(c, by_name[c], True) for c in order])
