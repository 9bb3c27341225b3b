"""Integer ranges as arrays, native and as a Python function."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, IntegerType


def int_range(size: int) -> Column:
    """The array 0..size-1; empty for size 0 or less. Folds to a constant in the plan."""
    if size <= 0:
        return F.array().cast("array<int>")
    return F.sequence(F.lit(0), F.lit(size - 1))


@F.udf(ArrayType(IntegerType()))
def int_range_udf(size):
    """The same as a Python function; :func:`int_range` needs no Python worker."""
    return None if size is None else list(range(size))
