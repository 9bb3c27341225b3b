"""Group-by summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def count_by(df: DataFrame, keys: list[str], name: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def summary_columns(total: dict[str, str], mean: dict[str, str], largest: dict[str, str], members: str,
                    decimals: int = 2) -> list[Column]:
    """Rounded sums, means and maxima (source column -> new name) and the row count, as one list."""
    return [
        *[F.round(F.sum(c), decimals).alias(n) for c, n in total.items()],
        *[F.round(F.mean(c), decimals).alias(n) for c, n in mean.items()],
        *[F.round(F.max(c), decimals).alias(n) for c, n in largest.items()],
        F.count(F.lit(1)).alias(members),
    ]
