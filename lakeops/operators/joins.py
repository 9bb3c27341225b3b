"""Inner equi-joins without ambiguous column names."""

from __future__ import annotations

from pyspark.sql import DataFrame


def join_on_key(left: DataFrame, right: DataFrame, keys: list[str], suffix: str = "_right") -> DataFrame:
    """Inner join on shared keys; keys appear once, and right columns that clash get ``suffix``."""
    clashes = {c: c + suffix for c in right.columns if c not in keys and c in left.columns}
    return left.join(right.withColumnsRenamed(clashes), list(keys), "inner")


def join_on_different_keys(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                           suffix: str = "_right") -> DataFrame:
    """Inner join on two differently named keys; both keys are kept."""
    clashes = {c: c + suffix for c in right.columns if c in left.columns}
    renamed = right.withColumnsRenamed(clashes)
    return left.join(renamed, left[left_key] == renamed[clashes.get(right_key, right_key)], "inner")
