"""Names for work columns that no column of the caller has."""

from __future__ import annotations

from pyspark.sql import DataFrame


def fresh_name(df: DataFrame, name: str, *others: DataFrame) -> str:
    """``name``, with underscores in front until no column of the given tables has it (Spark ignores case)."""
    taken = {c.lower() for table in (df, *others) for c in table.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def fresh_names(df: DataFrame, *names: str) -> list[str]:
    return [fresh_name(df, name) for name in names]


def column(name: str) -> str:
    """``name`` quoted, so that dots and spaces in it are taken as they are."""
    return "`" + name.replace("`", "``") + "`"
