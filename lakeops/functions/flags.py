"""A 0/1 flag for membership in a list, as a Column, as SQL, and as expression text.

A NULL value gives 0 in all three forms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def flag_in(column: Column, values: list) -> Column:
    return F.when(column.isin(list(values)), 1).otherwise(0)


def flag_in_sql(spark: SparkSession, view: str, flags: dict[str, tuple[str, list]],
                keep: tuple[str, ...] = ()) -> DataFrame:
    """SQL form over a view: ``flags`` maps the new name to (column, values), bound as parameters."""
    args: dict[str, object] = {"source": view}
    items = [f"`{c}`" for c in keep]
    for number, (name, (column, values)) in enumerate(flags.items()):
        marks = []
        for position, value in enumerate(values):
            args[f"v{number}_{position}"] = value
            marks.append(f":v{number}_{position}")
        items.append(f"CASE WHEN `{column}` IN ({', '.join(marks)}) THEN 1 ELSE 0 END AS `{name}`")
    return spark.sql(f"SELECT {', '.join(items)} FROM IDENTIFIER(:source)", args=args)


def flag_in_expr(column: str, values: list[str], name: str) -> str:
    """Expression text for ``selectExpr``."""
    quoted = ["'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values]
    return f"CASE WHEN `{column}` IN ({', '.join(quoted)}) THEN 1 ELSE 0 END AS `{name}`"
