"""Delete, update, upsert and append as functions from table to table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeops.operators.names import fresh_name


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Drop the rows for which ``predicate`` is true; rows where it is NULL stay."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def update_where(df: DataFrame, predicate: Column, changes: dict[str, Column]) -> DataFrame:
    """Set columns of the rows for which ``predicate`` is true; values are read from the old row."""
    unknown = [c for c in changes if c not in df.columns]
    if unknown:
        raise ValueError(f"no such columns: {unknown}")
    hit = F.coalesce(predicate, F.lit(False))
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[
        F.when(hit, changes[c].cast(types[c])).otherwise(F.col(c)).alias(c) if c in changes else F.col(c)
        for c in df.columns])


def _like_target(source: DataFrame, target: DataFrame) -> DataFrame:
    missing = [c for c in target.columns if c not in source.columns]
    if missing:
        raise ValueError(f"the source lacks columns of the target: {missing}")
    return source.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields])


def merge_upsert(target: DataFrame, source: DataFrame, keys: list[str], large_source: bool = False) -> DataFrame:
    """Rows of ``target`` whose key is in ``source`` take all source values, other source rows are added.

    A NULL key never matches. A target key that occurs several times is updated each time. The result raises an error
    if several source rows match one target row. By default the source is joined to the target once for updates and
    its keys once more for inserts, which suits a source that Spark broadcasts. ``large_source`` makes it one full
    outer join instead: each side is read once and shuffled once. Both give the same rows. Rows with a NULL key on
    either side pass around the joins, so they never meet in one task.
    """
    keys = list(keys)
    columns = target.columns
    new = _like_target(source, target)
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    beside = target.filter(~known).unionByName(new.filter(~known))
    old, new = target.filter(known), new.filter(known)
    # Work names must differ from the table's own columns and from one another.
    names = {c: fresh_name(target, f"_new_{c}") for c in columns}
    offered = new.withColumnsRenamed(names)
    condition = reduce(lambda a, b: a & b, [F.col(k) == F.col(names[k]) for k in keys])
    clash = F.raise_error(F.lit("several source rows match the same target row")).cast("boolean")
    taken = F.col(names[keys[0]]).isNotNull()
    values = [F.when(taken, F.col(names[c])).otherwise(F.col(c)).alias(c) for c in columns]

    if large_source:
        # The count per key uses the same partitioning as the join.
        n = fresh_name(target, "_n", offered)
        counted = offered.withColumn(n, F.count(F.lit(1)).over(Window.partitionBy(*[names[k] for k in keys])))
        joined = old.join(counted.hint("merge"), condition, "full_outer")
        met = F.col(keys[0]).isNotNull() & taken & (F.col(n) > 1)
        return joined.filter(F.when(met, clash).otherwise(True)).select(*values).unionByName(beside)

    updated = old.join(offered, condition, "left").select(*values)
    # The keys present on both sides, from key columns only; two source rows of one such key are the error.
    row, first, last = (fresh_name(target, name) for name in ("_row", "_first", "_last"))
    pairs = old.select(*keys).join(new.select(*keys, F.monotonically_increasing_id().alias(row)), keys)
    matched = pairs.groupBy(*keys).agg(F.min(row).alias(first), F.max(row).alias(last))
    matched = matched.filter(F.when(F.col(first) < F.col(last), clash).otherwise(True)).select(*keys)
    inserts = new.join(matched, keys, "left_anti").select(*columns)
    return updated.unionByName(inserts).unionByName(beside)


def check_append(target: DataFrame, rows: DataFrame, evolve: bool = False) -> None:
    """Raise if ``rows`` cannot be appended: other types, or columns the target lacks (unless ``evolve``)."""
    have = {f.name: f.dataType for f in target.schema.fields}
    clash = [f"{f.name}: {have[f.name].simpleString()} and {f.dataType.simpleString()}"
             for f in rows.schema.fields if f.name in have and f.dataType != have[f.name]]
    if clash:
        raise ValueError(f"column types differ: {clash}")
    extra = [c for c in rows.columns if c not in have]
    missing = [c for c in have if c not in rows.columns]
    if not evolve and (extra or missing):
        raise ValueError(f"schemas differ: additional columns {extra}, absent columns {missing}")


def append_rows(target: DataFrame, rows: DataFrame, evolve: bool = False) -> DataFrame:
    """All rows of both; with ``evolve`` a column of one side only is NULL in the other's rows."""
    check_append(target, rows, evolve)
    return target.unionByName(rows, allowMissingColumns=evolve)
