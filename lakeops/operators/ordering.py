"""Ranks, row numbers and running totals that hold when one group has most of the rows.

A Spark window puts each group in one task. Here the rows are range-partitioned on (group, order), so a large group
spans many tasks; each task's total per group is one row, the totals are summed in order, and every task adds what
lies before it. The way is the same at any size; ``chunks`` sets the number of tasks (by default the session's
number of shuffle partitions).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeops.operators.names import column, fresh_name, fresh_names
from lakeops.session import discard, materialize

#: A stored side of a join is broadcast up to this size, and joined by a shuffle beyond it.
BROADCAST_BYTES = 64 << 20


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match each other; the right side's keys are dropped."""
    names = {k: fresh_name(left, f"_right_{k}", right) for k in keys}
    renamed = right.withColumnsRenamed(names)
    condition = [F.col(column(k)).eqNullSafe(F.col(column(n))) for k, n in names.items()]
    return left.join(renamed, condition, how).drop(*names.values())


def join_measured(left: DataFrame, stored: DataFrame, keys: list[str], row_bytes: int, how: str = "inner") -> DataFrame:
    """Null-safe join with a materialized right side: broadcast if its counted rows, at ``row_bytes`` each, are few.

    Beyond that it is a sort-merge join, whose hot keys on the left adaptive execution splits.
    """
    small = stored.count() * row_bytes <= BROADCAST_BYTES
    return join_null_safe(left, F.broadcast(stored) if small else stored.hint("merge"), keys, how)


def _spread(df: DataFrame, partition_by: list[str], order_by: list[Column], chunks: int | None) -> DataFrame:
    chunks = chunks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(chunks, *[F.col(column(c)) for c in partition_by], *order_by)


def running_totals(df: DataFrame, totals: dict[str, Column], order_by: list[Column],
                   partition_by: list[str] = (), inclusive: bool = True,
                   chunks: int | None = None) -> DataFrame:
    """Add, per group and in order, the running sum of each value in ``totals`` (name -> value).

    ``order_by`` must be unique within a group. With ``inclusive=False`` a row's own value is left
    out. Values must not be NULL. ``df`` is read more than once, so a costly one should be
    materialized first.
    """
    partition_by = list(partition_by)
    end = 0 if inclusive else -1
    named = df.withColumns(totals)
    chunk, *rest = fresh_names(named, "_chunk", *[f"_sum_{n}" for n in totals], *[f"_before_{n}" for n in totals])
    sums, befores = dict(zip(totals, rest)), dict(zip(totals, rest[len(totals):]))

    def local_sum(value: Column, *by: str) -> Column:
        window = Window.partitionBy(*by).orderBy(*order_by)
        return F.coalesce(F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, end)), F.lit(0))

    spread = _spread(named, partition_by, order_by, chunks)
    spread = materialize(spread.withColumn(chunk, F.spark_partition_id()))
    chunk_sums = spread.groupBy(chunk, *partition_by).agg(*[F.sum(n).alias(sums[n]) for n in totals])
    earlier = (Window.partitionBy(*partition_by).orderBy(chunk)
               .rowsBetween(Window.unboundedPreceding, -1))
    before = chunk_sums.select(chunk, *partition_by, *[
        F.coalesce(F.sum(sums[n]).over(earlier), F.lit(0)).alias(befores[n]) for n in totals])
    joined = join_null_safe(spread, before, [chunk, *partition_by])
    summed = joined.select(*[F.col(column(c)) for c in df.columns], *[
        (local_sum(F.col(n), chunk, *partition_by) + F.col(befores[n])).alias(n) for n in totals])
    summed.stored_at = spread.stored_at  # discard() of the result frees what it reads
    return summed


def row_number_by(df: DataFrame, partition_by: list[str], order_by: list[Column], name: str = "row_number",
                  chunks: int | None = None) -> DataFrame:
    """Number the rows of each group from 1; end ``order_by`` with a unique key for a fixed result."""
    # In a sorted task this id counts rows from 0 in its lower 33 bits, below the task's number, so
    # a row's place needs no window and no second shuffle, only where its group starts.
    keys = [F.col(column(c)) for c in partition_by]
    place, chunk, start, count, shift = fresh_names(df, "_place", "_chunk", "_start", "_n", "_shift")
    placed = (_spread(df, partition_by, order_by, chunks)
              .sortWithinPartitions(*keys, *order_by).withColumn(place, F.monotonically_increasing_id()))
    stored = materialize(placed)
    placed = stored.withColumn(chunk, F.shiftright(place, 33))
    starts = placed.groupBy(chunk, *partition_by).agg(F.min(place).alias(start), F.count(F.lit(1)).alias(count))
    earlier = (Window.partitionBy(*partition_by).orderBy(chunk)
               .rowsBetween(Window.unboundedPreceding, -1))
    starts = starts.select(chunk, *partition_by, (
        F.coalesce(F.sum(count).over(earlier), F.lit(0)) + 1 - F.col(start)).alias(shift))
    numbered = join_null_safe(placed, starts, [chunk, *partition_by]).select(
        *[F.col(column(c)) for c in df.columns], (F.col(place) + F.col(shift)).alias(name))
    numbered.stored_at = stored.stored_at
    return numbered


def rank_by(df: DataFrame, partition_by: list[str], value: str, descending: bool = True, name: str = "rank",
            chunks: int | None = None) -> DataFrame:
    """Rank with gaps by ``value`` within each group; NULL values come last when descending.

    The rank of a value is one more than the rows ahead of it, so ranks are computed on distinct values and their
    counts. They are broadcast to the rows while they are few; beyond it a frequent value's rows are split by
    skewed-join handling.
    """
    order = F.col(value).desc() if descending else F.col(value).asc()
    # Two of these names could only meet if a grouping column had one of them.
    count, before = fresh_names(df, "_n", "_ahead")
    counts = materialize(df.groupBy(*partition_by, value).agg(F.count(F.lit(1)).alias(count)))
    ahead = running_totals(counts, {before: F.col(count)}, [order], partition_by, inclusive=False, chunks=chunks)
    ranks = materialize(ahead.select(*partition_by, value, (F.col(before) + 1).alias(name)))
    discard(counts, ahead)
    return join_measured(df, ranks, [*partition_by, value], 64)


def stable_row_id(df: DataFrame, key: list[str], name: str = "id", chunks: int | None = None) -> DataFrame:
    """0, 1, 2, ... in the order of a unique key, whatever the partitioning."""
    numbered = row_number_by(df, [], [F.col(k) for k in key], name, chunks)
    return numbered.withColumn(name, F.col(name) - 1)


def quick_row_id(df: DataFrame, name: str = "id") -> DataFrame:
    """Unique increasing ids without a shuffle; they change with the partitioning."""
    return df.withColumn(name, F.monotonically_increasing_id())


def top_rows(df: DataFrame, order_by: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows in order; each task keeps its own ``n`` only."""
    return df.orderBy(*order_by).limit(n)


def with_neighbours(df: DataFrame, partition_by: list[str], order_by: list[Column],
                    previous: dict[str, Column] | None = None, following: dict[str, Column] | None = None,
                    chunks: int | None = None) -> DataFrame:
    """Add values of the row before (``previous``, name -> value) and of the row after, within each group.

    They are NULL in a group's first and last row. ``order_by`` must be unique within a group for a fixed result. A
    group spans as many range-partitioned tasks as it needs: only the last row of the task before and the first one of
    the task after are carried over, one row per task.
    """
    previous, following = previous or {}, following or {}
    group = F.struct(*[F.col(column(c)) for c in partition_by]) if partition_by else F.struct(F.lit(0))
    back, ahead, place, chunk, last, first = fresh_names(df, "_back", "_ahead", "_place", "_chunk", "_last", "_first")
    # Numbered fields, as the caller's names may clash inside the struct too.
    marked = df.withColumns({
        back: F.struct(group.alias("g"), *[v.alias(f"v{i}") for i, v in enumerate(previous.values())]),
        ahead: F.struct(group.alias("g"), *[v.alias(f"v{i}") for i, v in enumerate(following.values())])})
    keys = [F.col(column(c)) for c in partition_by]
    spread = (_spread(marked, partition_by, order_by, chunks).sortWithinPartitions(*keys, *order_by)
              .withColumn(place, F.monotonically_increasing_id()))
    stored = materialize(spread)
    placed = stored.withColumn(chunk, F.shiftright(place, 33))
    every = Window.orderBy(chunk)
    ends = (placed.groupBy(chunk).agg(F.max_by(back, place).alias(last), F.min_by(ahead, place).alias(first))
            .select(chunk, F.lag(last).over(every).alias(last), F.lead(first).over(every).alias(first)))
    inside = Window.partitionBy(chunk).orderBy(place)
    near = placed.join(F.broadcast(ends), chunk).withColumns({
        last: F.coalesce(F.lag(back).over(inside), F.col(last)),
        first: F.coalesce(F.lead(ahead).over(inside), F.col(first))})

    def of_group(side: str, own: str, values: dict[str, Column]) -> list[Column]:
        same = F.col(side)["g"].eqNullSafe(F.col(own)["g"])
        return [F.when(same, F.col(side)[f"v{i}"]).alias(n) for i, n in enumerate(values)]

    found = near.select(*[F.col(column(c)) for c in df.columns], *of_group(last, back, previous),
                        *of_group(first, ahead, following))
    found.stored_at = stored.stored_at
    return found
