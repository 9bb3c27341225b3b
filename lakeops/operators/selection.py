"""Exactly k rows of each group, those with the smallest draws, without sorting a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeops.operators.ordering import join_measured, row_number_by
from lakeops.session import discard, materialize

#: Draws have 60 bits; the first pass counts them by their upper ones.
DRAW_BITS, UPPER_BITS = 60, 12


def smallest_limit(draws: DataFrame, by: list[str], draw: str, ties: list[str], quota: Column) -> DataFrame:
    """Per group the last (draw, ties...) that belongs to the ``quota`` smallest: columns ``by`` and a struct ``limit``.

    ``draw`` holds whole numbers of 60 bits; ``quota`` is computed from the column ``n``, the group's rows. Groups with
    a quota of 0 are left out. One pass counts draws by their upper bits, a second takes the rows of the one range that
    the quota ends in, about a 4,096th, which are then numbered in ranges over many tasks. Rows equal in draw and ties
    that the quota would part raise an error. ``draws`` is read twice; ``by`` may be empty, names with ``_`` in front
    are the operator's own.
    """
    by = list(by)
    upper = F.shiftright(draw, DRAW_BITS - UPPER_BITS)
    counted = materialize(draws.groupBy(*by, upper.alias("_upper")).agg(F.count(F.lit(1)).alias("_n")))
    # At most 4,096 rows per group.
    rising = Window.partitionBy(*by).orderBy("_upper").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*by)
    ranges = counted.withColumns({"_end": F.sum("_n").over(rising), "n": F.sum("_n").over(whole)}).withColumn(
        "_quota", quota.cast("long"))
    ending = materialize(ranges.filter((F.col("_quota") <= F.col("_end")) & (F.col("_quota") > F.col("_end") - F.col("_n")))
                         .select(*by, "_upper", (F.col("_quota") - F.col("_end") + F.col("_n")).alias("_left")))
    near = join_measured(draws.withColumn("_upper", upper), ending, [*by, "_upper"], 64)
    near = materialize(near.select(*by, draw, *ties, "_left"))
    numbered = row_number_by(near, by, [F.col(draw), *[F.col(t) for t in ties]], "_number")
    last = numbered.filter(F.col("_number").between(F.col("_left"), F.col("_left") + 1))
    place = F.struct(draw, *ties)
    inside = F.max(F.when(F.col("_number") == F.col("_left"), place))
    beyond = F.max(F.when(F.col("_number") > F.col("_left"), place))
    parted = F.raise_error(F.lit("rows with equal draws and ties cannot be parted: the key repeats")).cast(
        near.select(place).schema[0].dataType)
    limits = materialize(last.groupBy(*by).agg(F.when(inside == beyond, parted).otherwise(inside).alias("limit")))
    discard(counted, ending, near, numbered)
    return limits
