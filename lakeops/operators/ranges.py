"""Joins whose condition is a range: points in intervals and intervals that overlap, as equi-joins on cells.

The points' counted distribution lays out cells that hold about equally many of them. An interval becomes the few cells
of a tree that cover it exactly once, so a long one is a handful of coarse cells and not thousands of fine ones; a point
lies in one cell per level that any interval uses. Point and interval meet in exactly one cell, so each pair is found
once, and Spark joins by equality with its handling of hot keys. With further keys only the points of one key share a
cell, so each key has its own finest level: a key of few points is a single cell, however long the table is.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DateType, LongType, NumericType, TimestampNTZType, TimestampType

from lakeops.operators.names import column
from lakeops.operators.ordering import join_measured
from lakeops.session import discard, materialize

#: Points that a finest cell aims at.
CELL_POINTS = 256
#: Quantiles of the points by which cells are laid out; between them cells are evenly wide.
QUANTILES = 1024
#: A coarser cell holds so many cells of the level below: 2 ** STEP.
STEP = 4


def _number(value: Column, kind) -> Column:
    """The value as a double, in the same order as the values themselves (equal doubles are compared exactly later)."""
    if isinstance(kind, NumericType):
        return value.cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, TimestampType):
        return F.unix_micros(value).cast("double")
    if isinstance(kind, TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), value).cast("double")
    raise ValueError(f"ranges over {kind.simpleString()} are not supported")


class _Cells:
    """Numbered cells along the line; a larger value never lies in a smaller cell."""

    def __init__(self, bounds: list[float], points: int, cell_points: int):
        self.bounds = np.unique(np.array([b for b in bounds if b is not None and math.isfinite(b)], np.float64))
        spans = max(1, len(self.bounds) - 1)
        self.fine = max(1, math.ceil(points / spans / cell_points))
        self.last = spans * self.fine - 1

    def number(self, values: np.ndarray) -> np.ndarray:
        if len(self.bounds) < 2:
            return np.zeros(len(values), np.int64)
        span = np.searchsorted(self.bounds, values, side="right") - 1
        span = np.clip(np.where(np.isnan(values), len(self.bounds), span), 0, len(self.bounds) - 2)
        low, high = self.bounds[span], self.bounds[span + 1]
        far = np.clip(np.where(np.isnan(values), high, values), low, high)  # Spark takes NaN for the largest number
        within = (far / 2 - low / 2) / (high / 2 - low / 2)
        return np.minimum(span * self.fine + np.minimum((within * self.fine).astype(np.int64), self.fine - 1), self.last)

    def of(self, value: Column, default: int) -> Column:
        """The cell of a column; ``default`` for NULL."""
        cells = self

        @F.pandas_udf("long")
        def number(values: pd.Series) -> pd.Series:
            return pd.Series(cells.number(values.to_numpy(dtype="float64", na_value=np.nan)))

        return F.when(value.isNull(), F.lit(default).cast("long")).otherwise(number(value))


def cover(first: int, last: int, level: int = 0) -> list[int]:
    """The fewest cells of the tree that hold cells ``first`` to ``last`` of a level once each, as node << 5 | level."""
    out, size = [], 1 << STEP
    while first <= last:
        if last - first < size:
            return out + [n << 5 | level for n in range(first, last + 1)]
        while first % size:
            out.append(first << 5 | level)
            first += 1
        while last % size != size - 1:
            out.append(last << 5 | level)
            last -= 1
        first, last, level = first >> STEP, last >> STEP, level + 1
    return out


@F.pandas_udf(ArrayType(LongType()))
def _covers(first: pd.Series, last: pd.Series, base: pd.Series) -> pd.Series:
    return pd.Series([cover(a >> STEP * n, b >> STEP * n, n) for a, b, n in zip(first.tolist(), last.tolist(), base.tolist())])


def _crowded(points: DataFrame, names: list[str], cell_points: int) -> DataFrame:
    """The keys that have more points than a cell aims at."""
    counts = points.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    return materialize(counts.filter(F.col("n") > cell_points).select(*names))


def _finest(points: DataFrame, crowded: DataFrame, names: list[str], cell: Column, top: int, cell_points: int) -> DataFrame:
    """The finest level of each crowded key: the coarsest one below ``top`` at which its points meet at most
    ``cell_points`` of one another on average, else 0."""
    counts = join_measured(points, crowded, names, 64).select(*names, cell.alias("cell")).groupBy(*names, "cell").agg(
        F.count(F.lit(1)).cast("double").alias("n"))
    levels = F.array(*[F.struct(F.lit(n).alias("level"), F.shiftright("cell", STEP * n).alias("node")) for n in range(top)])
    nodes = counts.select(*names, "n", F.inline(levels)).groupBy(*names, "level", "node").agg(F.sum("n").alias("n"))
    met = nodes.groupBy(*names, "level").agg((F.sum(F.col("n") * F.col("n")) / F.sum("n")).alias("met"))
    return materialize(met.groupBy(*names).agg(F.coalesce(
        F.max(F.when(F.col("met") <= cell_points, F.col("level"))), F.lit(0)).alias("base")))


def _meet(points: DataFrame, intervals: DataFrame, kind, keys: int, cell_points: int) -> DataFrame:
    """Candidate pairs of ``points`` (x, k0.., a) and ``intervals`` (low, high, k0.., b): those that share a cell.

    A NULL point lies before all others; a NULL end of an interval is open.
    """
    names = [f"k{i}" for i in range(keys)]
    crowded = _crowded(points, names, cell_points) if keys else None
    if keys and crowded.isEmpty():
        return points.select(*names, "a").join(intervals.select(*names, "b"), names)
    x = _number(F.col("x"), kind)
    shares = [i / QUANTILES for i in range(QUANTILES + 1)]
    rows, bounds = points.agg(F.count("x"), F.percentile_approx(x, shares, F.lit(10_000))).first()
    cells = _Cells(bounds or [], rows, cell_points)
    base, top = F.lit(0), -(-cells.last.bit_length() // STEP)  # at the top the whole line is one cell
    if keys and top:
        finest = _finest(points, crowded, names, cells.of(x, 0), top, cell_points)
        points, intervals = (join_measured(side, finest, names, 64, "left") for side in (points, intervals))
        base = F.coalesce("base", F.lit(top))
    if keys:
        discard(crowded)
    covered = intervals.select(*names, "b", F.explode(_covers(
        cells.of(_number(F.col("low"), kind), 0), cells.of(_number(F.col("high"), kind), cells.last), base)).alias("cell"))
    covered = materialize(covered)
    levels = sorted(r[0] for r in covered.select((F.col("cell") % 32).cast("int")).distinct().collect())
    placed = points.select(*names, "a", cells.of(x, 0).alias("cell"), base.alias("base"))
    ladder = F.array(*[F.when(F.col("base") <= n, F.shiftleft(F.shiftright("cell", STEP * n), 5).bitwiseOR(
        F.lit(n).cast("long"))) for n in levels]).cast("array<long>")
    return placed.select(*names, "a", F.explode(F.array_compact(ladder)).alias("cell")).join(covered, [*names, "cell"])


def _packed(df: DataFrame, keys: list[str], side: str) -> DataFrame:
    """Key columns as k0.., and all columns as one struct with numbered fields."""
    known = df.filter(" AND ".join(f"{column(k)} IS NOT NULL" for k in keys)) if keys else df
    return known.select(*[F.col(column(k)).alias(f"k{i}") for i, k in enumerate(keys)],
                        F.struct(*[F.col(column(c)).alias(f"f{i}") for i, c in enumerate(df.columns)]).alias(side))


def _unpacked(joined: DataFrame, left: DataFrame, right: DataFrame, suffix: str) -> DataFrame:
    taken = {c.lower() for c in left.columns}
    names = [c + suffix if c.lower() in taken else c for c in right.columns]
    clash = [n for n in names if n.lower() in taken]
    if clash:
        raise ValueError(f"columns {clash} are on both sides even with the suffix")
    return joined.select(*[F.col("a")[f"f{i}"].alias(c) for i, c in enumerate(left.columns)],
                         *[F.col("b")[f"f{i}"].alias(n) for i, n in enumerate(names)])


def _field(df: DataFrame, side: str, name: str) -> Column:
    return F.col(side)[f"f{df.columns.index(name)}"]


def _same_kind(left: DataFrame, right: DataFrame, names: list[tuple[DataFrame, str]]):
    kinds = {df.schema[c].dataType.simpleString(): df.schema[c].dataType for df, c in names}
    if len(kinds) > 1:
        raise ValueError(f"ranges of different types: {sorted(kinds)}")
    return next(iter(kinds.values()))


def point_join(points: DataFrame, intervals: DataFrame, point: str, ends: tuple[str, str], keys: list[str] = (),
               closed: bool = True, suffix: str = "_right", cell_points: int = CELL_POINTS) -> DataFrame:
    """Every point with every interval that holds it: start <= point <= end, or point < end unless ``closed``.

    A NULL start or end is open; a NULL point lies nowhere. ``keys`` must be equal too, and NULL keys match nothing.
    All columns of both sides come out, those of the intervals with ``suffix`` where the names clash. Points and ends
    must have one type: a number, date or timestamp.
    """
    kind = _same_kind(points, intervals, [(points, point), (intervals, ends[0]), (intervals, ends[1])])
    left = _packed(points, keys, "a").withColumn("x", _field(points, "a", point)).filter("x IS NOT NULL")
    right = _packed(intervals, keys, "b").withColumns({
        "low": _field(intervals, "b", ends[0]), "high": _field(intervals, "b", ends[1])})
    right = right.filter("low IS NULL OR high IS NULL OR low <= high")
    x, low, high = _field(points, "a", point), *(_field(intervals, "b", e) for e in ends)
    inside = (low.isNull() | (low <= x)) & (high.isNull() | ((x <= high) if closed else (x < high)))
    return _unpacked(_meet(left, right, kind, len(keys), cell_points).filter(inside), points, intervals, suffix)


def overlap_join(left: DataFrame, right: DataFrame, left_ends: tuple[str, str], right_ends: tuple[str, str],
                 keys: list[str] = (), closed: bool = True, suffix: str = "_right",
                 cell_points: int = CELL_POINTS) -> DataFrame:
    """Every pair of intervals that share a point, once; with ``closed`` False an interval does not hold its end.

    NULL ends are open, intervals that hold no point match nothing; otherwise as ``point_join``. Of two intervals that
    overlap, the later start lies in the other interval: pairs are found by the left start in the right interval, or by
    the right start, if it is later, in the left one.
    """
    kind = _same_kind(left, right, [(left, e) for e in left_ends] + [(right, e) for e in right_ends])

    def side(df: DataFrame, name: str, ends: tuple[str, str]) -> tuple[DataFrame, Column, Column]:
        low, high = (_field(df, name, e) for e in ends)
        held = low.isNull() | high.isNull() | ((low <= high) if closed else (low < high))
        return _packed(df, keys, name).filter(held), low, high

    one, low, high = side(left, "a", left_ends)
    two, other_low, other_high = side(right, "b", right_ends)

    def before(start: Column, end: Column) -> Column:
        return end.isNull() | start.isNull() | ((start <= end) if closed else (start < end))

    starts_inside = (other_low.isNull() | (low.isNotNull() & (other_low <= low))) & before(low, other_high)
    first = _meet(one.withColumn("x", low), two.withColumns({"low": other_low, "high": other_high}), kind, len(keys),
                  cell_points).filter(starts_inside)
    starts_later = other_low.isNotNull() & (low.isNull() | (other_low > low)) & before(other_low, high)
    # The sides change places: right starts are the points, left intervals hold them.
    points = two.filter(other_low.isNotNull()).withColumn("x", other_low).withColumnRenamed("b", "a")
    holders = one.withColumns({"low": low, "high": high}).withColumnRenamed("a", "b")
    second = _meet(points, holders, kind, len(keys), cell_points)
    second = second.select(F.col("b").alias("a"), F.col("a").alias("b")).filter(starts_later)
    return _unpacked(first.select("a", "b").unionByName(second.select("a", "b")), left, right, suffix)
