"""Boosted trees for every group of a table at once, grown level by level from histograms that Spark sums.

Rows are binned once and packed into blocks of one group each; a group has as many blocks as its rows need, so one rule
serves groups of every size. A level of a round is one Spark job over the blocks of all groups that still learn: each
block finds the node of its rows, sums gradients per (node, feature, bin), and Spark adds the sums up. Of two siblings
only the lighter one is summed, the other is the parent less it. Gradients and leaf values are whole multiples of a
small unit, so all sums are exact and a model does not depend on how rows were dealt to blocks and tasks.
"""

from __future__ import annotations

import datetime
import itertools
import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (ArrayType, FloatType, IntegerType, LongType, StringType, StructField, StructType)

from lakeops.models.metrics import DIGITS, area_under_curve, weighted_scores
from lakeops.models.prepare import blank_nan, exact_medians, few_parts, fit_categories
from lakeops.operators.names import column
from lakeops.operators.ordering import join_measured, join_null_safe
from lakeops.session import discard, materialize

STATS_SCHEMA = StructType([
    StructField("group", StringType()), StructField("start_time", StringType()),
    StructField("end_time", StringType()), StructField("elapsed_seconds", FloatType()),
    StructField("train_precision", FloatType()), StructField("train_recall", FloatType()),
    StructField("train_f1", FloatType()), StructField("test_precision", FloatType()),
    StructField("test_recall", FloatType()), StructField("test_f1", FloatType()),
    StructField("test_auc", FloatType()), StructField("best_iteration", IntegerType()),
])
_SCORES = ("precision", "recall", "f1")
# What a row is used for: fitting, stopping only, or the reported test scores.
TRAIN, WATCH, TEST = 0, 1, 2
_TIME = "%d-%b-%Y (%H:%M:%S.%f)"
#: Rows of a block.
BLOCK_ROWS = 1 << 16
#: Gradients are multiples of 1 / GRADIENT, margins of 1 / MARGIN; scores are compared in steps of 1 / STEPS up to LIMIT.
GRADIENT, MARGIN, STEPS, LIMIT = 1 << 24, 1 << 20, 1 << 10, 32
#: After so many rounds the margins of all rows are stored, so a level never walks more trees than that.
STORED_ROUNDS = 4
#: What the trees of one group are taken to need when they are joined to its blocks.
TREE_BYTES = 1 << 16
#: Sums that the driver holds at once; groups beyond it learn in a further series of jobs.
DRIVER_SUMS = 1 << 23
#: Trees of so many levels are walked by columns of bytes.
BYTE_LEVELS = 7
#: Bytes of bin edges that are sent to every Python worker.
SENT_EDGES = 1 << 26
#: Finest bins and deepest trees that blocks and whole-number leaves are made for.
MOST_BINS, MOST_DEPTH = 256, 12


@dataclass(frozen=True)
class BoostOptions:
    max_rounds: int = 1000
    patience: int = 25
    rate: float = 0.3
    l2: float = 1.0
    bins: int = 64
    max_depth: int = 6

    def __post_init__(self):
        if not (2 <= self.bins <= MOST_BINS and 1 <= self.max_depth <= MOST_DEPTH):
            raise ValueError(f"bins must be 2 to {MOST_BINS}, max_depth 1 to {MOST_DEPTH}")


# -- one tree ----------------------------------------------------------------------------------------------------------

class Tree(NamedTuple):
    """Node i has the children 2 i (bins up to ``last``) and 2 i + 1; ``leaves`` holds margins of the lowest level.

    A node that is not split sends all rows to the left.
    """
    feature: np.ndarray
    last: np.ndarray
    leaves: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        size = 1 << depth
        return cls(np.zeros(size, np.int64), np.full(size, MOST_BINS, np.int64), np.zeros(size, np.int64))

    def nodes(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """The node of every row after so many levels; ``bins`` has one row per feature."""
        if levels <= BYTE_LEVELS:
            return (1 << levels) + np.zeros(bins.shape[1], np.int64) + self._below(bins, 1, levels)
        rows = np.arange(bins.shape[1])
        node = np.ones(bins.shape[1], np.int64)
        for _ in range(levels):
            node = 2 * node + (bins[self.feature[node], rows] > self.last[node])
        return node

    def _below(self, bins: np.ndarray, node: int, levels: int) -> np.ndarray:
        """Every row's place among the nodes so many levels below ``node``, if it came there.

        Whole columns of bytes are compared and merged, which is far quicker than to look up each row's nodes.
        """
        if levels == 0 or self.last[node] >= MOST_BINS:
            return np.zeros(1, np.uint8) if levels == 0 else self._below(bins, 2 * node, levels - 1)
        goes = (bins[self.feature[node]] > np.uint8(self.last[node])).view(np.uint8)
        if levels == 1:
            return goes
        left, right = (self._below(bins, child, levels - 1) for child in (2 * node, 2 * node + 1))
        return left ^ ((left ^ right | np.uint8(1 << levels - 1)) & np.negative(goes))

    def margins(self, bins: np.ndarray) -> np.ndarray:
        size = len(self.leaves)
        return self.leaves[self.nodes(bins, size.bit_length() - 1) - size]


class Split(NamedTuple):
    feature: int
    last: int
    left: np.ndarray    # (gradient, hessian) sums on either side
    right: np.ndarray


def best_split(sums: np.ndarray, options: BoostOptions) -> Split | None:
    """The split with the largest score of both sides together, from sums per (feature, bin, gradient or hessian).

    Equal scores go to the first feature and bin. A split that gains nothing by itself is taken too, as those below it
    may; None if no split has rows on both sides.
    """
    left = sums.cumsum(axis=1)[:, :-1]
    total = sums.sum(axis=1)[:, None, :]
    right = total - left
    extra = options.l2 * GRADIENT

    def score(side: np.ndarray) -> np.ndarray:
        return (side[..., 0] / GRADIENT) ** 2 / ((side[..., 1] + extra) / GRADIENT)

    gain = np.where((left[..., 1] > 0) & (right[..., 1] > 0), np.round(score(left) + score(right), 9), -1.0)
    f, last = np.unravel_index(int(gain.argmax()), gain.shape)
    return None if gain[f, last] < 0 else Split(int(f), int(last), left[f, last], right[f, last])


def leaf_value(gradient: int, hessian: int, options: BoostOptions) -> int:
    return round(-options.rate * int(gradient) / (int(hessian) + options.l2 * GRADIENT) * MARGIN)


@dataclass
class Model:
    """What the driver knows of one group: its trees, the tree that grows, the best round so far."""
    options: BoostOptions
    trees: list[Tree] = field(default_factory=list)
    best_round: int | None = None
    best_auc: float = float("nan")
    done: bool = False
    stored: int = 0     # trees whose margins are stored with the rows
    growing: Tree | None = None
    total: np.ndarray | None = None
    sums: dict[int, np.ndarray] = field(default_factory=dict)
    split: dict[int, Split] = field(default_factory=dict)

    def judge(self, auc: float) -> None:
        """Take note of the newest round's AUC; learning ends when later rounds cannot or do not help."""
        last = len(self.trees) - 1
        if self.best_round is None or auc > self.best_auc or (np.isnan(self.best_auc) and not np.isnan(auc)):
            self.best_round, self.best_auc = last, auc
        self.done = (len(self.trees) >= self.options.max_rounds or last - self.best_round >= self.options.patience
                     or self.best_auc == 1.0)

    def wanted(self, level: int) -> list[int]:
        """Nodes of a level whose histograms must be summed: the lighter child of each split node."""
        if level == 0:
            return [1]
        return [2 * n + int(s.left[1] > s.right[1]) for n, s in sorted(self.split.items()) if n >> (level - 1) == 1]

    def grow(self, level: int, found: dict[int, np.ndarray]) -> None:
        """Split the nodes of a level, given the wanted histograms."""
        if level == 0:
            self.growing, self.sums, self.split = Tree.empty(self.options.max_depth), dict(found), {}
            self.total = found[1][0].sum(axis=0)
        else:
            for node, sums in found.items():
                self.sums[node], self.sums[node ^ 1] = sums, self.sums[node >> 1] - sums
        for node in [n for n in self.sums if n >> level == 1]:
            split = best_split(self.sums[node], self.options)
            if split is not None:
                self.split[node] = split
                self.growing.feature[node], self.growing.last[node] = split.feature, split.last
        for node in [n for n in self.sums if n >> level != 1]:
            del self.sums[node]  # parents are no longer needed

    def finish(self) -> None:
        """Turn the sums on either side of the lowest splits into leaves; a node left whole ends at its far left."""
        depth, tree = self.options.max_depth, self.growing
        sides = {1: self.total}
        for level in range(depth):
            for node in [n for n in sides if n >> level == 1]:
                split, whole = self.split.get(node), sides.pop(node)
                if split is None:
                    sides[2 * node] = whole
                else:
                    sides[2 * node], sides[2 * node + 1] = split.left, split.right
        for node, side in sides.items():
            tree.leaves[node - (1 << depth)] = leaf_value(*side, self.options)
        self.trees.append(tree)
        self.growing, self.sums, self.split = None, {}, {}


def _by_score(counts: np.ndarray) -> np.ndarray:
    """Rows (score, positives, negatives) in order, one per score."""
    counts = counts[np.argsort(counts[:, 0])]
    start = np.flatnonzero(np.diff(counts[:, 0], prepend=counts[0, 0] - 1)) if len(counts) else np.zeros(0, np.int64)
    if not len(start):
        return counts
    return np.concatenate((counts[start, :1], np.add.reduceat(counts[:, 1:], start, axis=0)), axis=1)


def auc_of(counts: np.ndarray) -> float:
    """AUC from rows (score, positives, negatives); tied scores count half, NaN for one class only."""
    _, pos, neg = _by_score(counts).T
    pairs = int(pos.sum()) * int(neg.sum())
    return float((pos * (2 * (neg.cumsum() - neg) + neg)).sum() / 2 / pairs) if pairs else float("nan")


def scores_at(margins: np.ndarray) -> np.ndarray:
    """Margins in the steps in which scores are compared."""
    steps = np.rint(margins / (MARGIN // STEPS)).astype(np.int64)
    return np.clip(steps, -LIMIT * STEPS, LIMIT * STEPS)


# -- blocks of rows ----------------------------------------------------------------------------------------------------

_BLOCK = "rows int, bins binary, label binary, role binary, margin binary"


def _pack(binned: DataFrame, keep: list[str] = (), rows: int = BLOCK_ROWS) -> DataFrame:
    """Stored rows of (group, label, role, bins), a byte per bin, as blocks of one group each; ``keep`` come as lists.

    Rows are dealt by ranges of (group, stored place): a large group spans many tasks, whatever its rows hold. A block
    begins with its train rows.
    """
    spark = binned.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = (binned.withColumn("place", F.monotonically_increasing_id())
             .repartitionByRange(tasks, "group", "place").drop("place").sortWithinPartitions("group"))
    kind = dealt.schema["group"].dataType.simpleString()
    lists = "".join(f", {column(c)} array<{dealt.schema[c].dataType.simpleString()}>" for c in keep)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def block() -> pa.RecordBatch:
            one = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            role = one.column("role").to_numpy(zero_copy_only=False)
            if (role[1:] < role[:-1]).any():
                one = one.take(pa.array(np.argsort(role, kind="stable")))
            n = one.num_rows
            flat = one.column("bins").flatten().to_numpy().astype(np.uint8).reshape(n, -1)
            cells = [one.column("group").slice(0, 1), pa.array([n], pa.int32()),
                     pa.array([flat.T.tobytes()], pa.binary()),
                     *[pa.array([one.column(c).to_numpy(zero_copy_only=False).astype(np.uint8).tobytes()], pa.binary())
                       for c in ("label", "role")], pa.array([np.zeros(n, np.int64).tobytes()], pa.binary())]
            kept = [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), one.column(c)) for c in keep]
            return pa.RecordBatch.from_arrays([*cells, *kept],
                                              ["group", "rows", "bins", "label", "role", "margin", *keep])

        for batch in batches:
            groups = batch.column("group").to_pylist()
            cuts = [0, *[i for i in range(1, len(groups)) if groups[i] != groups[i - 1]], len(groups)]
            for start, end in itertools.pairwise(cuts):
                if held and held[0].column("group")[0].as_py() != groups[start]:
                    yield block()
                    held.clear()
                while start < end:
                    room = rows - sum(b.num_rows for b in held)
                    held.append(batch.slice(start, min(room, end - start)))
                    start += held[-1].num_rows
                    if sum(b.num_rows for b in held) >= rows:
                        yield block()
                        held.clear()
        if held:
            yield block()

    return dealt.mapInArrow(pack, f"group {kind}, {_BLOCK}{lists}")


class _Rows(NamedTuple):
    bins: np.ndarray
    label: np.ndarray
    role: np.ndarray
    margin: np.ndarray

    @classmethod
    def of(cls, row: dict) -> _Rows:
        n = row["rows"]
        return cls(np.frombuffer(row["bins"], np.uint8).reshape(-1, n), np.frombuffer(row["label"], np.uint8),
                   np.frombuffer(row["role"], np.uint8), np.frombuffer(row["margin"], np.int64))

    def train(self) -> _Rows:
        """The train rows, which come first in a block."""
        n = int(np.searchsorted(self.role, TRAIN, "right"))
        return _Rows(self.bins[:, :n], self.label[:n], self.role[:n], self.margin[:n])

    def margins(self, trees: list[Tree]) -> np.ndarray:
        margin = self.margin.copy()
        for tree in trees:
            margin += tree.margins(self.bins)
        return margin


def level_sums(rows: _Rows, margin: np.ndarray, tree: Tree | None, level: int, wanted: list[int],
               bins: int) -> np.ndarray:
    """Gradient and hessian sums of the train rows per (wanted node, feature, bin)."""
    slot = np.full(1 << level, -1, np.int64)
    slot[np.array(wanted, np.int64) - (1 << level)] = np.arange(len(wanted))
    nodes = tree.nodes(rows.bins, level) if level else np.ones(len(margin), np.int64)
    place = slot[nodes - (1 << level)]
    some = np.flatnonzero((rows.role == TRAIN) & (place >= 0))
    if len(some) == len(place):
        some = slice(None)
    place, chance = place[some] * bins, 1.0 / (1.0 + np.exp(-margin[some] / MARGIN))
    weights = (np.rint((chance - rows.label[some]) * GRADIENT), np.rint(chance * (1 - chance) * GRADIENT))
    out = np.zeros((len(wanted), len(rows.bins), bins, 2), np.int64)
    for f, of_feature in enumerate(rows.bins):
        cell = place + of_feature[some]
        for i, weight in enumerate(weights):
            # Sums of whole numbers below 2 ** 53 are exact in floating point.
            out[:, f, :, i] = np.bincount(cell, weight, len(wanted) * bins).reshape(-1, bins)
    return out


def _level(blocks: DataFrame, models: dict, level: int, judge: int, tasks: int, features: int) -> dict:
    """One job: per group, the wanted histograms of a level and, at the root, (score, positives, negatives).

    The sums of ``tasks`` tasks are added up by a shuffle, or by the driver if it can hold all of them; either way they
    are the same whole numbers.
    """
    kind = blocks.schema["group"].dataType.simpleString()
    asked = {g: (m.trees[m.stored:], m.growing, m.wanted(level), m.options.bins) for g, m in models.items()}
    scoring = {g for g, m in models.items() if level == 0 and m.trees}
    index = {g: i for i, g in enumerate(asked)}

    def add(batches: Iterator[pa.RecordBatch]) -> tuple[dict, dict]:
        """All sums of a task by group; scores as rows (score, positives, negatives)."""
        sums: dict = {}
        counts: dict = {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                group = row["group"]
                if group not in asked:
                    continue
                trees, growing, wanted, bins = asked[group]
                rows = _Rows.of(row) if group in scoring else _Rows.of(row).train()
                if not (wanted or group in scoring):
                    continue
                margin = rows.margins(trees)
                if wanted:
                    train = rows.train()
                    found = level_sums(train, margin[:len(train.role)], growing, level, wanted, bins)
                    sums[group] = sums[group] + found if group in sums else found
                if group in scoring:
                    judged = rows.role == judge
                    some = np.stack((scores_at(margin[judged]), rows.label[judged], 1 - rows.label[judged].astype(np.int64)), axis=1)
                    counts[group] = _by_score(np.concatenate((counts[group], some)) if group in counts else some)
        return sums, counts

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in enumerate(add(batches)):
            for group, array in found.items():
                yield pa.RecordBatch.from_arrays([pa.array([index[group]]), pa.array([part], pa.int32()),
                                                  pa.array([array.tobytes()], pa.binary())], ["model", "part", "data"])

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in enumerate(add(batches)):
            for group, array in found.items():
                if part == 0:
                    flat = array.reshape(-1, 2)
                    used = np.flatnonzero(flat.any(axis=1))
                    columns = used, flat[used, 0], flat[used, 1]
                else:
                    columns = tuple(array.T)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(columns[0]), index[group])), pa.array(np.full(len(columns[0]), part, np.int32)),
                     *[pa.array(np.ascontiguousarray(c)) for c in columns]], ["model", "part", "cell", "one", "two"])

    names = list(index)
    sums = {g: np.zeros((len(asked[g][2]) * features * asked[g][3], 2), np.int64) for g in asked}
    counts: dict = {g: [np.zeros((0, 3), np.int64)] for g in asked}
    most = sum(map(len, sums.values())) + len(scoring) * 2 * LIMIT * STEPS
    if tasks * most <= DRIVER_SUMS:
        found = blocks.mapInArrow(whole, "model long, part int, data binary").toArrow()
        for model, part, data in zip(*(c.to_pylist() for c in found.columns)):
            array = np.frombuffer(data, np.int64)
            if part == 0:
                sums[names[model]] += array.reshape(-1, 2)
            else:
                counts[names[model]].append(array.reshape(-1, 3))
    else:
        found = (blocks.mapInArrow(cells, "model long, part int, cell long, one long, two long").groupBy("model", "part", "cell")
                 .agg(F.sum("one").alias("one"), F.sum("two").alias("two")).toArrow())
        model, part, cell, one, two = (found.column(c).to_numpy() for c in ("model", "part", "cell", "one", "two"))
        order = np.argsort(model, kind="stable")
        bounds = np.searchsorted(model[order], np.arange(len(names) + 1))
        for i, group in enumerate(names):
            mine = order[bounds[i]:bounds[i + 1]]
            at, scored = mine[part[mine] == 0], mine[part[mine] == 1]
            sums[group][cell[at], 0], sums[group][cell[at], 1] = one[at], two[at]
            counts[group].append(np.stack([x[scored] for x in (cell, one, two)], axis=1))
    return {g: (dict(zip(asked[g][2], sums[g].reshape(len(asked[g][2]), features, asked[g][3], 2))),
                np.concatenate(counts[g])) for g in asked}


def _tasks(blocks: DataFrame) -> int:
    """How many tasks read some of the stored blocks."""
    return blocks.select(F.spark_partition_id().alias("task")).distinct().count()


def _learn(blocks: DataFrame, groups: list, features: int, options: BoostOptions, judge: int) -> dict:
    """Models of the given groups, whose rounds share their jobs."""
    models = {g: Model(options) for g in groups}
    margins, tasks = blocks, _tasks(blocks)
    while True:
        active = {g: m for g, m in models.items() if not m.done}
        if not active:
            break
        for level in range(options.max_depth):
            found = _level(margins, active, level, judge, tasks, features)
            for g, (sums, counts) in found.items():
                model = active[g]
                if level == 0 and model.trees:
                    model.judge(auc_of(counts))
                if level == 0 and not sums[1].any():
                    model.done = True  # no train rows, or all are predicted to the last unit
                if not model.done:
                    model.grow(level, sums)
            active = {g: m for g, m in active.items() if not m.done}
            if not active or not any(m.wanted(level + 1) for m in active.values()):
                break
        for model in active.values():
            model.finish()
        if active and max(len(m.trees) - m.stored for m in active.values()) >= STORED_ROUNDS:
            stored = _with_margins(margins, active)
            if margins is not blocks:
                discard(margins)
            margins, tasks = stored, _tasks(stored)
    if margins is not blocks:
        discard(margins)
    return models


def _with_margins(blocks: DataFrame, models: dict) -> DataFrame:
    """The blocks of the groups that still learn, with the margins after all trees so far."""
    todo = {g: m.trees[m.stored:] for g, m in models.items()}
    names = blocks.columns

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                row = {c: one.column(c)[0].as_py() for c in names}
                if row["group"] in todo:
                    margin = _Rows.of(row).margins(todo[row["group"]]).tobytes()
                    columns = [pa.array([margin], pa.binary()) if c == "margin" else one.column(c) for c in names]
                    yield pa.RecordBatch.from_arrays(columns, names)

    stored = materialize(blocks.mapInArrow(add, blocks.schema))
    for model in models.values():
        model.stored = len(model.trees)
    return stored


# -- preparation and the public functions ------------------------------------------------------------------------------

@dataclass
class Binning:
    """How rows become bins: medians and bin edges per group (stored tables) and the categories of the train rows.

    Inside, numeric features are called n0, n1, ... and categorical ones c0, c1, ..., whatever the caller calls them.
    """
    numeric: list[str]
    categorical: list[str]
    categories: list[list[str]]
    fill_category: str | None
    bins: int
    medians: DataFrame | None = None
    edges: DataFrame | None = None

    @property
    def features(self) -> int:
        return len(self.numeric) + sum(map(len, self.categories))

    def inputs(self) -> list[Column]:
        """The feature columns of a caller's table under their inner names; NULL categories are filled."""
        filled = [F.col(column(c)) if self.fill_category is None else
                  F.coalesce(F.col(column(c)), F.lit(self.fill_category)) for c in self.categorical]
        return [*[F.col(column(c)).cast("double").alias(f"n{i}") for i, c in enumerate(self.numeric)],
                *[c.alias(f"c{i}") for i, c in enumerate(filled)]]

    def values(self, rows: DataFrame) -> DataFrame:
        """The features of ``rows`` (group, the inner names and others) as one array."""
        numbers = [f"n{i}" for i in range(len(self.numeric))]
        filled = join_measured(rows, self.medians, ["group"], 16 + 8 * len(numbers), "left") if numbers else rows
        values = [F.coalesce(blank_nan(F.col(n)), F.col(f"median_{n}"), F.lit(0.0)) for n in numbers]
        values += [F.coalesce((F.col(f"c{i}") == v).cast("double"), F.lit(0.0))
                   for i, known in enumerate(self.categories) for v in known]
        inner = {*numbers, *[f"median_{n}" for n in numbers], *[f"c{i}" for i in range(len(self.categorical))]}
        return filled.select(*[column(c) for c in filled.columns if c not in inner],
                             F.array(*values).cast("array<double>").alias("values"))

    def __call__(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the features replaced by their bins; all 0 in a group without train rows.

        The edges of few groups go to Python workers, which look up whole columns at once; those of more are joined.
        """
        most = max(1, SENT_EDGES // (8 * self.features * self.bins))
        known = self.edges.limit(most + 1).collect()
        if len(known) <= most:
            return self._looked_up(rows, known)
        valued = join_measured(self.values(rows), self.edges, ["group"], 16 + 8 * self.bins * self.features, "left")
        bins = F.transform("values", lambda v, i: F.coalesce(
            F.size(F.filter(F.get("edges", i), lambda edge: edge < v)), F.lit(0)))
        return valued.withColumn("bins", bins).drop("values", "edges")

    def _looked_up(self, rows: DataFrame, known: list) -> DataFrame:
        """The same, given the rows (group, edges) of all groups."""
        spark = rows.sparkSession
        numbers, categories = [f"n{i}" for i in range(len(self.numeric))], self.categories
        places = spark.createDataFrame([(r["group"], i) for i, r in enumerate(known)],
                                       StructType([self.edges.schema["group"], StructField("place", IntegerType())]))
        if numbers:
            places = join_measured(places, self.medians, ["group"], 16 + 8 * len(numbers), "left")
        fills = {r["place"]: [r[f"median_{n}"] or 0.0 for n in numbers] for r in places.collect()}
        edges = [[np.array(e if e is not None else [], np.float64) for e in r["edges"]] for r in known]
        numbered = join_measured(rows, places.select("group", "place"), ["group"], 32, "left")
        kept = [c for c in rows.columns if c not in {*numbers, *[f"c{i}" for i in range(len(categories))]}]
        width = self.features
        types = ", ".join(f"{column(c)} {rows.schema[c].dataType.simpleString()}" for c in kept)

        def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                place = batch.column("place").fill_null(-1).to_numpy()
                bins = np.zeros((batch.num_rows, width), np.int32)
                values = [batch.column(n).to_numpy(zero_copy_only=False).astype(np.float64) for n in numbers]
                values += [pc.fill_null(pc.equal(batch.column(f"c{i}"), v), False).to_numpy(zero_copy_only=False).astype(np.float64)
                           for i, some in enumerate(categories) for v in some]
                for p in np.unique(place[place >= 0]).tolist():
                    mine = np.flatnonzero(place == p)
                    for f, value in enumerate(values):
                        value = value[mine]
                        if f < len(numbers):
                            value[np.isnan(value)] = fills[p][f]
                        bins[mine, f] = np.searchsorted(edges[p][f], value)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * width, pa.int32()), pa.array(bins.ravel()))
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], lists], [*kept, "bins"])

        return numbered.mapInArrow(look_up, f"{types}, bins array<int>")


def _fit_binning(binning: Binning, rows: DataFrame) -> None:
    """All statistics from the train rows of each group: medians, categories, and edges of bins with about equal counts.

    Edges come from one mergeable sketch per group and feature, the same way for every size.
    """
    train = rows.filter(F.col("role") == TRAIN)
    if binning.numeric:
        numbers = [f"n{i}" for i in range(len(binning.numeric))]
        binning.medians = exact_medians(train, numbers, ["group"]).withColumnsRenamed({n: f"median_{n}" for n in numbers})
        binning.medians = materialize(binning.medians)
    binning.categories = list(fit_categories(train, [f"c{i}" for i in range(len(binning.categorical))]).values())
    shares = F.array(*[F.lit(i / binning.bins) for i in range(1, binning.bins)])
    edges = [F.percentile_approx(F.col("values")[i], shares, F.lit(10_000)) for i in range(binning.features)]
    binning.edges = materialize(few_parts(binning.values(train)).groupBy("group").agg(F.array(*edges).alias("edges")))


_TREES = ArrayType(StructType([StructField("feature", ArrayType(IntegerType())), StructField("last", ArrayType(IntegerType())),
                               StructField("leaves", ArrayType(LongType()))]))


@dataclass
class GroupModels:
    """Fitted models of all groups; ``trees`` is a stored table with one row per group that had train rows."""
    binning: Binning
    trees: DataFrame

    def score(self, df: DataFrame, group: str | None, keep: list[str]) -> DataFrame:
        """``keep``, the predicted class and the margin of every row; both NULL for a group without a model."""
        names = {f"kept_{i}": c for i, c in enumerate(keep)}
        key = F.col(column(group)) if group else F.lit(0)
        rows = df.select(key.alias("group"), *[F.col(column(c)).alias(n) for n, c in names.items()],
                         *self.binning.inputs(), F.lit(0).alias("label"), F.lit(TRAIN).alias("role"))
        blocks = _pack(materialize(self.binning(rows)), list(names))
        joined = join_measured(blocks, self.trees, ["group"], TREE_BYTES, "left")
        types = ", ".join(f"{column(n)} {rows.schema[n].dataType.simpleString()}" for n in names)

        def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    one = batch.slice(i, 1)
                    row = {c: one.column(c)[0].as_py() for c in ("rows", "bins", "label", "role", "margin", "trees")}
                    trees = None if row["trees"] is None else [
                        Tree(*(np.array(t[c], np.int64) for c in Tree._fields)) for t in row["trees"]]
                    margin = None if trees is None else _Rows.of(row).margins(trees)
                    empty = [None] * row["rows"]
                    yield pa.RecordBatch.from_arrays(
                        [*[one.column(n).flatten() for n in names],
                         pa.array(empty if margin is None else (margin > 0).astype(np.int32), pa.int32()),
                         pa.array(empty if margin is None else margin / MARGIN, pa.float64())],
                        [*names, "prediction", "margin"])

        scored = joined.mapInArrow(predict, f"{types}{', ' if names else ''}prediction int, margin double")
        return scored.select(*[F.col(n).alias(c) for n, c in names.items()], "prediction", "margin")

    def save(self, path: str) -> str:
        """Write the model below ``path``: trees, medians, edges, and one row that describes the columns."""
        spark, binning = self.trees.sparkSession, self.binning
        about = json.dumps({name: getattr(binning, name) for name in (
            "numeric", "categorical", "categories", "fill_category", "bins")})
        spark.createDataFrame([(about,)], "about string").write.mode("overwrite").parquet(f"{path}/about")
        for name, table in (("trees", self.trees), ("medians", binning.medians), ("edges", binning.edges)):
            if table is not None:
                table.write.mode("overwrite").parquet(f"{path}/{name}")
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> GroupModels:
        about = json.loads(spark.read.parquet(f"{path}/about").first()[0])
        binning = Binning(**about, edges=spark.read.parquet(f"{path}/edges"))
        if binning.numeric:
            binning.medians = spark.read.parquet(f"{path}/medians")
        return cls(binning, spark.read.parquet(f"{path}/trees"))


def _series(sizes: list, features: int, options: BoostOptions) -> Iterator[list]:
    """Groups that learn together, so that the driver's sums stay bounded."""
    held, used = [], 0
    for group, rows in sizes:
        cost = features * options.bins * 2 ** (options.max_depth - 1) + min(rows, 2 * LIMIT * STEPS)
        if held and used + cost > DRIVER_SUMS:
            yield held
            held, used = [], 0
        held.append(group)
        used += cost
    if held:
        yield held


def fit_groups(df: DataFrame, group: str | None, label: str, test: str, numeric: list[str],
               categorical: list[str] = (), fill_category: str | None = None, options: BoostOptions = BoostOptions(),
               watch: str | None = None, block_rows: int = BLOCK_ROWS) -> tuple[GroupModels, DataFrame]:
    """One boosted model per group, or one of all rows if ``group`` is None, and one row of statistics each.

    ``test`` is a boolean column; its rows stop the training by their AUC and are also the reported test rows, which
    makes the test scores optimistic. With the boolean column ``watch`` those rows stop the training instead, and the
    test rows take no part in it. A NULL label is an error. The best round counts; later trees are dropped. The driver
    holds one model and, at a time, the sums of one level of the groups that learn together.
    """
    numeric, categorical = list(numeric), list(categorical)
    if not numeric and not categorical:
        raise ValueError("no feature columns")
    role = F.when(F.col(column(test)), TEST).when(F.col(column(watch)) if watch else F.lit(False), WATCH).otherwise(TRAIN)
    judge = WATCH if watch else TEST
    checked = F.when(F.col(column(label)).isNull(), F.raise_error(F.lit(f"{label} is NULL")).cast("int")
                     ).otherwise(F.col(column(label)).cast("int"))
    start = datetime.datetime.now()
    binning = Binning(numeric, categorical, [], fill_category, options.bins)
    rows = materialize(df.select((F.col(column(group)) if group else F.lit(0)).alias("group"), checked.alias("label"),
                                 role.alias("role"), *binning.inputs()))
    _fit_binning(binning, rows)
    binned = materialize(binning(rows))
    blocks = materialize(_pack(binned, rows=block_rows))
    discard(rows, binned)
    sizes = blocks.groupBy("group").agg(F.sum("rows")).orderBy("group").collect()
    models = {}
    for some in _series(sizes, binning.features, options):
        models |= _learn(blocks, some, binning.features, options, judge)
    end = datetime.datetime.now()

    spark, key = df.sparkSession, blocks.schema["group"]
    kept = {g: m.trees[:m.best_round + 1] for g, m in models.items() if m.best_round is not None}
    trees = spark.createDataFrame(
        [(g, [tuple(part.tolist() for part in t) for t in ts]) for g, ts in kept.items()],
        StructType([key, StructField("trees", _TREES)]))
    fitted = GroupModels(binning, materialize(trees))
    progress = spark.createDataFrame(
        [(g, start.strftime(_TIME), end.strftime(_TIME), round((end - start).total_seconds(), 1),
          models[g].best_round) for g, _ in sizes],
        StructType([key, *STATS_SCHEMA.fields[1:4], STATS_SCHEMA["best_iteration"]]))
    stats = _statistics(blocks, fitted.trees, progress)
    discard(blocks)
    return fitted, stats


def _statistics(blocks: DataFrame, trees: DataFrame, progress: DataFrame) -> DataFrame:
    """Weighted scores of both sides and the AUC of the test rows, by the models' best rounds."""
    kind = blocks.schema["group"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                rows = _Rows.of(row)
                margin = rows.margins([Tree(*(np.array(t[c], np.int64) for c in Tree._fields)) for t in row["trees"]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["group"]] * row["rows"], batch.schema.field("group").type),
                     pa.array(rows.role.astype(np.int32)), pa.array(rows.label.astype(np.int32)),
                     pa.array((margin > 0).astype(np.int32)), pa.array(scores_at(margin))],
                    ["group", "role", "label", "predicted", "score"])

    scored = materialize(join_measured(blocks, trees, ["group"], TREE_BYTES).mapInArrow(
        score, f"group {kind}, role int, label int, predicted int, score long"))
    sides = weighted_scores(scored, "label", "predicted", ["group", "role"])
    wide = sides.groupBy("group").agg(*[
        F.max(F.when(F.col("role") == r, F.col(n))).alias(f"{side}_{n}")
        for side, r in (("train", TRAIN), ("test", TEST)) for n in _SCORES])
    auc = area_under_curve(scored.filter(F.col("role") == TEST), "label", "score", ["group"], DIGITS)
    joined = join_null_safe(join_null_safe(progress, wide, ["group"], "left"),
                            auc.withColumnRenamed("auc", "test_auc"), ["group"], "left")
    found = materialize(joined.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in STATS_SCHEMA.fields]))
    discard(scored)
    return found


def train_groups(df: DataFrame, group: str, label: str, test: str, numeric: list[str], categorical: list[str] = (),
                 fill_category: str | None = None, options: BoostOptions = BoostOptions(), watch: str | None = None,
                 block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The statistics of ``fit_groups``: one row per group."""
    return fit_groups(df, group, label, test, numeric, categorical, fill_category, options, watch, block_rows)[1]
