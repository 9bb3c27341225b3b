"""Compression of vectors to short codes: one small codebook per part, refined by Lloyd rounds over cover trees.

Each block of rows gets one cover tree per part when it is first read; the trees are stored. A node covers a range of
the block's points, knows its own point and how far its farthest point lies, and the running sums of the points give
the sum of any node's range. A round walks the trees from the top: if one codebook entry is nearer to a node's point
than every other by more than twice the node's radius, it is the nearest of all its points, which then count at once;
what is left in doubt goes to the children, and in the leaves to exact comparisons in whole numbers.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lakeops.operators.ordering import join_measured
from lakeops.session import discard, materialize

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
#: Rows of a block, whose trees are built and read together, and the most numbers in it.
BLOCK_ROWS = 2048
BLOCK_NUMBERS = 1 << 22
#: Nodes of so many points are not split further.
LEAF = 8
#: Distances are compared in floating point only beyond this relative margin, so rounding never decides.
MARGIN = 1e-9


class Tree(NamedTuple):
    """A cover tree over the rows of ``points``, whose nodes are listed level by level, children side by side."""
    order: np.ndarray       # row of each place; a node covers places start to end
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray         # the node's own point
    first: np.ndarray       # its children: nodes first to last
    last: np.ndarray
    radius: np.ndarray      # at least the distance of its farthest point


def build_tree(points: np.ndarray, leaf: int = LEAF) -> Tree:
    """Split nodes into children that lie more than half the node's radius apart, until ``leaf`` points are left.

    This is the simplified cover tree: siblings are separated, nodes of different parents need not be.

    All nodes of a level are split together: each takes its own point as the first child, gives it the points within
    half the radius, then makes the first point left over the next child. Equal points end in one node of radius 0.
    """
    points = points.astype(np.float64)
    count = len(points)
    order = np.arange(count)
    squares = ((points - points[0]) ** 2).sum(axis=1)
    start, end, row = [np.zeros(1, np.int64)], [np.full(1, count)], [np.zeros(1, np.int64)]
    first, last, square = [], [], [np.array([squares.max(initial=0.0)])]
    total = 1
    while True:
        starts, ends, rows, radii = start[-1], end[-1], row[-1], square[-1]
        open_nodes = np.flatnonzero((ends - starts > leaf) & (radii > 0))
        children_from, children_to = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        first.append(children_from)
        last.append(children_to)
        if not len(open_nodes):
            break
        sizes = ends[open_nodes] - starts[open_nodes]
        owner = np.repeat(np.arange(len(open_nodes)), sizes)
        places = np.repeat(starts[open_nodes] - np.concatenate(([0], sizes.cumsum()[:-1])), sizes) + np.arange(len(owner))
        limit = radii[open_nodes] / 4
        child = np.empty(len(owner), np.int64)
        found = np.empty(len(owner))
        centre, step, child_rows, child_owner, made = rows[open_nodes], np.arange(len(owner)), [], [], 0
        owners, local = np.arange(len(open_nodes)), np.empty(len(open_nodes), np.int64)
        while len(step):
            child_rows.append(centre)
            child_owner.append(owners)
            local[owners] = np.arange(len(owners))
            mine = local[owner[step]]
            distance = ((points[order[places[step]]] - points[centre[mine]]) ** 2).sum(axis=1)
            inside = distance <= limit[owner[step]]
            child[step[inside]] = made + mine[inside]
            found[step[inside]] = distance[inside]
            made += len(owners)
            step = step[~inside]
            heads = np.flatnonzero(np.diff(owner[step], prepend=-1))
            owners, centre = owner[step[heads]], order[places[step[heads]]]
        # Children in the order of their parents, points in the order of their children.
        child_owner, child_rows = np.concatenate(child_owner), np.concatenate(child_rows)
        sequence = np.argsort(child_owner, kind="stable")
        number = np.empty(made, np.int64)
        number[sequence] = np.arange(made)
        child = number[child]
        arranged = np.argsort(child, kind="stable")
        order[places] = order[places[arranged]]
        counts = np.bincount(child, minlength=made)
        at = np.concatenate(([0], counts.cumsum()[:-1]))
        # Open nodes cover disjoint ranges in rising order, so places[at] is where a child's range begins.
        start.append(places[at])
        end.append(places[at] + counts)
        row.append(child_rows[sequence])
        square.append(np.maximum.reduceat(found[arranged], at))
        per_parent = np.bincount(child_owner, minlength=len(open_nodes))
        upto = total + per_parent.cumsum()
        children_from[open_nodes], children_to[open_nodes] = upto - per_parent, upto
        total += made
    radius = np.sqrt(np.concatenate(square)) * (1 + MARGIN)
    return Tree(order, *map(np.concatenate, (start, end, row, first, last)), radius)


class Assigner:
    """Nearest codebook entries of all points of one tree, by whole subtrees where the triangle inequality allows it."""

    def __init__(self, points: np.ndarray, tree: Tree, entries: np.ndarray):
        self.points, self.tree, self.entries = points, tree, entries
        # Products of whole numbers are exact in floating point up to 2 ** 53, and much faster there.
        width = max(1, points.shape[1])
        largest = max(int(np.abs(points).max(initial=0)), int(np.abs(entries).max(initial=0)))
        self.fast = 4 * width * largest ** 2 < 1 << 53
        kind = np.float64 if self.fast else np.int64
        self.exact, self.codes = points.astype(kind), entries.astype(kind)
        self.code_squares = (self.codes ** 2).sum(axis=1)
        self.compared = 0

    def squares(self, rows: np.ndarray) -> np.ndarray:
        """Exact squared distances of points to all entries."""
        points = self.exact[rows]
        self.compared += points.shape[0]
        if self.fast:
            return (points ** 2).sum(axis=1)[:, None] + self.code_squares - 2 * (points @ self.codes.T)
        return ((points[:, None, :] - self.codes) ** 2).sum(axis=2)

    def ranges(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(start, end, entry) of ranges of places that have one nearest entry; ties go to the lower index."""
        tree, beyond = self.tree, np.inf if self.fast else np.iinfo(np.int64).max
        nodes = np.zeros(1, np.int64)
        possible = np.ones((1, len(self.entries)), bool)
        while len(nodes):
            squares = np.where(possible, self.squares(tree.row[nodes]), beyond)
            near = squares.argmin(axis=1)
            radius = tree.radius[nodes]
            if self.tree.radius[nodes].any():
                distances = np.sqrt(squares.astype(np.float64))
                least = distances[np.arange(len(nodes)), near]
                reach = (least + 2 * radius) * (1 + MARGIN) + MARGIN
                possible &= distances <= reach[:, None]
            sure = (possible.sum(axis=1) == 1) | (radius == 0)
            yield tree.start[nodes[sure]], tree.end[nodes[sure]], near[sure]
            nodes, possible = nodes[~sure], possible[~sure]
            inner = tree.last[nodes] > tree.first[nodes]
            leaves = nodes[~inner]
            if len(leaves):
                sizes = tree.end[leaves] - tree.start[leaves]
                owner = np.repeat(np.arange(len(leaves)), sizes)
                places = np.repeat(tree.start[leaves] - np.concatenate(([0], sizes.cumsum()[:-1])), sizes) + np.arange(len(owner))
                squares = np.where(possible[~inner][owner], self.squares(tree.order[places]), beyond)
                yield places, places + 1, squares.argmin(axis=1)
            nodes, possible = nodes[inner], possible[inner]
            sizes = tree.last[nodes] - tree.first[nodes]
            possible = np.repeat(possible, sizes, axis=0)
            nodes = np.repeat(tree.first[nodes] - np.concatenate(([0], sizes.cumsum()[:-1])), sizes) + np.arange(sizes.sum())

    def sums(self) -> tuple[np.ndarray, np.ndarray]:
        """(count, componentwise sum) of the points nearest to each entry."""
        width = self.points.shape[1]
        running = np.zeros((len(self.points) + 1, width), np.int64)
        np.cumsum(self.points[self.tree.order], axis=0, out=running[1:])
        counts, totals = np.zeros(len(self.entries), np.int64), np.zeros((len(self.entries), width), np.int64)
        for start, end, near in self.ranges():
            np.add.at(counts, near, end - start)
            np.add.at(totals, near, running[end] - running[start])
        return counts, totals

    def nearest(self) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of every point."""
        by_place = np.empty(len(self.points), np.int64)
        for start, end, near in self.ranges():
            sizes = end - start
            places = np.repeat(start - np.concatenate(([0], sizes.cumsum()[:-1])), sizes) + np.arange(sizes.sum())
            by_place[places] = np.repeat(near, sizes)
        entry = np.empty(len(self.points), np.int64)
        entry[self.tree.order] = by_place
        return entry, ((self.points - self.entries[entry]) ** 2).sum(axis=1)


# -- blocks as rows ---------------------------------------------------------------------------------------------------

_COUNTS = ("start", "end", "row", "first", "last")


def _pack(tree: Tree) -> bytes:
    """Places as 16-bit numbers, as a block has far fewer rows; the radius is rounded up to 32 bits."""
    head = np.array([len(tree.order), len(tree.row)], np.uint32).tobytes()
    body = np.concatenate([tree.order, *[getattr(tree, c) for c in _COUNTS]]).astype(np.uint16).tobytes()
    return head + body + (tree.radius * (1 + 1e-6)).astype(np.float32).tobytes()


def _unpack(data: bytes) -> Tree:
    rows, nodes = (int(x) for x in np.frombuffer(data, np.uint32, 2))
    body = np.frombuffer(data, np.uint16, rows + len(_COUNTS) * nodes, 8).astype(np.int64)
    cells = [body[rows + i * nodes:rows + (i + 1) * nodes] for i in range(len(_COUNTS))]
    radius = np.frombuffer(data, np.float32, nodes, 8 + 2 * len(body)).astype(np.float64)
    return Tree(body[:rows], *cells, radius)


def _whole_numbers(vectors: pa.Array, scale: int, parts: int) -> np.ndarray:
    """floor(scale * component) of equally long vectors, a row each."""
    lengths = np.diff(vectors.offsets.to_numpy())
    length = int(lengths[0])
    if (lengths != length).any() or length % parts:
        raise ValueError(f"vectors must have one length that is a multiple of {parts}")
    flat = vectors.flatten().cast(pa.float64()).to_numpy()
    numbers = np.floor(flat * scale).reshape(len(lengths), length)
    # Below it, squared distances of whole vectors fit 63 bits.
    if length and np.abs(numbers).max(initial=0) >= math.isqrt((1 << 61) // length):
        raise ValueError("a component is too large for exact distances")
    return numbers.astype(np.int64)


def finite(vector: Column) -> Column:
    """True for a vector that is not NULL and holds only finite numbers."""
    return vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(F.abs(x) < F.lit(math.inf), F.lit(False)))


def _blocks(kept: DataFrame, scale: int, parts: int) -> DataFrame:
    """One row per block: keys, labels, length of the vectors, their whole numbers, one packed tree per part."""
    key, label = (kept.schema[c].dataType.simpleString() for c in ("key", "label"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = 0
            while start < batch.num_rows:
                width = max(1, len(batch.column(2)[start]))
                rows = max(1, min(BLOCK_ROWS, BLOCK_NUMBERS // width))
                block = batch.slice(start, rows)
                start += rows
                numbers = _whole_numbers(block.column(2), scale, parts)
                cells = numbers.reshape(len(numbers), parts, numbers.shape[1] // parts)
                trees = [_pack(build_tree(cells[:, p])) for p in range(parts)]
                small = np.abs(numbers).max(initial=0) < 1 << 31
                lists = [pa.ListArray.from_arrays(pa.array([0, block.num_rows], pa.int32()), block.column(i))
                         for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([
                    *lists, pa.array([numbers.shape[1]], pa.int32()),
                    pa.array([numbers.astype(np.int32 if small else np.int64).tobytes()], pa.binary()),
                    pa.array([trees], pa.list_(pa.binary()))], ["keys", "labels", "width", "numbers", "trees"])

    return kept.mapInArrow(build, f"keys array<{key}>, labels array<{label}>, width int, numbers binary, "
                                  "trees array<binary>")


def _assigners(batch: pa.RecordBatch, i: int, codebooks: list[np.ndarray]) -> Iterator[Assigner]:
    """The parts of block ``i`` of a batch, each with its tree and codebook; the last three columns hold the block."""
    width, data, trees = (batch.column(c)[i].as_py() for c in ("width", "numbers", "trees"))
    rows = int(np.frombuffer(trees[0], np.uint32, 1)[0])
    kind = np.int64 if width and len(data) == 8 * rows * width else np.int32
    cells = np.frombuffer(data, kind).astype(np.int64).reshape(rows, len(codebooks), width // len(codebooks))
    for p, (tree, entries) in enumerate(zip(trees, codebooks)):
        yield Assigner(np.ascontiguousarray(cells[:, p]), _unpack(tree), entries)


def refine(blocks: DataFrame, codebooks: list[np.ndarray]) -> list[np.ndarray]:
    """One Lloyd round: each entry becomes the floor of the mean of its points; unused entries stay.

    A task sends one number per entry and component, whatever its rows, and Spark sums them.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Column 0 counts, the others sum components.
        totals = [np.zeros((len(c), c.shape[1] + 1), np.int64) for c in codebooks]
        for batch in batches:
            for i in range(batch.num_rows):
                for total, one in zip(totals, _assigners(batch, i, codebooks)):
                    counts, sums = one.sums()
                    total[:, 0] += counts
                    total[:, 1:] += sums
        part = np.concatenate([np.full(t.size, p) for p, t in enumerate(totals)])
        cell = np.concatenate([np.arange(t.size) for t in totals])
        amount = np.concatenate([t.ravel() for t in totals])
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(cell, pa.int32()),
                                          pa.array(amount, pa.int64())], ["part", "cell", "amount"])

    sums = (blocks.select("width", "numbers", "trees").mapInArrow(add, "part int, cell int, amount long")
            .groupBy("part", "cell").agg(F.sum("amount").alias("amount")).collect())
    totals = [np.zeros((len(c), c.shape[1] + 1), np.int64) for c in codebooks]
    for part, cell, amount in sums:
        totals[part].flat[cell] = amount
    return [np.where(t[:, :1] > 0, t[:, 1:] // np.maximum(t[:, :1], 1), c) for t, c in zip(totals, codebooks)]


class Codes(NamedTuple):
    """``rows``: key, label, code (two hex digits per part), error; ``codebooks``: per part, entries by components."""
    rows: DataFrame
    codebooks: list[np.ndarray]


def compress(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codes:
    """Codes of all rows whose vector is not NULL and holds only finite components.

    A component x becomes the whole number floor(scale * x); from there on all arithmetic is exact. Codebooks start
    as the parts of the ``entries`` rows with the smallest keys (all, if fewer; NULL keys last, rows with one key by
    their vectors) and see ``rounds`` rounds over all rows. Nearest means the smallest squared distance, ties go to
    the lower index. ``error`` is the squared distance to the final entries, summed over parts. Repeated rows count
    each. Vectors of unequal lengths or of a length that parts do not divide raise an error, and so do components too
    large for 64-bit distances; empty vectors have the code 0 and no error. An empty table gives no rows and empty
    codebooks. The driver holds the codebooks only; tasks hold a block of at most 2,048 rows at a time.
    """
    if not 1 <= entries <= 256:
        raise ValueError("codes have two hex digits: 1 to 256 entries")
    kept = vectors.select(vectors[key].alias("key"), vectors[label].alias("label"),
                          vectors[vector].alias("vector")).filter(finite(F.col("vector")))
    seeds = kept.orderBy(F.col("key").asc_nulls_last(), "vector").select("vector").limit(entries).toArrow()
    first = [np.zeros((0, 0), np.int64)] * parts
    if seeds.num_rows:
        numbers = _whole_numbers(seeds.column(0).combine_chunks(), scale, parts)
        first = list(numbers.reshape(len(numbers), parts, numbers.shape[1] // parts).swapaxes(0, 1))
    codebooks = [np.ascontiguousarray(c) for c in first]
    blocks = materialize(_blocks(kept, scale, parts))
    for _ in range(rounds if seeds.num_rows else 0):
        codebooks = refine(blocks, codebooks)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                codes, error = [], 0
                for one in _assigners(batch, i, codebooks):
                    entry, squares = one.nearest()
                    codes.append(entry.astype(np.uint8))
                    error = error + squares
                texts = np.stack(codes, axis=1).tobytes().hex()
                size = 2 * parts
                codes = [texts[j:j + size] for j in range(0, len(texts), size)]
                block = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays(
                    [block.column("keys").flatten(), block.column("labels").flatten(), pa.array(codes, pa.string()),
                     pa.array(error, pa.int64())], ["key", "label", "code", "error"])

    types = {c: kept.schema[c].dataType.simpleString() for c in ("key", "label")}
    rows = materialize(blocks.mapInArrow(encode, f"key {types['key']}, label {types['label']}, code string, error long"))
    discard(blocks)
    return Codes(rows, codebooks)


def digest(codebooks: list[np.ndarray]) -> str:
    """SHA-256 of all components as decimal numbers by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(x) for c in codebooks for x in c.ravel().tolist()).encode()).hexdigest()


def decode(code: str, codebooks: list[np.ndarray], scale: int = SCALE) -> np.ndarray:
    """The vector that a code stands for."""
    return np.concatenate([c[int(code[2 * p:2 * p + 2], 16)] for p, c in enumerate(codebooks)]) / scale


def report(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
           **options) -> DataFrame:
    """Per kept row: key, code, error, label_error (sum of the errors of its label, NULL labels together) and
    codebooks_sha256; see ``compress``. Sums per label are aggregated first and joined back by a measured join, so a
    label may have most rows, or every row a label of its own."""
    rows, codebooks = compress(vectors, key, vector, label, **options)
    totals = materialize(rows.groupBy("label").agg(F.sum("error").alias("label_error")))
    joined = join_measured(rows, totals, ["label"], 64)
    return joined.select(F.col("key").alias(key), "code", "error", "label_error",
                         F.lit(digest(codebooks)).alias("codebooks_sha256"))


def report_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same in SQL, every vector against every entry."""
    steps = [f"""
    kept AS (
        SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * x::DOUBLE) AS BIGINT)) AS v
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    parts AS (
        SELECT vec_id, label, part, v[part * (len(v) // {parts}) + 1:(part + 1) * (len(v) // {parts})] AS x
        FROM (SELECT *, unnest(range({parts})) AS part FROM kept)),
    book0 AS (
        SELECT part, entry, x AS c
        FROM (SELECT part, x, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry FROM parts)
        WHERE entry < {entries})"""]
    nearest = """
        SELECT vec_id, label, part, x, min({{'d': d, 'e': entry}}) AS best
        FROM (SELECT p.*, b.entry,
                     list_sum(list_transform(list_zip(p.x, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
              FROM parts p JOIN book{n} b USING (part))
        GROUP BY ALL"""
    for n in range(rounds):
        steps.append(f"""
    near{n} AS MATERIALIZED ({nearest.format(n=n)}),
    mean{n} AS (
        SELECT part, entry, list((total - ((total % n) + n) % n) // n ORDER BY place) AS c
        FROM (SELECT part, best.e AS entry, place, sum(component)::BIGINT AS total, count(*) AS n
              FROM (SELECT part, best, unnest(x) AS component, unnest(range(len(x))) AS place FROM near{n})
              GROUP BY ALL)
        GROUP BY ALL),
    book{n + 1} AS MATERIALIZED (
        SELECT b.part, b.entry, coalesce(m.c, b.c) AS c FROM book{n} b LEFT JOIN mean{n} m USING (part, entry))""")
    return f"""
    WITH {','.join(steps)},
    final AS MATERIALIZED ({nearest.format(n=rounds)}),
    coded AS (
        SELECT vec_id, label, string_agg(format('{{:02x}}', best.e), '' ORDER BY part) AS code,
               sum(best.d)::BIGINT AS error
        FROM final GROUP BY vec_id, label),
    book AS (
        SELECT sha256(string_agg(component::VARCHAR, ',' ORDER BY part, entry, place)) AS codebooks_sha256
        FROM (SELECT part, entry, unnest(c) AS component, unnest(range(len(c))) AS place FROM book{rounds}))
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
    FROM coded, book"""
