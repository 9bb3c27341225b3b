"""Nearest vectors by inner product: inverted lists, rotated column blocks, and tests that abandon candidates early."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeops.llm.common import map_batches
from lakeops.session import materialize

#: The index is fitted on at most so many distinct vectors; every vector is then put into its list.
FIT_ROWS = 16_384
ROWS_PER_LIST = 32
FIT_ROUNDS = 8
#: Lists are probed, nearest first, until the fitted vectors' own neighbours are found with this recall.
RECALL = 0.97
TUNED_QUERIES = 256
BOUND_ROWS = 2048
#: Rotated dimensions read at once, and the width of the test: a candidate goes when its partial distance, carried on
#: to all dimensions, exceeds the bound by so many standard deviations.
COLUMNS = 16
DEVIATIONS = 2.4
#: Vectors that a task holds at once: a 64th of the table within these bounds. Queries pass by in batches.
LEAST_BLOCK, MOST_BLOCK = 4096, 65_536
BLOCKS = 64
BATCH_QUERIES = 2048
#: Vectors of one list that are compared with ``QUERIES_AT_ONCE`` queries.
VECTORS_AT_ONCE = 8192
QUERIES_AT_ONCE = 128


@dataclass
class Index:
    """Rotation, largest norm, list centres (rotated), how many lists to probe, and some vectors that bound distances."""

    rotation: np.ndarray
    norm: float
    centres: np.ndarray
    probes: int
    bounding: np.ndarray
    bounding_lists: np.ndarray

    def rotated(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        """Vectors of equal length with one more dimension, so that the largest inner product is the least distance."""
        square = (vectors ** 2).sum(axis=1)
        extra = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(0, self.norm ** 2 - square))
        return np.hstack([vectors, extra[:, None]]) @ self.rotation

    def distances(self, rows: np.ndarray, others: np.ndarray) -> np.ndarray:
        return np.maximum(0, (rows ** 2).sum(1)[:, None] + (others ** 2).sum(1)[None, :] - 2 * rows @ others.T)


def fit(vectors: np.ndarray, norm: float, lists: int, nearest: int) -> Index:
    """Random rotation, k-means centres, and the number of probes that a brute-force search of the sample asks for."""
    rng = np.random.default_rng(5)
    dims = vectors.shape[1] + 1
    rotation, signs = np.linalg.qr(rng.standard_normal((dims, dims)))
    index = Index(rotation * np.sign(np.diag(signs)), norm, np.zeros((0, dims)), 1, np.zeros((0, dims)), np.zeros(0, int))
    rows = index.rotated(vectors, query=False)
    centres = rows[rng.choice(len(rows), min(lists, len(rows)), replace=False)]
    for _ in range(FIT_ROUNDS):
        owner = index.distances(rows, centres).argmin(axis=1)
        counts = np.bincount(owner, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, owner, rows)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(1, counts)[:, None], centres)
    owner = index.distances(rows, centres).argmin(axis=1)
    asked = rng.choice(len(rows), min(TUNED_QUERIES, len(rows)), replace=False)
    queries = index.rotated(vectors[asked], query=True)
    true = np.argsort(index.distances(queries, rows), axis=1)[:, :nearest + 1]
    place = np.argsort(np.argsort(index.distances(queries, centres), axis=1), axis=1)
    needed = np.sort(np.take_along_axis(place, owner[true], axis=1).ravel())
    probes = int(needed[min(len(needed) - 1, math.ceil(RECALL * len(needed)))]) + 1
    bounding = rng.choice(len(rows), min(BOUND_ROWS, len(rows)), replace=False)
    return Index(index.rotation, norm, centres, probes, rows[bounding], owner[bounding])


def _matrix(column) -> np.ndarray:
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return array.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(array), -1)


def adaptive_scan(index: Index, asked: np.ndarray, bounds: np.ndarray, rows: np.ndarray,
                  wanted: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vector, distance) of at least the best ``wanted`` vectors of one list within each query's bound.

    Both sides are rotated; the list is read one column block after the other. After each, the hypothesis that a
    candidate is within the bound (the least of the given one and the list's own) is tested on its partial distance.
    """
    dims = index.rotation.shape[0]
    edges = [*range(0, dims, COLUMNS), dims]
    columns = [np.ascontiguousarray(rows[:, a:b]) for a, b in zip(edges, edges[1:])]
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    for start in range(0, len(asked), QUERIES_AT_ONCE):
        part = asked[start:start + QUERIES_AT_ONCE]
        partial = index.distances(part[:, :edges[1]], columns[0])
        limit = bounds[start:start + len(part)].copy()
        if len(rows) > wanted:
            first = np.argpartition(partial, wanted - 1, axis=1)[:, :wanted]
            limit = np.minimum(limit, ((rows[first] - part[:, None, :]) ** 2).sum(axis=2).max(axis=1))

        def within(distance, row, read):
            slack = (1 + DEVIATIONS / math.sqrt(read)) ** 2 if read < dims else 1 + 1e-9
            return distance * (dims / read) <= limit[row] * slack

        q, v = np.nonzero(within(partial, np.arange(len(part))[:, None], edges[1]))
        distance = partial[q, v]
        for block, (a, b) in zip(columns[1:], zip(edges[1:], edges[2:])):
            distance = distance + ((block[v] - part[q, a:b]) ** 2).sum(axis=1)
            keep = within(distance, q, b)
            q, v, distance = q[keep], v[keep], distance[keep]
        found.append((q + start, v, distance))
    return tuple(np.concatenate(x) for x in zip(*found))


def _best(q: np.ndarray, v: np.ndarray, distance: np.ndarray, count: int) -> tuple[np.ndarray, ...]:
    """The ``count`` nearest rows of each query, in order, and each row's place among them."""
    order = np.lexsort((v, distance, q))
    q, v, distance = q[order], v[order], distance[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    keep = place < count
    return q[keep], v[keep], distance[keep], place[keep]


def scan_lists(index: Index, queries: np.ndarray, bounds: np.ndarray, probed: np.ndarray, rows: np.ndarray,
               lists: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, vector) of a few more than the best ``wanted`` of each query in its probed lists.

    ``rows`` are rotated vectors with their lists; ``probed`` says, per query and list number, whether it is probed.
    Each list, or piece of a long one, tightens the bounds for the next.
    """
    asked = index.rotated(queries, query=True)
    bounds, nearest = bounds.copy(), np.full((len(asked), wanted), np.inf)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    order = np.argsort(lists, kind="stable")
    edges = np.flatnonzero(np.concatenate(([True], lists[order][1:] != lists[order][:-1])))
    pieces = [part[i:i + VECTORS_AT_ONCE] for part in np.split(order, edges[1:])
              for i in range(0, len(part), VECTORS_AT_ONCE)]
    for at in pieces:
        mine = np.flatnonzero(probed[:, lists[at[0]]])
        if not len(mine):
            continue
        q, v, distance, place = _best(*adaptive_scan(index, asked[mine], bounds[mine], rows[at], wanted), wanted + 7)
        new = np.full((len(mine), wanted + 7), np.inf)
        new[q, place] = distance
        nearest[mine] = np.partition(np.hstack([nearest[mine], new]), wanted - 1, axis=1)[:, :wanted]
        bounds[mine] = np.minimum(bounds[mine], nearest[mine].max(axis=1))
        found.append((mine[q], at[v], distance))
    q, v, distance = (np.concatenate(x) for x in zip(*found))
    keep = distance <= bounds[q] * (1 + 1e-9)
    return _best(q[keep], v[keep], distance[keep], wanted + 7)[:2]


def _sound(vector: Column) -> Column:
    """No NULL, no component NULL, infinite or no number, not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def list_units(counts: dict[int, int], lists: int, size: int) -> tuple[list[int], list[int]]:
    """The unit of each list, neighbours together up to ``size``, and the number of blocks of each unit."""
    units, sizes = [], []
    for i in range(lists):
        n = counts.get(i, 0)
        if not sizes or sizes[-1] and sizes[-1] + n > size:
            sizes.append(0)
        sizes[-1] += n
        units.append(len(sizes) - 1)
    return units, [max(1, math.ceil(n / size)) for n in sizes]


def scan_blocks(batches: Iterator[pa.RecordBatch], index: Index, wanted: int, at_once: int) -> Iterator[pa.RecordBatch]:
    """(query, entry, score) from rows sorted by block, a block's vectors before the queries that probe its lists.

    The vectors of one block are held, the queries pass by in batches of ``at_once``.
    """
    held: list[pa.RecordBatch] = []
    block, ready, waiting = None, None, []

    def scanned() -> Iterator[pa.RecordBatch]:
        nonlocal ready
        if held and waiting:
            if ready is None:
                vectors = pa.Table.from_batches(held)
                x = _matrix(vectors.column("v"))
                ready = (x, index.rotated(x, query=False), vectors.column("list").to_numpy(),
                         vectors.column("number").to_numpy())
            x, rows, lists, entries = ready
            queries = pa.Table.from_batches(waiting)
            asks = _matrix(queries.column("v"))
            probed = np.zeros((len(asks), len(index.centres)), bool)
            for row, numbers in zip(probed, queries.column("lists").to_pylist()):
                row[numbers] = True
            q, v = scan_lists(index, asks, queries.column("bound").to_numpy(), probed, rows, lists, wanted)
            yield pa.RecordBatch.from_arrays(
                [pa.array(queries.column("number").to_numpy()[q], pa.int64()), pa.array(entries[v], pa.int64()),
                 pa.array((asks[q] * x[v]).sum(axis=1), pa.float64())], ["query", "entry", "score"])
        waiting.clear()

    for batch in batches:
        blocks, asks = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        cuts = np.flatnonzero((blocks[1:] != blocks[:-1]) | (asks[1:] != asks[:-1])) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            if a == b:
                continue
            if blocks[a] != block:
                yield from scanned()
                block, ready = blocks[a], None
                held.clear()
            if not asks[a]:
                held.append(batch.slice(a, b - a))
                continue
            for start in range(a, b, at_once):
                waiting.append(batch.slice(start, min(at_once, b - start)))
                if sum(w.num_rows for w in waiting) >= at_once:
                    yield from scanned()
    yield from scanned()


def search(table: DataFrame, queries: Callable[[Column], Column], nearest: int, key: str = "vec_id", vector: str = "embedding",
           fit_rows: int = FIT_ROWS) -> DataFrame:
    """For each row whose id ``queries`` selects: query_id, rank (from 1), vec_id, score of its nearest other rows.

    Nearness is the inner product in double precision on the original vectors; ties go to the smaller id. The search
    is approximate: as many lists are probed as give a recall of 0.97 on the fitted sample, measured against brute
    force, and each list is read by an adaptive scan; what is returned has exact scores. Rows without an id, and
    vectors that are NULL, zero, hold NULL or non-finite components, or have another number of dimensions than most
    take no part. Equal vectors are one entry with its smallest ids, equal query vectors are searched once, and
    repeated rows count once. Fewer rows than ``nearest`` give all others. Each task holds some whole lists, or one
    block of a long list, and the queries that probe them pass by, so vectors are shuffled once.
    """
    spark = table.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    rows = (table.select(table[key].cast("long").alias("id"), table[vector].cast("array<double>").alias("v"))
            .filter(F.col("id").isNotNull() & _sound(F.col("v"))))
    sizes = rows.groupBy(F.size("v").alias("dims")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dims").first()
    if sizes is None:
        return spark.createDataFrame([], schema)
    rows = materialize(rows.filter(F.size("v") == sizes.dims).distinct().withColumn("asks", queries(F.col("id"))))
    order = Window.partitionBy("v").orderBy("id")
    entries = materialize(rows.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= nearest + 1)
                          .groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
                          .withColumn("entry", F.col("ids")[0]))
    stats = entries.agg(F.count("*").alias("n"), F.max(F.aggregate(
        "v", F.lit(0.0), lambda s, x: s + x * x)).alias("square")).first()
    sample = _matrix(entries.orderBy(F.xxhash64("entry"), "entry").limit(fit_rows).select("v").toArrow().column("v"))
    lists = max(1, min(math.ceil(math.sqrt(stats.n)), len(sample) // ROWS_PER_LIST))
    sent = spark.sparkContext.broadcast(fit(sample, math.sqrt(stats.square), lists, nearest))

    def assign(batch: pa.RecordBatch) -> pa.RecordBatch:
        index = sent.value
        rotated = index.rotated(_matrix(batch.column(0)), query=False)
        nearest_list = index.distances(rotated, index.centres).argmin(axis=1)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(nearest_list.astype(np.int32))],
                                          ["v", "ids", "entry", "list"])

    stored = materialize(map_batches(entries.select("v", "ids", "entry"), assign,
                                     "v array<double>, ids array<long>, entry long, list int", rows=4096))
    counts = {r.list: r.n for r in stored.groupBy("list").agg(F.count("*").alias("n")).collect()}
    units, blocks = list_units(counts, lists, max(LEAST_BLOCK, min(MOST_BLOCK, math.ceil(stats.n / BLOCKS))))
    first = np.cumsum([0, *blocks]).tolist()
    unit_of = np.array(units)

    def probe(batch: pa.RecordBatch) -> pa.RecordBatch:
        index = sent.value
        rotated = index.rotated(_matrix(batch.column(0)), query=True)
        lists = np.argsort(index.distances(rotated, index.centres), axis=1)
        near = index.distances(rotated, index.bounding)
        # Twice as many fitted vectors lie within the bound as are asked for, and lists are probed at least until
        # they hold a few more of these than are asked for, the query's own among them.
        enough = 2 * nearest + 2
        probes = np.full(len(rotated), min(index.probes, lists.shape[1]))
        if near.shape[1] > enough:
            close = np.argpartition(near, enough, axis=1)[:, :enough + 1]
            bound = np.take_along_axis(near, close, axis=1).max(axis=1)
            place = np.take_along_axis(np.argsort(lists, axis=1), index.bounding_lists[close], axis=1)
            probes = np.maximum(probes, np.sort(place, axis=1)[:, nearest + 5] + 1)
        else:
            bound, probes = np.full(len(rotated), np.inf), np.full(len(rotated), lists.shape[1])
        probed = np.zeros((len(rotated), lists.shape[1]), bool)
        np.put_along_axis(probed, lists, np.arange(lists.shape[1])[None, :] < probes[:, None], axis=1)
        # Per query the units it probes, each with its probed lists.
        asks, numbers = np.nonzero(probed)
        new = np.flatnonzero(np.concatenate(
            ([True], (asks[1:] != asks[:-1]) | (unit_of[numbers][1:] != unit_of[numbers][:-1]))))
        inner = pa.ListArray.from_arrays(pa.array(np.append(new, len(numbers)), pa.int32()),
                                         pa.array(numbers, pa.int32()))
        probes = pa.StructArray.from_arrays([pa.array(unit_of[numbers[new]], pa.int32()), inner], ["unit", "lists"])
        outer = np.searchsorted(asks[new], np.arange(len(rotated) + 1))
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(bound), pa.ListArray.from_arrays(pa.array(outer, pa.int32()), probes)],
            ["v", "query", "bound", "probes"])

    asking = rows.filter("asks").groupBy("v").agg(F.min("id").alias("query"))
    asked = map_batches(asking.select("v", "query"), probe, "v array<double>, query long, bound double, "
                        "probes array<struct<unit: int, lists: array<int>>>", rows=1024)

    def number(of: list[int], at: Column) -> Column:
        return F.element_at(F.lit(of), at + 1)

    # A unit is some whole lists, or all blocks of a long list; a query goes once to each block of a unit it probes.
    left = (stored.withColumn("unit", number(units, F.col("list")))
            .withColumn("block", number(first, F.col("unit"))
                        + F.pmod(F.xxhash64("entry"), number(blocks, F.col("unit"))).cast("int"))
            .select("block", F.lit(False).alias("asks"), "v", F.col("entry").alias("number"), "list",
                    F.lit(None).cast("double").alias("bound"), F.lit(None).cast("array<int>").alias("lists")))
    right = (asked.select("v", "query", "bound", F.inline("probes"))
             .select(F.explode(F.sequence(number(first, F.col("unit")), number(first, F.col("unit") + 1) - 1)).alias("block"),
                     F.lit(True).alias("asks"), "v", F.col("query").alias("number"),
                     F.lit(None).cast("int").alias("list"), "bound", "lists"))
    met = left.unionByName(right).repartitionById(first[-1], "block").sortWithinPartitions("block", "asks")
    at_once = BATCH_QUERIES
    hits = met.mapInArrow(lambda batches: scan_blocks(batches, sent.value, nearest + 1, at_once),
                          "query long, entry long, score double")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "entry")
    top = (hits.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= nearest + 1)
           .join(entries.select("entry", "ids"), "entry")
           .groupBy("query").agg(F.collect_list(F.struct("score", "ids")).alias("hits")))
    named = (rows.filter("asks").select("id", "v").join(asking, "v").select("id", "query").join(top, "query"))
    pairs = F.flatten(F.transform("hits", lambda h: F.transform(
        h["ids"], lambda i: F.struct((-h["score"]).alias("minus"), i.alias("other")))))
    others = F.slice(F.array_sort(F.filter(pairs, lambda p: p["other"] != F.col("id"))), 1, nearest)
    return named.select(F.col("id").alias("query_id"), F.posexplode(others).alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("hit.other").alias("vec_id"),
        (-F.col("hit.minus")).alias("score"))

