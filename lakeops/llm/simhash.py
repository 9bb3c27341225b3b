"""SimHash near-duplicates: fingerprints, an embedding into segment bit counts, a grid join there, exact checks."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from lakeops.llm.common import fresh_name, map_batches, text_of
from lakeops.llm.components import component_roots
from lakeops.session import materialize

WORDS = 3
DISTANCE = 2
SEED = 42
SEGMENTS = 16
#: A grid cell with more distinct fingerprints is cut further by equal bits; both ways find the same links.
CELL_ROWS = 4096
_BLOCK = 50_000
_COMPARED = 1 << 20


def fingerprint(text: str, words: int = WORDS) -> int:
    """64 majority bits over the hashes of all word shingles of the text; 0 without words."""
    tokens = text.encode().lower().split()  # of bytes: A-Z only, split at the six ASCII white spaces
    if not tokens:
        return 0
    ones, total = np.zeros(64, np.int64), 0
    digest = partial(xxhash.xxh64_digest, seed=SEED)
    for start in range(0, max(1, len(tokens) - words + 1), _BLOCK):
        part = tokens[start:start + _BLOCK + words - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(words)))) if len(part) >= words else [b" ".join(part)]
        bits = np.unpackbits(np.frombuffer(b"".join(map(digest, shingles)), np.uint8)).reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int64)
        total += len(bits)
    return int.from_bytes(np.packbits(ones * 2 > total).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", words: int = WORDS) -> tuple[DataFrame, str]:
    """``docs`` without its text but with the fingerprint as a signed long, and that column's name."""
    name = fresh_name(docs, "print")
    keep = [c for c in docs.columns if c != text]
    frame = docs.select(*[docs[f"`{c}`"] for c in keep], text_of(text).alias("text"))
    schema = frame.drop("text").withColumn(name, F.lit(0).cast("long")).schema

    def batch_prints(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = [fingerprint(t, words) for t in batch.column(len(keep)).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(np.array(values, np.uint64).view(np.int64), pa.int64())], schema.names)

    return map_batches(frame, batch_prints, schema), name


def _counts(prints: np.ndarray, segments: int) -> np.ndarray:
    """Number of one bits in each segment of each fingerprint."""
    bits = np.unpackbits(prints.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return bits.reshape(len(prints), segments, -1).sum(axis=2, dtype=np.int64)


def _cells(prints: np.ndarray, segments: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Grid points within half the distance of each fingerprint's point, as (row, packed point).

    Two points at Manhattan distance d or less have a grid point between them that is at most (d + 1) // 2 from
    both, so they meet there.
    """
    width = 64 // segments
    scale = np.array([(width + 3) ** i for i in range(segments)], np.uint64)
    steps = {tuple([0] * segments)}
    for _ in range((distance + 1) // 2):
        steps |= {s[:i] + (s[i] + d,) + s[i + 1:] for s in steps for i in range(segments) for d in (-1, 1)}
    shifts = np.array(sorted(steps), np.int64)
    points = _counts(prints, segments)
    out_rows, out_points = [], []
    for shift in shifts:
        moved = points + shift
        inside = ((moved >= 0) & (moved <= width)).all(axis=1)
        out_rows.append(np.flatnonzero(inside))
        out_points.append(((moved[inside] + 1).astype(np.uint64) * scale).sum(axis=1, dtype=np.uint64))
    return np.concatenate(out_rows), np.concatenate(out_points)


def _star_links(prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is within the distance in one cell: a spanning forest, never all pairs.

    Rows of the distance table are made a few at a time; each unvisited fingerprint grows a tree breadth first.
    """
    left = np.arange(len(prints))
    a, b = [], []
    while len(left) > 1:
        frontier, left = left[:1], left[1:]
        while len(frontier) and len(left):
            step = max(1, _COMPARED // len(left))
            part, frontier = frontier[:step], frontier[step:]
            near = np.bitwise_count(prints[part][:, None] ^ prints[left][None, :]) <= distance
            hit = near.any(axis=0)
            if hit.any():
                a.append(prints[part][near[:, hit].argmax(axis=0)])
                b.append(prints[left[hit]])
                frontier = np.concatenate([frontier, left[hit]])
                left = left[~hit]
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def print_links(prints: DataFrame, name: str, distance: int = DISTANCE, segments: int = SEGMENTS) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints within the Hamming distance, no all-pairs output.

    The Manhattan distance of the segment counts never exceeds the Hamming distance, so linked fingerprints share a
    grid point. Cells with many distinct fingerprints are split by position and value of ``distance + 1`` bit blocks:
    two fingerprints within the distance agree in one of the blocks whole.
    """
    blocks = np.array_split(np.arange(64), distance + 1)
    masks = [sum(1 << int(63 - i) for i in block) for block in blocks]

    def spread(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = batch.column(0).to_numpy().view(np.uint64)
        rows, points = _cells(values, segments, distance)
        return pa.RecordBatch.from_arrays([pa.array(points.view(np.int64)), pa.array(values[rows].view(np.int64))],
                                          ["cell", "print"])

    distinct = prints.select(F.col(name).alias("print")).distinct()
    cells = materialize(map_batches(distinct, spread, "cell long, print long", rows=10_000))
    full = cells.groupBy("cell").agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)
    sizes = materialize(full)
    split = F.array(*[F.struct(F.lit(i).alias("block"), F.col("print").bitwiseAND(F.lit(np.uint64(m).view(np.int64).item()))
                               .alias("bits")) for i, m in enumerate(masks)])
    whole = F.array(F.struct(F.lit(-1).alias("block"), F.lit(0).cast("long").alias("bits")))
    groups = (cells.join(sizes, "cell")
              .withColumn("part", F.explode(F.when(F.col("rows") > CELL_ROWS, split).otherwise(whole)))
              .select("cell", F.col("part.block").alias("block"), F.col("part.bits").alias("bits"), "print"))

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell, bounds, values in _whole_groups(batches):
            sizes = np.diff(bounds)
            twos = bounds[:-1][sizes == 2]
            near = np.bitwise_count(values[twos] ^ values[twos + 1]) <= distance
            a, b = [values[twos[near]]], [values[twos[near] + 1]]
            for start, size in zip(bounds[:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist()):
                one, two = _star_links(values[start:start + size], distance)
                a.append(one)
                b.append(two)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64), pa.int64()) for x in (a, b)],
                                             ["a", "b"])

    ordered = groups.repartition("cell", "block", "bits").sortWithinPartitions("cell", "block", "bits")
    return ordered.mapInArrow(links, "a long, b long").distinct()


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Sorted rows of (cell, block, bits, print) as (first three, group bounds, prints), never cutting a group."""
    kept = None
    for batch in batches:
        new = [np.asarray(batch.column(i).to_numpy(zero_copy_only=False)) for i in range(4)]
        kept = new if kept is None else [np.concatenate(pair) for pair in zip(kept, new)]
        change = np.flatnonzero((kept[0][1:] != kept[0][:-1]) | (kept[1][1:] != kept[1][:-1])
                                | (kept[2][1:] != kept[2][:-1])) + 1
        if len(change):
            yield kept[:3], np.concatenate(([0], change)), kept[3][:change[-1]].view(np.uint64)
            kept = [x[change[-1]:] for x in kept]
    if kept is not None and len(kept[0]):
        yield kept[:3], np.array([0, len(kept[0])]), kept[3].view(np.uint64)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS,
                    distance: int = DISTANCE) -> DataFrame:
    """Per row: key, fingerprint (16 hex digits), component_id (the smallest key reachable over links).

    Rows with equal fingerprints are linked, so the search runs over distinct fingerprints only: a hot group of
    copies is one row there. NULL texts and texts without words have fingerprint zero. NULL keys are given a
    component like others but never name one (a component of NULL keys alone has NULL).
    """
    prints, name = fingerprints(docs.select(docs[key].alias("key"), docs[text].alias("text")), words=words)
    prints = materialize(prints)
    roots = materialize(component_roots(print_links(prints, name, distance)))
    least = prints.groupBy(name).agg(F.min("key").alias("least"))
    named = least.join(roots.withColumnRenamed("node", name), name, "left").withColumn(
        "root", F.coalesce("root", name))
    components = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = materialize(named.select(name, "root").join(components, "root").drop("root"))
    return prints.join(by_print, name).select(
        F.col("key").alias(key), F.lower(F.lpad(F.hex(name), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each component: that of its smallest key; rows repeating that key go too.

    Rows without a key cannot be told apart and are all kept unless their component holds a key.
    """
    marked = near_duplicates(docs, key, text, **options)
    work = fresh_name(docs, "_first")
    first = marked.filter(F.col(key) == F.col("component_id")).select(F.col(key).alias(work)).distinct()
    kept = docs.join(first.hint("merge"), docs[key] == first[work]).drop(work).dropDuplicates([key])
    lone = marked.filter(F.col(key).isNull() & F.col("component_id").isNull()).limit(1)
    return kept.unionByName(docs.filter(docs[key].isNull()).join(lone.select(F.lit(1).alias("_lone")), how="left_semi"))
