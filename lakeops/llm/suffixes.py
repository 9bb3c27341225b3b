"""Removal of byte strings that repeat across documents, from suffix orders built column by column."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegralType

from lakeops.llm.common import fresh_name, map_batches, text_of
from lakeops.operators.names import column
from lakeops.operators.ordering import row_number_by
from lakeops.session import materialize

LENGTH = 50
#: A string's group is named by the least hash of its parts of this many bytes (8 and 4).
PART = 12
CHUNK_BYTES = 8 << 20
#: Bytes hashed at once, about; the places of all of them must fit the bits.
HASHED_BYTES = 1 << 20
PLACE_BITS = 24
#: Text bytes per bucket, from which the number of buckets follows.
BUCKET_BYTES = 8 << 20
#: Documents whose ranges are brought together in one value.
SHARE_ROWS = 1000
#: Symbols of one construction.
ORDER_BYTES = 1 << 18
END = 255  # never a byte of UTF-8
_FACTOR = 0x9E3779B97F4A7C15
_MIX = np.random.default_rng(7).integers(0, 2 ** 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _least_parts(raw: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place the least mixed hash of the ``PART``-byte parts of the string of ``length`` bytes there, and
    where the first part with that hash stands."""
    # Hashes of 2, 4 and 8 bytes from two halves each, then of 8 and 4.
    hashed, size = _MIX[raw], 1
    while size < 8:
        if size == 4:
            four = hashed
        hashed = hashed[:-size] * np.uint64(pow(_FACTOR, size, 1 << 64)) + hashed[size:]
        size *= 2
    count = len(raw) - PART + 1
    hashed = hashed[:count] * np.uint64(pow(_FACTOR, 4, 1 << 64)) + four[8:8 + count]
    hashed = (hashed ^ (hashed >> np.uint64(29))) * np.uint64(_FACTOR)
    hashed ^= hashed >> np.uint64(32)
    # The upper bits of a hash and its place in one number: equal ones go to the first place.
    here = np.uint64((1 << PLACE_BITS) - 1)
    least = (hashed & ~here) | np.arange(count, dtype=np.uint64)
    width, size = length - PART + 1, 1
    while size < width:
        step = min(size, width - size)
        least = np.minimum(least[:-step], least[step:])
        size += step
    place = (least & here).astype(np.int64)
    return hashed[place], place


def stretches(parts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(part, start, end, place of the least part, its hash) of neighbouring strings of ``length`` bytes with the
    same least part.

    Equal strings have equal least parts at equal places in them, wherever they stand, so one group of equal parts
    holds all copies of a string. A least part lies inside every string of its stretch, so a stretch is short.
    """
    raw = np.frombuffer(b"".join(parts), np.uint8)
    if len(raw) < length:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none.astype(np.uint64)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    starts = np.cumsum(sizes) - sizes
    names, places = _least_parts(raw, length)
    owner = np.repeat(np.arange(len(parts)), sizes)[:len(names)]
    inside = np.arange(len(names)) + length <= (starts + sizes)[owner]
    cut = np.flatnonzero((places[1:] != places[:-1]) | (owner[1:] != owner[:-1]) | (inside[1:] != inside[:-1])) + 1
    first = np.concatenate(([0], cut))
    last = np.concatenate((cut, [len(names)]))
    keep = inside[first]
    first, last = first[keep], last[keep]
    base = starts[owner[first]]
    return owner[first], first - base, last - base + length - 1, places[first] - base, names[first]


def _shuffled(numbers: np.ndarray) -> bytes:
    """The bytes of the numbers, all first bytes first, which compresses better."""
    return numbers.view(np.uint8).reshape(len(numbers), -1).T.tobytes()


def _unshuffled(raw: bytes, kind: type, n: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, n).T).view(kind).ravel()


def pack_chunk(docs: np.ndarray, variants: np.ndarray, bases: np.ndarray, parts: list[bytes], buckets: int,
               length: int) -> list[tuple[int, int, bytes]]:
    """(bucket, number, packed stretches) for a few texts; a bucket gets whole groups."""
    found, first, size = [], 0, 0
    for i, part in enumerate(parts):
        size += len(part)
        if size >= HASHED_BYTES or i == len(parts) - 1:
            owner, *rest = stretches(parts[first:i + 1], length)
            found.append([owner + first, *rest])
            first, size = i + 1, 0
    owner, start, end, place, names = (np.concatenate(x) for x in zip(*found))
    bucket = ((names >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    owner, start, end, place, bucket = (x[order] for x in (owner, start, end, place, bucket))
    bounds = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True]))) if len(bucket) else [0]
    packer = zstandard.ZstdCompressor(level=3)
    out = []
    for a, b in zip(bounds[:-1], bounds[1:]):
        body = [parts[o][s:e] for o, s, e in zip(owner[a:b].tolist(), start[a:b].tolist(), end[a:b].tolist())]
        # Differences of neighbours are small, which compresses better.
        raw = b"".join([_shuffled(np.diff(docs[owner[a:b]], prepend=0)),
                        _shuffled(np.diff(variants[owner[a:b]], prepend=0)),
                        _shuffled(np.diff(bases[owner[a:b]] + start[a:b], prepend=0)),
                        (place[a:b] - start[a:b]).astype(np.uint8).tobytes(),
                        (end[a:b] - start[a:b]).astype(np.uint8).tobytes(), *body])
        out.append((int(bucket[a]), int(b - a), packer.compress(raw)))
    return out


def unpack(n: int, packed: bytes) -> tuple[np.ndarray, ...]:
    """(documents, their variants, starts, places of the least part in the stretch, sizes, bytes)."""
    raw = zstandard.ZstdDecompressor().decompress(packed)
    wide = [np.cumsum(_unshuffled(raw[8 * n * i:8 * n * (i + 1)], np.int64, n)) for i in range(3)]
    small = [np.frombuffer(raw[i * n:(i + 1) * n], np.uint8).astype(np.int64) for i in (24, 25)]
    return (*wide, *small, raw[26 * n:])


def _hash_at(raw: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` bytes at each place."""
    out = np.zeros(len(at), np.uint64)
    for i in range(size):
        out = out * np.uint64(_FACTOR) + _MIX[raw[at + i]]
    return out


def _shared(keys: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Which rows have a key that rows of another document have too."""
    out = np.zeros(len(keys), bool)
    if len(keys):
        order = np.argsort(keys, kind="stable")
        first = np.flatnonzero(np.concatenate(([True], keys[order][1:] != keys[order][:-1])))
        low, high = np.minimum.reduceat(docs[order], first), np.maximum.reduceat(docs[order], first)
        out[order] = np.repeat(low != high, np.diff(np.append(first, len(keys))))
    return out


class _RangeMinimum:
    """Minimum over ranges of small numbers, from tables of doubling width."""

    def __init__(self, values: np.ndarray):
        self.size = len(values)
        self.tables = np.empty((max(1, self.size.bit_length()), self.size), np.uint8)
        self.tables[0] = values
        for level in range(1, len(self.tables)):
            half = 1 << (level - 1)
            np.minimum(self.tables[level - 1, :-half], self.tables[level - 1, half:], out=self.tables[level, :-half])
        self.tables = self.tables.ravel()

    def __call__(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        level = np.frexp((last - first + 1).astype(np.float32))[1].astype(np.int64) - 1
        row = level * self.size
        return np.minimum(self.tables[row + first], self.tables[row + last + 1 - (1 << level)])


def suffix_order(strings: list[bytes], cap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, suffix length, common prefix with the suffix before, up to ``cap``) of all suffixes in order.

    One symbol of every string is inserted per round, the last first: round r holds the order of all suffixes of up
    to r symbols as the Burrows-Wheeler transform of the collection, the symbol before each suffix. The suffix that
    this symbol extends stands where the symbol's rank says; its common prefixes with its new neighbours are one more
    than the least between the places they extend.
    """
    count = len(strings)
    flat = np.frombuffer(b"".join(strings), np.uint8)
    sizes = np.fromiter(map(len, strings), np.int64, count)
    ends = np.cumsum(sizes)
    before = flat[ends - 1].copy()
    # String and suffix length in one number.
    which = np.arange(count, dtype=np.int32 if count < 1 << 22 else np.int64) << 8
    common = np.zeros(count, np.uint8)
    place, alive = np.arange(count), np.arange(count)
    for step in range(1, int(sizes.max(initial=0)) + 1):
        total = len(before)
        order = np.argsort(before, kind="stable")
        rank = np.empty(total, np.int32 if total < 1 << 31 else np.int64)
        rank[order] = np.arange(total, dtype=rank.dtype)
        here = place[alive]
        k = rank[here].astype(np.int64)
        symbol = before[here]
        least = _RangeMinimum(common)
        at = np.maximum(k - 1, 0)
        one, two = order[at], order[np.minimum(k + 1, total - 1)]
        joined_one = np.flatnonzero((k > 0) & (before[one] == symbol))
        joined_two = np.flatnonzero((k + 1 < total) & (before[two] == symbol))
        prefix, following = np.zeros(len(k), np.uint8), np.zeros(len(k), np.uint8)
        prefix[joined_one] = np.minimum(cap, 1 + least(one[joined_one] + 1, here[joined_one]).astype(np.int64))
        following[joined_two] = np.minimum(cap, 1 + least(here[joined_two] + 1, two[joined_two]).astype(np.int64))
        target = count + k
        old = np.ones(total + len(alive), bool)
        old[target] = False
        left = sizes[alive] - step
        symbols = np.where(left > 0, flat[np.maximum(ends[alive] - step - 1, 0)], END).astype(np.uint8)

        def grown(values: np.ndarray, new) -> np.ndarray:
            out = np.empty(len(old), values.dtype)
            out[old] = values
            out[target] = new
            return out

        before, which = grown(before, symbols), grown(which, alive << 8 | step)
        common = grown(common, prefix)
        common[target[joined_two] + 1] = following[joined_two]
        place[alive] = target
        # Places of finished strings move too, but nothing is inserted through them any more.
        alive = alive[left > 0]
    return which >> 8, which & 255, common


def least_documents(strings: list[bytes], least: np.ndarray, length: int) -> list[np.ndarray]:
    """For each string's places, the smallest document of any string that has the same ``length`` bytes there."""
    owner, depth, common = suffix_order(strings, length)
    group = np.cumsum(common < length) - 1
    documents = least[owner]
    smallest = np.minimum.reduceat(documents, np.flatnonzero(common < length))[group]
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    bounds = np.concatenate(([0], np.cumsum(sizes - length + 1)))
    out = np.empty(bounds[-1], np.int64)
    whole = depth >= length
    out[bounds[owner[whole]] + sizes[owner[whole]] - depth[whole]] = smallest[whole]
    return np.split(out, bounds[1:-1])


def _smallest(strings: list[bytes], tag: np.ndarray, least: np.ndarray, length: int) -> list[np.ndarray]:
    """``least_documents`` of all strings, which come in the order of their groups; a construction takes whole groups.

    A string that is the only one of its group shares nothing with another: what it holds starts in its own least
    document, so it needs no order.
    """
    if not strings:
        return []
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))
    edges = np.flatnonzero(np.concatenate((tag[1:] != tag[:-1], [True]))) + 1
    sizes = np.diff(edges, prepend=0)
    alone = np.repeat(sizes == 1, sizes)
    out = [np.full(n, d) if a else None for n, d, a in zip((lengths - length + 1).tolist(), least.tolist(), alone.tolist())]
    held: list[int] = []
    filled = 0
    for end, size in zip(edges.tolist(), sizes.tolist()):
        if size > 1:
            held += range(end - size, end)
            filled += int(lengths[end - size:end].sum())
        if held and (filled >= ORDER_BYTES or end == len(strings)):
            for i, found in zip(held, least_documents([strings[i] for i in held], least[held], length)):
                out[i] = found
            held, filled = [], 0
    return out


def repeats_in_bucket(packed: list[tuple[int, bytes]], length: int) -> tuple[np.ndarray, ...]:
    """(document, variant, start, end) of the bytes of this bucket's stretches that start in a smaller document too."""
    found = [unpack(n, raw) for n, raw in packed]
    docs, variants, starts, places, sizes = (np.concatenate([f[i] for f in found]) for i in range(5))
    body = b"".join([f[5] for f in found])
    del found
    raw = np.frombuffer(body, np.uint8)
    begins = np.cumsum(sizes) - sizes
    # Two documents that share a string share its least part, and half of what else is in the string on one side.
    side = (length - PART + 1) // 2
    tags = _hash_at(raw, begins + places, PART)
    at = np.flatnonzero(_shared(tags, docs))
    near = np.zeros(len(at), bool)
    for reach, inside in ((-side, places[at] >= side), (PART, places[at] + PART + side <= sizes[at])):
        some = at[inside]
        near[inside] |= _shared(tags[some] * np.uint64(_FACTOR) + _hash_at(raw, begins[some] + places[some] + reach, side),
                                docs[some])
    at = at[near]
    at = at[np.argsort(tags[at], kind="stable")]
    names: dict[bytes, int] = {}
    which = np.fromiter((names.setdefault(body[b:b + s], len(names)) for b, s in
                         zip(begins[at].tolist(), sizes[at].tolist())), np.int64, len(at))
    docs, variants, starts, sizes, tags = docs[at], variants[at], starts[at], sizes[at], tags[at]
    strings = list(names)
    least = np.full(len(strings), np.iinfo(np.int64).max)
    np.minimum.at(least, which, docs)
    tag = np.zeros(len(strings), np.uint64)
    tag[which] = tags
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))
    smallest = _smallest(strings, tag, least, length)
    if not len(which):
        none = np.zeros(0, np.int64)
        return none, none, none, none
    flat = np.concatenate(smallest)
    bounds = np.cumsum(lengths - length + 1) - (lengths - length + 1)
    places = sizes - length + 1
    piece = np.repeat(np.arange(len(which)), places)
    offset = np.arange(len(piece)) - np.repeat(np.cumsum(places) - places, places)
    covered = flat[bounds[which[piece]] + offset] < docs[piece]
    piece, offset = piece[covered], offset[covered]
    if not len(piece):
        none = np.zeros(0, np.int64)
        return none, none, none, none
    new = np.flatnonzero(np.concatenate(([True], (piece[1:] != piece[:-1]) | (offset[1:] != offset[:-1] + 1))))
    last = np.append(new[1:], len(piece)) - 1
    first = piece[new]
    return docs[first], variants[first], starts[first] + offset[new], starts[first] + offset[last] + length


def _runs(starts: np.ndarray, ends: np.ndarray) -> list[list[int]]:
    """Ranges as maximal runs [start, end], in order; ranges that touch are one."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    first = np.flatnonzero(np.concatenate(([True], starts[1:] > ends[:-1])))
    return np.stack([starts[first], ends[np.append(first[1:], len(ends)) - 1]], axis=1).tolist()


def _told_apart(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``docs`` with ``of_key`` (the key as a number) and ``variant``: 0 but for rows that repeat a key with another text.

    The texts of a repeated key are numbered by hash; equal rows are one document. Only keys and hashes are shuffled,
    and the texts of none but a table with very many repeated keys.
    """
    body = F.xxhash64(F.col(text), F.lit(1))
    pairs = docs.filter(F.col(key).isNotNull()).select(F.col(key).alias("twin"), body.alias("twin_body"))
    several = pairs.groupBy("twin").agg(F.min("twin_body").alias("low"), F.max("twin_body").alias("high"))
    twins = pairs.join(several.filter("low <> high").select("twin"), "twin", "left_semi").distinct()
    twins = materialize(row_number_by(materialize(twins), ["twin"], [F.col("twin_body")], "variant"))
    return docs.join(twins, (F.col(key) == F.col("twin")) & (body == F.col("twin_body")), "left").select(
        *docs.columns, F.coalesce("variant", F.lit(0)).cast("long").alias("variant"))


def repeated_spans(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """(of, of_variant, spans): per document with any, the maximal byte ranges [start, end] covered by strings of
    ``length`` bytes that also start in a document with a smaller key. ``rows`` come from ``_told_apart`` with the
    columns key (long), variant and text.

    Texts are cut into stretches of neighbouring strings that share a least part (by hash), so
    equal strings meet in one bucket whatever stands around them. A bucket's distinct stretches are the collection
    whose suffix order is built column by column; buckets follow the table's size. Ties: an equal key is not smaller.
    """
    if not PART < length <= 128:
        raise ValueError(f"the length is more than {PART} and at most 128 bytes")
    rows = rows.filter("key IS NOT NULL").select("key", "variant", "text")
    total = rows.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("rows")).first()
    buckets = max(1, math.ceil((total.bytes or 0) / BUCKET_BYTES))
    shares = max(1, math.ceil(total.rows / SHARE_ROWS))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[int, int, int, bytes]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            *numbers, parts = zip(*waiting)
            packed = pack_chunk(*(np.array(x, np.int64) for x in numbers), list(parts), buckets, length)
            waiting.clear()
            columns = list(zip(*packed)) or [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                                               pa.array(columns[2], pa.binary())], ["bucket", "n", "packed"])

        for batch in batches:
            for i in range(batch.num_rows):
                raw = batch.column(2)[i].as_py().encode()
                if len(raw) < length:
                    continue
                number, variant = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                for base in range(0, len(raw) - length + 1, HASHED_BYTES):
                    part = raw[base:base + HASHED_BYTES + length - 1]
                    waiting.append((number, variant, base, part))
                    size += len(part)
                    if size >= CHUNK_BYTES:
                        yield flush()
                        size = 0
        if waiting:
            yield flush()

    def find(table: pa.Table) -> pa.Table:
        keys, variants, starts, ends = repeats_in_bucket(
            list(zip(table.column("n").to_pylist(), table.column("packed").to_pylist())), length)
        share = ((keys.view(np.uint64) * np.uint64(_FACTOR)) >> np.uint64(20)) % np.uint64(shares)
        order = np.argsort(share, kind="stable")
        share, ranges = share[order], np.stack([x[order] for x in (keys, variants, starts, ends)], axis=1)
        first = np.flatnonzero(np.concatenate(([True], share[1:] != share[:-1]))) if len(keys) else np.zeros(0, np.int64)
        return pa.table({"share": pa.array(share[first].astype(np.int64), pa.int64()), "ranges": pa.array(
            [r.tobytes() for r in np.split(ranges, first[1:])] if len(keys) else [], pa.binary())})

    def join(batch: pa.RecordBatch) -> pa.RecordBatch:
        owners, spans = [], []
        for lists in batch.column(1).to_pylist():
            ranges = np.frombuffer(b"".join(lists), np.int64).reshape(-1, 4)
            ranges = ranges[np.lexsort((ranges[:, 1], ranges[:, 0]))]
            first = np.flatnonzero(np.concatenate(([True], (ranges[1:, :2] != ranges[:-1, :2]).any(axis=1))))
            for part in np.split(ranges, first[1:]):
                owners.append(part[0, :2].tolist())
                spans.append(_runs(part[:, 2], part[:, 3]))
        return pa.RecordBatch.from_arrays(
            [*[pa.array([o[i] for o in owners], pa.int64()) for i in (0, 1)],
             pa.array(spans, pa.list_(pa.list_(pa.int64())))], ["of", "of_variant", "spans"])

    # A bucket's ranges travel packed, some documents' together; a document's runs are few.
    # About one bucket per task, however many the session's number of shuffle partitions is.
    ranges = (rows.mapInArrow(cut, "bucket long, n long, packed binary").repartition(buckets, "bucket").groupBy("bucket")
              .applyInArrow(lambda table: find(table), "share long, ranges binary"))
    return map_batches(ranges.groupBy("share").agg(F.collect_list("ranges").alias("ranges")), join,
                       "of long, of_variant long, spans array<array<bigint>>", rows=16)


def _marked(docs: DataFrame, key: str, text: str, length: int) -> tuple[DataFrame, str]:
    """``docs`` with one more column, whose name is returned: the removed byte ranges of each row, or NULL."""
    every = [f"c{i}" for i in range(len(docs.columns))]
    rows = _told_apart(docs.select(*[F.col(column(c)).alias(n) for c, n in zip(docs.columns, every)],
                                   _number(docs, key).alias("key"), text_of(text).alias("text")), "key", "text")
    spans = materialize(repeated_spans(rows, length))
    joined = rows.join(spans.hint("merge"), (rows["key"] == spans["of"]) & (rows["variant"] == spans["of_variant"]), "left")
    name = fresh_name(docs, "spans")
    return joined.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, every)], spans["spans"].alias(name)), name


def _number(docs: DataFrame, key: str) -> Column:
    kind = docs.schema[key].dataType
    if not isinstance(kind, IntegralType):
        raise ValueError(f"keys must be whole numbers, as documents are compared by them; {key} is {kind.simpleString()}")
    return F.col(column(key)).cast("long")


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """Per row: key, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 (of the bytes left).

    NULL texts are empty. Rows without a key neither remove nor lose anything. Rows that repeat a key are compared
    with smaller keys only, each text for itself; repeats within a document stay. Keys are whole numbers, others raise
    an error.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = _told_apart(docs.select(_number(docs, key).alias("key"), text_of(text).alias("text")), "key", "text")
    spans = materialize(repeated_spans(rows, length))

    def shrink(batch: pa.RecordBatch, packer: zstandard.ZstdCompressor) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(
            [packer.compress(t.encode()) for t in batch.column(2).to_pylist()], pa.binary())], ["key", "variant", "packed"])

    def digest(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, unpacker = [], zstandard.ZstdDecompressor()
        for packed, merged in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            raw, merged = unpacker.decompress(packed), merged or []
            kept, last = hashlib.sha256(), 0
            for start, end in merged:
                kept.update(raw[last:start])
                last = end
            kept.update(raw[last:])
            rows.append((len(raw), sum(b - a for a, b in merged), len(merged), kept.hexdigest()))
        columns = list(zip(*rows)) or [(), (), (), ()]
        return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]),
                                           pa.array(columns[3], pa.string())],
                                          ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    # Texts are shuffled once to meet their runs, compressed better than a shuffle would.
    small = map_batches(rows.select("key", "variant", "text"), shrink, "key long, variant long, packed binary",
                        lambda: zstandard.ZstdCompressor(level=6))
    marked = (small.join(spans.hint("merge"), (small["key"] == spans["of"]) & (small["variant"] == spans["of_variant"]), "left")
              .select("key", "packed", "spans"))
    return map_batches(marked, digest, "key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
                       ).withColumn("key", F.col("key").cast(kind)).withColumnRenamed("key", key)


REPORT_SQL = f"""
    WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS raw FROM documents),
    places AS (
        SELECT doc_id, place, substr(raw, 2 * place + 1, {2 * LENGTH}) AS body
        FROM (SELECT doc_id, raw, unnest(range(len(raw) // 2 - {LENGTH - 1})) AS place FROM docs)),
    removed AS (
        SELECT doc_id, place FROM places JOIN (SELECT body, min(doc_id) AS first FROM places GROUP BY body) USING (body)
        WHERE doc_id > first),
    marked AS (
        SELECT doc_id, place, place > coalesce(lag(place) OVER w + {LENGTH}, -1) AS opens
        FROM removed WINDOW w AS (PARTITION BY doc_id ORDER BY place)),
    runs AS (
        SELECT doc_id, min(place) AS start, max(place) + {LENGTH} AS stop
        FROM (SELECT *, sum(opens::INTEGER) OVER (PARTITION BY doc_id ORDER BY place) AS run FROM marked)
        GROUP BY doc_id, run),
    pieces AS (
        SELECT doc_id, coalesce(lag(stop) OVER (PARTITION BY doc_id ORDER BY start), 0) AS start, start AS stop FROM runs
        UNION ALL
        SELECT d.doc_id, coalesce(max(r.stop), 0), any_value(len(d.raw)) // 2
        FROM docs d LEFT JOIN runs r ON r.doc_id = d.doc_id GROUP BY d.doc_id),
    kept AS (
        SELECT p.doc_id, string_agg(substr(raw, 2 * start + 1, 2 * (stop - start)), '' ORDER BY start, stop) AS raw
        FROM pieces p JOIN docs d ON d.doc_id = p.doc_id GROUP BY p.doc_id),
    counts AS (SELECT doc_id, sum(stop - start) AS removed, count(*) AS spans FROM runs GROUP BY doc_id)
    SELECT d.doc_id, CAST(len(d.raw) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(c.removed, 0) AS BIGINT) AS n_removed,
           coalesce(c.spans, 0) AS n_spans, sha256(unhex(k.raw)) AS kept_sha256
    FROM docs d JOIN kept k ON k.doc_id = d.doc_id LEFT JOIN counts c ON c.doc_id = d.doc_id"""


def drop_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with the repeated bytes taken out of the text; a character that is cut in two goes as a whole."""
    marked, name = _marked(docs, key, text, length)
    at = docs.columns.index(text)
    width = len(docs.columns)

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = []
        for body, spans in zip(batch.column(at).cast(pa.string()).to_pylist(), batch.column(width).to_pylist()):
            if body and spans:
                raw, pieces, last = body.encode(), [], 0
                for start, end in [*spans, (len(raw), 0)]:
                    pieces.append(raw[last:start].decode(errors="ignore"))
                    last = end
                body = "".join(pieces)
            texts.append(body)
        columns = [*batch.columns[:width]]
        columns[at] = pa.array(texts, pa.string())
        return pa.RecordBatch.from_arrays(columns, batch.schema.names[:width])

    schema = docs.withColumn(text, docs[text].cast("string")).schema
    return map_batches(marked, cut, schema)
