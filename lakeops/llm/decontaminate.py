"""Benchmark decontamination: a broadcast set of word windows, scanned over all texts and verified."""

from __future__ import annotations

import math
import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from lakeops.llm.common import fresh_name, map_batches, text_of
from lakeops.session import materialize

WINDOW = 13
#: Broadcast windows have at most about so many bytes of text; beyond it the windows go out in several passes.
BROADCAST_BYTES = 32 << 20
#: Documents with at least one hit word in so many are contaminated.
SHARE = 20
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
#: Lower-cases A-Z; what is neither digit, letter nor part of a longer character becomes a space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
              for c in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


def benchmark_windows(benchmark: DataFrame, key: str, text: str, window: int = WINDOW) -> DataFrame:
    """One row per distinct (window, item): the words joined by spaces, their number, and the item's id as text."""

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: dict[tuple, None] = {}
        for item, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = words_of(body)
            size = min(window, len(words))
            for i in range(len(words) - size + 1 if size else 0):
                out[b" ".join(words[i:i + size]), size, item] = None
        columns = list(zip(*out)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.int32()),
                                           pa.array(columns[2], pa.string())], ["window", "size", "item"])

    rows = benchmark.select(benchmark[key].cast("string").alias("item"), text_of(text).alias("text"))
    return map_batches(rows, cut, "window binary, size int, item string").distinct()


class WindowSet:
    """Hashes of the windows by length, with the windows themselves to verify hits."""

    def __init__(self, windows: dict[bytes, list[str | None]]):
        self.windows = windows
        self.ids: dict[bytes, int] = {}
        by_size: dict[int, list[list[int]]] = {}
        for window in windows:
            row = [self.ids.setdefault(w, len(self.ids) + 1) for w in window.split()]
            by_size.setdefault(len(row), []).append(row)
        self.hashes = {n: np.unique(self._hash(np.array(rows, np.uint64).ravel(), n)[::n])
                       for n, rows in by_size.items()}

    @staticmethod
    def _hash(ids: np.ndarray, size: int) -> np.ndarray:
        """A polynomial of each ``size`` neighbours, modulo 2 to the 64."""
        total = np.zeros(len(ids) - size + 1, np.uint64)
        for i in range(size):
            total = total * _FACTOR + ids[i:len(ids) - size + 1 + i]
        return total

    def scan(self, texts: list[str]) -> list[tuple[int, list[tuple[int, int]], set]]:
        """Per text: its number of words, the merged word ranges inside windows, the items of those windows."""
        lists = [words_of(t) for t in texts]
        found: list[tuple[int, list, set]] = [(len(words), [], set()) for words in lists]
        sizes = np.array([len(words) + 1 for words in lists], np.int64)
        starts = np.concatenate(([0], np.cumsum(sizes)))
        ids = np.zeros(starts[-1], np.uint64)
        for start, words in zip(starts.tolist(), lists):
            ids[start:start + len(words)] = np.fromiter(map(self.ids.get, words, repeat(0)), np.uint64, len(words))
        unknown = np.concatenate(([0], np.cumsum(ids == 0)))  # a separating zero ends every text
        for size, hashes in self.hashes.items():
            if len(ids) < size:
                continue
            at = np.flatnonzero(unknown[size:] == unknown[:-size])
            if not len(at):
                continue
            hashed = np.zeros(len(at), np.uint64)
            for i in range(size):
                hashed = hashed * _FACTOR + ids[at + i]
            near = np.minimum(np.searchsorted(hashes, hashed), len(hashes) - 1)
            at = at[hashes[near] == hashed]
            for place, owner in zip(at.tolist(), (np.searchsorted(starts, at, side="right") - 1).tolist()):
                first = place - int(starts[owner])
                items = self.windows.get(b" ".join(lists[owner][first:first + size]))
                if items is not None:
                    found[owner][1].append((first, first + size))
                    found[owner][2].update(i for i in items if i is not None)
        return [(n, merged(ranges), items) for n, ranges, items in found]


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges as disjoint ranges that do not touch, in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def scan(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item: str = "item_id",
         item_text: str = "text", window: int = WINDOW,
         broadcast_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with four added columns, whose names are returned by role: ``words``, ``hits`` (words inside any
    benchmark window), ``items`` (ids, as text, of the items those windows belong to), ``ranges`` (merged word
    ranges).

    The windows are cut and made distinct by Spark; their total size is measured, and they are broadcast in as many
    disjoint blocks of bounded size as that takes (one for any usual benchmark). Each block is one scan without a
    shuffle that adds its hits to those of the blocks before. NULL texts have no words. NULL item ids still hit but
    are not listed; repeated items and repeated documents change nothing. Empty tables give no hits.
    """
    windows = benchmark_windows(benchmark, item, item_text, window)
    size = F.length("window") + F.coalesce(F.length("item"), F.lit(0)) + 64
    total = windows.select(F.sum(size).alias("bytes")).first().bytes or 0
    blocks = max(1, math.ceil(total / broadcast_bytes))
    names = {role: fresh_name(docs, role) for role in ("words", "hits", "items", "ranges")}
    pair = T.ArrayType(T.LongType())
    plain = docs.schema.names
    at = len(plain)
    frame = docs.select(*[docs[f"`{c}`"] for c in plain], F.lit(0).cast("long").alias(names["words"]),
                        F.lit(0).cast("long").alias(names["hits"]),
                        F.array().cast("array<string>").alias(names["items"]),
                        F.array().cast("array<array<bigint>>").alias(names["ranges"]))
    schema = T.StructType([*docs.schema.fields, T.StructField(names["words"], T.LongType()),
                           T.StructField(names["hits"], T.LongType()),
                           T.StructField(names["items"], T.ArrayType(T.StringType())),
                           T.StructField(names["ranges"], T.ArrayType(pair))])
    text_at = plain.index(text)
    spark = docs.sparkSession
    for block in range(blocks):
        mine = windows if blocks == 1 else windows.filter(F.pmod(F.xxhash64("window", "item"), blocks) == block)
        grouped: dict[bytes, list] = {}
        for row in mine.select("window", "item").collect():
            grouped.setdefault(bytes(row.window), []).append(row.item)
        sent = spark.sparkContext.broadcast(grouped)

        def pass_over(batch: pa.RecordBatch, known: WindowSet) -> pa.RecordBatch:
            texts = [t or "" for t in batch.column(text_at).cast(pa.string()).to_pylist()]
            counts, hits, items, ranges = [], [], [], []
            for (n, new, found), old, named in zip(known.scan(texts), batch.column(at + 3).to_pylist(),
                                                   batch.column(at + 2).to_pylist()):
                both = merged([*map(tuple, old), *new])
                counts.append(n)
                hits.append(sum(b - a for a, b in both))
                items.append(sorted(found | set(named)))
                ranges.append([list(r) for r in both])
            return pa.RecordBatch.from_arrays(
                [*batch.columns[:at], pa.array(counts, pa.int64()), pa.array(hits, pa.int64()),
                 pa.array(items, pa.list_(pa.string())), pa.array(ranges, pa.list_(pa.list_(pa.int64())))],
                [*batch.schema.names])

        frame = map_batches(frame, pass_over, schema, lambda sent=sent: WindowSet(sent.value))
        if block < blocks - 1:
            frame = materialize(frame)
    return frame, names


def contaminated(names: dict[str, str]):
    """At least one word in twenty lies inside a benchmark window."""
    return (F.col(names["hits"]) > 0) & (F.col(names["hits"]) * SHARE >= F.col(names["words"]))


def report(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """Per document: key, n_words, n_hit, n_items, items_sha256 (ids sorted as text, joined by commas), contaminated."""
    frame, names = scan(docs, benchmark, **options)
    items = F.array_sort(F.col(names["items"]))
    return frame.select(key, F.col(names["words"]).alias("n_words"), F.col(names["hits"]).alias("n_hit"),
                        F.size(items).cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"),
                        contaminated(names).alias("contaminated"))


_WORDS_SQL = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                          'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
REPORT_SQL = f"""
    WITH docs AS (SELECT doc_id, {_WORDS_SQL} AS words FROM documents),
    items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS_SQL} AS words FROM benchmark),
    cut AS (SELECT item, least(13, len(words)) AS size, words, unnest(range(len(words) - least(13, len(words)) + 1)) AS place
            FROM items WHERE len(words) > 0),
    windows AS (SELECT DISTINCT item, size, array_to_string(words[place + 1:place + size], ' ') AS body FROM cut),
    scanned AS (
        SELECT doc_id, size, place, array_to_string(words[place + 1:place + size], ' ') AS body
        FROM (SELECT doc_id, words, size, unnest(range(len(words) - size + 1)) AS place
              FROM docs CROSS JOIN (SELECT DISTINCT size FROM windows) WHERE len(words) >= size)),
    hits AS (SELECT doc_id, place, size, item FROM scanned JOIN windows USING (size, body)),
    covered AS (SELECT doc_id, count(DISTINCT word) AS n FROM (
        SELECT doc_id, unnest(range(place, place + size)) AS word FROM hits) GROUP BY doc_id),
    named AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names
              FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
    SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(c.n, 0) AS n_hit, coalesce(i.n, 0) AS n_items,
           sha256(coalesce(i.names, '')) AS items_sha256,
           coalesce(c.n, 0) > 0 AND 20 * coalesce(c.n, 0) >= len(words) AS contaminated
    FROM docs d LEFT JOIN covered c ON c.doc_id = d.doc_id LEFT JOIN named i ON i.doc_id = d.doc_id"""


def _cut_words(text: str, ranges: list[list[int]]) -> str:
    raw = text.encode()
    spans = [m.span() for m in _WORD.finditer(raw)]
    out, last = [], 0
    for start, end in ranges:
        out.append(raw[last:spans[start][0]])
        last = spans[end - 1][1]
    return b"".join([*out, raw[last:]]).decode()


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", text: str = "text",
                  **options) -> DataFrame:
    """``docs`` without its contaminated rows (``documents``), or with every word range inside a benchmark window
    cut out of the text (``spans``; what stands between two words of a range goes with it). Same columns."""
    if remove not in ("documents", "spans"):
        raise ValueError("remove is documents or spans")
    frame, names = scan(docs, benchmark, text=text, **options)
    if remove == "documents":
        return frame.filter(~contaminated(names)).select(*[frame[f"`{c}`"] for c in docs.columns])
    width, at, ranges_at = len(docs.columns), docs.columns.index(text), frame.columns.index(names["ranges"])

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(at).cast(pa.string()).to_pylist()
        kept = [_cut_words(t, r) if r else t for t, r in zip(texts, batch.column(ranges_at).to_pylist())]
        columns = [*batch.columns[:width]]
        columns[at] = pa.array(kept, pa.string())
        return pa.RecordBatch.from_arrays(columns, batch.schema.names[:width])

    schema = T.StructType([T.StructField(f.name, T.StringType()) if f.name == text else f for f in docs.schema.fields])
    return map_batches(frame, cut, schema)
