"""Packing token sequences into windows by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import heapq
import math
import zlib
from array import array

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F

from lakeops.llm.bpe import WORDS, PairMerger, TextEncoder
from lakeops.llm.common import map_batches, text_of
from lakeops.session import materialize

CAPACITY = 2048
END_ID = 1
#: Rests of documents are cut to at most this many tokens, so that windows hold enough pieces to be near-equal.
REST = 512
#: Pieces balanced together; the number of such groups grows with the table.
GROUP_PIECES = 2048


def differencing(sizes: np.ndarray, windows: int) -> np.ndarray:
    """The window of each piece: partial partitions with the largest spread are merged, opposite imbalances facing.

    Each partial partition is its window sums in falling order. Merging adds one's largest sums to the other's
    smallest ones. The tree of merges is then walked down to name each piece's window.
    """
    n = len(sizes)
    sums: dict[int, np.ndarray] = {}
    for i, size in enumerate(sizes.tolist()):
        sums[i] = np.zeros(windows, np.int64)
        sums[i][0] = size
    heap = [(-size if windows > 1 else 0, i) for i, size in enumerate(sizes.tolist())]
    heapq.heapify(heap)
    merges: list[tuple[int, int, np.ndarray]] = []
    while len(heap) > 1:
        (_, one), (_, two) = heapq.heappop(heap), heapq.heappop(heap)
        total = sums.pop(one) + sums.pop(two)[::-1]
        order = np.argsort(-total, kind="stable")
        total = total[order]
        node = n + len(merges)
        merges.append((one, two, order))
        sums[node] = total
        heapq.heappush(heap, (int(total[-1] - total[0]), node))
    out = np.zeros(n, np.int64)
    places = {n + len(merges) - 1: np.arange(windows)}
    for node in range(n + len(merges) - 1, n - 1, -1):
        one, two, order = merges[node - n]
        mine = places.pop(node)
        for child, slots in ((one, order), (two, windows - 1 - order)):
            if child < n:
                out[child] = mine[np.flatnonzero(slots == 0)[0]]
            else:
                places[child] = np.empty(windows, np.int64)
                places[child][slots] = mine
    return out


def balance(sizes: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """The window of each piece, in as few near-equal windows as differencing can fill within the capacity."""
    windows = max(1, math.ceil(sizes.sum() / capacity))
    while True:
        chosen = differencing(sizes, windows)
        if np.bincount(chosen, weights=sizes, minlength=windows).max(initial=0) <= capacity:
            return chosen
        windows += 1


class FastWords:
    """New text parts encoded by a compiled encoder over the same vocabulary file."""

    def __init__(self, path: str):
        merger = PairMerger(path)
        self.added = merger.added
        self._encoding = tiktoken.Encoding("packing", pat_str=WORDS, mergeable_ranks=merger.ranked_bytes(),
                                           special_tokens={})

    def encode(self, parts: list[str]) -> list[bytes]:
        encode = self._encoding.encode_ordinary
        return [array("I", encode(p)).tobytes() for p in parts]

    def whole(self, text: str) -> bytes:
        return array("I", self._encoding.encode_ordinary(text)).tobytes()


def pieces(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
           rest: int = REST) -> DataFrame:
    """Each document's ids and the end id, cut into whole windows and small rests: key, start, length, ids_crc32,
    doc_tokens. NULL texts are the end id alone."""
    end = END_ID.to_bytes(4, "little")

    def cut(batch: pa.RecordBatch, encoder: TextEncoder) -> pa.RecordBatch:
        at, starts, lengths, sums, totals = [], [], [], [], []
        for i, ids in enumerate(encoder.encode(batch.column(1).to_pylist())):
            ids += end
            total, start = len(ids) // 4, 0
            while start < total:
                length = capacity if total - start >= capacity else min(rest, total - start)
                at.append(i)
                starts.append(start)
                lengths.append(length)
                sums.append(zlib.crc32(ids[4 * start:4 * (start + length)]))
                totals.append(total)
                start += length
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(at, pa.int64()))] + [pa.array(x, pa.int64()) for x in
                                                               (starts, lengths, sums, totals)],
            ["key", "start", "length", "ids_crc32", "doc_tokens"])

    rows = docs.select(docs[key].alias("key"), text_of(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return map_batches(rows, cut, f"key {kind}, start long, length long, ids_crc32 long, doc_tokens long",
                       lambda: TextEncoder(FastWords(vocabulary)))


def pack(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
         rest: int = REST, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset; each id lies in one piece.

    A document's ids fill whole windows first. What is left over is cut small, dealt at random to groups of about
    ``group_pieces`` (their number follows the table), and each group is packed on its own by differencing, so no
    task sees more than a group. Pieces, not texts, are shuffled. Repeated rows and NULL keys are packed like any
    others; an empty table gives no piece. Sequence ids are unique, not gapless.
    """
    cut = materialize(pieces(docs, vocabulary, key, text, capacity, rest))
    groups = max(1, math.ceil(cut.count() / group_pieces))
    dealt = cut.withColumn("group", F.floor(F.rand(17) * groups))
    kind = cut.schema["key"].dataType.simpleString()

    def place(group: tuple, rows: pa.Table) -> pa.Table:
        start, length, crc = (rows.column(c).to_numpy() for c in ("start", "length", "ids_crc32"))
        rows = rows.take(pa.array(np.lexsort((start, crc, length))))
        length = rows.column("length").to_numpy()
        small = length < capacity
        window = np.empty(len(length), np.int64)
        window[small] = balance(length[small], capacity)
        window[~small] = np.arange((~small).sum()) + (window[small].max() + 1 if small.any() else 0)
        order = np.argsort(window, kind="stable")
        before = np.concatenate(([0], np.cumsum(length[order])[:-1]))
        first = np.concatenate(([True], window[order][1:] != window[order][:-1]))
        offset = np.empty(len(length), np.int64)
        offset[order] = before - before[first][np.cumsum(first) - 1]
        number = (int(group[0].as_py()) << 24) + window
        return (rows.select(["key", "start", "length", "ids_crc32", "doc_tokens"])
                .append_column("sequence_id", pa.array(number)).append_column("offset", pa.array(offset)))

    packed = dealt.groupBy("group").applyInArrow(
        lambda group, rows: place(group, rows),
        f"key {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return packed.withColumnRenamed("key", key)
