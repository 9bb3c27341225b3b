"""Reproducible shuffling into shards: a Feistel permutation of global row numbers with cycle walking.

A row's number is its place in an order of the rows' own values. The permutation is keyed and needs no table: the
place of any row number, and the row number at any place, are computed from the number of rows and the seed alone.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from lakeops.llm.common import fresh_name, text_of
from lakeops.operators.names import column
from lakeops.operators.ordering import row_number_by
from lakeops.session import discard, materialize

SHARDS = 40
ROUNDS = 6
#: Bytes that every document takes beside its text.
OVERHEAD = 16
# Multipliers of the published splitmix64 finaliser.
MULTIPLIERS = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


class Permutation:
    """A keyed permutation of 0 .. ``rows`` - 1, computable for any single number in both directions.

    A number is cut into two halves of ``half`` bits; each round adds (exclusive or) a keyed hash of one half to the
    other. The network permutes the 4 ** half numbers, fewer than 4 * rows (4 at least), so a number that lands
    outside the rows is sent through again until it lands inside, which keeps it a permutation of the rows.
    """

    def __init__(self, rows: int, seed: int = 0, rounds: int = ROUNDS):
        if rows < 0:
            raise ValueError("the number of rows is negative")
        self.rows = rows
        self.half = max(1, ((rows - 1).bit_length() + 1) // 2) if rows else 1
        self.keys = [int.from_bytes(hashlib.sha256(f"{seed}|{i}".encode()).digest()[:8], "little")
                     for i in range(rounds)]

    def _hash(self, half: np.ndarray, key: int) -> np.ndarray:
        x = half + np.uint64(key)
        for shift, factor in zip((30, 27), MULTIPLIERS):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return (x ^ (x >> np.uint64(31))) & np.uint64((1 << self.half) - 1)

    def _network(self, numbers: np.ndarray, inverse: bool) -> np.ndarray:
        bits = np.uint64(self.half)
        left, right = numbers >> bits, numbers & np.uint64((1 << self.half) - 1)
        for key in reversed(self.keys) if inverse else self.keys:
            if inverse:
                left, right = right ^ self._hash(left, key), left
            else:
                left, right = right, left ^ self._hash(right, key)
        return (left << bits) | right

    def _walk(self, numbers, inverse: bool) -> np.ndarray:
        out = np.atleast_1d(np.asarray(numbers)).astype(np.uint64)
        if len(out) and int(out.max()) >= self.rows:
            raise ValueError(f"a number is not below {self.rows}")
        todo = np.arange(len(out))
        while len(todo):
            out[todo] = self._network(out[todo], inverse)
            todo = todo[out[todo] >= np.uint64(self.rows)]
        return out.astype(np.int64)

    def forward(self, numbers) -> np.ndarray:
        """The place of each row number."""
        return self._walk(numbers, False)

    def backward(self, places) -> np.ndarray:
        """The row number at each place."""
        return self._walk(places, True)

    def place(self, number: int, shards: int) -> tuple[int, int]:
        """(shard, slot) of one row number."""
        place = int(self.forward(number)[0])
        return place % shards, place // shards

    def row_at(self, shard: int, slot: int, shards: int) -> int:
        """The row number in a slot of a shard."""
        return int(self.backward(slot * shards + shard)[0])

    def column(self, number: Column) -> Column:
        """``forward`` of a column of numbers, in Arrow batches."""
        permutation = self

        @F.pandas_udf("long")
        def forward(numbers: pd.Series) -> pd.Series:
            return pd.Series(permutation.forward(numbers.to_numpy()))

        return forward(number)


def place_rows(docs: DataFrame, order_by: list[str], shards: int = SHARDS, seed: int = 0) -> DataFrame:
    """``docs`` with the columns ``shard`` (0 to shards - 1) and ``slot`` (from 0, gapless in each shard).

    Rows are numbered in the order of ``order_by`` (NULL first), spread over many tasks, and the permutation puts
    number i to place p: shard p % shards, slot p // shards. So shards differ by one row at most, and the result
    depends on the rows' values, the number of shards and the seed, not on partitions. Rows that are equal in
    ``order_by`` are numbered in the order in which they were stored for this, so a third of all rows may be equal;
    name all columns for a result that never changes. Columns already called shard or slot raise an error. An empty
    table gives no rows. ``docs`` is read once and written twice on the way; pass only the columns to be placed.
    """
    clash = {"shard", "slot"} & {c.lower() for c in docs.columns}
    if clash:
        raise ValueError(f"columns named {sorted(clash)} are in the way")
    tie, number, place = (fresh_name(docs, name) for name in ("_tie", "_number", "_place_of"))
    stored = materialize(docs.withColumn(tie, F.monotonically_increasing_id()))
    rows = stored.count()
    order = [F.col(column(c)).asc_nulls_first() for c in order_by]
    numbered = row_number_by(stored, [], [*order, F.col(tie)], number)
    discard(stored)
    permuted = numbered.withColumn(place, Permutation(rows, seed).column(F.col(number) - 1))
    return permuted.select(*[F.col(column(c)) for c in docs.columns],
                           (F.col(place) % shards).cast("int").alias("shard"),
                           F.expr(f"{column(place)} div {shards}").alias("slot"))


def write_shards(placed: DataFrame, path: str, shards: int = SHARDS, files_per_shard: int = 1) -> None:
    """Write the result of ``place_rows`` to ``path/shard=k``; names of a shard's files follow their slots.

    Rows are dealt to tasks by ranges of (shard, slot), so a shard of any size may span many files.
    """
    (placed.repartitionByRange(shards * files_per_shard, "shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS,
           seed: int = 0) -> DataFrame:
    """Per row: key, size (UTF-8 bytes of the text plus 16), text_crc32, law, shard, slot, grown_shard (NULL).

    The law is ``rows``: counts of shards are at most one apart. NULL texts have no bytes and the checksum 0. Texts
    are read once and not shuffled: rows are numbered by (key, size, checksum), NULL keys first. Repeated rows and
    equal texts are placed each for itself. Other columns are not read.
    """
    whole = text_of(text)
    digest = docs.select(
        docs[key].alias(key), (F.octet_length(whole) + F.lit(OVERHEAD)).cast("long").alias("size"),
        F.crc32(whole.cast("binary")).alias("text_crc32"))
    placed = place_rows(digest, digest.columns, shards, seed)
    return placed.select(key, "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))
