"""How the sources of a language differ in their words, from an index that is built in one pass.

Each task indexes its documents in memory: per language and source, how often a term occurs and in how many documents.
When the block is full it is written as a run, sorted by term and cut into shards of terms by hash. The runs of a shard
are then merged through a heap; a merge sees a bounded number of runs, so beyond it there are several levels. What comes
out is one posting list per term that enough documents of its language hold. Differences between two sources are summed
from a common base, the chance of a term that neither has, plus corrections streamed from the posting lists.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeops.llm.common import text_of
from lakeops.operators.ordering import join_measured
from lakeops.session import discard, materialize

MIN_DOCUMENTS = 30
TOP_TERMS = 50
#: A chance of 1 as a whole number, and what is added to every count.
UNIT = 1_000_000_000
SMOOTHING = 5
#: (document, term) postings that an index block holds before it is written.
BLOCK_POSTINGS = 3_000_000
#: Runs merged at once, and the shards of terms that a run is cut into; each further level of merging cuts finer.
FAN_IN = 256
SHARDS = 256
FINER = 16
#: Texts are cut into terms so many bytes at a time; longer ones between terms.
PIECE_BYTES = 4 << 20
#: Sources whose differences a task sums in one table.
TABLE_SOURCES = 1024
#: Estimated bytes of one broadcast row of group totals.
GROUP_BYTES = 128

_CODES = np.arange(256)
_UPPER = (_CODES >= ord("A")) & (_CODES <= ord("Z"))
_LOWERED = np.where(_UPPER, _CODES + 32, _CODES).astype(np.uint8)
#: Bytes of terms: ASCII letters and everything outside ASCII.
_IN_TERM = _UPPER | ((_CODES >= ord("a")) & (_CODES <= ord("z"))) | (_CODES >= 0x80)

_RUNS = "run long, shard int, langs array<string>, sources array<string>, postings binary"
_RUN_NAMES = ["run", "shard", "langs", "sources", "postings"]
#: A shard of a run: by term, then by group, which counts up the languages and sources named beside it.
_POSTINGS = pa.schema([("term", pa.binary()), ("group", pa.int32()), ("n", pa.int64()), ("docs", pa.int64())])
_LISTS = "lang string, term binary, sources array<string>, counts array<long>, docs long"


# -- blocks in memory, written as sorted runs ------------------------------------------------------------------------

class Counts(NamedTuple):
    """Entries in the order of (term, group); ``terms`` and ``groups`` are sorted and distinct."""
    terms: pa.BinaryArray
    groups: list[tuple[str, str]]
    term: np.ndarray
    group: np.ndarray
    n: np.ndarray
    docs: np.ndarray


def _distinct(arrays: list[pa.Array]) -> tuple[pa.Array, np.ndarray]:
    """The sorted distinct values of some arrays, and the place of each given value among them."""
    coded = pa.concat_arrays(arrays).dictionary_encode()
    order = pc.sort_indices(coded.dictionary)
    place = np.empty(len(order), np.int64)
    place[order.to_numpy()] = np.arange(len(order))
    return coded.dictionary.take(order), place[coded.indices.to_numpy()]


def _starts(key: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin in a sorted array."""
    return np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)


def cut_terms(data: np.ndarray, starts: np.ndarray) -> tuple[pa.BinaryArray, np.ndarray]:
    """The lower-cased terms of texts that lie one after another in ``data``, and the text that each is from."""
    inside = _IN_TERM[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    within = starts[starts < len(data)]
    first[within] = inside[within]
    begin = np.flatnonzero(first)
    kept = _LOWERED[data[inside]]
    offsets = np.append(inside.cumsum(dtype=np.int32)[begin] - 1, len(kept)).astype(np.int32)
    terms = pa.BinaryArray.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])
    return terms, np.searchsorted(starts, begin, side="right") - 1


class Block:
    """(document, term) postings since the last run; the empty term stands in every document, so none is lost."""

    def __init__(self):
        self.groups: dict[tuple[str, str], int] = {}
        self.group_of: list[int] = []
        self.pieces: list[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, groups: list[tuple[str, str]], data: np.ndarray, offsets: np.ndarray) -> None:
        """Texts between neighbouring ``offsets`` of ``data``, each in a group."""
        first = len(self.group_of)
        self.group_of += [self.groups.setdefault(g, len(self.groups)) for g in groups]
        self.size += len(groups)
        if offsets[-1] - offsets[0] <= PIECE_BYTES:
            self._keep(*_postings(data[offsets[0]:offsets[-1]], offsets[:-1] - offsets[0]), first)
        else:  # one long text: its pieces become one set of postings again
            pieces = [_postings(piece, np.zeros(1, np.int64)) for piece in _pieces(data[offsets[0]:offsets[-1]])]
            terms, place = _distinct([p[0] for p in pieces])
            local = np.concatenate([p[1] + at for p, at in zip(pieces, np.cumsum([0, *[len(p[0]) for p in pieces]]))])
            counts = np.bincount(place[local], np.concatenate([p[3] for p in pieces]), len(terms)).astype(np.int64)
            self._keep(terms, np.arange(len(terms)), np.zeros(len(terms), np.int64), counts, first)

    def _keep(self, terms: pa.Array, code: np.ndarray, text: np.ndarray, n: np.ndarray, first: int) -> None:
        self.pieces.append((terms, code, text + first, n))
        self.size += len(code)

    def counts(self) -> Counts:
        docs = len(self.group_of)
        pieces = [*self.pieces, (pa.array([b""], pa.binary()), np.zeros(docs, np.int64), np.arange(docs),
                                 np.zeros(docs, np.int64))]
        terms, place = _distinct([p[0] for p in pieces])
        ends = np.cumsum([0, *[len(p[0]) for p in pieces]])
        term = place[np.concatenate([code + at for (_, code, _, _), at in zip(pieces, ends)])]
        names = sorted(self.groups)
        rank = np.empty(len(names), np.int64)
        rank[[self.groups[g] for g in names]] = np.arange(len(names))
        group = rank[np.array(self.group_of, np.int64)][np.concatenate([p[2] for p in pieces])]
        key = term * len(names) + group
        order = np.argsort(key, kind="stable")
        key = key[order]
        start = _starts(key)
        n = np.add.reduceat(np.concatenate([p[3] for p in pieces])[order], start)
        return Counts(terms, names, key[start] // len(names), key[start] % len(names), n,
                      np.diff(start, append=len(key)))


def _postings(data: np.ndarray, starts: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms, and per (text, term): the term's place among them, the text, the occurrences."""
    terms, text = cut_terms(data, starts)
    coded = terms.dictionary_encode()
    size = max(1, len(coded.dictionary))
    key, n = np.unique(text * size + coded.indices.to_numpy(), return_counts=True)
    return coded.dictionary, key % size, key // size, n


def _pieces(data: np.ndarray) -> Iterator[np.ndarray]:
    """A long text in pieces of about ``PIECE_BYTES`` that cut no term."""
    start = 0
    while len(data) - start > PIECE_BYTES:
        end = start + PIECE_BYTES
        while end < len(data) and _IN_TERM[data[end:end + 4096]].all():
            end += 4096
        end = min(len(data), end + int(np.argmin(_IN_TERM[data[end:end + 4096]]))) if end < len(data) else len(data)
        yield data[start:end]
        start = end
    yield data[start:]


def _segments(run: int, counts: Counts, shards: int) -> Iterator[pa.RecordBatch]:
    """A run as one row per shard of terms."""
    if not len(counts.term):
        return
    hashes = pd.util.hash_array(np.array(counts.terms.to_pylist(), dtype=object), categorize=False)
    shard = (hashes % np.uint64(shards)).astype(np.int64)[counts.term]
    order = np.argsort(shard, kind="stable")
    cuts = np.append(_starts(shard[order]), len(order))
    for start, end in zip(cuts, cuts[1:]):
        some = order[start:end]
        used, group = np.unique(counts.group[some], return_inverse=True)
        langs, sources = zip(*(counts.groups[g] for g in used))
        postings = pa.RecordBatch.from_arrays(
            [counts.terms.take(pa.array(counts.term[some])), pa.array(group, pa.int32()), pa.array(counts.n[some]),
             pa.array(counts.docs[some])], schema=_POSTINGS)
        yield pa.RecordBatch.from_arrays(
            [pa.array([run], pa.int64()), pa.array([shard[some[0]]], pa.int32()),
             pa.array([langs], pa.list_(pa.string())), pa.array([sources], pa.list_(pa.string())),
             pa.array([postings.serialize().to_pybytes()], pa.binary())], _RUN_NAMES)


def index_runs(docs: DataFrame, block_postings: int = BLOCK_POSTINGS, shards: int = SHARDS) -> DataFrame:
    """Rows of runs, from the columns lang, source and text, which hold no NULL."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, run = Block(), TaskContext.get().partitionId() << 24
        for batch in batches:
            groups = list(zip(*(batch.column(i).to_pylist() for i in (0, 1))))
            text = batch.column(2).cast(pa.large_binary())
            _, offsets, data = text.buffers()
            offsets = np.frombuffer(offsets, np.int64)[text.offset:text.offset + len(text) + 1] if len(text) else None
            data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
            start = 0
            while start < len(text):
                end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + PIECE_BYTES, side="right")) - 1)
                block.add(groups[start:end], data, offsets[start:end + 1])
                start = end
                if block.size >= block_postings:
                    yield from _segments(run, block.counts(), shards)
                    block, run = Block(), run + 1
        if block.size:
            yield from _segments(run, block.counts(), shards)

    return docs.mapInArrow(index, _RUNS)


# -- merging runs ----------------------------------------------------------------------------------------------------

def merge_segments(segments: list[tuple[list[str], list[str], bytes]]) -> Counts:
    """One shard of several runs: entries go through a heap over the runs, and those of one term and group are summed.

    A heap entry is one whole number: the term's place, the group's place, the entry's own place.
    """
    names = sorted({g for langs, sources, _ in segments for g in zip(langs, sources)})
    at = {g: i for i, g in enumerate(names)}
    runs = [pa.ipc.read_record_batch(pa.py_buffer(data), _POSTINGS) for _, _, data in segments]
    terms, term = _distinct([r.column("term") for r in runs])
    group = np.concatenate([np.array([at[g] for g in zip(langs, sources)], np.int64)[r.column("group").to_numpy()]
                            for (langs, sources, _), r in zip(segments, runs)])
    size = len(term)
    kind = np.int64 if len(terms) * len(names) * size < 1 << 63 else object
    packed = (term.astype(kind) * len(names) + group) * size + np.arange(size)
    ends = np.cumsum([0, *[r.num_rows for r in runs]])
    merged = np.fromiter(heapq.merge(*(packed[a:b].tolist() for a, b in zip(ends, ends[1:]))), kind, size)
    key, order = merged // size, (merged % size).astype(np.int64)
    start = _starts(key)
    n, docs = (np.add.reduceat(np.concatenate([r.column(c).to_numpy() for r in runs])[order], start)
               for c in ("n", "docs"))
    return Counts(terms, names, (key[start] // len(names)).astype(np.int64), (key[start] % len(names)).astype(np.int64),
                  n, docs)


def _lists(counts: Counts, min_documents: int) -> pa.RecordBatch:
    """Posting lists of the terms in enough documents of a language; the empty term's counts are documents."""
    langs = sorted({lang for lang, _ in counts.groups})
    lang_of = np.array([langs.index(lang) for lang, _ in counts.groups], np.int64) if len(langs) < 100 else np.unique(
        np.array([lang for lang, _ in counts.groups], object), return_inverse=True)[1]
    sources = pa.array([source for _, source in counts.groups], pa.string())
    key = counts.term * len(langs) + lang_of[counts.group]
    start = _starts(key)
    docs = np.add.reduceat(counts.docs, start)
    marker = np.array([not t.as_py() for t in counts.terms[:1]] or [False])[0]
    empty = (counts.term == 0) & marker
    kept = (docs >= min_documents) | empty[start]
    sizes = np.diff(start, append=len(key))
    chosen = np.repeat(kept, sizes)
    offsets = pa.array(np.concatenate(([0], sizes[kept].cumsum())), pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array(langs, pa.string()).take(pa.array(key[start][kept] % len(langs))),
         counts.terms.take(pa.array(key[start][kept] // len(langs))),
         pa.ListArray.from_arrays(offsets, sources.take(pa.array(counts.group[chosen]))),
         pa.ListArray.from_arrays(offsets, pa.array(np.where(empty, counts.docs, counts.n)[chosen])),
         pa.array(docs[kept])], ["lang", "term", "sources", "counts", "docs"])


def _shards(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, Counts]]:
    """(group of runs, merged counts) of each shard in a task, whose rows come sorted by both."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    for (group, _), some in itertools.groupby(rows, key=lambda r: r[:2]):
        yield group, merge_segments([r[2:] for r in some])


def merge_runs(runs: DataFrame, min_documents: int = MIN_DOCUMENTS, fan_in: int = FAN_IN,
               shards: int = SHARDS) -> DataFrame:
    """Posting lists (lang, term, sources, counts, docs) of the terms in at least ``min_documents`` documents of a
    language, and of the empty term, whose counts are the documents of each source.

    While there are more than ``fan_in`` runs, groups of about that many are merged into one each, so a term that every
    run holds never brings more than about ``fan_in`` entries per source to one task; the merged runs are longer and
    so cut into more shards. ``runs`` must be stored; it is discarded.
    """
    spark = runs.sparkSession
    while True:
        number = runs.agg(F.count_distinct("run")).first()[0]
        groups = math.ceil(number / fan_in)
        group = F.pmod(F.xxhash64("run"), F.lit(groups)) if groups > 1 else F.lit(0).cast("long")
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), shards, shards * groups)
        dealt = (runs.select(group.alias("group"), *_RUN_NAMES[1:]).repartition(tasks, "group", "shard")
                 .sortWithinPartitions("group", "shard"))
        finer = shards * FINER

        def into_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for group, counts in _shards(batches):
                yield from _segments(group, counts, finer)

        def into_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, counts in _shards(batches):
                yield _lists(counts, min_documents)

        merged = materialize(dealt.mapInArrow(into_runs, _RUNS) if groups > 1 else
                             dealt.mapInArrow(into_lists, _LISTS))
        discard(runs)
        if groups <= 1:
            return merged
        runs, shards = merged, finer


# -- chances and their differences -----------------------------------------------------------------------------------

def chance(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(UNIT * (count + 5) / (total + 5 * kept)), exact at any count that fits a long."""
    def wide(value: Column, digits: int) -> Column:
        return value.cast(f"decimal({digits},0)")

    above = wide(F.lit(UNIT), 10) * (wide(count, 20) + SMOOTHING)
    below = wide(total, 20) + wide(kept, 15) * SMOOTHING
    return F.call_function("div", above, below) + 1


def _one_sided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per source and each other one: the differences as if no term were in both, shared out over both directions."""
    for batch in batches:
        for row in batch.to_pylist():
            base, kept = row["base"], row["kept"]
            held = sorted((h["p"], h["terms"]) for h in row["held"] or [])
            p, terms = (np.array([h[i] for h in held], np.int64) for i in (0, 1))
            others = [o for o in row["others"] if o["source"] != row["source"]]
            names, bases = [o["source"] for o in others], np.array([o["base"] for o in others], np.int64)
            upto, sums = (np.concatenate(([0], x.cumsum())) for x in (terms, terms * p))
            at = np.searchsorted(p, bases, side="right")
            far = bases * upto[at] - sums[at] + (sums[-1] - sums[at]) - bases * (upto[-1] - upto[at])
            gap = np.abs(base - bases)
            own = far - gap * upto[-1]
            me = [row["source"]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["lang"]] * (2 * len(names)), pa.string()), pa.array(me + names, pa.string()),
                 pa.array(names + me, pa.string()), pa.array(np.concatenate((own + kept * gap, own)), pa.int64())],
                ["lang", "source", "item", "value"])


def _both(p: np.ndarray, base: np.ndarray, other: np.ndarray, other_base: np.ndarray) -> np.ndarray:
    """For a term that two sources hold: its difference less what the one-sided sums took it for."""
    p, base = p[:, None], base[:, None]
    return np.abs(p - other) - np.abs(p - other_base) - np.abs(base - other) + np.abs(base - other_base)


def _pair_rows(lang: str, rows: list[str], columns: list[str], sums: np.ndarray) -> pa.RecordBatch:
    i, j = np.nonzero(sums)
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(i), pa.string()), pa.array(rows, pa.string()).take(pa.array(i)),
         pa.array(columns, pa.string()).take(pa.array(j)), pa.array(sums[i, j], pa.int64())],
        ["lang", "source", "item", "value"])


def _corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over the terms of a task per pair of sources that share some; tables are sent when they are full."""
    places: dict[str, dict[str, int]] = {}
    tables: dict[str, np.ndarray] = {}

    def send(langs: list[str]) -> Iterator[pa.RecordBatch]:
        for lang in langs:
            names = list(places.pop(lang))
            yield _pair_rows(lang, names, names, tables.pop(lang)[:len(names), :len(names)])

    for batch in batches:
        langs, held = batch.column("lang").to_pylist(), batch.column("held")
        cuts = np.diff(held.offsets.to_numpy()).cumsum()
        cells = held.flatten()
        source, all_p, all_base = (cells.field(c) for c in ("source", "p", "base"))
        source = source.dictionary_encode()
        known, codes = source.dictionary.to_pylist(), source.indices.to_numpy()
        all_p, all_base = all_p.to_numpy(), all_base.to_numpy()
        for lang, start, end in zip(langs, [0, *cuts], cuts):
            names, p, base = [known[c] for c in codes[start:end]], all_p[start:end], all_base[start:end]
            if len(names) > TABLE_SOURCES:
                blocks = [slice(i, i + TABLE_SOURCES) for i in range(0, len(names), TABLE_SOURCES)]
                for i, j in itertools.product(blocks, blocks):
                    sums = _both(p[i], base[i], p[j], base[j])
                    if i == j:
                        np.fill_diagonal(sums, 0)
                    yield _pair_rows(lang, names[i], names[j], sums)
                continue
            place = places.setdefault(lang, {})
            at = [place.setdefault(n, len(place)) for n in names]
            if len(place) > TABLE_SOURCES:
                for name in names:  # new ones that the table has no room for wait until it is sent
                    if place[name] >= len(tables[lang]):
                        del place[name]
                yield from send([lang])
                place = places.setdefault(lang, {})
                at = [place.setdefault(n, len(place)) for n in names]
            table = tables.get(lang, np.zeros((0, 0), np.int64))
            if len(place) > len(table):
                size = min(TABLE_SOURCES, max(len(place), 2 * len(table)))
                table = tables[lang] = np.pad(table, (0, size - len(table)))
            sums = _both(p, base, p, base)
            np.fill_diagonal(sums, 0)
            table[np.ix_(at, at)] += sums
        if sum(t.size for t in tables.values()) > 8 * TABLE_SOURCES ** 2:
            yield from send(list(tables))
    yield from send(list(tables))


def posting_lists(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text",
                  min_documents: int = MIN_DOCUMENTS, block_postings: int = BLOCK_POSTINGS, fan_in: int = FAN_IN,
                  shards: int = SHARDS) -> DataFrame:
    """(lang, term, sources, counts, docs) of the terms that enough documents of their language hold; see ``merge_runs``.

    Texts are read once; only sorted runs of counted terms are written and shuffled.
    """
    rows = docs.select(text_of(lang).alias("lang"), text_of(source).alias("source"), text_of(text).alias("text"))
    return merge_runs(materialize(index_runs(rows, block_postings, shards)), min_documents, fan_in, shards)


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text",
          min_documents: int = MIN_DOCUMENTS, top: int = TOP_TERMS, **options) -> DataFrame:
    """Per language and source: how far it is from every other source (part ``pair``), and the ``top`` terms it uses
    more than its language does (part ``term``): lang, source, part, item, value, rank.

    NULL in any of the three columns counts as the empty text; other columns are not read. Terms are runs of ASCII
    letters, put in lower case, and of characters outside ASCII. A language keeps the terms in at least
    ``min_documents`` of its documents, repeated rows counted each. A source's chance of a kept term is
    1 + floor(10^9 * (count + 5) / (total + 5 * kept terms)), and so is the language's. A pair's value is the sum of
    the differences over all kept terms (0 if there are none), a term's the difference to the language. Ranks start at
    1, larger values first, ties by item. Sources without terms take part; a language's only source has no pair. An
    empty table gives no rows. Very long texts are indexed in pieces. The rows of a pair are as many as asked for:
    every other source of the language; nothing else here grows with the square of the sources.
    """
    lists = posting_lists(docs, lang, source, text, min_documents, **options)
    terms = lists.filter(F.length("term") > 0).withColumn("all", F.aggregate("counts", F.lit(0).cast("long"),
                                                                            lambda a, b: a + b))
    kept = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("all").alias("lang_total"))
    cells = terms.select("lang", "term", "all", F.inline(F.arrays_zip(F.col("sources").alias("source"),
                                                                     F.col("counts").alias("n"))))
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    every = lists.filter(F.length("term") == 0).select("lang", F.explode("sources").alias("source"))
    groups = every.join(totals, ["lang", "source"], "left").join(kept, ["lang"], "left").select(
        "lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("kept", F.lit(0)).alias("kept"),
        F.coalesce("lang_total", F.lit(0)).alias("lang_total"))
    base = F.when(F.col("kept") > 0, chance(F.lit(0), F.col("total"), F.greatest(F.col("kept"), F.lit(1))))
    groups = materialize(groups.withColumn("base", F.coalesce(base, F.lit(0)).cast("long")))

    known = join_measured(cells, groups, ["lang", "source"], GROUP_BYTES)
    cells = materialize(known.select(
        "lang", "term", "source", "base", chance(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
        chance(F.col("all"), F.col("lang_total"), F.col("kept")).alias("q")))
    discard(lists)

    ranked = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc())
    above = (cells.filter("p > q")
             .select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"),
                     (F.col("p") - F.col("q")).alias("value"))
             .withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= top))

    held = (cells.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("terms"))
            .groupBy("lang", "source").agg(F.collect_list(F.struct("p", "terms")).alias("held")))
    others = materialize(groups.groupBy("lang").agg(F.collect_list(F.struct("source", "base")).alias("others")))
    # A language's list is as long as the rows asked for per source; it is broadcast by the size of all lists.
    facing = join_measured(groups.join(held, ["lang", "source"], "left").select("lang", "source", "base", "kept", "held"),
                           others, ["lang"], GROUP_BYTES * math.ceil(groups.count() / max(1, others.count())))
    shared = (cells.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "base")).alias("held"))
              .filter(F.size("held") > 1).select("lang", "held"))
    form = "lang string, source string, item string, value long"
    pairs = (facing.mapInArrow(_one_sided, form).unionByName(shared.mapInArrow(_corrections, form))
             .groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))
    apart = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn(
        "rank", F.row_number().over(ranked))
    return apart.unionByName(above)


def audit_sql(min_documents: int = MIN_DOCUMENTS, top: int = TOP_TERMS) -> str:
    """The same in SQL, from a row per source and kept term."""
    chances = "1 + ({unit} * ({count} + {more})) // ({total} + {more} * kept)"

    def p(count: str, total: str) -> str:
        return chances.format(unit=UNIT, more=SMOOTHING, count=count, total=total)

    return f"""
    WITH docs AS (
        SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
        FROM documents),
    found AS MATERIALIZED (
        SELECT doc, lang, source, term, count(*) AS n
        FROM (SELECT doc, lang, source, unnest(terms) AS term FROM docs) GROUP BY ALL),
    words AS MATERIALIZED (
        SELECT lang, term, sum(n)::BIGINT AS n FROM found GROUP BY lang, term HAVING count(*) >= {min_documents}),
    langs AS (SELECT lang, count(*) AS kept, sum(n)::BIGINT AS total FROM words GROUP BY lang),
    groups AS MATERIALIZED (SELECT DISTINCT lang, source FROM docs),
    counted AS (
        SELECT g.lang, g.source, w.term, w.n AS lang_n, coalesce(c.n, 0) AS n
        FROM groups g JOIN words w USING (lang)
        LEFT JOIN (SELECT lang, source, term, sum(n)::BIGINT AS n FROM found GROUP BY ALL) c USING (lang, source, term)),
    cells AS MATERIALIZED (
        SELECT lang, source, term, n, {p('n', 'group_total')} AS p, {p('lang_n', 'total')} AS q
        FROM (SELECT *, (sum(n) OVER (PARTITION BY lang, source))::BIGINT AS group_total FROM counted)
        JOIN langs USING (lang)),
    pairs AS (
        SELECT g.lang, g.source, h.source AS item, coalesce(max(d.value), 0)::BIGINT AS value
        FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
        LEFT JOIN (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
                   FROM cells a JOIN cells b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
                   GROUP BY ALL) d ON d.lang = g.lang AND d.source = g.source AND d.item = h.source
        GROUP BY ALL),
    ranked AS (
        SELECT lang, source, 'pair' AS part, item, value FROM pairs
        UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM cells WHERE n > 0 AND p > q)
    SELECT * FROM (
        SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
        FROM ranked)
    WHERE part = 'pair' OR rank <= {top}"""
