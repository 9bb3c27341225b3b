import zlib
from collections import Counter

import numpy as np
import pytest

from lakeops.llm import queries, sharding
from lakeops.llm.sharding import Permutation


@pytest.mark.parametrize("rows", [0, 1, 2, 3, 5, 40, 41, 1000, 4097])
def test_every_number_gets_one_place_and_back(rows):
    one = Permutation(rows, seed=3)
    places = one.forward(np.arange(rows))
    assert sorted(places) == list(range(rows))
    assert list(one.backward(places)) == list(range(rows))
    if rows > 40:
        assert list(places) != list(Permutation(rows, seed=4).forward(np.arange(rows)))
        assert list(places) == list(Permutation(rows, seed=3).forward(np.arange(rows)))


def test_large_numbers_and_single_places():
    one = Permutation(3 * 10 ** 17, seed=1)
    some = np.array([0, 1, 10 ** 9, 3 * 10 ** 17 - 1])
    assert list(one.backward(one.forward(some))) == list(some)
    shard, slot = one.place(10 ** 9, 40)
    assert one.row_at(shard, slot, 40) == 10 ** 9
    with pytest.raises(ValueError):
        one.forward([3 * 10 ** 17])


def test_neighbours_are_spread():
    shards = Permutation(100_000, seed=0).forward(np.arange(1000)) % 40
    assert np.bincount(shards, minlength=40).max() < 60
    steps = np.diff(Permutation(100_000, seed=0).forward(np.arange(2000)))
    assert abs(np.corrcoef(steps[1:], steps[:-1])[0, 1] + 0.5) < 0.1  # as for independent places


def expected(rows, shards=sharding.SHARDS):
    """(doc_id, size, crc, shard, slot) by numbering the sorted rows and permuting one by one."""
    digests = [(i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows]
    digests.sort(key=lambda d: (d[0] is not None, d[0] or 0, *d[1:]))
    one = Permutation(len(rows))
    return sorted((str(d[0]), *d[1:], *one.place(n, shards)) for n, d in enumerate(digests))


def check(df, rows):
    found = df.collect()
    assert df.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert sorted((str(r.doc_id), r.size, r.text_crc32, r.shard, r.slot) for r in found) == expected(rows)
    assert {r.law for r in found} <= {"rows"} and {r.grown_shard for r in found} <= {None}
    counts = Counter(r.shard for r in found)
    sizes = [counts[s] for s in range(40)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(r.slot for r in found if r.shard == s) == list(range(n)) for s, n in counts.items())


def test_query_on_the_given_table(spark, tiny):
    rows = [tuple(r) for r in spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text").collect()]
    check(queries.QUERIES["op12_sharding"](spark, tiny), rows)


def test_awkward_rows_and_partitions(spark, awkward, no_documents):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    for parts in (1, 3, 16):
        check(sharding.report(awkward.repartition(parts)), rows)
    assert sharding.report(no_documents).collect() == []


def test_one_row_many_times(spark):
    rows = [(1, "same")] * 500 + [(i, "x" * i) for i in range(2, 90)]
    check(sharding.report(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)), rows)


def test_whole_rows_keep_clashing_columns(spark, tmp_path):
    names = "_tie int, _number int, _place int, `a.b` int, k long"
    docs = spark.createDataFrame([(7, 8, 9, i % 3, i) for i in range(100)], names)
    placed = sharding.place_rows(docs, ["k"], shards=8, seed=5)
    found = placed.collect()
    assert placed.columns == [*docs.columns, "shard", "slot"]
    one = Permutation(100, 5)
    assert all((r.shard, r.slot) == one.place(r.k, 8) and r._tie == 7 and r["a.b"] == r.k % 3 for r in found)
    with pytest.raises(ValueError, match="slot"):
        sharding.place_rows(docs.withColumnRenamed("_tie", "Slot"), ["k"])
    path = str(tmp_path / "shards")
    sharding.write_shards(placed, path, shards=8, files_per_shard=2)
    back = spark.read.parquet(path)
    assert sorted((r.k, r.shard, r.slot) for r in back.collect()) == sorted((r.k, r.shard, r.slot) for r in found)
    for shard in range(8):
        files = sorted((tmp_path / "shards" / f"shard={shard}").glob("*.parquet"))
        slots = [r.slot for f in files for r in spark.read.parquet(str(f)).collect()]
        assert slots == sorted(slots)
