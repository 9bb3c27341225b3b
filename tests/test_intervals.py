import random

import pytest
from pyspark.sql import functions as F

from lakeops.operators import ordering
from lakeops.operators.intervals import as_of, current, merge_history

CHANGES = "k int, t int, s int, v string, gone boolean"


def slow_history(batches, collapse=False):
    """(key, value, from, to, deleted) by replaying each batch on per-key lists of events."""
    state = {}
    for batch in batches:
        news = {}
        for k, t, s, v, gone in batch:
            old = news.get((k, t))
            if old is None or s > old[0]:
                news[k, t] = (s, None if gone else v, bool(gone))
        for (k, t), (_, v, gone) in news.items():
            state.setdefault(k, {})[t] = (v, gone)
        if collapse:
            for k, events in state.items():
                last, kept = (None, True), {}
                for t in sorted(events):
                    if events[t] != last:
                        kept[t] = last = events[t]
                state[k] = kept
    out = []
    for k, events in state.items():
        times = sorted(events)
        out += [(k, events[t][0], t, u, events[t][1]) for t, u in zip(times, times[1:] + [None])]
    return sorted(out, key=str)


def draw(rng, n, keys):
    rows = [(rng.choice(keys), rng.randrange(60), rng.randrange(10**6), rng.choice(["a", "b", None]),
             rng.choice([False, False, False, True, None])) for _ in range(n)]
    return rows


def merged(spark, batches, **options):
    state = None
    for batch in batches:
        state = merge_history(state, spark.createDataFrame(batch, CHANGES), ["k"], "t", "s", "gone", **options)
    return state


@pytest.mark.parametrize("collapse", [False, True])
def test_against_replay(spark, collapse):
    rng = random.Random(11)
    batches = [draw(rng, n, [1, 1, 1, 1, 2, 3, None]) for n in (40, 1, 25)]
    state = merged(spark, batches, collapse=collapse, chunks=5)
    assert state.columns == ["k", "v", "valid_from", "valid_to", "deleted"]
    assert sorted(map(tuple, state.collect()), key=str) == slow_history(batches, collapse)


def test_order_of_arrival_does_not_matter(spark):
    rng = random.Random(4)
    times = rng.sample(range(500), 60)
    rows = [(rng.choice([1, 1, 2]), t, 0, rng.choice("abc"), rng.random() < 0.2) for t in times]
    one = merged(spark, [rows])
    parts = merged(spark, [rows[40:], rows[:15], rows[15:40]])
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, parts.collect()), key=str)
    for when in (0, 100, 250, 499):
        last = {}
        for k, t, _, v, gone in sorted(rows, key=lambda r: r[1]):
            if t <= when:
                last[k] = None if gone else v
        found = {r.k: r.v for r in as_of(parts, F.lit(when)).collect()}
        assert found == {k: v for k, v in last.items() if v is not None}
    assert sorted(current(one).collect()) == sorted(as_of(one, F.lit(10**6)).collect())


def test_late_change_splits_a_stretch_and_gaps_stay(spark):
    state = spark.createDataFrame([(1, "a", 10, 20, False), (1, "b", 30, None, False), (2, "z", 0, None, False)],
                                  "k int, v string, valid_from int, valid_to int, deleted boolean")
    changes = spark.createDataFrame([(1, 15, "late"), (1, 25, "gap"), (3, 1, "new")], "k int, t int, v string")
    rows = sorted(map(tuple, merge_history(state, changes, ["k"], "t").collect()), key=lambda r: (r[0], r[2]))
    assert rows == [(1, "a", 10, 15, False), (1, "late", 15, 20, False), (1, None, 20, 25, True),
                    (1, "gap", 25, 30, False), (1, "b", 30, None, False), (2, "z", 0, None, False),
                    (3, "new", 1, None, False)]


def test_conflicts_nulls_and_wrong_columns(spark):
    def change(rows, schema="k int, t int, v string"):
        return spark.createDataFrame(rows, schema)

    same = merge_history(None, change([(1, 1, "a"), (1, 1, "a")]), ["k"], "t")
    assert [tuple(r) for r in same.collect()] == [(1, "a", 1, None, False)]
    with pytest.raises(Exception, match="differ"):
        merge_history(None, change([(1, 1, "a"), (1, 1, "b")]), ["k"], "t").collect()
    with pytest.raises(Exception, match="t is NULL"):
        merge_history(None, change([(1, None, "a")]), ["k"], "t").collect()
    with pytest.raises(ValueError, match="v: string and int"):
        merge_history(same, change([(1, 2, 3)], "k int, t int, v int"), ["k"], "t")
    with pytest.raises(ValueError, match="unknown"):
        merge_history(same, change([(1, 2, "a", 3)], "k int, t int, v string, w int"), ["k"], "t")
    with pytest.raises(ValueError, match="taken"):
        merge_history(None, change([(1, 2, True)], "k int, t int, deleted boolean"), ["k"], "t")
    assert merge_history(None, change([]), ["k"], "t").collect() == []
    assert merge_history(same, change([]), ["k"], "t").collect() == same.collect()


def test_names_like_work_columns_and_two_keys(spark):
    names = "`a.b` int, _time int, t int, _body string, _order int, _chunk int"
    rows = [(1, 1, 5, "x", 0, 7), (1, 1, 9, "y", 0, 7), (1, 2, 5, "z", 0, 7)]
    found = merge_history(None, spark.createDataFrame(rows, names), ["a.b", "_time"], "t").collect()
    assert sorted(map(tuple, found), key=str) == sorted(
        [(1, 1, "x", 0, 7, 5, 9, False), (1, 1, "y", 0, 7, 9, None, False), (1, 2, "z", 0, 7, 5, None, False)], key=str)


def test_one_key_with_most_changes_spans_tasks(spark):
    rows = spark.range(20_000).select(F.lit(1).alias("k"), F.col("id").cast("int").alias("t"),
                                      (F.col("id") % 3).alias("v"))
    state = merge_history(None, rows, ["k"], "t", chunks=6)
    assert state.filter("valid_to = valid_from + 1").count() == 19_999
    assert state.filter("valid_to IS NULL").count() == 1
    near = ordering.with_neighbours(rows, ["k"], [F.col("t")], {"p": F.col("v")}, {"n": F.col("t")}, chunks=6)
    parts = spark.read.parquet(near.stored_at).select(F.spark_partition_id().alias("p"), "k").groupBy("p").count().collect()
    assert max(r["count"] for r in parts) < 10_000
    assert near.filter("p <=> if(t = 0, NULL, (t - 1) % 3) AND n <=> if(t = 19999, NULL, t + 1)").count() == 20_000


def test_stored_history_rewrites_only_parts_with_changed_keys(spark):
    from lakeops.operators.versions import VersionedTable
    from lakeops.session import scratch_database
    first = merge_history(None, spark.createDataFrame([(1, 1, "a"), (None, 1, "n")], "k int, t int, v string"), ["k"], "t")
    table = VersionedTable.create(spark, f"{scratch_database(spark, 'h')}.rows", first)
    table.append(merge_history(None, spark.createDataFrame([(2, 1, "b")], "k int, t int, v string"), ["k"], "t"))
    table.merge_history(spark.createDataFrame([(None, 5, "m"), (3, 5, "c")], "k int, t int, v string"), ["k"], "t")
    assert sorted(map(tuple, table.read().collect()), key=str) == sorted(
        [(1, "a", 1, None, False), (2, "b", 1, None, False), (3, "c", 5, None, False), (None, "n", 1, 5, False),
         (None, "m", 5, None, False)], key=str)
    newest = table.history().first()
    assert newest.operation == "merge_history" and newest.parts == [1, 2]
