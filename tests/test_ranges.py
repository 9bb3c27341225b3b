import datetime
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lakeops.operators import ranges
from lakeops.operators.ranges import cover, overlap_join, point_join


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**6), st.integers(0, 10**6))
def test_cover_holds_each_cell_once(one, two):
    first, last = min(one, two), max(one, two)
    held = sorted((n >> 5 << ranges.STEP * (n & 31), (n >> 5) + 1 << ranges.STEP * (n & 31)) for n in cover(first, last))
    assert held[0][0] == first and held[-1][1] == last + 1
    assert all(a[1] == b[0] for a, b in zip(held, held[1:]))
    assert len(held) <= 2 * 15 * 6


@settings(max_examples=100, deadline=None)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=32), min_size=1, max_size=40),
       st.lists(st.floats(allow_nan=False), min_size=2, max_size=40), st.integers(1, 10**6))
def test_cells_keep_the_order(bounds, values, points):
    cells = ranges._Cells(bounds, points, 10)
    found = cells.number(np.array(sorted(values)))
    assert (np.diff(found) >= 0).all() and found.min() >= 0 and found.max() <= cells.last


def held(low, x, high, closed):
    return (low is None or low <= x) and (high is None or (x <= high if closed else x < high))


def overlap(a, b, closed):
    if any(lo is not None and hi is not None and not (lo <= hi if closed else lo < hi) for lo, hi in (a, b)):
        return False
    return all(lo is None or hi is None or (lo <= hi if closed else lo < hi) for lo, hi in ((a[0], b[1]), (b[0], a[1])))


def draw(rng, n, wide):
    """Many ties, short and long intervals, open, empty and reversed ones."""
    out = []
    for i in range(n):
        low = rng.choice([rng.randrange(100), rng.randrange(wide), 50])
        high = low + rng.choice([0, 1, 5, 5, 40, wide, -3])
        out.append((i, rng.choice(["a", "a", "b", None]), None if rng.random() < 0.08 else low,
                    None if rng.random() < 0.08 else high))
    return out


@pytest.mark.parametrize("closed,keys,cell", [(True, [], 2), (False, ["g"], 5), (True, ["g"], 1000)])
def test_against_all_pairs(spark, closed, keys, cell):
    rng = random.Random(6)
    one, two = draw(rng, 90, 3000), draw(rng, 70, 3000)
    left, right = (spark.createDataFrame(rows, "i int, g string, low int, high int") for rows in (one, two))
    found = overlap_join(left, right, ("low", "high"), ("low", "high"), keys, closed, cell_points=cell)
    assert found.columns == ["i", "g", "low", "high", "i_right", "g_right", "low_right", "high_right"]
    same = lambda a, b: not keys or (a[1] is not None and a[1] == b[1])
    want = sorted((a[0], b[0]) for a in one for b in two if same(a, b) and overlap(a[2:], b[2:], closed))
    assert sorted((r.i, r.i_right) for r in found.collect()) == want and len(want) > 100
    found = point_join(left, right, "low", ("low", "high"), keys, closed, cell_points=cell)
    want = sorted((a[0], b[0]) for a in one for b in two if same(a, b) and a[2] is not None and held(b[2], a[2], b[3], closed)
                  and not (b[2] is not None and b[3] is not None and b[2] > b[3]))
    assert sorted((r.i, r.i_right) for r in found.collect()) == want


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "double", "decimal(20,0)", "bigint"])
def test_types(spark, kind):
    base = {"date": "date_add(DATE'2024-01-01', int(id))", "timestamp": "TIMESTAMP'2024-03-30 22:00:00' + make_interval(0,0,0,0,int(id))",
            "timestamp_ntz": "CAST(TIMESTAMP'2024-03-30 22:00:00' + make_interval(0,0,0,0,int(id)) AS TIMESTAMP_NTZ)",
            "double": "CASE WHEN id = 9 THEN double('NaN') ELSE id / 3D END",
            "decimal(20,0)": "CAST(9007199254740990 + id AS DECIMAL(20,0))", "bigint": "9007199254740990 + id"}[kind]
    rows = spark.range(10).selectExpr("CAST(id AS INT) AS id", f"CAST({base} AS {kind}) AS x")
    ends = rows.alias("l").join(rows.alias("r"), F.expr("r.id = l.id + 2")).selectExpr("l.id AS w", "l.x AS s", "r.x AS e")
    found = point_join(rows, ends, "x", ("s", "e"), closed=False, cell_points=1).select("id", "w").collect()
    assert sorted(map(tuple, found)) == sorted((i, w) for i in range(10) for w in range(8) if w <= i < w + 2)


def test_empty_tables_names_and_wrong_types(spark):
    rows = spark.createDataFrame([(1, 2, 3, 4, 5)], "x int, low int, high int, cell int, a int")
    for left, right in ((rows, rows), (rows.limit(0), rows), (rows, rows.limit(0))):
        found = overlap_join(left, right, ("low", "high"), ("low", "high"))
        assert found.count() == (1 if left is right else 0) and len(found.columns) == 10
    with pytest.raises(ValueError, match="different types"):
        point_join(rows, rows.withColumn("high", F.lit(1.5)), "x", ("low", "high"))
    with pytest.raises(ValueError, match="string"):
        texts = rows.select(*[F.col(c).cast("string") for c in rows.columns])
        point_join(texts, texts, "x", ("low", "high")).count()


def test_plan_joins_by_equality(spark):
    rows = spark.range(1000).selectExpr("id", "id AS low", "id + 3 AS high")
    plan = overlap_join(rows, rows, ("low", "high"), ("low", "high"))._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_many_points_make_few_candidates(spark):
    points = spark.range(40_000).selectExpr("id", "CAST(pow(id / 1000D, 3) AS DOUBLE) AS x")  # very uneven
    ends = points.filter("id % 10 = 0").selectExpr("id AS w", "x AS s", "x + 0.01 AS e")
    met = ranges._meet(points.select("x", F.struct("id").alias("a")),
                       ends.select(F.col("s").alias("low"), F.col("e").alias("high"), F.struct("w").alias("b")),
                       points.schema["x"].dataType, 0, 64)
    assert met.count() < 40_000 * 4_000 / 100
    assert point_join(points, ends, "x", ("s", "e"), cell_points=64).count() == points.alias("p").join(
        F.broadcast(ends), F.expr("s <= x AND x <= e")).count()


def keyed(spark, sizes, wide):
    """Points spread over ``wide`` steps, and intervals of a hundredth of that, of keys of so many rows each."""
    rows = spark.createDataFrame([(g, n) for g, n in sizes], "g int, n int").selectExpr("g", "explode(sequence(1, n)) AS i")
    return rows.selectExpr("g", "i", f"CAST(pmod(hash(g, i), {wide}) AS BIGINT) AS low").selectExpr(
        "g", "i", "low", f"low + {wide} DIV 100 AS high")


def met_by(rows, cell):
    return ranges._meet(
        rows.selectExpr("low AS x", "g AS k0", "struct(i) AS a"), rows.selectExpr("low", "high", "g AS k0", "struct(i) AS b"),
        rows.schema["low"].dataType, 1, cell)


def test_keys_of_few_points_are_not_cut_by_the_points_of_others(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(ranges, "materialize", lambda df: stored.append(df.localCheckpoint()) or stored[-1])
    # Many small keys: nothing but the keys is joined. With a large key beside them only its intervals have more cells.
    assert met_by(keyed(spark, [(g, 5) for g in range(4000)], 10**6), 16).columns == ["k0", "a", "b"]
    stored.clear()
    met_by(keyed(spark, [(g, 5) for g in range(4000)] + [(-1, 3000)], 10**6), 16)
    covered = stored[-1].groupBy("k0").count()
    assert covered.filter("k0 < 0").first()["count"] > 3000
    assert covered.filter("k0 >= 0").agg(F.max("count")).first()[0] == 5


@pytest.mark.parametrize("sizes", [[(1, 400), (2, 3), (3, 90), (4, 1)], [(1, 2000)], [(g, 3) for g in range(300)]])
def test_keys_of_all_sizes_against_all_pairs(spark, sizes):
    plain = [(r.g, r.i, r.low if r.i % 50 else None, r.high if r.i % 77 else None) for r in keyed(spark, sizes, 20_000).collect()]
    rows = spark.createDataFrame(plain, "g int, i int, low bigint, high bigint")
    found = overlap_join(rows, rows, ("low", "high"), ("low", "high"), ["g"], cell_points=16)
    one, two = rows.alias("a"), rows.alias("b")
    want = one.join(two, F.expr("a.g = b.g AND (a.low IS NULL OR b.high IS NULL OR a.low <= b.high)"
                                " AND (b.low IS NULL OR a.high IS NULL OR b.low <= a.high)"))
    got = [(r.g, r.i, r.i_right) for r in found.collect()]
    assert sorted(got) == sorted(tuple(r) for r in want.select("a.g", "a.i", "b.i").collect()) and len(got) > 300


def test_a_large_key_makes_few_candidates(spark):
    # Of 20,000 points in one place of the line and 300 small keys all over it.
    rows = keyed(spark, [(g, 5) for g in range(300)], 10**7).unionByName(keyed(spark, [(-1, 20_000)], 10**5))
    assert met_by(rows, 64).count() < 20_000 * 20_000 / 20
