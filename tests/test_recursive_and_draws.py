import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.functions.draws import bits, plain_uniform, uniform
from lakeops.models import prepare, synth
from lakeops.operators.recursive import fixpoint, follow_links
from lakeops.operators.selection import smallest_limit


# -- recursion -------------------------------------------------------------------------------------------------------

def reached(edges):
    out = {}
    for a, b in edges:
        out.setdefault(a, set()).add(b)
    pairs = set(edges)
    while True:
        more = {(a, c) for a, b in pairs for c in out.get(b, ())} - pairs
        if not more:
            return pairs
        pairs |= more


@pytest.mark.parametrize("cyclic", [False, True])
def test_fixpoint_is_the_transitive_closure(spark, cyclic):
    rng = random.Random(2)
    edges = [(a, b) for a, b in ((rng.randrange(25), rng.randrange(25)) for _ in range(30)) if cyclic or a < b]
    edges += edges[:3] + [(None, 3), (4, None)]
    df = spark.createDataFrame(edges, "a int, b int")
    next_ones = df.select(F.col("a").alias("x"), F.col("b").alias("y"))
    found = fixpoint(df, lambda new: new.join(next_ones, F.col("b") == F.col("x")).select("a", F.col("y").alias("b")))
    want = reached([e for e in edges if e[0] is not None and e[1] is not None])
    assert {tuple(r) for r in found.filter("a IS NOT NULL AND b IS NOT NULL").collect()} == want
    assert found.count() == found.distinct().count() and found.filter("a IS NULL AND b = 3").count() == 1


def test_fixpoint_limits_and_wrong_steps(spark):
    one = spark.createDataFrame([(1,)], "n int")
    assert sorted(r.n for r in fixpoint(one, lambda new: new.filter("n < 20").select((F.col("n") + 1).alias("n"))).collect()
                  ) == list(range(1, 21))
    with pytest.raises(ValueError, match="after 5 rounds"):
        fixpoint(one, lambda new: new.select((F.col("n") + 1).alias("n")), most_rounds=5)
    with pytest.raises(ValueError, match="instead of"):
        fixpoint(one, lambda new: new.select(F.col("n").cast("string").alias("n")))
    assert fixpoint(one.limit(0), lambda new: new).collect() == []


def slow_roots(links):
    known, out = dict(links), {}
    for node in known:
        at, steps, seen = node, 0, {node}
        while known.get(at) is not None:
            at, steps = known[at], steps + 1
            if at in seen:
                out[node] = (None, None, True)
                break
            seen.add(at)
        else:
            out[node] = (at, steps, False)
    return out


def test_links_are_followed_to_the_end(spark):
    rng = random.Random(9)
    links = [(i, i - 1) for i in range(1, 300)] + [(0, None), (1000, 2000), (1001, 1000)]  # long, and an unlisted end
    links += [(500, 501), (501, 502), (502, 500), (503, 501), (504, 504), (505, 503)]      # cycles and ways into them
    links += [(600 + i, rng.choice([None, 600 + rng.randrange(i)]) if i else None) for i in range(60)]
    df = spark.createDataFrame([*links, links[5], (None, 1)], "root int, _to int").repartition(5)
    found = follow_links(df, "root", "_to")
    assert {r[0]: tuple(r)[1:] for r in found.collect()} == slow_roots(links)
    with pytest.raises(Exception, match="followed by several"):
        follow_links(spark.createDataFrame([(1, 2), (1, None)], "a int, b int"), "a", "b").collect()
    assert follow_links(df.limit(0), "root", "_to").collect() == []


# -- exact draws -----------------------------------------------------------------------------------------------------

def test_limits_against_sorting(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["hot", "hot", "hot", "cold", None]), rng.choice([rng.randrange(2**60), 5, 2**59]), i) for i in range(900)]
    df = spark.createDataFrame(rows, "g string, draw long, tie int").repartition(6)
    for share in (0.0, 0.001, 0.31, 1.0):
        limits = {r.g: tuple(r.limit) for r in smallest_limit(df, ["g"], "draw", ["tie"], F.floor(F.lit(share) * F.col("n"))).collect()}
        for g in {r[0] for r in rows}:
            mine = sorted(r[1:] for r in rows if r[0] == g)
            k = int(share * len(mine))
            assert limits.get(g) == (mine[k - 1] if k else None)
    whole = smallest_limit(df, [], "draw", ["tie"], F.lit(17)).first().limit
    assert tuple(whole) == sorted(r[1:] for r in rows)[16]
    same = spark.createDataFrame([(7, 1)] * 4, "draw long, tie int")
    assert tuple(smallest_limit(same, [], "draw", ["tie"], F.lit(4)).first().limit) == (7, 1)
    with pytest.raises(Exception, match="the key repeats"):
        smallest_limit(same, [], "draw", ["tie"], F.lit(2)).collect()


def test_exactly_so_many_blanks_and_test_rows(spark):
    names = "k long, `g h` string, _limit int, a double, b string"
    rows = spark.range(403).select(F.col("id").alias("k"), F.when(F.col("id") % 4 > 0, "hot").alias("g h"),
                                   F.lit(1).alias("_limit"), F.col("id").cast("double").alias("a"), F.lit("x").alias("b"))
    blanked = synth.inject_missing_exact(rows, "k", ["a", "b"], 0.1, by=["g h"])
    assert blanked.columns == ["k", "g h", "_limit", "a", "b"], names
    counts = {r[0]: tuple(r)[1:] for r in blanked.groupBy("g h").agg(
        F.count("*"), F.count_if(F.col("a").isNull()) + F.count_if(F.col("b").isNull())).collect()}
    assert counts == {"hot": (302, int(0.1 * 604)), None: (101, int(0.1 * 202))}
    again = synth.inject_missing_exact(rows.repartition(9), "k", ["a", "b"], 0.1, by=["g h"])
    assert sorted(map(str, again.collect())) == sorted(map(str, blanked.collect()))
    whole = synth.inject_missing_exact(rows, "k", ["a"], 0.25)
    assert whole.filter("a IS NULL").count() == 100
    assert synth.inject_missing_exact(rows, "k", ["a"], 0.0).filter("a IS NULL").count() == 0
    split = prepare.exact_split(rows, "k", by=["g h"])
    assert {r[0]: r[1] for r in split.groupBy("g h").agg(F.count_if("in_test")).collect()} == {"hot": 100, None: 34}
    assert prepare.exact_split(rows.limit(0), "k").collect() == []


def test_plain_draws_are_those_of_spark(spark):
    row = spark.range(1).select(uniform(F.lit("key 7"), "name", 3), bits(F.lit("key 7"), "name", 3)).first()
    assert row[0] == plain_uniform("key 7", "name", 3) == row[1] / 2**60


# -- clusters --------------------------------------------------------------------------------------------------------

def test_moments_of_each_cluster(spark):
    features, informative, redundant, classes, clusters = 6, 3, 2, 2, 2
    keys = spark.range(8000).withColumnRenamed("id", "k")
    rows = synth.cluster_rows(keys, "k", features, informative, redundant, classes, clusters, separation=2.0,
                              label_noise=0.0, seed=4, decimals=6)
    which = F.floor(uniform(F.col("k"), "cluster", 4) * (classes * clusters)).cast("int")
    data = np.array([tuple(r) for r in rows.select(which, "label", *synth.feature_names(features)).collect()], float)
    plan = list(synth.cluster_plan(features, informative, redundant, classes, clusters, 2.0, 4))
    assert len({tuple(corner) for corner, _ in plan}) == 4
    for c, (corner, linear) in enumerate(plan):
        mine = data[data[:, 0] == c]
        assert abs(len(mine) - 2000) < 200 and (mine[:, 1] == c % classes).all()
        inner = mine[:, 2:2 + informative]
        assert np.abs(inner.mean(axis=0) - corner).max() < 0.12
        want = np.array(linear).T @ np.array(linear)
        assert np.abs(np.cov(inner.T) - want).max() < 0.15
    mixture = data[:, 2:5] @ np.array(synth.mixing_plan(informative, redundant, 4)).T
    assert np.abs(data[:, 5:7] - mixture).max() < 1e-4
    assert np.abs(data[:, 7].mean()) < 0.05 and abs(data[:, 7].std() - 1) < 0.05
    noisy = synth.cluster_rows(keys, "k", features, informative, redundant, classes, clusters, seed=4)
    flipped = noisy.withColumn("c", which % classes).filter("label <> c").count()
    assert abs(flipped / 8000 - 0.2) < 0.02  # four in ten drawn anew, half of them alike
    with pytest.raises(ValueError):
        synth.cluster_rows(keys, "k", 3, 2, 2)
