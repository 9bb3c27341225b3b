import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.models import boosting, metrics, prepare, synth
from lakeops.models.boosting import GRADIENT, MARGIN, STEPS, TEST, TRAIN, WATCH, BoostOptions
from lakeops.session import scratch_path

STATS = [c for c in boosting.STATS_SCHEMA.names if "time" not in c and "elapsed" not in c]


@pytest.fixture(scope="module")
def training(spark):
    keys = spark.range(900).select(F.col("id").alias("k"), F.when(F.col("id") % 3 == 0, "small").otherwise("hot").alias("g"))
    names = synth.feature_names(4)
    rows = synth.inject_missing(synth.synth_rows(keys, "k", features=4), "k", names)
    rows = rows.withColumn("categorical_feature_01", synth.draw_category(F.col("k"), F.col("label")))
    return rows.withColumn("t", prepare.in_test(F.col("k"))).cache(), names


def naive_fit(bins, label, role, options, judge=TEST):
    """(best AUC, best round, last round, margins of the best round): the same rules as plain loops over rows."""
    rows = list(zip(bins.tolist(), label.tolist(), role.tolist()))
    margins, best, best_round, best_margins, last_round = [0] * len(rows), -1.0, 0, None, -1

    def total(some, chances):
        return (sum(round((chances[i] - rows[i][1]) * GRADIENT) for i in some),
                sum(round(chances[i] * (1 - chances[i]) * GRADIENT) for i in some))

    def score(sums):
        return (sums[0] / GRADIENT) ** 2 / (sums[1] / GRADIENT + options.l2)

    def grow(train, every, depth, chances):
        """Add leaf values to the margins of ``every`` row below a node with these train rows."""
        choice = None
        for f in range(len(rows[0][0])) if depth < options.max_depth else []:
            for last in range(options.bins - 1):
                sides = [[i for i in train if (rows[i][0][f] > last) == right] for right in (False, True)]
                sums = [total(s, chances) for s in sides]
                if min(s[1] for s in sums) <= 0:
                    continue
                gain = round(score(sums[0]) + score(sums[1]), 9)
                if choice is None or gain > choice[0]:
                    choice = (gain, f, last, sides)
        if choice is None:
            g, h = total(train, chances)
            value = round(-options.rate * g / (h + options.l2 * GRADIENT) * MARGIN)
            for i in every:
                margins[i] += value
            return
        _, f, last, sides = choice
        for right in (False, True):
            grow(sides[right], [i for i in every if (rows[i][0][f] > last) == right], depth + 1, chances)

    while last_round + 1 < options.max_rounds and last_round - best_round < options.patience and best < 1:
        last_round += 1
        chances = [1 / (1 + math.exp(-m / MARGIN)) for m in margins]
        grow([i for i, r in enumerate(rows) if r[2] == TRAIN], range(len(rows)), 0, chances)
        judged = [(round(margins[i] / (MARGIN // STEPS)), r[1]) for i, r in enumerate(rows) if r[2] == judge]
        wins = [(a > b) + (a == b) / 2 for a, y in judged if y for b, z in judged if not z]
        auc = sum(wins) / len(wins)
        if auc > best:
            best, best_round, best_margins = auc, last_round, list(margins)
    return best, best_round, last_round, best_margins


@pytest.mark.parametrize("judge", [TEST, WATCH])
def test_against_plain_loops(spark, judge):
    rng = np.random.default_rng(5)
    bins = rng.integers(0, 6, size=(150, 3))
    label = ((bins[:, 0] > 2) ^ (bins[:, 1] > 1)).astype(int) ^ (rng.random(150) < 0.15)
    role = rng.choice([TRAIN, TRAIN, judge], 150)
    options = BoostOptions(max_rounds=9, patience=3, bins=6, max_depth=3)
    rows = [("g", int(y), int(r), b.tolist()) for b, y, r in zip(bins, label, role)]
    frame = spark.createDataFrame(rows, "group string, label int, role int, bins array<int>")
    for block_rows in (7, 1000):
        blocks = boosting.materialize(boosting._pack(boosting.materialize(frame), rows=block_rows))
        model = boosting._learn(blocks, ["g"], 3, options, judge)["g"]
        best, best_round, last_round, margins = naive_fit(bins, label, role, options, judge)
        assert (model.best_auc, model.best_round, len(model.trees) - 1) == (pytest.approx(best), best_round, last_round)
        found = sum(t.margins(bins.T.astype(np.uint8)) for t in model.trees[:best_round + 1])
        assert found.tolist() == margins


def test_same_model_for_any_blocks_and_partitions(training):
    rows, names = training
    options = BoostOptions(max_rounds=20, patience=18, bins=16, max_depth=2)
    cats = ["categorical_feature_01"]

    def stats(rows=rows, watch=None, **more):
        result = boosting.train_groups(rows.withColumn("w", F.col("k") % 5 == 0), "g", "label", "t", names, cats,
                                       "missing", options, watch, **more)
        assert result.schema.names == boosting.STATS_SCHEMA.names
        return {r.group: tuple(r) for r in result.select(*STATS).collect()}

    whole = stats()
    assert set(whole) == {"hot", "small"}
    assert whole == stats(block_rows=50) == stats(rows.repartition(7), block_rows=64)
    assert all(0.5 < s[STATS.index("test_auc")] <= 1 for s in whole.values())
    assert stats(watch="w") != whole


def test_groups_in_several_series_and_alone(training, monkeypatch):
    rows, names = training
    options = BoostOptions(max_rounds=4, patience=4, bins=16, max_depth=2)

    def stats(rows):
        return {r.group: tuple(r) for r in boosting.train_groups(
            rows, "g", "label", "t", names, options=options).select(*STATS).collect()}

    together = stats(rows)
    alone = {g: stats(rows.filter(F.col("g") == g))[g] for g in ("hot", "small")}
    monkeypatch.setattr(boosting, "DRIVER_SUMS", 1)
    assert together == alone == stats(rows)


def test_exclusive_or_is_learned_exactly(spark):
    rows = spark.range(800).selectExpr("id AS k", "id % 2 AS a", "id div 2 % 2 AS b", "id % 3 AS c",
                                       "CAST(id % 2 != id div 2 % 2 AS INT) AS label", "id % 7 = 0 AS t")
    models, stats = boosting.fit_groups(rows, None, "label", "t", ["a", "b", "c"], options=BoostOptions(max_depth=4))
    row = stats.first()
    assert row.best_iteration == 0 and row.test_auc == row.train_f1 == row.test_f1 == 1.0
    loaded = boosting.GroupModels.load(spark, models.save(scratch_path(spark, "xor")))
    scored = loaded.score(rows, None, ["k", "label"]).collect()
    assert len(scored) == 800 and all(r.prediction == r.label for r in scored)
    stumps = boosting.train_groups(rows.withColumn("g", F.lit(1)), "g", "label", "t", ["a", "b", "c"],
                                   options=BoostOptions(max_depth=1, max_rounds=5)).first()
    assert stumps.test_f1 < 0.8


def test_scoring_by_group_with_clashing_names_and_unseen_groups(spark, training):
    rows, names = training
    clash = rows.withColumnsRenamed({names[0]: "group", names[1]: "bins", names[2]: "values", names[3]: "role"})
    numeric, cats = ["group", "bins", "values", "role"], ["categorical_feature_01"]
    options = BoostOptions(max_rounds=5, max_depth=3, bins=16)
    models, stats = boosting.fit_groups(clash, "g", "label", "t", numeric, cats, options=options)
    more = clash.unionByName(clash.limit(2).withColumn("g", F.lit("unseen"))).unionByName(
        clash.limit(1).withColumn("g", F.lit(None).cast("string")))
    scored = models.score(more, "g", ["k", "g", "t", "label", "group"])
    assert scored.columns == ["k", "g", "t", "label", "group", "prediction", "margin"] and scored.count() == 903
    assert scored.filter("coalesce(g, 'unseen') = 'unseen'").select("prediction").distinct().collect()[0][0] is None
    found = {r.g: r.f1 for r in metrics.weighted_scores(scored.filter("t AND g IN ('hot', 'small')"), "label", "prediction",
                                                        ["g"]).collect()}
    assert found == {r.group: pytest.approx(r.test_f1, abs=1e-6) for r in stats.collect()}


def test_single_class_no_train_rows_and_constant_features(spark):
    data = [("one", 1, float(i), i % 3 == 0) for i in range(12)] + [("none", 1, 1.0, True)]
    data += [("flat", i % 2, 7.0, i % 5 == 0) for i in range(40)] + [(None, i % 2, float(i % 2), i % 3 == 0) for i in range(20)]
    df = spark.createDataFrame(data, "g string, label int, numeric_a double, t boolean")
    options = BoostOptions(max_rounds=5, patience=2)
    found = {r.group: r for r in boosting.train_groups(df, "g", "label", "t", ["numeric_a"], options=options).collect()}
    assert set(found) == {"one", "none", "flat", None}
    assert found["one"].test_auc is None and found["one"].train_precision == 1.0 and found["one"].best_iteration == 0
    assert found["none"].best_iteration is None and found["none"].start_time
    assert found["flat"].test_auc == 0.5 and found[None].test_auc == 1.0
    assert boosting.train_groups(df.limit(0), "g", "label", "t", ["numeric_a"], options=options).collect() == []


def test_outliers_and_null_labels(spark):
    rng = random.Random(8)
    data = [("g", int(i % 2), (1e9 if i == 0 else rng.gauss(3 * (i % 2), 0.5)), i % 3 == 0) for i in range(400)]
    df = spark.createDataFrame(data, "g string, label int, numeric_a double, t boolean")
    options = BoostOptions(max_rounds=5, patience=2)
    assert boosting.train_groups(df, "g", "label", "t", ["numeric_a"], options=options).first().test_auc > 0.98
    holes = df.withColumn("label", F.when(F.col("numeric_a") > 0, F.col("label")))
    with pytest.raises(Exception, match="label is NULL"):
        boosting.train_groups(holes, "g", "label", "t", ["numeric_a"], options=options).collect()


def test_siblings_are_subtracted():
    rng = np.random.default_rng(3)
    bins = rng.integers(0, 8, (4, 500)).astype(np.uint8)
    rows = boosting._Rows(bins, rng.integers(0, 2, 500).astype(np.uint8), np.zeros(500, np.uint8), np.zeros(500, np.int64))
    model = boosting.Model(BoostOptions(bins=8, max_depth=3))

    def sums(level, wanted):
        return dict(zip(wanted, boosting.level_sums(rows, rows.margin, model.growing, level, wanted, 8)))

    model.grow(0, sums(0, model.wanted(0)))
    for level in (1, 2):
        wanted = model.wanted(level)
        assert len(wanted) == 1 << (level - 1)  # one of two siblings
        model.grow(level, sums(level, wanted))
        every = sums(level, [n for n in range(1 << level, 2 << level)])
        assert set(model.sums) == set(every) and all((model.sums[n] == every[n]).all() for n in every)


def test_too_many_categories_are_an_error(spark):
    with pytest.raises(ValueError, match="more than 5"):
        prepare.fit_categories(spark.range(9).selectExpr("CAST(id AS STRING) AS c"), ["c"], most=5)


@pytest.mark.parametrize("depth", [1, 3, 6, 7, 9])
def test_trees_walked_by_columns_of_bytes(depth):
    rng = np.random.default_rng(depth)
    bins = rng.integers(0, 256, (5, 3000)).astype(np.uint8)
    tree = boosting.Tree.empty(depth)
    size = 1 << depth
    tree.feature[1:] = rng.integers(0, 5, size - 1)
    tree.last[1:] = np.where(rng.random(size - 1) < 0.8, rng.integers(0, 255, size - 1), boosting.MOST_BINS)
    tree.leaves[:] = rng.integers(-1000, 1000, size)
    for levels in range(depth + 1):
        want = []
        for row in bins.T.tolist():
            node = 1
            for _ in range(levels):
                node = 2 * node + (row[tree.feature[node]] > tree.last[node])
            want.append(node)
        assert tree.nodes(bins, levels).tolist() == [int(n) for n in want]
    assert tree.margins(bins).tolist() == tree.leaves[np.array(want) - size].tolist()


def test_a_tree_costs_no_look_up_per_row_and_level():
    bins = np.zeros((2, 100), np.uint8)

    class Column(np.ndarray):
        def __getitem__(self, at):
            assert not isinstance(at, tuple), "rows are looked up one by one"
            return np.asarray(super().__getitem__(at))

    assert boosting.Tree.empty(6).margins(bins.view(Column)).tolist() == [0] * 100


def test_bins_are_looked_up_in_workers_as_by_a_join(spark, monkeypatch):
    data = [(["a", "b", None][i % 3], i % 4 // 3, [None, float("nan"), float(i % 17), -i / 3][i % 4], "xyz"[i % 3] if i % 5 else None)
            for i in range(400)] + [("only test", TEST, 1.0, "x")]
    rows = spark.createDataFrame(data, "group string, role int, n0 double, c0 string")
    binning = boosting.Binning(["number"], ["text"], [], None, 9)
    boosting._fit_binning(binning, rows)
    found = binning(rows)
    assert "MapInArrow" in found._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(boosting, "SENT_EDGES", 0)
    joined = binning(rows)
    assert "MapInArrow" not in joined._jdf.queryExecution().executedPlan().toString()
    assert found.dtypes == joined.dtypes
    assert sorted(map(str, found.collect())) == sorted(map(str, joined.select(found.columns).collect()))
    assert binning(rows.limit(0)).collect() == []


def test_blocks_begin_with_their_train_rows(spark):
    rows = [("g", i % 2, [TEST, TRAIN, WATCH][i % 3], [i % 7, i % 5]) for i in range(50)]
    frame = boosting.materialize(spark.createDataFrame(rows, "group string, label int, role int, bins array<int>"))
    found = []
    for row in boosting._pack(frame, rows=16).collect():
        block = boosting._Rows.of(row.asDict())
        assert (np.diff(block.role.astype(int)) >= 0).all() and (block.train().role == TRAIN).all()
        assert len(block.train().role) == (block.role == TRAIN).sum() == block.train().bins.shape[1]
        found += zip(["g"] * row.rows, block.label.tolist(), block.role.tolist(), block.bins.T.tolist())
    assert sorted(found) == sorted(rows)


def test_sketches_are_merged_from_few_parts(spark):
    frame = spark.range(0, 100, 1, 64)
    assert prepare.few_parts(frame).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert prepare.few_parts(spark.range(0, 100, 1, 2)).rdd.getNumPartitions() == 2
