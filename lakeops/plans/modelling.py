"""Queries over feature preparation, metrics and models."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from lakeops.models import boosting, metrics, prepare, scoring, synth
from lakeops.plans.tables import ACCOUNTS_SQL, accounts, table
from lakeops.session import materialize, scratch_path
from lakeops.sources.files import spread_rows

FEATURES = synth.feature_names()


def hash_split(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", prepare.in_test(F.col("o_orderkey")).alias("in_test"))


def impute_median(spark, folder):
    """Balances filled with the median of the train customers."""
    rows = accounts(spark, folder).select("c_custkey", "c_acctbal")
    medians = prepare.fit_medians(rows.filter(~prepare.in_test(F.col("c_custkey"))), ["c_acctbal"])
    return prepare.impute_medians(rows, medians)


def impute_median_int(spark, folder):
    """Whole numbers with holes: halves and ones twos, whose median is 1.5, beside one that doubles cannot hold, and dates."""
    part = table(spark, folder, "part").select("p_partkey", F.explode(F.array(F.lit(1), F.lit(2))).alias("copy"))
    rows = part.select("p_partkey", "copy", F.when(F.col("p_partkey") % 7 != 0, F.col("copy")).alias("filled"),
                       F.when(F.col("p_partkey") % 5 != 0, 2 * F.col("p_partkey") + 9007199254740993).alias("large"),
                       F.when(F.col("p_partkey") % 3 != 0, F.timestamp_add("DAY", F.col("p_partkey").cast("int"), F.lit(
                           "2020-01-01").cast("timestamp_ntz"))).alias("day"))
    return prepare.impute_medians(rows, prepare.fit_medians(rows, ["filled", "large", "day"]))


def median_by_group(spark, folder):
    return prepare.exact_medians(table(spark, folder, "lineitem"), ["l_quantity", "l_extendedprice"], ["l_returnflag"])


def impute_constant(spark, folder):
    return accounts(spark, folder).select(
        "c_custkey", prepare.impute_constant(F.col("c_mktsegment")).alias("c_mktsegment"))


def one_hot(spark, folder):
    """Categories known from the customers outside one segment; that segment gives zeros."""
    rows = accounts(spark, folder).select(
        "c_custkey", prepare.impute_constant(F.col("c_mktsegment")).alias("c_mktsegment"))
    known = prepare.fit_categories(rows.filter(F.col("c_mktsegment") != "BUILDING"), ["c_mktsegment"])
    return prepare.one_hot(rows, known, ["c_custkey"])


def scale_column(spark, folder):
    """A saved and loaded stage that doubles a column."""
    from pyspark.ml import PipelineModel
    path = scoring.save_model(PipelineModel([scoring.scale_stage("c_acctbal", 2.0, "doubled")]),
                              scratch_path(spark, "scale_model"))
    return scoring.load_model(path).transform(accounts(spark, folder).select("c_custkey", "c_acctbal"))


def _scored_documents(spark, folder):
    """Labelled documents with the text length as score and as prediction."""
    labels = table(spark, folder, "labels")
    documents = table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    return labels.join(documents, "doc_id").select(
        "lang", "quality", (F.col("n_chars") > 1000).cast("int").alias("predicted"), "n_chars")


def weighted_prf(spark, folder):
    return metrics.weighted_scores(_scored_documents(spark, folder), "quality", "predicted", ["lang"])


def auc_rank(spark, folder):
    return metrics.area_under_curve(_scored_documents(spark, folder), "quality", "n_chars", ["lang"], digits=6)


def metrics_long(spark, folder):
    scores = metrics.weighted_scores(_scored_documents(spark, folder), "quality", "predicted", ["lang"])
    return metrics.as_runs(scores, F.col("lang"), ["precision", "recall", "f1"])


def synth_group_data(spark, folder):
    keys = table(spark, folder, "customer").select("c_custkey", F.col("c_mktsegment").alias("group_name"))
    rows = synth.synth_rows(keys, "c_custkey", batches=False)
    return rows.withColumns({c: F.col(c).cast("double") for c in FEATURES})


def inject_missing(spark, folder):
    rows = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.round(F.sum("l_quantity"), 2).alias("quantity"), F.round(F.sum("l_extendedprice"), 2).alias("price"))
    return synth.inject_missing(rows, "l_orderkey", ["quantity", "price"])


def draw_category(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("label"))
    return orders.withColumn("categorical_feature_01", synth.draw_category(F.col("o_orderkey"), F.col("label")))


def inject_missing_exact(spark, folder):
    """Exactly a tenth of the cells of each priority's orders are blanked."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice", "o_custkey", "o_orderstatus")
    return synth.inject_missing_exact(orders, "o_orderkey", BLANKED, by=["o_orderpriority"])


def exact_split(spark, folder):
    """A test share of exactly a third of the customers of each segment, one segment being NULL."""
    return prepare.exact_split(accounts(spark, folder).select("c_custkey", "c_mktsegment"), "c_custkey", by=["c_mktsegment"])


def cluster_data(spark, folder):
    """Gaussian clusters for every customer."""
    return synth.cluster_rows(table(spark, folder, "customer").select("c_custkey"), "c_custkey", **CLUSTERS)


BLANKED = ["o_totalprice", "o_custkey", "o_orderstatus"]
CLUSTERS = {"features": 7, "informative": 3, "redundant": 2, "classes": 2, "clusters": 3, "seed": 0}


def _training_rows(spark, folder):
    """Synthetic features with holes for every order, grouped by priority."""
    keys = table(spark, folder, "orders").select("o_orderkey", F.col("o_orderpriority").alias("group_name"))
    # Drawing is heavy on the processor and the keys are narrow, so they are spread before it.
    keys = spread_rows(keys, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = synth.synth_rows(keys, "o_orderkey")
    rows = synth.inject_missing(rows, "o_orderkey", FEATURES)
    return rows.select("o_orderkey", "group_name", "label",
                       synth.draw_category(F.col("o_orderkey"), F.col("label")).alias("categorical_feature_01"),
                       *[F.col(c).cast("double").alias(c) for c in FEATURES],
                       prepare.in_test(F.col("o_orderkey")).alias("in_test"))


def _stored_training_rows(spark, folder):
    """The same, written once, because fitting reads its input many times."""
    return materialize(_training_rows(spark, folder))


def _exact_rows(spark, folder):
    """The training rows with a label that follows from one feature of few values, which scoring must find again."""
    share = F.col("o_orderkey") % 5
    rows = _training_rows(spark, folder).withColumns({
        "numeric_feature_00": share.cast("double"), "label": (share >= 3).cast("int")})
    return materialize(rows)


def group_train_exact(spark, folder):
    """Full rounds per group on that label: exact scores on both sides from the first round on."""
    rows = _exact_rows(spark, folder)
    stats = boosting.train_groups(rows, "group_name", "label", "in_test", prepare.columns_with(rows, "numeric"),
                                  prepare.columns_with(rows, "categorical"))
    return stats.select("group", "best_iteration", *[
        F.col(c).cast("double").alias(c) for c in stats.columns if c.startswith(("train_", "test_"))])


def _crossed_rows(spark, folder):
    """Orders with a label that is the exclusive or of two features, which no single split tells anything about."""
    key = F.col("o_orderkey")
    one, two = key % 2, F.floor(key / 2) % 2
    return table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("group_name"), one.cast("double").alias("numeric_feature_00"),
        two.cast("double").alias("numeric_feature_01"), (one != two).cast("int").alias("label"),
        F.element_at(F.array(*[F.lit(c) for c in synth.CATEGORIES]), (key % 3 + 1).cast("int")).alias("categorical_feature_01"),
        prepare.in_test(key).alias("in_test"))


CROSSED = boosting.BoostOptions(max_depth=4)


def group_train_crossed(spark, folder):
    """Trees of some depth per group on that label: exact from the first round on."""
    rows = _crossed_rows(spark, folder)
    stats = boosting.train_groups(rows, "group_name", "label", "in_test", prepare.columns_with(rows, "numeric"),
                                  prepare.columns_with(rows, "categorical"), options=CROSSED)
    return stats.select("group", "best_iteration", *[
        F.col(c).cast("double").alias(c) for c in stats.columns if c.startswith(("train_", "test_"))])


def table_score_crossed(spark, folder):
    """One model of the whole table, stopped by its AUC, saved, loaded and applied to every order."""
    rows = _crossed_rows(spark, folder)
    models, _ = boosting.fit_groups(rows, None, "label", "in_test", prepare.columns_with(rows, "numeric"),
                                    prepare.columns_with(rows, "categorical"), options=CROSSED)
    loaded = boosting.GroupModels.load(spark, models.save(scratch_path(spark, "model")))
    return loaded.score(rows, None, ["o_orderkey"]).select("o_orderkey", "prediction")


def gbt_train_exact(spark, folder):
    rows = _exact_rows(spark, folder)
    predicted = _fitted(rows).transform(rows).withColumn("predicted", F.col("prediction").cast("int"))
    return metrics.weighted_scores(predicted, "label", "predicted", ["in_test"])


def batch_score_exact(spark, folder):
    """Fit, save, load, check the columns and score every order: the loaded model gives the label."""
    rows = _exact_rows(spark, folder)
    path = scoring.save_model(_fitted(rows), scratch_path(spark, "model"))
    contract = StructType([StructField("categorical_feature_01", StringType()),
                           *[StructField(c, DoubleType()) for c in FEATURES]])
    return scoring.score(scoring.load_model(path), rows, ["o_orderkey"], contract)


def group_train(spark, folder):
    rows = _training_rows(spark, folder)
    return boosting.train_groups(rows, "group_name", "label", "in_test", prepare.columns_with(rows, "numeric"),
                                 prepare.columns_with(rows, "categorical"))


def _fitted(rows):
    return scoring.fit_gbt(rows, "label", "in_test", prepare.columns_with(rows, "numeric"),
                           prepare.columns_with(rows, "categorical"))


def gbt_train(spark, folder):
    """Scores on train and test rows of one model over all orders."""
    rows = _stored_training_rows(spark, folder)
    predicted = _fitted(rows).transform(rows).withColumn("predicted", F.col("prediction").cast("int"))
    return metrics.weighted_scores(predicted, "label", "predicted", ["in_test"])


def batch_score(spark, folder):
    """Fit, save, load, check the columns and score every order."""
    rows = _stored_training_rows(spark, folder)
    path = scoring.save_model(_fitted(rows), scratch_path(spark, "model"))
    contract = StructType([StructField("categorical_feature_01", StringType()),
                           *[StructField(c, DoubleType()) for c in FEATURES]])
    return scoring.score(scoring.load_model(path), rows, ["o_orderkey"], contract)


QUERIES = {f.__name__: f for f in (
    hash_split, impute_median, impute_median_int, median_by_group, impute_constant, one_hot, scale_column, weighted_prf, auc_rank,
    metrics_long, synth_group_data, inject_missing, draw_category, group_train, gbt_train, batch_score,
    inject_missing_exact, exact_split, cluster_data, group_train_exact, group_train_crossed, table_score_crossed, gbt_train_exact, batch_score_exact)}


def _bits_sql(key: str, name: str, seed: int = 0) -> str:
    return f"CAST('0x' || substr(md5({key} || '|{name}|{seed}'), 1, 15) AS BIGINT)"


def _uniform_sql(key: str, name: str) -> str:
    return f"({_bits_sql(key, name)}::DOUBLE / 1152921504606846976.0::DOUBLE)"


def _feature_sql(name: str, number: int) -> str:
    drawn = _bits_sql("c_custkey", name)
    total = " + ".join(f"(({drawn} >> {15 * part}) & 32767)" for part in range(4))
    side = 0.5 if number % 2 == 0 else -0.5
    return (f"CAST(round((({total}) / 32768.0::DOUBLE - 2.0::DOUBLE) * sqrt(3.0::DOUBLE)"
            f" + CASE WHEN class = 1 THEN {side} ELSE {-side} END::DOUBLE, 4) AS FLOAT)::DOUBLE AS {name}")


def _normal_sql(key: str, name: str) -> str:
    drawn = _bits_sql(key, name)
    total = " + ".join(f"(({drawn} >> {15 * part}) & 32767)" for part in range(4))
    return f"((({total}) / 32768.0::DOUBLE - 2.0::DOUBLE) * sqrt(3.0::DOUBLE))"


def _cluster_sql() -> str:
    """The cluster data from the same plan of corners, maps and mixtures."""
    size, more = CLUSTERS["informative"], CLUSTERS["redundant"]
    plan = list(synth.cluster_plan(CLUSTERS["features"], size, more, CLUSTERS["classes"], CLUSTERS["clusters"], 1.0, 0))
    names = synth.feature_names(CLUSTERS["features"])

    def pick(values) -> str:
        return f"[{', '.join(f'{v!r}::DOUBLE' for v in values)}][cluster + 1]"

    placed = []
    for j in range(size):
        terms = [pick([corner[j] for corner, _ in plan])] + [f"z{i} * {pick([a[i][j] for _, a in plan])}" for i in range(size)]
        placed.append(f"{' + '.join(terms)} AS x{j}")
    values = [f"x{j}" for j in range(size)]
    values += [" + ".join(["0.0::DOUBLE", *[f"x{j} * {w!r}::DOUBLE" for j, w in enumerate(weights)]])
               for weights in synth.mixing_plan(size, more, 0)]
    values += [_normal_sql("c_custkey", n) for n in names[size + more:]]
    return f"""
        SELECT c_custkey, CAST(CASE WHEN {_uniform_sql('c_custkey', 'noise')} < 0.4
                   THEN floor({_uniform_sql('c_custkey', 'coin')} * {CLUSTERS['classes']})
                   ELSE cluster % {CLUSTERS['classes']} END AS INTEGER) AS label,
               {', '.join(f'round({v}, 4) AS {n}' for v, n in zip(values, names))}
        FROM (SELECT *, {', '.join(placed)} FROM (
            SELECT c_custkey, CAST(floor({_uniform_sql('c_custkey', 'cluster')} * {len(plan)}) AS INTEGER) AS cluster,
                   {', '.join(f"{_normal_sql('c_custkey', f'normal {j}')} AS z{j}" for j in range(size))}
            FROM customer))"""


_TEST_SQL = "CAST('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 33"
_SCORED_SQL = """
    SELECT lang, quality, CAST(n_chars > 1000 AS INTEGER) AS predicted, n_chars
    FROM labels JOIN documents USING (doc_id)"""
_PRF_SQL = f"""
    SELECT lang, round(sum(support * CASE WHEN called > 0 THEN hits / called ELSE 0 END) / sum(support), 3) AS precision,
           round(sum(support * CASE WHEN support > 0 THEN hits / support ELSE 0 END) / sum(support), 3) AS recall,
           round(sum(support * CASE WHEN hits > 0 THEN 2 * hits / (called + support) ELSE 0 END) / sum(support), 3) AS f1
    FROM (SELECT lang, class, count(*) FILTER (quality = class) AS support,
                 count(*) FILTER (predicted = class) AS called,
                 count(*) FILTER (quality = class AND predicted = class) AS hits
          FROM ({_SCORED_SQL}), (SELECT unnest([0, 1]) AS class) GROUP BY lang, class)
    GROUP BY lang"""

ORACLES = {
    "inject_missing_exact": f"""
        WITH cells AS (
            SELECT o_orderkey, o_orderpriority, name, {_bits_sql('o_orderkey', "' || name || '")} AS draw
            FROM orders, (SELECT unnest([{', '.join(f"'blank {c}'" for c in BLANKED)}]) AS name)),
        gone AS (
            SELECT o_orderkey, name FROM cells
            QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY draw, o_orderkey::VARCHAR, name)
                    <= floor(0.1 * count(*) OVER (PARTITION BY o_orderpriority)))
        SELECT o_orderkey, o_orderpriority, {', '.join(
            f"CASE WHEN (o_orderkey, 'blank {c}') NOT IN (SELECT (o_orderkey, name) FROM gone) THEN {c} END AS {c}" for c in BLANKED)}
        FROM orders""",
    "exact_split": f"""
        SELECT c_custkey, c_mktsegment, row_number() OVER (
                   PARTITION BY c_mktsegment ORDER BY {_bits_sql('c_custkey', 'split')}, c_custkey::VARCHAR)
               <= ceil(0.33 * count(*) OVER (PARTITION BY c_mktsegment)) AS in_test
        FROM ({ACCOUNTS_SQL})""",
    "cluster_data": _cluster_sql(),
    "hash_split": f"SELECT o_orderkey, {_TEST_SQL.format(key='o_orderkey')} AS in_test FROM orders",
    "impute_median": f"""
        SELECT c_custkey, coalesce(c_acctbal, (SELECT median(c_acctbal) FROM ({ACCOUNTS_SQL})
                                               WHERE NOT {_TEST_SQL.format(key='c_custkey')})) AS c_acctbal
        FROM ({ACCOUNTS_SQL})""",
    "group_train_exact": """
        SELECT DISTINCT o_orderpriority AS "group", 0 AS best_iteration, 1.0::DOUBLE AS train_precision,
               1.0::DOUBLE AS train_recall, 1.0::DOUBLE AS train_f1, 1.0::DOUBLE AS test_precision,
               1.0::DOUBLE AS test_recall, 1.0::DOUBLE AS test_f1, 1.0::DOUBLE AS test_auc
        FROM orders""",
    "group_train_crossed": """
        SELECT DISTINCT o_orderpriority AS "group", 0 AS best_iteration, 1.0::DOUBLE AS train_precision,
               1.0::DOUBLE AS train_recall, 1.0::DOUBLE AS train_f1, 1.0::DOUBLE AS test_precision,
               1.0::DOUBLE AS test_recall, 1.0::DOUBLE AS test_f1, 1.0::DOUBLE AS test_auc
        FROM orders""",
    "table_score_crossed": "SELECT o_orderkey, CAST(o_orderkey % 2 <> o_orderkey // 2 % 2 AS INTEGER) AS prediction FROM orders",
    "gbt_train_exact": f"""
        SELECT DISTINCT {_TEST_SQL.format(key='o_orderkey')} AS in_test, 1.0::DOUBLE AS precision,
               1.0::DOUBLE AS recall, 1.0::DOUBLE AS f1
        FROM orders""",
    "batch_score_exact": "SELECT o_orderkey, CAST(o_orderkey % 5 >= 3 AS INTEGER) AS prediction FROM orders",
    "impute_median_int": """
        WITH rows AS (
            SELECT p_partkey, copy, CASE WHEN p_partkey % 7 <> 0 THEN copy::DOUBLE ELSE 1.5::DOUBLE END AS filled,
                   CASE WHEN p_partkey % 5 <> 0 THEN 2 * p_partkey + 9007199254740993 END AS large,
                   CASE WHEN p_partkey % 3 <> 0 THEN TIMESTAMP '2020-01-01' + to_days(CAST(p_partkey AS INTEGER)) END AS day
            FROM part, (SELECT unnest([1, 2]) AS copy)),
        large AS (SELECT large, row_number() OVER (ORDER BY large) AS i, count(*) OVER () AS n FROM rows WHERE large IS NOT NULL),
        days AS (SELECT day, row_number() OVER (ORDER BY day) AS i, count(*) OVER () AS n FROM rows WHERE day IS NOT NULL)
        SELECT p_partkey, copy, filled, coalesce(large, (
                   SELECT CAST(sum(large) // 2 AS BIGINT) FROM (SELECT large FROM large WHERE i = (n + 1) // 2
                   UNION ALL SELECT large FROM large WHERE i = (n + 2) // 2))) AS large,
               coalesce(day, (SELECT day FROM days WHERE i = (n + 1) // 2)) AS day
        FROM rows""",
    "median_by_group": """
        SELECT l_returnflag, median(l_quantity) AS l_quantity, median(l_extendedprice) AS l_extendedprice
        FROM lineitem GROUP BY l_returnflag""",
    "impute_constant": f"""
        SELECT c_custkey, coalesce(c_mktsegment, 'missing') AS c_mktsegment FROM ({ACCOUNTS_SQL})""",
    "one_hot": "SELECT " + ", ".join(
        f"CAST(coalesce(c_mktsegment, 'missing') = '{v}' AS INTEGER) AS \"c_mktsegment_{v}\""
        for v in ("AUTOMOBILE", "FURNITURE", "HOUSEHOLD", "MACHINERY", "missing")) + f", c_custkey FROM ({ACCOUNTS_SQL})",
    "scale_column": f"SELECT c_custkey, c_acctbal, c_acctbal * 2.0::DOUBLE AS doubled FROM ({ACCOUNTS_SQL})",
    "weighted_prf": _PRF_SQL,
    "auc_rank": f"""
        WITH scored AS ({_SCORED_SQL}),
        counts AS (SELECT lang, n_chars, count(*) FILTER (quality = 1) AS pos, count(*) FILTER (quality <> 1) AS neg
                   FROM scored GROUP BY lang, n_chars),
        below AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY lang ORDER BY n_chars
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS less FROM counts)
        SELECT lang, round(sum(pos * (less + neg / 2))::DOUBLE / nullif(sum(pos) * sum(neg), 0), 6) AS auc
        FROM below GROUP BY lang""",
    "metrics_long": " UNION ALL ".join(
        f"SELECT lang AS run, '{m}' AS metric, {m} AS value FROM ({_PRF_SQL})" for m in ("precision", "recall", "f1")),
    "synth_group_data": f"""
        SELECT c_custkey, c_mktsegment AS group_name,
               CAST(CASE WHEN {_uniform_sql('c_custkey', 'noise')} < 0.4
                         THEN CASE WHEN {_uniform_sql('c_custkey', 'coin')} < 0.5 THEN 0 ELSE 1 END
                         ELSE class END AS INTEGER) AS label,
               {', '.join(_feature_sql(name, i) for i, name in enumerate(FEATURES))}
        FROM (SELECT *, CASE WHEN {_uniform_sql('c_custkey', 'class')} < 0.5 THEN 0 ELSE 1 END AS class FROM customer)""",
    "inject_missing": f"""
        SELECT l_orderkey, CASE WHEN {_uniform_sql('l_orderkey', 'blank quantity')} >= 0.1 THEN quantity END AS quantity,
               CASE WHEN {_uniform_sql('l_orderkey', 'blank price')} >= 0.1 THEN price END AS price
        FROM (SELECT l_orderkey, round(sum(l_quantity), 2) AS quantity, round(sum(l_extendedprice), 2) AS price
              FROM lineitem GROUP BY l_orderkey)""",
    "draw_category": f"""
        SELECT o_orderkey, label, CASE WHEN draw < CASE WHEN label = 1 THEN 0.7 ELSE 0.3 END THEN 'A'
                                       WHEN draw < CASE WHEN label = 1 THEN 0.9 ELSE 0.8 END THEN 'B'
                                       ELSE 'C' END AS categorical_feature_01
        FROM (SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS label,
                     {_uniform_sql('o_orderkey', 'category')} AS draw FROM orders)""",
}
