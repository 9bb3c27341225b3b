"""The physical plans that the operators are meant to have."""

import re

import pytest
from pyspark.sql import functions as F

from lakeops.operators import changes, expand, joins, ordering
from lakeops.plans import QUERIES
from lakeops.plans.tables import table
from lakeops.session import materialize
from lakeops.sources.files import spread_rows


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_columns_reach_the_scan(spark, tiny):
    plan = plan_of(QUERIES["filter_eq"](spark, tiny))
    assert "EqualTo(o_custkey,77)" in plan and "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan


def test_count_reads_no_columns(spark, tiny):
    assert "ReadSchema: struct<>" in plan_of(QUERIES["count_all"](spark, tiny))


@pytest.mark.parametrize("name", ["clean_group_having", "multi_agg", "agg_from_list", "count_by_key"])
def test_summaries_shuffle_partial_sums_once(spark, tiny, name):
    plan = plan_of(QUERIES[name](spark, tiny))
    assert plan.count("Exchange") == 1 and "partial_" in plan.split("Exchange")[1]
    assert "Python" not in plan


@pytest.mark.parametrize("name", ["case_flag_df", "case_flag_sql", "case_flag_expr", "strip_prefix", "money_to_double",
                                  "clean_table", "duplicate_rows", "explode_range", "delete_where", "update_where",
                                  "append_evolve", "hash_split", "impute_constant", "draw_category",
                                  "synth_group_data", "token_similarity_native", "format_timestamp"])
def test_row_by_row_operators_neither_shuffle_nor_use_python(spark, tiny, name):
    plan = plan_of(QUERIES[name](spark, tiny))
    assert "Exchange" not in plan and "Python" not in plan


def test_top_rows_keep_a_few_per_task(spark, tiny):
    assert "TakeOrderedAndProject" in plan_of(QUERIES["top_desc"](spark, tiny))


def test_similarity_runs_in_arrow_batches_on_two_columns(spark, tiny):
    plan = plan_of(QUERIES["token_similarity"](spark, tiny))
    assert "ArrowEvalPython" in plan and "BatchEvalPython" not in plan and "Exchange" not in plan


def test_small_source_merges_without_shuffling_the_target(spark, tiny):
    target = table(spark, tiny, "orders").select("o_orderkey", "o_totalprice")
    source = target.filter("o_orderkey < 10")
    plan = plan_of(changes.merge_upsert(target, source, ["o_orderkey"]))
    # The target meets the source by broadcast joins; only the keys found on both sides and the source are exchanged.
    assert plan.count("BroadcastHashJoin") >= 2 and plan.count("SortMergeJoin") == plan.count("LeftAnti") == 1
    shuffled = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert len(shuffled) <= 2


def test_large_sides_merge_without_broadcast(spark, tiny):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target = table(spark, tiny, "orders").select("o_orderkey", "o_totalprice")
        merged = changes.merge_upsert(target, target.withColumn("o_totalprice", F.lit(1.0)), ["o_orderkey"])
        assert "Broadcast" not in plan_of(merged)
        joined = joins.join_on_key(target, target, ["o_orderkey"])
        assert "SortMergeJoin" in plan_of(joined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_large_source_merges_with_one_scan_and_one_exchange_per_side(spark, tiny):
    target = table(spark, tiny, "orders").select("o_orderkey", "o_totalprice").filter("o_orderkey IS NOT NULL")
    source = table(spark, tiny, "lineitem").selectExpr("l_orderkey AS o_orderkey", "l_tax AS o_totalprice")
    merged = changes.merge_upsert(target, source, ["o_orderkey"], large_source=True)
    # The other scans are those of the rows without a key, which the files' statistics leave empty.
    plan = plan_of(merged)
    joined = plan.split("SortMergeJoin")[1].split("Union")[0]
    assert plan.count("Exchange hashpartitioning") == 2 and joined.count("FileScan") <= 4 and "Broadcast" not in plan


def test_medians_of_groups_do_not_shuffle_the_rows(spark, tiny):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = table(spark, tiny, "lineitem").select("l_returnflag", "l_quantity", F.lit(1).alias("_marker"))
        bands = materialize(rows.groupBy("l_returnflag").agg(F.max("l_quantity").alias("_bands")))
        plan = plan_of(ordering.join_measured(rows, bands, ["l_returnflag"], 64))
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_no_cartesian_product_in_any_cheap_query(spark, tiny):
    for name in ("self_join_inner", "join_diff_keys", "merge_upsert", "auc_rank", "median_by_group", "view_rank",
                 "weighted_prf", "token_similarity_turns"):
        plan = plan_of(QUERIES[name](spark, tiny))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name


def test_copies_are_made_before_the_only_shuffle(spark, tiny):
    copies = expand.duplicate_rows(table(spark, tiny, "supplier"), 1000, "s_suppkey")
    assert plan_of(spread_rows(copies, 50)).count("Exchange") == 1


@pytest.mark.parametrize("name", ["clean_group_having", "view_rank", "merge_upsert", "auc_rank", "weighted_prf"])
@pytest.mark.parametrize("parts", [1, 16])
def test_results_do_not_depend_on_partition_counts(spark, tiny, name, parts):
    expected = sorted(map(str, QUERIES[name](spark, tiny).collect()))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        assert sorted(map(str, QUERIES[name](spark, tiny).collect())) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
