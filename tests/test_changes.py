import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from lakeops.operators import changes, expand, joins
from lakeops.operators.filters import filter_table


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


def table(spark, data, schema="k int, v int"):
    return spark.createDataFrame(data, schema)


def test_delete_keeps_null_predicate(spark):
    df = table(spark, [(1, 5), (2, None), (3, 9)])
    assert rows(changes.delete_where(df, F.col("v") > 6)) == [(1, 5), (2, None)]


def test_update_reads_the_old_row(spark):
    df = table(spark, [(1, 5), (2, None), (3, 9)])
    updated = changes.update_where(df, F.col("v") > 4, {"k": F.col("v"), "v": F.col("k")})
    assert rows(updated) == [(2, None), (5, 1), (9, 3)]
    assert updated.dtypes == df.dtypes
    with pytest.raises(ValueError):
        changes.update_where(df, F.lit(True), {"x": F.lit(1)})


def test_merge_null_and_repeated_target_keys(spark):
    target = table(spark, [(1, 10), (1, 11), (2, 20), (None, 7)])
    source = table(spark, [(1, None), (9, 90), (None, 5)])
    merged = changes.merge_upsert(target, source, ["k"])
    assert rows(merged) == rows(table(spark, [(1, None), (1, None), (2, 20), (9, 90), (None, 5), (None, 7)]))


def test_merge_two_keys_and_column_order(spark):
    target = table(spark, [(1, "a", 1), (1, "b", 2), (1, None, 3)], "k int, s string, v int")
    source = table(spark, [(8, "b", 1), (9, None, 1)], "v int, s string, k int")
    merged = changes.merge_upsert(target, source, ["k", "s"])
    assert rows(merged) == rows(table(spark, [(1, "a", 1), (1, "b", 8), (1, None, 3), (1, None, 9)],
                                      "k int, s string, v int"))


def test_merge_source_conflicts(spark):
    target = table(spark, [(1, 10)])
    for large in (False, True):
        conflict = changes.merge_upsert(target, table(spark, [(1, 1), (1, 2)]), ["k"], large)
        for act in (conflict.collect, conflict.count):
            with pytest.raises(Exception, match="several source rows"):
                act()
        # Repeated source keys that match nothing are all inserted.
        merged = changes.merge_upsert(target, table(spark, [(2, 1), (2, 2)]), ["k"], large)
        assert rows(merged) == [(1, 10), (2, 1), (2, 2)]
    with pytest.raises(ValueError):
        changes.merge_upsert(target, table(spark, [(1,)], "k int"), ["k"])


def test_merge_when_source_comes_from_target(spark):
    target = table(spark, [(1, 10), (2, 20)])
    merged = changes.merge_upsert(target, target.filter("k = 1").withColumn("v", F.lit(5)), ["k"])
    assert rows(merged) == [(1, 5), (2, 20)]


pairs = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.one_of(st.none(), st.integers(0, 3))), max_size=8)


def merge_by_hand(target, source):
    known = {k: v for k, v in source if k is not None}
    present = {k for k, _ in target}
    return ([(k, known[k]) if k in known else (k, v) for k, v in target]
            + [(k, v) for k, v in source if k is None or k not in present])


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(pairs, pairs)
def test_merge_against_plain_python(spark, target, source):
    unique = list({k: (k, v) for k, v in source}.values())
    for large in (False, True):
        merged = changes.merge_upsert(table(spark, target), table(spark, unique), ["k"], large)
        assert rows(merged) == rows(table(spark, merge_by_hand(target, unique)))


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(pairs)
def test_delete_and_kept_rows_are_the_table(spark, data):
    df = table(spark, data)
    predicate = F.col("v") > 1
    assert rows(changes.delete_where(df, predicate).unionAll(df.filter(predicate))) == rows(df)


def test_merge_forms_agree_on_repeated_target_keys(spark):
    target = table(spark, [(1, 1), (2, 2), (2, 4), (None, 3)])
    source = table(spark, [(2, None), (5, 5), (None, 9)])
    assert rows(changes.merge_upsert(target, source, ["k"])) == rows(
        changes.merge_upsert(target, source, ["k"], large_source=True)) == rows(
        table(spark, [(1, 1), (2, None), (2, None), (None, 3), (5, 5), (None, 9)]))


def test_append_is_strict_unless_it_evolves(spark):
    target = table(spark, [(1, 1)])
    wide = table(spark, [(2, 2, "M")], "k int, v int, g string")
    with pytest.raises(ValueError, match="g"):
        changes.append_rows(target, wide)
    assert rows(changes.append_rows(target, wide, evolve=True)) == [(1, 1, None), (2, 2, "M")]
    for evolve in (False, True):
        with pytest.raises(ValueError, match="types differ"):
            changes.append_rows(target, table(spark, [(1, "x")], "k int, v string"), evolve)


def test_joins_without_ambiguity(spark):
    df = table(spark, [(1, 5), (2, 6), (None, 7)])
    joined = joins.join_on_key(df, df, ["k"])
    assert joined.columns == ["k", "v", "v_right"] and rows(joined) == [(1, 5, 5), (2, 6, 6)]
    other = joins.join_on_different_keys(df, df, "k", "k")
    assert other.columns == ["k", "v", "k_right", "v_right"] and other.count() == 2


def test_expand(spark):
    df = table(spark, [(1, 5), (None, 6)])
    copies = expand.duplicate_rows(df, 3, "k")
    assert copies.count() == 6 and copies.columns == ["k", "v", "exploded", "DISTINCT_ID"]
    assert {r.DISTINCT_ID for r in copies.collect()} == {"1_0", "1_1", "1_2", None}
    assert expand.duplicate_rows(df, 0, "k").count() == 0


def test_filter_binds_its_value(spark):
    table(spark, [("a' OR '1'='1", 1), ("b", 2)], "s string, v int").createOrReplaceTempView("filter_rows")
    assert filter_table(spark, "filter_rows", "s", "=", "a' OR '1'='1").count() == 1
    with pytest.raises(ValueError):
        filter_table(spark, "filter_rows", "v", "; DROP", 1)


@pytest.mark.parametrize("large", [False, True])
def test_merge_with_columns_named_like_work_columns(spark, large):
    names = "_n int, _row int, _first int, _last int, _new_k int, k int"
    target = spark.createDataFrame([(1, 1, 1, 1, 1, 1), (2, 2, 2, 2, 2, 2)], names)
    source = spark.createDataFrame([(9, 9, 9, 9, 9, 2), (8, 8, 8, 8, 8, 3)], names)
    rows = changes.merge_upsert(target, source, ["k"], large_source=large).collect()
    assert sorted(map(tuple, rows)) == [(1, 1, 1, 1, 1, 1), (8, 8, 8, 8, 8, 3), (9, 9, 9, 9, 9, 2)]
