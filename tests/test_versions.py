import pytest
from pyspark.sql import functions as F

from lakeops.operators.versions import VersionedTable
from lakeops.session import delete_folder, scratch_database


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def table(spark):
    base = spark.createDataFrame([(1, 30), (2, 40), (3, None)], "k int, v int")
    return VersionedTable.create(spark, f"{scratch_database(spark, 'test')}.t", base)


def test_story(spark, table):
    assert table.delete(F.col("k") == 1) == 1
    assert table.update(F.col("k") == 2, {"v": F.lit(100)}) == 2
    assert table.merge(spark.createDataFrame([(3, 7), (9, None)], "k int, v int"), ["k"]) == 3
    wide = spark.createDataFrame([(8, 70, "M")], "k int, v int, g string")
    with pytest.raises(ValueError):
        table.append(wide)
    assert table.append(wide, evolve=True) == 4
    assert rows(table.read(0)) == rows(spark.createDataFrame([(1, 30), (2, 40), (3, None)], "k int, v int"))
    assert rows(table.read(1)) == [(2, 40), (3, None)]
    assert rows(table.read(2)) == [(2, 100), (3, None)]
    assert rows(table.read(3)) == [(2, 100), (3, 7), (9, None)]
    assert table.read(3).columns == ["k", "v"]
    assert rows(table.read()) == [(2, 100, None), (3, 7, None), (8, 70, "M"), (9, None, None)]
    history = table.history().collect()
    assert [(h.version, h.operation, h.rows) for h in history] == [
        (4, "append", 1), (3, "merge", 3), (2, "update", 2), (1, "delete", 2), (0, "create", 3)]
    assert all(h.files > 0 and h.bytes > 0 and h.committed_at for h in history)
    # Rows that evolve need not have a column that only later versions got.
    assert table.append(spark.createDataFrame([(10, 1)], "k int, v int"), evolve=True) == 5
    assert table.read().filter("k = 10").first() == (10, 1, None)


def test_appends_write_only_their_rows_then_compact_and_retain(spark, table):
    for n in range(4):
        table.append(spark.createDataFrame([(100 + n, n)], "k int, v int"))
    before = rows(table.read())
    assert [h.rows for h in table.history().collect()][:4] == [1, 1, 1, 1]
    assert table.compact() == 5
    assert table.compact() is None
    assert rows(table.read()) == before and rows(table.read(4)) == before
    assert table.history().first().files == 1
    assert table.retain(2) == []          # version 4 still needs the first and all appended parts
    assert table.retain(1) == [0, 1, 2, 3, 4]
    assert rows(table.read()) == before
    with pytest.raises(ValueError, match="dropped"):
        table.read(4)
    assert len(table.history().collect()) == 6


def test_scan_is_pruned_to_the_version(spark, table):
    table.update(F.col("k") == 2, {"v": F.lit(1)})
    plan = table.read(1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(version" in plan
    assert len(table.read(1).inputFiles()) <= 3 and all("version=1" in f for f in table.read(1).inputFiles())


def test_unknown_version_and_reserved_name(spark, table):
    with pytest.raises(ValueError):
        table.read(7)
    with pytest.raises(ValueError):
        VersionedTable.create(spark, "x", spark.createDataFrame([(1,)], "version int"))


def test_failed_commit_is_invisible_and_can_be_cleared(spark, table):
    before = rows(table.read())
    folder = f"{table.location}/version=1"
    spark.createDataFrame([(5, 5)], "k int, v int").write.parquet(folder)
    assert rows(table.read()) == before
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        table.delete(F.col("k") == 1)
    delete_folder(spark, folder)
    assert table.delete(F.col("k") == 1) == 1 and table.read().count() == 2


def test_partition_without_history_is_invisible(spark, table):
    folder = f"{table.location}/version=1"
    spark.createDataFrame([(5, 5)], "k int, v int").write.parquet(folder)
    spark.sql(f"ALTER TABLE {table.name} ADD PARTITION (version=1)")
    assert table.read().count() == 3


def test_rewrite_and_append_check_stored_types(spark, table):
    assert table.rewrite(table.read().withColumn("w", F.lit("x")), "widen") == 1
    assert table.read().columns == ["k", "v", "w"] and table.read(0).columns == ["k", "v"]
    table.rewrite(table.read().drop("w"), "narrow")
    before = rows(table.read())
    with pytest.raises(ValueError, match="types differ"):
        table.rewrite(table.read().withColumn("v", F.col("v").cast("string")), "retype")
    # The newest version lacks w, but an older one stored it as text.
    with pytest.raises(ValueError, match="w: string and int"):
        table.append(spark.createDataFrame([(9, 9, 9)], "k int, v int, w int"), evolve=True)
    with pytest.raises(ValueError, match="version"):
        table.rewrite(table.read().withColumn("version", F.lit(1)), "reserved")
    assert rows(table.read()) == before and table.latest() == 2


def test_empty_table(spark):
    empty = VersionedTable.create(spark, f"{scratch_database(spark, 'test')}.e", spark.createDataFrame([], "k int"))
    assert empty.read().count() == 0
    empty.append(spark.createDataFrame([(1,)], "k int"))
    assert rows(empty.read()) == [(1,)]
    empty.delete(F.lit(True))
    assert empty.read().count() == 0


def test_changes_rewrite_only_the_parts_they_touch(spark, table):
    for n in (10, 20, 30):
        table.append(spark.createDataFrame([(n, n), (n + 1, n)], "k int, v int"))
    assert table.history().first().parts == [0, 1, 2, 3]
    table.update(F.col("k") == 20, {"v": F.lit(7)})
    assert (table.history().first().parts, table.history().first().rows) == ([0, 1, 3, 4], 2)
    table.delete(F.col("k") == 999)
    assert (table.history().first().parts, table.history().first().rows) == ([0, 1, 3, 4], 0)
    table.merge(spark.createDataFrame([(11, None), (31, 5), (50, 1)], "k int, v int"), ["k"])
    assert (table.history().first().parts, table.history().first().rows) == ([0, 4, 6], 5)
    table.merge(spark.createDataFrame([(60, 1)], "k int, v int"), ["k"])
    assert (table.history().first().parts, table.history().first().rows) == ([0, 4, 6, 7], 1)
    assert rows(table.read()) == sorted(
        [(1, 30), (2, 40), (3, None), (10, 10), (11, None), (20, 7), (21, 20), (30, 30), (31, 5), (50, 1), (60, 1)], key=str)
    assert rows(table.read(3)) == sorted(
        [(1, 30), (2, 40), (3, None), (10, 10), (11, 10), (20, 20), (21, 20), (30, 30), (31, 30)], key=str)
    assert table.retain(1) == [1, 2, 3] and table.read().count() == 11


@pytest.fixture
def bucketed(spark):
    base = spark.range(4000).selectExpr("id AS k", "CAST(id % 7 AS INT) AS v")
    return VersionedTable.create(spark, f"{scratch_database(spark, 'test')}.b", base, bucket_by=["k"], buckets=16)


def test_one_changed_key_rewrites_one_bucket(spark, bucketed):
    created = bucketed.history().first()
    assert len(created.parts) == 16 and created.rows == 4000
    bucketed.merge(spark.createDataFrame([(17, -1)], "k int, v int"), ["k"])  # another type of the same key
    merged = bucketed.history().first()
    assert len(set(merged.parts) & set(created.parts)) == 15 and len(merged.parts) == 16
    assert merged.rows < 400 and merged.bytes < created.bytes / 8
    assert bucketed.read().filter("k = 17").first().v == -1 and bucketed.read().count() == 4000
    assert bucketed.read(0).filter("k = 17").first().v == 3
    bucketed.delete(F.col("k").isin(17, 18))
    assert bucketed.history().first().rows < 800 and bucketed.read().count() == 3998
    bucketed.update(F.col("k") == 99, {"v": F.lit(5)})
    assert bucketed.history().first().rows < 400 and bucketed.read().filter("k = 99").first().v == 5


def test_merge_reads_only_the_buckets_of_its_source(spark, bucketed):
    source = spark.createDataFrame([(5, 1), (None, 2)], "k long, v int")
    parts = bucketed._parts_of_keys(source, ["k"])
    assert 1 <= len(parts) <= 2
    files = bucketed._parts(parts).inputFiles()
    assert 0 < len(files) < len(bucketed.read().inputFiles()) / 4
    assert bucketed._parts_of_keys(source, ["v"]) is None
    bucketed.merge(source, ["k"])
    assert rows(bucketed.read().filter("k = 5 OR k IS NULL")) == [(5, 1), (None, 2)]


def test_buckets_with_appends_evolution_compaction_and_retention(spark, bucketed):
    bucketed.append(spark.createDataFrame([(9001, 1), (9002, 2), (None, 3)], "k long, v int"))
    bucketed.append(spark.createDataFrame([(9003, 1, "x")], "k long, v int, w string"), evolve=True)
    before = rows(bucketed.read())
    assert len(before) == 4004 and bucketed.read(1).columns == ["k", "v"]
    assert bucketed.compact(min_files=1) == 3 and len(bucketed.history().first().parts) == 16
    assert rows(bucketed.read()) == before
    dropped = bucketed.retain(1)
    assert dropped and rows(bucketed.read()) == before
    with pytest.raises(ValueError, match="dropped"):
        bucketed.read(1)
    with pytest.raises(ValueError, match="by \\['k'\\]"):
        bucketed.rewrite(bucketed.read().drop("k"), "narrow")
    with pytest.raises(ValueError, match="bucket"):
        VersionedTable.create(spark, "x", spark.range(1).withColumnRenamed("id", "bucket"), bucket_by=["bucket"], buckets=2)
    again = VersionedTable(spark, bucketed.name)
    assert again.bucketing == (["k"], 16)
    again.delete(F.lit(True))
    assert again.read().count() == 0
    again.append(spark.createDataFrame([(1, 1, "y")], "k long, v int, w string"))
    assert rows(again.read()) == [(1, 1, "y")]


@pytest.mark.parametrize("buckets", [0, 3])
def test_fifty_inserts_leave_few_parts(spark, buckets):
    some = spark.range(40).selectExpr("id AS k")
    table = VersionedTable.create(spark, f"{scratch_database(spark, 'test')}.i", some,
                                  bucket_by=["k"] if buckets else [], buckets=buckets)
    for _ in range(21):
        table.append(some, tiers=3)
    parts = table.history().first().parts
    assert table.read().count() == 22 * 40 and len({table._version_of(p) for p in parts}) <= 2 * 3
    merges = table.history().filter("operation = 'merge parts'").collect()
    assert 8 <= len(merges) <= 11 and max(m.rows for m in merges) == 9 * 40
    written = sum(r.rows for r in table.history().collect())
    assert written <= 22 * 40 * 4  # each row about log3(22) + 1 times


def test_two_writers_of_one_version(spark, table):
    other = VersionedTable(spark, table.name)
    assert other.latest() == 0 and other._base().version == 0
    table.append(spark.createDataFrame([(4, 4)], "k int, v int"))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        other.append(spark.createDataFrame([(5, 5)], "k int, v int"))
    assert rows(VersionedTable(spark, table.name).read()) == rows(other.read()) and other.read().count() == 4


def test_retention_by_hours(spark, table):
    for n in range(3):
        table.update(F.col("k") == 1, {"v": F.lit(n)})
    assert table.retain(hours=1) == []
    # As if versions 1, 2 and 3 had come three, two and one hour later than version 0, four hours ago.
    hours_ago = F.expr("current_timestamp() - make_interval(0, 0, 0, 0, 4 - version)")
    aged = spark.createDataFrame(table.history().collect(), table.history().schema).withColumn("committed_at", hours_ago)
    aged.write.mode("overwrite").format("parquet").saveAsTable(table.history_name)
    table = VersionedTable(spark, table.name)
    assert table.retain(hours=2.5) == [0]      # version 0 was replaced three hours ago, version 1 two hours ago
    assert table.read(1).count() == 3
    assert table.retain(hours=0) == [1, 2] and table.read().count() == 3
