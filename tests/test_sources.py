import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType

from lakeops import claims
from lakeops.plans import reading
from lakeops.session import LOCAL, discard, materialize, scratch_database, scratch_dir, scratch_path
from lakeops.sources import csv, files, tables


def test_schema_builder():
    schema = csv.build_schema(["b", "a"], {IntegerType(): ["a"], StringType(): ["b"]})
    assert schema.simpleString() == "struct<b:string,a:int>" and all(f.nullable for f in schema)
    for order, types in ((["a", "x"], {IntegerType(): ["a"]}), (["a"], {IntegerType(): ["a", "x"]}),
                         (["a"], {IntegerType(): ["a"], StringType(): ["a"]})):
        with pytest.raises(ValueError):
            csv.build_schema(order, types)


def test_csv_inferred_and_declared(spark):
    path = scratch_path(spark, "csv")
    spark.createDataFrame([(1, "x", 1.5), (2, None, None)], "k int, s string, d double").write.option(
        "header", True).csv(path)
    assert csv.read_csv(spark, path).dtypes == [("k", "int"), ("s", "string"), ("d", "double")]
    declared = csv.read_csv(spark, path, "k bigint, s string, d string")
    assert declared.dtypes == [("k", "bigint"), ("s", "string"), ("d", "string")] and declared.count() == 2


def test_claims_story(spark):
    path = scratch_path(spark, "claims")
    raw = {c: "1" for c in claims.COLUMNS}
    lines = []
    for number, changed in enumerate((
            {"MSTATUS": "z_No", "EDUCATION": "<High School", "CLM_AMT": "$1,000", "AGE": "50", "CAR_USE": "Private"},
            {"EDUCATION": "PhD", "OCCUPATION": "Doctor", "CLM_AMT": "$0", "AGE": "", "CAR_USE": "Private"},
            {"EDUCATION": "z_High School", "OCCUPATION": "z_Blue Collar", "CLM_AMT": "", "AGE": "30",
             "CAR_USE": "Commercial"})):
        lines.append(",".join(f'"{v}"' for v in {**raw, **changed, "ID": str(number)}.values()))
    spark.createDataFrame([(",".join(claims.COLUMNS),)] + [(x,) for x in lines], "value string").coalesce(1).write.text(path)
    df = claims.read_claims(spark, path)
    assert len(df.columns) == 27 and dict(df.dtypes)["AGE"] == "int" and dict(df.dtypes)["BIRTH"] == "string"
    cleaned = claims.clean_claims(df)
    assert cleaned.columns[-11:] == [*claims.STRIPPED, *claims.MONEY] and len(cleaned.columns) == 27
    found = {r.ID: (r.MSTATUS, r.EDUCATION, r.CLM_AMT) for r in cleaned.collect()}
    assert found == {0: ("No", "High School", 1000.0), 1: ("1", "PhD", 0.0), 2: ("1", "High School", None)}
    assert [tuple(r) for r in df.orderBy("ID").select(*claims.claim_flags()).collect()] == [(0, 0), (1, 1), (0, 0)]
    assert {tuple(r) for r in claims.claim_summary(cleaned, "CAR_USE").collect()} == {
        ("Private", 1000.0, 50.0, 1, 2), ("Commercial", None, 30.0, 1, 1)}
    assert [r.EDUCATION for r in claims.claim_summary(cleaned, "EDUCATION", 39).collect()] == ["High School"]


def test_tables(spark):
    database = scratch_database(spark, "test")
    name = f"{database}.t"
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, s string")
    assert tables.save_table(base, name).count() == 2
    assert tables.save_table(base.limit(1), name).count() == 1
    assert tables.append_to_table(base.select("s", "k"), name).count() == 3
    with pytest.raises(ValueError, match="x"):
        tables.append_to_table(base.withColumn("x", F.lit(1)), name)
    assert tables.insert_batches(spark, name, ["k", "s"], sample_rows=2, batches=3).count() == 9
    assert tables.create_table_as(spark, f"{database}.c", name, ["s"]).columns == ["s"]
    assert {r.tableName for r in spark.sql(f"SHOW TABLES IN {database}").filter("NOT isTemporary").collect()} == {"t", "c"}
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
    assert described.filter("col_name = 'Provider'").first().data_type == "parquet"
    tables.use_database(spark, database)
    assert spark.catalog.currentDatabase() == database and spark.table("t").count() == 9
    spark.catalog.setCurrentDatabase("default")
    tables.drop_tables(spark, [name, f"{database}.c", f"{database}.none"], database)
    assert not spark.catalog.databaseExists(database)


def test_database_name():
    assert tables.database_name("abc") == "workshop_abc"
    for bad in ("", "a b"):
        with pytest.raises(ValueError):
            tables.database_name(bad)


def test_files_and_compaction(spark):
    many, few = scratch_path(spark, "many"), scratch_path(spark, "few")
    files.spread_rows(spark.range(1000), 20).write.parquet(many)
    listing = files.file_inventory(spark, many)
    assert listing.columns == ["path", "name", "bytes", "megabytes"]
    assert files.count_files(spark, many) == 20 == listing.filter("bytes > 0 AND name LIKE '%.parquet'").count()
    assert files.compact_parquet(spark, many, few) == few
    assert files.count_files(spark, few) == 1 and spark.read.parquet(few).count() == 1000
    assert files.compact_parquet(spark, few, scratch_path(spark, "unused")) == few
    balanced = scratch_path(spark, "balanced")
    files.balance_for_write(spark.read.parquet(many)).write.parquet(balanced)
    assert files.count_files(spark, balanced) < 20


@pytest.mark.parametrize("target", [1_000, 20_000, 128_000_000])
def test_compaction_query_at_any_target(spark, tiny, target):
    rows = reading.compact_rows(spark, tiny, target).collect()
    assert sum(r.n for r in rows) == 1500 and all(r.few_files for r in rows)


def test_discarded_tables_leave_no_folder(spark):
    before = set(os.listdir(scratch_dir(spark).removeprefix("file:")))
    stored = [materialize(spark.range(3)) for _ in range(4)]
    discard(*stored)
    discard(spark.range(1))
    assert set(os.listdir(scratch_dir(spark).removeprefix("file:"))) == before


def test_only_plain_local_masters_get_a_temporary_folder():
    assert all(LOCAL.fullmatch(m) for m in ("local", "local[4]", "local[*]", "local[2,3]"))
    assert not any(LOCAL.fullmatch(m) for m in ("local-cluster[2,1,1024]", "yarn", "spark://host:7077", "localhost"))


def test_megabytes():
    assert files.bytes_to_megabytes(246568) == 0.25 and files.bytes_to_megabytes(101525468) == 101.53
    assert files.megabytes_to_bytes(2) == 2_000_000


def test_scratch_folder_is_shared_and_paths_differ(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert scratch_dir(spark) == (named or spark.sparkContext.getCheckpointDir()).rstrip("/")
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_materialize_fixes_partition_dependent_values(spark):
    fixed = materialize(spark.range(100).repartition(7).withColumn("p", F.spark_partition_id()))
    assert sorted(fixed.collect()) == sorted(fixed.repartition(2).collect())
