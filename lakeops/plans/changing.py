"""Queries over deletes, updates, upserts, schema evolution and table versions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window, functions as F

from lakeops.operators import changes
from lakeops.operators.versions import VersionedTable
from lakeops.plans.tables import ACCOUNTS_SQL, accounts, table
from lakeops.session import scratch_database


def _key():
    return F.col("c_custkey")


def delete_where(spark, folder):
    return changes.delete_where(accounts(spark, folder), F.col("c_acctbal") > 5000)


def update_where(spark, folder):
    return changes.update_where(accounts(spark, folder), F.col("c_acctbal") > 5000,
                                {"c_acctbal": F.lit(100), "c_mktsegment": F.concat("c_mktsegment", F.lit(" old"))})


def _merge_target(spark, folder):
    """Accounts with repeated keys and NULL keys."""
    base = accounts(spark, folder)
    repeated = base.unionByName(base.filter(_key() % 15 == 0))
    return repeated.withColumn("c_custkey", F.when(_key() % 13 != 0, _key()))


def _merge_source(spark, folder):
    """Changed rows (some to NULL), new keys and NULL keys."""
    base = table(spark, folder, "customer").select("c_custkey", "c_acctbal", F.lit("NEW").alias("c_mktsegment"))
    changed = base.filter(_key() % 10 == 5).withColumn("c_acctbal", F.when(_key() % 20 == 5, F.col("c_acctbal") + 1))
    return (changed.unionByName(base.filter(_key() % 20 == 7).withColumn("c_custkey", -1 - _key()))
            .unionByName(base.filter(_key() % 100 == 1).withColumn("c_custkey", F.lit(None).cast("bigint"))))


def merge_upsert(spark, folder):
    return changes.merge_upsert(_merge_target(spark, folder), _merge_source(spark, folder), ["c_custkey"])


def merge_upsert_unique(spark, folder):
    """The same source into a table with unique keys, by one full outer join."""
    source = _merge_source(spark, folder)
    return changes.merge_upsert(accounts(spark, folder), source, ["c_custkey"], large_source=True)


def merge_upsert_large(spark, folder):
    """The first merge, by one full outer join."""
    return changes.merge_upsert(_merge_target(spark, folder), _merge_source(spark, folder), ["c_custkey"],
                                large_source=True)


def append_evolve(spark, folder):
    base = accounts(spark, folder)
    rows = base.filter(_key() % 50 == 0).select("c_custkey", "c_acctbal", "c_mktsegment", F.lit("M").alias("c_gender"))
    return changes.append_rows(base, rows, evolve=True)


def _versioned(spark, folder):
    """Create, delete, update, merge, then append with a new column: versions 0 to 4."""
    customer = table(spark, folder, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    versioned = VersionedTable.create(spark, f"{scratch_database(spark, 'versions')}.customer", customer)
    versioned.delete(_key() % 10 == 3)
    versioned.update(_key() % 10 == 4, {"c_acctbal": F.lit(100)})
    versioned.merge(_merge_source(spark, folder), ["c_custkey"])
    versioned.append(customer.filter(_key() % 50 == 0).select(
        (-1_000_000_000_000 - _key()).alias("c_custkey"), "c_acctbal", "c_mktsegment", F.lit("M").alias("c_gender")),
        evolve=True)
    return versioned


def version_count(spark, folder):
    versioned = _versioned(spark, folder)
    counts = [versioned.read(v).agg(F.count(F.lit(1)).alias("n")).withColumn("version", F.lit(v)) for v in range(5)]
    return reduce(lambda a, b: a.unionByName(b), counts)


def version_filter(spark, folder):
    """Changed, updated and new rows before and after."""
    versioned = _versioned(spark, folder)
    states = [versioned.read(v).withColumn("version", F.lit(v)) for v in (0, 3)]
    return states[0].unionByName(states[1]).filter(
        (_key() % 10).isin([3, 4, 5]) | (_key() < 0) | _key().isNull())


def table_history(spark, folder):
    return _versioned(spark, folder).history().select("version", "operation", "rows")


def retain_versions(spark, folder):
    versioned = _versioned(spark, folder)
    versioned.compact(min_files=1)
    versioned.retain(2)
    kept = [versioned.read(v).agg(F.count(F.lit(1)).alias("n")).withColumn("version", F.lit(v)) for v in (4, 5)]
    return kept[0].unionByName(kept[1])


def bucketed_changes(spark, folder):
    """A table written at once in buckets, then a merge, a delete and an update of few keys: only their buckets are new."""
    customer = table(spark, folder, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    versioned = VersionedTable.create(spark, f"{scratch_database(spark, 'buckets')}.customer", customer,
                                      bucket_by=["c_custkey"], buckets=32)
    versioned.merge(customer.filter(_key() < 3).withColumns({
        "c_custkey": F.when(_key() == 2, -1).otherwise(_key()), "c_mktsegment": F.lit("NEW")}), ["c_custkey"])
    versioned.delete(_key() == 7)
    versioned.update(_key().isin(8, 9), {"c_acctbal": F.lit(100)})
    return versioned.read()


def bucketed_history(spark, folder):
    """The same changes: how many of the buckets each of them left alone."""
    customer = table(spark, folder, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    versioned = VersionedTable.create(spark, f"{scratch_database(spark, 'buckets')}.customer", customer,
                                      bucket_by=["c_custkey"], buckets=8)
    versioned.delete(_key() == 7)
    versioned.update(_key() == 8, {"c_acctbal": F.lit(100)})
    before = Window.orderBy("version")
    kept = F.size(F.array_intersect("parts", F.lag("parts").over(before)))
    return versioned.history().select("version", "operation", F.coalesce(kept, F.lit(0)).alias("kept"))


def tiered_inserts(spark, folder):
    """Thirty inserts with merging by tiers of three: rows written by each version and the parts of the last one."""
    some = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    versioned = VersionedTable.create(spark, f"{scratch_database(spark, 'tiers')}.supplier", some)
    for _ in range(TIERED_INSERTS):
        versioned.append(some, tiers=3)
    newest = versioned.history().limit(1).select(F.lit("parts of the last").alias("operation"),
                                                 F.size("parts").cast("long").alias("versions"),
                                                 F.lit(versioned.read().count()).cast("long").alias("rows"))
    return versioned.history().groupBy("operation").agg(
        F.count(F.lit(1)).alias("versions"), F.sum("rows").alias("rows")).unionByName(newest)


TIERED_INSERTS = 30

QUERIES = {f.__name__: f for f in (
    bucketed_changes, bucketed_history, tiered_inserts, delete_where, update_where, merge_upsert, merge_upsert_unique, merge_upsert_large, append_evolve, version_count, version_filter,
    table_history, retain_versions)}

_SOURCE = """
    SELECT c_custkey, CASE WHEN c_custkey % 20 = 5 THEN c_acctbal + 1 END AS c_acctbal, 'NEW' AS c_mktsegment
    FROM customer WHERE c_custkey % 10 = 5
    UNION ALL SELECT -1 - c_custkey, c_acctbal, 'NEW' FROM customer WHERE c_custkey % 20 = 7"""
_SOURCE_WITH_NULL = f"""{_SOURCE}
    UNION ALL SELECT NULL, c_acctbal, 'NEW' FROM customer WHERE c_custkey % 100 = 1"""


def _merge_sql(target: str, source: str) -> str:
    return f"""
        WITH t AS ({target}), s AS ({source})
        SELECT t.c_custkey, CASE WHEN s.c_custkey IS NOT NULL THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
               CASE WHEN s.c_custkey IS NOT NULL THEN s.c_mktsegment ELSE t.c_mktsegment END AS c_mktsegment
        FROM t LEFT JOIN s ON t.c_custkey = s.c_custkey
        UNION ALL
        SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.c_custkey = s.c_custkey)"""


_MERGE_TARGET = f"""
    SELECT CASE WHEN c_custkey % 13 <> 0 THEN c_custkey END AS c_custkey, c_acctbal, c_mktsegment
    FROM ({ACCOUNTS_SQL} UNION ALL SELECT * FROM ({ACCOUNTS_SQL}) WHERE c_custkey % 15 = 0)"""
_V2 = """
    SELECT c_custkey, CASE WHEN c_custkey % 10 = 4 THEN 100 ELSE c_acctbal END AS c_acctbal, c_mktsegment
    FROM customer WHERE c_custkey % 10 <> 3"""
_SIZES = """
    sizes AS (
        SELECT count(*) AS all_rows, count(*) FILTER (c_custkey % 10 <> 3) AS kept,
               count(*) FILTER (c_custkey % 20 = 7) + count(*) FILTER (c_custkey % 100 = 1) AS added, count(*) FILTER (c_custkey % 50 = 0) AS appended
        FROM customer)"""

def _tiers(inserts: int, fan_in: int) -> tuple[int, int, int]:
    """(merges, tables written by them, parts left) after a first table and so many like it."""
    parts, merges, written = [1], 0, 0
    for _ in range(inserts):
        parts.append(1)
        while len(parts) >= fan_in and len(set(parts[-fan_in:])) == 1:
            merges, written = merges + 1, written + sum(parts[-fan_in:])
            parts[-fan_in:] = [sum(parts[-fan_in:])]
    return merges, written, len(parts)


_MERGES, _REWRITTEN, _LEFT = _tiers(TIERED_INSERTS, 3)

ORACLES = {
    "bucketed_changes": """
        SELECT CASE WHEN c_custkey = 2 THEN -1 ELSE c_custkey END AS c_custkey, c_acctbal, 'NEW' AS c_mktsegment
        FROM customer WHERE c_custkey < 3
        UNION ALL SELECT c_custkey, CASE WHEN c_custkey IN (8, 9) THEN 100 ELSE c_acctbal END, c_mktsegment
        FROM customer WHERE c_custkey >= 2 AND c_custkey <> 7""",
    "bucketed_history": """
        SELECT 0 AS version, 'create' AS operation, 0 AS kept
        UNION ALL SELECT 1, 'delete', 7 UNION ALL SELECT 2, 'update', 7""",
    "tiered_inserts": f"""
        SELECT 'create' AS operation, CAST(1 AS BIGINT) AS versions, count(*) AS rows FROM supplier
        UNION ALL SELECT 'append', {TIERED_INSERTS}, {TIERED_INSERTS} * count(*) FROM supplier
        UNION ALL SELECT 'merge parts', {_MERGES}, {_REWRITTEN} * count(*) FROM supplier
        UNION ALL SELECT 'parts of the last', {_LEFT}, {TIERED_INSERTS + 1} * count(*) FROM supplier""",
    "delete_where": f"SELECT * FROM ({ACCOUNTS_SQL}) WHERE coalesce(c_acctbal <= 5000, TRUE)",
    "update_where": f"""
        SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN 100 ELSE c_acctbal END AS c_acctbal,
               CASE WHEN c_acctbal > 5000 THEN c_mktsegment || ' old' ELSE c_mktsegment END AS c_mktsegment
        FROM ({ACCOUNTS_SQL})""",
    "merge_upsert": _merge_sql(_MERGE_TARGET, _SOURCE_WITH_NULL),
    "merge_upsert_large": _merge_sql(_MERGE_TARGET, _SOURCE_WITH_NULL),
    "merge_upsert_unique": _merge_sql(ACCOUNTS_SQL, _SOURCE_WITH_NULL),
    "append_evolve": f"""
        SELECT *, NULL::VARCHAR AS c_gender FROM ({ACCOUNTS_SQL})
        UNION ALL SELECT *, 'M' FROM ({ACCOUNTS_SQL}) WHERE c_custkey % 50 = 0""",
    "version_count": f"""
        WITH {_SIZES}
        SELECT all_rows AS n, 0 AS version FROM sizes UNION ALL SELECT kept, 1 FROM sizes
        UNION ALL SELECT kept, 2 FROM sizes UNION ALL SELECT kept + added, 3 FROM sizes
        UNION ALL SELECT kept + added + appended, 4 FROM sizes""",
    "version_filter": f"""
        SELECT * FROM (
            SELECT c_custkey, c_acctbal, c_mktsegment, 0 AS version FROM customer
            UNION ALL SELECT *, 3 FROM ({_merge_sql(_V2, _SOURCE_WITH_NULL)}))
        WHERE c_custkey % 10 IN (3, 4, 5) OR c_custkey < 0 OR c_custkey IS NULL""",
    "table_history": f"""
        WITH {_SIZES}
        SELECT 0 AS version, 'create' AS operation, all_rows AS rows FROM sizes
        UNION ALL SELECT 1, 'delete', kept FROM sizes UNION ALL SELECT 2, 'update', kept FROM sizes
        UNION ALL SELECT 3, 'merge', kept + added FROM sizes UNION ALL SELECT 4, 'append', appended FROM sizes""",
    "retain_versions": f"""
        WITH {_SIZES}
        SELECT kept + added + appended AS n, 4 AS version FROM sizes
        UNION ALL SELECT kept + added + appended, 5 FROM sizes""",
}
