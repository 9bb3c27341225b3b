"""Numbered versions of a parquet table, with history, time travel and retention.

Layout: one managed table partitioned by ``version`` holds the rows, a second table
``<name>_history`` holds one row per version. A commit writes at most one new partition, and its
history row lists the partitions that make up the version; Spark prunes a read to them. An append
writes only its rows. A delete, update or merge rewrites only the partitions that hold a matching
row. ``rewrite`` and ``compact`` write the whole table.

A table can also be dealt to buckets by a hash of its keys: they are a second partition column, and
what is said of partitions above holds for (version, bucket). Then a change of few keys rewrites few
buckets of a table that was written at once, and a merge reads only the buckets of its source.

A commit writes the partition's folder, adds the partition, then appends the history row; readers
go by the history, so they see a version whole or not at all. A crash before the last step leaves
an unused folder, and the next commit fails until it is removed by hand. Of two writers of the same
number the second fails because the folder exists. There is no further concurrency control.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, Window, functions as F
from pyspark.sql.types import (ArrayType, IntegerType, LongType, StringType, StructField, StructType,
                               TimestampType)

from lakeops.operators import changes, intervals
from lakeops.operators.ordering import join_null_safe
from lakeops.sources.files import (
    BYTES_PER_MEGABYTE, balance_for_write, files_for, folder_names, merge_files, written_size,
)

#: The most buckets; a part's number is version * MOST_BUCKETS + bucket, or the version alone without buckets.
MOST_BUCKETS = 1 << 16
HISTORY = StructType([
    StructField("version", IntegerType()), StructField("parts", ArrayType(LongType())),
    StructField("operation", StringType()), StructField("detail", StringType()),
    StructField("rows", LongType()), StructField("files", LongType()), StructField("bytes", LongType()),
    StructField("columns", ArrayType(StringType())), StructField("committed_at", TimestampType()),
])


def _text(predicate: Column) -> str:
    return str(predicate).removeprefix("Column<'").removesuffix("'>")


class VersionedTable:
    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.name = name
        self.history_name = f"{name}_history"
        self._newest: Row | None = None

    # -- reading ---------------------------------------------------------------------------

    def history(self) -> DataFrame:
        """One row per version, newest first. ``rows``, ``files`` and ``bytes`` are those written by it."""
        return self.spark.table(self.history_name).orderBy(F.col("version").desc())

    def _entry(self, version: int | None = None) -> Row:
        entries = self.history() if version is None else self.history().filter(F.col("version") == version)
        entry = entries.first()
        if entry is None:
            raise ValueError(f"{self.name} has no version {version}")
        return entry

    def _base(self) -> Row:
        """The version to build on: the last one seen or written here. If another writer was faster, the commit fails."""
        if self._newest is None:
            self._newest = self._entry()
        return self._newest

    def latest(self) -> int:
        return self._entry().version

    def read(self, version: int | None = None) -> DataFrame:
        """The rows and columns of a version; the newest one by default."""
        entry = self._entry(version)
        if version is not None and not set(entry.parts) <= set(self._partitions()):
            raise ValueError(f"the rows of version {version} of {self.name} were dropped")
        return self._parts(entry.parts).select(*entry.columns)

    @cached_property
    def bucketing(self) -> tuple[list[str], int]:
        """(key columns, number of buckets); none and 0 for a table without buckets."""
        found = {r[0]: r[1] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect()}
        return json.loads(found.get("bucket_by", "[]")), int(found.get("buckets", 0))

    def _place(self, part: int) -> dict[str, int]:
        """The partition values of a part."""
        if not self.bucketing[1]:
            return {"version": part}
        return {"version": part // MOST_BUCKETS, "bucket": part % MOST_BUCKETS}

    def _version_of(self, part: int) -> int:
        return self._place(part)["version"]

    def _parts(self, parts: list[int]) -> DataFrame:
        """Rows of the given parts, with the partition columns; Spark prunes the others."""
        rows = self.spark.table(self.name)
        if not self.bucketing[1]:
            return rows.filter(F.col("version").isin(parts))
        buckets: dict[int, list[int]] = {}
        for place in map(self._place, parts):
            buckets.setdefault(place["version"], []).append(place["bucket"])
        chosen = F.lit(False)
        for version, some in buckets.items():
            chosen = chosen | ((F.col("version") == version) & F.col("bucket").isin(some))
        return rows.filter(chosen)

    def _part_number(self) -> Column:
        version = F.col("version").cast("long")
        return version * MOST_BUCKETS + F.col("bucket") if self.bucketing[1] else version

    def _bucket_of(self, rows: DataFrame) -> Column:
        """The bucket of each row, by its keys in the table's own types."""
        keys, number = self.bucketing
        types = {f.name: f.dataType for f in self.spark.table(self.name).schema.fields}
        return F.pmod(F.xxhash64(*[rows[f"`{k}`"].cast(types[k]) for k in keys]), F.lit(number)).cast("int")

    def _partitions(self) -> list[int]:
        places = [dict(p.split("=") for p in r[0].split("/"))
                  for r in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()]
        if not self.bucketing[1]:
            return [int(p["version"]) for p in places]
        return [int(p["version"]) * MOST_BUCKETS + int(p["bucket"]) for p in places]

    # -- writing ---------------------------------------------------------------------------

    @classmethod
    def create(cls, spark: SparkSession, name: str, df: DataFrame, operation: str = "create",
               balance: bool = False, bucket_by: list[str] = (), buckets: int = 0) -> VersionedTable:
        """Create the table with ``df`` as version 0; ``balance`` evens out its files by a shuffle.

        With ``bucket_by`` rows are dealt to ``buckets`` by a hash of these columns, here and in all later versions.
        """
        if bool(bucket_by) != bool(buckets) or not 0 <= buckets <= MOST_BUCKETS:
            raise ValueError(f"bucket_by needs 1 to {MOST_BUCKETS} buckets")
        missing = [k for k in bucket_by if k not in df.columns]
        if missing:
            raise ValueError(f"no such columns: {missing}")
        own = ["version", "bucket"] if buckets else ["version"]
        for column in own:
            if column in [c.lower() for c in df.columns]:
                raise ValueError(f"the column name {column} is taken")
        fields = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields], *[f"{c} INT" for c in own]])
        properties = f" TBLPROPERTIES ('bucket_by'='{json.dumps(list(bucket_by))}', 'buckets'='{buckets}')" if buckets else ""
        spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet PARTITIONED BY ({', '.join(own)}){properties}")
        table = cls(spark, name)
        spark.createDataFrame([], HISTORY).write.format("parquet").saveAsTable(table.history_name)
        table._commit(0, balance_for_write(df) if balance else df, [], operation, "")
        return table

    @cached_property
    def location(self) -> str:
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}")
        return described.filter("col_name = 'Location'").first().data_type.rstrip("/")

    def _commit(self, version: int, df: DataFrame | None, kept: list[int], operation: str, detail: str,
                columns: list[str] | None = None) -> int:
        """Record a version made of the parts ``kept`` and, unless None, new ones with ``df``."""
        rows, files, size = 0, 0, 0
        if df is not None:
            folder = f"{self.location}/version={version}"
            seen = Observation()
            observed = df.observe(seen, F.count(F.lit(1)).alias("rows"))
            if self.bucketing[1]:
                # Adaptive execution splits a bucket that is too large for one task, and joins small ones.
                dealt = observed.withColumn("bucket", self._bucket_of(observed)).hint("rebalance", "bucket")
                dealt.write.mode("errorifexists").partitionBy("bucket").parquet(folder)
                written = [version * MOST_BUCKETS + int(n.split("=")[1]) for n in folder_names(self.spark, folder)
                           if n.startswith("bucket=")]
            else:
                observed.write.mode("errorifexists").parquet(folder)
                written = [version]
            self._add_partitions(sorted(written))
            files, size = written_size(self.spark, folder)
            rows, kept, columns = seen.get["rows"], [*kept, *sorted(written)], df.columns
        entry = [version, kept, operation, detail, rows, files, size, columns]
        values = [F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(entry, HISTORY.fields)]
        (self.spark.range(1, numPartitions=1).select(*values, F.current_timestamp().alias("committed_at"))
         .write.mode("append").format("parquet").saveAsTable(self.history_name))
        self._newest = Row(**dict(zip(HISTORY.names, [*entry, None])))
        return version

    def _specs(self, parts: list[int]) -> list[str]:
        return [f"PARTITION ({', '.join(f'{c}={v}' for c, v in self._place(p).items())})" for p in parts]

    def _add_partitions(self, parts: list[int]) -> None:
        if parts:
            self.spark.sql(f"ALTER TABLE {self.name} ADD {' '.join(self._specs(parts))}")

    def rewrite(self, df: DataFrame, operation: str, detail: str = "", balance: bool = False) -> int:
        """Commit ``df``, usually made from ``read()``, as the whole table; returns the new version.

        Columns may be left out or, as in an evolving append, added, but none may change its type.
        ``balance`` evens out its files by a shuffle.
        """
        self._check_stored(df)
        return self._commit(self._base().version + 1, balance_for_write(df) if balance else df, [], operation, detail)

    def _check_stored(self, rows: DataFrame) -> None:
        """Make room for new columns; raise if a column has another type than any version stored it with."""
        stored = {f.name: f.dataType for f in self.spark.table(self.name).schema.fields}
        taken = [c for c in rows.columns if c.lower() in ("version", *(["bucket"] if self.bucketing[1] else []))]
        if taken:
            raise ValueError(f"the column name {taken[0]} is taken")
        lost = [k for k in self.bucketing[0] if k not in rows.columns]
        if lost:
            raise ValueError(f"rows are dealt to buckets by {lost}")
        clash = [f"{f.name}: {stored[f.name].simpleString()} and {f.dataType.simpleString()}"
                 for f in rows.schema.fields if f.name in stored and f.dataType != stored[f.name]]
        if clash:
            raise ValueError(f"column types differ from the stored ones: {clash}")
        added = [f for f in rows.schema.fields if f.name not in stored]
        if added:
            fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
            self.spark.sql(f"ALTER TABLE {self.name} ADD COLUMNS ({fields})")

    def _change(self, matching: Callable[[DataFrame], DataFrame], change: Callable[[DataFrame], DataFrame],
                operation: str, detail: str, adds_rows: bool = False, within: list[int] | None = None) -> int:
        """Apply ``change`` to the parts with rows that ``matching`` keeps, and leave the others.

        Only the parts ``within`` are looked at, if that is given.
        """
        entry = self._base()
        looked_at = entry.parts if within is None else [p for p in entry.parts if p in set(within)]
        found = matching(self._parts(looked_at)).select(self._part_number().alias("part")).distinct().collect()
        hit = sorted(r[0] for r in found)
        kept = [p for p in entry.parts if p not in set(hit)]
        if not hit and not adds_rows:
            return self._commit(entry.version + 1, None, kept, operation, detail, columns=entry.columns)
        changed = change(self._parts(hit).select(*entry.columns))
        return self._commit(entry.version + 1, changed, kept, operation, detail)

    def _parts_of_keys(self, source: DataFrame, keys: list[str]) -> list[int] | None:
        """The parts that can hold a key of ``source``; None if that cannot be told from the keys."""
        if not self.bucketing[1] or not set(self.bucketing[0]) <= set(keys):
            return None
        # At most one number per bucket.
        buckets = {r[0] for r in source.select(self._bucket_of(source)).distinct().collect()}
        return [p for p in self._base().parts if p % MOST_BUCKETS in buckets]

    def delete(self, predicate: Column, detail: str = "") -> int:
        return self._change(lambda rows: rows.filter(predicate),
                            lambda rows: changes.delete_where(rows, predicate), "delete", detail or _text(predicate))

    def update(self, predicate: Column, values: dict[str, Column], detail: str = "") -> int:
        return self._change(lambda rows: rows.filter(predicate),
                            lambda rows: changes.update_where(rows, predicate, values), "update",
                            detail or _text(predicate))

    def merge(self, source: DataFrame, keys: list[str], large_source: bool = False) -> int:
        """Upsert; partitions without any key of ``source`` are not touched, which cannot change the result."""
        return self._change(lambda rows: rows.join(source.select(*keys), list(keys), "left_semi"),
                            lambda rows: changes.merge_upsert(rows, source, keys, large_source), "merge",
                            f"on {', '.join(keys)}", adds_rows=True, within=self._parts_of_keys(source, keys))

    def merge_history(self, changes: DataFrame, keys: list[str], at: str, **options) -> int:
        """Merge changes into a stored history of intervals; see ``intervals.merge_history``.

        All rows of a key that changes are in the partitions that hold it, so the others are not touched.
        """
        def changed(rows: DataFrame) -> DataFrame:
            return join_null_safe(rows, changes.select(*keys).distinct(), keys, "left_semi")

        return self._change(changed, lambda rows: intervals.merge_history(rows, changes, keys, at, **options),
                            "merge_history", f"on {', '.join(keys)} at {at}", adds_rows=True,
                            within=self._parts_of_keys(changes, keys))

    def append(self, rows: DataFrame, evolve: bool = False, tiers: int = 0) -> int:
        """Add rows as a new version; only they are written. New columns need ``evolve``.

        With ``tiers`` small versions are merged as they gather, see ``merge_tiers``.
        """
        entry = self._base()
        current = self._parts(entry.parts).select(*entry.columns)
        changes.check_append(current, rows, evolve)
        self._check_stored(rows)
        new = [f for f in rows.schema.fields if f.name not in current.columns]
        full = current.limit(0).unionByName(rows, allowMissingColumns=True)
        version = self._commit(entry.version + 1, full, entry.parts, "append", "evolve" if new else "")
        return self.merge_tiers(tiers) or version if tiers else version

    # -- upkeep ----------------------------------------------------------------------------

    def compact(self, target_bytes: int = 128 * BYTES_PER_MEGABYTE, min_files: int = 2) -> int | None:
        """Rewrite the newest version in few files; None if it has no ``min_files`` too many.

        A table with buckets keeps at least one file for each of them.
        """
        entry = self._base()
        versions = {self._version_of(p) for p in entry.parts}
        written = self.history().filter(F.col("version").isin(list(versions)))
        files, size = written.agg(F.coalesce(F.sum("files"), F.lit(0)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
        buckets = len({p % MOST_BUCKETS for p in entry.parts}) if self.bucketing[1] else 1
        if files - max(buckets, math.ceil(size / target_bytes)) < min_files:
            return None
        rows = self._parts(entry.parts).select(*entry.columns)
        merged = rows if self.bucketing[1] else merge_files(rows, size, target_bytes)
        return self._commit(entry.version + 1, merged, [], "compact", f"{files} files")

    def merge_tiers(self, fan_in: int = 4, target_bytes: int = 128 * BYTES_PER_MEGABYTE) -> int | None:
        """Merge the newest written versions into one while ``fan_in`` of them are of one size; the last version made.

        Sizes are of one tier if they have the same whole logarithm to the base ``fan_in``. A merged version is of the
        next tier, so after n inserts of like size each row was written about log n times, and the newest version has
        about ``fan_in`` * log n parts. Each merge is a version of its own.
        """
        if fan_in < 2:
            raise ValueError("fan_in must be at least 2")
        made, sizes = None, None
        while True:
            entry = self._base()
            order = list(dict.fromkeys(self._version_of(p) for p in entry.parts))
            newest = order[-fan_in:]
            if len(newest) < fan_in:
                return made
            if sizes is None or not set(newest) <= sizes.keys():
                sizes = self._sizes(newest)
            if len({self._tier(sizes[v][0], fan_in) for v in newest}) > 1:
                return made
            chosen = [p for p in entry.parts if self._version_of(p) in set(newest)]
            rows = self._parts(chosen).select(*entry.columns)
            size = sum(sizes[v][1] for v in newest)
            made = self._commit(entry.version + 1, rows.coalesce(files_for(size, target_bytes)),
                                [p for p in entry.parts if p not in set(chosen)], "merge parts",
                                f"versions {', '.join(map(str, newest))}")
            sizes[made] = (sum(sizes[v][0] for v in newest), size)

    @staticmethod
    def _tier(rows: int, fan_in: int) -> int:
        tier = 0
        while rows >= fan_in:
            rows, tier = rows // fan_in, tier + 1
        return tier

    def _sizes(self, versions: list[int]) -> dict[int, tuple[int, int]]:
        """(rows, bytes) that each version wrote."""
        found = self.history().filter(F.col("version").isin(versions)).select("version", "rows", "bytes").collect()
        return {r.version: (r.rows, r.bytes) for r in found}

    def retain(self, keep: int = 1, hours: float | None = None) -> list[int]:
        """Drop the parts that no version to be kept needs; returns their numbers (without buckets: versions).

        Kept are the last ``keep`` versions or, with ``hours``, all that were the newest one at some time within the
        last so many hours; the newest version always is. History rows stay, but versions whose rows are gone can no
        longer be read.
        """
        if hours is None:
            wanted = self.history().limit(max(1, keep))
        else:
            replaced = F.lead("committed_at").over(Window.orderBy("version"))
            since = F.current_timestamp() - F.make_dt_interval(secs=F.lit(hours * 3600).cast("decimal(18,6)"))
            wanted = self.history().withColumn("replaced", replaced).filter(
                F.col("replaced").isNull() | (F.col("replaced") >= since))
        needed = {r[0] for r in wanted.select(F.explode("parts")).distinct().collect()}
        latest = self.latest()
        dropped = sorted(p for p in self._partitions() if p not in needed and self._version_of(p) <= latest)
        if dropped:
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS {', '.join(self._specs(dropped))}")
        return dropped
