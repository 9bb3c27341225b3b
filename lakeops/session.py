"""Session set-up and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Masters whose executors share the driver's machine and its folders; local-cluster[...] is none of them.
LOCAL = re.compile(r"local(\[[^\]]*\])?")


def build_session(app: str = "lakeops", master: str | None = None, partitions: int | None = None,
                  memory: str | None = None) -> SparkSession:
    """A session with adaptive execution and a fixed time zone; give ``master`` only for local runs."""
    builder = (SparkSession.builder.appName(app)
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false").config(
            "spark.ui.showConsoleProgress", "false")
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    if memory:
        builder = builder.config("spark.driver.memory", memory)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The folder shared by all executors for intermediate data.

    It is the one named by ``spark.checkpoint.dir``, or the context's checkpoint folder. Only a
    local session without either gets a temporary folder, removed at exit; on a cluster a folder
    of one machine would be wrong, so the setting is required there.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(shared)
        return shared.rstrip("/")
    if context.getCheckpointDir() is None:
        if not LOCAL.fullmatch(context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        own = tempfile.mkdtemp(prefix="lakeops-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        context.setCheckpointDir(own)
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call returns."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def scratch_database(spark: SparkSession, name: str) -> str:
    """Create a database with its own folder in the shared folder and return its name."""
    database = f"{name}_{uuid.uuid4().hex[:12]}"
    path = f"{scratch_dir(spark)}/{database}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{path}'")
    return database


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and read it back.

    Needed where a column depends on how rows were partitioned, such as ``spark_partition_id``:
    computing it twice could give two answers. Also used for results that several later steps
    read. The copy outlives lost executors, and later reads take only the columns they need.
    Whoever has read it for the last time should ``discard`` it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "rows")
    df.write.mode("errorifexists").parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def discard(*stored: DataFrame) -> None:
    """Delete what ``materialize`` wrote for these; nothing may read them afterwards."""
    for df in stored:
        path = getattr(df, "stored_at", None)
        if path is not None:
            delete_folder(df.sparkSession, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
