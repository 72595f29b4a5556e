"""Where results are written and how they are read back.

Publishing is a new version directory plus one event row that names it; the event is the commit.
Readers follow the latest successful event, so a lost driver or executor leaves the previous
version in force and no directory is ever renamed or overwritten in place.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
# Spark setting: shuffle files of a write go when it has ended, not when the driver happens to collect its garbage
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries that start inside remove their shuffle files at their end; the session's own setting comes back."""
    before = spark.conf.get(FREE_SHUFFLES)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def shared_dir(spark: SparkSession) -> str:
    """The folder shared by all executors for intermediate results.

    Taken from the session's ``spark.checkpoint.dir``.  Only where that is unset (a local test
    session) a folder of this machine is chosen and set as the checkpoint folder.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(
        CHECKPOINT_CONF, None
    )
    context = spark.sparkContext
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    current = context.getCheckpointDir()
    if current is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a shared folder on a cluster")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="creditloom-"))
        current = context.getCheckpointDir()
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_dir(spark).rstrip('/')}/scratch/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: rows are stored in the shared folder and survive lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Write a table; what was shuffled for it takes no disk any more."""
    with shuffles_freed(df.sparkSession):
        df.write.mode(mode).option("compression", "zstd").parquet(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder of intermediate results that nothing reads any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def path_exists(spark: SparkSession, path: str | None) -> bool:
    if path is None:
        return False
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def version_path(root: str, layer: str, table: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{table}/version={run_id}"


def publish(
    df: DataFrame, root: str, layer: str, table: str, run_id: str, metrics: list[Column] = ()
) -> tuple[str, dict]:
    """Write one table version; it becomes visible when its success event is appended.

    ``metrics`` are aggregates over the written rows, taken during the write itself, so that a
    large table is not read again for its profile.  Returns the path and the metrics.
    """
    path = version_path(root, layer, table, run_id)
    if not metrics:
        return write_parquet(df, path), {}
    watched = Observation(f"{layer}.{table}.{run_id}")
    write_parquet(df.observe(watched, *metrics), path)
    return path, watched.get


def publish_bucketed(
    df: DataFrame, name: str, path: str, buckets: int, key: str
) -> DataFrame:
    """Create or replace a catalog table bucketed and sorted by ``key``.

    Tables bucketed alike on one key join and aggregate on it without a shuffle, which is the
    layout to choose for the history tables (contract key) and roll-ups (client key).
    """
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .format("parquet")
        .option("path", path)
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)


def register_views(spark: SparkSession, paths: dict[str, str]) -> list[str]:
    """Expose published tables as temporary views, one per name."""
    for name, path in paths.items():
        read_parquet(spark, path).createOrReplaceTempView(name)
    return sorted(paths)
