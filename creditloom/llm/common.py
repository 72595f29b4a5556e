"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.storage import FREE_SHUFFLES, scratch_path, shuffles_freed  # noqa: F401


def staged(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The rows survive lost executors and are computed once, so values that depend on the task that
    made them (block numbers, positions) stay fixed for every later reader.  What was shuffled for them
    takes no disk any more.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_freed(spark):
        df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_by(df: DataFrame, name: str, key: str, files: int) -> DataFrame:
    """Like staged(), with the rows dealt to ``files`` buckets by ``key``: a join on it with rows dealt alike does not shuffle them.

    The session's catalog knows the table only while it is made; the files lie in the shared folder.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    known = path.rpartition("/")[2].replace("-", "_")
    with shuffles_freed(spark):
        df.write.option("compression", "zstd").option("path", path).bucketBy(files, key).saveAsTable(known, format="parquet")
    stored = spark.table(known)
    spark.sql(f"DROP TABLE {known}")  # of a table with a path of its own only the entry goes
    return stored


def stored_order(df: DataFrame, name: str) -> DataFrame:
    """Add ``name`` = gapless position 0, 1, ... of the row in the files it is read from, by file name and row.

    Files that one sorted write left keep its order in their names.  Rows that do not come straight from
    files are stored first.  Only one row per file, of which the driver has a list anyway, meets in one
    place and is broadcast.
    """
    own = [c for c in df.columns if c != name]
    file, row = F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__row")
    try:
        placed = df.select(*own, file, row)
    except AnalysisException:
        placed = staged(df, "rows").select(*own, file, row)
    before = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    first = placed.groupBy("__file").agg((F.max("__row") + 1).alias("__n")).select(
        "__file", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first")
    )
    return placed.join(F.broadcast(first), "__file").select(*own, (F.col("__first") + F.col("__row")).alias(name))


def freed() -> None:
    """Give memory of arrays that are no longer used back to the machine; a worker would keep it for its next task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # numpy's memory, with glibc
    if trim:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8_bytes(text: Column | str) -> Column:
    """UTF-8 bytes of a text; none for NULL."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary")


def byte_slices(texts: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """Cut rows ``start .. stop`` so that each slice holds about ``limit`` bytes, one row at least."""
    return size_slices(np.asarray(pc.fill_null(pc.binary_length(texts), 0)), limit)


def size_slices(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < len(sizes):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield start, stop
        start = stop


def numbered_within(
    df: DataFrame, group: list[Column], order: list[Column], name: str, rows_per_task: int = 200_000
) -> DataFrame:
    """Add ``name`` = gapless position 0, 1, ... of the row within its group.

    A group may hold most of the rows, so it is cut by a hash of the order columns into parts of
    about ``rows_per_task`` rows, numbered inside each part, and shifted by the sizes of the parts
    before it.  Only part sizes (rows / rows_per_task of them) meet in one place per group.
    """
    keys = [f"__g{i}" for i in range(len(group))]
    keyed = df.select("*", *[c.alias(k) for c, k in zip(group, keys)])
    total = df.count()
    parts = max(1, -(-total // rows_per_task))
    keyed = keyed.withColumn("__part", F.pmod(F.xxhash64(*order), F.lit(parts)))
    sizes = keyed.groupBy(*keys, "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(
        *[F.col(k).alias(f"__b{k}") for k in keys],
        F.col("__part").alias("__bpart"),
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"),
    )
    inside = Window.partitionBy(*keys, "__part").orderBy(*order)
    ranked = keyed.withColumn("__pos", F.row_number().over(inside) - 1)
    same = F.col("__part") == F.col("__bpart")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__b{k}"))
    return ranked.join(bases, same).select(
        *df.columns, (F.col("__base") + F.col("__pos")).alias(name)
    )
