"""What a published table was made from takes no disk any more, and raw files may be compressed."""

import glob
import os
import time

from pyspark.sql import functions as F

from checks.raw_queries import RAW_FILES, write_raw_files
from creditloom.plans import bronze, raw_audit
from creditloom.sources import storage


def shuffle_files(spark):
    """Data files of shuffles below the session's local folders."""
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for d in manager.localDirs() for f in glob.glob(os.path.join(d.toString(), "*", "shuffle_*.data"))}


def test_publishing_leaves_no_shuffle_files(spark, tmp_path):
    before, setting = shuffle_files(spark), spark.conf.get(storage.FREE_SHUFFLES)
    counted = spark.range(10_000).repartition(5, "id").groupBy((F.col("id") % 7).alias("k")).count()
    path, facts = storage.publish(counted, str(tmp_path), "silver", "a", "r", [F.sum("count").alias("n")])
    until = time.time() + 20  # Spark removes them beside the next work
    while not shuffle_files(spark) <= before and time.time() < until:
        time.sleep(0.1)
    assert shuffle_files(spark) <= before
    assert spark.conf.get(storage.FREE_SHUFFLES) == setting
    assert facts == {"n": 10_000} and spark.read.parquet(path).count() == 7
    assert all(f.endswith(".zstd.parquet") for f in glob.glob(f"{path}/part-*"))


def test_compressed_raw_files_are_read_alike(inputs):
    spark, names = inputs.spark, ("application_test", "bureau")
    plain, packed = write_raw_files(inputs, names), write_raw_files(inputs, names, compression="gzip")
    shown = [
        sorted((r.file_name, r.validation_status, r.row_count, r.column_count) for r in raw_audit.audit_files(spark, d).collect())
        for d in (plain, packed)
    ]
    assert shown[0] == shown[1]
    for name in names:
        a, b = (bronze.read_raw_csv(spark, f"{d}/{RAW_FILES[name]}") for d in (plain, packed))
        assert a.count() > 0 and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    parts = glob.glob(f"{packed.removeprefix('file:')}/*/part-*")
    assert parts and all(f.endswith(".csv.gz") for f in parts)
    storage.remove(spark, packed)
    assert not storage.path_exists(spark, packed) and storage.path_exists(spark, plain)
