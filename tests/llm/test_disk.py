"""What a stored result was made from does not stay on disk, and texts are not shuffled more than needed."""

import glob
import os

from pyspark.sql import functions as F

import corpus_pipeline
from creditloom.llm.common import FREE_SHUFFLES, staged


def shuffle_files(spark):
    """Data files of shuffles below the session's local folders."""
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for d in manager.localDirs() for f in glob.glob(os.path.join(d.toString(), "*", "shuffle_*.data"))}


def test_staged_leaves_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(FREE_SHUFFLES)
    stored = staged(spark.range(10_000).repartition(5, "id").groupBy((F.col("id") % 7).alias("k")).count(), "freed")
    assert sorted(r["count"] for r in stored.collect()) == [1428, 1428, 1428, 1429, 1429, 1429, 1429]
    assert shuffle_files(spark) <= before
    assert spark.conf.get(FREE_SHUFFLES) == setting


def test_mix_shuffles_texts_twice(spark):
    rows = spark.range(2000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"),
        F.concat(*[F.base64(F.unhex(F.sha2(F.concat("id", F.lit(f"-{i}")), 512))) for i in range(32)]).alias("text"),
    )
    stored = staged(rows, "documents", "none")
    size = sum(len(r["text"]) for r in stored.collect())
    before, limit = shuffle_files(spark), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables of some size
    mixed = corpus_pipeline.mix_sources(spark, stored, "").collect()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert sorted(r["doc_id"] for r in mixed) == [*range(2000)]
    # For the join with the positions and for the order; the numbering took two more before.
    written = sum(os.path.getsize(f) for f in shuffle_files(spark) - before)
    assert written < 2.5 * size
