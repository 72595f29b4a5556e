"""Session settings the wide credit tables want.  All are runtime settings of Spark SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Partition counts, join sides and skewed partitions are decided from observed sizes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM does not compile methods above 8000 bytes of bytecode.  Projections over a hundred
    # columns exceed that in one generated stage and would run interpreted; above the limit Spark
    # generates split projections instead (measured: 2-3 times faster on the application table).
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.codegen.maxFields": "300",
}


def tune(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark
