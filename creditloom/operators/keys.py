"""Dense surrogate keys 1..n in key order without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

# Ranges of the key: FINE holds at most 2^16 different keys, COARSE at most 2^24 FINE ranges.
FINE_BITS, COARSE_BITS = 16, 40
_INTEGRAL = ("tinyint", "smallint", "int", "bigint")
_KEY, _FINE, _COARSE, _RANK = "__key", "__fine", "__coarse", "__rank"


def require_unique(df: DataFrame, key: str) -> None:
    """Raise if a key value occurs twice; the check stops at the first few offenders."""
    offenders = df.groupBy(key).count().where(F.col("count") > 1).limit(5).collect()
    if offenders:
        shown = ", ".join(str(r[key]) for r in offenders)
        raise ValueError(f"{key} is not unique: {shown}")


def key_ranks(df: DataFrame, key: str) -> DataFrame:
    """(key, rank) for the distinct keys of a column that holds none twice; a second one is an error.

    Only the key column is read.  Its values are counted per range of values, the counts are added up
    over the ranges, and a row's place inside its range is added to that.  Ranges are made of the bits
    of the key, so a retried task numbers as before and nothing has to be stored, sampled or collected;
    a window sees at most 2^24 rows, whatever the keys are.
    """
    kind = df.schema[key].dataType.simpleString()
    if kind not in _INTEGRAL:
        raise TypeError(f"{key} must be integral, not {kind}")
    ids = df.select(F.col(key).cast("long").alias(_KEY)).where(F.col(_KEY).isNotNull()).select(
        _KEY, F.shiftright(_KEY, FINE_BITS).alias(_FINE)
    )
    fine = ids.groupBy(_FINE).agg(F.count(F.lit(1)).alias("__n")).withColumn(
        _COARSE, F.shiftright(_FINE, COARSE_BITS - FINE_BITS)
    )

    def before(window: WindowSpec) -> Column:
        return F.coalesce(F.sum("__n").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    coarse = fine.groupBy(_COARSE).agg(F.sum("__n").alias("__n")).select(
        _COARSE, before(Window.orderBy(_COARSE)).alias("__base")
    )
    starts = fine.withColumn("__inner", before(Window.partitionBy(_COARSE).orderBy(_FINE))).join(coarse, _COARSE)
    starts = starts.select(_FINE, (F.col("__base") + F.col("__inner")).alias("__start"))
    inside = Window.partitionBy(_FINE).orderBy(_KEY)
    numbered = ids.select("*", F.row_number().over(inside).alias("__pos"), F.lag(_KEY).over(inside).alias("__last"))
    twice = F.raise_error(F.concat(F.lit(f"{key} is not unique: "), F.col(_KEY).cast("string"))).cast("long")
    rank = F.when(F.col("__last") == F.col(_KEY), twice).otherwise(F.col("__start") + F.col("__pos"))
    return numbered.join(starts, _FINE).select(_KEY, rank.alias(_RANK))


def dense_key(df: DataFrame, key: str, name: str) -> DataFrame:
    """Add ``name`` = position of the row in the order of ``key``, from 1 to the row count.

    Rows meet their number on ``key``, the key that the joins of a star use as well, so wide rows
    take no shuffle of their own.  A NULL key has no number.
    """
    ranks = key_ranks(df, key)
    return df.join(ranks, F.col(key) == F.col(_KEY), "left").select(*df.columns, F.col(_RANK).alias(name))
