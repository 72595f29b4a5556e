"""Left join of a table with a roll-up that is unique on the key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def attach(
    left: DataFrame,
    rollup: DataFrame,
    key: str,
    missing_flag: str | None = None,
    hot_keys: Sequence | None = None,
    salts: int = 64,
) -> DataFrame:
    """Left join on ``key``; ``missing_flag`` marks rows of ``left`` without a match.

    The roll-up has one row per key, so rows never multiply.  ``hot_keys`` (see ``hot_keys``
    below) lists keys so frequent in ``left`` that one task could not hold them: their rows are
    spread over ``salts`` sub-keys and only the few matching roll-up rows are copied.
    """
    right = rollup
    if missing_flag is not None:
        right = right.withColumn(missing_flag, F.lit(False))
    if hot_keys:
        hot = F.col(key).isin(list(hot_keys))
        left = left.withColumn(
            "__salt",
            F.when(hot, F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int")).otherwise(0),
        )
        copies = F.when(hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        right = right.withColumn("__salt", F.explode(copies))
        joined = left.join(right, [key, "__salt"], "left").drop("__salt")
    else:
        joined = left.join(right, key, "left")
    if missing_flag is not None:
        joined = joined.withColumn(missing_flag, F.coalesce(missing_flag, F.lit(True)))
    return joined


def hot_keys(df: DataFrame, key: str, share: float = 0.01) -> list:
    """Keys that hold more than ``share`` of the rows of ``df``.

    At most ``1 / share`` keys can qualify, so the result is bounded whatever the data.  Counting
    combines on the map side and reads the key column only.
    """
    counts = df.groupBy(key).count()
    total = df.count()
    frequent = counts.where((F.col("count") > total * share) & F.col(key).isNotNull())
    return [r[key] for r in frequent.select(key).collect()]
