"""Aggregate column builders.

All of them are algebraic (sum, count, min, max, moments), so Spark combines on the map side and
one very frequent key costs one partial row per task, not one huge group.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rows import ieee_divide, quoted


def rows() -> Column:
    return F.count(F.lit(1))


def any_true(flag: str) -> Column:
    """True if any row is; NULLs are ignored, NULL if there is nothing else."""
    return F.bool_or(flag)


def true_rows(flag: str) -> Column:
    """Number of true rows as a sum: NULLs are ignored, NULL if there is nothing else."""
    return F.expr(f"sum(bigint({quoted(flag)}))")


def tally(condition: str) -> Column:
    """Number of rows that satisfy the condition; NULL counts as no, the result is never NULL."""
    return F.expr(f"count_if({condition})")


def share(condition: str) -> Column:
    """Share of rows that satisfy the condition; NULL counts as no."""
    return F.expr(f"avg(double(coalesce({condition}, false)))")


def ratio_of_sums(numerator: str, denominator: str) -> Column:
    """sum/sum by IEEE rules, for the roll-ups that do not guard their denominator."""
    return ieee_divide(F.sum(numerator), F.sum(denominator))


def ratio_of_positive_sums(numerator: str, denominator: str) -> Column:
    """sum/sum where the denominator's sum is above zero, else NULL."""
    total = F.sum(denominator)
    return F.when(total > 0, F.try_divide(F.sum(numerator), total))


def default_rate(target: str = "target") -> Column:
    """Mean of a boolean label over the labelled rows."""
    return F.expr(f"avg(int({quoted(target)}))")


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson correlation over rows where both sides are present.

    A constant side gives NULL; the built-in aggregate raises a division error under ANSI mode.
    """
    x, y = x.cast("double"), y.cast("double")
    both = x.isNotNull() & y.isNotNull()
    return F.try_divide(
        F.covar_pop(x, y),
        F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y)),
    )
