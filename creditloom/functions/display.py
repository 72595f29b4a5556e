"""Text forms of numbers for reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import vocab

# Texts and scales of the report formats
ABSENT, CURRENCY, TIMES = "-", "R$ ", "x"
BILLION, MILLION = 1_000_000_000.0, 1_000_000.0


def _fixed(value: Column, digits: int) -> Column:
    """Fixed-point text without group separators (half-even on the exact binary value)."""
    return F.regexp_replace(F.format_number(value, digits), ",", "")


def human_number(value: Column) -> Column:
    v = value.cast("double")
    return (
        F.when(v.isNull(), F.lit(ABSENT))
        .when(v >= BILLION, F.concat(_fixed(v / F.lit(BILLION), 1), F.lit("B")))
        .when(v >= MILLION, F.concat(_fixed(v / F.lit(MILLION), 1), F.lit("M")))
        .otherwise(F.format_number(v, 0))
    )


def human_currency(value: Column) -> Column:
    return F.when(value.isNull(), F.lit(ABSENT)).otherwise(
        F.concat(F.lit(CURRENCY), human_number(value))
    )


def human_percent(value: Column) -> Column:
    v = value.cast("double")
    return F.when(v.isNull(), F.lit(ABSENT)).otherwise(
        F.concat(_fixed(v * F.lit(100.0), 2), F.lit("%"))
    )


def lift_label(lift: Column) -> Column:
    return F.concat(F.coalesce(_fixed(lift, 1), F.lit("nan")), F.lit(TIMES))


def risk_bucket(lift: Column) -> Column:
    return (
        F.when(lift >= vocab.RISK_HIGH_LIFT, F.lit(vocab.RISK_HIGH))
        .when(lift <= vocab.RISK_LOW_LIFT, F.lit(vocab.RISK_LOW))
        .otherwise(F.lit(vocab.RISK_NEAR))
    )
