"""Row-level column builders.  Nothing here shuffles; every function returns a Column.

Builders over many columns hand Spark one SQL expression text instead of a tree of column calls:
the plan is the same and building it stays cheap for tables of well over a hundred columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(column: str) -> str:
    return f"`{column}`"


def literal(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _added(columns: Sequence[str], term: str) -> str:
    return " + ".join(term.format(quoted(c)) for c in columns)


def label_or(column: str, default: str) -> Column:
    """The text, or ``default`` where it is NULL."""
    return F.coalesce(F.col(column), F.lit(default))


def years_from_days(column: str, days_per_year: float) -> Column:
    """Signed day offset as a positive number of years (double division on purpose)."""
    return F.abs(F.col(column)) / F.lit(days_per_year)


def code_flags(flags: Mapping[str, tuple[str, str]]) -> dict[str, Column]:
    """``flag -> (column, code)`` as three-valued equality flags."""
    return {
        flag: F.expr(f"{quoted(column)} = {literal(code)}")
        for flag, (column, code) in flags.items()
    }


def one_hot(encodings: Mapping[str, Mapping[str, str]]) -> dict[str, Column]:
    """``column -> {code: flag}`` as one equality flag per code; NULL stays NULL."""
    return code_flags(
        {flag: (column, code) for column, codes in encodings.items() for code, flag in codes.items()}
    )


def ratio_if_positive(numerator: str, denominator: str) -> Column:
    """Ratio where the denominator is above zero, else NULL."""
    n, d = quoted(numerator), quoted(denominator)
    return F.expr(f"if({d} > 0, try_divide({n}, {d}), NULL)")


def ratio_or_null(numerator: str, denominator: str) -> Column:
    """Ratio with a NULL result for a zero denominator; negative denominators are used."""
    return F.try_divide(F.col(numerator), F.col(denominator))


def ieee_divide(numerator: Column, denominator: Column) -> Column:
    """Floating-point division by the IEEE rules instead of an ANSI error on zero.

    x/0 is signed infinity, 0/0 is NaN, and NULL on either side stays NULL.
    """
    n, d = numerator.cast("double"), denominator.cast("double")
    by_zero = (
        F.when(F.isnan(n) | (n == 0), F.lit(float("nan")))
        .when(n > 0, F.lit(float("inf")))
        .when(n < 0, F.lit(float("-inf")))
    )
    return F.when(d == 0, by_zero).otherwise(F.try_divide(n, d))


def present_count(columns: Sequence[str]) -> Column:
    """How many of the columns hold a value."""
    return F.expr(_added(columns, "int({0} IS NOT NULL)"))


def missing_count(columns: Sequence[str]) -> Column:
    return F.expr(_added(columns, "int({0} IS NULL)"))


def true_count(columns: Sequence[str]) -> Column:
    """How many of the boolean columns are true; NULL counts as not set."""
    return F.expr(_added(columns, "int(coalesce({0}, false))"))


def share_of(count: Column, size: int) -> Column:
    return count / F.lit(float(size))


def row_sum(columns: Sequence[str]) -> Column:
    """Sum over the present values, NULL when none is present."""
    present = ", ".join(quoted(c) for c in columns)
    return F.expr(f"if(coalesce({present}) IS NOT NULL, {_added(columns, 'coalesce({0}, 0D)')}, NULL)")


def row_mean(columns: Sequence[str]) -> Column:
    """Mean over the present values, NULL when none is present."""
    filled, count = _added(columns, "coalesce({0}, 0D)"), _added(columns, "int({0} IS NOT NULL)")
    return F.expr(f"try_divide({filled}, double({count}))")


def any_positive(columns: Sequence[str]) -> Column:
    """Three-state flag: NULL without any value, else whether the sum is above zero."""
    return row_sum(columns) > 0


def excess(left: str, right: str) -> Column:
    """``left - right`` clamped at zero; zero too when either side is NULL."""
    return F.greatest(F.col(left) - F.col(right), F.lit(0.0))


def is_true(column: str) -> Column:
    """Flag with NULL read as false."""
    return F.coalesce(F.col(column), F.lit(False))


def mean_of_rates(columns: Sequence[str]) -> Column:
    """Plain mean of rates with NULL read as zero."""
    return share_of(F.expr(_added(columns, "coalesce({0}, 0D)")), len(columns))


def relabel(column: str, labels: Mapping[str, str], keep_others: bool) -> Column:
    """Replace codes by labels; other codes are kept or become NULL."""
    source = F.col(column)
    chain = None
    for code, label in labels.items():
        hit = source == F.lit(code)
        chain = F.when(hit, F.lit(label)) if chain is None else chain.when(hit, F.lit(label))
    return chain.otherwise(source) if keep_others else chain
