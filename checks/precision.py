"""Stable text of doubles for comparing two engines.

Sums of doubles depend on their order in the last digits.  Both sides are rounded, 2 digits from
1000 up and 6 below.  A small shift keeps the rounding boundary away from the exact halves that
averages of amounts in cents fall on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

LARGE = 1000.0
LARGE_DIGITS, LARGE_SHIFT = 2, 0.000137
SMALL_DIGITS, SMALL_SHIFT = 6, 0.0000000137


def settle(df: DataFrame) -> DataFrame:
    """Round every double column."""

    def item(field: T.StructField) -> str:
        x = f"`{field.name}`"
        if not isinstance(field.dataType, T.DoubleType):
            return x
        large = f"round({x} + {LARGE_SHIFT:.6f}D, {LARGE_DIGITS})"
        small = f"round({x} + {SMALL_SHIFT:.10f}D, {SMALL_DIGITS})"
        return f"if(abs({x}) >= {LARGE}D, {large}, {small}) + 0D AS {x}"

    return df.selectExpr(*[item(f) for f in df.schema.fields])


def settle_sql(sql: str, doubles: list[str], others: bool = True) -> str:
    """The same rounding around a SQL query; ``doubles`` names its double columns."""
    names = ", ".join("'" + d.replace("'", "''") + "'" for d in doubles)
    pick = f"COLUMNS(lambda c: c IN ({names}))"
    rest = f"COLUMNS(lambda c: c NOT IN ({names})), " if others else ""
    return (
        f"SELECT {rest}list_transform([{pick}], lambda x: CASE WHEN abs(x) >= {LARGE} "
        f"THEN round(x + {LARGE_SHIFT:.6f}e0, {LARGE_DIGITS}) "
        f"ELSE round(x + {SMALL_SHIFT:.10f}e0, {SMALL_DIGITS}) END + 0.0e0)[1] FROM ({sql})"
    )
