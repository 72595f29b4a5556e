"""Rule-driven banding of a numeric value.

Two equal forms over the same rules: a broadcast range join, for rules that live in a table, and
a ``when`` chain, which keeps a wide projection free of joins.  Bounds are ``lower <= v < upper``;
an absent bound is open; the null band takes NULL only.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..functions.rows import literal, quoted

MAX_RULES = 1000


def collect_rules(rules: DataFrame, limit: int = MAX_RULES) -> list[Row]:
    """Bring a rule table to the driver after proving that it is small.

    Band rules are hand-kept configuration; a table above the limit is a wrong input and raises.
    """
    rows = rules.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"band rule table holds more than {limit} rules")
    return sorted(rows, key=lambda r: (r.band_group, r.band_order))


def check_rules(rows: Iterable[Row]) -> None:
    """Raise unless the bands of every group are disjoint, so that a value has one label."""
    groups: dict[str, list[Row]] = {}
    for r in rows:
        groups.setdefault(r.band_group, []).append(r)
    for group, members in groups.items():
        if sum(r.is_null_band for r in members) > 1:
            raise ValueError(f"{group}: more than one null band")
        spans = sorted(
            (
                float("-inf") if r.lower_bound is None else r.lower_bound,
                float("inf") if r.upper_bound is None else r.upper_bound,
            )
            for r in members
            if not r.is_null_band
        )
        for (_, end), (start, _) in zip(spans, spans[1:]):
            if start < end:
                raise ValueError(f"{group}: overlapping bands")


def band_label(value: str, rows: Iterable[Row], group: str) -> Column:
    """Label of the column ``value`` by the rules of one group, as a single expression."""
    members = [r for r in rows if r.band_group == group]
    if not members:
        raise ValueError(f"no band rules for {group}")
    v, arms = quoted(value), []
    for r in members:
        if r.is_null_band:
            hit = f"{v} IS NULL"
        else:
            bounds = [f"{v} IS NOT NULL"]
            if r.lower_bound is not None:
                bounds.append(f"{v} >= {float(r.lower_bound)!r}D")
            if r.upper_bound is not None:
                bounds.append(f"{v} < {float(r.upper_bound)!r}D")
            hit = " AND ".join(bounds)
        arms.append(f"WHEN {hit} THEN {literal(r.band_label)}")
    return F.expr(f"CASE {' '.join(arms)} END")


def band_join(df: DataFrame, rules: DataFrame, group: str, value: str, label: str) -> DataFrame:
    """Left range join of ``df`` with the rules of one group; adds ``label``.

    The rule side is broadcast only after ``collect_rules`` has bounded it.
    """
    rows = [r for r in collect_rules(rules) if r.band_group == group]
    bounds = df.sparkSession.createDataFrame(
        [(r.band_label, r.lower_bound, r.upper_bound, r.is_null_band) for r in rows],
        "rule_label string, rule_lower double, rule_upper double, rule_null boolean",
    )
    v = F.col(value)
    in_range = (
        v.isNotNull()
        & ~F.col("rule_null")
        & (F.col("rule_lower").isNull() | (v >= F.col("rule_lower")))
        & (F.col("rule_upper").isNull() | (v < F.col("rule_upper")))
    )
    matches = (v.isNull() & F.col("rule_null")) | in_range
    joined = df.join(F.broadcast(bounds), matches, "left")
    return joined.select(*[df[c] for c in df.columns], F.col("rule_label").alias(label))
