"""Typed loads of the hand-kept rule tables (bands, renames, sentinels, input schema)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession

from .. import vocab
from ..operators.bands import check_rules, collect_rules

BAND_SCHEMA = (
    "band_group string, source_column string, band_order int, band_label string, "
    "lower_bound double, upper_bound double, lower_inclusive boolean, upper_inclusive boolean, "
    "is_null_band boolean, description string"
)
MAX_COLUMN_RULES = 10_000


def default_band_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(vocab.BAND_RULES, BAND_SCHEMA)


def load_band_rules(spark: SparkSession, path: str) -> DataFrame:
    """Band rules from a CSV file; an empty bound is open."""
    return spark.read.schema(BAND_SCHEMA).csv(path, header=True, mode="FAILFAST")


def band_rows(rules: DataFrame) -> list[Row]:
    """Rules as checked driver rows, for ``band_label``."""
    found = collect_rules(rules)
    check_rules(found)
    return found


def default_band_rows() -> list[Row]:
    names = [part.split()[0] for part in BAND_SCHEMA.split(", ")]
    found = [Row(**dict(zip(names, rule))) for rule in vocab.BAND_RULES]
    check_rules(found)
    return found


@dataclass(frozen=True)
class ColumnRules:
    """Everything the bronze job needs to know about the columns of the raw files."""

    types: dict[tuple[str, str], str]
    nullable: dict[tuple[str, str], bool]
    renames: dict[tuple[str, str], tuple[str, str]]
    sentinels: dict[tuple[str, str], list[tuple[str, str | None]]]
    expected: dict[str, list[str]] = field(default_factory=dict)


def _last_rule_wins(rules, all_rules: bool) -> dict:
    """Sentinel rules by (file, column); by default a later rule for a column replaces it."""
    chosen: dict[tuple[str, str], list[tuple[str, str | None]]] = {}
    for file, column, sentinel, replacement in rules:
        earlier = chosen.get((file, column), []) if all_rules else []
        chosen[(file, column)] = earlier + [(sentinel, replacement)]
    return chosen


def _strip_quotes(text: str | None) -> str | None:
    return text[1:-1] if text and len(text) > 1 and text[0] == text[-1] == "'" else text


def _clean(rules, unquote: bool):
    if not unquote:
        return rules
    return [(f, c, _strip_quotes(s), _strip_quotes(r)) for f, c, s, r in rules]


def default_column_rules(all_sentinels: bool = False, unquote: bool = False) -> ColumnRules:
    """Built-in rules.

    ``all_sentinels`` keeps every sentinel of a column instead of the last one; ``unquote`` drops
    literal quotes around sentinels.  Both are off because the published results come without.
    """
    raw_names = {(f, bronze): raw for f, raw, _, bronze in vocab.RENAMES}
    types, nullable, expected = {}, {}, {}
    for file, kinds in vocab.INPUT_SCHEMA.items():
        for kind, columns in kinds.items():
            for bronze in columns:
                raw = raw_names.get((file, bronze), bronze.upper())
                types[(file, raw)] = kind
                nullable[(file, raw)] = not raw.startswith("SK_ID_")
                expected.setdefault(file, []).append(raw)
    return ColumnRules(
        types=types,
        nullable=nullable,
        renames={(f, raw): (ref, bronze) for f, raw, ref, bronze in vocab.RENAMES},
        sentinels=_last_rule_wins(_clean(vocab.SENTINEL_RULES, unquote), all_sentinels),
        expected=expected,
    )


def load_column_rules(
    spark: SparkSession,
    schema_path: str,
    rename_path: str,
    sentinel_path: str,
    all_sentinels: bool = False,
    unquote: bool = False,
) -> ColumnRules:
    """Rules from three CSV files; each is bounded before it is collected."""

    def rows(path: str, schema: str) -> list[Row]:
        table = spark.read.schema(schema).csv(
            path,
            header=True,
            mode="FAILFAST",
            ignoreLeadingWhiteSpace=True,
            ignoreTrailingWhiteSpace=True,
        )
        found = table.limit(MAX_COLUMN_RULES + 1).collect()
        if len(found) > MAX_COLUMN_RULES:
            raise ValueError(f"{path} holds more than {MAX_COLUMN_RULES} rules")
        return found

    schema_rows = rows(
        schema_path,
        "file_name string, source_column string, reference_column string, "
        "bronze_column string, bronze_type string, bronze_nullable string",
    )
    rename_rows = rows(
        rename_path,
        "file_name string, source_column string, reference_column string, "
        "bronze_column string, bronze_type string, notes string",
    )
    sentinel_rows = rows(
        sentinel_path,
        "file_name string, source_column string, sentinel_sql string, "
        "replacement_sql string, is_active string, notes string",
    )
    active = [
        (
            r.file_name,
            r.source_column,
            r.sentinel_sql,
            None if (r.replacement_sql or "NULL").upper() == "NULL" else r.replacement_sql,
        )
        for r in sentinel_rows
        if (r.is_active or "").lower() == "true"
    ]
    expected: dict[str, list[str]] = {}
    for r in schema_rows:
        expected.setdefault(r.file_name, []).append(r.source_column)
    return ColumnRules(
        types={
            (r.file_name, r.source_column): r.bronze_type.upper()
            for r in schema_rows
            if r.bronze_type
        },
        nullable={
            (r.file_name, r.source_column): (r.bronze_nullable or "YES").upper() != "NO"
            for r in schema_rows
        },
        renames={
            (r.file_name, r.source_column): (
                r.reference_column or r.source_column,
                r.bronze_column or r.source_column.lower(),
            )
            for r in rename_rows
        },
        sentinels=_last_rule_wins(_clean(active, unquote), all_sentinels),
        expected=expected,
    )
