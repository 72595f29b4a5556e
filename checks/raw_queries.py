"""Registered queries over raw files: audit, load and the runs that keep events."""

from __future__ import annotations

import functools
from collections.abc import Callable, Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom import vocab
from creditloom.operators.bands import band_join
from creditloom.plans import bronze, bronze_run, insights, raw_audit, raw_run, refresh
from creditloom.sources import rules, storage
from creditloom.sources.events import read_events

from .inputs import Inputs, raw_text

RAW_SOURCES: dict[str, Callable[[Inputs], DataFrame]] = {
    "application_train": lambda t: t.train,
    "application_test": lambda t: t.test,
    **{n: (lambda t, n=n: t.view(n)) for n in (
        "bureau", "bureau_balance", "previous_application", "pos_cash_balance", "credit_card_balance",
        "installments_payments",
    )},
}
RAW_FILES = dict(vocab.RAW_FILES)


def raw_rows(t: Inputs, table: str) -> DataFrame:
    return raw_text(RAW_SOURCES[table](t), RAW_FILES[table])


def write_raw_files(
    t: Inputs, tables: Collection[str] = tuple(RAW_FILES), target: str | None = None, compression: str = "none"
) -> str:
    """The adapter views as the raw CSV file set, or the named files of it."""
    target = target or storage.scratch_path(t.spark, "raw")
    for table in tables:
        with storage.shuffles_freed(t.spark):
            raw_rows(t, table).write.csv(
                f"{target}/{RAW_FILES[table]}", header=True, escape='"', compression=compression
            )
    return target


def _write_lines(rows: DataFrame, path: str, damage: Callable[[Column], Column]) -> None:
    """CSV lines with a header in each part, every line changed by ``damage`` before it is stored."""
    line = damage(F.concat_ws(",", *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in rows.columns]))
    # The built-in id counts the rows of a partition in its lower 33 bits.
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    rows.select(F.when(first, F.concat(F.lit(",".join(rows.columns) + "\n"), line)).otherwise(line)).write.text(path)


def with_line_breaks(bureau: DataFrame) -> DataFrame:
    """Every seventh credit type holds a comma, quotes and two line breaks."""
    broken = F.concat(F.lit('of "'), F.col("credit_type"), F.lit('",\n\nsecond "line"'))
    return bureau.withColumn(
        "credit_type", F.when(F.col("sk_bureau_id") % 7 == 0, broken).otherwise(F.col("credit_type"))
    )


def _write_broken_bureau(t: Inputs, target: str) -> str:
    path = f"{target}/bureau.csv"
    raw_text(with_line_breaks(t.view("bureau")), "bureau.csv").write.csv(path, header=True, escape='"')
    return path


def write_damaged_files(t: Inputs) -> str:
    """Seven files, each of a kind: line breaks, short lines, bad bytes, a broken archive, plain ones."""
    target = write_raw_files(t, ("application_train", "previous_application", "installments_payments"))
    _write_broken_bureau(t, target)
    _write_lines(
        raw_rows(t, "pos_cash_balance"),
        f"{target}/POS_CASH_balance.csv",
        lambda line: F.when(F.col("MONTHS_BALANCE") == "-3", F.regexp_replace(line, ",[^,]*$", "")).otherwise(line),
    )
    bad = F.expr("CAST(X'FF' AS STRING)")
    _write_lines(
        raw_rows(t, "bureau_balance"),
        f"{target}/bureau_balance.csv",
        lambda line: F.when(F.col("MONTHS_BALANCE") == "-2", F.concat(line, bad)).otherwise(line),
    )
    raw_rows(t, "credit_card_balance").write.csv(
        f"{target}/credit_card_balance.csv", header=True, compression="gzip"
    )
    hadoop = t.spark.sparkContext._jvm.org.apache.hadoop.fs
    part = hadoop.Path(f"{target}/credit_card_balance.csv/part-x.csv.gz")
    out = part.getFileSystem(t.spark.sparkContext._jsc.hadoopConfiguration()).create(part)
    out.write(bytearray(b"\x1f\x8b\x08\x00no archive"))
    out.close()
    return target


def _shown(audited: DataFrame) -> DataFrame:
    return audited.select(
        "table_name", "file_name", "exists", "read_success", "validation_status", "row_count",
        "column_count", "inconsistent_rows", "has_line_breaks",
        F.array_join("column_names", ",").alias("column_names"),
        F.array_join("errors", ",").alias("errors"),
    )


def _reuse(t: Inputs) -> DataFrame:
    """Events of three audits: all files but one, nothing new, one file late and one grown."""
    late, warehouse = "installments_payments", storage.scratch_path(t.spark, "warehouse")
    target = write_raw_files(t, [n for n in RAW_FILES if n != late])
    runs = [raw_run.run_audit(t.spark, target, warehouse) for _ in range(2)]
    write_raw_files(t, [late], target)
    raw_rows(t, "bureau").write.mode("append").csv(f"{target}/bureau.csv", header=True, escape='"')
    runs.append(raw_run.run_audit(t.spark, target, warehouse))
    number = F.create_map(*[F.lit(x) for n, run in enumerate(runs, 1) for x in (run.run_id, n)])
    counts = F.from_json("details_json", "table_count_skipped_cached_validation long, table_count_missing long")
    return read_events(t.spark, warehouse).select(
        number[F.col("run_id")].alias("run"), "entity_type", "entity_name", "status", "row_count", "column_count",
        "used_cached_result", counts["table_count_skipped_cached_validation"].alias("skipped"),
        counts["table_count_missing"].alias("missing"),
    )


def _schema_evaluation(t: Inputs) -> DataFrame:
    audited = raw_audit.audit_files(t.spark, write_raw_files(t)).where("exists")
    actual = audited.select("file_name", F.explode("column_names").alias("column_name"))
    expected = bronze.expected_columns(t.spark, rules.default_column_rules())
    report = bronze.schema_evaluation(actual, expected, bronze.required_columns(t.spark))
    listed = [f.name for f in report.schema.fields if isinstance(f.dataType, T.ArrayType)]
    return report.withColumns({c: F.array_join(c, ",") for c in listed})


def _loaded(t: Inputs, path: str, file: str) -> DataFrame:
    raw = bronze.read_raw_csv(t.spark, path)
    plan = bronze.plan_table(raw, file, rules.default_column_rules())
    bronze.require_no_nulls(plan)
    return bronze.standardise(raw, plan)


def _csv_to_bronze(table: str) -> Callable[[Inputs], DataFrame]:
    file = RAW_FILES[table]
    return lambda t: _loaded(t, f"{write_raw_files(t, [table])}/{file}", file)


def _csv_to_bronze_damaged(t: Inputs) -> DataFrame:
    """The bureau file whose records run over line ends, without an audit before."""
    return _loaded(t, _write_broken_bureau(t, storage.scratch_path(t.spark, "raw")), "bureau.csv")


def _rule_file(t: Inputs, rows: list[tuple], columns: str) -> str:
    path = storage.scratch_path(t.spark, "rules")
    t.spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns.split())).coalesce(1).write.csv(path, header=True)
    return path


def column_rules_from_files(t: Inputs) -> rules.ColumnRules:
    """The rules of the load by way of the three files that they are kept in."""
    given = rules.default_column_rules()
    schema = []
    for (file, source), kind in given.types.items():
        reference, name = given.renames.get((file, source), (source, bronze.snake_case(source)))
        nullable = "YES" if given.nullable[file, source] else "NO"
        schema.append((file, source, reference, name, kind, nullable))
    renames = [(f, raw, ref, name, None, None) for f, raw, ref, name in vocab.RENAMES]
    sentinels = [(f, c, old, new or "NULL", "true", None) for f, c, old, new in vocab.SENTINEL_RULES]
    return rules.load_column_rules(
        t.spark,
        _rule_file(t, schema, "file_name source_column reference_column bronze_column bronze_type bronze_nullable"),
        _rule_file(t, renames, "file_name source_column reference_column bronze_column bronze_type notes"),
        _rule_file(t, sentinels, "file_name source_column sentinel_sql replacement_sql is_active notes"),
    )


def _band_join_loaded(t: Inputs) -> DataFrame:
    """Score and income bands by rules that come from a file."""
    path = storage.scratch_path(t.spark, "band-rules")
    t.band_rules.coalesce(1).write.csv(path, header=True)
    loaded = rules.load_band_rules(t.spark, path)
    df = t.applications.select("sk_id_curr", "ext_source_mean", "amt_income_total")
    df = band_join(df, loaded, "score_band", "ext_source_mean", "score_band")
    return band_join(df, loaded, "income_band", "amt_income_total", "income_band").select(
        "sk_id_curr", "score_band", "income_band"
    )


def _bronze_refresh(t: Inputs) -> DataFrame:
    """Events of two bronze runs over audited files: one file is ragged, one breaks a NOT NULL rule."""
    warehouse = storage.scratch_path(t.spark, "warehouse")
    target = write_raw_files(t, [n for n in RAW_FILES if n not in ("pos_cash_balance", "credit_card_balance")])
    keyless = F.when(F.col("MONTHS_BALANCE") == "-3", F.lit(None)).otherwise(F.col("SK_ID_PREV"))
    raw_rows(t, "pos_cash_balance").withColumn("SK_ID_PREV", keyless).write.csv(
        f"{target}/POS_CASH_balance.csv", header=True, escape='"'
    )
    _write_lines(
        raw_rows(t, "credit_card_balance"), f"{target}/credit_card_balance.csv", lambda line: F.concat(line, F.lit(","))
    )
    raw_run.run_audit(t.spark, target, warehouse)
    for _ in range(2):
        bronze_run.build_bronze(t.spark, target, warehouse, column_rules_from_files(t))
    stored = functools.reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("stored_rows")).withColumn("entity_name", F.lit(name.split(".")[1]))
        for name, df in refresh.published_tables(t.spark, warehouse).items()
    ])
    events = read_events(t.spark, warehouse).where("layer = 'bronze' AND entity_type = 'table'")
    details = F.from_json("details_json", "validation_warnings array<string>, sentinel_columns array<string>")
    rule = F.regexp_extract("error_message", "(raw_file_invalid|bronze_non_nullable_validation_failed)", 1)
    return events.join(stored, "entity_name", "left").select(
        "entity_name", "status", "row_count", "column_count", "used_cached_result", "stored_rows",
        F.array_join(details["validation_warnings"], ",").alias("warnings"),
        F.array_join(details["sentinel_columns"], ",").alias("sentinels"),
        rule.alias("error"),
    )


def _raw_to_star(t: Inputs) -> DataFrame:
    """From CSV files to a report: audit, bronze, silver, gold, each read as the last one published it.

    The report reads the gold views.  The raw files are compressed, one part per task that wrote it, and
    go when the bronze layer has been loaded from them.
    """
    warehouse, target = storage.scratch_path(t.spark, "warehouse"), write_raw_files(t, compression="gzip")
    raw_run.run_audit(t.spark, target, warehouse)
    bronze_run.build_bronze(t.spark, target, warehouse)
    storage.remove(t.spark, target)
    refresh.build_layers(t.spark, warehouse, {})
    refresh.register_gold_views(t.spark, warehouse)
    star = insights.Star(*map(t.spark.table, ("fact_credit_risk", "dim_requester", "dim_risk_segment")))
    return insights.dti_lift(star.base(insights.REPORT_COLUMNS["dti_lift"]))


QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {
    "csv_to_bronze": _csv_to_bronze("bureau"),
    **{f"csv_to_bronze_{n}": _csv_to_bronze(n) for n in RAW_FILES if n != "bureau"},
    "csv_to_bronze_damaged": _csv_to_bronze_damaged,
    "band_join_loaded": _band_join_loaded,
    "bronze_refresh": _bronze_refresh,
    "raw_to_star": _raw_to_star,
    "schema_evaluation": _schema_evaluation,
    "raw_audit_files": lambda t: _shown(raw_audit.audit_files(t.spark, write_raw_files(t))),
    "raw_audit_damaged": lambda t: _shown(raw_audit.audit_files(t.spark, write_damaged_files(t))),
    "raw_audit_rollup": lambda t: raw_audit.audit_rollup(raw_audit.audit_files(t.spark, write_damaged_files(t))),
    "raw_audit_reuse": _reuse,
}
