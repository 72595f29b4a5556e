"""Checking SQL of the raw-file queries: what the audit and the load of the written files must find."""

from __future__ import annotations

from creditloom import vocab
from creditloom.sources import adapter, rules

from .inputs import RAW_NAMES

_APPLICATION_COLUMNS = [c for c in adapter.VIEWS["applications"][1] if c != "flag_test"]
_TEST_COLUMNS = [c for c in _APPLICATION_COLUMNS if c != "target"]
TRAIN = f"(SELECT {', '.join(_APPLICATION_COLUMNS)} FROM applications WHERE NOT flag_test)"
TEST = f"(SELECT {', '.join(_TEST_COLUMNS)} FROM applications WHERE flag_test)"
# Table -> the rows written to its file, and their columns
WRITTEN = {
    "application_train": (TRAIN, _APPLICATION_COLUMNS),
    "application_test": (TEST, _TEST_COLUMNS),
    **{
        name: (name, list(adapter.VIEWS[name][1]))
        for name in (
            "bureau", "bureau_balance", "previous_application", "pos_cash_balance", "credit_card_balance",
            "installments_payments",
        )
    },
}
BRONZE_PREVIOUS = (
    "SELECT * REPLACE (nullif(days_first_drawing, 365243) AS days_first_drawing, "
    "if(name_cash_loan_purpose = 'XPA', 'Not Applicable', name_cash_loan_purpose) "
    "AS name_cash_loan_purpose, "
    "if(name_payment_type = 'XNA', 'Unknown', name_payment_type) AS name_payment_type, "
    "if(name_goods_category = 'XNA', 'Unknown', name_goods_category) AS name_goods_category) "
    "FROM previous_application"
)
# Sentinel rules in force and the rows they match
_SENTINELS = {
    "application_train": {"DAYS_EMPLOYED": "days_employed IS NULL"},
    "application_test": {"DAYS_EMPLOYED": "days_employed IS NULL"},
    "previous_application": {
        "NAME_CASH_LOAN_PURPOSE": "name_cash_loan_purpose = 'XPA'",
        "NAME_PAYMENT_TYPE": "name_payment_type = 'XNA'",
        "NAME_CLIENT_TYPE": "name_client_type = '''XNA'''",
        "NAME_GOODS_CATEGORY": "name_goods_category = 'XNA'",
        "DAYS_FIRST_DRAWING": "days_first_drawing = 365243",
    },
}


def raw_names(file: str, columns: list[str]) -> list[str]:
    return [RAW_NAMES.get((file, c), c.upper()) for c in columns]


def _audit_row(
    table: str, file: str, status: str = "valid", errors: str = "", ragged: str = "0", breaks: str = "false"
) -> str:
    """An audited file.  A damage that depends on the rows counts only where such rows exist."""
    source, columns = WRITTEN[table]
    found = "true" if ragged == "0" else f"{ragged} > 0"
    readable = "false" if errors == "encoding_error" else "true"
    return (
        f"SELECT '{table}' AS table_name, '{file}' AS file_name, true AS exists, {readable} AS read_success, "
        f"if({found}, '{status}', 'valid') AS validation_status, count(*) AS row_count, {len(columns)} AS column_count, "
        f"CAST({ragged} AS BIGINT) AS inconsistent_rows, {breaks} AS has_line_breaks, "
        f"'{','.join(raw_names(file, columns))}' AS column_names, if({found}, '{errors}', '') AS errors FROM {source}"
    )


def _no_audit(table: str, file: str, exists: str, status: str, error: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{file}' AS file_name, {exists} AS exists, false AS read_success, "
        f"'{status}' AS validation_status, CAST(0 AS BIGINT) AS row_count, 0 AS column_count, "
        f"CAST(0 AS BIGINT) AS inconsistent_rows, false AS has_line_breaks, '' AS column_names, '{error}' AS errors"
    )


def _audited() -> str:
    return " UNION ALL ".join(_audit_row(table, file) for table, file in vocab.RAW_FILES)


def _damaged() -> str:
    """Short lines in the third months, bad bytes in the second, a part that is no archive, a file missing."""
    parts = []
    for table, file in vocab.RAW_FILES:
        if table == "application_test":
            parts.append(_no_audit(table, file, "false", "missing", "file_not_found"))
        elif table == "credit_card_balance":
            parts.append(_no_audit(table, file, "true", "invalid", "read_error:EOFException"))
        elif table == "bureau":
            parts.append(_audit_row(table, file, breaks="coalesce(bool_or(sk_bureau_id % 7 = 0), false)"))
        elif table == "pos_cash_balance":
            short = "count(*) FILTER (months_balance = -3)"
            parts.append(_audit_row(table, file, "invalid", "inconsistent_row_length", short))
        elif table == "bureau_balance":
            parts.append(_audit_row(table, file, "invalid", "encoding_error"))
        else:
            parts.append(_audit_row(table, file))
    return " UNION ALL ".join(parts)


def _rollup() -> str:
    return (
        "SELECT count(*) AS table_count_expected, count(*) FILTER (exists) AS table_count_found, "
        "count(*) FILTER (read_success) AS table_count_read_success, "
        "count(*) FILTER (validation_status = 'valid') AS table_count_validation_passed, "
        "count(*) FILTER (validation_status = 'invalid') AS table_count_validation_failed, "
        "count(*) FILTER (validation_status = 'missing') AS table_count_missing, "
        "CAST(0 AS BIGINT) AS table_count_skipped_cached_validation, "
        "if(count(*) FILTER (validation_status <> 'valid') > 0, 'partial_failure', 'success') AS run_status "
        f"FROM ({_damaged()})"
    )


def _reuse() -> str:
    """Files as counted or reused by each of three runs, and the counters of the runs."""
    parts = []
    for run, skipped, missing in ((1, 0, 1), (2, 7, 1), (3, 6, 0)):
        for table, _ in vocab.RAW_FILES:
            source, columns = WRITTEN[table]
            absent = table == "installments_payments" and run < 3
            grown = table == "bureau" and run == 3
            read = run == 1 or grown or table == "installments_payments"
            rows = "0 * count(*)" if absent else "2 * count(*)" if grown else "count(*)"
            parts.append(
                f"SELECT {run} AS run, 'file' AS entity_type, '{table}' AS entity_name, "
                f"'{'missing' if absent else 'valid'}' AS status, CAST({rows} AS BIGINT) AS row_count, "
                f"{0 if absent else len(columns)} AS column_count, {str(not read).lower()} AS used_cached_result, "
                f"CAST(NULL AS BIGINT) AS skipped, CAST(NULL AS BIGINT) AS missing FROM {source}"
            )
        status = "partial_failure" if missing else "success"
        parts.append(
            f"SELECT {run}, 'run', 'raw_validation', '{status}', CAST(NULL AS BIGINT), CAST(NULL AS INTEGER), false, "
            f"CAST({skipped} AS BIGINT), CAST({missing} AS BIGINT)"
        )
    return " UNION ALL ".join(parts)


def _bronze_refresh() -> str:
    """Per run and table: loaded, then kept; the two damaged files fail both times."""
    failures = {"credit_card_balance": "raw_file_invalid", "pos_cash_balance": "bronze_non_nullable_validation_failed"}
    parts = []
    for status, kept in (("success", "false"), ("skipped_cached_transformation", "true")):
        for table, file in vocab.RAW_FILES:
            source, columns = WRITTEN[table]
            if table in failures:
                parts.append(
                    f"SELECT '{table}' AS entity_name, 'failed' AS status, CAST(NULL AS BIGINT) AS row_count, "
                    "CAST(NULL AS INTEGER) AS column_count, false AS used_cached_result, "
                    "CAST(NULL AS BIGINT) AS stored_rows, CAST(NULL AS VARCHAR) AS warnings, "
                    f"CAST(NULL AS VARCHAR) AS sentinels, '{failures[table]}' AS error"
                )
                continue
            tests = _SENTINELS.get(table, {})
            hits = [f"if(bool_or({tests[c]}), '{c}', NULL)" for c in raw_names(file, columns) if c in tests]
            parts.append(
                f"SELECT '{table}' AS entity_name, '{status}' AS status, count(*) AS row_count, "
                f"{len(columns)} AS column_count, {kept} AS used_cached_result, count(*) AS stored_rows, '' AS warnings, "
                f"concat_ws(',', {', '.join(hits) or 'NULL'}) AS sentinels, CAST(NULL AS VARCHAR) AS error FROM {source}"
            )
    return " UNION ALL ".join(parts)


def _schema_rows() -> str:
    """Expected against delivered names, each file's rows only if its table has any."""
    column_rules = rules.default_column_rules()
    parts = []
    for table, file in vocab.RAW_FILES:
        source, columns = WRITTEN[table]
        actual = set(raw_names(file, columns))
        expected = set(column_rules.expected[file])
        required = set(vocab.REQUIRED_COLUMNS[file])
        status = "error" if required - actual else "warning" if actual ^ expected else "ok"
        lists = {
            "missing_required_columns": required - actual,
            "missing_expected_columns": expected - actual,
            "unexpected_columns": actual - expected,
        }
        shown = ", ".join(f"'{','.join(sorted(names))}' AS {column}" for column, names in lists.items())
        parts.append(
            f"SELECT '{file}' AS file_name, '{status}' AS schema_status, "
            f"CAST({len(expected)} AS BIGINT) AS expected_column_count, {shown} FROM {source} HAVING count(*) > 0"
        )
    return " UNION ALL ".join(parts)


SQL = {
    "csv_to_bronze": "SELECT * FROM bureau",
    **{
        f"csv_to_bronze_{table}": f"SELECT * FROM {source}"
        for table, (source, _) in WRITTEN.items()
        if table != "bureau"
    },
    "csv_to_bronze_previous_application": BRONZE_PREVIOUS,
    # A column that the rules do not know stays text.
    "csv_to_bronze_credit_card_balance": (
        "SELECT * REPLACE (CAST(event_id AS VARCHAR) AS event_id) FROM credit_card_balance"
    ),
    "csv_to_bronze_damaged": (
        "SELECT * REPLACE (if(sk_bureau_id % 7 = 0, 'of \"' || credit_type || '\",' || chr(10) || chr(10) || "
        "'second \"line\"', credit_type) AS credit_type) FROM bureau"
    ),
    "bronze_refresh": _bronze_refresh(),
    "raw_to_star": "SELECT * FROM dti",
    "schema_evaluation": _schema_rows(),
    "raw_audit_files": _audited(),
    "raw_audit_damaged": _damaged(),
    "raw_audit_rollup": _rollup(),
    "raw_audit_reuse": _reuse(),
}
EXACT = {
    "csv_to_bronze_bureau_balance", "schema_evaluation", "raw_audit_files", "raw_audit_damaged", "raw_audit_rollup", "raw_audit_reuse", "bronze_refresh",
}
