"""Records over splits, audit runs that reuse results, and bronze runs that isolate failures."""

import csv
import gzip
import io
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from creditloom import vocab
from creditloom.operators import records
from creditloom.operators.events import latest_event
from creditloom.plans import bronze, bronze_run, raw_audit, raw_run, refresh
from creditloom.sources import rules
from creditloom.sources.events import read_events

from .test_raw_audit import folder, small_splits  # noqa: F401


def fields(text):
    """Records of a text.  The line end behind a quote that never closes is not kept by lines."""
    return [[*r[:-1], r[-1].rstrip("\n")] for r in csv.reader(io.StringIO(text, newline="")) if r]


def test_records_cross_splits_like_the_reader(spark, small_splits):  # noqa: F811
    rng = random.Random(11)
    pieces = ['"', '""', ",", "\n", "\n", "abc", " ", "é", ',"', '",', '"x\ny"', "\n\n"]
    for _ in range(12):
        body = "".join(rng.choice(pieces) for _ in range(rng.randrange(400)))
        content = "h1,h2\n" + body
        path = folder({"f.csv": content.encode()})
        found = records.whole_records(spark, f"{path}/f.csv").collect()
        assert sorted(f for r in found for f in fields(r.text)) == sorted(fields(content)), content
        assert [r.text for r in found if r.header] == ["h1,h2"]


def test_one_scan_per_file(spark, monkeypatch):
    path = folder({"bureau.csv": b'A,B\n1,"two\nlines"\n', "bureau_balance.csv": b"A\n1\n"})
    seen, lexed = [], records.lexed_lines
    monkeypatch.setattr(records, "lexed_lines", lambda s, p: seen.append(os.path.basename(p)) or lexed(s, p))
    rows = {r.file_name: r for r in raw_audit.audit_files(spark, path).collect()}
    assert sorted(seen) == ["bureau.csv", "bureau_balance.csv"]
    plan = records.part_profiles(lexed(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1
    # The load of a file with line breaks takes the audit's word for header and breaks: one scan as well.
    seen.clear()
    row = rows["bureau.csv"]
    loaded = bronze.read_raw_csv(spark, row.path, row.has_line_breaks, row.column_names)
    assert [tuple(r) for r in loaded.collect()] == [("1", "two\nlines")] and seen == ["bureau.csv"]
    assert "FileScan text" not in loaded._jdf.queryExecution().executedPlan().toString()


def test_an_open_quote_in_the_header_gathers_nothing(spark):
    path = folder({"bureau.csv": b'A,"B\n' + b"1,2,some more text\n" * 200_000, "bureau_balance.csv": b"A\n1\n"})
    found = {r.file_name: r for r in raw_audit.audit_files(spark, path).collect()}
    row = found["bureau.csv"]
    assert row.errors == ["read_error:Error"] and (row.row_count, row.column_count) == (0, 0) and not row.read_success
    assert found["bureau_balance.csv"].validation_status == "valid"
    summary = records.part_profiles(records.lexed_lines(spark, f"{path}/bureau.csv")).first()
    assert len(summary.header_text) <= records.HEADER_CHARS + 1


def test_a_damaged_archive_is_a_row_of_its_own(spark):
    path = folder({"bureau_balance.csv": b"A\n1\n"})
    parts = os.path.join(path, "bureau.csv")
    os.mkdir(parts)
    whole = gzip.compress(b"A,B\n" + b"".join(b"%d,%d\n" % (i, i * i) for i in range(5000)))
    for name, content in (("p0.csv.gz", whole), ("p1.csv.gz", whole[: len(whole) // 2])):
        with open(os.path.join(parts, name), "wb") as f:
            f.write(content)
    found = {r.file_name: r for r in raw_audit.audit_files(spark, path).collect()}
    assert found["bureau.csv"].errors == ["read_error:EOFException"] and not found["bureau.csv"].read_success
    assert found["bureau_balance.csv"].validation_status == "valid"


def test_other_errors_are_not_taken_for_unreadable_files(spark, monkeypatch):
    path = folder({"bureau.csv": b"A\n1\n"})
    monkeypatch.setattr(records, "_stretch", lambda *a: 1 / 0)
    with pytest.raises(Exception, match="ZeroDivisionError"):
        raw_audit.audit_files(spark, path)


def test_audit_runs_read_only_what_changed(spark, monkeypatch, tmp_path):
    path, seen, lexed = folder({"bureau.csv": b"A,B\n1,2\n", "bureau_balance.csv": b"A\n1\n2,3\n"}), [], records.lexed_lines
    monkeypatch.setattr(records, "lexed_lines", lambda s, p: seen.append(os.path.basename(p)) or lexed(s, p))

    def run():
        seen.clear()
        return raw_run.run_audit(spark, path, str(tmp_path))

    first = run()
    assert sorted(seen) == ["bureau.csv", "bureau_balance.csv"]
    assert first.counts["table_count_skipped_cached_validation"] == 0
    second = run()
    # A result that was not valid is never reused.
    assert seen == ["bureau_balance.csv"] and second.counts["table_count_skipped_cached_validation"] == 1
    kept = {r.file_name: r for r in second.files.collect()}["bureau.csv"]
    assert (kept.row_count, kept.column_names, kept.validation_status) == (1, ["A", "B"], "valid")
    with open(os.path.join(path, "bureau.csv"), "ab") as f:
        f.write(b'3,"4\n5"\n')
    third = run()
    assert sorted(seen) == ["bureau.csv", "bureau_balance.csv"]
    assert third.counts["run_status"] == "partial_failure"
    assert {r.file_name: r for r in third.files.collect()}["bureau.csv"].has_line_breaks
    log = read_events(spark, str(tmp_path))
    assert log.where("entity_type = 'run' AND layer = 'raw'").count() == 3
    assert log.where("entity_type = 'file'").count() == 3 * len(vocab.RAW_FILES)


BUREAU = "SK_ID_CURR,SK_ID_BUREAU,CREDIT_ACTIVE,AMT_ANNUITY\n"


def small_rules():
    """The built-in rules, for files that hold some of the columns only."""
    return rules.default_column_rules()


def reports(spark, path, where, **options):
    found = bronze_run.build_bronze(spark, path, where, small_rules(), **options)
    return {r["entity_name"]: r for r in found}


def test_bronze_runs(spark, tmp_path):
    where = str(tmp_path)
    path = folder({
        "bureau.csv": (BUREAU + '1,10,"Act\nive",5\n2,20,Closed,\n').encode(),
        "bureau_balance.csv": b"SK_ID_BUREAU,MONTHS_BALANCE,STATUS\n,-1,C\n",
        "credit_card_balance.csv": b"SK_ID_PREV,SK_ID_CURR\nx,1\n",
        "POS_CASH_balance.csv": b"SK_ID_PREV,SK_ID_CURR,NEW FLAG\n1,2,Y\n3,4,n\n",
    })
    chosen = ["bureau", "bureau_balance", "credit_card_balance", "pos_cash_balance", "installments_payments"]
    planned = reports(spark, path, where, selected=chosen, dry_run=True)
    assert planned["bureau"]["status"] == "planned" and read_events(spark, where).count() == 0

    raw_run.run_audit(spark, path, where)
    first = reports(spark, path, where, selected=chosen)
    assert {n: r["status"] for n, r in first.items()} == {
        "bureau": "success", "bureau_balance": "failed", "credit_card_balance": "failed",
        "pos_cash_balance": "success", "installments_payments": "failed",
    }
    assert "SK_ID_BUREAU:null_count=1" in first["bureau_balance"]["error_message"]
    assert "CAST_INVALID_INPUT" in first["credit_card_balance"]["error_message"]
    assert "raw_file_not_found" in first["installments_payments"]["error_message"]
    assert first["bureau"]["details"]["validation_warnings"] == []
    # A column without a mapping is looked at, and a boolean one becomes boolean.
    assert "new_flag:BOOLEAN:YES" in first["pos_cash_balance"]["schema_text"]
    assert first["pos_cash_balance"]["details"]["boolean_candidates"] == ["NEW FLAG"]
    tables = refresh.published_tables(spark, where)
    assert set(tables) == {"bronze.bureau", "bronze.pos_cash_balance"}
    assert sorted(tuple(r) for r in tables["bronze.bureau"].collect()) == [
        (1, 10, "Act\nive", 5.0), (2, 20, "Closed", None)
    ]

    assert reports(spark, path, where, selected=["bureau"])["bureau"]["status"] == "skipped_cached_transformation"
    # Another set of columns breaks the schema; the published version stays in force.
    with open(os.path.join(path, "bureau.csv"), "w") as f:
        f.write("SK_ID_CURR,SK_ID_BUREAU\n1,10\n")
    drifted = reports(spark, path, where, selected=["bureau"])["bureau"]
    assert drifted["status"] == "failed" and "bronze_schema_mismatch" in drifted["error_message"]
    assert refresh.published_tables(spark, where)["bronze.bureau"].count() == 2
    # New rows without a new audit: loaded, and the difference to the audit is a warning.
    with open(os.path.join(path, "bureau.csv"), "w") as f:
        f.write(BUREAU + "1,10,Active,5\n")
    grown = reports(spark, path, where, selected=["bureau"])["bureau"]
    assert grown["status"] == "success"
    assert grown["details"]["validation_warnings"] == ["raw_bronze_row_count_mismatch:raw=2:bronze=1"]
    newest = latest_event(read_events(spark, where)).where("entity_name = 'bureau'").first()
    assert json.loads(newest.details_json)["column_rules"]["SK_ID_BUREAU"]["bronze_column"] == "sk_bureau_id"
    runs = read_events(spark, where).where("layer = 'bronze' AND entity_type = 'run'").orderBy("event_ts_utc").collect()
    assert [r.status for r in runs] == ["partial_failure", "success", "partial_failure", "success"]


def test_mapped_types_are_guarded(spark):
    raw = spark.createDataFrame([("1", "2")], "SK_ID_CURR string, SK_ID_BUREAU string")
    plan = bronze_run.plan_load(raw, "bureau.csv", small_rules())
    bronze_run.require_mapped(plan, small_rules())
    other = bronze.TablePlan("bureau.csv", [
        bronze.ColumnPlan(c.source, c.reference, c.bronze, "DOUBLE", True, c.origin) for c in plan.columns
    ], 0)
    with pytest.raises(ValueError, match="type_mismatch:sk_id_curr.*nullable_mismatch:sk_id_curr"):
        bronze_run.require_mapped(other, small_rules())


def test_definition_follows_the_rules_of_the_file():
    base = rules.default_column_rules()
    changed = rules.default_column_rules(all_sentinels=True)
    assert bronze_run.definition("previous_application.csv", base) != bronze_run.definition("previous_application.csv", changed)
    assert bronze_run.definition("bureau.csv", base) == bronze_run.definition("bureau.csv", changed)


def test_silver_reads_the_published_bronze(spark, tmp_path):
    path, where = folder({"bureau.csv": (BUREAU + "1,10,Active,5\n").encode()}), str(tmp_path)
    reports(spark, path, where, selected=["bureau"])
    table = refresh.Table("silver", "copy", ("bronze.bureau",), lambda df: df.select(F.col("sk_bureau_id")))
    assert [r["status"] for r in refresh.build_layers(spark, where, {}, tables=[table])] == ["success"]
    assert [r["status"] for r in refresh.build_layers(spark, where, {}, tables=[table])] == ["skipped_cached_transformation"]
    assert refresh.published_tables(spark, where)["silver.copy"].first().sk_bureau_id == 10
