"""The audit against the row-by-row reader of the standard library."""

import csv
import io
import os
import tempfile

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from creditloom import vocab
from creditloom.plans import raw_audit

FILES = {
    "application_train.csv": b"\xef\xbb\xbfSK_ID_CURR,TARGET,NAME\n"
    + b"".join(b'%d,1,"a,b ""q"""\n' % i for i in range(30)),
    "application_test.csv": b"",
    "bureau.csv": b"A,B\n1,2\n\n3\n4,5,6\n",
    "bureau_balance.csv": b"A,B,C\n"
    + b"".join(b'%d,"line one\nline, ""two"" \n\n three",x\n' % i for i in range(40))
    + b'1,2\n5" pipe,b"c,d\n\n',
    "previous_application.csv": b"A,B\n1,\xff\xfe\n",
    "credit_card_balance.csv": b"A,B\r\n1,2\r\n",
    "installments_payments.csv": b'"A ""x""","B\nb",C\n1,"open, never closed\n2,3,4\n',
}


def folder(files):
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    for name, content in files.items():
        with open(os.path.join(path, name), "wb") as f:
            f.write(content)
    return path


def by_reader(content):
    """(header, records, records of another width) by the standard reader."""
    reader = csv.reader(io.StringIO(content.decode("utf-8-sig"), newline=""))
    header = next(reader, None) or []
    records = list(reader)
    return header, len(records), sum(len(r) != len(header) for r in records)


@pytest.fixture
def small_splits(spark):
    """Splits of a few dozen bytes, so that records cross them."""
    names = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_damaged_files(spark, small_splits):
    found = {r.file_name: r for r in raw_audit.audit_files(spark, folder(FILES)).collect()}
    for name, content in FILES.items():
        if name in ("application_test.csv", "previous_application.csv"):
            continue
        header, records, ragged = by_reader(content)
        row = found[name]
        assert (row.column_names, row.row_count, row.inconsistent_rows) == (header, records, ragged), name
        assert row.validation_status == ("invalid" if ragged else "valid")
    assert found["application_test.csv"].errors == ["empty_file"]
    assert found["previous_application.csv"].errors == ["encoding_error"]
    assert not found["previous_application.csv"].read_success
    missing = found["POS_CASH_balance.csv"]
    assert (missing.validation_status, missing.errors) == ("missing", ["file_not_found"])
    assert found["bureau_balance.csv"].has_line_breaks


def test_rollup_and_missing_folder(spark):
    counts = raw_audit.audit_rollup(raw_audit.audit_files(spark, folder(FILES))).first()
    assert counts.asDict() == {
        "table_count_expected": 8, "table_count_found": 7, "table_count_read_success": 5,
        "table_count_validation_passed": 2, "table_count_validation_failed": 5,
        "table_count_missing": 1, "table_count_skipped_cached_validation": 0,
        "run_status": "partial_failure",
    }
    nowhere = raw_audit.audit_rollup(raw_audit.audit_files(spark, "/tmp/no-such-folder")).first()
    assert nowhere.table_count_missing == 8


def test_header_only_and_part_files(spark):
    path = folder({"bureau.csv": b"A,B\n"})
    parts = os.path.join(path, "bureau_balance.csv")
    os.mkdir(parts)
    for i, text in enumerate([b"A,B\n1,2\n3,4\n", b"A,B\n5,6\n7\n", b"A,C\n8,9\n"]):
        with open(os.path.join(parts, f"part-{i}.csv"), "wb") as f:
            f.write(text)
    found = {r.file_name: r for r in raw_audit.audit_files(spark, path).collect()}
    assert (found["bureau.csv"].row_count, found["bureau.csv"].validation_status) == (0, "valid")
    delivered = found["bureau_balance.csv"]
    assert (delivered.row_count, delivered.inconsistent_rows) == (5, 1)
    assert delivered.errors == ["inconsistent_row_length", "part_headers_differ"]


def test_identity_changes_with_content(spark):
    path = folder({"bureau.csv": b"A,B\n"})
    before = raw_audit.file_identity(spark, path).first().file_fingerprint
    with open(os.path.join(path, "bureau.csv"), "ab") as f:
        f.write(b"1,2\n")
    assert raw_audit.file_identity(spark, path).first().file_fingerprint != before


texts = st.lists(st.sampled_from(['"', '""', ",", "\n", "a", " ", "\r\n", "é", ',"', '",']), max_size=60)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(texts, min_size=7, max_size=7))
def test_any_text_counts_like_the_reader(spark, small_splits, bodies):
    contents = {
        file: ("h1,h2\n" + "".join(body)).encode()
        for (_, file), body in zip(vocab.RAW_FILES, bodies)
    }
    found = {r.file_name: r for r in raw_audit.audit_files(spark, folder(contents)).collect()}
    for file, content in contents.items():
        header, records, ragged = by_reader(content)
        row = found[file]
        assert (row.column_names, row.row_count, row.inconsistent_rows) == (header, records, ragged), content
