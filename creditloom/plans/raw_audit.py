"""Structural audit of the raw CSV files, one scan per file.

An expected file is one CSV file or a folder of that name with part files, each with a header.
Files are read as text lines in parallel splits, quoted line breaks included, and come back as one
row per part (see ``operators.records``).  Every file is a job of its own, so a file that cannot be read
becomes a row with a ``read_error`` while the others are audited.  Profiles that are known from an
earlier run are handed in and their files are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import vocab
from ..operators import records

# Error of a delivery in several part files whose headers are not all the same
PART_HEADERS = "part_headers_differ"
READ_ERROR = "read_error:"
# Kind of error of a header that is longer than a field may be
TOO_LONG = "Error"

PROFILE_KINDS = (
    "file_name string, column_names array<string>, column_count int, row_count long, inconsistent_rows long, "
    "valid_text boolean, has_line_breaks boolean, headers_differ boolean, read_error string"
)
PROFILE_NAMES = [part.split()[0] for part in PROFILE_KINDS.split(", ")]


def expected_files(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(vocab.RAW_FILES, "table_name string, file_name string")


def file_identity(spark: SparkSession, raw_dir: str) -> DataFrame:
    """Path, size, modification time and fingerprint of the expected files that exist.

    One status call per expected file on the driver; Spark's own sources leave out empty files,
    which the audit has to tell from missing ones.  Content is not read.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(raw_dir)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for _, name in vocab.RAW_FILES:
        path = hadoop.Path(folder, name)
        if files.exists(path):
            size = files.getContentSummary(path).getLength()
            modified = files.getFileStatus(path).getModificationTime() * 1_000_000
            found.append((name, path.toString(), size, modified))
    return spark.createDataFrame(
        found, "file_name string, path string, file_size_bytes long, file_modified_at_ns long"
    ).withColumn(
        "file_fingerprint", F.concat_ws("|", "path", "file_size_bytes", "file_modified_at_ns")
    )


def _per_file(parts: DataFrame) -> DataFrame:
    """Parts of one delivery added up; every part carries its own header."""
    named = parts.withColumn("column_names", records.header_names(F.col("header_text")))
    return named.agg(
        F.min_by(F.struct("column_names", "header_fields"), "part").alias("header"),
        F.sum("records").alias("row_count"),
        F.sum("ragged").alias("inconsistent_rows"),
        F.min("valid_text").alias("valid_text"),
        F.max("has_line_breaks").alias("has_line_breaks"),
        (F.count_distinct("column_names") > 1).alias("headers_differ"),
        F.max("header_too_long").alias("too_long"),
    )


def read_failure(error: Exception) -> str | None:
    """The kind of a failure to read a file, or nothing if the error is another one."""
    java = getattr(error, "java_exception", None) or getattr(error, "_origin", None)
    if java is None or "FAILED_READ_FILE" not in str(error) and "java.io." not in str(error):
        return None
    while java.getCause() is not None:
        java = java.getCause()
    return java.getClass().getSimpleName()


def profile_file(spark: SparkSession, path: str, file_name: str) -> tuple:
    """The profile of one file or folder (PROFILE_KINDS) from one scan."""
    unread = (file_name, [], 0, 0, 0, True, False, False)
    try:
        found = _per_file(records.part_profiles(records.lexed_lines(spark, path))).first()
    except (Py4JJavaError, PySparkException) as error:
        kind = read_failure(error)
        if kind is None:
            raise
        return (*unread, kind)
    if found.header is None:
        return (*unread, None)
    if found.too_long:
        return (*unread, TOO_LONG)
    return (
        file_name, found.header.column_names, found.header.header_fields, found.row_count, found.inconsistent_rows,
        found.valid_text, found.has_line_breaks, found.headers_differ, None,
    )


def audit_files(spark: SparkSession, raw_dir: str, known: Mapping[str, Mapping] | None = None) -> DataFrame:
    """One row per expected file: presence, identity, header, counts, errors and status.

    ``errors`` lists each kind of error once; ``inconsistent_rows`` carries how many records have
    another width than the header.  ``known`` maps names of files that did not change to their
    profiles; they are not read.
    """
    known = known or {}
    identity = file_identity(spark, raw_dir)
    present = {r.file_name: r.path for r in identity.collect()}
    profiles = [tuple({**known[n], "file_name": n}.get(k) for k in PROFILE_NAMES) for n in present if n in known]
    profiles += [profile_file(spark, path, n) for n, path in present.items() if n not in known]
    joined = (
        expected_files(spark)
        .join(identity, "file_name", "left")
        .join(spark.createDataFrame(profiles, PROFILE_KINDS), "file_name", "left")
    )
    exists = F.col("path").isNotNull()
    failed = exists & F.col("read_error").isNotNull()
    empty = exists & ~failed & (F.coalesce("column_count", F.lit(0)) == 0)
    undecodable = exists & ~empty & ~F.coalesce("valid_text", F.lit(True))
    ragged = exists & ~empty & (F.coalesce("inconsistent_rows", F.lit(0)) > 0)
    errors = F.array_compact(
        F.array(
            F.when(~exists, F.lit(vocab.ERROR_NOT_FOUND)),
            F.when(empty, F.lit(vocab.ERROR_EMPTY)),
            F.when(ragged, F.lit(vocab.ERROR_ROW_LENGTH)),
            F.when(exists & F.coalesce("headers_differ", F.lit(False)), F.lit(PART_HEADERS)),
            F.when(undecodable, F.lit(vocab.ERROR_ENCODING)),
            F.when(failed, F.concat(F.lit(READ_ERROR), "read_error")),
        )
    )
    readable = exists & ~empty & ~undecodable & ~failed
    counted = exists & ~empty
    status = (
        F.when(~exists, F.lit(vocab.STATUS_MISSING))
        .when(~readable | (F.size(errors) > 0), F.lit(vocab.STATUS_INVALID))
        .otherwise(F.lit(vocab.STATUS_VALID))
    )
    none = F.array().cast("array<string>")
    return joined.select(
        "table_name",
        "file_name",
        "path",
        exists.alias("exists"),
        readable.alias("read_success"),
        status.alias("validation_status"),
        F.when(counted, F.col("row_count")).otherwise(F.lit(0)).alias("row_count"),
        F.when(counted, F.col("column_count")).otherwise(F.lit(0)).alias("column_count"),
        F.when(counted, F.col("column_names")).otherwise(none).alias("column_names"),
        F.when(counted, F.col("inconsistent_rows")).otherwise(F.lit(0)).alias("inconsistent_rows"),
        F.coalesce("has_line_breaks", F.lit(False)).alias("has_line_breaks"),
        errors.alias("errors"),
        "file_size_bytes",
        "file_modified_at_ns",
        "file_fingerprint",
        F.lit(vocab.RAW_AUDIT_VERSION).alias("validation_version"),
        F.col("file_name").isin(_names(known)).alias("skipped_cached_validation"),
    )


def _names(names: Iterable[str]) -> list[str]:
    return [*names] or [""]


def audit_rollup(files: DataFrame) -> DataFrame:
    """Counts over the audited files and the status of the run.

    ``files`` may carry ``skipped_cached_validation``; without it nothing was reused.
    """
    status = F.col("validation_status")
    reused = (
        F.col("skipped_cached_validation")
        if "skipped_cached_validation" in files.columns
        else F.lit(False)
    )

    def number(condition: Column) -> Column:
        return F.count(F.when(condition, 1))

    counts = files.agg(
        F.count(F.lit(1)).alias("table_count_expected"),
        number(F.col("exists")).alias("table_count_found"),
        number(F.col("read_success")).alias("table_count_read_success"),
        number(status == vocab.STATUS_VALID).alias("table_count_validation_passed"),
        number(status == vocab.STATUS_INVALID).alias("table_count_validation_failed"),
        number(status == vocab.STATUS_MISSING).alias("table_count_missing"),
        number(reused).alias("table_count_skipped_cached_validation"),
    )
    bad = F.col("table_count_validation_failed") + F.col("table_count_missing")
    return counts.withColumn(
        "run_status", F.when(bad > 0, F.lit("partial_failure")).otherwise(F.lit("success"))
    )
