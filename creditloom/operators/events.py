"""Questions to the append-only event log: latest state, reuse, freshness, run counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab


def _latest(events: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key.  An aggregate, so a key with very many events combines map-side."""
    others = [c for c in events.columns if c not in keys]
    newest = events.groupBy(*keys).agg(
        F.max_by(F.struct(*others), F.struct(*order)).alias("__newest")
    )
    return newest.select(*keys, "__newest.*")


def latest_event(events: DataFrame, order: Sequence[str] = ("event_ts_utc", "seq")) -> DataFrame:
    """Latest successful table event per layer and entity."""
    done = events.where(
        (F.col("entity_type") == "table") & F.col("status").isin(list(vocab.SUCCESS_STATUSES))
    )
    return _latest(done, ["layer", "entity_name"], order)


def latest_file_event(
    events: DataFrame, order: Sequence[str] = ("event_ts_utc", "seq")
) -> DataFrame:
    """Latest raw event per file, whatever its status."""
    return _latest(events.where(F.col("entity_type") == "file"), ["entity_name"], order)


def reuse_valid_result(
    current: DataFrame,
    events: DataFrame,
    order: Sequence[str] = ("event_ts_utc", "seq"),
    valid: str = vocab.STATUS_VALID,
) -> DataFrame:
    """Attach the last valid result with the same fingerprint and version to each entity.

    ``current`` has entity_name, file_fingerprint and process_version; the result adds
    ``can_reuse`` and the reused counts.
    """
    keys = ["entity_name", "file_fingerprint", "process_version"]
    known = _latest(events.where(F.col("status") == valid), keys, order)
    counts = [c for c in ("row_count", "column_count", "details_json") if c in known.columns]
    found = known.select(*keys, *counts, F.lit(True).alias("can_reuse"))
    return current.join(found, keys, "left").withColumn(
        "can_reuse", F.coalesce("can_reuse", F.lit(False))
    )


def refresh_decision(desired: DataFrame, latest: DataFrame) -> DataFrame:
    """Which tables are still current.

    A table is fresh only if its output exists and version, definition, sources and schema all
    equal those of its latest successful event.
    """
    compared = ["process_version", "definition_fingerprint", "source_fingerprint", "schema_text"]
    known = latest.select(
        "layer", "entity_name", *[F.col(c).alias(f"known_{c}") for c in compared]
    )
    joined = desired.join(known, ["layer", "entity_name"], "left")

    def same(name: str) -> Column:
        return F.coalesce(F.col(name) == F.col(f"known_{name}"), F.lit(False))

    fresh = F.col("output_exists")
    for name in compared:
        fresh = fresh & same(name)
    reason = F.when(F.col("known_process_version").isNull(), F.lit("never_built")).when(
        ~F.col("output_exists"), F.lit("output_missing")
    )
    for name in compared:
        reason = reason.when(~same(name), F.lit(f"{name}_changed"))
    return joined.select(
        *desired.columns, F.coalesce(fresh, F.lit(False)).alias("is_fresh"), reason.alias("reason")
    )


def run_counters(events: DataFrame) -> DataFrame:
    """Selected, succeeded, failed and reused tables per run, and the run's status."""
    status = F.col("status")

    def number(condition: Column) -> Column:
        return F.count(F.when(condition, 1))

    failed = number(status.isin(list(vocab.FAILURE_STATUSES)))
    return (
        events.where(F.col("entity_type") == "table")
        .groupBy("run_id")
        .agg(
            F.count(F.lit(1)).alias("table_count_selected"),
            number(status.isin(list(vocab.SUCCESS_STATUSES))).alias("table_count_succeeded"),
            failed.alias("table_count_failed"),
            number(status == "skipped_cached_transformation").alias("table_count_skipped"),
            F.when(failed > 0, F.lit("partial_failure"))
            .otherwise(F.lit("success"))
            .alias("run_status"),
        )
    )
