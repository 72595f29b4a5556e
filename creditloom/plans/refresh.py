"""Builds the layers in declared order and keeps the refresh audit.

A table is a name, its inputs and a builder from DataFrames to a DataFrame.  Per table: compare
with the latest successful event and reuse, or build, publish a new version and append the event
that makes it visible.  A failure stays with its table and those that read from it.
"""

from __future__ import annotations

import hashlib
import inspect
import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .. import vocab
from ..functions import aggs, rows
from ..operators import attach, bands, keys
from ..operators.events import latest_event, refresh_decision
from ..operators.fingerprint import (
    content_fingerprint, content_metrics, observed_fingerprint, schema_text,
)
from ..sources import rules as rule_tables
from ..sources import storage
from ..sources.events import append_events, live_events, utc_now
from . import gold, silver

VERSION = "layers_v1"
REUSED, BUILT, FAILED = "skipped_cached_transformation", "success", "failed"
SKIPPED = "skipped_upstream_failed"


@dataclass(frozen=True)
class Table:
    layer: str
    name: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    modules: tuple = ()
    extra: str = ""

    @property
    def key(self) -> str:
        return f"{self.layer}.{self.name}"

    def definition(self) -> str:
        """Fingerprint of the code and rules that define the table."""
        shared = (vocab, rows, aggs, attach)
        text = "\n".join(inspect.getsource(m) for m in (*shared, *self.modules)) + self.extra
        return _digest([VERSION, self.key, text])


def _digest(parts) -> str:
    return hashlib.sha256(json.dumps(parts).encode("utf-8")).hexdigest()


def bronze_sources(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {f"bronze.{name}": df for name, df in tables.items()}


def layer_tables(band_rows=None) -> list[Table]:
    """All silver and gold tables, each after the tables it reads."""
    band_rows = rule_tables.default_band_rows() if band_rows is None else band_rows
    rule_text = "\n".join(str(tuple(r)) for r in band_rows)

    def s(name: str, inputs: list[str], build) -> Table:
        return Table("silver", name, tuple(inputs), build, (silver,))

    def g(name: str, inputs: list[str], build) -> Table:
        return Table("gold", name, tuple(inputs), build, (gold, bands, keys), rule_text)

    spark_rules = lambda spark: spark.createDataFrame(band_rows, rule_tables.BAND_SCHEMA)
    return [
        s("applications", ["bronze.application_train", "bronze.application_test"], silver.applications),
        s("bureau", ["bronze.bureau"], silver.bureau),
        s("bureau_balance", ["bronze.bureau_balance"], silver.bureau_balance),
        s("previous_application", ["bronze.previous_application"], silver.previous_application),
        s("installments_payments", ["bronze.installments_payments"], silver.installments_payments),
        s("credit_card_balance", ["bronze.credit_card_balance"], silver.credit_card_balance),
        s("pos_cash_balance", ["bronze.pos_cash_balance"], silver.pos_cash_balance),
        s(
            "agg_bureau_external_credit_behavior",
            ["silver.bureau", "silver.bureau_balance"],
            silver.external_behavior,
        ),
        s(
            "agg_internal_historical_behavior",
            [
                "silver.previous_application", "silver.installments_payments",
                "silver.credit_card_balance", "silver.pos_cash_balance",
            ],
            silver.internal_behavior,
        ),
        g("ref_band_rules", [], lambda: spark_rules(SparkSession.active())),
        # Shared steps of the star: client roll-ups once for three readers, one numbering.
        g("client_external", ["silver.agg_bureau_external_credit_behavior"], gold.client_external),
        g("client_internal", ["silver.agg_internal_historical_behavior"], gold.client_internal),
        g("application_spine", ["silver.applications"], gold.application_spine),
        g(
            "credit_risk_feature_store",
            ["silver.applications", "gold.client_internal", "gold.client_external"],
            gold.feature_store,
        ),
        g("dim_requester", ["gold.application_spine"], lambda a: gold.dim_requester(a, band_rows)),
        g("dim_contract", ["gold.application_spine"], gold.dim_contract),
        g(
            "dim_risk_segment",
            ["gold.application_spine", "gold.client_internal", "gold.client_external"],
            lambda a, i, e: gold.dim_risk_segment(a, i, e, band_rows),
        ),
        g(
            "fact_credit_risk",
            ["gold.application_spine", "gold.client_internal", "gold.client_external"],
            gold.fact_credit_risk,
        ),
    ]


def published_paths(spark: SparkSession, warehouse: str) -> dict[str, str]:
    """Current version of every table, from the event log."""
    current = latest_event(live_events(spark, warehouse))
    found = current.select("layer", "entity_name", "artifact_path").collect()
    return {f"{r.layer}.{r.entity_name}": r.artifact_path for r in found}


def published_tables(spark: SparkSession, warehouse: str) -> dict[str, DataFrame]:
    return {
        name: storage.read_parquet(spark, path)
        for name, path in published_paths(spark, warehouse).items()
    }


def register_gold_views(spark: SparkSession, warehouse: str) -> list[str]:
    """Gold tables as temporary views named after the table."""
    gold_paths = {
        name.split(".", 1)[1]: path
        for name, path in published_paths(spark, warehouse).items()
        if name.startswith("gold.")
    }
    return storage.register_views(spark, gold_paths)


def build_layers(
    spark: SparkSession,
    warehouse: str,
    sources: Mapping[str, DataFrame],
    selected: set[str] | None = None,
    source_fingerprints: Mapping[str, str] | None = None,
    band_rows=None,
    tables: list[Table] | None = None,
) -> list[dict]:
    """Refresh the layers over the given bronze tables; returns one report per table.

    ``source_fingerprints`` identifies the bronze inputs where their loader already knows them
    (file fingerprints); without it their content is fingerprinted.  ``selected`` limits the run
    to some tables by ``layer.name``; the others are read as published.
    """
    run_id, started = str(uuid.uuid4()), utc_now()
    all_tables = layer_tables(band_rows) if tables is None else tables
    chosen = [t for t in all_tables if selected is None or t.key in selected]
    log = latest_event(live_events(spark, warehouse))
    last_events = log.collect()  # one row per table
    known = {f"{r.layer}.{r.entity_name}": r for r in last_events}
    latest = spark.createDataFrame(last_events, log.schema)
    frames: dict[str, DataFrame] = dict(sources)
    given = dict(source_fingerprints or {})
    fingerprints: dict[str, str] = {}
    states: dict[str, str] = {}
    reports: list[dict] = []

    def frame(name: str) -> DataFrame:
        if name not in frames:
            if name not in known:
                raise ValueError(f"source_table_not_found: {name}")
            frames[name] = storage.read_parquet(spark, known[name].artifact_path)
        return frames[name]

    def fingerprint(name: str) -> str:
        """One form for every input: this run's, the published or the bronze content."""
        if name not in fingerprints:
            if name in given:
                fingerprints[name] = given[name]
            elif name in known and name not in sources:
                fingerprints[name] = known[name].table_fingerprint
            else:
                fingerprints[name] = content_fingerprint(frame(name)).first().table_fingerprint
        return fingerprints[name]

    for wave in _waves(chosen):
        ready = [t for t in wave if not _failed_inputs(t, states)]
        sources_of: dict[str, str | Exception] = {}
        for table in ready:
            try:
                sources_of[table.key] = _digest([[i, fingerprint(i)] for i in table.inputs])
            except Exception as error:  # noqa: BLE001 - an input that cannot be read fails its readers only
                sources_of[table.key] = error
        current = _decisions(
            spark, {t: s for t in ready if isinstance(s := sources_of[t.key], str)}, known, latest
        )
        for table in wave:
            event = {
                "run_id": run_id,
                "layer": table.layer,
                "entity_type": "table",
                "entity_name": table.name,
                "started_at_utc": utc_now(),
                "warehouse_path": warehouse,
                "process_version": VERSION,
                "used_cached_result": False,
            }
            try:
                if table not in ready:
                    failed = _failed_inputs(table, states)
                    event.update(status=SKIPPED, error_message=f"failed inputs: {failed}")
                elif isinstance(sources_of[table.key], Exception):
                    raise sources_of[table.key]
                else:
                    event["definition_fingerprint"] = table.definition()
                    event["source_fingerprint"] = sources_of[table.key]
                    if current[table.key]:
                        last = known[table.key]
                        kept = ("artifact_path", "row_count", "column_count", "schema_text", "table_fingerprint")
                        event.update(status=REUSED, used_cached_result=True, **{k: last[k] for k in kept})
                    else:
                        event.update(_built(table, [frame(i) for i in table.inputs], warehouse, run_id, event))
                    frames[table.key] = storage.read_parquet(spark, event["artifact_path"])
                    fingerprints[table.key] = event["table_fingerprint"]
            except Exception as error:  # noqa: BLE001 - a failed table must not stop the others
                event.update(status=FAILED, error_message=f"{type(error).__name__}: {error}")
            states[table.key] = event["status"]
            event["seq"] = len(reports)
            event["event_ts_utc"] = event["finished_at_utc"] = utc_now()
            reports.append(event)
            # The event is the commit of the version just written.
            append_events(spark, warehouse, [event])

    append_events(spark, warehouse, [_run_event(run_id, started, warehouse, reports)])
    return reports


def _waves(tables: list[Table]) -> list[list[Table]]:
    """Tables in declared order, cut before each that reads one of the same wave."""
    waves: list[list[Table]] = []
    for table in tables:
        if not waves or any(i == t.key for i in table.inputs for t in waves[-1]):
            waves.append([])
        waves[-1].append(table)
    return waves


def _failed_inputs(table: Table, states: Mapping[str, str]) -> list[str]:
    return [i for i in table.inputs if states.get(i) in (FAILED, SKIPPED)]


def _decisions(
    spark: SparkSession, wanted: Mapping[Table, str], known: Mapping, latest: DataFrame
) -> dict[str, bool]:
    """Which tables of a wave are current: one question to the event log for all of them.

    The schema asked for is that of the stored table, so a table changed behind the log is built anew.
    """
    rows = []
    for table, sources in wanted.items():
        last = known.get(table.key)
        exists = last is not None and storage.path_exists(spark, last.artifact_path)
        stored = schema_text(storage.read_parquet(spark, last.artifact_path).schema) if exists else None
        rows.append((table.layer, table.name, VERSION, table.definition(), sources, stored, exists))
    if not any(row[-1] for row in rows):
        return {t.key: False for t in wanted}
    desired = spark.createDataFrame(
        rows,
        "layer string, entity_name string, process_version string, definition_fingerprint string, "
        "source_fingerprint string, schema_text string, output_exists boolean",
    )
    return {f"{r.layer}.{r.entity_name}": r.is_fresh for r in refresh_decision(desired, latest).collect()}


def _built(table: Table, inputs: list[DataFrame], warehouse: str, run_id: str, event: Mapping) -> dict:
    built = table.build(*inputs)
    path, facts = storage.publish(built, warehouse, table.layer, table.name, run_id, content_metrics(built))
    return {
        "status": BUILT,
        "artifact_path": path,
        "row_count": facts["row_count"],
        "column_count": len(built.columns),
        "schema_text": schema_text(built.schema),
        "table_fingerprint": observed_fingerprint(
            facts, built.schema, event["definition_fingerprint"], event["source_fingerprint"]
        ),
    }


def _run_event(run_id: str, started, warehouse: str, reports: list[dict]) -> dict:
    statuses = [r["status"] for r in reports]
    succeeded = sum(s in vocab.SUCCESS_STATUSES for s in statuses)
    failed = sum(s in vocab.FAILURE_STATUSES for s in statuses)
    now = utc_now()
    return {
        "run_id": run_id,
        "seq": len(reports),
        "event_ts_utc": now,
        "layer": "layers",
        "entity_type": "run",
        "entity_name": "layer_refresh",
        "status": "partial_failure" if failed else "success",
        "started_at_utc": started,
        "finished_at_utc": now,
        "warehouse_path": warehouse,
        "process_version": VERSION,
        "used_cached_result": False,
        "details": {
            "table_count_selected": len(statuses),
            "table_count_succeeded": succeeded,
            "table_count_failed": failed,
            "table_count_skipped_cached": statuses.count(REUSED),
        },
    }
