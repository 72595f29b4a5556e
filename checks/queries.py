"""The registered queries: every operator family over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom import vocab
from creditloom.operators.attach import attach, hot_keys
from creditloom.operators.bands import band_join
from creditloom.operators.events import (
    latest_event, refresh_decision, reuse_valid_result, run_counters,
)
from creditloom.operators.fingerprint import content_fingerprint, table_profile
from creditloom.operators.keys import dense_key
from creditloom.functions import rows
from creditloom.plans import bronze, gold, insights, refresh, silver
from creditloom.sources import adapter, rules, storage

from . import raw_queries
from .inputs import Inputs, raw_text
from .precision import settle

SEGMENT_MIN_CLIENTS = 20


# --- bronze ---------------------------------------------------------------------------------


def _bronze_profile(df: DataFrame, file: str) -> DataFrame:
    column_rules = rules.default_column_rules()
    return bronze.profile(df, bronze.column_plans(file, df.columns, column_rules))


def _bool_domain_profile(t: Inputs) -> DataFrame:
    return _bronze_profile(raw_text(t.train), "application_train.csv").select(
        "column_name", "is_boolean", "row_count"
    )


def _sentinel_profile(t: Inputs) -> DataFrame:
    train = _bronze_profile(raw_text(t.train), "application_train.csv")
    previous = _bronze_profile(
        raw_text(t.view("previous_application")), "previous_application.csv"
    )
    return (
        train.unionByName(previous)
        .where(F.col("sentinel_rows").isNotNull())
        .select("column_name", "sentinel_rows")
    )


def _bronze(df: DataFrame, file: str) -> DataFrame:
    raw = raw_text(df)
    plan = bronze.plan_table(raw, file, rules.default_column_rules())
    bronze.require_no_nulls(plan)
    return bronze.standardise(raw, plan)


def _bool_normalise(t: Inputs) -> DataFrame:
    names = ["flag_own_car", "flag_own_realty", *vocab.CONTACT]
    raw = raw_text(t.train.select("sk_id_curr", *names))
    return raw.select(
        F.col("SK_ID_CURR").cast("bigint").alias("sk_id_curr"),
        *[bronze.normalised_boolean(n.upper()).alias(n) for n in names],
    )


def _typed_cast(t: Inputs) -> DataFrame:
    kinds = {"sk_id_prev": "BIGINT", "days_decision": "BIGINT", "amt_credit": "DOUBLE",
             "cnt_payment": "BIGINT", "name_contract_status": "VARCHAR"}
    raw = raw_text(t.view("previous_application").select(*kinds))
    return raw.select(*[bronze.typed(n.upper(), kind).alias(n) for n, kind in kinds.items()])


def _null_constraints(t: Inputs) -> DataFrame:
    column_rules = rules.default_column_rules()
    raw = raw_text(t.view("previous_application"))
    return bronze.null_constraint_report(
        raw, bronze.column_plans("previous_application.csv", raw.columns, column_rules)
    )


def _reconciliation(t: Inputs) -> DataFrame:
    raw_events = t.event_log.withColumn("entity_type", F.lit("file")).withColumn(
        "column_count", F.lit(4)
    )
    loaded = t.event_log.groupBy("entity_name").agg(
        F.count(F.lit(1)).alias("bronze_row_count"),
        F.max((F.col("seq") % 3 + 3).cast("int")).alias("bronze_column_count"),
        F.min((F.col("seq") % 2 + 4).cast("int")).alias("planned_column_count"),
    )
    report = bronze.reconciliation(loaded, raw_events)
    return report.withColumn("validation_warnings", F.array_join("validation_warnings", "; "))


# --- silver ---------------------------------------------------------------------------------


def _features(df: DataFrame, key: str, features: dict) -> DataFrame:
    return df.select(key, *[c.alias(n) for n, c in features.items()])


def _application(builder: Callable[[], dict]) -> Callable[[Inputs], DataFrame]:
    return lambda t: _features(
        silver.union_applications(t.train, t.test), "sk_id_curr", builder()
    )


# --- gold -----------------------------------------------------------------------------------


def _band_join_all(t: Inputs) -> DataFrame:
    df = t.applications.select(
        "sk_id_curr", "age_years", "amt_income_total", "employment_years", "ext_source_mean",
        "annuity_income_ratio",
    )
    groups = {r.band_group: r.source_column for r in t.rule_rows}
    for group, column in groups.items():
        df = band_join(df, t.band_rules, group, column, group)
    return df.select("sk_id_curr", *groups)


def _band_rule_usage(t: Inputs) -> DataFrame:
    labelled = t.applications.select(
        *[c.alias(n) for n, c in gold.requester_bands(t.rule_rows).items()],
        gold.risk_bands(t.rule_rows)["mean_score_band"].alias("score_band"),
        gold.risk_bands(t.rule_rows)["annuity_income_band"].alias("annuity_income_band"),
    )
    groups = labelled.columns
    pairs = F.array(*[F.struct(F.lit(g).alias("band_group"), F.col(g).alias("band_label")) for g in groups])
    used = labelled.select(F.inline(pairs)).groupBy("band_group", "band_label").agg(
        F.count(F.lit(1)).alias("applications")
    )
    return gold.ref_band_rules(t.spark).join(used, ["band_group", "band_label"], "left")


def _dense_key(t: Inputs) -> DataFrame:
    return dense_key(t.view("bureau").select("sk_bureau_id", "credit_type"), "sk_bureau_id", "bureau_key")


def _hot_key_attach(t: Inputs) -> DataFrame:
    """Roll-up attached to its own detail rows, the frequent keys spread over salts."""
    months = silver.card_rollup(t.card).select("sk_id_prev", "total_credit_card_records", "card_total_dpd")
    frequent = hot_keys(t.card, "sk_id_prev", share=0.007)
    joined = attach(t.card, months, "sk_id_prev", "no_rollup", hot_keys=frequent, salts=16)
    return joined.select("event_id", "sk_id_prev", "total_credit_card_records", "card_total_dpd", "no_rollup")


# --- refresh --------------------------------------------------------------------------------


def _reuse_valid_result(t: Inputs) -> DataFrame:
    log = t.event_log.withColumn(
        "status", F.when(F.col("status") == "failed", F.lit("invalid")).otherwise(F.lit("valid"))
    )
    current = log.groupBy("entity_name").agg(
        F.max("file_fingerprint").alias("file_fingerprint"), F.lit("v1").alias("process_version")
    )
    return reuse_valid_result(current, log).select(
        "entity_name", "file_fingerprint", "process_version", "can_reuse", "row_count"
    )


def _refresh_decision(t: Inputs) -> DataFrame:
    log = t.event_log.withColumns(
        {
            "definition_fingerprint": F.col("file_fingerprint"),
            "source_fingerprint": (F.col("row_count") % 2).cast("string"),
            "schema_text": F.lit("s"),
        }
    )
    desired = log.groupBy("layer", "entity_name").agg(
        F.lit("v1").alias("process_version"),
        F.max("definition_fingerprint").alias("definition_fingerprint"),
        F.min("source_fingerprint").alias("source_fingerprint"),
        F.lit("s").alias("schema_text"),
        (F.max("seq") % 5 != 0).alias("output_exists"),
    )
    return refresh_decision(desired, latest_event(log)).select(
        "layer", "entity_name", "is_fresh", "reason"
    )


def _table_profile(t: Inputs) -> DataFrame:
    return table_profile({n: t.view(n) for n in adapter.VIEWS}).drop("schema_text")


def _content_fingerprint(t: Inputs) -> DataFrame:
    return content_fingerprint(t.internal_behavior, definition="internal_behavior")


def _publish_roundtrip(t: Inputs) -> DataFrame:
    """Star schema published, found again through the event log and queried on its keys."""
    warehouse = storage.scratch_path(t.spark, "warehouse")
    sources = {
        "silver.applications": t.applications,
        "silver.agg_bureau_external_credit_behavior": t.external_behavior,
        "silver.agg_internal_historical_behavior": t.internal_behavior,
    }
    star_tables = {
        f"gold.{name}"
        for name in (
            "client_external", "client_internal", "application_spine", "dim_requester",
            "dim_risk_segment", "fact_credit_risk",
        )
    }
    refresh.build_layers(
        t.spark,
        warehouse,
        sources,
        selected=star_tables,
        # The given tables do not change, so their place identifies them.
        source_fingerprints={name: f"{t.sf_dir}:{name}" for name in sources},
    )
    star = refresh.published_tables(t.spark, warehouse)
    base = insights.portfolio_from_star(
        star["gold.fact_credit_risk"], star["gold.dim_requester"], star["gold.dim_risk_segment"]
    )
    return insights.dti_lift(base)


_QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {
    "segment_lift": lambda t: insights.segment_lift(t.portfolio, SEGMENT_MIN_CLIENTS, unique=True),
    "union_by_name_flag_test": lambda t: silver.union_applications(t.train, t.test),
    "application_labels_years": _application(silver.application_labels),
    "application_flags": _application(silver.application_flags),
    "application_ratios": _application(silver.application_ratios),
    "ext_source_stats": _application(silver.ext_source_stats),
    "inquiry_row_sum": _application(silver.inquiry_total),
    "fill_rates": _application(silver.fill_rates),
    "true_rates": _application(silver.true_rates),
    "overall_completeness": _application(silver.overall_completeness),
    "silver_applications": lambda t: t.applications,
    "bureau_features": lambda t: t.bureau,
    "bureau_balance_features": lambda t: t.bureau_balance,
    "previous_application_features": lambda t: t.previous,
    "installment_features": lambda t: t.payments,
    "card_features": lambda t: t.card,
    "pos_features": lambda t: t.pos,
    "bureau_balance_rollup": lambda t: silver.bureau_balance_rollup(t.bureau_balance),
    "external_behavior": lambda t: t.external_behavior,
    "installment_rollup": lambda t: silver.installment_rollup(t.payments),
    "card_rollup": lambda t: silver.card_rollup(t.card),
    "pos_rollup": lambda t: silver.pos_rollup(t.pos),
    "internal_behavior": lambda t: t.internal_behavior,
    "band_rule_usage": _band_rule_usage,
    "band_join_all": _band_join_all,
    "dense_key": _dense_key,
    "hot_key_attach": _hot_key_attach,
    "segment_external": lambda t: gold.consumer_view(t.external, "segment"),
    "segment_internal": lambda t: gold.consumer_view(t.internal, "segment"),
    "dim_requester": lambda t: gold.dim_requester(t.spine, t.rule_rows),
    "dim_contract": lambda t: gold.dim_contract(t.spine),
    "dim_risk_segment": lambda t: gold.dim_risk_segment(
        t.spine, t.internal, t.external, t.rule_rows
    ),
    "feature_store_external": lambda t: gold.consumer_view(t.external, "feature"),
    "feature_store_internal": lambda t: gold.consumer_view(t.internal, "feature"),
    "one_hot": lambda t: _features(t.applications, "sk_id_curr", rows.one_hot(vocab.ONE_HOT)),
    "feature_store": lambda t: gold.feature_store(t.applications, t.internal, t.external),
    "fact_base": lambda t: gold.labelled_base(t.applications),
    "fact_external": lambda t: gold.consumer_view(t.external, "fact"),
    "fact_internal": lambda t: gold.consumer_view(t.internal, "fact"),
    "fact_credit_risk": lambda t: gold.fact_credit_risk(t.spine, t.internal, t.external),
    "portfolio_kpis": lambda t: insights.portfolio_kpis(t.portfolio, unique=True),
    "default_split": lambda t: insights.default_split(t.portfolio),
    "humanised_kpis": lambda t: insights.humanised_kpis(t.portfolio, unique=True),
    "profile_distribution": lambda t: insights.profile_distribution(t.portfolio, unique=True),
    "profile_reindexed": lambda t: insights.profile_reindexed(t.portfolio, t.band_rules, unique=True),
    "risk_bucket": lambda t: insights.risk_buckets(
        insights.segment_lift(t.portfolio, SEGMENT_MIN_CLIENTS, unique=True)
    ),
    "dti_lift": lambda t: insights.dti_lift(t.portfolio),
    "dti_lift_pivot": lambda t: insights.dti_lift_pivot(t.portfolio, t.band_rules, t.rule_rows),
    "behavior_segments": lambda t: insights.behavior_segments(t.portfolio, unique=True),
    "top_behavior_segments": lambda t: insights.top_behavior_segments(t.portfolio, unique=True),
    "target_correlation": lambda t: insights.target_correlation(t.portfolio),
    "top_correlation": lambda t: insights.top_correlation(t.portfolio),
    "correlation_matrix": lambda t: insights.correlation_matrix(t.portfolio),
    "bool_domain_profile": _bool_domain_profile,
    "bool_normalise": _bool_normalise,
    "sentinel_profile": _sentinel_profile,
    "sentinel_replace": lambda t: _bronze(
        t.view("previous_application"), "previous_application.csv"
    ),
    "typed_cast": _typed_cast,
    "bronze_table": lambda t: _bronze(t.train, "application_train.csv"),
    "null_constraint_report": _null_constraints,
    "reconciliation": _reconciliation,
    "latest_event": lambda t: latest_event(t.event_log),
    "reuse_valid_result": _reuse_valid_result,
    "refresh_decision": _refresh_decision,
    "run_counters": lambda t: run_counters(t.event_log),
    "table_profile": _table_profile,
    "content_fingerprint": _content_fingerprint,
    "publish_roundtrip": _publish_roundtrip,
} | raw_queries.QUERIES


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(build: Callable[[Inputs], DataFrame]):
        return lambda spark, sf_dir: settle(build(Inputs(spark, sf_dir)))

    return {name: bound(build) for name, build in _QUERIES.items()}
