"""Gold layer: band rules, star schema and feature store.

The three consumers of each history (feature store, risk segment, fact) are computed in one
``groupBy(sk_id_curr)`` per history and then projected; unused aggregates are pruned by Catalyst.
All three dimension keys number the same applications in the same order, so the order is
established once (``application_spine``) and the star needs no key look-up joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from .. import vocab
from ..functions import aggs, rows
from ..operators.attach import attach
from ..operators.bands import band_label
from ..operators.keys import dense_key
from ..sources.rules import default_band_rules

CLIENT = "sk_id_curr"
SPINE_KEY = "application_key"
NO_BUREAU, NO_PREVIOUS = "flag_missing_bureau_info", "flag_missing_prev_applications_info"

# Published columns that are taken over from the applications table
REQUESTER_COLUMNS = [
    "code_gender", "age_years", "age_band", "name_family_status", "flag_married",
    "name_type_suite_clean", "name_income_type", "occupation_type_clean", "income_band",
    "flag_employed", "flag_employment_missing", "flag_economically_inactive",
    "flag_self_employed", "flag_unemployed", "flag_student", "flag_pensioner",
    "flag_maternity_leave", "employment_years", "employment_tenure_band", "organization_type",
    "name_education_type", "flag_own_car", "own_car_age", "flag_car_age_missing",
    "flag_own_realty", "name_housing_type",
]
CONTRACT_COLUMNS = ["name_contract_type", *vocab.LOAN_TYPE_FLAGS, "flag_social_default_na"]
SCORE_FLAGS = [f"flag_{c}_missing" for c in vocab.EXT_SCORES]
AMOUNTS = ["amt_credit", "amt_annuity", "amt_goods_price", "amt_income_total"]
APPLICATION_RATIOS = [
    "annuity_credit_ratio", "annuity_income_ratio", "loan_income_ratio", "debt_good_ratio",
    "income_per_person",
]
SCORE_STATS = ["ext_source_count", "ext_source_mean", "ext_source_max", "ext_source_min"]
FACT_APPLICATION_COLUMNS = [
    "target", *AMOUNTS, *APPLICATION_RATIOS, "cnt_children", "cnt_fam_members",
    "employment_years", *SCORE_STATS, "total_credit_inquiries",
    "housing_info_filled_count", "housing_info_fill_rate",
    "contact_info_filled_count", "contact_info_filled_rate",
    "ext_source_missing_count", "ext_source_fill_rate",
    "social_circle_info_filled_count", "social_circle_info_filled_rate",
    "document_provided_count", "document_provided_rate",
]
FEATURE_APPLICATION_COLUMNS = [
    "target", "flag_test", *vocab.LOAN_TYPE_FLAGS, *AMOUNTS, *APPLICATION_RATIOS,
    "cnt_children", "cnt_fam_members", "age_years", "employment_years",
    "flag_employed", "flag_employment_missing", "flag_economically_inactive",
    "flag_self_employed", "flag_unemployed", "flag_student", "flag_married",
    "flag_own_car", "flag_car_age_missing", "flag_own_realty",
    "weekday_appr_process_start", "hour_appr_process_start", "days_registration",
    "days_id_publish", "days_last_phone_change", "region_population_relative",
    "region_rating_client", "region_rating_client_w_city", *vocab.REGION_MISMATCH,
    *SCORE_FLAGS, *SCORE_STATS, "total_credit_inquiries",
    "def_30_cnt_social_circle", "def_60_cnt_social_circle",
    "flag_has_social_default", "flag_social_default_na",
    "housing_info_fill_rate", "contact_info_filled_rate", "core_profile_info_filled_rate",
    "ext_source_missing_count", "ext_source_fill_rate",
    "credit_bureau_request_info_filled_rate", "social_circle_info_filled_rate",
    "document_provided_rate", "cadastral_completeness_rate",
]

# History flags behind the published aggregates (aggregate -> flag)
SEGMENT_INTERNAL_FLAGS = {
    "flag_repeater": "flag_repeater",
    "flag_high_card_user": "flag_card_high_utilization",
    "flag_has_overused_card": "flag_card_over_utilization",
    "flag_has_had_late_payment": "flag_installment_late_payment",
    "internal_pos_dpd": "flag_pos_dpd",
    "internal_pos_severe_dpd": "flag_pos_severe_dpd",
}
SEGMENT_EXTERNAL_FLAGS = {
    "external_had_dpd": "flag_has_dpd_agg",
    "external_severe_dpd": "flag_severe_dpd_agg",
    "external_bad_debt": "flag_bad_debt",
    "external_recent_credit": "flag_recent_credit",
}
EXTERNAL_TALLIES = {
    "bureau_active_loans": "flag_active_credit",
    "bureau_bad_debt_loans": "flag_bad_debt",
    "bureau_prolonged_loans": "flag_credit_was_prolonged",
    "bureau_consumer_credit_loans": "flag_consumer_credit",
    "bureau_credit_card_loans": "flag_credit_card",
    "bureau_car_loans": "flag_car_loan",
    "bureau_mortgage_loans": "flag_mortgage",
    "bureau_total_loans_with_dpd": "flag_has_dpd_agg",
    "bureau_total_loans_with_severe_dpd": "flag_severe_dpd_agg",
    "bureau_total_loans_with_recent_dpd": "flag_has_recent_dpd",
    "bureau_recent_credit_count": "flag_recent_credit",
}
PREVIOUS_SHARES = {
    "prev_approval_rate": "flag_approved_application",
    "prev_refusal_rate": "flag_refused_application",
    "prev_cancel_rate": "flag_canceled_application",
    "prev_cash_loan_rate": "flag_cash_loan",
    "prev_revolving_loan_rate": "flag_revolving_loan",
    "prev_consumer_loan_rate": "flag_consumer_loan",
    "prev_recent_application_rate": "flag_recent_application",
    "prev_long_term_payment_rate": "flag_long_term_payment",
}
PREVIOUS_AVAILABLE = {
    "prev_installments_available_rate": "flag_installments_info_missing",
    "prev_credit_card_available_rate": "flag_credit_card_info_missing",
    "prev_pos_available_rate": "flag_pos_info_missing",
}
PREVIOUS_ANY = {
    "flag_repeater": "flag_repeater",
    "flag_has_had_late_payment": "flag_installment_late_payment",
    "flag_has_had_partial_payment": "flag_installment_partial_payment",
    "flag_has_had_pos_dpd": "flag_pos_dpd",
    "flag_has_had_pos_severe_dpd": "flag_pos_severe_dpd",
}
PREVIOUS_AVERAGES = {
    "prev_avg_application_amt": "amt_application",
    "prev_avg_given_credit": "amt_credit",
    "prev_avg_cnt_payment": "cnt_payment",
    "prev_avg_down_payment": "amt_down_payment",
    "prev_avg_goods_price": "amt_goods_price",
    "prev_avg_approved_credit_ratio": "approved_credit_ratio",
    "prev_avg_annuity_credit_ratio": "annuity_credit_ratio",
    "prev_avg_goods_vs_application_ratio": "goods_vs_application_ratio",
    "prev_avg_days_late_installments": "installment_avg_days_late",
    "prev_avg_late_payment_ratio": "installment_late_payment_ratio",
    "prev_avg_partial_payment_ratio": "installment_partial_payment_ratio",
    "avg_payment_ratio": "wavg_payment_ratio",
    "prev_avg_pos_dpd_ratio": "pos_dpd_ratio",
    "prev_avg_pos_severe_dpd_ratio": "pos_severe_dpd_ratio",
    "pos_avg_dpd": "pos_avg_dpd",
}
PREVIOUS_MAXIMA = {
    "prev_max_application_amt": "amt_application",
    "prev_max_given_credit": "amt_credit",
    "prev_max_cnt_payment": "cnt_payment",
    "prev_max_days_late_installments": "installment_max_days_late",
    "max_payment_ratio": "max_payment_ratio",
}
FACT_PREVIOUS_COUNTS = {
    "prev_applications_approved": "flag_approved_application",
    "prev_applications_refused": "flag_refused_application",
    "prev_applications_canceled": "flag_canceled_application",
    "prev_cash_loan_count": "flag_cash_loan",
    "prev_revolving_loan_count": "flag_revolving_loan",
    "prev_consumer_loan_count": "flag_consumer_loan",
    "prev_recent_application_count": "flag_recent_application",
    "prev_long_term_pay_application_count": "flag_long_term_payment",
}


# --- per-client roll-ups --------------------------------------------------------------------


def segment_external() -> dict[str, Column]:
    return {
        **{name: aggs.any_true(flag) for name, flag in SEGMENT_EXTERNAL_FLAGS.items()},
        "max_external_dpd_status": F.max("max_dpd_status"),
    }


def feature_external() -> dict[str, Column]:
    return {
        "bureau_total_loans": aggs.rows(),
        **{name: aggs.tally(flag) for name, flag in EXTERNAL_TALLIES.items()},
        "bureau_avg_credit": F.avg("amt_credit_sum"),
        "bureau_max_credit": F.max("amt_credit_sum"),
        "bureau_avg_debt": F.avg("amt_credit_sum_debt"),
        "bureau_max_debt": F.max("amt_credit_sum_debt"),
        "bureau_total_overdue_amount": F.sum("amt_credit_sum_overdue"),
        "bureau_max_overdue_amount": F.max("amt_credit_sum_overdue"),
        "bureau_avg_overdue_credit_ratio": F.avg("overdue_credit_ratio"),
        "bureau_max_overdue_credit_ratio": F.max("overdue_credit_ratio"),
        "bureau_avg_debt_credit_ratio": F.avg("debt_credit_ratio"),
        "bureau_max_debt_credit_ratio": F.max("debt_credit_ratio"),
        "bureau_avg_credit_age_days": F.avg("credit_age_days"),
        "bureau_min_credit_age_days": F.min("credit_age_days"),
    }


def fact_external() -> dict[str, Column]:
    # Recency and monthly status are only known where the credit has a monthly balance.
    observed = ~F.col("flag_balance_missing")
    return {
        "bureau_total_loans": aggs.rows(),
        "bureau_active_loans": aggs.true_rows("flag_active_credit"),
        "bureau_bad_debt_loans": aggs.true_rows("flag_bad_debt"),
        "bureau_total_credit": F.sum("amt_credit_sum"),
        "bureau_avg_credit": F.avg("amt_credit_sum"),
        "bureau_total_loans_with_dpd": aggs.tally("flag_has_dpd_agg"),
        "bureau_total_loans_with_severe_dpd": aggs.tally("flag_severe_dpd_agg"),
        "bureau_recent_credit_count": F.sum(
            F.when(observed, F.col("flag_recent_credit").cast("long"))
        ),
        "bureau_max_dpd_status": F.max(F.when(observed, F.col("max_dpd_status"))),
        "bureau_total_overdue_amount": F.sum("amt_credit_sum_overdue"),
        "bureau_avg_overdue_credit_ratio": F.avg("overdue_credit_ratio"),
        "bureau_avg_debt_credit_ratio": F.avg("debt_credit_ratio"),
        "bureau_max_debt_credit_ratio": F.max("debt_credit_ratio"),
        "bureau_avg_credit_age_days": F.avg("credit_age_days"),
    }


def segment_internal() -> dict[str, Column]:
    return {name: aggs.any_true(flag) for name, flag in SEGMENT_INTERNAL_FLAGS.items()}


def feature_internal() -> dict[str, Column]:
    since_decision = F.abs("days_decision")
    return {
        "prev_applications_total": aggs.rows(),
        **{name: aggs.share(flag) for name, flag in PREVIOUS_SHARES.items()},
        **{name: aggs.share(f"NOT {flag}") for name, flag in PREVIOUS_AVAILABLE.items()},
        **{name: aggs.any_true(flag) for name, flag in PREVIOUS_ANY.items()},
        **{name: F.avg(column) for name, column in PREVIOUS_AVERAGES.items()},
        **{name: F.max(column) for name, column in PREVIOUS_MAXIMA.items()},
        "prev_avg_days_since_decision": F.avg(since_decision),
        "prev_min_days_since_decision": F.min(since_decision),
        "prev_total_installments": F.sum("total_installments"),
        "prev_unpaid_amount_for_installments": F.sum("installment_total_unpaid_amount"),
    }


def fact_internal() -> dict[str, Column]:
    return {
        "prev_total_application_amt": F.sum("amt_application"),
        "prev_total_given_credit": F.sum("amt_credit"),
        "prev_avg_given_credit": F.avg("amt_credit"),
        "prev_approved_credit_ratio": aggs.ratio_of_positive_sums("amt_credit", "amt_application"),
        "prev_goods_vs_application_ratio": aggs.ratio_of_positive_sums(
            "amt_application", "amt_goods_price"
        ),
        "prev_applications_total": aggs.rows(),
        **{name: aggs.true_rows(flag) for name, flag in FACT_PREVIOUS_COUNTS.items()},
        "max_credit_utilization": F.max("max_credit_utilization"),
        "avg_credit_utilization": aggs.ratio_of_sums("total_amt_balance", "total_credit_limit"),
        "prev_unpaid_amount_for_installments": F.sum("installment_total_unpaid_amount"),
        "max_payment_ratio": F.max("max_payment_ratio"),
        "avg_payment_ratio": aggs.ratio_of_sums("total_amt_payment", "total_amt_installment"),
        "pos_total_dpd": F.sum("pos_total_dpd"),
        # Kept as published: the mean of totals, unlike the feature store's mean of means.
        "pos_avg_dpd": F.avg("pos_total_dpd"),
    }


# The same published name can mean different things in two tables, so the shared roll-up keeps
# one prefix per consumer.
_EXTERNAL = {"segment": segment_external, "feature": feature_external, "fact": fact_external}
_INTERNAL = {"segment": segment_internal, "feature": feature_internal, "fact": fact_internal}


def _client_rollup(behavior: DataFrame, consumers: dict) -> DataFrame:
    return behavior.groupBy(CLIENT).agg(
        *[
            column.alias(f"{consumer}__{name}")
            for consumer, columns in consumers.items()
            for name, column in columns().items()
        ]
    )


def client_external(external_behavior: DataFrame) -> DataFrame:
    """Every external aggregate of every gold table, one row per client, one shuffle."""
    return _client_rollup(external_behavior, _EXTERNAL)


def client_internal(internal_behavior: DataFrame) -> DataFrame:
    """Every internal aggregate of every gold table, one row per client, one shuffle."""
    return _client_rollup(internal_behavior, _INTERNAL)


def consumer_view(rollup: DataFrame, consumer: str) -> DataFrame:
    """The columns of one consumer under their published names."""
    prefix = f"{consumer}__"
    own = [c for c in rollup.columns if c.startswith(prefix)]
    return rollup.select(CLIENT, *own).withColumnsRenamed({c: c.removeprefix(prefix) for c in own})


# --- bands ----------------------------------------------------------------------------------


def ref_band_rules(spark: SparkSession) -> DataFrame:
    return default_band_rules(spark)


def requester_bands(rules: Sequence[Row]) -> dict[str, Column]:
    return {
        "age_band": band_label("age_years", rules, "age_band"),
        "income_band": band_label("amt_income_total", rules, "income_band"),
        "employment_tenure_band": band_label("employment_years", rules, "employment_tenure_band"
        ),
    }


def risk_bands(rules: Sequence[Row]) -> dict[str, Column]:
    return {
        "mean_score_band": band_label("ext_source_mean", rules, "score_band"),
        "annuity_income_band": band_label("annuity_income_ratio", rules, "annuity_income_band"
        ),
    }


# --- star schema ----------------------------------------------------------------------------


def _unique(columns: Sequence[str]) -> list[str]:
    return list(dict.fromkeys(columns))


def spine_columns() -> list[str]:
    """Application columns that the dimensions or the fact need."""
    banded = set(("age_band", "income_band", "employment_tenure_band"))
    return _unique(
        [CLIENT, "flag_test"]
        + [c for c in REQUESTER_COLUMNS if c not in banded]
        + CONTRACT_COLUMNS
        + vocab.EXT_SCORES
        + SCORE_FLAGS
        + FACT_APPLICATION_COLUMNS
    )


def application_spine(applications: DataFrame) -> DataFrame:
    """Applications numbered 1..n by client; the one place where the star's order is made."""
    return dense_key(applications.select(*spine_columns()), CLIENT, SPINE_KEY)


def dim_requester(spine: DataFrame, rules: Sequence[Row]) -> DataFrame:
    return spine.withColumns(requester_bands(rules)).select(
        F.col(SPINE_KEY).alias("requester_key"), CLIENT, *REQUESTER_COLUMNS
    )


def dim_contract(spine: DataFrame) -> DataFrame:
    return spine.select(F.col(SPINE_KEY).alias("contract_key"), CLIENT, *CONTRACT_COLUMNS)


def dim_risk_segment(
    spine: DataFrame, internal: DataFrame, external: DataFrame, rules: Sequence[Row]
) -> DataFrame:
    """Risk signals per application; ``internal`` and ``external`` are the client roll-ups."""
    inner, outer = consumer_view(internal, "segment"), consumer_view(external, "segment")
    joined = attach(spine.withColumns(risk_bands(rules)), outer, CLIENT, NO_BUREAU)
    joined = attach(joined, inner, CLIENT, NO_PREVIOUS)
    return joined.select(
        F.col(SPINE_KEY).alias("risk_segment_key"),
        CLIENT,
        *inner.columns[1:],
        *outer.columns[1:],
        "mean_score_band",
        "annuity_income_band",
        NO_PREVIOUS,
        NO_BUREAU,
        *vocab.EXT_SCORES,
        *SCORE_FLAGS,
    )


def labelled_base(applications: DataFrame) -> DataFrame:
    """Fact base: labelled applications only, filtered before any join."""
    return applications.where(~F.col("flag_test")).select(CLIENT, *FACT_APPLICATION_COLUMNS)


def fact_credit_risk(spine: DataFrame, internal: DataFrame, external: DataFrame) -> DataFrame:
    """Central fact of labelled applications with dimension keys and history metrics."""
    inner, outer = consumer_view(internal, "fact"), consumer_view(external, "fact")
    base = spine.where(~F.col("flag_test"))
    joined = attach(attach(base, outer, CLIENT), inner, CLIENT)
    keys = [
        F.col(SPINE_KEY).alias(k) for k in ("requester_key", "contract_key", "risk_segment_key")
    ]
    return joined.select(
        CLIENT, *keys, *FACT_APPLICATION_COLUMNS, *outer.columns[1:], *inner.columns[1:]
    )


# --- feature store --------------------------------------------------------------------------


def feature_store(
    applications: DataFrame, internal: DataFrame, external: DataFrame
) -> DataFrame:
    """Modelling table: application features, one-hot codes and both histories."""
    inner, outer = consumer_view(internal, "feature"), consumer_view(external, "feature")
    encoded = rows.one_hot(vocab.ONE_HOT)
    base = applications.select(
        CLIENT,
        *FEATURE_APPLICATION_COLUMNS,
        *[column.alias(name) for name, column in encoded.items()],
    )
    joined = attach(base, outer, CLIENT, NO_BUREAU)
    joined = attach(joined, inner, CLIENT, NO_PREVIOUS)
    return joined.select(
        *base.columns, NO_BUREAU, *outer.columns[1:], NO_PREVIOUS, *inner.columns[1:]
    )
