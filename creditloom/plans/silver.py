"""Silver layer: row-level features of each input table and the history roll-ups.

Row-level builders are projections.  Roll-ups are one ``groupBy`` each and the attach steps are
left joins between tables that are unique on the join key, so no join multiplies rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions import aggs, rows
from ..operators.attach import attach


def _extend(df: DataFrame, features: dict[str, Column]) -> DataFrame:
    return df.select("*", *[c.alias(n) for n, c in features.items()])


# --- applications ---------------------------------------------------------------------------


def union_applications(train: DataFrame, test: DataFrame) -> DataFrame:
    """Labelled and unlabelled applications, matched by name and marked by ``flag_test``."""
    labelled = train.withColumn("flag_test", F.lit(False))
    unlabelled = test.withColumn("flag_test", F.lit(True))
    return labelled.unionByName(unlabelled, allowMissingColumns=True)


def application_labels() -> dict[str, Column]:
    return {
        "name_type_suite_clean": rows.label_or("name_type_suite", vocab.UNKNOWN),
        "occupation_type_clean": rows.label_or("occupation_type", vocab.UNKNOWN),
        "age_years": rows.years_from_days("days_birth", vocab.DAYS_PER_YEAR),
        "employment_years": rows.years_from_days("days_employed", vocab.DAYS_PER_YEAR),
    }


def application_flags() -> dict[str, Column]:
    social_defaults = ["def_30_cnt_social_circle", "def_60_cnt_social_circle"]
    return {
        **rows.code_flags(vocab.LOAN_TYPE_FLAGS),
        "flag_employed": F.col("days_employed").isNotNull(),
        "flag_employment_missing": F.col("days_employed").isNull(),
        "flag_economically_inactive": F.col("name_income_type").isin(vocab.INACTIVE_INCOME_TYPES),
        **rows.code_flags(vocab.ACTIVITY_FLAGS),
        "flag_car_age_missing": F.col("own_car_age").isNull(),
        **{f"flag_{c}_missing": F.col(c).isNull() for c in vocab.EXT_SCORES},
        "flag_has_social_default": rows.any_positive(social_defaults),
        "flag_social_default_na": F.coalesce(*map(F.col, social_defaults)).isNull(),
        "flag_married": F.col("name_family_status").isin(vocab.MARRIED_STATUSES),
    }


def application_ratios() -> dict[str, Column]:
    return {
        "annuity_credit_ratio": rows.ratio_if_positive("amt_annuity", "amt_credit"),
        "loan_income_ratio": rows.ratio_or_null("amt_credit", "amt_income_total"),
        "annuity_income_ratio": rows.ratio_or_null("amt_annuity", "amt_income_total"),
        "debt_good_ratio": rows.ratio_or_null("amt_credit", "amt_goods_price"),
        "income_per_person": rows.ratio_or_null("amt_income_total", "cnt_fam_members"),
    }


def ext_source_stats() -> dict[str, Column]:
    scores = [F.col(c) for c in vocab.EXT_SCORES]
    return {
        "ext_source_count": rows.present_count(vocab.EXT_SCORES),
        "ext_source_mean": rows.row_mean(vocab.EXT_SCORES),
        "ext_source_max": F.greatest(*scores),
        "ext_source_min": F.least(*scores),
    }


def inquiry_total() -> dict[str, Column]:
    return {"total_credit_inquiries": rows.row_sum(vocab.BUREAU_REQUESTS)}


def fill_rates() -> dict[str, Column]:
    groups = {
        ("housing_info_filled_count", "housing_info_fill_rate"): vocab.HOUSING,
        ("core_profile_info_filled_count", "core_profile_info_filled_rate"): vocab.CORE_PROFILE,
        (
            "credit_bureau_request_info_filled_count",
            "credit_bureau_request_info_filled_rate",
        ): vocab.BUREAU_REQUESTS,
        ("social_circle_info_filled_count", "social_circle_info_filled_rate"): vocab.SOCIAL_CIRCLE,
    }
    features: dict[str, Column] = {}
    for (count_name, rate_name), columns in groups.items():
        filled = rows.present_count(columns)
        features[count_name] = filled
        features[rate_name] = rows.share_of(filled, len(columns))
    features["ext_source_missing_count"] = rows.missing_count(vocab.EXT_SCORES)
    features["ext_source_fill_rate"] = rows.share_of(
        rows.present_count(vocab.EXT_SCORES), len(vocab.EXT_SCORES)
    )
    return features


def true_rates() -> dict[str, Column]:
    groups = {
        ("contact_info_filled_count", "contact_info_filled_rate"): vocab.CONTACT,
        ("document_provided_count", "document_provided_rate"): vocab.DOCUMENTS,
    }
    features: dict[str, Column] = {}
    for (count_name, rate_name), columns in groups.items():
        given = rows.true_count(columns)
        features[count_name] = given
        features[rate_name] = rows.share_of(given, len(columns))
    return features


def overall_completeness() -> dict[str, Column]:
    """Completeness over all groups but documents; contact fields count when true."""
    present = (
        vocab.CORE_PROFILE + vocab.HOUSING + vocab.EXT_SCORES
        + vocab.BUREAU_REQUESTS + vocab.SOCIAL_CIRCLE
    )
    filled = rows.present_count(present) + rows.true_count(vocab.CONTACT)
    return {
        "cadastral_completeness_count": filled,
        "cadastral_completeness_rate": rows.share_of(filled, len(present) + len(vocab.CONTACT)),
    }


def applications(train: DataFrame, test: DataFrame) -> DataFrame:
    """One row per application with all row-level features."""
    return _extend(
        union_applications(train, test),
        {
            **application_labels(),
            **application_flags(),
            **application_ratios(),
            **ext_source_stats(),
            **inquiry_total(),
            **fill_rates(),
            **true_rates(),
            **overall_completeness(),
        },
    )


# --- history tables -------------------------------------------------------------------------


def bureau(df: DataFrame) -> DataFrame:
    age = F.abs("days_credit")
    return _extend(
        df,
        {
            "flag_debt_missing": F.col("amt_credit_sum_debt").isNull(),
            "flag_missing_annuity": F.col("amt_annuity").isNull(),
            "flag_has_dpd": F.coalesce("amt_credit_sum_overdue", F.lit(0.0)) > 0,
            "flag_recent_credit": age <= vocab.RECENT_DAYS,
            "flag_credit_was_prolonged": F.col("cnt_credit_prolong") > 0,
            **rows.code_flags(vocab.BUREAU_CODE_FLAGS),
            "debt_credit_ratio": rows.ratio_if_positive("amt_credit_sum_debt", "amt_credit_sum"),
            "overdue_credit_ratio": rows.ratio_if_positive(
                "amt_credit_sum_overdue", "amt_credit_sum"
            ),
            "credit_age_days": age,
        },
    )


def bureau_balance(df: DataFrame) -> DataFrame:
    status = F.col("status")
    age = F.abs("months_balance")
    overdue = status.isin(vocab.STATUS_OVERDUE)
    return _extend(
        df,
        {
            "status_numeric": F.when(status == vocab.STATUS_UNKNOWN, F.lit(None))
            .when(status == vocab.STATUS_CLOSED, F.lit(0))
            .otherwise(status.cast("int")),
            "flag_has_dpd": overdue,
            "flag_severe_dpd": status.isin(vocab.STATUS_SEVERE),
            "flag_recent_dpd": (age <= vocab.RECENT_MONTHS) & overdue,
            "flag_closed_credit": status == vocab.STATUS_CLOSED,
            "flag_missing_status": status == vocab.STATUS_UNKNOWN,
            "months_balance_abs": age,
        },
    )


def previous_application(df: DataFrame) -> DataFrame:
    return _extend(
        df,
        {
            "name_type_suite_clean": rows.label_or("name_type_suite", vocab.UNKNOWN),
            "amt_goods_price_known": F.col("amt_goods_price").isNotNull(),
            # Kept as published: true where the category is absent.
            "flag_goods_category_known": F.col("name_goods_category").isNull(),
            "flag_recent_application": F.abs("days_decision") <= vocab.RECENT_DAYS,
            "flag_long_term_payment": F.col("cnt_payment") >= vocab.LONG_TERM_PAYMENTS,
            **rows.code_flags(vocab.DECISION_FLAGS),
            **rows.code_flags(vocab.LOAN_TYPE_FLAGS),
            **rows.code_flags(vocab.REPEATER_FLAG),
            "credit_application_diff": F.col("amt_credit") - F.col("amt_application"),
            "goods_vs_application_ratio": rows.ratio_if_positive(
                "amt_application", "amt_goods_price"
            ),
            "approved_credit_ratio": rows.ratio_if_positive("amt_credit", "amt_application"),
            "annuity_credit_ratio": rows.ratio_if_positive("amt_annuity", "amt_credit"),
        },
    )


def installments_payments(df: DataFrame) -> DataFrame:
    paid_on, due_on = F.col("days_entry_payment"), F.col("days_instalment")
    return _extend(
        df,
        {
            "flag_early_payment": paid_on < due_on,
            "flag_late_payment": paid_on > due_on,
            "flag_partial_payment": F.col("amt_payment") < F.col("amt_instalment"),
            "flag_credit_card": F.col("num_instalment_number") == 0,
            "days_late": rows.excess("days_entry_payment", "days_instalment"),
            "payment_ratio": rows.ratio_if_positive("amt_payment", "amt_instalment"),
            "unpaid_amount": rows.excess("amt_instalment", "amt_payment"),
        },
    )


def credit_card_balance(df: DataFrame) -> DataFrame:
    has_limit = F.col("amt_credit_limit_actual") > 0
    used = rows.ratio_or_null("amt_balance", "amt_credit_limit_actual")
    return _extend(
        df,
        {
            "flag_high_utilization": has_limit & (used >= vocab.HIGH_UTILIZATION),
            "flag_over_utilization": has_limit & (used > vocab.FULL_UTILIZATION),
            "flag_minimum_payment": F.col("amt_payment_current")
            <= F.col("amt_inst_min_regularity"),
            "flag_cash_advance": F.col("amt_drawings_current") > 0,
            "flag_high_cash_advance": F.col("cnt_drawings_current") >= vocab.MANY_DRAWINGS,
            "credit_utilization_ratio": rows.ratio_if_positive(
                "amt_balance", "amt_credit_limit_actual"
            ),
        },
    )


def pos_cash_balance(df: DataFrame) -> DataFrame:
    return _extend(
        df,
        {
            "flag_has_dpd": F.col("sk_dpd") > 0,
            "flag_severe_dpd": F.col("sk_dpd") > vocab.SEVERE_DPD_DAYS,
            **rows.code_flags(vocab.ACTIVE_CONTRACT_FLAG),
            "flag_near_completion": F.col("cnt_instalment_future")
            <= vocab.NEAR_COMPLETION_PAYMENTS,
            "remaining_installment_ratio": rows.ratio_if_positive(
                "cnt_instalment_future", "cnt_instalment"
            ),
        },
    )


# --- roll-ups -------------------------------------------------------------------------------


def _named(columns: dict[str, Column]) -> list[Column]:
    return [c.alias(n) for n, c in columns.items()]


def bureau_balance_rollup(balance: DataFrame) -> DataFrame:
    """One row per bureau credit over its monthly statuses."""
    overdue, severe = aggs.true_rows("flag_has_dpd"), aggs.true_rows("flag_severe_dpd")
    return balance.groupBy("sk_bureau_id").agg(
        *_named(
            {
                "flag_has_dpd": aggs.any_true("flag_has_dpd"),
                "flag_severe_dpd": aggs.any_true("flag_severe_dpd"),
                "flag_has_recent_dpd": aggs.any_true("flag_recent_dpd"),
                "total_months": aggs.rows(),
                "closed_credit_months": aggs.true_rows("flag_closed_credit"),
                "dpd_1_30_months": aggs.tally("status_numeric = 1"),
                "dpd_31_60_months": aggs.tally("status_numeric = 2"),
                "dpd_61_90_months": aggs.tally("status_numeric = 3"),
                "dpd_90_plus_months": aggs.tally("status_numeric >= 4"),
                "total_dpd_months": overdue,
                "dpd_ratio": F.try_divide(overdue, aggs.rows()),
                "severe_dpd_months": severe,
                "severe_dpd_ratio": F.try_divide(severe, aggs.rows()),
                "max_dpd_status": F.max("status_numeric"),
            }
        )
    )


def external_behavior(bureau_rows: DataFrame, balance: DataFrame) -> DataFrame:
    """One row per bureau credit with its monthly behaviour attached."""
    months = bureau_balance_rollup(balance).withColumnsRenamed(
        {"flag_has_dpd": "months_had_dpd", "flag_severe_dpd": "months_had_severe_dpd"}
    )
    joined = attach(bureau_rows, months, "sk_bureau_id", missing_flag="flag_balance_missing")
    overdue_days = F.col("credit_day_overdue")
    kept = [c for c in months.columns if c not in ("sk_bureau_id",) and not c.startswith("months_had")]
    return joined.select(
        *bureau_rows.columns,
        "flag_balance_missing",
        # NULL OR false stays NULL: nothing is known without a balance or an overdue day.
        (F.col("months_had_dpd") | (overdue_days > 0)).alias("flag_has_dpd_agg"),
        (F.col("months_had_severe_dpd") | (overdue_days > vocab.SEVERE_DPD_DAYS)).alias(
            "flag_severe_dpd_agg"
        ),
        *kept,
    )


def installment_rollup(payments: DataFrame) -> DataFrame:
    return payments.groupBy("sk_id_prev").agg(
        *_named(
            {
                "flag_installment_late_payment": aggs.any_true("flag_late_payment"),
                "flag_installment_early_payment": aggs.any_true("flag_early_payment"),
                "flag_installment_partial_payment": aggs.any_true("flag_partial_payment"),
                "total_installments": aggs.rows(),
                # Kept as published: a sum despite the name.
                "installment_total_avg_days_late": F.sum("days_late"),
                "installment_avg_days_late": F.avg("days_late"),
                "installment_max_days_late": F.max("days_late"),
                "total_amt_payment": F.sum("amt_payment"),
                "total_amt_installment": F.sum("amt_instalment"),
                "wavg_payment_ratio": aggs.ratio_of_sums("amt_payment", "amt_instalment"),
                "max_payment_ratio": F.max("payment_ratio"),
                "installment_late_payment_ratio": aggs.share("flag_late_payment"),
                "installment_partial_payment_ratio": aggs.share("flag_partial_payment"),
                "installment_total_unpaid_amount": F.sum("unpaid_amount"),
            }
        )
    )


def card_rollup(card: DataFrame) -> DataFrame:
    return card.groupBy("sk_id_prev").agg(
        *_named(
            {
                "flag_card_high_utilization": aggs.any_true("flag_high_utilization"),
                "flag_card_over_utilization": aggs.any_true("flag_over_utilization"),
                "total_credit_card_records": aggs.rows(),
                "card_total_dpd": F.sum("sk_dpd"),
                "card_avg_dpd": F.avg("sk_dpd"),
                "total_amt_balance": F.sum("amt_balance"),
                "total_credit_limit": F.sum("amt_credit_limit_actual"),
                "wavg_credit_utilization": aggs.ratio_of_sums(
                    "amt_balance", "amt_credit_limit_actual"
                ),
                "max_credit_utilization": F.max("credit_utilization_ratio"),
                # Kept as published: both counts are plain row counts.
                "card_high_utilization_count": aggs.rows(),
                "card_over_utilization_count": aggs.rows(),
                "card_high_utilization_ratio": aggs.share("flag_high_utilization"),
                "card_over_utilization_ratio": aggs.share("flag_over_utilization"),
                "card_minimum_payment_ratio": aggs.share("flag_minimum_payment"),
                "card_cash_advance_ratio": aggs.share("flag_cash_advance"),
            }
        )
    )


def pos_rollup(pos: DataFrame) -> DataFrame:
    return pos.groupBy("sk_id_prev").agg(
        *_named(
            {
                "flag_pos_dpd": aggs.any_true("flag_has_dpd"),
                "flag_pos_severe_dpd": aggs.any_true("flag_severe_dpd"),
                "total_pos_cash_records": aggs.rows(),
                "pos_dpd_ratio": aggs.share("flag_has_dpd"),
                "pos_severe_dpd_ratio": aggs.share("flag_severe_dpd"),
                "pos_total_dpd": F.sum("sk_dpd"),
                "pos_avg_dpd": F.avg("sk_dpd"),
            }
        )
    )


def internal_behavior(
    previous: DataFrame, payments: DataFrame, card: DataFrame, pos: DataFrame
) -> DataFrame:
    """One row per previous application with instalment, card and POS behaviour attached.

    All four sides meet on ``sk_id_prev``: each roll-up is already partitioned by it when it is
    joined, so the only extra exchange is that of ``previous``.
    """
    histories = [
        (
            installment_rollup(payments).drop("flag_installment_early_payment"),
            "flag_installments_info_missing",
        ),
        (card_rollup(card), "flag_credit_card_info_missing"),
        (pos_rollup(pos), "flag_pos_info_missing"),
    ]
    joined = previous
    for rollup, missing_flag in histories:
        joined = attach(joined, rollup, "sk_id_prev", missing_flag=missing_flag)
    details = [c for rollup, _ in histories for c in rollup.columns if c != "sk_id_prev"]
    return joined.select(*previous.columns, *[flag for _, flag in histories], *details)
