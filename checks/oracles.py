"""The checking side: each registered query as SQL over the same tables.

Written apart from the Spark code and in the checking engine's own idiom (list functions,
``FILTER``, ``arg_max``).  The tables of the layers are CTEs; a query names those
it needs.
"""

from __future__ import annotations

from creditloom import vocab
from creditloom.plans import gold
from creditloom.sources import adapter

from . import raw_oracles
from .precision import settle_sql
from .queries import SEGMENT_MIN_CLIENTS
from .raw_oracles import BRONZE_PREVIOUS, TRAIN, WRITTEN


def _quoted(text: str | None) -> str:
    return "NULL" if text is None else "'" + str(text).replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(_quoted(v) for v in values) + ")"


def _ints(columns: list[str], test: str) -> str:
    """Number of columns that pass the test, as INTEGER."""
    return "CAST(" + " + ".join(f"CAST({test.format(c)} AS INTEGER)" for c in columns) + " AS INTEGER)"


def _present(columns: list[str]) -> str:
    return _ints(columns, "({0} IS NOT NULL)")


def _absent(columns: list[str]) -> str:
    return _ints(columns, "({0} IS NULL)")


def _set(columns: list[str]) -> str:
    return _ints(columns, "coalesce({0}, false)")


def _equalities(flags: dict) -> str:
    return ", ".join(f"({col} = {_quoted(code)}) AS {flag}" for flag, (col, code) in flags.items())


def _ratio_pos(n: str, d: str) -> str:
    return f"if({d} > 0, {n} / {d}, NULL)"


SCORES = "[" + ", ".join(vocab.EXT_SCORES) + "]"
INQUIRIES = "[" + ", ".join(vocab.BUREAU_REQUESTS) + "]"

LABELS = (
    "coalesce(name_type_suite, 'Unknown') AS name_type_suite_clean, "
    "coalesce(occupation_type, 'Unknown') AS occupation_type_clean, "
    "abs(days_birth) / 365.0e0 AS age_years, abs(days_employed) / 365.0e0 AS employment_years"
)
SOCIAL_LIST = "list_filter([def_30_cnt_social_circle, def_60_cnt_social_circle], lambda v: v IS NOT NULL)"
FLAGS = (
    f"{_equalities(vocab.LOAN_TYPE_FLAGS)}, "
    "days_employed IS NOT NULL AS flag_employed, days_employed IS NULL AS flag_employment_missing, "
    f"name_income_type IN {_in(vocab.INACTIVE_INCOME_TYPES)} AS flag_economically_inactive, "
    f"{_equalities(vocab.ACTIVITY_FLAGS)}, own_car_age IS NULL AS flag_car_age_missing, "
    + ", ".join(f"{c} IS NULL AS flag_{c}_missing" for c in vocab.EXT_SCORES)
    + f", list_sum({SOCIAL_LIST}) > 0 AS flag_has_social_default, "
    f"len({SOCIAL_LIST}) = 0 AS flag_social_default_na, "
    f"name_family_status IN {_in(vocab.MARRIED_STATUSES)} AS flag_married"
)
RATIOS = (
    f"{_ratio_pos('amt_annuity', 'amt_credit')} AS annuity_credit_ratio, "
    "amt_credit / nullif(amt_income_total, 0) AS loan_income_ratio, "
    "amt_annuity / nullif(amt_income_total, 0) AS annuity_income_ratio, "
    "amt_credit / nullif(amt_goods_price, 0) AS debt_good_ratio, "
    "amt_income_total / nullif(cnt_fam_members, 0) AS income_per_person"
)
SCORE_STATS = (
    f"CAST(len(list_filter({SCORES}, lambda v: v IS NOT NULL)) AS INTEGER) AS ext_source_count, "
    f"list_avg({SCORES}) AS ext_source_mean, list_max({SCORES}) AS ext_source_max, "
    f"list_min({SCORES}) AS ext_source_min"
)
INQUIRY_SUM = f"list_sum({INQUIRIES}) AS total_credit_inquiries"
FILLS = ", ".join(
    f"{_present(cols)} AS {count}, {_present(cols)} / {len(cols)}.0e0 AS {rate}"
    for count, rate, cols in [
        ("housing_info_filled_count", "housing_info_fill_rate", vocab.HOUSING),
        ("core_profile_info_filled_count", "core_profile_info_filled_rate", vocab.CORE_PROFILE),
        (
            "credit_bureau_request_info_filled_count",
            "credit_bureau_request_info_filled_rate",
            vocab.BUREAU_REQUESTS,
        ),
        ("social_circle_info_filled_count", "social_circle_info_filled_rate", vocab.SOCIAL_CIRCLE),
    ]
) + (
    f", {_absent(vocab.EXT_SCORES)} AS ext_source_missing_count, "
    f"{_present(vocab.EXT_SCORES)} / 3.0e0 AS ext_source_fill_rate"
)
TRUES = (
    f"{_set(vocab.CONTACT)} AS contact_info_filled_count, "
    f"{_set(vocab.CONTACT)} / 6.0e0 AS contact_info_filled_rate, "
    f"{_set(vocab.DOCUMENTS)} AS document_provided_count, "
    f"{_set(vocab.DOCUMENTS)} / 20.0e0 AS document_provided_rate"
)
_ALL_PRESENT = _present(
    vocab.HOUSING + vocab.CORE_PROFILE + vocab.SOCIAL_CIRCLE + vocab.BUREAU_REQUESTS + vocab.EXT_SCORES
)
OVERALL = (
    f"{_ALL_PRESENT} + {_set(vocab.CONTACT)} AS cadastral_completeness_count, "
    f"({_ALL_PRESENT} + {_set(vocab.CONTACT)}) / 46.0e0 AS cadastral_completeness_rate"
)


def _band(value: str, group: str) -> str:
    """Label by the rule table as a correlated look-up."""
    return (
        f"(SELECT r.band_label FROM band_rules r WHERE r.band_group = '{group}' AND "
        f"CASE WHEN {value} IS NULL THEN r.is_null_band ELSE NOT r.is_null_band AND "
        f"{value} >= coalesce(r.lower_bound, '-inf'::DOUBLE) AND "
        f"(r.upper_bound IS NULL OR {value} < r.upper_bound) END)"
    )


def _rule_rows() -> str:
    def text(v):
        if isinstance(v, bool):
            return str(v).lower()
        if isinstance(v, float):
            return f"{v!r}::DOUBLE"
        return str(v) if isinstance(v, int) else _quoted(v)

    return ", ".join("(" + ", ".join(text(v) for v in rule) + ")" for rule in vocab.BAND_RULES)


def _maybe(agg: str, flags: dict) -> str:
    return ", ".join(f"{agg.format(flag)} AS {name}" for name, flag in flags.items())


BIG = "CAST({0} AS BIGINT)"
N_TRUE = "CAST(sum(CAST({0} AS INTEGER)) AS BIGINT)"

CTES: dict[str, str] = {
    **{name: adapter.duckdb_view(name) for name in adapter.VIEWS},
    "band_rules": (
        "SELECT band_group, source_column, CAST(band_order AS INTEGER) AS band_order, band_label, "
        "CAST(lower_bound AS DOUBLE) AS lower_bound, CAST(upper_bound AS DOUBLE) AS upper_bound, "
        "lower_inclusive, upper_inclusive, is_null_band, CAST(description AS VARCHAR) AS description "
        f"FROM (VALUES {_rule_rows()}) v(band_group, source_column, band_order, band_label, "
        "lower_bound, upper_bound, lower_inclusive, upper_inclusive, is_null_band, description)"
    ),
    "s_app": (
        f"SELECT *, {LABELS}, {FLAGS}, {RATIOS}, {SCORE_STATS}, {INQUIRY_SUM}, {FILLS}, {TRUES}, "
        f"{OVERALL} FROM applications"
    ),
    "s_bureau": (
        "SELECT *, amt_credit_sum_debt IS NULL AS flag_debt_missing, "
        "amt_annuity IS NULL AS flag_missing_annuity, "
        "coalesce(amt_credit_sum_overdue > 0, false) AS flag_has_dpd, "
        "days_credit BETWEEN -30 AND 30 AS flag_recent_credit, "
        "cnt_credit_prolong >= 1 AS flag_credit_was_prolonged, "
        f"{_equalities(vocab.BUREAU_CODE_FLAGS)}, "
        f"{_ratio_pos('amt_credit_sum_debt', 'amt_credit_sum')} AS debt_credit_ratio, "
        f"{_ratio_pos('amt_credit_sum_overdue', 'amt_credit_sum')} AS overdue_credit_ratio, "
        "abs(days_credit) AS credit_age_days FROM bureau"
    ),
    "s_balance": (
        "SELECT *, CASE status WHEN 'X' THEN NULL WHEN 'C' THEN 0 ELSE CAST(status AS INTEGER) END "
        "AS status_numeric, status BETWEEN '1' AND '5' AS flag_has_dpd, "
        "status BETWEEN '3' AND '5' AS flag_severe_dpd, "
        "months_balance BETWEEN -1 AND 1 AND status BETWEEN '1' AND '5' AS flag_recent_dpd, "
        "status = 'C' AS flag_closed_credit, status = 'X' AS flag_missing_status, "
        "abs(months_balance) AS months_balance_abs FROM bureau_balance"
    ),
    "s_prev": (
        "SELECT *, coalesce(name_type_suite, 'Unknown') AS name_type_suite_clean, "
        "amt_goods_price IS NOT NULL AS amt_goods_price_known, "
        "name_goods_category IS NULL AS flag_goods_category_known, "
        "days_decision BETWEEN -30 AND 30 AS flag_recent_application, "
        "cnt_payment >= 24 AS flag_long_term_payment, "
        f"{_equalities(vocab.DECISION_FLAGS)}, {_equalities(vocab.LOAN_TYPE_FLAGS)}, "
        f"{_equalities(vocab.REPEATER_FLAG)}, amt_credit - amt_application AS credit_application_diff, "
        f"{_ratio_pos('amt_application', 'amt_goods_price')} AS goods_vs_application_ratio, "
        f"{_ratio_pos('amt_credit', 'amt_application')} AS approved_credit_ratio, "
        f"{_ratio_pos('amt_annuity', 'amt_credit')} AS annuity_credit_ratio "
        "FROM previous_application"
    ),
    "s_inst": (
        "SELECT *, days_entry_payment < days_instalment AS flag_early_payment, "
        "days_instalment < days_entry_payment AS flag_late_payment, "
        "amt_instalment > amt_payment AS flag_partial_payment, "
        "num_instalment_number = 0 AS flag_credit_card, "
        "if(days_entry_payment > days_instalment, days_entry_payment - days_instalment, 0.0e0) AS days_late, "
        f"{_ratio_pos('amt_payment', 'amt_instalment')} AS payment_ratio, "
        "if(amt_instalment > amt_payment, amt_instalment - amt_payment, 0.0e0) AS unpaid_amount "
        "FROM installments_payments"
    ),
    "s_card": (
        "SELECT * EXCLUDE (u), if(amt_credit_limit_actual > 0, u >= 0.8e0, false) AS flag_high_utilization, "
        "if(amt_credit_limit_actual > 0, u > 1, false) AS flag_over_utilization, "
        "amt_inst_min_regularity >= amt_payment_current AS flag_minimum_payment, "
        "amt_drawings_current > 0 AS flag_cash_advance, "
        "cnt_drawings_current >= 5 AS flag_high_cash_advance, u AS credit_utilization_ratio "
        f"FROM (SELECT *, {_ratio_pos('amt_balance', 'amt_credit_limit_actual')} AS u "
        "FROM credit_card_balance)"
    ),
    "s_pos": (
        "SELECT *, sk_dpd > 0 AS flag_has_dpd, sk_dpd > 60 AS flag_severe_dpd, "
        f"{_equalities(vocab.ACTIVE_CONTRACT_FLAG)}, cnt_instalment_future <= 3 AS flag_near_completion, "
        f"{_ratio_pos('cnt_instalment_future', 'cnt_instalment')} AS remaining_installment_ratio "
        "FROM pos_cash_balance"
    ),
    "balance_agg": (
        "SELECT sk_bureau_id, bool_or(flag_has_dpd) AS flag_has_dpd, "
        "bool_or(flag_severe_dpd) AS flag_severe_dpd, bool_or(flag_recent_dpd) AS flag_has_recent_dpd, "
        f"count(*) AS total_months, {N_TRUE.format('flag_closed_credit')} AS closed_credit_months, "
        "count(*) FILTER (status_numeric = 1) AS dpd_1_30_months, "
        "count(*) FILTER (status_numeric = 2) AS dpd_31_60_months, "
        "count(*) FILTER (status_numeric = 3) AS dpd_61_90_months, "
        "count(*) FILTER (status_numeric > 3) AS dpd_90_plus_months, "
        f"{N_TRUE.format('flag_has_dpd')} AS total_dpd_months, "
        "avg(CAST(flag_has_dpd AS INTEGER)) AS dpd_ratio, "
        f"{N_TRUE.format('flag_severe_dpd')} AS severe_dpd_months, "
        "avg(CAST(flag_severe_dpd AS INTEGER)) AS severe_dpd_ratio, "
        "max(status_numeric) AS max_dpd_status FROM s_balance GROUP BY ALL"
    ),
    "ext": (
        "SELECT b.*, m.sk_bureau_id IS NULL AS flag_balance_missing, "
        "m.flag_has_dpd OR b.credit_day_overdue > 0 AS flag_has_dpd_agg, "
        "m.flag_severe_dpd OR b.credit_day_overdue > 60 AS flag_severe_dpd_agg, "
        "m.* EXCLUDE (sk_bureau_id, flag_has_dpd, flag_severe_dpd) "
        "FROM s_bureau b LEFT JOIN balance_agg m USING (sk_bureau_id)"
    ).replace("b.*, m.sk_bureau_id IS NULL", "b.*, m.total_months IS NULL"),
    "inst_agg": (
        "SELECT sk_id_prev, bool_or(flag_late_payment) AS flag_installment_late_payment, "
        "bool_or(flag_early_payment) AS flag_installment_early_payment, "
        "bool_or(flag_partial_payment) AS flag_installment_partial_payment, "
        "count(*) AS total_installments, sum(days_late) AS installment_total_avg_days_late, "
        "avg(days_late) AS installment_avg_days_late, max(days_late) AS installment_max_days_late, "
        "sum(amt_payment) AS total_amt_payment, sum(amt_instalment) AS total_amt_installment, "
        "sum(amt_payment) / sum(amt_instalment) AS wavg_payment_ratio, "
        "max(payment_ratio) AS max_payment_ratio, "
        "count(*) FILTER (flag_late_payment) / count(*) AS installment_late_payment_ratio, "
        "count(*) FILTER (flag_partial_payment) / count(*) AS installment_partial_payment_ratio, "
        "sum(unpaid_amount) AS installment_total_unpaid_amount FROM s_inst GROUP BY ALL"
    ),
    "card_agg": (
        "SELECT sk_id_prev, bool_or(flag_high_utilization) AS flag_card_high_utilization, "
        "bool_or(flag_over_utilization) AS flag_card_over_utilization, "
        "count(*) AS total_credit_card_records, CAST(sum(sk_dpd) AS BIGINT) AS card_total_dpd, "
        "avg(sk_dpd) AS card_avg_dpd, sum(amt_balance) AS total_amt_balance, "
        "CAST(sum(amt_credit_limit_actual) AS BIGINT) AS total_credit_limit, "
        "sum(amt_balance) / sum(amt_credit_limit_actual) AS wavg_credit_utilization, "
        "max(credit_utilization_ratio) AS max_credit_utilization, "
        "count(*) AS card_high_utilization_count, count(*) AS card_over_utilization_count, "
        "count(*) FILTER (flag_high_utilization) / count(*) AS card_high_utilization_ratio, "
        "count(*) FILTER (flag_over_utilization) / count(*) AS card_over_utilization_ratio, "
        "count(*) FILTER (flag_minimum_payment) / count(*) AS card_minimum_payment_ratio, "
        "count(*) FILTER (flag_cash_advance) / count(*) AS card_cash_advance_ratio FROM s_card GROUP BY ALL"
    ),
    "pos_agg": (
        "SELECT sk_id_prev, bool_or(flag_has_dpd) AS flag_pos_dpd, "
        "bool_or(flag_severe_dpd) AS flag_pos_severe_dpd, count(*) AS total_pos_cash_records, "
        "count(*) FILTER (flag_has_dpd) / count(*) AS pos_dpd_ratio, "
        "count(*) FILTER (flag_severe_dpd) / count(*) AS pos_severe_dpd_ratio, "
        "CAST(sum(sk_dpd) AS BIGINT) AS pos_total_dpd, avg(sk_dpd) AS pos_avg_dpd "
        "FROM s_pos GROUP BY ALL"
    ),
    "hist": (
        "SELECT p.*, total_installments IS NULL AS flag_installments_info_missing, "
        "total_credit_card_records IS NULL AS flag_credit_card_info_missing, "
        "total_pos_cash_records IS NULL AS flag_pos_info_missing, "
        "i.* EXCLUDE (sk_id_prev, flag_installment_early_payment), c.* EXCLUDE (sk_id_prev), "
        "o.* EXCLUDE (sk_id_prev) FROM s_prev p LEFT JOIN inst_agg i USING (sk_id_prev) "
        "LEFT JOIN card_agg c USING (sk_id_prev) LEFT JOIN pos_agg o USING (sk_id_prev)"
    ),
    "seg_ext": (
        f"SELECT sk_id_curr, {_maybe('bool_or({0})', gold.SEGMENT_EXTERNAL_FLAGS)}, "
        "max(max_dpd_status) AS max_external_dpd_status FROM ext GROUP BY ALL"
    ),
    "seg_int": (
        f"SELECT sk_id_curr, {_maybe('bool_or({0})', gold.SEGMENT_INTERNAL_FLAGS)} "
        "FROM hist GROUP BY ALL"
    ),
    "feat_ext": (
        "SELECT sk_id_curr, count(*) AS bureau_total_loans, "
        f"{_maybe('count(*) FILTER ({0})', gold.EXTERNAL_TALLIES)}, "
        "avg(amt_credit_sum) AS bureau_avg_credit, max(amt_credit_sum) AS bureau_max_credit, "
        "avg(amt_credit_sum_debt) AS bureau_avg_debt, max(amt_credit_sum_debt) AS bureau_max_debt, "
        "sum(amt_credit_sum_overdue) AS bureau_total_overdue_amount, "
        "max(amt_credit_sum_overdue) AS bureau_max_overdue_amount, "
        "avg(overdue_credit_ratio) AS bureau_avg_overdue_credit_ratio, "
        "max(overdue_credit_ratio) AS bureau_max_overdue_credit_ratio, "
        "avg(debt_credit_ratio) AS bureau_avg_debt_credit_ratio, "
        "max(debt_credit_ratio) AS bureau_max_debt_credit_ratio, "
        "avg(credit_age_days) AS bureau_avg_credit_age_days, "
        "min(credit_age_days) AS bureau_min_credit_age_days FROM ext GROUP BY ALL"
    ),
    "feat_int": (
        "SELECT sk_id_curr, count(*) AS prev_applications_total, "
        f"{_maybe('count(*) FILTER ({0}) / count(*)', gold.PREVIOUS_SHARES)}, "
        f"{_maybe('count(*) FILTER (NOT {0}) / count(*)', gold.PREVIOUS_AVAILABLE)}, "
        f"{_maybe('bool_or({0})', gold.PREVIOUS_ANY)}, "
        f"{_maybe('avg({0})', gold.PREVIOUS_AVERAGES)}, {_maybe('max({0})', gold.PREVIOUS_MAXIMA)}, "
        "avg(abs(days_decision)) AS prev_avg_days_since_decision, "
        "min(abs(days_decision)) AS prev_min_days_since_decision, "
        "CAST(sum(total_installments) AS BIGINT) AS prev_total_installments, "
        "sum(installment_total_unpaid_amount) AS prev_unpaid_amount_for_installments "
        "FROM hist GROUP BY ALL"
    ),
    "fact_ext": (
        "SELECT sk_id_curr, count(*) AS bureau_total_loans, "
        f"{N_TRUE.format('flag_active_credit')} AS bureau_active_loans, "
        f"{N_TRUE.format('flag_bad_debt')} AS bureau_bad_debt_loans, "
        "sum(amt_credit_sum) AS bureau_total_credit, avg(amt_credit_sum) AS bureau_avg_credit, "
        "count(*) FILTER (flag_has_dpd_agg) AS bureau_total_loans_with_dpd, "
        "count(*) FILTER (flag_severe_dpd_agg) AS bureau_total_loans_with_severe_dpd, "
        "CAST(sum(CAST(flag_recent_credit AS INTEGER)) FILTER (NOT flag_balance_missing) AS BIGINT) "
        "AS bureau_recent_credit_count, "
        "max(max_dpd_status) FILTER (NOT flag_balance_missing) AS bureau_max_dpd_status, "
        "sum(amt_credit_sum_overdue) AS bureau_total_overdue_amount, "
        "avg(overdue_credit_ratio) AS bureau_avg_overdue_credit_ratio, "
        "avg(debt_credit_ratio) AS bureau_avg_debt_credit_ratio, "
        "max(debt_credit_ratio) AS bureau_max_debt_credit_ratio, "
        "avg(credit_age_days) AS bureau_avg_credit_age_days FROM ext GROUP BY ALL"
    ),
    "fact_int": (
        "SELECT sk_id_curr, sum(amt_application) AS prev_total_application_amt, "
        "sum(amt_credit) AS prev_total_given_credit, avg(amt_credit) AS prev_avg_given_credit, "
        f"{_ratio_pos('sum(amt_credit)', 'sum(amt_application)')} AS prev_approved_credit_ratio, "
        f"{_ratio_pos('sum(amt_application)', 'sum(amt_goods_price)')} AS prev_goods_vs_application_ratio, "
        f"count(*) AS prev_applications_total, {_maybe(N_TRUE, gold.FACT_PREVIOUS_COUNTS)}, "
        "max(max_credit_utilization) AS max_credit_utilization, "
        "sum(total_amt_balance) / sum(total_credit_limit) AS avg_credit_utilization, "
        "sum(installment_total_unpaid_amount) AS prev_unpaid_amount_for_installments, "
        "max(max_payment_ratio) AS max_payment_ratio, "
        "sum(total_amt_payment) / sum(total_amt_installment) AS avg_payment_ratio, "
        "CAST(sum(pos_total_dpd) AS BIGINT) AS pos_total_dpd, avg(pos_total_dpd) AS pos_avg_dpd "
        "FROM hist GROUP BY ALL"
    ),
    "numbered": (
        "SELECT *, row_number() OVER (ORDER BY sk_id_curr) AS n, "
        f"{_band('age_years', 'age_band')} AS age_band, "
        f"{_band('amt_income_total', 'income_band')} AS income_band, "
        f"{_band('employment_years', 'employment_tenure_band')} AS employment_tenure_band, "
        f"{_band('ext_source_mean', 'score_band')} AS mean_score_band, "
        f"{_band('annuity_income_ratio', 'annuity_income_band')} AS annuity_income_band FROM s_app"
    ),
    "wide": (
        "SELECT a.*, f.* EXCLUDE (sk_id_curr), g.* EXCLUDE (sk_id_curr), "
        "s.* EXCLUDE (sk_id_curr), t.* EXCLUDE (sk_id_curr), "
        "f.bureau_total_loans IS NULL AS flag_missing_bureau_info, "
        "g.prev_applications_total IS NULL AS flag_missing_prev_applications_info "
        "FROM numbered a LEFT JOIN fact_ext f USING (sk_id_curr) LEFT JOIN fact_int g USING (sk_id_curr) "
        "LEFT JOIN seg_ext s USING (sk_id_curr) LEFT JOIN seg_int t USING (sk_id_curr) "
        "WHERE NOT flag_test"
    ),
    "overall": (
        "SELECT count(DISTINCT sk_id_curr) AS n, count(*) FILTER (target) AS defaults, "
        "sum(amt_credit) AS amount, avg(CAST(target AS INTEGER)) AS rate FROM wide"
    ),
    "lift": (
        f"SELECT {{gender}} AS genero, age_band AS faixa_idade, income_band AS faixa_renda, "
        "count(DISTINCT sk_id_curr) AS clientes, avg(CAST(target AS INTEGER)) AS taxa_inadimplencia, "
        "avg(CAST(target AS INTEGER)) / (SELECT nullif(rate, 0) FROM overall) AS lift_risco, "
        "avg(CAST(target AS INTEGER)) - (SELECT rate FROM overall) AS lift_pp FROM wide "
        "WHERE code_gender IN ('F', 'M') AND age_band NOT IN ('Unknown', 'Outlier') "
        "AND income_band NOT IN ('Unknown', 'Outlier') GROUP BY ALL "
        f"HAVING count(DISTINCT sk_id_curr) >= {SEGMENT_MIN_CLIENTS}"
    ).replace("{gender}", "if(code_gender = 'F', 'Feminino', 'Masculino')"),
    "profile": (
        "SELECT distribution_type, coalesce(bucket, 'Unknown') AS bucket, "
        "count(DISTINCT sk_id_curr) AS clients, avg(CAST(target AS INTEGER)) AS default_rate, "
        "avg(amt_income_total) AS avg_income FROM (SELECT *, unnest(["
        + ", ".join(
            f"{{'distribution_type': {_quoted(axis)}, 'bucket': "
            + (
                "CASE code_gender WHEN 'M' THEN 'Masculino' WHEN 'F' THEN 'Feminino' END"
                if column == "code_gender"
                else column
            )
            + "}"
            for axis, column in vocab.PROFILE_AXES.items()
        )
        + "], recursive := true) FROM wide) GROUP BY ALL"
    ),
    "dti": (
        "SELECT income_band, annuity_income_band, count(*) FILTER (target) / count(*) / "
        "(SELECT nullif(rate, 0) FROM overall) AS lift_inadimplencia FROM wide "
        "WHERE annuity_income_band NOT IN ('Unknown', 'Outlier') GROUP BY ALL"
    ),
}


def _segment_test(kind: str, column: str, limit) -> str:
    return {
        "set": f"coalesce({column}, false)",
        "unset": f"coalesce({column}, false) = false",
        "known_low": f"{column} < {limit}",
        "low": f"coalesce({column}, 0) < {limit}",
        "many": f"coalesce({column}, 0) >= {limit}",
    }[kind]


CTES["segments"] = (
    "SELECT segmento, count(DISTINCT sk_id_curr) AS clientes, count(*) FILTER (target) AS defaults, "
    "sum(amt_credit) AS valor_emprestimos, avg(CAST(target AS INTEGER)) AS taxa_inadimplencia, "
    "coalesce(sum(amt_credit) FILTER (target), 0.0e0) AS valor_emprestimos_inadimplentes, "
    "avg(CAST(target AS INTEGER)) / (SELECT nullif(rate, 0) FROM overall) AS lift_risco, "
    "avg(CAST(target AS INTEGER)) - (SELECT rate FROM overall) AS lift_pp, "
    "count(DISTINCT sk_id_curr) / (SELECT nullif(n, 0) FROM overall) AS pct_clientes, "
    "count(*) FILTER (target) / (SELECT nullif(defaults, 0) FROM overall) AS pct_defaults, "
    "sum(amt_credit) / (SELECT nullif(amount, 0) FROM overall) AS pct_valor_emprestimos "
    "FROM (SELECT sk_id_curr, target, amt_credit, unnest(list_filter(["
    + ", ".join(
        f"if({_segment_test(kind, column, limit)}, {_quoted(label)}, NULL)"
        for label, kind, column, limit in vocab.BEHAVIOR_SEGMENTS
    )
    + "], lambda s: s IS NOT NULL)) AS segmento FROM wide) GROUP BY ALL "
    f"HAVING count(DISTINCT sk_id_curr) >= {vocab.MIN_CLIENTS}"
)


def _corr_value(column: str, is_flag: bool) -> str:
    if is_flag:
        return f"CAST(coalesce({column}, false) AS DOUBLE)"
    if column == "cadastral_completeness_rate":
        return "(" + " + ".join(f"coalesce({c}, 0)" for c in vocab.COMPLETENESS_PROXY) + ") / 5"
    return f"CAST({column} AS DOUBLE)"


CTES["correlations"] = (
    "SELECT variavel, if(isnan(c), NULL, c) AS correlacao FROM (SELECT unnest(["
    + ", ".join(
        f"{{'variavel': {_quoted(label)}, 'c': corr(CAST(target AS DOUBLE), {_corr_value(col, flag)})}}"
        for label, col, flag in vocab.CORRELATION_VARIABLES
    )
    + "], recursive := true) FROM wide)"
)
CTES["top_corr"] = (
    "SELECT * FROM correlations WHERE correlacao IS NOT NULL "
    f"ORDER BY abs(correlacao) DESC, variavel LIMIT {vocab.TOP_CORRELATIONS}"
)


def _human(value: str, prefix: str = "") -> str:
    return (
        f"CASE WHEN {value} IS NULL THEN '-' "
        f"WHEN {value} >= 1000000000 THEN '{prefix}' || printf('%.1fB', {value} / 1000000000.0e0) "
        f"WHEN {value} >= 1000000 THEN '{prefix}' || printf('%.1fM', {value} / 1000000.0e0) "
        f"ELSE '{prefix}' || format('{{:,.0f}}', CAST({value} AS DOUBLE)) END"
    )


def _percent(value: str) -> str:
    return f"coalesce(printf('%.2f%%', {value} * 100.0e0), '-')"


KPIS = (
    "SELECT count(DISTINCT sk_id_curr) AS n_total_loans, sum(amt_credit) AS total_credit_amount, "
    "avg(CAST(target AS INTEGER)) AS default_rate, count(*) FILTER (target) AS total_defaults, "
    "coalesce(sum(amt_credit) FILTER (target), 0.0e0) AS default_credit_amount, "
    "sum(prev_applications_approved) / nullif(sum(prev_applications_total), 0) AS historical_approval_rate "
    "FROM wide"
)
BAND_ORDER = (
    "(SELECT band_group, band_label, min(band_order) AS band_order FROM band_rules "
    "WHERE band_label NOT IN ('Unknown', 'Outlier') GROUP BY ALL)"
)
_DTI_COLUMNS = [
    r[3] for r in vocab.BAND_RULES
    if r[0] == "annuity_income_band" and r[3] not in vocab.BANDS_OUTSIDE_ORDER
]

# --- bronze and refresh ---------------------------------------------------------------------

LITERALS = _in(vocab.TRUE_LITERALS + vocab.FALSE_LITERALS)


def _profile_rows() -> str:
    parts = [
        f"{{'column_name': '{c.upper()}', 'is_boolean': coalesce(bool_and(lower(trim(CAST("
        + (f"coalesce({c}, 365243)" if c == "days_employed" else f"CAST({c} AS VARCHAR)")
        + f" AS VARCHAR))) IN {LITERALS}), false)}}"
        for c in WRITTEN["application_train"][1]
    ]
    return (
        f"SELECT unnest([{', '.join(parts)}], recursive := true), count(*) AS row_count FROM {TRAIN}"
    )


_EVENTS_DONE = (
    "event_log WHERE entity_type = 'table' AND status IN ('success', 'skipped_cached_transformation')"
)
_EVENT_FIELDS = [c for c in adapter.VIEWS["event_log"][1] if c not in ("layer", "entity_name")]


def _app(columns: str) -> str:
    return f"SELECT sk_id_curr, {columns} FROM applications"


def _listing(columns: list[str]) -> str:
    return ", ".join(columns)


SQL: dict[str, str] = {
    "segment_lift": "SELECT * FROM lift",
    "union_by_name_flag_test": "SELECT * FROM applications",
    "application_labels_years": _app(LABELS),
    "application_flags": _app(FLAGS),
    "application_ratios": _app(RATIOS),
    "ext_source_stats": _app(SCORE_STATS),
    "inquiry_row_sum": _app(INQUIRY_SUM),
    "fill_rates": _app(FILLS),
    "true_rates": _app(TRUES),
    "overall_completeness": _app(OVERALL),
    "silver_applications": "SELECT * FROM s_app",
    "bureau_features": "SELECT * FROM s_bureau",
    "bureau_balance_features": "SELECT * FROM s_balance",
    "previous_application_features": "SELECT * FROM s_prev",
    "installment_features": "SELECT * FROM s_inst",
    "card_features": "SELECT * FROM s_card",
    "pos_features": "SELECT * FROM s_pos",
    "bureau_balance_rollup": "SELECT * FROM balance_agg",
    "external_behavior": "SELECT * FROM ext",
    "installment_rollup": "SELECT * FROM inst_agg",
    "card_rollup": "SELECT * FROM card_agg",
    "pos_rollup": "SELECT * FROM pos_agg",
    "internal_behavior": "SELECT * FROM hist",
    "band_rule_usage": (
        "SELECT r.*, u.n AS applications FROM band_rules r LEFT JOIN (SELECT g, l, count(*) AS n FROM ("
        "SELECT unnest([{'g': 'age_band', 'l': age_band}, {'g': 'income_band', 'l': income_band}, "
        "{'g': 'employment_tenure_band', 'l': employment_tenure_band}, "
        "{'g': 'score_band', 'l': mean_score_band}, "
        "{'g': 'annuity_income_band', 'l': annuity_income_band}], recursive := true) FROM numbered) "
        "GROUP BY ALL) u ON u.g = r.band_group AND u.l = r.band_label"
    ),
    "band_join_all": (
        "SELECT sk_id_curr, age_band, income_band, employment_tenure_band, "
        "mean_score_band AS score_band, annuity_income_band FROM numbered"
    ),
    "band_join_loaded": "SELECT sk_id_curr, mean_score_band AS score_band, income_band FROM numbered",
    "dense_key": (
        "SELECT sk_bureau_id, credit_type, row_number() OVER (ORDER BY sk_bureau_id) AS bureau_key FROM bureau"
    ),
    "hot_key_attach": (
        "SELECT event_id, sk_id_prev, total_credit_card_records, card_total_dpd, "
        "total_credit_card_records IS NULL AS no_rollup "
        "FROM credit_card_balance LEFT JOIN card_agg USING (sk_id_prev)"
    ),
    "segment_external": "SELECT * FROM seg_ext",
    "segment_internal": "SELECT * FROM seg_int",
    "dim_requester": (
        f"SELECT n AS requester_key, sk_id_curr, {_listing(gold.REQUESTER_COLUMNS)} FROM numbered"
    ),
    "dim_contract": (
        f"SELECT n AS contract_key, sk_id_curr, {_listing(gold.CONTRACT_COLUMNS)} FROM numbered"
    ),
    "dim_risk_segment": (
        "SELECT n AS risk_segment_key, a.sk_id_curr, s.* EXCLUDE (sk_id_curr), t.* EXCLUDE (sk_id_curr), "
        "mean_score_band, annuity_income_band, t.sk_id_curr IS NULL AS flag_missing_prev_applications_info, "
        "s.sk_id_curr IS NULL AS flag_missing_bureau_info, "
        f"{_listing(vocab.EXT_SCORES + gold.SCORE_FLAGS)} FROM numbered a "
        "LEFT JOIN seg_ext s ON s.sk_id_curr = a.sk_id_curr "
        "LEFT JOIN seg_int t ON t.sk_id_curr = a.sk_id_curr"
    ),
    "feature_store_external": "SELECT * FROM feat_ext",
    "feature_store_internal": "SELECT * FROM feat_int",
    "one_hot": "SELECT sk_id_curr, "
    + ", ".join(
        f"{column} = {_quoted(code)} AS {flag}"
        for column, codes in vocab.ONE_HOT.items()
        for code, flag in codes.items()
    )
    + " FROM s_app",
    "feature_store": (
        f"SELECT a.sk_id_curr, {_listing(gold.FEATURE_APPLICATION_COLUMNS)}, "
        + ", ".join(
            f"{column} = {_quoted(code)} AS {flag}"
            for column, codes in vocab.ONE_HOT.items()
            for code, flag in codes.items()
        )
        + ", e.sk_id_curr IS NULL AS flag_missing_bureau_info, e.* EXCLUDE (sk_id_curr), "
        "i.sk_id_curr IS NULL AS flag_missing_prev_applications_info, i.* EXCLUDE (sk_id_curr) "
        "FROM s_app a LEFT JOIN feat_ext e ON e.sk_id_curr = a.sk_id_curr "
        "LEFT JOIN feat_int i ON i.sk_id_curr = a.sk_id_curr"
    ),
    "fact_base": (
        f"SELECT sk_id_curr, {_listing(gold.FACT_APPLICATION_COLUMNS)} FROM s_app WHERE NOT flag_test"
    ),
    "fact_external": "SELECT * FROM fact_ext",
    "fact_internal": "SELECT * FROM fact_int",
    "fact_credit_risk": (
        "SELECT sk_id_curr, n AS requester_key, n AS contract_key, n AS risk_segment_key, "
        f"{_listing(gold.FACT_APPLICATION_COLUMNS)}, f.* EXCLUDE (sk_id_curr), g.* EXCLUDE (sk_id_curr) "
        "FROM numbered a LEFT JOIN fact_ext f USING (sk_id_curr) LEFT JOIN fact_int g USING (sk_id_curr) "
        "WHERE NOT flag_test"
    ),
    "portfolio_kpis": KPIS,
    "default_split": (
        "SELECT 'Valor' AS categoria, rate AS valor FROM overall "
        "UNION ALL SELECT 'Restante', 1 - rate FROM overall"
    ),
    "humanised_kpis": (
        f"SELECT {_human('n_total_loans')} AS n_total_loans, "
        f"{_human('total_credit_amount', 'R$ ')} AS total_credit_amount, "
        f"{_percent('default_rate')} AS default_rate, {_human('total_defaults')} AS total_defaults, "
        f"{_human('default_credit_amount', 'R$ ')} AS default_credit_amount, "
        f"{_percent('historical_approval_rate')} AS historical_approval_rate FROM ({KPIS})"
    ),
    "profile_distribution": "SELECT * FROM profile",
    "profile_reindexed": (
        "SELECT distribution_type, band_order, o.band_label AS bucket, clients, default_rate, avg_income "
        f"FROM {BAND_ORDER} o JOIN (VALUES ('Faixa de renda', 'income_band'), "
        "('Faixa etária', 'age_band')) x(distribution_type, band_group) USING (band_group) "
        "LEFT JOIN (SELECT distribution_type, bucket AS band_label, clients, default_rate, avg_income "
        "FROM profile) p USING (distribution_type, band_label)"
    ),
    "risk_bucket": (
        "SELECT *, printf('%.1fx', lift_risco) AS lift_label, CASE WHEN lift_risco >= 1.25 THEN "
        "'Alto risco' WHEN lift_risco <= 0.85 THEN 'Baixo risco' ELSE 'Próximo da média' END "
        "AS risk_bucket FROM lift"
    ),
    "dti_lift": "SELECT * FROM dti",
    "dti_lift_pivot": (
        "SELECT o.band_order, o.band_label AS income_band, "
        + ", ".join(
            f"max(lift_inadimplencia) FILTER (annuity_income_band = {_quoted(c)}) AS \"{c}\""
            for c in _DTI_COLUMNS
        )
        + f" FROM {BAND_ORDER} o LEFT JOIN dti d ON d.income_band = o.band_label "
        "WHERE o.band_group = 'income_band' GROUP BY ALL"
    ),
    "behavior_segments": "SELECT * FROM segments",
    "top_behavior_segments": (
        "SELECT * FROM segments ORDER BY lift_risco DESC NULLS LAST, defaults DESC, "
        f"valor_emprestimos DESC, segmento LIMIT {vocab.TOP_SEGMENTS}"
    ),
    "target_correlation": "SELECT * FROM correlations",
    "top_correlation": "SELECT * FROM top_corr",
    "correlation_matrix": "SELECT "
    + ", ".join(
        f"max(correlacao) FILTER (variavel = {_quoted(label)}) AS \"{label}\""
        for label, _, _ in vocab.CORRELATION_VARIABLES
    )
    + " FROM top_corr",
    "bool_domain_profile": _profile_rows(),
    "bool_normalise": (
        f"SELECT sk_id_curr, flag_own_car, flag_own_realty, {_listing(vocab.CONTACT)} FROM {TRAIN}"
    ),
    "sentinel_profile": (
        f"SELECT 'DAYS_EMPLOYED' AS column_name, count(*) FILTER (days_employed IS NULL) AS sentinel_rows FROM {TRAIN} "
        + " ".join(
            f"UNION ALL SELECT '{c.upper()}', count(*) FILTER ({c} = {v}) FROM previous_application"
            for c, v in [
                ("days_first_drawing", "365243"), ("name_client_type", "'''XNA'''"),
                ("name_cash_loan_purpose", "'XPA'"), ("name_payment_type", "'XNA'"),
                ("name_goods_category", "'XNA'"),
            ]
        )
    ),
    "sentinel_replace": BRONZE_PREVIOUS,
    "typed_cast": (
        "SELECT sk_id_prev, days_decision, amt_credit, CAST(cnt_payment AS BIGINT) AS cnt_payment, "
        "name_contract_status FROM previous_application"
    ),
    "bronze_table": f"SELECT * FROM {TRAIN}",
    "null_constraint_report": " UNION ALL ".join(
        f"SELECT '{c.upper()}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_rows, "
        f"count(*) FILTER ({c} IS NULL) > 0 AS violated FROM previous_application"
        for c in ("sk_id_prev", "sk_id_curr")
    ),
    "reconciliation": (
        "SELECT entity_name, array_to_string(list_filter(["
        "if(r <> n, printf('raw_bronze_row_count_mismatch:raw=%d:bronze=%d', r, n), NULL), "
        "if(4 <> c, printf('raw_bronze_column_count_mismatch:raw=%d:bronze=%d', 4, c), NULL), "
        "if(p <> c, printf('planned_bronze_column_count_mismatch:planned=%d:loaded=%d', p, c), NULL)"
        "], lambda w: w IS NOT NULL), '; ') AS validation_warnings FROM (SELECT entity_name, "
        "arg_max(row_count, (event_ts_utc, seq)) AS r, count(*) AS n, max(seq % 3 + 3) AS c, "
        "min(seq % 2 + 4) AS p FROM event_log GROUP BY ALL)"
    ),
    "latest_event": (
        "SELECT layer, entity_name, "
        + ", ".join(f"arg_max({c}, (event_ts_utc, seq)) AS {c}" for c in _EVENT_FIELDS)
        + f" FROM {_EVENTS_DONE} GROUP BY ALL"
    ),
    "reuse_valid_result": (
        "SELECT c.*, k.row_count IS NOT NULL AS can_reuse, k.row_count FROM (SELECT entity_name, "
        "max(file_fingerprint) AS file_fingerprint, 'v1' AS process_version FROM event_log GROUP BY ALL) c "
        "LEFT JOIN (SELECT entity_name, file_fingerprint, process_version, "
        "arg_max(row_count, (event_ts_utc, seq)) AS row_count FROM event_log WHERE status <> 'failed' "
        "GROUP BY ALL) k USING (entity_name, file_fingerprint, process_version)"
    ),
    "refresh_decision": (
        "SELECT layer, entity_name, d.ok AND k.v = 'v1' AND k.f = d.f AND k.s = d.s AS is_fresh, "
        "CASE WHEN k.v IS NULL THEN 'never_built' WHEN NOT d.ok THEN 'output_missing' "
        "WHEN k.v <> 'v1' THEN 'process_version_changed' "
        "WHEN k.f <> d.f THEN 'definition_fingerprint_changed' "
        "WHEN k.s <> d.s THEN 'source_fingerprint_changed' END AS reason FROM "
        "(SELECT layer, entity_name, max(file_fingerprint) AS f, min(CAST(row_count % 2 AS VARCHAR)) AS s, "
        "max(seq) % 5 <> 0 AS ok FROM event_log GROUP BY ALL) d LEFT JOIN "
        "(SELECT layer, entity_name, arg_max(process_version, (event_ts_utc, seq)) AS v, "
        "arg_max(file_fingerprint, (event_ts_utc, seq)) AS f, "
        "CAST(arg_max(row_count, (event_ts_utc, seq)) % 2 AS VARCHAR) AS s "
        f"FROM {_EVENTS_DONE} GROUP BY ALL) k USING (layer, entity_name)"
    ),
    "run_counters": (
        "SELECT run_id, count(*) AS table_count_selected, count(*) FILTER (status <> 'failed') AS table_count_succeeded, "
        "count(*) FILTER (status = 'failed') AS table_count_failed, "
        "count(*) FILTER (status = 'skipped_cached_transformation') AS table_count_skipped, "
        "if(count(*) FILTER (status = 'failed') > 0, 'partial_failure', 'success') AS run_status "
        "FROM event_log WHERE entity_type = 'table' GROUP BY ALL"
    ),
    "table_profile": " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS row_count, {len(adapter.VIEWS[n][1])} AS column_count FROM {n}"
        for n in adapter.VIEWS
    ),
    "publish_roundtrip": "SELECT * FROM dti",
} | raw_oracles.SQL

# Double columns of the queries, by name; the rest is exact.
DOUBLES = set(
    vocab._APPLICATION["DOUBLE"]
    + [c for s in vocab.INPUT_SCHEMA.values() for c in s.get("DOUBLE", [])]
    + gold.APPLICATION_RATIOS
    + list(gold.PREVIOUS_SHARES) + list(gold.PREVIOUS_AVAILABLE) + list(gold.PREVIOUS_AVERAGES)
    + list(gold.PREVIOUS_MAXIMA) + _DTI_COLUMNS
    + """age_years employment_years ext_source_mean ext_source_max ext_source_min
    total_credit_inquiries housing_info_fill_rate core_profile_info_filled_rate
    credit_bureau_request_info_filled_rate social_circle_info_filled_rate ext_source_fill_rate
    contact_info_filled_rate document_provided_rate cadastral_completeness_rate
    debt_credit_ratio overdue_credit_ratio credit_application_diff goods_vs_application_ratio
    approved_credit_ratio days_late payment_ratio unpaid_amount credit_utilization_ratio
    remaining_installment_ratio dpd_ratio severe_dpd_ratio installment_total_avg_days_late
    installment_avg_days_late installment_max_days_late total_amt_payment total_amt_installment
    wavg_payment_ratio installment_late_payment_ratio installment_partial_payment_ratio
    installment_total_unpaid_amount card_avg_dpd total_amt_balance wavg_credit_utilization
    max_credit_utilization card_high_utilization_ratio card_over_utilization_ratio
    card_minimum_payment_ratio card_cash_advance_ratio pos_dpd_ratio pos_severe_dpd_ratio
    bureau_avg_credit bureau_max_credit bureau_avg_debt bureau_max_debt
    bureau_total_overdue_amount bureau_max_overdue_amount bureau_avg_overdue_credit_ratio
    bureau_max_overdue_credit_ratio bureau_avg_debt_credit_ratio bureau_max_debt_credit_ratio
    bureau_avg_credit_age_days bureau_total_credit prev_avg_days_since_decision
    prev_unpaid_amount_for_installments prev_total_application_amt prev_total_given_credit
    prev_approved_credit_ratio prev_goods_vs_application_ratio avg_credit_utilization
    total_credit_amount default_rate default_credit_amount historical_approval_rate valor
    avg_income taxa_inadimplencia lift_risco lift_pp lift_inadimplencia valor_emprestimos
    valor_emprestimos_inadimplentes pct_clientes pct_defaults pct_valor_emprestimos correlacao
    lower_bound upper_bound""".split()
)
# Queries without any double column, and those where a name above stands for another type.
EXACT = {
    "application_flags", "band_join_all", "band_join_loaded", "dense_key", "hot_key_attach", "segment_external",
    "segment_internal", "dim_contract", "one_hot", "humanised_kpis", "bool_domain_profile",
    "bool_normalise", "sentinel_profile", "null_constraint_report",
    "reconciliation", "latest_event",
    "reuse_valid_result", "refresh_decision", "run_counters", "table_profile",
    "bureau_balance_features",
} | raw_oracles.EXACT
NOT_DOUBLE = {"typed_cast": {"cnt_payment"}}
ONLY_DOUBLES = {"correlation_matrix": [label for label, _, _ in vocab.CORRELATION_VARIABLES]}


def oracle_sql() -> dict[str, str]:
    names = list(CTES)

    def with_ctes(body: str) -> str:
        """The query with the CTEs it uses, directly or through others, in order."""
        import re

        needed: set[str] = set()
        pending = [body]
        while pending:
            text = pending.pop()
            for name in names:
                if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                    needed.add(name)
                    pending.append(CTES[name])
        ctes = ", ".join(f"{n} AS ({CTES[n]})" for n in names if n in needed)
        return f"WITH {ctes} {body}" if ctes else body

    queries = {}
    for name, body in SQL.items():
        if name in ONLY_DOUBLES:
            body = settle_sql(body, ONLY_DOUBLES[name], others=False)
        elif name not in EXACT:
            body = settle_sql(body, sorted(DOUBLES - NOT_DOUBLE.get(name, set())))
        queries[name] = with_ctes(body)
    return queries
