"""Fixed values of the credit-risk domain.

Everything in this module is data that must equal the published rules for results to be right:
file names, column groups, accepted literals, sentinel and band rules, category codes, thresholds
and report labels.  Logic lives elsewhere.
"""

from __future__ import annotations

# --------------------------------------------------------------------------------------------
# Raw file set (logical table, file)
# --------------------------------------------------------------------------------------------
RAW_FILES = [
    ("application_train", "application_train.csv"),
    ("application_test", "application_test.csv"),
    ("bureau", "bureau.csv"),
    ("bureau_balance", "bureau_balance.csv"),
    ("previous_application", "previous_application.csv"),
    ("pos_cash_balance", "POS_CASH_balance.csv"),
    ("credit_card_balance", "credit_card_balance.csv"),
    ("installments_payments", "installments_payments.csv"),
]

RAW_AUDIT_VERSION = "raw_validation_v1"
BRONZE_VERSION = "bronze_transformation_v1"

# Statuses and error codes of the raw audit
STATUS_MISSING, STATUS_INVALID, STATUS_VALID = "missing", "invalid", "valid"
ERROR_NOT_FOUND, ERROR_EMPTY = "file_not_found", "empty_file"
ERROR_ROW_LENGTH, ERROR_ENCODING = "inconsistent_row_length", "encoding_error"

# Codes that open the messages of a failed bronze load
BAD_NAME, REPEATED_NAME = "invalid_column_name", "duplicate_bronze_column_name"
SCHEMA_DRIFT = "bronze_schema_mismatch"

# Statuses of a refreshed table that count as a success
SUCCESS_STATUSES = ("success", "skipped_cached_transformation")
# A table that could not be tried because of its inputs has failed as well.
FAILURE_STATUSES = ["failed", "skipped_upstream_failed"]

# --------------------------------------------------------------------------------------------
# Column groups of an application
# --------------------------------------------------------------------------------------------
BUILDING_MEASURES = [
    "apartments", "basementarea", "years_beginexpluatation", "years_build", "commonarea",
    "elevators", "entrances", "floorsmax", "floorsmin", "landarea", "livingapartments",
    "livingarea", "nonlivingapartments", "nonlivingarea",
]
HOUSING = [f"{m}_avg" for m in BUILDING_MEASURES] + ["totalarea_mode"]
CORE_PROFILE = [
    "code_gender", "cnt_children", "amt_income_total", "name_income_type", "name_education_type",
    "name_family_status", "name_housing_type", "days_birth", "days_employed", "occupation_type",
    "cnt_fam_members", "organization_type",
]
CONTACT = [
    "flag_mobil", "flag_emp_phone", "flag_work_phone", "flag_cont_mobile", "flag_phone",
    "flag_email",
]
EXT_SCORES = ["ext_source_1", "ext_source_2", "ext_source_3"]
BUREAU_REQUESTS = [
    f"amt_req_credit_bureau_{p}" for p in ("hour", "day", "week", "mon", "qrt", "year")
]
SOCIAL_CIRCLE = [
    "obs_30_cnt_social_circle", "def_30_cnt_social_circle",
    "obs_60_cnt_social_circle", "def_60_cnt_social_circle",
]
DOCUMENTS = [f"flag_document_{i}" for i in range(2, 22)]
REGION_MISMATCH = [
    "reg_region_not_live_region", "reg_region_not_work_region", "live_region_not_work_region",
    "reg_city_not_live_city", "reg_city_not_work_city", "live_city_not_work_city",
]

# --------------------------------------------------------------------------------------------
# Input schema, by file and type (names in bronze form)
# --------------------------------------------------------------------------------------------
_APPLICATION = {
    "BIGINT": [
        "sk_id_curr", "cnt_children", "days_birth", "days_employed", "days_id_publish",
        "region_rating_client", "region_rating_client_w_city", "hour_appr_process_start",
    ],
    "BOOLEAN": ["target", "flag_own_car", "flag_own_realty"] + CONTACT + REGION_MISMATCH
    + ["emergencystate_mode"] + DOCUMENTS,
    "VARCHAR": [
        "name_contract_type", "code_gender", "name_type_suite", "name_income_type",
        "name_education_type", "name_family_status", "name_housing_type", "occupation_type",
        "weekday_appr_process_start", "organization_type", "fondkapremont_mode",
        "housetype_mode", "wallsmaterial_mode",
    ],
    "DOUBLE": [
        "amt_income_total", "amt_credit", "amt_annuity", "amt_goods_price",
        "region_population_relative", "days_registration", "own_car_age", "cnt_fam_members",
    ] + EXT_SCORES
    + [f"{m}_{s}" for s in ("avg", "mode", "medi") for m in BUILDING_MEASURES]
    + ["totalarea_mode"] + SOCIAL_CIRCLE + ["days_last_phone_change"] + BUREAU_REQUESTS,
}
INPUT_SCHEMA = {
    "application_train.csv": _APPLICATION,
    "application_test.csv": {
        kind: [c for c in cols if c != "target"] for kind, cols in _APPLICATION.items()
    },
    "bureau.csv": {
        "BIGINT": [
            "sk_id_curr", "sk_bureau_id", "days_credit", "credit_day_overdue",
            "cnt_credit_prolong", "days_credit_update",
        ],
        "VARCHAR": ["credit_active", "credit_currency", "credit_type"],
        "DOUBLE": [
            "days_credit_enddate", "days_enddate_fact", "amt_credit_max_overdue",
            "amt_credit_sum", "amt_credit_sum_debt", "amt_credit_sum_limit",
            "amt_credit_sum_overdue", "amt_annuity",
        ],
    },
    "bureau_balance.csv": {"BIGINT": ["sk_bureau_id", "months_balance"], "VARCHAR": ["status"]},
    "previous_application.csv": {
        "BIGINT": [
            "sk_id_prev", "sk_id_curr", "hour_appr_process_start", "days_decision",
            "sellerplace_area",
        ],
        "BOOLEAN": ["flag_last_appl_per_contract", "nflag_last_appl_in_day"],
        "VARCHAR": [
            "name_contract_type", "weekday_appr_process_start", "name_cash_loan_purpose",
            "name_contract_status", "name_payment_type", "code_reject_reason",
            "name_type_suite", "name_client_type", "name_goods_category", "name_portfolio",
            "name_product_type", "channel_type", "name_seller_industry", "name_yield_group",
            "product_combination",
        ],
        "DOUBLE": [
            "amt_annuity", "amt_application", "amt_credit", "amt_down_payment",
            "amt_goods_price", "rate_down_payment", "rate_interest_primary",
            "rate_interest_privileged", "cnt_payment", "days_first_drawing", "days_first_due",
            "days_last_due_1st_version", "days_last_due", "days_termination",
            "nflag_insured_on_approval",
        ],
    },
    "POS_CASH_balance.csv": {
        "BIGINT": ["sk_id_prev", "sk_id_curr", "months_balance", "sk_dpd", "sk_dpd_def"],
        "VARCHAR": ["name_contract_status"],
        "DOUBLE": ["cnt_instalment", "cnt_instalment_future"],
    },
    "credit_card_balance.csv": {
        "BIGINT": [
            "sk_id_prev", "sk_id_curr", "months_balance", "amt_credit_limit_actual",
            "cnt_drawings_current", "sk_dpd", "sk_dpd_def",
        ],
        "VARCHAR": ["name_contract_status"],
        "DOUBLE": [
            "amt_balance", "amt_drawings_atm_current", "amt_drawings_current",
            "amt_drawings_other_current", "amt_drawings_pos_current",
            "amt_inst_min_regularity", "amt_payment_current", "amt_payment_total_current",
            "amt_receivable_principal", "amt_receivable", "amt_total_receivable",
            "cnt_drawings_atm_current", "cnt_drawings_other_current",
            "cnt_drawings_pos_current", "cnt_instalment_mature_cum",
        ],
    },
    "installments_payments.csv": {
        "BIGINT": ["sk_id_prev", "sk_id_curr", "num_instalment_number"],
        "DOUBLE": [
            "num_instalment_version", "days_instalment", "days_entry_payment",
            "amt_instalment", "amt_payment",
        ],
    },
}

# Raw names whose bronze name is not simply their snake case
# (file, raw column, reference column, bronze column)
RENAMES = [
    ("bureau.csv", "SK_ID_BUREAU", "SK_BUREAU_ID", "sk_bureau_id"),
    ("bureau_balance.csv", "SK_ID_BUREAU", "SK_BUREAU_ID", "sk_bureau_id"),
    ("credit_card_balance.csv", "AMT_RECIVABLE", "AMT_RECEIVABLE", "amt_receivable"),
]

# Columns without which a raw file cannot be used
REQUIRED_COLUMNS = {
    "application_train.csv": ["SK_ID_CURR", "TARGET"],
    "application_test.csv": ["SK_ID_CURR"],
    "bureau.csv": ["SK_ID_CURR", "SK_ID_BUREAU"],
    "bureau_balance.csv": ["SK_ID_BUREAU", "MONTHS_BALANCE"],
    "previous_application.csv": ["SK_ID_PREV", "SK_ID_CURR"],
    "POS_CASH_balance.csv": ["SK_ID_PREV", "SK_ID_CURR"],
    "credit_card_balance.csv": ["SK_ID_PREV", "SK_ID_CURR"],
    "installments_payments.csv": ["SK_ID_PREV", "SK_ID_CURR"],
}

# Boolean literals, compared after lower(trim(value))
TRUE_LITERALS = ["1", "true", "y", "yes"]
FALSE_LITERALS = ["0", "false", "n", "no"]

# Sentinel rules (file, raw column, sentinel, replacement; None = NULL)
SENTINEL_RULES = [
    ("application_train.csv", "DAYS_EMPLOYED", "365243", None),
    ("application_test.csv", "DAYS_EMPLOYED", "365243", None),
    ("previous_application.csv", "DAYS_FIRST_DRAWING", "365243", None),
    ("previous_application.csv", "DAYS_FIRST_DUE", "365243", None),
    ("previous_application.csv", "DAYS_LAST_DUE_1ST_VERSION", "365243", None),
    ("previous_application.csv", "DAYS_LAST_DUE", "365243", None),
    ("previous_application.csv", "DAYS_TERMINATION", "365243", None),
    ("previous_application.csv", "NAME_CLIENT_TYPE", "'XNA'", "'Unknown'"),
    ("previous_application.csv", "NAME_CASH_LOAN_PURPOSE", "XNA", "Unknown"),
    ("previous_application.csv", "NAME_CASH_LOAN_PURPOSE", "XPA", "Not Applicable"),
    ("previous_application.csv", "NAME_PAYMENT_TYPE", "XNA", "Unknown"),
    ("previous_application.csv", "NAME_GOODS_CATEGORY", "XNA", "Unknown"),
]

# --------------------------------------------------------------------------------------------
# Band rules
# (group, source column, order, label, lower, upper, lower incl., upper incl., null band, text)
# --------------------------------------------------------------------------------------------
BAND_RULES = [
    ("age_band", "age_years", 1, "<25", None, 25.0, True, False, False, "Age below 25 years"),
    ("age_band", "age_years", 2, "25-34", 25.0, 35.0, True, False, False, "Age from 25 to 34 years"),
    ("age_band", "age_years", 3, "35-44", 35.0, 45.0, True, False, False, "Age from 35 to 44 years"),
    ("age_band", "age_years", 4, "45-54", 45.0, 55.0, True, False, False, "Age from 45 to 54 years"),
    ("age_band", "age_years", 5, "55-64", 55.0, 65.0, True, False, False, "Age from 55 to 64 years"),
    ("age_band", "age_years", 6, "65+", 65.0, None, True, False, False, "Age of 65 years or more"),
    ("age_band", "age_years", 99, "Unknown", None, None, False, False, True, "Missing age"),
    ("income_band", "amt_income_total", 1, "<90k", None, 90000.0, True, False, False, "Income below 90000"),
    ("income_band", "amt_income_total", 2, "90k-135k", 90000.0, 135000.0, True, False, False, "Income from 90000 to 134999"),
    ("income_band", "amt_income_total", 3, "135k-180k", 135000.0, 180000.0, True, False, False, "Income from 135000 to 179999"),
    ("income_band", "amt_income_total", 4, "180k-225k", 180000.0, 225000.0, True, False, False, "Income from 180000 to 224999"),
    ("income_band", "amt_income_total", 5, "225k-315k", 225000.0, 315000.0, True, False, False, "Income from 225000 to 314999"),
    ("income_band", "amt_income_total", 6, "315k+", 315000.0, None, True, False, False, "Income of 315000 or more"),
    ("income_band", "amt_income_total", 99, "Unknown", None, None, False, False, True, "Missing income"),
    ("employment_tenure_band", "employment_years", 1, "<1 year", None, 1.0, True, False, False, "Employment below 1 year"),
    ("employment_tenure_band", "employment_years", 2, "1-3 years", 1.0, 3.0, True, False, False, "Employment from 1 to less than 3 years"),
    ("employment_tenure_band", "employment_years", 3, "3-5 years", 3.0, 5.0, True, False, False, "Employment from 3 to less than 5 years"),
    ("employment_tenure_band", "employment_years", 4, "5-10 years", 5.0, 10.0, True, False, False, "Employment from 5 to less than 10 years"),
    ("employment_tenure_band", "employment_years", 5, "10+ years", 10.0, None, True, False, False, "Employment of 10 years or more"),
    ("employment_tenure_band", "employment_years", 99, "Unknown", None, None, False, False, True, "Missing employment tenure"),
    ("score_band", "ext_source_mean", 1, "<0.20", None, 0.2, True, False, False, "External score mean below 0.20"),
    ("score_band", "ext_source_mean", 2, "0.20-0.39", 0.2, 0.4, True, False, False, "External score mean from 0.20 to less than 0.40"),
    ("score_band", "ext_source_mean", 3, "0.40-0.59", 0.4, 0.6, True, False, False, "External score mean from 0.40 to less than 0.60"),
    ("score_band", "ext_source_mean", 4, "0.60-0.79", 0.6, 0.8, True, False, False, "External score mean from 0.60 to less than 0.80"),
    ("score_band", "ext_source_mean", 5, "0.80+", 0.8, None, True, False, False, "External score mean of 0.80 or more"),
    ("score_band", "ext_source_mean", 99, "Unknown", None, None, False, False, True, "Missing external score mean"),
    ("annuity_income_band", "annuity_income_ratio", 1, "Risco Baixo", None, 0.35, True, False, False, None),
    ("annuity_income_band", "annuity_income_ratio", 2, "Risco Moderado", 0.35, 0.41, True, False, False, None),
    ("annuity_income_band", "annuity_income_ratio", 3, "Risco Alto", 0.41, 0.5, True, False, False, None),
    ("annuity_income_band", "annuity_income_ratio", 4, "Risco Muito Alto", 0.5, 1.0, True, False, False, None),
    ("annuity_income_band", "annuity_income_ratio", 5, "Outlier", 1.0, None, True, False, False, None),
    ("annuity_income_band", "annuity_income_ratio", 99, "Unknown", None, None, False, False, True, None),
]
BANDS_OUTSIDE_ORDER = ["Unknown", "Outlier"]

# --------------------------------------------------------------------------------------------
# Category codes behind equality and membership flags (flag -> column, code)
# --------------------------------------------------------------------------------------------
UNKNOWN = "Unknown"
LOAN_TYPE_FLAGS = {
    "flag_cash_loan": ("name_contract_type", "Cash loans"),
    "flag_revolving_loan": ("name_contract_type", "Revolving loans"),
    "flag_consumer_loan": ("name_contract_type", "Consumer loans"),
}
ACTIVITY_FLAGS = {
    "flag_self_employed": ("organization_type", "Self-employed"),
    "flag_unemployed": ("name_income_type", "Unemployed"),
    "flag_student": ("name_income_type", "Student"),
    "flag_pensioner": ("name_income_type", "Pensioner"),
    "flag_maternity_leave": ("name_income_type", "Maternity leave"),
}
INACTIVE_INCOME_TYPES = ["Unemployed", "Student", "Pensioner", "Maternity leave"]
MARRIED_STATUSES = ["Married", "Civil marriage"]
BUREAU_CODE_FLAGS = {
    "flag_active_credit": ("credit_active", "Active"),
    "flag_bad_debt": ("credit_active", "Bad debt"),
    "flag_consumer_credit": ("credit_type", "Consumer credit"),
    "flag_credit_card": ("credit_type", "Credit card"),
    "flag_car_loan": ("credit_type", "Car loan"),
    "flag_mortgage": ("credit_type", "Mortgage"),
}
DECISION_FLAGS = {
    "flag_approved_application": ("name_contract_status", "Approved"),
    "flag_refused_application": ("name_contract_status", "Refused"),
    "flag_canceled_application": ("name_contract_status", "Canceled"),
}
REPEATER_FLAG = {"flag_repeater": ("name_client_type", "Repeater")}
ACTIVE_CONTRACT_FLAG = {"flag_active_contract": ("name_contract_status", "Active")}
STATUS_UNKNOWN, STATUS_CLOSED = "X", "C"
STATUS_OVERDUE = ["1", "2", "3", "4", "5"]
STATUS_SEVERE = ["3", "4", "5"]

# thresholds
DAYS_PER_YEAR = 365.0
RECENT_DAYS = 30
RECENT_MONTHS = 1
LONG_TERM_PAYMENTS = 24
SEVERE_DPD_DAYS = 60
NEAR_COMPLETION_PAYMENTS = 3
HIGH_UTILIZATION = 0.8
FULL_UTILIZATION = 1.0
MANY_DRAWINGS = 5

# One-hot columns of the feature store (source column -> code -> flag)
ONE_HOT = {
    "code_gender": {"F": "flag_gender_female", "M": "flag_gender_male"},
    "name_income_type": {
        "Working": "flag_income_working",
        "Commercial associate": "flag_income_commercial_associate",
        "Pensioner": "flag_income_pensioner",
        "State servant": "flag_income_state_servant",
    },
    "name_education_type": {
        "Secondary / secondary special": "flag_education_secondary",
        "Higher education": "flag_education_higher",
        "Incomplete higher": "flag_education_incomplete_higher",
        "Lower secondary": "flag_education_lower_secondary",
        "Academic degree": "flag_education_academic_degree",
    },
    "name_family_status": {
        "Single / not married": "flag_family_single",
        "Civil marriage": "flag_family_civil_marriage",
        "Separated": "flag_family_separated",
        "Widow": "flag_family_widow",
    },
    "name_housing_type": {
        "House / apartment": "flag_housing_house_apartment",
        "With parents": "flag_housing_with_parents",
        "Municipal apartment": "flag_housing_municipal",
        "Rented apartment": "flag_housing_rented",
    },
    "occupation_type_clean": {
        "Unknown": "flag_occupation_unknown",
        "Laborers": "flag_occupation_laborers",
        "Sales staff": "flag_occupation_sales_staff",
        "Core staff": "flag_occupation_core_staff",
        "Managers": "flag_occupation_managers",
        "Drivers": "flag_occupation_drivers",
        "High skill tech staff": "flag_occupation_high_skill_tech",
        "Accountants": "flag_occupation_accountants",
        "Security staff": "flag_occupation_security_staff",
    },
}

# --------------------------------------------------------------------------------------------
# Report labels and limits
# --------------------------------------------------------------------------------------------
GENDER_LABELS = {"M": "Masculino", "F": "Feminino"}
GENDER_UNKNOWN = "XNA"
PROFILE_AXES = {
    "Faixa de renda": "income_band",
    "Faixa etária": "age_band",
    "Tipo de Família": "name_family_status",
    "Tipo de Trabalho": "name_income_type",
    "Educação": "name_education_type",
    "Gênero": "code_gender",
}
ORDERED_AXES = {"Faixa de renda": "income_band", "Faixa etária": "age_band"}
RISK_HIGH, RISK_LOW, RISK_NEAR = "Alto risco", "Baixo risco", "Próximo da média"
RISK_HIGH_LIFT, RISK_LOW_LIFT = 1.25, 0.85
DEFAULT_SHARE, REST_SHARE = "Valor", "Restante"
MIN_CLIENTS = 100
TOP_SEGMENTS = 12
TOP_CORRELATIONS = 15
LOW_COMPLETENESS = 0.70

# Behaviour segments, in report order (label, kind, column, limit).
# kind: set = flag is true; unset = flag is not true; low = rate below limit with NULL as 0;
# known_low = rate below limit, NULL stays out; many = count at or above limit with NULL as 0.
BEHAVIOR_SEGMENTS = [
    ("Self employed", "set", "flag_self_employed", None),
    ("Desempregado", "set", "flag_unemployed", None),
    ("Economicamente inativo", "set", "flag_economically_inactive", None),
    ("Pensionista", "set", "flag_pensioner", None),
    ("Sem carro próprio", "unset", "flag_own_car", None),
    ("Sem imóvel próprio", "unset", "flag_own_realty", None),
    ("High user cartão", "set", "flag_high_card_user", None),
    ("Overuser cartão", "set", "flag_has_overused_card", None),
    ("Atraso interno em parcela", "set", "flag_has_had_late_payment", None),
    ("DPD interno POS", "set", "internal_pos_dpd", None),
    ("DPD interno severo", "set", "internal_pos_severe_dpd", None),
    ("DPD externo", "set", "external_had_dpd", None),
    ("DPD externo severo", "set", "external_severe_dpd", None),
    ("Bad debt externo", "set", "external_bad_debt", None),
    ("Crédito externo recente", "set", "external_recent_credit", None),
    ("Sem histórico interno", "set", "flag_missing_prev_applications_info", None),
    ("Sem bureau", "set", "flag_missing_bureau_info", None),
    ("Completude cadastral Residência <70%", "known_low", "housing_info_fill_rate", LOW_COMPLETENESS),
    ("Contato cadastral <70%", "low", "contact_info_filled_rate", LOW_COMPLETENESS),
    ("Documentos <70%", "low", "document_provided_rate", LOW_COMPLETENESS),
    ("Consultas de crédito 6+", "many", "total_credit_inquiries", 6),
    ("Créditos antigos 6+", "many", "bureau_total_loans", 6),
    ("Recusas históricas 3+", "many", "prev_applications_refused", 3),
]

# Correlation variables, in report order (label, column, is a flag)
CORRELATION_VARIABLES = [
    ("Renda", "amt_income_total", False),
    ("Anuidade/Renda", "annuity_income_ratio", False),
    ("Crédito/Renda", "loan_income_ratio", False),
    ("Score externo médio", "ext_source_mean", False),
    ("Consultas crédito", "total_credit_inquiries", False),
    ("Créditos antigos", "bureau_total_loans", False),
    ("Créditos com DPD", "bureau_total_loans_with_dpd", False),
    ("Créditos com DPD severo", "bureau_total_loans_with_severe_dpd", False),
    ("Recusas históricas", "prev_applications_refused", False),
    ("Utilização cartão max", "max_credit_utilization", False),
    ("Completude cadastral", "cadastral_completeness_rate", False),
    ("Flag self employed", "flag_self_employed", True),
    ("Flag desempregado", "flag_unemployed", True),
    ("Flag high card user", "flag_high_card_user", True),
    ("Flag overuser cartão", "flag_has_overused_card", True),
    ("Flag atraso parcela", "flag_has_had_late_payment", True),
    ("Flag DPD externo", "external_had_dpd", True),
    ("Flag DPD externo severo", "external_severe_dpd", True),
    ("Flag bad debt externo", "external_bad_debt", True),
]
# The five rates behind the dashboard's completeness proxy
COMPLETENESS_PROXY = [
    "housing_info_fill_rate", "contact_info_filled_rate", "ext_source_fill_rate",
    "social_circle_info_filled_rate", "document_provided_rate",
]
