"""Gives generic order/event tables the shape of the credit inputs.

Used by the checks: every adapter view is a plain projection of a given table, written in SQL
expressions that Spark and the checking engine read alike.  ``{dd}`` is the one difference
between the two dialects (days from the order to a fixed date).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import vocab

SPARK_DAYS = "datediff(DATE '2001-08-05', CAST(o_orderdate AS DATE))"
DUCKDB_DAYS = "date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-05')"


def _choice(expression: str, labels: list[str | None]) -> str:
    """CASE over the remainders 0, 1, … of an expression."""
    arms = " ".join(
        f"WHEN {i} THEN {'NULL' if label is None else repr(label)}"
        for i, label in enumerate(labels)
    )
    return f"CASE ({expression}) % {len(labels)} {arms} END"


def _numbers(columns: list[str], gap: int) -> dict[str, str]:
    return {
        name: f"CASE WHEN (c_custkey + {i}) % {gap} = 0 OR c_custkey % 16 = 9 THEN NULL "
        f"ELSE CAST((c_custkey + {i}) % 10 AS DOUBLE) END"
        for i, name in enumerate(columns)
    }


def _booleans(columns: list[str], every: int) -> dict[str, str]:
    return {
        name: f"CASE WHEN (c_custkey + {i}) % 23 = 0 THEN NULL "
        f"ELSE (c_custkey + {i}) % {every} = 0 END"
        for i, name in enumerate(columns)
    }


def _orphaned(condition: str) -> str:
    """The order key, moved out of the parent's range for some rows: history without a parent."""
    return f"CASE WHEN {condition} THEN l_orderkey + 1000000000000 ELSE l_orderkey END"


_INCOME_TYPES = [
    "Working", "Commercial associate", "Pensioner", "State servant", "Unemployed", "Student",
    "Maternity leave",
]
_EDUCATION = [
    "Secondary / secondary special", "Higher education", "Incomplete higher", "Lower secondary",
    "Academic degree",
]
_FAMILY = ["Married", "Single / not married", "Civil marriage", "Separated", "Widow", None]
_HOUSING_TYPES = ["House / apartment", "With parents", "Municipal apartment", "Rented apartment"]
_OCCUPATIONS = [
    "Laborers", "Sales staff", "Core staff", "Managers", "Drivers", "High skill tech staff",
    "Accountants", "Security staff", None,
]
_WEEKDAYS = ["MONDAY", "TUESDAY", "WEDNESDAY", "THURSDAY", "FRIDAY", "SATURDAY", "SUNDAY"]

_APPLICATIONS = {
    "sk_id_curr": "c_custkey",
    "target": "CASE WHEN c_custkey % 7 = 3 THEN NULL ELSE c_acctbal < 0 END",
    "flag_test": "(c_custkey % 7 = 3)",
    "name_contract_type": "CASE c_mktsegment WHEN 'BUILDING' THEN 'Revolving loans' "
    "WHEN 'FURNITURE' THEN 'Consumer loans' ELSE 'Cash loans' END",
    "code_gender": "CASE WHEN c_custkey % 50 = 0 THEN 'XNA' WHEN c_custkey % 3 = 0 THEN 'M' "
    "ELSE 'F' END",
    "amt_income_total": "CASE WHEN c_custkey % 11 = 0 THEN NULL "
    "ELSE (c_acctbal + 1000.0e0) * 35.0e0 END",
    "amt_credit": "(c_acctbal + 1000.0e0) * 50.0e0 + c_nationkey * 1000.0e0",
    "amt_annuity": "CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE 2000.0e0 * (c_custkey % 37) END",
    "days_birth": "CASE WHEN c_custkey % 40 = 7 THEN NULL ELSE -(18 + c_custkey % 60) * 365 END",
    "days_employed": "CASE WHEN c_custkey % 5 = 0 THEN NULL "
    "ELSE -((c_custkey * 17) % 5000) END",
    "ext_source_1": "CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE (c_custkey % 101) / 100.0e0 END",
    "ext_source_2": "CASE WHEN c_custkey % 10 = 4 THEN NULL ELSE (c_custkey % 97) / 96.0e0 END",
    "ext_source_3": "CASE WHEN c_custkey % 5 = 4 THEN NULL ELSE (c_custkey % 89) / 88.0e0 END",
    "name_income_type": _choice("c_custkey + c_nationkey", _INCOME_TYPES),
    "name_education_type": _choice("c_nationkey", _EDUCATION),
    "name_family_status": _choice("c_custkey + c_nationkey", _FAMILY),
    "name_housing_type": _choice("c_custkey * 3 + c_nationkey", _HOUSING_TYPES),
    "occupation_type": _choice("c_custkey + 2 * c_nationkey", _OCCUPATIONS),
    "organization_type": _choice(
        "c_custkey + 1", ["Self-employed", "Business Entity", "School", None]
    ),
    "name_type_suite": _choice("c_custkey + 3", ["Family", "Unaccompanied", None]),
    "cnt_children": "CAST(c_custkey % 4 AS BIGINT)",
    "cnt_fam_members": "CASE WHEN c_custkey % 19 = 0 THEN NULL "
    "ELSE CAST(c_custkey % 6 AS DOUBLE) END",
    "amt_goods_price": "CASE WHEN c_custkey % 17 = 0 THEN NULL "
    "ELSE (c_acctbal + 1000.0e0) * 45.0e0 END",
    "flag_own_car": "(c_custkey % 3 = 1)",
    "flag_own_realty": "CASE WHEN c_custkey % 8 = 5 THEN NULL ELSE c_custkey % 5 < 3 END",
    "own_car_age": "CASE WHEN c_custkey % 3 = 1 THEN CAST(c_custkey % 30 AS DOUBLE) END",
    "weekday_appr_process_start": _choice("c_custkey", _WEEKDAYS),
    "hour_appr_process_start": "c_custkey % 24",
    "days_registration": "CAST(-(c_custkey % 9000) AS DOUBLE)",
    "days_id_publish": "-(c_custkey % 4000)",
    "days_last_phone_change": "CAST(-(c_custkey % 1500) AS DOUBLE)",
    "region_population_relative": "c_nationkey / 1000.0e0",
    "region_rating_client": "1 + c_custkey % 3",
    "region_rating_client_w_city": "1 + (c_custkey + 1) % 3",
    **_numbers(vocab.HOUSING, 4),
    **_numbers(vocab.BUREAU_REQUESTS, 5),
    **_numbers(vocab.SOCIAL_CIRCLE, 3),
    **_booleans(vocab.CONTACT, 2),
    **_booleans(vocab.DOCUMENTS, 7),
    **_booleans(vocab.REGION_MISMATCH, 9),
}
_BUREAU = {
    "sk_id_curr": "o_custkey",
    "sk_bureau_id": "o_orderkey",
    "credit_active": "CASE o_orderstatus WHEN 'O' THEN 'Active' WHEN 'F' THEN 'Closed' "
    "ELSE 'Bad debt' END",
    "credit_type": "CASE o_orderpriority WHEN '1-URGENT' THEN 'Credit card' "
    "WHEN '2-HIGH' THEN 'Car loan' WHEN '3-MEDIUM' THEN 'Mortgage' "
    "ELSE 'Consumer credit' END",
    "days_credit": "CAST(-{dd} AS BIGINT)",
    "credit_day_overdue": "CASE WHEN o_orderkey % 23 = 1 THEN o_orderkey % 90 ELSE 0 END",
    "cnt_credit_prolong": "o_orderkey % 4",
    "amt_credit_sum": "CASE WHEN o_orderkey % 29 = 0 THEN 0.0e0 ELSE o_totalprice END",
    "amt_credit_sum_debt": "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice * 0.4e0 END",
    "amt_credit_sum_overdue": "CASE WHEN o_orderkey % 23 = 1 THEN o_totalprice * 0.1e0 "
    "ELSE 0.0e0 END",
    "amt_annuity": "CASE WHEN o_orderkey % 4 = 1 THEN NULL ELSE o_totalprice / 36.0e0 END",
}
_BUREAU_BALANCE = {
    "sk_bureau_id": _orphaned("l_orderkey % 3 = 1"),
    "months_balance": "CAST(-l_linenumber AS BIGINT)",
    "status": "CASE WHEN l_quantity < 8 THEN 'X' WHEN l_quantity < 16 THEN 'C' "
    "WHEN l_quantity < 38 THEN '0' WHEN l_quantity < 43 THEN '1' WHEN l_quantity < 46 THEN '2' "
    "WHEN l_quantity < 48 THEN '3' WHEN l_quantity < 50 THEN '4' ELSE '5' END",
}
_PREVIOUS = {
    "sk_id_prev": "o_orderkey",
    "sk_id_curr": "o_custkey",
    "name_contract_status": "CASE o_orderstatus WHEN 'O' THEN 'Approved' "
    "WHEN 'F' THEN 'Refused' ELSE 'Canceled' END",
    "name_contract_type": _choice(
        "o_orderkey", ["Cash loans", "Revolving loans", "Consumer loans"]
    ),
    "name_client_type": "CASE WHEN o_orderkey % 4 = 0 THEN 'Repeater' ELSE 'New' END",
    "amt_application": "CASE WHEN o_orderkey % 31 = 0 THEN 0.0e0 ELSE o_totalprice END",
    "amt_credit": "o_totalprice * 0.9e0",
    "amt_annuity": "o_totalprice / 24.0e0",
    "amt_goods_price": "CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_totalprice * 1.1e0 END",
    "cnt_payment": "CAST(o_orderkey % 48 AS DOUBLE)",
    "days_decision": "CAST(-{dd} AS BIGINT)",
    "amt_down_payment": "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_totalprice * 0.05e0 END",
    "name_type_suite": "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'Family' END",
    "name_goods_category": "CASE WHEN o_orderkey % 11 = 0 THEN NULL "
    "WHEN o_orderkey % 11 = 1 THEN 'XNA' ELSE 'Mobile' END",
    "name_cash_loan_purpose": _choice("o_orderkey", ["XAP", "XNA", "XPA", "Repairs"]),
    "name_payment_type": _choice("o_orderkey + 1", ["Cash through the bank", "XNA", None]),
    "days_first_drawing": "CASE WHEN o_orderkey % 10 = 2 THEN 365243.0e0 "
    "ELSE CAST(-(o_orderkey % 700) AS DOUBLE) END",
}
_INSTALLMENTS = {
    "sk_id_prev": _orphaned("l_orderkey % 5 = 0"),
    "sk_id_curr": "o_custkey",
    "num_instalment_number": "CAST(l_linenumber AS BIGINT)",
    "days_instalment": "CAST(-l_linenumber * 30 AS DOUBLE)",
    "days_entry_payment": "CASE WHEN l_suppkey % 20 = 0 THEN NULL "
    "ELSE CAST(-l_linenumber * 30 + (l_partkey % 21) - 15 AS DOUBLE) END",
    "amt_instalment": "CASE WHEN l_partkey % 41 = 0 THEN 0.0e0 ELSE l_extendedprice END",
    "amt_payment": "CASE WHEN l_suppkey % 20 = 0 THEN NULL ELSE l_extendedprice * "
    "(1.0e0 - CASE WHEN l_discount >= 0.08e0 THEN l_discount ELSE 0.0e0 END) END",
}
_CARD = {
    "sk_id_prev": "user_id * 2",
    "event_id": "event_id",
    "amt_balance": "value * 10.0e0",
    "amt_credit_limit_actual": "CASE WHEN event_type = 'signup' THEN 0 "
    "ELSE 200 + 100 * (user_id % 10) END",
    "amt_payment_current": "value",
    "amt_inst_min_regularity": "CASE WHEN event_id % 9 = 0 THEN NULL ELSE 20.0e0 END",
    "amt_drawings_current": "CASE WHEN event_type = 'purchase' THEN value ELSE 0.0e0 END",
    "cnt_drawings_current": "event_id % 8",
    "sk_dpd": "CASE WHEN event_type = 'error' THEN event_id % 100 ELSE 0 END",
}
_POS = {
    "sk_id_prev": _orphaned("l_orderkey % 7 = 0"),
    "months_balance": "CAST(-l_linenumber AS BIGINT)",
    "name_contract_status": "CASE l_linestatus WHEN 'O' THEN 'Active' ELSE 'Completed' END",
    "cnt_instalment": "CAST(l_partkey % 25 AS DOUBLE)",
    "cnt_instalment_future": "CAST(l_linenumber AS DOUBLE)",
    "sk_dpd": "CASE WHEN l_returnflag = 'R' AND l_discount >= 0.07e0 THEN l_partkey % 120 "
    "ELSE 0 END",
}
# The event table in the role of a refresh log.
_EVENT_LOG = {
    "run_id": "CAST(user_id % 25 AS STRING)",
    "seq": "event_id",
    "event_ts_utc": "ts",
    "layer": "CASE WHEN user_id % 2 = 0 THEN 'silver' ELSE 'gold' END",
    "entity_type": "'table'",
    "entity_name": "CAST(user_id AS STRING)",
    "status": "CASE event_type WHEN 'error' THEN 'failed' WHEN 'click' THEN 'success' "
    "WHEN 'view' THEN 'skipped_cached_transformation' ELSE 'success' END",
    "process_version": "CASE WHEN event_id % 50 = 0 THEN 'v0' ELSE 'v1' END",
    "file_fingerprint": "CAST(event_id % 3 AS STRING)",
    "row_count": "event_id % 1000",
}

# name -> (source tables, columns); every row of the source tables plays one row of the view
VIEWS: dict[str, tuple[tuple[str, ...], dict[str, str]]] = {
    "applications": (("customer",), _APPLICATIONS),
    "bureau": (("orders",), _BUREAU),
    "bureau_balance": (("lineitem",), _BUREAU_BALANCE),
    "previous_application": (("orders",), _PREVIOUS),
    "installments_payments": (("lineitem", "orders"), _INSTALLMENTS),
    "credit_card_balance": (("events",), _CARD),
    "pos_cash_balance": (("lineitem",), _POS),
    "event_log": (("events",), _EVENT_LOG),
}


def duckdb_view(name: str) -> str:
    """The adapter view as a SELECT for the checking engine."""
    tables, columns = VIEWS[name]
    items = ", ".join(
        f"{expr.replace('{dd}', DUCKDB_DAYS)} AS {col}" for col, expr in columns.items()
    )
    source = tables[0]
    if len(tables) == 2:
        source = f"{tables[0]} JOIN {tables[1]} ON l_orderkey = o_orderkey"
    return f"SELECT {items} FROM {source}"


def spark_view(name: str, read: Callable[[str], DataFrame]) -> DataFrame:
    """The adapter view as a DataFrame; ``read`` gives the source table of a name."""
    tables, columns = VIEWS[name]
    frames = [read(t) for t in tables]
    if len(frames) == 2:
        # Instalments carry their order's client: an equi-join on the order key.
        source = frames[0].join(frames[1], F.col("l_orderkey") == F.col("o_orderkey"))
    else:
        source = frames[0]
    return source.selectExpr(
        *[f"{expr.replace('{dd}', SPARK_DAYS)} AS {col}" for col, expr in columns.items()]
    )
