"""Row-level features on hand-written edge rows."""

import math

import pytest
from pyspark.sql import functions as F

from creditloom.functions import display, rows
from creditloom.plans import silver


def one(spark, schema, values, column):
    return spark.createDataFrame([values], schema).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "values, expected",
    [((None, None), None), ((0.0, None), False), ((None, 2.0), True), ((0.0, 0.0), False)],
)
def test_any_positive_has_three_states(spark, values, expected):
    assert one(spark, "a double, b double", values, rows.any_positive(["a", "b"])) is expected


@pytest.mark.parametrize(
    "values, total, mean, count",
    [
        ((None, None, None), None, None, 0),
        ((0.5, None, None), 0.5, 0.5, 1),
        ((0.0, 0.0, 0.0), 0.0, 0.0, 3),
        ((0.2, 0.4, None), 0.6000000000000001, 0.30000000000000004, 2),
    ],
)
def test_row_sum_mean_count(spark, values, total, mean, count):
    schema, names = "a double, b double, c double", ["a", "b", "c"]
    assert one(spark, schema, values, rows.row_sum(names)) == total
    assert one(spark, schema, values, rows.row_mean(names)) == mean
    assert one(spark, schema, values, rows.present_count(names)) == count
    assert one(spark, schema, values, rows.missing_count(names)) == 3 - count


def test_true_count_reads_null_as_not_set(spark):
    assert one(spark, "a boolean, b boolean, c boolean", (True, None, False), rows.true_count(list("abc"))) == 1


@pytest.mark.parametrize(
    "n, d, expected",
    [(1.0, 0.0, math.inf), (-1.0, 0.0, -math.inf), (1.0, 4.0, 0.25), (None, 0.0, None), (1.0, None, None)],
)
def test_ieee_divide(spark, n, d, expected):
    assert one(spark, "n double, d double", (n, d), rows.ieee_divide(F.col("n"), F.col("d"))) == expected


def test_ieee_divide_zero_by_zero_is_nan(spark):
    assert math.isnan(one(spark, "n double, d double", (0.0, 0.0), rows.ieee_divide(F.col("n"), F.col("d"))))


@pytest.mark.parametrize("a, b, expected", [(5.0, 3.0, 2.0), (3.0, 5.0, 0.0), (None, 5.0, 0.0)])
def test_excess_is_zero_without_input(spark, a, b, expected):
    assert one(spark, "a double, b double", (a, b), rows.excess("a", "b")) == expected


@pytest.mark.parametrize(
    "n, d, guarded, nulled", [(1.0, 0.0, None, None), (1.0, -2.0, None, -0.5), (1.0, 2.0, 0.5, 0.5)]
)
def test_ratios(spark, n, d, guarded, nulled):
    schema = "n double, d double"
    assert one(spark, schema, (n, d), rows.ratio_if_positive("n", "d")) == guarded
    assert one(spark, schema, (n, d), rows.ratio_or_null("n", "d")) == nulled


@pytest.mark.parametrize(
    "status, number, dpd, severe, recent",
    [
        ("X", None, False, False, False), ("C", 0, False, False, False), ("0", 0, False, False, False),
        ("1", 1, True, False, True), ("5", 5, True, True, True), (None, None, None, None, None),
    ],
)
def test_monthly_status(spark, status, number, dpd, severe, recent):
    df = spark.createDataFrame([(1, -1, status)], "sk_bureau_id long, months_balance long, status string")
    row = silver.bureau_balance(df).first()
    assert (row.status_numeric, row.flag_has_dpd, row.flag_severe_dpd, row.flag_recent_dpd) == (
        number, dpd, severe, recent,
    )


def test_unreadable_status_raises(spark):
    df = spark.createDataFrame([(1, -1, "Z")], "sk_bureau_id long, months_balance long, status string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        silver.bureau_balance(df).collect()


def test_card_without_limit_does_not_divide(spark):
    df = spark.createDataFrame(
        [(1, 5.0, 0), (2, 9.0, 10), (3, 11.0, 10), (4, None, 10)],
        "sk_id_prev long, amt_balance double, amt_credit_limit_actual long",
    ).selectExpr(
        "*", "1D AS amt_payment_current", "1D AS amt_inst_min_regularity",
        "0D AS amt_drawings_current", "5L AS cnt_drawings_current",
    )
    found = {
        r.sk_id_prev: (r.flag_high_utilization, r.flag_over_utilization, r.credit_utilization_ratio)
        for r in silver.credit_card_balance(df).collect()
    }
    assert found == {
        1: (False, False, None), 2: (True, False, 0.9), 3: (True, True, 1.1), 4: (None, None, None),
    }


def test_codes_with_quotes_are_literals(spark):
    flag = rows.code_flags({"f": ("c", "it's \\ fine")})["f"]
    assert one(spark, "c string", ("it's \\ fine",), flag) is True


@pytest.mark.parametrize(
    "value, number, percent",
    [
        (None, "-", "-"), (0.0, "0", "0.00%"), (999.5, "1,000", "99950.00%"),
        (1234567.0, "1.2M", "123456700.00%"), (2.5e9, "2.5B", "250000000000.00%"), (-5.0, "-5", "-500.00%"),
    ],
)
def test_human_numbers(spark, value, number, percent):
    assert one(spark, "v double", (value,), display.human_number(F.col("v"))) == number
    assert one(spark, "v double", (value,), display.human_percent(F.col("v"))) == percent


@pytest.mark.parametrize(
    "lift, label, bucket",
    [
        (1.25, "1.2x", "Alto risco"), (0.85, "0.8x", "Baixo risco"), (1.0, "1.0x", "Próximo da média"),
        (None, "nanx", "Próximo da média"),
    ],
)
def test_risk_bucket_and_label(spark, lift, label, bucket):
    assert one(spark, "v double", (lift,), display.risk_bucket(F.col("v"))) == bucket
    # Half-even on the exact binary value, as text formatting of doubles does.
    assert one(spark, "v double", (lift,), display.lift_label(F.col("v"))) == label
