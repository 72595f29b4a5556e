"""Roll-ups, star schema and analytics."""

import math

from pyspark.sql import functions as F

from creditloom import vocab
from creditloom.plans import gold, insights, silver


def test_external_flags_stay_unknown_without_balance(spark):
    bureau = spark.createDataFrame(
        [(1, 0), (2, 5), (3, 70), (4, 0)], "sk_bureau_id long, credit_day_overdue long"
    )
    months = silver.bureau_balance(
        spark.createDataFrame([(4, -1, "0"), (4, -2, "3")], "sk_bureau_id long, months_balance long, status string")
    )
    found = {
        r.sk_bureau_id: (r.flag_balance_missing, r.flag_has_dpd_agg, r.flag_severe_dpd_agg, r.max_dpd_status)
        for r in silver.external_behavior(bureau, months).collect()
    }
    assert found == {
        1: (True, None, None, None), 2: (True, True, None, None), 3: (True, True, True, None),
        4: (False, True, True, 3),
    }


def test_card_rollup_divides_by_zero_like_floats(spark):
    card = silver.credit_card_balance(
        spark.createDataFrame(
            [(1, 0.0, 0), (2, 5.0, 0), (3, 5.0, 10)],
            "sk_id_prev long, amt_balance double, amt_credit_limit_actual long",
        ).selectExpr(
            "*", "1D AS amt_payment_current", "1D AS amt_inst_min_regularity", "0L AS sk_dpd",
            "0D AS amt_drawings_current", "0L AS cnt_drawings_current",
        )
    )
    found = {r.sk_id_prev: r.wavg_credit_utilization for r in silver.card_rollup(card).collect()}
    assert math.isnan(found[1]) and found[2] == math.inf and found[3] == 0.5


def test_no_join_multiplies_rows(inputs):
    t = inputs
    assert t.external_behavior.count() == t.bureau.count()
    assert t.internal_behavior.count() == t.previous.count()
    features = gold.feature_store(t.applications, t.internal, t.external)
    assert features.count() == t.applications.count()
    assert len(features.columns) == 159 == len(set(features.columns))


def test_star_schema_shape_and_keys(inputs):
    t = inputs
    n = t.applications.count()
    fact = gold.fact_credit_risk(t.spine, t.internal, t.external)
    dims = {
        "requester_key": (gold.dim_requester(t.spine, t.rule_rows), 28),
        "contract_key": (gold.dim_contract(t.spine), 7),
        "risk_segment_key": (gold.dim_risk_segment(t.spine, t.internal, t.external, t.rule_rows), 23),
    }
    for key, (dim, width) in dims.items():
        assert len(dim.columns) == width
        low, high, distinct = dim.agg(F.min(key), F.max(key), F.count_distinct(key)).first()
        assert (low, high, distinct) == (1, n, n)
    assert len(fact.columns) == 67
    assert fact.count() == t.applications.where("NOT flag_test").count()
    star = insights.portfolio_from_star(fact, requester := dims["requester_key"][0], dims["risk_segment_key"][0])
    direct = insights.behavior_segments(t.portfolio, 1).collect()
    assert [r.segmento for r in insights.behavior_segments(star, 1).collect()] == [r.segmento for r in direct]
    assert fact.join(requester, ["requester_key", "sk_id_curr"]).count() == fact.count()


def base_row(**values):
    row = {"sk_id_curr": 1, "target": False, "amt_credit": 10.0, "amt_income_total": 5.0}
    for _, kind, column, _ in vocab.BEHAVIOR_SEGMENTS:
        row[column] = {"set": False, "unset": True}.get(kind, 1.0 if "low" in kind else 0)
    row.update(
        {
            "code_gender": "F", "age_band": "<25", "income_band": "<90k", "name_family_status": None,
            "name_income_type": "Working", "name_education_type": "x", "annuity_income_band": "Risco Baixo",
            "annuity_income_ratio": 0.1, "loan_income_ratio": 1.0, "ext_source_mean": 0.5,
            "bureau_total_loans_with_dpd": 0, "bureau_total_loans_with_severe_dpd": 0,
            "max_credit_utilization": 0.5, "ext_source_fill_rate": 1.0,
            "social_circle_info_filled_rate": 1.0, "prev_applications_approved": 1,
            "prev_applications_total": 2,
        }
    )
    row.update(values)
    return row


SCHEMA_TYPES = {bool: "boolean", float: "double", int: "long", str: "string"}


def base_table(spark, rows):
    full = [base_row(**{"sk_id_curr": i, **r}) for i, r in enumerate(rows)]
    sample = base_row(name_family_status="x")
    schema = ", ".join(f"{k} {SCHEMA_TYPES[type(v)]}" for k, v in sample.items())
    return spark.createDataFrame([tuple(r[k] for k in sample) for r in full], schema)


def test_segment_lift_drops_unknown_and_small_groups(spark):
    base = base_table(
        spark,
        [{"target": True}, {}, {"code_gender": "XNA"}, {"age_band": "Unknown"}, {"income_band": None},
         {"code_gender": "M"}, {"code_gender": None}, {"income_band": "Outlier"}],
    )
    at_two = insights.segment_lift(base, 2).collect()
    assert [(r.genero, r.clientes, r.lift_risco) for r in at_two] == [("Feminino", 2, 4.0)]
    assert [r.genero for r in insights.segment_lift(base, 1).collect()] == ["Feminino", "Masculino"]
    assert insights.segment_lift(base, 3).collect() == []


def test_behaviour_segments_treat_nulls_by_rule(spark):
    base = base_table(
        spark,
        [
            {"housing_info_fill_rate": None, "contact_info_filled_rate": None, "flag_own_car": None},
            {"total_credit_inquiries": 6, "target": True},
        ],
    )
    found = {r.segmento: r for r in insights.behavior_segments(base, 1).collect()}
    assert set(found) == {"Contato cadastral <70%", "Sem carro próprio", "Consultas de crédito 6+"}
    assert found["Consultas de crédito 6+"].lift_risco == 2.0
    assert found["Consultas de crédito 6+"].pct_defaults == 1.0


def test_clients_are_counted_once(spark):
    base = base_table(spark, [{"sk_id_curr": 9}, {"sk_id_curr": 9, "target": True}])
    assert insights.portfolio_kpis(base).first().n_total_loans == 1
    assert insights.segment_lift(base, 1).first().clientes == 1


def test_constant_variables_have_no_correlation(spark):
    base = base_table(
        spark,
        [{"amt_income_total": 1.0, "target": True}, {"amt_income_total": 2.0},
         {"amt_income_total": 9.0, "target": None}, {"amt_income_total": None, "target": True}],
    )
    found = {r.variavel: r.correlacao for r in insights.target_correlation(base).collect()}
    assert len(found) == 19
    assert found["Renda"] == -1.0
    assert found["Anuidade/Renda"] is None
    assert [r.variavel for r in insights.top_correlation(base).collect()] == ["Renda"]
    matrix = insights.correlation_matrix(base).first()
    assert matrix["Renda"] == -1.0 and matrix["Crédito/Renda"] is None


def test_profile_has_unknown_bucket_and_band_order(spark, inputs):
    base = base_table(spark, [{"code_gender": "XNA"}, {"age_band": "65+"}])
    found = {(r.distribution_type, r.bucket): r.clients for r in insights.profile_distribution(base).collect()}
    assert found[("Gênero", "Unknown")] == 1 and found[("Gênero", "Feminino")] == 1
    assert found[("Tipo de Família", "Unknown")] == 2
    laid_out = insights.profile_reindexed(base, inputs.band_rules).collect()
    ages = [(r.bucket, r.clients) for r in laid_out if r.distribution_type == "Faixa etária"]
    assert ages == [("<25", 1), ("25-34", None), ("35-44", None), ("45-54", None), ("55-64", None), ("65+", 1)]


def scans(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan.count("Relation [") + plan.count("LogicalRDD") + plan.count("LocalRelation")


def test_reports_scan_the_base_once(spark, tmp_path):
    path = str(tmp_path / "base")
    base_table(spark, [{}, {"target": True}]).write.parquet(path)
    base = spark.read.parquet(path)
    assert scans(insights.profile_distribution(base)) == 1
    assert scans(insights.target_correlation(base)) == 1
    # The segments once, and the four portfolio totals once more over three columns.
    assert scans(insights.behavior_segments(base)) == 1


def test_baseline_does_not_read_the_histories(inputs):
    plan = inputs.portfolio.agg(F.avg(F.col("target").cast("int")))._jdf.queryExecution().optimizedPlan()
    assert "Join" not in plan.toString()
