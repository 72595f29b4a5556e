"""What the reports shuffle and read: no rows per client, no dimension that is not shown."""

import pytest

from creditloom.plans import gold, insights
from creditloom.sources import storage


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def star(spark, inputs, tmp_path_factory):
    where = tmp_path_factory.mktemp("star")
    tables = {
        "fact": gold.fact_credit_risk(inputs.spine, inputs.internal, inputs.external),
        "requester": gold.dim_requester(inputs.spine, inputs.rule_rows),
        "risk": gold.dim_risk_segment(inputs.spine, inputs.internal, inputs.external, inputs.rule_rows),
    }
    for name, df in tables.items():
        storage.write_parquet(df, str(where / name))
    return insights.Star(*[storage.read_parquet(spark, str(where / n)) for n in tables])


REPORTS = {
    "portfolio_kpis": (lambda b: insights.portfolio_kpis(b, unique=True), 1),
    "default_split": (insights.default_split, 1),
    "target_correlation": (insights.target_correlation, 3),
    "profile_distribution": (lambda b: insights.profile_distribution(b, unique=True), 2),
    "segment_lift": (lambda b: insights.segment_lift(b, 1, unique=True), 2),
    "dti_lift": (insights.dti_lift, 3),
    "behavior_segments": (lambda b: insights.behavior_segments(b, 1, unique=True), 3),
}


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_reports_read_only_the_tables_they_show(star, name):
    report, most = REPORTS[name]
    narrow = report(star.base(insights.REPORT_COLUMNS[name]))
    assert executed(narrow).count("FileScan") <= most
    assert sorted(map(str, narrow.collect())) == sorted(map(str, report(star.base()).collect()))


def test_reports_shuffle_no_client_above_the_joins(spark, star):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for threshold in ("10MB", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            for name, (report, _) in REPORTS.items():
                plan = executed(report(star.base(insights.REPORT_COLUMNS[name])))
                joins = [i for i, line in enumerate(plan.splitlines()) if "Join" in line]
                clients = [i for i, line in enumerate(plan.splitlines()) if "hashpartitioning(sk_id_curr" in line]
                # The plan is printed from the result down: what lies above the joins comes first.
                assert not clients or joins and min(clients) > min(joins), (name, plan)
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_client_with_two_applications_is_refused(spark, inputs):
    twice = inputs.applications.unionByName(inputs.applications)
    with pytest.raises(ValueError, match="sk_id_curr is not unique"):
        insights.portfolio(twice, inputs.internal, inputs.external, inputs.rule_rows)
