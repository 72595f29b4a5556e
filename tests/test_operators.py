"""Bands, keys, attach and fingerprints."""

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from creditloom import vocab
from creditloom.operators.attach import attach, hot_keys
from creditloom.operators.bands import band_join, band_label, check_rules
from creditloom.operators.fingerprint import content_fingerprint, content_metrics, observed_fingerprint
from creditloom.operators.keys import dense_key
from creditloom.sources import rules
from creditloom.sources.storage import publish

EDGES = [None, -1.0, 0.0, 24.999, 25.0, 34.9999999, 35.0, 65.0, 1e12, float("nan")]
LABELS = ["Unknown", "<25", "<25", "<25", "25-34", "25-34", "35-44", "65+", "65+", "65+"]


def test_band_edges_by_expression_and_by_join(spark):
    df = spark.createDataFrame(list(enumerate(EDGES)), "i int, age_years double")
    by_label = df.select("i", band_label("age_years", rules.default_band_rows(), "age_band").alias("b"))
    by_join = band_join(df, rules.default_band_rules(spark), "age_band", "age_years", "b")
    assert [r.b for r in by_label.orderBy("i").collect()] == LABELS
    assert [r.b for r in by_join.orderBy("i").collect()] == LABELS


def test_every_value_has_one_band(inputs):
    t = inputs
    for group, column in {(r.band_group, r.source_column) for r in t.rule_rows}:
        joined = band_join(t.applications.select("sk_id_curr", column), t.band_rules, group, column, "b")
        assert joined.count() == t.applications.count()
        assert joined.where("b IS NULL").count() == 0


def test_overlapping_bands_are_refused():
    row = Row("band_group", "lower_bound", "upper_bound", "is_null_band")
    with pytest.raises(ValueError, match="overlapping"):
        check_rules([row("g", None, 5.0, False), row("g", 4.0, None, False)])


def test_rules_from_file_equal_the_built_in_ones(spark, tmp_path):
    path = str(tmp_path / "bands")
    rules.default_band_rules(spark).coalesce(1).write.csv(path, header=True)
    loaded = {tuple(r) for r in rules.load_band_rules(spark, path).collect()}
    assert loaded == {tuple(r) for r in rules.default_band_rules(spark).collect()}
    assert len(loaded) == 32


def test_dense_key_is_gapless_and_ordered(spark):
    # Keys of either sign, close together and far apart, over several fine and coarse ranges
    keys = sorted({*range(-70_000, 70_000, 7), *(k * 2**33 for k in range(-300, 300)), *(k * 2**55 + 5 for k in range(-250, 250)), 2**63 - 1})
    df = spark.createDataFrame([(k, str(k)) for k in keys], "k long, v string").repartition(7)
    keyed = dense_key(df, "k", "n").orderBy("k").collect()
    assert [(r.k, r.v, r.n) for r in keyed] == [(k, str(k), i) for i, k in enumerate(keys, 1)]


def test_dense_key_on_empty_null_and_repeated_keys(spark):
    assert dense_key(spark.createDataFrame([], "k long"), "k", "n").count() == 0
    nulls = spark.createDataFrame([(None,), (3,), (None,), (-3,)], "k int")
    assert sorted(map(tuple, dense_key(nulls, "k", "n").collect()), key=str) == [(-3, 1), (3, 2), (None, None), (None, None)]
    with pytest.raises(Exception, match="k is not unique: 4"):
        dense_key(spark.createDataFrame([(4,), (4,), (5,)], "k long"), "k", "n").collect()
    with pytest.raises(TypeError, match="integral"):
        dense_key(spark.createDataFrame([("a",)], "k string"), "k", "n")


def test_dense_key_takes_no_job_while_planning_and_no_shuffle_of_wide_rows(spark):
    spark.sparkContext.setJobGroup("planning", "dense key")
    try:
        keyed = dense_key(spark.range(1000).selectExpr("id AS k", "uuid() AS v"), "k", "n")
        plan = keyed._jdf.queryExecution().executedPlan().toString()
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    single = [line for line in plan.splitlines() if "SinglePartition" in line]
    # One window runs in one task: over the counts of the coarse ranges.
    assert len(single) == 1 and "__coarse" in plan
    assert not [line for line in plan.splitlines() if "Exchange" in line and "rangepartitioning" in line]


def test_attach_keeps_rows_and_marks_missing(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k long, v string")
    right = spark.createDataFrame([(1, 10), (3, 30)], "k long, s long")
    for frequent in ([], [1], [1, 2]):
        joined = attach(left, right, "k", "absent", hot_keys=frequent, salts=4)
        assert sorted(map(tuple, joined.select("v", "s", "absent").collect())) == [
            ("a", 10, False), ("b", 10, False), ("c", None, True), ("d", None, True),
        ]


def test_hot_keys_are_found_and_bounded(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
    assert hot_keys(df, "k", share=0.1) == [7]


def test_content_fingerprint_ignores_order_and_sees_changes(spark):
    base = [(1, 1.0, None), (2, 0.0, "x"), (2, 0.0, "x"), (3, None, "y")]

    def mark(values):
        df = spark.createDataFrame(values, "a long, b double, c string").repartition(3)
        return content_fingerprint(df).first().table_fingerprint

    reference = mark(base)
    assert mark(base[::-1]) == reference
    assert mark([(1, 1.0, None), (2, -0.0, "x"), (2, 0.0, "x"), (3, None, "y")]) == reference
    assert mark(base[:2] + base[3:]) != reference
    assert mark([(1, None, "1.0")] + base[1:]) != reference
    assert mark(base + [(9, 9.0, "p"), (9, 9.0, "p")]) != reference


def test_fingerprint_observed_while_writing_is_the_same(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "id / 7 AS x", "if(id % 3 = 0, NULL, string(id)) AS t")
    path, facts = publish(df, str(tmp_path), "gold", "t", "run", content_metrics(df))
    stored = spark.read.parquet(path)
    expected = content_fingerprint(stored, "d", "s").first()
    assert facts["row_count"] == expected.row_count == 1000
    assert observed_fingerprint(facts, df.schema, "d", "s") == expected.table_fingerprint


def test_schema_has_the_documented_size():
    columns = rules.default_column_rules()
    assert len(columns.types) == 339
    assert sum(not n for n in columns.nullable.values()) == 13
    assert len(vocab.INPUT_SCHEMA["application_train.csv"]["BOOLEAN"]) == 36
