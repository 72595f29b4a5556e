"""Event log and layer refresh."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from creditloom.operators.events import (
    latest_event, latest_file_event, refresh_decision, reuse_valid_result, run_counters,
)
from creditloom.plans import refresh
from creditloom.plans.refresh import Table
from creditloom.sources import adapter, storage
from creditloom.sources.events import (
    append_events, compact_events, event_row, live_events, parse_utc, read_events,
)

T0 = datetime(2024, 1, 1, 10)


def event(seq, status="success", entity="t", **more):
    return {
        "run_id": "r", "seq": seq, "event_ts_utc": T0, "layer": "silver", "entity_type": "table",
        "entity_name": entity, "status": status, "process_version": "v1", **more,
    }


def test_events_are_appended_and_ties_go_to_the_later_one(spark, tmp_path):
    where = str(tmp_path)
    assert read_events(spark, where).count() == 0
    append_events(spark, where, [event(1, row_count=10), event(2, row_count=20)])
    append_events(spark, where, [event(3, status="failed", row_count=30, details={"a": [1]})])
    log = read_events(spark, where)
    assert log.count() == 3
    assert log.where("seq = 3").first().details_json == '{"a": [1]}'
    assert str(log.first().event_date) == "2024-01-01"
    newest = latest_event(log).collect()
    assert [(r.entity_name, r.row_count) for r in newest] == [("t", 20)]
    assert run_counters(log).first().asDict() == {
        "run_id": "r", "table_count_selected": 3, "table_count_succeeded": 2, "table_count_failed": 1,
        "table_count_skipped": 0, "run_status": "partial_failure",
    }


def test_event_fields(spark):
    assert parse_utc("2024-01-01T10:00:00Z") == T0
    with pytest.raises(ValueError, match="unknown event fields"):
        event_row({"event_ts_utc": T0, "colour": "red"})


def test_refresh_decision_reasons(spark):
    def table(**change):
        row = dict(layer="l", process_version="v", definition_fingerprint="d", source_fingerprint="s", schema_text="x")
        return {**row, **change}

    known = spark.createDataFrame([table(entity_name=n) for n in "abcde"])
    desired = spark.createDataFrame(
        [
            table(entity_name="a", output_exists=True),
            table(entity_name="b", output_exists=False),
            table(entity_name="c", output_exists=True, definition_fingerprint="d2"),
            table(entity_name="d", output_exists=True, source_fingerprint="s2"),
            table(entity_name="e", output_exists=True, process_version="v2"),
            table(entity_name="f", output_exists=True),
        ]
    )
    found = {r.entity_name: (r.is_fresh, r.reason) for r in refresh_decision(desired, known).collect()}
    assert found == {
        "a": (True, None), "b": (False, "output_missing"), "c": (False, "definition_fingerprint_changed"),
        "d": (False, "source_fingerprint_changed"), "e": (False, "process_version_changed"),
        "f": (False, "never_built"),
    }


def test_only_valid_results_of_the_same_file_are_reused(spark):
    log = spark.createDataFrame(
        [("f", "p1", "v1", "valid", 1, 10), ("f", "p1", "v1", "valid", 2, 20), ("f", "p1", "v1", "invalid", 3, 30),
         ("g", "p2", "v0", "valid", 1, 5)],
        "entity_name string, file_fingerprint string, process_version string, status string, seq long, row_count long",
    ).withColumn("event_ts_utc", F.lit(T0))
    current = spark.createDataFrame(
        [("f", "p1", "v1"), ("g", "p2", "v1"), ("h", "p3", "v1")],
        "entity_name string, file_fingerprint string, process_version string",
    )
    found = {r.entity_name: (r.can_reuse, r.row_count) for r in reuse_valid_result(current, log).collect()}
    assert found == {"f": (True, 20), "g": (False, None), "h": (False, None)}


def test_all_layers_from_bronze(spark, inputs, tmp_path):
    views = [n for n in adapter.VIEWS if n not in ("applications", "event_log")]
    bronze = {"application_train": inputs.train, "application_test": inputs.test}
    sources = refresh.bronze_sources({**bronze, **{n: inputs.view(n) for n in views}})
    marks = {name: name for name in sources}
    reports = refresh.build_layers(spark, str(tmp_path), sources, source_fingerprints=marks)
    assert {r["status"] for r in reports} == {"success"}, [r for r in reports if r["status"] != "success"]
    assert len(reports) == 18
    tables = refresh.published_tables(spark, str(tmp_path))
    assert len(tables["gold.credit_risk_feature_store"].columns) == 159
    assert tables["gold.fact_credit_risk"].count() == inputs.train.count()
    assert tables["silver.applications"].count() == inputs.applications.count()
    assert tables["gold.ref_band_rules"].count() == 32


def small_layers(factor=2, broken=False):
    def double(df):
        if broken:
            raise RuntimeError("no")
        return df.select((F.col("x") * factor).alias("x"))

    return [
        Table("silver", "doubled", ("bronze.base",), double, extra=str(factor)),
        Table("gold", "total", ("silver.doubled",), lambda d: d.agg(F.sum("x").alias("total"))),
        Table("gold", "rows", ("bronze.base",), lambda d: d.agg(F.count("*").alias("n"))),
    ]


def run(spark, where, df, **options):
    reports = refresh.build_layers(
        spark, where, {"bronze.base": df}, tables=small_layers(**options)
    )
    return {f"{r['layer']}.{r['entity_name']}": r["status"] for r in reports}


def test_refresh_reuses_rebuilds_and_isolates_failures(spark, tmp_path):
    where = str(tmp_path)
    df = spark.range(5).toDF("x")
    built = {"silver.doubled": "success", "gold.total": "success", "gold.rows": "success"}
    reused = {k: "skipped_cached_transformation" for k in built}
    assert run(spark, where, df) == built
    assert run(spark, where, df.repartition(3)) == reused
    assert refresh.published_tables(spark, where)["gold.total"].first().total == 20

    # A changed definition refreshes the table and its readers only.
    assert run(spark, where, df, factor=3) == {**built, "gold.rows": reused["gold.rows"]}
    assert refresh.published_tables(spark, where)["gold.total"].first().total == 30
    # Changed input data refreshes everything.
    assert run(spark, where, spark.range(6).toDF("x"), factor=3) == built

    # A failure stays with its table and its readers; the published versions stay in force.
    assert run(spark, where, df, broken=True, factor=4) == {
        "silver.doubled": "failed", "gold.total": "skipped_upstream_failed", "gold.rows": "success",
    }
    assert refresh.published_tables(spark, where)["gold.total"].first().total == 45
    last_run = read_events(spark, where).where("entity_type = 'run'").orderBy(F.desc("event_ts_utc")).first()
    assert last_run.status == "partial_failure"

    assert refresh.register_gold_views(spark, where) == ["rows", "total"]
    assert spark.sql("SELECT total FROM total WHERE total = :t", {"t": 45}).count() == 1


def test_missing_output_is_rebuilt(spark, tmp_path):
    where, df = str(tmp_path), spark.range(3).toDF("x")
    run(spark, where, df)
    path = refresh.published_paths(spark, where)["gold.rows"]
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
    again = run(spark, where, df)
    assert again["gold.rows"] == "success" and again["gold.total"] == "skipped_cached_transformation"


def test_selected_tables_read_published_inputs(spark, tmp_path):
    where, df = str(tmp_path), spark.range(3).toDF("x")
    run(spark, where, df)
    reports = refresh.build_layers(spark, where, {}, selected={"gold.total"}, tables=small_layers())
    assert [(r["entity_name"], r["status"]) for r in reports] == [("total", "skipped_cached_transformation")]


def test_checkpoint_folder_comes_from_the_session(spark):
    folder = storage.shared_dir(spark)
    assert folder == spark.sparkContext.getCheckpointDir() or folder == spark.conf.get("spark.checkpoint.dir")
    assert storage.scratch_path(spark, "a") != storage.scratch_path(spark, "a")


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    a = spark.range(2000).selectExpr("id AS k", "id % 7 AS v")
    b = spark.range(0, 2000, 2).selectExpr("id AS k", "id AS w")
    left = storage.publish_bucketed(a, "bucket_a", str(tmp_path / "a"), 4, "k")
    right = storage.publish_bucketed(b, "bucket_b", str(tmp_path / "b"), 4, "k")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = left.join(right, "k", "left").groupBy("k").agg(F.sum("w"))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        assert joined.count() == 2000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE bucket_a")
        spark.sql("DROP TABLE bucket_b")


def test_a_snapshot_answers_like_the_whole_log(spark, tmp_path):
    where, day = str(tmp_path), datetime(2024, 1, 1, 10)
    for n in range(6):
        append_events(spark, where, [
            {**event(n, row_count=n, entity=e, status=s), "event_ts_utc": day.replace(day=1 + n)}
            for e, s in (("t", "success"), ("u", "failed" if n > 1 else "success"))
        ] + [
            {"run_id": "r", "seq": n, "event_ts_utc": day.replace(day=1 + n), "layer": "raw", "entity_type": "file",
             "entity_name": "f", "status": "valid" if n != 3 else "invalid", "file_fingerprint": str(n % 2),
             "process_version": "v1", "row_count": n}
        ])
    current = spark.createDataFrame(
        [("f", "0", "v1"), ("f", "1", "v1"), ("f", "2", "v1")],
        "entity_name string, file_fingerprint string, process_version string",
    )

    def answers(log):
        files = log.where("layer = 'raw'")
        tables = sorted(map(str, latest_event(log).collect()))
        return tables, sorted(map(str, latest_file_event(files).collect())), sorted(
            map(str, reuse_valid_result(current, files).collect())
        )

    whole = answers(read_events(spark, where))
    for before in (2, 5):
        compact_events(spark, where, datetime(2024, 1, before).date())
        assert answers(live_events(spark, where)) == whole
    # Two tables (latest and last success) and a file (latest, and valid ones by fingerprint)
    snapshot = spark.read.parquet(f"{where}/metadata/event_snapshots/before=2024-01-05")
    assert snapshot.count() == 6 and read_events(spark, where).count() == 18
    assert live_events(spark, where).count() == 6 + 6
