"""The command-line steps of two runs, in order, on the reference dataset."""

import json
from pathlib import Path

import pytest

from gaugeframe import jobs
from gaugeframe.operators import profile
from gaugeframe.sources import marts


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("jobs")
    raw, stage, store = f"{base}/raw", f"{base}/stage", f"{base}/marts"

    def step(name, *more):
        args = jobs.arguments().parse_args(
            [name, "--raw", raw, "--stage", stage, "--marts", store, *more])
        jobs.run_step(spark, args)

    step("generate")
    step("ingest")
    with pytest.raises(Exception, match="already exists"):
        step("ingest")
    step("ingest", "--force")
    for run, when in (("001", "2026-01-01T00:00:00+00:00"), ("002", "2026-01-02T00:00:00+00:00")):
        step("validate", "--run-id", run, "--run-ts", when)
        step("score", "--run-id", run)
    step("validate", "--run-id", "002", "--run-ts", "2026-01-02T00:00:00+00:00")
    step("profile", "--run-id", "002")
    step("gate", "--run-id", "002")
    step("lifecycle")
    step("metrics", "--run-id", "002")
    step("metrics", "--run-id", "002", "--workflow-attempt", "2")
    step("metrics", "--run-id", "002", "--workflow-attempt", "2")
    return base, store, step


def test_marts(spark, folders):
    _, store, _ = folders
    checks = marts.read_mart(spark, f"{store}/dq_check_results")
    assert {r.run_id: r["count"] for r in checks.groupBy("run_id").count().collect()} == {"001": 27, "002": 27}
    # Validating run 002 again has replaced its issues, not added to them.
    issues = marts.read_mart(spark, f"{store}/dq_issue_history")
    assert issues.where("run_id = '002'").count() == 5 and issues.count() == 10
    lifecycle = spark.read.parquet(f"{store}/dq_issue_lifecycle")
    assert {(r.status, r.occurrence_count) for r in lifecycle.collect()} == {("open", 2)}
    scores = marts.read_run(spark, f"{store}/score_history", "001").first()
    assert round(scores.score, 2) == 98.22 and scores.failed_checks == 5
    assert json.loads(scores.subscores)["consistency"] == 100.0
    assert str(scores.run_ts).startswith("2026-01-01T00:00:00")
    history = marts.read_mart(spark, f"{store}/dq_run_history")
    assert json.loads(history.first().total_rows_by_table) == {
        "districts": 5, "users": 8, "resources": 6, "events": 6, "newsletter": 4}
    assert marts.read_mart(spark, f"{store}/dq_metrics_history").count() == 2
    top = marts.read_run(spark, f"{store}/profiles/table_summaries", "002")
    assert top.count() == 5


def test_marts_have_their_declared_schemas(spark, folders):
    _, store, _ = folders
    for name in marts.SCHEMAS:
        declared = {f.name: f.dataType for f in marts.read_mart(spark, f"{store}/{name}").schema}
        if any((store_part := Path(store) / name).glob("run_id=*")):
            written = spark.read.parquet(str(store_part)).drop("run_id").schema
            assert {f.name: f.dataType for f in written} == {k: v for k, v in declared.items() if k != "run_id"}, name
    assert marts.read_mart(spark, f"{store}/nowhere/dq_anomalies").count() == 0


def test_project_metrics_keep_one_row_per_attempt(spark, folders):
    _, store, _ = folders
    rows = marts.read_mart(spark, f"{store}/project_metrics_history").collect()
    assert sorted(r.workflow_attempt for r in rows) == ["2", "local"]
    row = rows[0]
    assert (row.quality_gate_status, row.passed_checks, row.warning_checks, row.failed_checks) == ("pass", 21, 1, 5)
    assert (row.recurring_issue_count, row.new_issue_count, row.check_pass_rate) == (5, 0, 0.7778)


def test_compare_and_failing_gate(spark, folders, capsys):
    base, store, step = folders
    with pytest.raises(SystemExit, match="run id is required"):
        jobs.run_step(spark, jobs.arguments().parse_args(["score", "--marts", str(base)]))
    expected = {"score": 98.22, "failed_checks": 5, "issue_counts": {"duplicate": 3, "missing": 2},
                "subscores": {"uniqueness": 94.41}}
    path = base / "baseline.json"
    path.write_text(json.dumps(expected, indent=2))
    step("compare", "--run-id", "001", "--baseline", str(path))
    step("metrics", "--run-id", "002", "--baseline", str(path), "--workflow-attempt", "3")
    rows = marts.read_run(spark, f"{store}/project_metrics_history", "002").collect()
    assert len(rows) == 3
    path.write_text(json.dumps({**expected, "score": 90.0}))
    with pytest.raises(SystemExit):
        step("compare", "--run-id", "001", "--baseline", str(path))
    gate = base / "gate.yml"
    gate.write_text("score_threshold: 99.5\n")
    with pytest.raises(SystemExit):
        step("gate", "--run-id", "001", "--gate", str(gate))
    assert "below threshold 99.50" in capsys.readouterr().out


def test_missing_extra_and_drifted_tables(spark, folders, tmp_path):
    """Tables are what the stage holds, and the expected schema is the configured one."""
    base, _, step = folders
    schema = tmp_path / "schema.yml"
    schema.write_text("""
tables:
  users: {columns: {user_id: {type: uuid}, nick: string}}
  payments: {columns: {payment_id: uuid}}
""")
    rules = tmp_path / "rules.yml"
    rules.write_text("""
checks:
  completeness:
    - {id: note, table: extra, column: note, rule: NULL_PERCENTAGE}
    - {id: counts, table: "*", rule: NON_NEGATIVE_COUNTS, column_regex: "count"}
""")
    stage, marts_ = str(tmp_path / "stage"), str(tmp_path / "marts")
    spark.createDataFrame([(1,)], "user_id int").write.parquet(f"{stage}/users")
    spark.createDataFrame([("x", "n", 3), (None, "m", -2)], "note string, count_text string, n_count int").write.parquet(f"{stage}/extra")

    def validate(*more):
        args = jobs.arguments().parse_args(
            ["validate", "--stage", stage, "--marts", marts_, "--run-id", "9", "--run-ts", "2026-01-01T00:00:00", *more])
        jobs.run_step(spark, args)

    def rows(name):
        return marts.read_run(spark, f"{marts_}/{name}", "9").collect()

    validate("--expected-schema", str(schema), "--rules", str(rules))
    drift = {r.table_name: r for r in rows("dq_schema_drift")}
    assert drift["payments"].notes == "Expected staging table was not created."
    assert drift["extra"].notes == "Unexpected staging table appeared."
    assert json.loads(drift["extra"].new_columns) == ["count_text", "n_count", "note"]
    assert json.loads(drift["users"].missing_columns) == ["nick"]
    assert json.loads(drift["users"].type_changes) == [
        {"column": "user_id", "expected": "varchar", "actual": "integer"}]
    assert [(r.check_id, r.table_name, r.column_name, r.type) for r in rows("dq_skipped_columns")] == [
        ("counts", "extra", "count_text", "string")]
    assert {r.check_name: r.affected_rows for r in rows("dq_issue_history")} == {"note": 1, "counts": 1}
    assert {r.check_id: r.success for r in rows("dq_expectation_results")} == {"note": False, "counts": False}
    assert rows("dq_expectation_statistics")[0].success_percent == 0.0
    assert sum(r.rules for r in rows("dq_rule_summary") if r.grouping == "table_name") == 2
    assert json.loads(rows("dq_run_history")[0].total_rows_by_table) == {"extra": 2, "users": 1}
    # The built-in rules need tables that are not there: the drift is on record all the same.
    with pytest.raises(ValueError, match="Missing staging table"):
        validate()
    assert "newsletter" in {r.table_name for r in rows("dq_schema_drift")}


def test_a_clean_run_closes_issues(spark, folders):
    _, store, step = folders
    clean = spark.createDataFrame([("003", "2026-01-03T00:00:00+00:00", "phase1", "{}")],
                                  "run_id string, run_ts string, dataset_name string, total_rows_by_table string")
    marts.write_run(clean, f"{store}/dq_run_history")
    step("lifecycle", "--close-issues")
    assert {r.status for r in spark.read.parquet(f"{store}/dq_issue_lifecycle").collect()} == {"not_seen_in_latest_run"}
    step("lifecycle")
    assert {r.status for r in spark.read.parquet(f"{store}/dq_issue_lifecycle").collect()} == {"open"}


def test_profile_keeps_counts_and_sketches(spark, folders):
    _, store, step = folders
    step("profile", "--run-id", "001", "--sketches")
    assert spark.read.parquet(f"{store}/profiles/value_counts/users/001").agg({"_n": "sum"}).first()[0] == 8 * 6
    kept = marts.read_mart(spark, f"{store}/profiles/distinct_sketches/users")
    exact = {r.column_name: r.distinct_count for r in marts.read_run(spark, f"{store}/profiles/column_profiles", "001")
             .where("table_name = 'users'").collect()}
    found = {r.column_name: r.distinct_estimate for r in profile.distinct_estimates(kept).collect()}
    assert found == exact
