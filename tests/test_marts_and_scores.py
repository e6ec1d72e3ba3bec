import pytest
from pyspark.sql import functions as F

from gaugeframe import defaults
from gaugeframe.config import GateSettings
from gaugeframe.operators import drift, gate, history, outcomes, scoring
from gaugeframe.session import local_frame
from gaugeframe.sources import exports, marts, synthetic


def scored(spark, rows):
    return local_frame(spark, rows, "dimension string, penalty double, weight double")


def test_scores(spark):
    checks = scored(spark, [("completeness", 0.0, 1.0), ("completeness", 0.25, 1.0), ("integrity", 0.0, 2.0)])
    assert scoring.overall_score(checks).first().score == 93.75
    by = {r.dimension: r.score for r in scoring.dimension_scores(checks).collect()}
    assert by == {"completeness": 87.5, "integrity": 100.0}
    best = scoring.ranked_dimension_scores(scoring.dimension_scores(checks)).first()
    assert best.dimension == "integrity"
    assert scoring.overall_score(scored(spark, [])).first().score == 100.0
    assert scoring.overall_score(scored(spark, [("d", 1.0, 0.0)])).first().score == 100.0
    assert scoring.overall_score(scored(spark, [("d", 9.0, 1.0)]), minimum=5.0).first().score == 5.0


CHECK = "check_id string, table_name string, status string, failure_rate double, severity int, dimension string"


def test_check_summary_order_and_defaults(spark):
    checks = local_frame(
        spark, [("p", "users", "pass", 0.0, 2, "c"), ("f", "events", "fail", 0.2, 5, "i"),
                ("w", "x", "warn", None, None, "c"), ("g", "y", "fail", 0.3, 1, "c")], CHECK)
    full = checks.withColumns({c: F.lit(None).cast("double") for c in (
        "threshold_warning", "threshold_fail", "weight", "penalty")}).withColumn("description", F.lit("d"))
    rows = scoring.check_summary(full).collect()
    assert [r.check_id for r in rows] == ["g", "f", "p", "w"]
    assert rows[3].severity == 0 and rows[3].failure_rate == 0.0 and rows[0].weight == 0.0


ISSUE = ("run_id string, run_ts string, dataset_name string, table_name string, check_name string, "
         "dimension string, issue_type string, severity int, affected_pct double, "
         "probable_root_cause string, recommended_fix string")
HISTORY = [
    ("run-1", "2026-01-01T00:00:00+00:00", "d", "users", "email_unique", "uniqueness", "duplicate", 4, 0.2, "Duplicate import", "Dedupe"),
    ("run-2", "2026-01-02T00:00:00+00:00", "d", "users", "email_unique", "uniqueness", "duplicate", 4, 0.1, None, "Dedupe more"),
    ("run-1", "2026-01-01T00:00:00+00:00", "d", "events", "events_user_fk", "integrity", "fk", 5, 0.3, "Missing users", "Load"),
]


def test_lifecycle(spark):
    issues = local_frame(spark, HISTORY, ISSUE)
    rows = {r.issue_key: r for r in history.issue_lifecycle(issues).collect()}
    email, fk = rows["users|email_unique|duplicate"], rows["events|events_user_fk|fk"]
    assert (email.status, email.occurrence_count, email.first_seen_run_id, email.last_seen_run_id) == (
        "open", 2, "run-1", "run-2")
    assert abs(email.median_affected_pct - 0.15) < 1e-12 and email.max_affected_pct == 0.2
    assert (email.probable_root_cause, email.recommended_fix) == ("Duplicate import", "Dedupe more")
    assert fk.status == "not_seen_in_latest_run"
    counts = history.lifecycle_counts(history.issue_lifecycle(issues)).first()
    assert tuple(counts) == (1, 0, 1, 1)
    # A later, clean run closes everything when the run history decides.
    runs = local_frame(spark, [("run-3", "2026-01-03T00:00:00Z")], "run_id string, run_ts string")
    assert {r.status for r in history.issue_lifecycle(issues, runs).collect()} == {"not_seen_in_latest_run"}


def test_lifecycle_with_missing_columns_and_bad_times(spark):
    slim = local_frame(spark, [("u", "c", "bad"), ("u", "c", "2026-01-01")], "table_name string, check_name string, run_ts string")
    row = history.issue_lifecycle(slim).first()
    assert row.issue_key == "u|c|" and row.occurrence_count == 2 and row.severity == 0
    assert history.issue_lifecycle(slim.where("run_ts = 'bad'")).count() == 0


def test_recurrence_totals_and_trend(spark):
    issues = local_frame(spark, [*HISTORY, ("run-2", None, "d", "t", "c", "x", None, 1, 0.5, "p", "f")], ISSUE)
    top = history.recurrence(issues, limit=1).collect()
    assert [(r.check_name, r.occurrences, r.probable_root_cause) for r in top] == [
        ("email_unique", 2, "Duplicate import")]
    assert history.recurrence(issues).count() == 2
    assert history.recurring_count(history.recurrence(issues)).first()[0] == 1
    totals = [tuple(r) for r in history.issue_totals(issues).collect()]
    assert totals == [("duplicate", 2, 1), ("Unknown", 1, 2), ("fk", 1, 3)]
    matrix = [tuple(r) for r in history.trend_matrix(issues, types=2).collect()]
    assert [(r[0], str(r[1])[:10], r[2], r[3], r[4]) for r in matrix] == [
        ("run-2", "1970-01-01", 1, "duplicate", 0), ("run-2", "1970-01-01", 2, "Unknown", 1),
        ("run-1", "2026-01-01", 1, "duplicate", 1), ("run-1", "2026-01-01", 2, "Unknown", 0),
        ("run-2", "2026-01-02", 1, "duplicate", 1), ("run-2", "2026-01-02", 2, "Unknown", 0)]


def test_score_trend_preview_counts(spark):
    scores = local_frame(spark, [("a", "2024-01-01", "d", 90.0), ("b", "2024-01-02", "d", 95.0), ("c", "2024-01-02", "e", 1.0)],
                         "run_id string, run_ts string, dataset_name string, score double")
    assert {r.run_id: r.score_change for r in history.score_trend(scores).collect()} == {"a": None, "b": 5.0, "c": None}
    issues = local_frame(spark, HISTORY, ISSUE)
    preview = scoring.issue_preview(issues, 2).collect()
    assert [r.check_name for r in preview] == ["events_user_fk", "email_unique"]
    assert preview[1].probable_root_cause == "Duplicate import"
    assert {tuple(r) for r in scoring.issue_counts(issues).collect()} == {("duplicate", 2), ("fk", 1)}


def test_run_time_fallbacks(spark):
    runs = local_frame(spark, [("run-1", "2024-01-01T00:00:00Z", "d"), ("run-1", "2024-01-02T00:00:00Z", "d")],
                       "run_id string, run_ts string, dataset_name string")
    issues = local_frame(spark, HISTORY, ISSUE)
    assert str(scoring.resolve_run_ts(runs, issues, "run-1").first()[0]) == "2024-01-02 00:00:00"
    assert str(scoring.resolve_run_ts(runs, issues, "run-2").first()[0]) == "2026-01-02 00:00:00"
    assert scoring.resolve_run_ts(runs, issues, "none").first()[0] is not None
    assert tuple(scoring.last_run(runs, "none").first()) == (None, None)


def test_gate(spark):
    checks = local_frame(spark, [("b", "t", "fail", 0.2, 5, "i"), ("a", "t", "fail", 0.2, 5, "i"), ("c", "t", "fail", 0.1, 4, "i")], CHECK)
    score = local_frame(spark, [(95.004,)], "score double")
    settings = GateSettings(95.0, 5.0)
    verdict = gate.gate_verdict(score, checks, settings).first()
    assert not verdict.passed and verdict.critical_checks == ["a (t)", "b (t)"]
    assert "a (t), b (t)" in verdict.reason and verdict.score == 95.0
    assert gate.gate_verdict(score, checks.where("severity < 5"), settings).first().passed
    low = gate.gate_verdict(score, checks, GateSettings(96.0, 5.0)).first()
    assert low.reason == "overall score 95.00 is below threshold 96.00"
    assert gate.critical_failures(checks, settings).first()[0] == 2


def test_root_cause_coverage_and_maxima(spark):
    issues = local_frame(spark, [("Bad import", "Reload", "4", "0.5"), ("Missing map", " ", "x", None)],
                         "probable_root_cause string, recommended_fix string, severity string, affected_pct string")
    row = gate.issue_measures(issues).first()
    assert (row.total_issues, row.max_severity, row.max_affected_pct, row.issue_root_cause_coverage_pct) == (2, 4, 0.5, 0.5)
    none = gate.issue_measures(issues.limit(0)).first()
    assert (none.max_severity, none.max_affected_pct, none.issue_root_cause_coverage_pct) == (0, 0.0, 1.0)


def test_rule_summary(spark):
    frame = outcomes.rules_frame(spark, defaults.RULES)
    rows = {(r.grouping, r.value): r.rules for r in gate.rule_summary(frame).collect()}
    assert rows[("dimension", "completeness")] == 6 and rows[("table_name", "users")] == 10
    assert rows[("rule_type", "FK")] == 3 and rows[("severity", "5")] == 4
    totals = gate.rule_totals(frame).first()
    assert (totals.total_rules, totals.total_weight, totals.documentation_coverage_pct) == (27, 30.0, 1.0)


def test_expectations_and_exceptions(spark):
    checks = local_frame(spark, [("a", 0, 0.0), ("b", 2, 0.5)], "check_id string, failure_count bigint, failure_rate double")
    row = outcomes.expectation_statistics(checks).first()
    assert tuple(row) == (2, 1, 1, 50.0, False)
    assert outcomes.expectation_statistics(checks.limit(0)).first().success_percent == 100.0
    issues = local_frame(spark, HISTORY, ISSUE)
    assert outcomes.exceptions(issues).columns == [
        "check_name", "table_name", "dimension", "issue_type", "severity", "affected_pct",
        "probable_root_cause", "recommended_fix"]


def test_marts_replace_only_their_run(spark, tmp_path):
    path = str(tmp_path / "mart")
    one = local_frame(spark, [("007", 1), ("007", 2), ("8", 3)], "run_id string, n int")
    marts.write_run(one, path)
    marts.write_run(local_frame(spark, [("007", 9)], "run_id string, n int"), path)
    marts.write_run(one.limit(0), path)
    assert {(r.run_id, r.n) for r in marts.read_mart(spark, path).collect()} == {("007", 9), ("8", 3)}
    run = marts.read_run(spark, path, "007")
    assert [r.n for r in run.collect()] == [9]
    assert "PartitionFilters: [isnotnull(run_id" in run._jdf.queryExecution().toString()


def test_upsert_history(spark):
    old = local_frame(spark, [("r", "w", "1", "t1", 1), ("r", "w", "2", "t1", 2)],
                      "run_id string, workflow_run_id string, workflow_attempt string, generated_at string, a int")
    new = local_frame(spark, [("r", "w", "1", "t0", 5)],
                      "run_id string, workflow_run_id string, workflow_attempt string, generated_at string, b int")
    rows = {r.workflow_attempt: (r.a, r.b) for r in marts.upsert_history(old, new).collect()}
    assert rows == {"1": (None, 5), "2": (2, None)}


def test_exports_round_trip(spark, tmp_path):
    rows = [("1", 'say "hi", you'), ("2", None)]
    df = local_frame(spark, rows, "a string, b string")
    exports.write_csv(df, str(tmp_path / "x.csv"))
    assert {tuple(r) for r in exports.read_export(spark, str(tmp_path / "x.csv"), ["a", "b"]).collect()} == set(rows)
    assert exports.read_export(spark, str(tmp_path / "x.csv"), ["b"]).columns == ["b"]
    broken = local_frame(spark, [("1", "two\nlines")], "a string, b string")
    exports.write_csv(broken, str(tmp_path / "m.csv"))
    assert exports.read_export(spark, str(tmp_path / "m.csv"), ["b"], multi_line=True).first().b == "two\nlines"
    exports.write_csv(df.limit(0), str(tmp_path / "empty.csv"))
    parts = list((tmp_path / "empty.csv").glob("*.csv"))
    assert [p.read_text().strip() for p in parts] == ["a,b"]
    exports.write_staged(df, str(tmp_path / "t"))
    try:
        exports.write_staged(df, str(tmp_path / "t"))
        raise AssertionError("an existing target must be refused")
    except Exception as refused:
        assert "already exists" in str(refused)
    exports.write_staged(df, str(tmp_path / "t"), force=True)


def test_name_uuid_and_copies(spark):
    import uuid

    df = local_frame(spark, [("phase1-42-user-é",), ("x",)], "k string")
    got = [r[0] for r in df.select(synthetic.name_uuid(F.col("k"))).collect()]
    space = uuid.UUID(synthetic.NAMESPACE)
    assert got == [str(uuid.uuid5(space, "phase1-42-user-é")), str(uuid.uuid5(space, "x"))]
    raw = synthetic.generate(spark, "phase1", 42, copies=3)
    assert {n: df.count() for n, df in raw.items()} == {
        "districts": 15, "users": 24, "resources": 18, "events": 18, "newsletter": 12}
    users = raw["users"]
    assert users.select("user_id").distinct().count() == 24
    orphans = raw["events"].join(users, "user_id", "left_anti").count()
    assert orphans == 0


def test_drift(spark):
    tables = {"users": spark.sql("SELECT 'a' AS user_id, 1 AS age, 2L AS big, 'x' AS extra"),
              "surprise": spark.sql("SELECT 1 AS b, 2 AS a")}
    expected = drift.expected_columns(spark, {
        "users": {"user_id": "uuid", "age": "int", "big": "integer", "gone": "string"}, "lost": {"z": "int", "y": "int"}})
    rows = {r.table_name: r for r in drift.compare_schemas(expected, drift.actual_columns(spark, tables)).collect()}
    assert rows["lost"].missing_columns == '["y","z"]' and rows["lost"].notes == "Expected staging table was not created."
    assert rows["surprise"].new_columns == '["a","b"]' and rows["surprise"].notes.startswith("Unexpected")
    users = rows["users"]
    assert users.type_changes == '[{"column":"big","expected":"integer","actual":"bigint"}]'
    assert users.notes == "Missing columns: gone; New columns: extra; Type changes: big (integer→bigint)"


def test_comparison_reports_the_first_mismatch(spark):
    actual = local_frame(spark, [("score", "overall", 90.0), ("failed_checks", "checks", 5.0), ("issue_count", "orphan", 1.0)],
                         "kind string, name string, value double")
    base = {"score": 90.005, "failed_checks": 4, "issue_counts": {}, "subscores": {"x": 1.0}}
    rows = gate.compare_with_baseline(actual, gate.baseline_rows(spark, base))
    by = {(r.kind, r.name): (r.delta, r.matches) for r in rows.collect()}
    assert by == {("score", "overall"): (-0.005, True), ("failed_checks", "checks"): (1.0, False),
                  ("issue_count", "orphan"): (1.0, False), ("subscore", "x"): (-1.0, False)}
    verdict = gate.match_verdict(rows).first()
    assert not verdict.matched and verdict.reason.startswith("failed_checks checks: expected 4.0 vs actual 5.0")


def test_a_rerun_without_rows_leaves_none(spark, tmp_path):
    path = str(tmp_path / "issues")
    rows = local_frame(spark, [("a/1", 1), ("b", 2)], "run_id string, n int")
    marts.write_run(rows, path)
    marts.write_run(rows.limit(0), path, run_id="a/1")
    assert [r.n for r in marts.read_run(spark, path, "b").collect()] == [2]
    assert marts.read_run(spark, path, "a/1").isEmpty()


def test_files_of_a_folder_are_read_by_their_own_header(spark, tmp_path):
    folder = tmp_path / "some users.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("id,name,state\n1,N1,NY\n")
    (folder / "b.csv").write_text("state,id,name\nTX,2,N2\n")
    (folder / "c.csv").write_text("id,name,state\n3,N3,CA\n")
    (folder / "d.csv").write_text("")
    got = exports.read_export(spark, str(folder), ["id", "name", "state"])
    assert {tuple(r) for r in got.collect()} == {
        ("1", "N1", "NY"), ("2", "N2", "TX"), ("3", "N3", "CA")}


def test_headers_are_found_in_one_job(spark, tmp_path):
    """Quoted names over two lines, blank first lines, files without bytes; any number of files."""
    folder = tmp_path / "many.csv"
    folder.mkdir()
    for i in range(12):
        (folder / f"p{i:02d}.csv").write_text("a,b\n" + f"{i},x\n" if i % 2 else "b,\"c,d\",a\n" + f"y,z,{i}\n")
    (folder / "blank.csv").write_text("\n\nB ,a\n7,8\n")
    (folder / "quoted.csv").write_text('"two\nlines",a,b\n1,2,3\n')
    (folder / "none.csv").write_text("")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    heads = exports.first_lines(spark, str(folder))
    assert len(tracker.getJobIdsForGroup("headers")) == 1
    assert sorted(map(len, heads.values())) == [1, 1, 6, 6]
    spark.sparkContext.setJobGroup("other", "other")
    got = {(r.a, r.b) for r in exports.read_export(spark, str(folder), ["a", "b"], multi_line=True).collect()}
    assert got == {(str(i), "x" if i % 2 else "y") for i in range(12)} | {("8", "7"), ("2", "3")}
    with pytest.raises(ValueError, match="No column q"):
        exports.read_export(spark, str(folder), ["a", "q"])
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(ValueError, match="No file with a header"):
        exports.read_export(spark, str(tmp_path / "empty.csv"), ["a"])
