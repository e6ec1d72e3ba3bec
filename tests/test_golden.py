"""The reference dataset end to end: generate, export, ingest, validate, score, gate."""

import pytest
from pyspark.sql import functions as F

from gaugeframe import defaults
from gaugeframe.operators import drift, gate, scoring
from gaugeframe.plans.validation import Run, validate
from gaugeframe.sources import exports, synthetic

# The published outcome of the reference dataset.
BASELINE = {
    "score": 98.22,
    "failed_checks": 5,
    "issue_counts": {"duplicate": 3, "missing": 2},
    "subscores": {
        "completeness": 97.7,
        "validity_accuracy": 100.0,
        "consistency": 100.0,
        "uniqueness": 94.41,
        "integrity": 100.0,
    },
}


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("golden")
    raw, stage = f"{base}/raw", f"{base}/stage"
    metadata = synthetic.run_metadata("phase1", 42)
    synthetic.write_dataset(synthetic.generate(spark, "phase1", 42), raw, metadata)
    run_id = exports.ingest(spark, raw, stage, defaults.VOCABULARY, "phase1", 42)
    assert run_id == metadata["run_id"]
    return exports.read_staged(spark, stage)


@pytest.fixture(scope="module")
def validation(staged):
    return validate(staged, defaults.RULES, Run("r1", "phase1", "2024-06-01T00:00:00"))


def test_published_outcome(spark, validation):
    actual = gate.measure_rows(
        scoring.overall_score(validation.checks),
        validation.dimension_scores,
        scoring.issue_counts(validation.issues),
        validation.issues.agg(F.count(F.lit(1)).alias("failed_checks")),
    )
    comparison = gate.compare_with_baseline(actual, gate.baseline_rows(spark, BASELINE))
    verdict = gate.match_verdict(comparison).first()
    assert verdict.matched, verdict.reason


def test_status_counts_and_gate(validation):
    counts = gate.status_counts(validation.checks).first()
    assert (counts.passed_checks, counts.warning_checks, counts.failed_checks) == (21, 1, 5)
    verdict = validation.gate(defaults.GATE).first()
    assert verdict.passed and verdict.score == 98.22


def test_no_drift(spark, staged):
    expected = drift.expected_columns(spark, defaults.EXPECTED_SCHEMA)
    assert drift.compare_schemas(expected, drift.actual_columns(spark, staged)).count() == 0


def test_issue_log(validation):
    issues = {row.check_name: row for row in validation.issues.collect()}
    assert set(issues) == {
        "users_email_not_null", "users_district_id_not_null", "users_email_unique",
        "users_email_org_unique", "resources_resource_id_unique",
    }
    blank = issues["users_email_not_null"]
    assert blank.probable_root_cause.startswith("CRM export allows blank email")
    assert '"email":null' in blank.sample_bad_rows_json
    repeated = issues["users_email_unique"]
    assert repeated.recommended_fix == "Enforce DUPLICATE_PERCENTAGE for users"
    assert '"dq_rank":"2"' in repeated.sample_bad_rows_json
