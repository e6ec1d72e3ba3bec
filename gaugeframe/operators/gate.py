"""Quality gate, project metrics and comparison with a baseline."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeframe.config import GateSettings
from gaugeframe.functions.stats import count_when, exact_sum, rounded_ratio
from gaugeframe.operators.scoring import overall_score
from gaugeframe.session import local_frame


def _critical(settings: GateSettings) -> Column:
    return (F.col("status") == "fail") & (F.col("severity") >= settings.critical_severity)


def _culprits(settings: GateSettings) -> Column:
    """Critical checks in order, as an aggregate; others are NULL, which lists leave out."""
    label = F.format_string("%s (%s)", "check_id", "table_name")
    listed = F.collect_list(F.when(_critical(settings), label))
    return F.array_sort(listed).alias("critical_checks")


def _verdict(judged: DataFrame, settings: GateSettings) -> DataFrame:
    low = F.format_string(
        f"overall score %.2f is below threshold {settings.score_threshold:.2f}", "score"
    )
    failed = F.concat(
        F.lit("critical checks failed: "), F.array_join("critical_checks", ", "),
        F.lit(f" (severity >= {settings.critical_severity:.1f})"),
    )
    reason = F.when(F.col("score") < settings.score_threshold, low).when(
        F.size("critical_checks") > 0, failed
    )
    return (
        judged.select(F.round("score", 2).alias("score"), "critical_checks")
        .withColumn("reason", reason)
        .withColumn("passed", F.col("reason").isNull())
    )


def gate_verdict(scores: DataFrame, checks: DataFrame, settings: GateSettings) -> DataFrame:
    """G1: one row saying whether the run passes, and if not, why.

    The score decides first (rounded to two places, as published); then any critical check
    with status `fail`.
    """
    culprits = checks.agg(_culprits(settings)).scalar().alias("critical_checks")
    return _verdict(scores.select("score", culprits), settings)


def judge_checks(
    checks: DataFrame, settings: GateSettings, baseline: float = 100.0, minimum: float = 0.0
) -> DataFrame:
    """G1 from the checks alone: score and critical checks in one aggregate."""
    return _verdict(overall_score(checks, baseline, minimum, also=[_culprits(settings)]), settings)


def status_counts(checks: DataFrame) -> DataFrame:
    """G2"""
    return checks.agg(*_statuses())


def _statuses() -> list[Column]:
    return [
        count_when(F.col("status") == "pass").alias("passed_checks"),
        count_when(F.col("status") == "warn").alias("warning_checks"),
        count_when(F.col("status") == "fail").alias("failed_checks"),
    ]


def critical_failures(checks: DataFrame, settings: GateSettings) -> DataFrame:
    """G3"""
    return checks.agg(_critical_count(settings))


def _critical_count(settings: GateSettings) -> Column:
    return count_when(_critical(settings)).alias("critical_failed_checks")


def _filled(column: str) -> Column:
    return F.trim(F.coalesce(F.col(column).cast("string"), F.lit(""))) != ""


def issue_measures(issues: DataFrame) -> DataFrame:
    """Number of issues, worst severity and share, root-cause coverage; one row."""
    total = F.count(F.lit(1))
    covered = count_when(_filled("probable_root_cause") & _filled("recommended_fix"))

    def largest(column: str) -> Column:
        return F.max(F.col(column).cast("string").try_cast("double"))

    return issues.agg(
        total.alias("total_issues"),
        F.coalesce(largest("severity"), F.lit(0.0)).cast("int").alias("max_severity"),
        F.coalesce(largest("affected_pct"), F.lit(0.0)).alias("max_affected_pct"),
        F.when(total == 0, F.lit(1.0))
        .otherwise(rounded_ratio(covered, total))
        .alias("issue_root_cause_coverage_pct"),
    )


def root_cause_coverage(issues: DataFrame) -> DataFrame:
    """Share of issues that name both a cause and a fix; 1.0 without issues."""
    return issue_measures(issues).select("issue_root_cause_coverage_pct")


def rule_summary(rules: DataFrame) -> DataFrame:
    """Number of rules by dimension, table, type and severity, in long form.

    Takes the rules table or check results. One aggregate serves the four groupings.
    """
    slim = rules.select(
        "dimension", "table_name", "rule_type", F.col("severity").cast("string").alias("severity")
    )
    names = ["dimension", "table_name", "rule_type", "severity"]
    value = F.when(F.grouping("dimension") == 0, F.col("dimension"))
    group = F.when(F.grouping("dimension") == 0, F.lit("dimension"))
    for name in names[1:]:
        group = group.when(F.grouping(name) == 0, F.lit(name))
        value = value.when(F.grouping(name) == 0, F.col(name))
    return slim.groupingSets([[n] for n in names], *names).agg(
        group.alias("grouping"), value.alias("value"), F.count(F.lit(1)).alias("rules")
    ).select("grouping", "value", "rules")


def rule_totals(rules: DataFrame) -> DataFrame:
    """Number of rules, total weight, share of rules with a description."""
    total = F.count(F.lit(1))
    return rules.agg(
        total.alias("total_rules"),
        F.round(exact_sum(F.col("weight")), 2).alias("total_weight"),
        rounded_ratio(
            count_when(F.coalesce("description", F.lit("")) != ""), total
        ).alias("documentation_coverage_pct"),
    )


def project_metrics(
    score: DataFrame,
    checks: DataFrame,
    issues: DataFrame,
    lifecycle: DataFrame,
    recurrences: DataFrame,
    settings: GateSettings,
    comparison: DataFrame | None = None,
) -> DataFrame:
    """Everything that is reported about a run, as one row.

    `score` is the run's score record; `lifecycle` and `recurrences` are the counts of H4 and
    H5; `comparison` is that with a baseline (G9), if there is one. Each input is aggregated
    once, to a row that is a scalar subquery.
    """
    counts = checks.agg(*_statuses(), _critical_count(settings)).select(F.struct("*")).scalar()
    measures = issue_measures(issues).select(F.struct("*")).scalar()
    stages = lifecycle.select(F.struct("*")).scalar()
    recurring = recurrences.scalar()
    rounded = F.round("score", 2)
    joined = score.select(
        "*", counts.alias("c"), measures.alias("m"), stages.alias("l"),
        recurring.alias("r"), rounded.alias("overall_score"),
    )
    good = (F.col("overall_score") >= settings.score_threshold) & (
        F.col("c.critical_failed_checks") == 0
    )
    recur = F.when(F.col("l.recurring_issue_count") == 0, F.col("r")).otherwise(
        F.col("l.recurring_issue_count")
    )
    row = joined.select(
        "run_id", "run_ts", "dataset_name", "overall_score",
        F.lit(settings.score_threshold).alias("score_threshold"),
        F.lit(settings.critical_severity).alias("critical_severity"),
        F.when(good, "pass").otherwise("fail").alias("quality_gate_status"),
        "total_checks", "c.passed_checks", "c.warning_checks",
        F.col("c.failed_checks").alias("failed_checks"),
        rounded_ratio(F.col("c.passed_checks"), F.col("total_checks")).alias("check_pass_rate"),
        "c.critical_failed_checks", "m.total_issues", "m.max_severity", "m.max_affected_pct",
        "m.issue_root_cause_coverage_pct", "l.open_issue_count", "l.new_issue_count",
        F.coalesce(recur, F.lit(0)).alias("recurring_issue_count"),
        "l.resolved_or_not_seen_issue_count",
    )
    if comparison is None:
        nothing = {"regression_status": "string", "regression_score_delta": "double"}
        return row.withColumns({n: F.lit(None).cast(kind) for n, kind in nothing.items()})
    verdict = comparison.agg(
        F.when(F.coalesce(F.bool_and("matches"), F.lit(True)), "pass").otherwise("fail").alias("status"),
        F.max(F.when(F.col("kind") == "score", F.col("delta"))).alias("delta"),
    )
    return row.withColumn("v", verdict.select(F.struct("*")).scalar()).select(
        *row.columns, F.col("v.status").alias("regression_status"),
        F.col("v.delta").alias("regression_score_delta"),
    )


# ---------------------------------------------------------------- comparison with a baseline


def measure_rows(
    scores: DataFrame, dimensions: DataFrame, issue_counts: DataFrame, failed_checks: DataFrame
) -> DataFrame:
    """A run's comparable numbers in long form: (kind, name, value)."""
    published = F.round("score", 2).alias("value")
    return (
        scores.select(F.lit("score").alias("kind"), F.lit("overall").alias("name"), published)
        .unionByName(
            dimensions.select(F.lit("subscore").alias("kind"), F.col("dimension").alias("name"), published)
        )
        .unionByName(
            issue_counts.select(
                F.lit("issue_count").alias("kind"), F.col("issue_type").alias("name"),
                F.col("issue_count").cast("double").alias("value"),
            )
        )
        .unionByName(
            failed_checks.select(
                F.lit("failed_checks").alias("kind"), F.lit("checks").alias("name"),
                F.col("failed_checks").cast("double").alias("value"),
            )
        )
    )


def baseline_rows(spark, baseline: Mapping[str, Any]) -> DataFrame:
    """A stored baseline (score, failed_checks, issue_counts, subscores) in the same form."""
    rows = [
        ("score", "overall", float(baseline.get("score", 0.0))),
        ("failed_checks", "checks", float(baseline.get("failed_checks", -1))),
    ]
    rows += [("subscore", k, float(v)) for k, v in (baseline.get("subscores") or {}).items()]
    rows += [("issue_count", k, float(v)) for k, v in (baseline.get("issue_counts") or {}).items()]
    return local_frame(spark, rows, "kind string, name string, value double")


def compare_with_baseline(
    actual: DataFrame, expected: DataFrame, tolerance: float = 0.01
) -> DataFrame:
    """Deltas over all expected and found numbers, and whether each is acceptable.

    Scores may differ by the tolerance, counts must be equal. Dimensions the baseline does not
    name are not compared.
    """
    both = expected.withColumnRenamed("value", "expected").join(
        actual.withColumnRenamed("value", "actual"), ["kind", "name"], "full_outer"
    )
    missing = F.col("actual").isNull() & (F.col("kind") == "subscore")
    difference = F.coalesce("actual", F.lit(0.0)) - F.coalesce("expected", F.lit(0.0))
    near = F.abs(difference) <= tolerance
    exact = F.coalesce("actual", F.lit(0.0)) == F.coalesce("expected", F.lit(0.0))
    matches = (
        F.when(missing, F.lit(False))
        .when(F.col("kind").isin("score", "subscore"), near)
        .otherwise(exact)
    )
    return both.where((F.col("kind") != "subscore") | F.col("expected").isNotNull()).select(
        "kind", "name", "expected", "actual", F.round(difference, 4).alias("delta"),
        matches.alias("matches"),
    )


# The order in which a mismatch is reported.
_ORDER = ("score", "failed_checks", "issue_count", "subscore")


def match_verdict(comparison: DataFrame) -> DataFrame:
    """One row: `matched`, and the first mismatch as the reason."""
    place = F.array_position(F.array(*[F.lit(k) for k in _ORDER]), F.col("kind"))
    text = F.format_string(
        "%s %s: expected %s vs actual %s", "kind", "name",
        F.coalesce(F.col("expected").cast("string"), F.lit("none")),
        F.coalesce(F.col("actual").cast("string"), F.lit("none")),
    )
    first = F.min(F.when(~F.col("matches"), F.struct(place.alias("p"), "name", text.alias("t"))))
    return comparison.agg(
        F.coalesce(F.bool_and("matches"), F.lit(True)).alias("matched"), first.alias("f")
    ).select("matched", F.col("f.t").alias("reason"))
