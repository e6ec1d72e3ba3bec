"""Scores, summaries and score history (SC1-SC8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeframe.functions.stats import exact_sum, ranked
from gaugeframe.functions.timestamps import parse_timestamp, utc_now

PREVIEW_SIZE = 12
SUMMARY_COLUMNS = (
    "check_id", "table_name", "dimension", "description", "status", "failure_rate",
    "threshold_warning", "threshold_fail", "severity", "weight", "penalty", "issue_type",
)


def _score(baseline: float, minimum: float) -> Column:
    lost = F.col("total_penalty") / F.col("total_weight")
    scaled = F.greatest(F.lit(float(minimum)), F.lit(float(baseline)) - 100 * lost)
    return F.when(F.col("total_weight") != 0, scaled).otherwise(F.lit(float(baseline)))


def overall_score(
    checks: DataFrame,
    baseline: float = 100.0,
    minimum: float = 0.0,
    by: Sequence[str] = (),
    also: Sequence[Column] = (),
) -> DataFrame:
    """SC1: baseline minus the weighted share of penalties, never below the minimum.

    `also` names further aggregates of the checks to take in the same pass.
    """
    measures = [
        exact_sum(F.col("penalty")).alias("total_penalty"),
        exact_sum(F.col("weight")).alias("total_weight"),
        F.count(F.lit(1)).alias("total_checks"),
        *also,
    ]
    sums = checks.groupBy(*by).agg(*measures) if by else checks.agg(*measures)
    return sums.withColumn("score", _score(baseline, minimum))


def dimension_scores(
    checks: DataFrame, baseline: float = 100.0, minimum: float = 0.0, by: Sequence[str] = ()
) -> DataFrame:
    """SC2: the same per dimension."""
    return overall_score(checks, baseline, minimum, (*by, "dimension"))


def ranked_dimension_scores(scores: DataFrame) -> DataFrame:
    """SC8: best dimension first, with its `rank`."""
    return ranked(scores, F.desc("score"), F.col("dimension"))


def check_summary(checks: DataFrame) -> DataFrame:
    """SC3: fail, pass, warn (alphabetical), highest failure rate first; gaps become zero.

    `rank` says the order.
    """
    columns = [
        F.col(c) if c in checks.columns else F.lit(None).cast("string").alias(c)
        for c in SUMMARY_COLUMNS
    ]
    zero = {c: 0.0 for c in (
        "failure_rate", "threshold_warning", "threshold_fail", "weight", "penalty"
    )}
    filled = checks.select(*columns).fillna({**zero, "severity": 0})
    return ranked(filled, F.col("status"), F.desc("failure_rate"), F.col("check_id"))


def issue_preview(issues: DataFrame, limit: int | None = PREVIEW_SIZE) -> DataFrame:
    """SC4: the most severe issues, most affected first; `limit=None` gives the whole order."""
    ordered = issues.select(
        "run_id", "table_name", "check_name", "issue_type",
        F.coalesce("severity", F.lit(0)).alias("severity"),
        F.coalesce("affected_pct", F.lit(0.0)).alias("affected_pct"),
        F.coalesce("probable_root_cause", F.lit("")).alias("probable_root_cause"),
        F.coalesce("recommended_fix", F.lit("")).alias("recommended_fix"),
    ).orderBy(F.desc("severity"), F.desc("affected_pct"), "check_name")
    return ordered if limit is None else ordered.limit(limit)


def issue_counts(issues: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """SC5"""
    return (
        issues.where(F.col("issue_type").isNotNull())
        .groupBy(*by, "issue_type")
        .agg(F.count(F.lit(1)).alias("issue_count"))
    )


def last_run(run_history: DataFrame, run_id: str) -> DataFrame:
    """IO8: (run_ts, dataset_name) of the run's latest history row; one row, NULLs if none."""
    latest = F.max_by(F.struct("run_ts", "dataset_name"), parse_timestamp(F.col("run_ts")))
    return (
        run_history.where(F.col("run_id") == run_id)
        .agg(latest.alias("r"))
        .select("r.run_ts", "r.dataset_name")
    )


def resolve_run_ts(run_history: DataFrame, issues: DataFrame, run_id: str) -> DataFrame:
    """SC7: run time from the run history, else from the issues, else now; one row."""
    noted = last_run(run_history, run_id).select(F.col("run_ts").alias("noted"))
    first_issue = issues.where(F.col("run_id") == run_id).agg(F.min("run_ts").alias("seen"))
    texts = noted.select(
        F.coalesce(
            F.when(F.col("noted") != "", F.col("noted")), first_issue.scalar()
        ).alias("text")
    )
    return texts.select(F.coalesce(parse_timestamp(F.col("text")), utc_now()).alias("run_ts"))


def score_record(
    checks: DataFrame,
    issues: DataFrame,
    run_id: str,
    run_ts: str | Column,
    baseline: float = 100.0,
    minimum: float = 0.0,
) -> DataFrame:
    """SC6: the score-history row of one run.

    `failed_checks` counts issues, i.e. checks with failing rows, not `fail` statuses.
    """
    subscores = dimension_scores(checks, baseline, minimum).agg(
        F.to_json(
            F.map_from_entries(F.array_sort(F.collect_list(F.struct("dimension", "score"))))
        )
    )
    failed = issues.agg(F.count(F.lit(1)))
    dataset = checks.agg(F.coalesce(F.max("dataset_name"), F.lit("unknown")))
    when = run_ts if isinstance(run_ts, Column) else F.lit(run_ts)
    return overall_score(checks, baseline, minimum).select(
        F.lit(run_id).alias("run_id"),
        when.alias("run_ts"),
        dataset.scalar().alias("dataset_name"),
        "score",
        F.lit(float(baseline)).alias("baseline"),
        F.lit(float(minimum)).alias("minimum"),
        "total_penalty",
        "total_weight",
        "total_checks",
        failed.scalar().alias("failed_checks"),
        subscores.scalar().alias("subscores"),
    )
