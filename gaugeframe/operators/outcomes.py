"""Check results, issue log, run history and expectation statistics."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeframe.config import Rule, RuleSet
from gaugeframe.functions.stats import ratio
from gaugeframe.session import local_frame

RULE_SCHEMA = """
    ord int, check_id string, table_name string, stage_table string, dimension string,
    description string, rule_type string, columns array<string>, column_regex string,
    severity int, weight double, threshold_warning double, threshold_fail double,
    issue_type string
"""

# The columns of the results, which later steps and readers know by name.
CHECK_COLUMNS = (
    "run_id", "dataset_name", "table_name", "stage_table", "check_id", "dimension",
    "description", "rule_type", "columns", "column_regex", "severity", "weight",
    "threshold_warning", "threshold_fail", "failure_rate", "failure_count", "total_rows",
    "status", "penalty",
)

ISSUE_COLUMNS = (
    "run_id", "run_ts", "dataset_name", "table_name", "check_name", "dimension",
    "issue_type", "severity", "affected_rows", "affected_pct", "sample_bad_rows_json",
    "probable_root_cause", "recommended_fix", "root_cause_candidates",
)

EXCEPTION_COLUMNS = (
    "check_name", "table_name", "dimension", "issue_type", "severity", "affected_rows",
    "affected_pct", "probable_root_cause", "recommended_fix", "sample_bad_rows_json",
)


CAUSES_SCHEMA = """
    check_id string,
    causes array<struct<probable_cause: string, recommended_fix: string>>
"""


def _rule_row(ord_: int, rule: Rule) -> tuple:
    swept = rule.kind == "NON_NEGATIVE_COUNTS"
    return (
        ord_, rule.id, rule.table, "*" if swept else f"staging_{rule.table}", rule.dimension,
        rule.description, rule.rule_type, list(rule.columns), rule.column_regex, rule.severity,
        rule.weight, rule.warning, rule.fail, rule.issue_type,
    )


def causes_frame(spark: SparkSession, rules: RuleSet) -> DataFrame:
    """The causes of each check, in their order; checks without any are absent."""
    known = {c.check_id: rules.causes_of(c.check_id) for c in rules.causes}
    rows = [
        (check_id, [{"probable_cause": c.probable_cause, "recommended_fix": c.recommended_fix}
                    for c in causes])
        for check_id, causes in known.items()
    ]
    return local_frame(spark, rows, CAUSES_SCHEMA)


def rules_frame(spark: SparkSession, rules: RuleSet | Iterable[Rule]) -> DataFrame:
    """The rules as a table, joined with the root causes that their set knows.

    Bare rules, outside a RuleSet, have none: description and rule type stand in.
    """
    declared = local_frame(spark, [_rule_row(i, r) for i, r in enumerate(rules)], RULE_SCHEMA)
    known = rules if isinstance(rules, RuleSet) else RuleSet(())
    likeliest = F.get("causes", F.lit(0))
    remedy = F.concat(F.lit("Enforce "), "rule_type", F.lit(" for "), "table_name")
    return declared.join(causes_frame(spark, known), "check_id", "left").select(
        *declared.columns,
        F.coalesce(likeliest["probable_cause"], "description").alias("probable_root_cause"),
        F.coalesce(likeliest["recommended_fix"], remedy).alias("recommended_fix"),
        F.coalesce(F.to_json("causes"), F.lit("[]")).alias("root_cause_candidates"),
    )


def status(rate: Column, warning: Column, fail: Column) -> Column:
    """R12. With thresholds of zero even a clean check is a `fail`."""
    return F.when(rate >= fail, "fail").when(rate >= warning, "warn").otherwise("pass")


def penalty(rate: Column, severity: Column, weight: Column) -> Column:
    """R13"""
    return rate * (severity / F.lit(5)) * weight


def judge(
    counts: DataFrame,
    rules: Iterable[Rule],
    by: Sequence[str] = (),
) -> DataFrame:
    """Counts joined with their rules, plus failure_rate, status and penalty.

    Without `by`, rules that counted nothing appear with zero rows; with `by`, results exist
    for the runs in which a table has rows.
    """
    declared = rules_frame(counts.sparkSession, rules)
    joined = declared.join(counts, "check_id", "inner" if by else "left")
    rate = ratio(F.col("failure_count"), F.col("total_rows"))
    return (
        joined.withColumn("failure_count", F.coalesce("failure_count", F.lit(0).cast("long")))
        .withColumn("total_rows", F.coalesce("total_rows", F.lit(0).cast("long")))
        .withColumn("failure_rate", rate)
        .withColumn(
            "status",
            status(F.col("failure_rate"), F.col("threshold_warning"), F.col("threshold_fail")),
        )
        .withColumn(
            "penalty", penalty(F.col("failure_rate"), F.col("severity"), F.col("weight"))
        )
    )


def check_results(judged: DataFrame, run_id: str | Column, dataset_name: str | Column) -> DataFrame:
    """O1"""
    return judged.withColumns(
        {"run_id": _as_column(run_id), "dataset_name": _as_column(dataset_name)}
    ).select(*CHECK_COLUMNS)


def issue_log(
    judged: DataFrame,
    run_id: str | Column,
    dataset_name: str | Column,
    run_ts: str | Column,
    samples: DataFrame | None = None,
) -> DataFrame:
    """O2, O3: every check with failing rows, whatever its status. `samples` as by sample_json."""
    issues = judged.where(F.col("failure_count") > 0)
    if samples is None:
        issues = issues.withColumn("sample_bad_rows_json", F.lit("[]"))
    else:
        issues = issues.join(samples, "check_id", "left").withColumn(
            "sample_bad_rows_json", F.coalesce("sample_bad_rows_json", F.lit("[]"))
        )
    return issues.withColumns(
        {
            "run_id": _as_column(run_id),
            "dataset_name": _as_column(dataset_name),
            "run_ts": _as_column(run_ts),
            "check_name": F.col("check_id"),
            "affected_rows": F.col("failure_count"),
            "affected_pct": F.col("failure_rate"),
        }
    ).select(*ISSUE_COLUMNS)


def exceptions(issues: DataFrame) -> DataFrame:
    """IO10: the columns of the exceptions export, as far as they exist."""
    return issues.select(*[c for c in EXCEPTION_COLUMNS if c in issues.columns])


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """IO11: (table_name, row_count). Counts read no column data from Parquet."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    united = parts[0]
    for part in parts[1:]:
        united = united.unionByName(part)
    return united


def run_history(counts: DataFrame, run_id: str, run_ts: str, dataset_name: str) -> DataFrame:
    """One row per run with the row count of every table as JSON."""
    entries = F.array_sort(F.collect_list(F.struct("table_name", "row_count")))
    return counts.agg(F.to_json(F.map_from_entries(entries)).alias("total_rows_by_table")).select(
        F.lit(run_id).alias("run_id"),
        F.lit(run_ts).alias("run_ts"),
        F.lit(dataset_name).alias("dataset_name"),
        "total_rows_by_table",
    )


def expectation_statistics(checks: DataFrame) -> DataFrame:
    """A check succeeds when no row fails it."""
    evaluated = F.count(F.lit(1))
    good = F.count_if(F.col("failure_count") == 0)
    return checks.agg(
        evaluated.alias("evaluated_expectations"),
        good.alias("successful_expectations"),
        (evaluated - good).alias("unsuccessful_expectations"),
        F.when(evaluated > 0, good.cast("double") / evaluated.cast("double") * 100)
        .otherwise(F.lit(100.0))
        .alias("success_percent"),
        F.coalesce(F.bool_and(F.col("failure_count") == 0), F.lit(True)).alias("success"),
    )


def expectation_results(checks: DataFrame) -> DataFrame:
    """Per check, unexpected count and percentage."""
    return checks.select(
        "check_id",
        "table_name",
        "dimension",
        (F.col("failure_count") == 0).alias("success"),
        F.col("failure_count").alias("unexpected_count"),
        (F.col("failure_rate") * 100).alias("unexpected_percent"),
    )


def _as_column(value: str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)
