"""Analytics over run history: recurrence, issue lifecycle, totals, trends (H1-H8).

Histories hold one row per run and issue. "First" and "last" follow (run_ts, run_id) rather
than file order, so they do not depend on how the history was written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeframe.functions.stats import count_when, ranked
from gaugeframe.functions.timestamps import parse_timestamp

RECURRENCE_LIMIT = 10
TREND_TYPES = 8
LIFECYCLE_COLUMNS = (
    "issue_key", "first_seen_run_ts", "last_seen_run_ts", "first_seen_run_id",
    "last_seen_run_id", "occurrence_count", "table_name", "check_name", "dimension",
    "issue_type", "severity", "max_affected_pct", "median_affected_pct",
    "probable_root_cause", "recommended_fix", "status",
)
_LIFECYCLE_DEFAULTS = {
    "run_id": F.lit, "table_name": F.lit, "check_name": F.lit, "dimension": F.lit,
    "issue_type": F.lit, "probable_root_cause": F.lit, "recommended_fix": F.lit,
}


def with_run_time(history: DataFrame) -> DataFrame:
    """Adds `_ts`: run_ts as naive UTC, NULL when it cannot be parsed."""
    kind = history.schema["run_ts"].dataType
    parsed = F.col("run_ts") if isinstance(kind, T.TimestampNTZType) else parse_timestamp(F.col("run_ts"))
    return history.withColumn("_ts", parsed)


def _last(column: str) -> Column:
    """Latest non-null value: rows without a value are given no place in the order."""
    place = F.when(F.col(column).isNotNull(), F.struct("_ts", "run_id"))
    return F.max_by(column, place).alias(column)


def _of_dataset(history: DataFrame, dataset_name: str | None) -> DataFrame:
    return history if dataset_name is None else history.where(F.col("dataset_name") == dataset_name)


def recurrence(
    history: DataFrame, limit: int | None = RECURRENCE_LIMIT, dataset_name: str | None = None
) -> DataFrame:
    """H1: the issues seen most often, most recent first among equals; all if limit is None."""
    keys = ["check_name", "table_name", "issue_type"]
    complete = _of_dataset(history, dataset_name).dropna(subset=keys)
    ranked = (
        with_run_time(complete)
        .groupBy(*keys)
        .agg(
            F.count("run_id").alias("occurrences"),
            F.median("affected_pct").alias("median_affected_pct"),
            F.max("_ts").alias("last_seen"),
            _last("probable_root_cause"),
            _last("recommended_fix"),
        )
        .orderBy(F.desc("occurrences"), F.desc("last_seen"), *keys)
    )
    return ranked if limit is None else ranked.limit(limit)


def _with_lifecycle_columns(history: DataFrame) -> DataFrame:
    missing: dict[str, Column] = {
        name: lit("") for name, lit in _LIFECYCLE_DEFAULTS.items() if name not in history.columns
    }
    if "run_ts" not in history.columns:
        missing["run_ts"] = F.lit(None).cast("timestamp_ntz")
    if "severity" not in history.columns:
        missing["severity"] = F.lit(0)
    if "affected_pct" not in history.columns:
        missing["affected_pct"] = F.lit(0.0)
    return history.withColumns(missing) if missing else history


def issue_lifecycle(
    history: DataFrame, runs: DataFrame | None = None, dataset_name: str | None = None
) -> DataFrame:
    """H2, H3: per issue, when it was first and last seen, how often, and whether it is open.

    An issue is open when it was seen in the latest run. By default the latest run is taken
    from the issue history itself, in which a run without issues leaves no trace; pass the run
    history as `runs` to let a clean run close issues.
    """
    issues = with_run_time(_with_lifecycle_columns(_of_dataset(history, dataset_name)))
    source = issues if runs is None else with_run_time(_of_dataset(runs, dataset_name))
    latest = source.agg(F.max("_ts"))
    name = F.concat_ws("|", *[F.coalesce(c, F.lit("None")) for c in (
        "table_name", "check_name", "issue_type")])
    order = F.struct("_ts", "run_id")
    # Runs whose time cannot be read come last, so the first run is one that has a time.
    earliest = F.struct(F.col("_ts").isNull(), F.col("_ts"), F.col("run_id"))
    grouped = (
        issues.withColumn("issue_key", name)
        .groupBy("issue_key")
        .agg(
            F.min("_ts").alias("first_seen_run_ts"),
            F.max("_ts").alias("last_seen_run_ts"),
            F.min_by("run_id", earliest).alias("first_seen_run_id"),
            F.max_by("run_id", order).alias("last_seen_run_id"),
            F.count("run_id").alias("occurrence_count"),
            *[_last(c) for c in ("table_name", "check_name", "dimension", "issue_type")],
            F.max("severity").alias("severity"),
            F.max("affected_pct").alias("max_affected_pct"),
            F.median("affected_pct").alias("median_affected_pct"),
            _last("probable_root_cause"),
            _last("recommended_fix"),
        )
        .withColumn("_latest", latest.scalar())
        .where(F.col("_latest").isNotNull())
    )
    seen = F.col("last_seen_run_ts") == F.col("_latest")
    return (
        grouped.withColumn("status", F.when(seen, "open").otherwise("not_seen_in_latest_run"))
        .orderBy(
            F.when(F.col("status") == "open", 0).otherwise(1),
            F.desc("severity"),
            F.desc("occurrence_count"),
            "issue_key",
        )
        .select(*LIFECYCLE_COLUMNS)
    )


def lifecycle_counts(lifecycle: DataFrame) -> DataFrame:
    """H4: open, new, recurring and no longer seen issues."""
    is_open = F.col("status") == "open"
    count = F.coalesce("occurrence_count", F.lit(0))
    return lifecycle.agg(
        count_when(is_open).alias("open_issue_count"),
        count_when(is_open & (count == 1)).alias("new_issue_count"),
        count_when(is_open & (count > 1)).alias("recurring_issue_count"),
        count_when(F.col("status") == "not_seen_in_latest_run").alias(
            "resolved_or_not_seen_issue_count"
        ),
    )


def recurring_count(recurrences: DataFrame) -> DataFrame:
    """H5: issues seen more than once. Takes the recurrences of all issues, not a top list."""
    return recurrences.agg(count_when(F.col("occurrences") > 1).alias("recurring_issue_count"))


def _named_type() -> Column:
    return F.coalesce("issue_type", F.lit("Unknown"))


def issue_totals(history: DataFrame) -> DataFrame:
    """H6: all-time number of issues per type, most frequent first by `rank`."""
    totals = history.groupBy(_named_type().alias("issue_type")).agg(
        F.count(F.lit(1)).alias("issue_count")
    )
    return ranked(totals, F.desc("issue_count"), F.col("issue_type"))


def trend_matrix(history: DataFrame, types: int = TREND_TYPES) -> DataFrame:
    """H7: every run against the most frequent issue types, with zeroes where none occurred."""
    noted = with_run_time(history).select(
        F.coalesce("run_id", F.lit("unknown-run")).alias("run_id"),
        F.coalesce("_ts", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).alias("run_ts"),
        _named_type().alias("issue_type"),
    )
    counts = noted.groupBy("run_id", "run_ts", "issue_type").agg(
        F.count(F.lit(1)).alias("issue_count")
    )
    frequent = (
        counts.groupBy("issue_type")
        .agg(F.sum("issue_count").alias("n"))
        .orderBy(F.desc("n"), "issue_type")
        .limit(types)
        .agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("rank"), "issue_type"))))
    )
    # A scalar subquery of at most `types` names; each run then gets one row per name.
    grid = (
        counts.select("run_id", "run_ts")
        .distinct()
        .select("run_id", "run_ts", F.posexplode(frequent.scalar()).alias("pos", "entry"))
        .select("run_id", "run_ts", (F.col("pos") + 1).alias("type_rank"), "entry.issue_type")
    )
    return (
        grid.join(counts, ["run_id", "run_ts", "issue_type"], "left")
        .select(
            "run_id", "run_ts", "type_rank", "issue_type",
            F.coalesce("issue_count", F.lit(0)).alias("issue_count"),
        )
        .orderBy("run_ts", "run_id", "type_rank")
    )


def score_trend(scores: DataFrame, by: Sequence[str] = ("dataset_name",)) -> DataFrame:
    """H8: scores in run order with the change since the previous run of the dataset."""
    in_order = Window.partitionBy(*by).orderBy("_ts", "run_id")
    return (
        with_run_time(scores)
        .withColumn("score_change", F.col("score") - F.lag("score").over(in_order))
        .drop("_ts")
    )
