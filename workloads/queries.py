"""The registered queries, each a callable (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeframe import defaults
from gaugeframe.config import GateSettings, Rule
from gaugeframe.functions.text import canonicalise_by_table
from gaugeframe.functions.timestamps import parse_timestamp
from gaugeframe.operators import anomaly, drift, gate, history, outcomes, profile, scoring
from gaugeframe.operators.cleaning import clean_table
from gaugeframe.operators.rules import count_failures
from gaugeframe.operators.samples import failing_rows, negative_rows, sample_rows
from gaugeframe.plans.validation import Run, daily_runs, validate, validate_runs
from gaugeframe.sources import marts
from gaugeframe.sources.synthetic import stable_id
from workloads.views import raw, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = "2024-01-25 00:00:00"
RUN_ID, RUN_TS, DATASET = "run-1", "2024-01-25T00:00:00", "phase1"
RUN = Run(RUN_ID, DATASET, RUN_TS)
GATE = GateSettings(score_threshold=90.0, critical_severity=5.0)


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def as_of() -> F.Column:
    return F.lit(AS_OF).cast("timestamp_ntz")


def staged(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five spoiled tables, cleaned. `view_count` gives the column sweep something to see."""
    return {
        name: clean_table(
            raw(spark, sf_dir, name), name, defaults.VOCABULARY,
            keep=("view_count",) if name == "resources" else (),
        )
        for name in ("users", "districts", "resources", "events", "newsletter")
    }


# ---------------------------------------------------------------- cleaning


def _clean_query(name: str) -> None:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return clean_table(raw(spark, sf_dir, name), name, defaults.VOCABULARY)

    QUERIES[f"clean_{name}"] = build


for _name in ("users", "districts", "resources", "events", "newsletter"):
    _clean_query(_name)


@query
def stable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IO12: name-based ids for every order."""
    key = F.col("o_orderkey").cast("string")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", stable_id("order", key, "phase1", 42).alias("stable_id")
    )


def _canonical_segments(spark: SparkSession, sf_dir: str, **limits: int) -> DataFrame:
    """Orders' customers by name, a third of them one name, replaced by their segment."""
    name = F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    hot = F.when(F.col("o_orderkey") % 3 == 0, F.lit(" customer#000000001 ")).otherwise(name)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", hot.alias("customer"))
    known = table(spark, sf_dir, "customer").where("c_custkey % 5 <> 0").select(
        F.lower("c_name").alias("alias"), F.col("c_mktsegment").alias("canonical")
    )
    return canonicalise_by_table(orders, "customer", known, F.lit("unknown"), **limits)


@query
def canonical_by_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _canonical_segments(spark, sf_dir)


@query
def canonical_by_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _canonical_segments(spark, sf_dir, map_rows=0)


@query
def canonical_by_split_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CL3 as for a vocabulary too large to broadcast; one alias holds a third of the rows."""
    return _canonical_segments(spark, sf_dir, map_rows=0, broadcast_bytes=0)


# How the time of an order is spelled, in turn by its key.
TIME_SPELLINGS = (
    "yyyyMMdd", "yyyyMMdd'T'HHmmss", "yyyyMMdd HH:mm", "yyyy-MM-dd'T'HH", "yyyy-MM-dd h a",
    "d-MMM-yy", "EEE, dd MMM yyyy HH:mm:ss 'GMT'", "EEE MMM d yyyy HH:mm", "HH:mm yyyy-MM-dd",
    "d MMMM yyyy 'at' h:mm a", "yyyy-MM-dd HH:mm:ss 'EST'",
)


@query
def parsed_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CL8: every order's day, with a time made from its key, written in one of many spellings."""
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp_ntz")
    moment = F.date_trunc("day", day).cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), key % 86400
    )
    spelled = F.coalesce(*[
        F.when(key % len(TIME_SPELLINGS) == i, F.date_format(moment, pattern))
        for i, pattern in enumerate(TIME_SPELLINGS)
    ])
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", parse_timestamp(spelled).alias("parsed")
    )


# ---------------------------------------------------------------- single rules


def _outcome(tables: dict[str, DataFrame], *rules: Rule) -> DataFrame:
    judged = outcomes.judge(count_failures(tables, rules, as_of()), rules)
    return judged.select(
        "check_id", "issue_type", "failure_count", "total_rows", "failure_rate", "status", "penalty"
    )


def _rule(check_id: str, table_name: str, kind: str, *args: str, **more) -> Rule:
    return Rule(
        check_id, table_name, "test", kind, args, severity=3, weight=1.5, warning=0.01, fail=0.05,
        **more,
    )


@query
def rule_null_percentage(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = staged(spark, sf_dir)
    return _outcome(
        tables,
        _rule("users_email", "users", "NULL_PERCENTAGE", columns=("email",)),
        _rule("users_state", "users", "NULL_PERCENTAGE", columns=("state",)),
        _rule("events_ts", "events", "NULL_PERCENTAGE", columns=("event_ts",)),
    )


@query
def rule_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = staged(spark, sf_dir) | {"documents": table(spark, sf_dir, "documents")}
    return _outcome(
        tables,
        _rule("email_format", "users", "PATTERN", r"^[^\s@]+@[^\s@]+\.[^\s@]+$", columns=("email",)),
        _rule("state_code", "users", "PATTERN", "^[A-Z]{2}$", columns=("state",)),
        _rule("has_digit", "documents", "PATTERN", "[0-9]", columns=("text",)),
    )


@query
def rule_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {
        "orders": table(spark, sf_dir, "orders"), "lineitem": table(spark, sf_dir, "lineitem"),
        "events": table(spark, sf_dir, "events"),
    }
    return _outcome(
        tables,
        _rule("orders", "orders", "DATE_RANGE", "1996-01-01T00:00:00Z", "2000-12-31T00:00:00Z",
              columns=("o_orderdate",)),
        _rule("shipped", "lineitem", "DATE_RANGE", "1995-06-01", "now", columns=("l_shipdate",)),
        _rule("events", "events", "DATE_RANGE", "1900-01-01T00:00:00Z", "now", columns=("ts",)),
    )


@query
def rule_non_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {n: table(spark, sf_dir, n) for n in ("customer", "supplier", "part", "lineitem")}
    return _outcome(
        tables,
        _rule("balances", "*", "NON_NEGATIVE_COUNTS", column_regex="acctbal$"),
        _rule("quantities", "*", "NON_NEGATIVE_COUNTS", column_regex="(size|QUANTITY|price)"),
        _rule("nothing", "*", "NON_NEGATIVE_COUNTS", column_regex="no_such_column"),
    )


@query
def rule_timestamp_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = _rule("order", "newsletter", "TIMESTAMP_ORDER",
                 columns=("subscribed_at", "opened_at", "clicked_at"))
    return _outcome({"newsletter": staged(spark, sf_dir)["newsletter"]}, rule)


@query
def rule_enum(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = staged(spark, sf_dir) | {"orders": table(spark, sf_dir, "orders")}
    return _outcome(
        tables,
        _rule("role", "users", "ENUM", "student", "Teacher", "admin", "district_admin", "other",
              columns=("role",)),
        _rule("grade", "resources", "ENUM", "PreK-2", "3-5", "6-8", "9-12", columns=("grade_band",)),
        _rule("priority", "orders", "ENUM", "1-urgent", "2-HIGH", "3-MEDIUM",
              columns=("o_orderpriority",)),
    )


@query
def rule_unique_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = staged(spark, sf_dir) | {
        "lineitem": table(spark, sf_dir, "lineitem"), "events": table(spark, sf_dir, "events"),
    }
    return _outcome(
        tables,
        _rule("district_names", "districts", "UNIQUE_MAPPING", "district_name", "district_id"),
        _rule("part_supplier", "lineitem", "UNIQUE_MAPPING", "l_partkey", "l_suppkey"),
        _rule("line_flag", "lineitem", "UNIQUE_MAPPING", "l_returnflag", "l_linestatus"),
        _rule("event_user", "events", "UNIQUE_MAPPING", "event_id", "user_id"),
    )


@query
def rule_duplicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = staged(spark, sf_dir) | {"documents": table(spark, sf_dir, "documents")}
    return _outcome(
        tables,
        _rule("email", "users", "DUPLICATE_PERCENTAGE", columns=("email",)),
        _rule("event_id", "events", "DUPLICATE_PERCENTAGE", columns=("event_id",)),
        _rule("text", "documents", "DUPLICATE_PERCENTAGE", columns=("text",)),
    )


@query
def rule_duplicate_compound(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {
        "lineitem": table(spark, sf_dir, "lineitem"), "users": staged(spark, sf_dir)["users"],
    }
    return _outcome(
        tables,
        _rule("lines", "lineitem", "DUPLICATE_PERCENTAGE", columns=("l_orderkey", "l_linenumber")),
        _rule("flags", "lineitem", "DUPLICATE_PERCENTAGE", columns=("l_returnflag",)),
        _rule("supplied", "lineitem", "UNIQUE_MAPPING", "l_orderkey", "l_linenumber"),
        _rule("email_org", "users", "DUPLICATE_PERCENTAGE", columns=("email", "org_id")),
    )


@query
def rule_foreign_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = staged(spark, sf_dir) | {
        n: table(spark, sf_dir, n) for n in ("lineitem", "orders", "labels", "documents")
    }
    return _outcome(
        tables,
        _rule("event_user", "events", "FK", "users.user_id", columns=("user_id",)),
        _rule("event_resource", "events", "FK", "resources.resource_id", columns=("resource_id",)),
        _rule("user_district", "users", "FK", "districts.district_id", columns=("district_id",)),
        _rule("line_order", "lineitem", "FK", "orders.o_orderkey", columns=("l_orderkey",)),
        _rule("document_label", "documents", "FK", "labels.doc_id", columns=("doc_id",)),
    )


# ---------------------------------------------------------------- failing rows


@query
def rule_pattern_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failing_rows(staged(spark, sf_dir), defaults.RULES.only("users_email_format").rules[0])


@query
def rule_fk_failing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failing_rows(staged(spark, sf_dir), defaults.RULES.only("events_user_fk").rules[0])


@query
def rule_unique_mapping_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {"lineitem": table(spark, sf_dir, "lineitem")}
    rule = _rule("part_supplier", "lineitem", "UNIQUE_MAPPING", "l_partkey", "l_suppkey")
    return failing_rows(tables, rule)


@query
def rule_unique_mapping_rows_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flag holds half of all rows and maps to two statuses; the other two are clean."""
    tables = {"lineitem": table(spark, sf_dir, "lineitem")}
    rule = _rule("flag_status", "lineitem", "UNIQUE_MAPPING", "l_returnflag", "l_linestatus")
    return failing_rows(tables, rule)


@query
def rule_fk_rows_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flag holds half of all rows and is unknown to the referenced table."""
    lines = table(spark, sf_dir, "lineitem")
    tables = {"lineitem": lines, "returned": lines.where("l_returnflag <> 'N'")}
    rule = _rule("flag", "lineitem", "FK", "returned.l_returnflag", columns=("l_returnflag",))
    return failing_rows(tables, rule)


@query
def rule_duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of several equal-keyed rows gets which rank is free; keys and ranks are not."""
    tables = {"lineitem": table(spark, sf_dir, "lineitem")}
    rule = _rule("lines", "lineitem", "DUPLICATE_PERCENTAGE", columns=("l_orderkey", "l_linenumber"))
    return failing_rows(tables, rule).select("l_orderkey", "l_linenumber", "dq_rank")


@query
def rule_duplicate_rows_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three keys hold all rows."""
    tables = {"lineitem": table(spark, sf_dir, "lineitem")}
    rule = _rule("flags", "lineitem", "DUPLICATE_PERCENTAGE", columns=("l_returnflag",))
    return failing_rows(tables, rule).select("l_returnflag", "dq_rank")


@query
def rule_negative_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negative_rows(table(spark, sf_dir, "customer"), ["c_acctbal"]).select(
        "c_custkey", "c_acctbal", "failed_column"
    )


@query
def rule_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_rows(staged(spark, sf_dir), defaults.RULES, as_of())


# ---------------------------------------------------------------- outcomes and scores


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = count_failures(staged(spark, sf_dir), defaults.RULES, as_of())
    return outcomes.judge(counts, defaults.RULES)


def _checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcomes.check_results(_judged(spark, sf_dir), RUN_ID, DATASET)


def _issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcomes.issue_log(_judged(spark, sf_dir), RUN_ID, DATASET, RUN_TS)


def _run(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Checks and issues for queries that read them several times: the tables are scanned once."""
    v = validate(staged(spark, sf_dir), defaults.RULES, RUN, as_of(), with_samples=False)
    return v.checks, v.issues


@query
def check_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = F.array_join("columns", ",").alias("columns")
    return _checks(spark, sf_dir).withColumn("columns", columns)


@query
def issue_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate(staged(spark, sf_dir), defaults.RULES, RUN, as_of()).issues


@query
def exceptions_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = validate(staged(spark, sf_dir), defaults.RULES, RUN, as_of())
    return outcomes.exceptions(v.issues)


@query
def expectation_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcomes.expectation_statistics(_checks(spark, sf_dir))


@query
def expectation_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcomes.expectation_results(_checks(spark, sf_dir))


@query
def run_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("customer", "orders", "lineitem", "events", "documents", "pages")
    counts = outcomes.row_counts({n: table(spark, sf_dir, n) for n in names})
    return outcomes.run_history(counts, RUN_ID, RUN_TS, DATASET)


@query
def score_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.overall_score(_checks(spark, sf_dir))


@query
def score_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = scoring.dimension_scores(_checks(spark, sf_dir))
    return scoring.ranked_dimension_scores(scores)


@query
def score_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks, issues = _run(spark, sf_dir)
    return scoring.score_record(checks, issues, RUN_ID, RUN_TS)


@query
def check_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.check_summary(_checks(spark, sf_dir))


@query
def issue_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.issue_preview(_issues(spark, sf_dir))


@query
def issue_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.issue_counts(_issues(spark, sf_dir))


# ---------------------------------------------------------------- gate and project metrics


@query
def gate_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdict = gate.judge_checks(_checks(spark, sf_dir), GATE)
    return verdict.withColumn("critical_checks", F.array_join("critical_checks", ", "))


@query
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.status_counts(_checks(spark, sf_dir))


@query
def critical_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.critical_failures(_checks(spark, sf_dir), GATE)


@query
def root_cause_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.issue_measures(_issues(spark, sf_dir))


@query
def rule_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.rule_summary(_checks(spark, sf_dir))


@query
def rule_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.rule_totals(_checks(spark, sf_dir))


BASELINE = {
    "score": 98.22,
    "failed_checks": 5,
    "issue_counts": {"duplicate": 3, "missing": 2},
    "subscores": {
        "completeness": 97.7, "validity_accuracy": 100.0, "consistency": 100.0,
        "uniqueness": 94.41, "integrity": 100.0, "timeliness": 99.0,
    },
}


def _compared(checks: DataFrame, issues: DataFrame) -> DataFrame:
    actual = gate.measure_rows(
        scoring.overall_score(checks),
        scoring.dimension_scores(checks),
        scoring.issue_counts(issues),
        issues.agg(F.count(F.lit(1)).alias("failed_checks")),
    )
    baseline = gate.baseline_rows(checks.sparkSession, BASELINE)
    return gate.compare_with_baseline(actual, baseline)


@query
def baseline_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compared(*_run(spark, sf_dir))


@query
def baseline_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.match_verdict(_compared(*_run(spark, sf_dir)))


@query
def project_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks, issues = _run(spark, sf_dir)
    past = _kept_issues(spark, sf_dir)
    comparison = _compared(checks, issues)
    return gate.project_metrics(
        scoring.score_record(checks, issues, RUN_ID, RUN_TS), checks, issues,
        history.lifecycle_counts(history.issue_lifecycle(past)),
        history.recurring_count(history.recurrence(past, limit=None)), GATE, comparison,
    )


@query
def history_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily metrics written twice: a first attempt, then a repeat that knows one column more."""
    events = daily_runs(table(spark, sf_dir, "events"), "ts", DATASET).withColumn(
        "workflow_run_id", F.concat(F.lit("w"), F.col("user_id") % 5)
    )
    grouped = events.groupBy("run_id", "workflow_run_id")
    first = grouped.agg(F.count(F.lit(1)).alias("total_events")).withColumns(
        {"workflow_attempt": F.lit("1"), "generated_at": F.lit("2024-02-01T00:00:00")}
    )
    repeat = (
        events.where(F.col("run_id") >= "run-2024-01-15")
        .groupBy("run_id", "workflow_run_id")
        .agg(
            (F.count(F.lit(1)) * 10).alias("total_events"),
            F.count_if(F.col("event_type") == "error").alias("errors"),
        )
        .withColumns({"workflow_attempt": F.lit("1"), "generated_at": F.lit("2024-02-02T00:00:00")})
    )
    return marts.upsert_history(first, repeat)


# ---------------------------------------------------------------- history: every day is a run

def _daily_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rules over all tables, for every day on which rows of a table arrive."""
    runs = {}
    for name in ("users", "districts", "resources", "events", "newsletter"):
        keep = ("day", "view_count") if name == "resources" else ("day",)
        df = clean_table(raw(spark, sf_dir, name), name, defaults.VOCABULARY, keep=keep)
        runs[name] = daily_runs(df, "day", DATASET).drop("day")
    return validate_runs(runs, defaults.RULES, as_of())


def _daily_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = _daily_checks(spark, sf_dir)
    return outcomes.issue_log(judged, F.col("run_id"), F.col("dataset_name"), F.col("run_ts"))


def _kept_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history where it is read several times; elsewhere it would be a mart.

    A checkpoint, as a persisted plan of grouping sets is not found again from within a scalar
    subquery, which then repeats all its scans. Without a checkpoint folder executors keep it.
    """
    issues = _daily_issues(spark, sf_dir)
    return issues.checkpoint() if spark.sparkContext.getCheckpointDir() else issues.localCheckpoint()


@query
def issue_history_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily_issues(spark, sf_dir)


@query
def recurrence_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.recurrence(_daily_issues(spark, sf_dir))


@query
def recurring_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.recurring_count(
        history.recurrence(_daily_issues(spark, sf_dir), limit=None)
    )


@query
def issue_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.issue_lifecycle(_kept_issues(spark, sf_dir))


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run history of the days on which events happened, each noted twice by three datasets."""
    events = daily_runs(table(spark, sf_dir, "events"), "ts", DATASET)
    days = events.groupBy("run_id", "run_ts", (F.col("user_id") % 3).alias("part")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return days.select(
        "run_id", F.regexp_replace("run_ts", "00:00:00", F.concat(F.lit("0"), F.col("part"), F.lit(":00:00"))).alias("run_ts"),
        F.concat(F.lit("tenant-"), "part").alias("dataset_name"),
        F.to_json(F.create_map(F.lit("events"), "n")).alias("total_rows_by_table"),
    )


@query
def issue_lifecycle_by_run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H2 with a run history: issues of the last event days are open, if none ran after them."""
    return history.issue_lifecycle(_kept_issues(spark, sf_dir), runs=_days(spark, sf_dir))


@query
def last_run_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IO8: the latest of the rows that the history has of a run."""
    return scoring.last_run(_days(spark, sf_dir), "run-2024-01-05")


@query
def run_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC7: from the run history, or, for a run it does not know, from the run's issues."""
    days, issues = _days(spark, sf_dir), _kept_issues(spark, sf_dir)
    known = days.where("run_id <> 'run-2024-01-06'")
    return _united([
        scoring.resolve_run_ts(known, issues, f"run-2024-01-0{i}").withColumn("day", F.lit(i)) for i in (5, 6)
    ])


@query
def lifecycle_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.lifecycle_counts(history.issue_lifecycle(_kept_issues(spark, sf_dir)))


@query
def issue_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.issue_totals(_daily_issues(spark, sf_dir))


@query
def issue_trend_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.trend_matrix(_kept_issues(spark, sf_dir))


@query
def score_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = scoring.overall_score(
        _daily_checks(spark, sf_dir), by=("run_id", "run_ts", "dataset_name")
    )
    return history.score_trend(scores)


# ---------------------------------------------------------------- anomalies: every day is a run


def _tenant_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three datasets with a run per day."""
    return daily_runs(table(spark, sf_dir, "events"), "ts", DATASET).withColumn(
        "dataset_name", F.concat(F.lit("tenant-"), F.col("user_id") % 3)
    )


def _tenant_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases play the part of completions."""
    return anomaly.run_metrics(
        _tenant_events(spark, sf_dir), ("run_id", "run_ts", "dataset_name"), completion="purchase"
    )


@query
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomaly.metrics_record(_tenant_metrics(spark, sf_dir))


@query
def event_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 in long form."""
    run = ("run_id", "run_ts", "dataset_name")
    counts = anomaly.type_counts(_tenant_events(spark, sf_dir), run)
    shares = anomaly.type_shares(counts).withColumnRenamed("key", "event_type")
    return counts.join(shares, [*run, "event_type"]).drop("run_ts")


def _kept_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics history, one row per run, where it is read several times."""
    return _tenant_metrics(spark, sf_dir).persist()




@query
def anomaly_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    test = anomaly.ValueTest("event_volume", 3.0, "both")
    found = anomaly.backtest(_kept_metrics(spark, sf_dir), [test], 2.0)
    return found


@query
def anomaly_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    test = anomaly.ValueTest("completion_rate", 2.0, "down")
    found = anomaly.backtest(_kept_metrics(spark, sf_dir), [test], 2.0)
    return found


@query
def distribution_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomaly.prior_baselines(_kept_metrics(spark, sf_dir))


@query
def anomaly_distribution_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = anomaly.backtest(_kept_metrics(spark, sf_dir), [], 0.05)
    return found


@query
def anomaly_current_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last day against all days before it."""
    metrics = _kept_metrics(spark, sf_dir)
    last = metrics.agg(F.max("run_id")).scalar()
    current, past = metrics.where(F.col("run_id") == last), metrics.where(F.col("run_id") < last)
    tests = [anomaly.ValueTest("event_volume", 0.5), anomaly.ValueTest("completion_rate", 0.5, "down")]
    return anomaly.detect(current, past, tests, 0.02)


# ---------------------------------------------------------------- schema drift

# Declared on purpose not quite as the tables are.
DECLARED = {
    "customer": {
        "c_custkey": "bigint", "c_name": "string", "c_nationkey": "integer",
        "c_acctbal": "decimal", "c_phone": "string",
    },
    "orders": {
        "o_orderkey": "integer", "o_custkey": "bigint", "o_orderstatus": "enum",
        "o_totalprice": "double", "o_orderdate": "timestamp", "o_orderpriority": "string",
    },
    "events": {
        "event_id": "bigint", "ts": "timestamp", "user_id": "uuid", "event_type": "enum",
        "value": "double", "props": "string",
    },
    "labels": {"doc_id": "bigint", "quality": "int", "toxic": "int"},
    "payments": {"payment_id": "uuid", "amount": "decimal"},
}
DRIFT_TABLES = ("customer", "orders", "events", "labels", "supplier")


def _schemas(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    tables = {n: table(spark, sf_dir, n) for n in DRIFT_TABLES}
    return (
        drift.expected_columns(spark, DECLARED),
        drift.actual_columns(spark, tables),
        outcomes.row_counts(tables),
    )


@query
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drifting tables, and how many rows each holds."""
    expected, actual, counts = _schemas(spark, sf_dir)
    drifting = drift.compare_schemas(expected, actual).join(counts, "table_name", "left")
    return drifting.select(
        "table_name", "missing_columns", "new_columns", "type_changes", "notes",
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
    )


@query
def schema_type_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected, actual, counts = _schemas(spark, sf_dir)
    return drift.type_changes(expected, actual).join(counts, "table_name")


@query
def stage_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {n: table(spark, sf_dir, n) for n in DRIFT_TABLES}
    return drift.stage_catalogue(tables, outcomes.row_counts(tables))


# ---------------------------------------------------------------- profiles

PROFILED = ("customer", "part", "orders", "lineitem", "events", "documents", "labels")


def _united(frames: list[DataFrame]) -> DataFrame:
    united = frames[0]
    for frame in frames[1:]:
        united = united.unionByName(frame)
    return united


def _profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _united([profile.column_profiles(table(spark, sf_dir, n), n) for n in PROFILED])


@query
def profile_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profiles(spark, sf_dir)


@query
def profile_top_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _united([profile.top_values(table(spark, sf_dir, n), n) for n in PROFILED])


@query
def profile_distinct_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sketch per column and day, merged over all days, beside the exact count: within 5 %."""
    events = daily_runs(table(spark, sf_dir, "events"), "ts", DATASET).drop("run_ts", "dataset_name")
    kept = profile.distinct_sketches(events, "events", ["run_id"])
    estimates = profile.distinct_estimates(kept).drop("ordinal")
    exact = profile.column_profiles(table(spark, sf_dir, "events"), "events")
    off = F.abs(F.col("distinct_estimate") - F.col("distinct_count"))
    return exact.join(estimates, ["table_name", "column_name"]).select(
        "table_name", "column_name", "distinct_count",
        (off <= F.col("distinct_count") * 0.05).alias("within_bound"),
    )


@query
def profile_type_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order statuses and districts do not mix; the raw time and balance texts do."""
    mixed = table(spark, sf_dir, "customer").select(
        F.when(F.col("c_custkey") % 3 == 0, F.col("c_acctbal").cast("string"))
        .when(F.col("c_custkey") % 7 == 0, F.concat(F.lit(" "), F.col("c_custkey"), F.lit(" ")))
        .otherwise(F.col("c_name"))
        .alias("contact"),
        F.col("c_mktsegment"),
        F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey").cast("string")).alias("number"),
    )
    return profile.type_issues(mixed, "contacts").select(
        "table_name", "column_name", "issue", "details.numeric_values", "details.non_numeric_values"
    )


@query
def profile_table_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = staged(spark, sf_dir)
    cleaned = [profile.column_profiles(clean[n], f"clean_{n}") for n in ("users", "resources")]
    return profile.table_summaries(_united([_profiles(spark, sf_dir), *cleaned]))
