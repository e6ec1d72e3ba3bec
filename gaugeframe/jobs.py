"""Command line for spark-submit: one subcommand per step of a run."""

from __future__ import annotations

import argparse
import json
import sys
from datetime import datetime, timezone
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeframe import defaults
from gaugeframe.config import (
    load_expected_schema, load_gate_settings, load_root_causes, load_rules, load_vocabulary,
)
from gaugeframe.functions.timestamps import parse_timestamp, utc_now
from gaugeframe.operators import anomaly, drift, gate, history, outcomes, profile, scoring
from gaugeframe.operators.rules import skipped_report
from gaugeframe.plans.validation import Run, validate
from gaugeframe.session import configure
from gaugeframe.sources import exports, marts, synthetic


def _rules(spark: SparkSession, args):
    causes = load_root_causes(args.root_causes, spark) if args.root_causes else ()
    return load_rules(args.rules, causes, spark) if args.rules else defaults.RULES


def _mart(spark: SparkSession, args, name: str) -> DataFrame:
    return marts.read_mart(spark, f"{args.marts}/{name}")


def run_generate(spark: SparkSession, args) -> None:
    metadata = synthetic.run_metadata(args.dataset, args.seed)
    raw = synthetic.generate(spark, args.dataset, args.seed, args.copies)
    synthetic.write_dataset(raw, args.raw, metadata, args.force)
    print(metadata["run_id"])


def run_ingest(spark: SparkSession, args) -> None:
    words = load_vocabulary(args.mappings, spark) if args.mappings else defaults.VOCABULARY
    run_id = exports.ingest(
        spark, args.raw, args.stage, words, args.dataset, args.seed, args.force, args.run_id
    )
    print(run_id)


def run_profile(spark: SparkSession, args) -> None:
    """Two scans per table: one counts its values, one fetches the long texts among top values."""
    tables = exports.read_staged(spark, args.stage)

    def keep(name: str, counts: DataFrame) -> DataFrame:
        # As large as the distinct values are many, so each task writes its own file.
        path = f"{args.marts}/profiles/value_counts/{name}/{quote(args.run_id, safe='')}"
        counts.write.mode("overwrite").parquet(path)
        return spark.read.schema(counts.schema).parquet(path)

    results = profile.profile(tables, args.run_id, args.dataset, args.top_n, keep)
    for name, df in results.items():
        marts.write_run(df, f"{args.marts}/profiles/{name}")
    if args.sketches:
        for name, df in tables.items():
            sketches = profile.distinct_sketches(df, name).withColumn("run_id", F.lit(args.run_id))
            marts.write_run(sketches, f"{args.marts}/profiles/distinct_sketches/{name}", run_id=args.run_id)


def run_validate(spark: SparkSession, args) -> None:
    """Two scans per table give checks and issues; the rest is derived from marts or metrics.

    Drift is written first: a missing table is on record even though rules that need it fail.
    """
    tables = exports.read_staged(spark, args.stage)
    rules = _rules(spark, args)
    now = args.run_ts or datetime.now(timezone.utc).isoformat()
    run = Run(args.run_id, args.dataset, now)
    stamp = {
        "run_id": F.lit(run.run_id), "run_ts": F.lit(run.run_ts),
        "dataset_name": F.lit(run.dataset_name),
    }

    def write(df: DataFrame, name: str) -> None:
        marts.write_run(df, f"{args.marts}/{name}", run_id=run.run_id)

    declared = (
        load_expected_schema(args.expected_schema, spark) if args.expected_schema
        else defaults.EXPECTED_SCHEMA
    )
    actual = drift.actual_columns(spark, tables)
    drifting = drift.compare_schemas(drift.expected_columns(spark, declared), actual)
    write(drifting.withColumns(stamp), "dq_schema_drift")
    write(skipped_report(spark, rules, tables).withColumns(stamp), "dq_skipped_columns")

    as_of = F.coalesce(parse_timestamp(F.lit(now)), utc_now())
    validation = validate(tables, rules, run, as_of=as_of)
    marts.write_run(validation.checks, f"{args.marts}/dq_check_results")
    write(validation.issues, "dq_issue_history")
    marts.write_run(validation.run_history, f"{args.marts}/dq_run_history")
    write(outcomes.expectation_results(validation.checks).withColumns(stamp), "dq_expectation_results")
    write(outcomes.expectation_statistics(validation.checks).withColumns(stamp), "dq_expectation_statistics")
    write(gate.rule_summary(validation.checks).withColumns(stamp), "dq_rule_summary")
    top = history.recurrence(_mart(spark, args, "dq_issue_history"))
    write(top.withColumn("run_id", F.lit(run.run_id)), "dq_issue_recurrence")
    if "events" not in tables:
        return
    # Events are read once; metrics and tests start from the counts per type.
    write(anomaly.type_counts(tables["events"]).withColumns(stamp), "dq_event_types")

    def own_and_past(name: str) -> tuple[DataFrame, DataFrame]:
        known, own = _mart(spark, args, name), F.col("run_id") == run.run_id
        return known.where(own), known.where(~own)

    types = own_and_past("dq_event_types")
    record = anomaly.metrics_record(anomaly.metrics_of(types[0]).withColumns(stamp))
    marts.write_run(record, f"{args.marts}/dq_metrics_history")
    metrics = map(anomaly.parse_metrics, own_and_past("dq_metrics_history"))
    write(anomaly.detect(*metrics, types=types), "dq_anomalies")


def _run_results(spark: SparkSession, args) -> tuple[DataFrame, DataFrame]:
    checks = marts.read_run(spark, f"{args.marts}/dq_check_results", args.run_id)
    issues = marts.read_run(spark, f"{args.marts}/dq_issue_history", args.run_id)
    return checks, issues


def run_score(spark: SparkSession, args) -> None:
    checks, issues = _run_results(spark, args)
    rules = _rules(spark, args)
    past = _mart(spark, args, "dq_run_history")
    when = scoring.resolve_run_ts(past, issues, args.run_id).first().run_ts.isoformat()
    record = scoring.score_record(checks, issues, args.run_id, when, rules.baseline, rules.minimum)
    marts.write_run(record, f"{args.marts}/score_history")
    exports.write_csv(issues, f"{args.marts}/exports/issues/{args.run_id}")
    exports.write_csv(
        outcomes.exceptions(issues), f"{args.marts}/exports/exceptions/{args.run_id}"
    )
    print(json.dumps(marts.read_run(spark, f"{args.marts}/score_history", args.run_id).first().asDict()))


def run_gate(spark: SparkSession, args) -> None:
    checks, _ = _run_results(spark, args)
    settings = load_gate_settings(args.gate, spark) if args.gate else defaults.GATE
    scores = marts.read_run(spark, f"{args.marts}/score_history", args.run_id)
    verdict = gate.gate_verdict(scores, checks, settings).first()
    print(f"score {verdict.score:.2f}: {verdict.reason or 'passed'}")
    if not verdict.passed:
        sys.exit(1)


def run_lifecycle(spark: SparkSession, args) -> None:
    """With `--close-issues`, a later run without issues closes them: the run history tells."""
    issues = _mart(spark, args, "dq_issue_history")
    runs = _mart(spark, args, "dq_run_history") if args.close_issues else None
    history.issue_lifecycle(issues, runs=runs).write.mode("overwrite").parquet(
        f"{args.marts}/dq_issue_lifecycle"
    )


def run_metrics(spark: SparkSession, args) -> None:
    checks, issues = _run_results(spark, args)
    settings = load_gate_settings(args.gate, spark) if args.gate else defaults.GATE
    score = marts.read_run(spark, f"{args.marts}/score_history", args.run_id)
    stages = history.lifecycle_counts(spark.read.parquet(f"{args.marts}/dq_issue_lifecycle"))
    recurring = history.recurring_count(
        history.recurrence(_mart(spark, args, "dq_issue_history"), limit=None)
    )
    comparison = _comparison(spark, args, checks, issues) if args.baseline else None
    row = gate.project_metrics(
        score, checks, issues, stages, recurring, settings, comparison
    ).withColumns(
        {
            "generated_at": F.lit(datetime.now(timezone.utc).isoformat()),
            "workflow_run_id": F.lit(args.workflow_run_id),
            "workflow_attempt": F.lit(args.workflow_attempt),
        }
    )
    # A run's partition holds all of its attempts, so only that partition is merged. Replacing
    # it is safe: a dynamic overwrite moves new files in only after every task has finished.
    path = f"{args.marts}/project_metrics_history"
    if marts.path_exists(spark, path):
        row = marts.upsert_history(marts.read_run(spark, path, args.run_id), row)
    marts.write_run(row, path)


def _comparison(spark: SparkSession, args, checks: DataFrame, issues: DataFrame) -> DataFrame:
    rules = _rules(spark, args)
    baseline = json.loads(spark.read.text(args.baseline, wholetext=True).first()[0])
    actual = gate.measure_rows(
        scoring.overall_score(checks, rules.baseline, rules.minimum),
        scoring.dimension_scores(checks, rules.baseline, rules.minimum),
        scoring.issue_counts(issues),
        issues.agg(F.count(F.lit(1)).alias("failed_checks")),
    )
    return gate.compare_with_baseline(
        actual, gate.baseline_rows(spark, baseline), args.tolerance
    )


def run_compare(spark: SparkSession, args) -> None:
    comparison = _comparison(spark, args, *_run_results(spark, args))
    verdict = gate.match_verdict(comparison).first()
    print(verdict.reason or "matched")
    if not verdict.matched:
        sys.exit(1)


STEPS = {
    "generate": run_generate, "ingest": run_ingest, "profile": run_profile,
    "validate": run_validate, "score": run_score, "gate": run_gate,
    "lifecycle": run_lifecycle, "metrics": run_metrics, "compare": run_compare,
}


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="gaugeframe", description=__doc__)
    parser.add_argument("step", choices=list(STEPS))
    parser.add_argument("--dataset")
    parser.add_argument("--seed", type=int, default=42)
    parser.add_argument("--copies", type=int, default=1)
    parser.add_argument("--run-id")
    parser.add_argument("--run-ts")
    parser.add_argument("--raw")
    parser.add_argument("--stage")
    parser.add_argument("--marts")
    parser.add_argument("--rules")
    parser.add_argument("--root-causes")
    parser.add_argument("--mappings")
    parser.add_argument("--expected-schema")
    parser.add_argument("--gate")
    parser.add_argument("--baseline")
    parser.add_argument("--tolerance", type=float, default=0.01)
    parser.add_argument("--top-n", type=int, default=profile.TOP_VALUES)
    parser.add_argument("--close-issues", action="store_true")
    parser.add_argument("--sketches", action="store_true")
    parser.add_argument("--workflow-run-id", default="local")
    parser.add_argument("--workflow-attempt", default="local")
    parser.add_argument("--force", action="store_true")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    spark = configure(SparkSession.builder.appName(f"gaugeframe-{args.step}")).getOrCreate()
    run_step(spark, args)


def run_step(spark: SparkSession, args: argparse.Namespace) -> None:
    """Steps after ingest take the run id and dataset name from the staged tables by default."""
    if args.step not in ("generate", "ingest") and args.stage:
        known = exports.read_run_metadata(spark, args.stage)
        args.run_id = args.run_id or known.get("run_id")
        args.dataset = args.dataset or known.get("dataset_name")
    if args.step not in ("generate", "ingest", "lifecycle") and not args.run_id:
        raise SystemExit("A run id is required")
    args.dataset = args.dataset or "phase1"
    STEPS[args.step](spark, args)


if __name__ == "__main__":
    main()
