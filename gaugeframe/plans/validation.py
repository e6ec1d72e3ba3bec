"""End-to-end runs: validate, score, gate and the follow-up history (O6, SC6, G8)."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from gaugeframe.config import GateSettings, RuleSet
from gaugeframe.operators import gate, outcomes, scoring
from gaugeframe.operators.rules import count_failures, findings
from gaugeframe.operators.samples import SAMPLE_LIMIT, sample_json, sample_rows
from gaugeframe.session import local_frame


@dataclass(frozen=True)
class Run:
    run_id: str
    dataset_name: str
    run_ts: str


@dataclass(frozen=True)
class Validation:
    """The outcome of one run, as lazy DataFrames.

    The tables are scanned once to count, when a result is first asked for. What comes back is
    one row per rule and a few offending keys, which become a local table that all results derive
    from. Samples take one more scan.
    """

    tables: Mapping[str, DataFrame]
    rules: RuleSet
    run: Run
    as_of: Column | None = None
    with_samples: bool = True

    @cached_property
    def found(self) -> list[Row]:
        """Counts per rule, and with samples at most SAMPLE_LIMIT offending keys of each."""
        if self.with_samples:
            return findings(self.tables, self.rules, self.as_of, SAMPLE_LIMIT).collect()
        counts = count_failures(self.tables, self.rules, self.as_of)
        return counts.withColumn("key", F.lit(None)).collect()

    @cached_property
    def judged(self) -> DataFrame:
        spark = next(iter(self.tables.values())).sparkSession
        rows = [
            (r["check_id"], r["failure_count"], r["total_rows"]) for r in self.found if r["key"] is None
        ]
        counts = local_frame(spark, rows, "check_id string, failure_count bigint, total_rows bigint")
        return outcomes.judge(counts, self.rules)

    @cached_property
    def checks(self) -> DataFrame:
        return outcomes.check_results(self.judged, self.run.run_id, self.run.dataset_name)

    @cached_property
    def issues(self) -> DataFrame:
        samples = None
        if self.with_samples:
            samples = sample_json(sample_rows(self.tables, self.rules, self.as_of, self.found))
        return outcomes.issue_log(
            self.judged, self.run.run_id, self.run.dataset_name, self.run.run_ts, samples
        )

    @cached_property
    def run_history(self) -> DataFrame:
        counts = outcomes.row_counts(self.tables)
        return outcomes.run_history(
            counts, self.run.run_id, self.run.run_ts, self.run.dataset_name
        )

    @cached_property
    def score(self) -> DataFrame:
        return scoring.score_record(
            self.checks, self.issues, self.run.run_id, self.run.run_ts,
            self.rules.baseline, self.rules.minimum,
        )

    @cached_property
    def dimension_scores(self) -> DataFrame:
        return scoring.dimension_scores(self.checks, self.rules.baseline, self.rules.minimum)

    def gate(self, settings: GateSettings) -> DataFrame:
        return gate.judge_checks(
            self.checks, settings, self.rules.baseline, self.rules.minimum
        )


def validate(
    tables: Mapping[str, DataFrame],
    rules: RuleSet,
    run: Run,
    as_of: Column | None = None,
    with_samples: bool = True,
) -> Validation:
    """O6"""
    return Validation(tables, rules, run, as_of, with_samples)


def validate_runs(
    tables: Mapping[str, DataFrame],
    rules: RuleSet,
    as_of: Column | None = None,
    by: tuple[str, ...] = ("run_id", "run_ts", "dataset_name"),
) -> DataFrame:
    """Many runs in one set of passes: judged checks per run.

    The tables with rules carry the run columns; referenced tables need not.
    """
    return outcomes.judge(count_failures(tables, rules, as_of, by), rules, by)


def daily_runs(df: DataFrame, time_column: str, dataset_name: str) -> DataFrame:
    """Makes every calendar day of a table a run."""
    day = F.col(time_column).cast("date").cast("string")
    return df.withColumns(
        {
            "run_id": F.concat(F.lit("run-"), day),
            "run_ts": F.concat(day, F.lit("T00:00:00")),
            "dataset_name": F.lit(dataset_name),
        }
    )
