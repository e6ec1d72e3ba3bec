"""Run metrics and their anomalies against earlier runs (A1-A10).

Two ways to use it:

* `detect` compares the current run of each dataset with a stored history, as happens after
  every run. Medians are plain aggregates; cost is linear in the history.
* `backtest` flags every run of a history against the runs before it. The only per-dataset
  order involved is over run metrics, one row per run, never over data rows. Running medians and
  deviations come from one sorted list per dataset, or per dataset and event type, in place of
  the earlier values of each run. Shares of types that a run lacks are not spelled out per run:
  between two occurrences a type's median is one interval, and intervals meet runs in blocks.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeframe.functions.stats import ratio
from gaugeframe.operators.history import with_run_time

COMPLETION = "complete"
SHIFT_THRESHOLD = 0.15
METRIC_COLUMNS = (
    "run_id", "run_ts", "dataset_name", "event_volume", "completion_count",
    "completion_rate", "event_type_counts", "event_type_distribution",
)
ANOMALY_COLUMNS = (
    "run_id", "metric", "metric_value", "baseline_value", "baseline_spread", "z_score",
    "threshold", "direction", "notes", "details", "dataset_name", "run_ts",
)


@dataclass(frozen=True)
class ValueTest:
    """Which metric is tested, how far it may move, and in which direction."""

    metric: str
    threshold: float = 3.0
    direction: str = "both"


VALUE_TESTS = (
    ValueTest("event_volume", 3.0, "both"),
    ValueTest("completion_rate", 3.0, "down"),
)


# ---------------------------------------------------------------- run metrics


def type_counts(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A2 in long form: (by..., event_type, event_count); a missing type is the empty text."""
    kind = F.coalesce("event_type", F.lit("")).alias("event_type")
    return events.select(*by, kind).groupBy(*by, "event_type").agg(F.count(F.lit(1)).alias("event_count"))


def metrics_of(types: DataFrame, by: Sequence[str] = (), completion: str = COMPLETION) -> DataFrame:
    """A1: the metrics of each run from its type counts, which are far fewer than its events.

    The maps of counts and shares are for the record of a run, which has one row. What tests
    shares reads the long form as well.
    """
    count = F.col("event_count")
    done = F.sum(F.when(F.col("event_type") == completion, count).otherwise(F.lit(0)))
    entries = F.array_sort(F.collect_list(F.struct("event_type", "event_count")))
    measures = [
        F.coalesce(F.sum(count), F.lit(0)).alias("event_volume"),
        F.coalesce(done, F.lit(0)).alias("completion_count"),
        entries.alias("_entries"),
    ]
    totals = types.groupBy(*by).agg(*measures) if by else types.agg(*measures)
    shares = F.transform(
        "_entries",
        lambda e: F.struct(
            e["event_type"].alias("key"),
            (e["event_count"].cast("double") / F.col("event_volume").cast("double")).alias("value"),
        ),
    )
    return totals.select(
        *by,
        "event_volume",
        "completion_count",
        ratio(F.col("completion_count"), F.col("event_volume")).alias("completion_rate"),
        F.map_from_entries("_entries").alias("event_type_counts"),
        F.map_from_entries(shares).alias("event_type_distribution"),
    )


def run_metrics(
    events: DataFrame, by: Sequence[str] = (), completion: str = COMPLETION
) -> DataFrame:
    """A1, A2: volume, completions and the share of every event type, per run."""
    return metrics_of(type_counts(events, by), by, completion)


def type_shares(metrics: DataFrame) -> DataFrame:
    """(dataset_name, run_id, run_ts, key, share) from metrics with maps, or from the long form."""
    run = ["dataset_name", "run_id", "run_ts"]
    if "event_count" in metrics.columns:
        total = F.sum("event_count").over(Window.partitionBy("dataset_name", "run_id", "run_ts"))
        share = F.col("event_count").cast("double") / total.cast("double")
        return metrics.select(*run, F.col("event_type").alias("key"), share.alias("share"))
    return metrics.select(*run, F.explode("event_type_distribution").alias("key", "share"))


def metrics_record(metrics: DataFrame) -> DataFrame:
    """The metrics as they are kept in the history: maps as JSON."""
    return metrics.select(
        *[
            F.to_json(c).alias(c) if c in ("event_type_counts", "event_type_distribution") else c
            for c in METRIC_COLUMNS
        ]
    )


def parse_metrics(history: DataFrame) -> DataFrame:
    """The inverse of `metrics_record`; unreadable JSON becomes NULL."""
    return history.withColumn(
        "event_type_counts", F.from_json("event_type_counts", "map<string,bigint>")
    ).withColumn(
        "event_type_distribution", F.from_json("event_type_distribution", "map<string,double>")
    )


# ---------------------------------------------------------------- tests


def _flag(test: ValueTest) -> Column:
    """A3, A4 on columns value, median, mad. Without variation any difference counts."""
    moved = F.col("value") != F.col("median")
    far = F.abs("z_score") >= test.threshold
    if test.direction == "down":
        far = far & (F.col("z_score") <= 0)
    return F.when(F.col("mad") == 0, moved).otherwise(far)


def _z_score() -> Column:
    return F.when(F.col("mad") != 0, (F.col("value") - F.col("median")) / F.col("mad"))


def _value_records(scored: DataFrame, test: ValueTest) -> DataFrame:
    """A10 for value anomalies."""
    still = F.format_string(
        f"{test.metric} deviated from median %.2f without variation.", F.col("median")
    )
    moved = F.format_string(
        f"{test.metric} moved {test.direction} to %.4f (median %.4f, mad %.4f).",
        F.col("value"), F.col("median"), F.col("mad"),
    )
    details = F.when(
        F.col("mad") == 0,
        F.to_json(F.struct("median", F.col("value").alias("current"), "mad")),
    ).otherwise(F.to_json(F.struct("median", "mad", "z_score")))
    return (
        scored.withColumn("z_score", _z_score())
        .where(_flag(test))
        .select(
            "run_id",
            F.lit(test.metric).alias("metric"),
            F.col("value").alias("metric_value"),
            F.col("median").alias("baseline_value"),
            F.col("mad").alias("baseline_spread"),
            "z_score",
            F.lit(test.threshold).alias("threshold"),
            F.lit(test.direction).alias("direction"),
            F.when(F.col("mad") == 0, still).otherwise(moved).alias("notes"),
            details.alias("details"),
            "dataset_name",
            "run_ts",
        )
    )


def _shift_records(deltas: DataFrame, threshold: float) -> DataFrame:
    """The largest change of any type's share; the smallest name wins a tie.

    `deltas` has run_id, run_ts, dataset_name, key, baseline and current, of one or more types.
    """
    return (
        deltas.groupBy("dataset_name", "run_id", "run_ts")
        .agg(_worst(F.abs(F.col("current") - F.col("baseline"))))
        .select(
            "dataset_name", "run_id", "run_ts", F.col("w.key").alias("category"),
            "w.baseline", "w.current", (-F.col("w.neg")).alias("delta"),
        )
        .where(F.col("delta") >= threshold)
        .select(
            "run_id",
            F.lit("event_type_distribution").alias("metric"),
            F.col("delta").alias("metric_value"),
            F.col("baseline").alias("baseline_value"),
            F.lit(threshold).alias("baseline_spread"),
            F.lit(None).cast("double").alias("z_score"),
            F.lit(threshold).alias("threshold"),
            F.lit("shift").alias("direction"),
            F.format_string(
                "Event type '%s' shifted by %.2f%% relative to baseline.",
                F.when(F.col("category") == "", "missing").otherwise(F.col("category")),
                F.col("delta") * 100,
            ).alias("notes"),
            F.to_json(F.struct("category", "baseline", "current", "delta")).alias("details"),
            "dataset_name",
            "run_ts",
        )
    )


# ---------------------------------------------------------------- current run against history


def _current(metrics: DataFrame, test: ValueTest) -> DataFrame:
    return metrics.select(
        "run_id", "run_ts", "dataset_name", F.col(test.metric).cast("double").alias("value")
    )


def value_anomalies(current: DataFrame, history: DataFrame, test: ValueTest) -> DataFrame:
    """The current run of each dataset against the stored runs of that dataset."""
    past = history.select("dataset_name", F.col(test.metric).cast("double").alias("x")).dropna()
    middle = past.groupBy("dataset_name").agg(F.median("x").alias("median"))
    spread = (
        past.join(middle, "dataset_name")
        .groupBy("dataset_name", "median")
        .agg(F.median(F.abs(F.col("x") - F.col("median"))).alias("mad"))
    )
    return _value_records(_current(current, test).join(spread, "dataset_name"), test)


def baseline_distribution(history: DataFrame) -> DataFrame:
    """Median share per event type over the runs in which the type occurs."""
    return (
        type_shares(history).groupBy("dataset_name", "key").agg(F.median("share").alias("baseline"))
    )


def distribution_shift(
    current: DataFrame, history: DataFrame, threshold: float = SHIFT_THRESHOLD
) -> DataFrame:
    """A8 for the current run of each dataset. Both sides as metrics or in long form."""
    base = baseline_distribution(history)
    now = type_shares(current)
    runs = now.select("dataset_name", "run_id", "run_ts").distinct()
    shares = now.select("dataset_name", "key", F.col("share").alias("current"))
    deltas = (
        shares.join(base, ["dataset_name", "key"], "full_outer")
        .fillna(0.0, ["current", "baseline"])
        .join(runs, "dataset_name")
        # No anomaly without a history of the dataset.
        .join(base.select("dataset_name").distinct(), "dataset_name", "left_semi")
    )
    return _shift_records(deltas, threshold)


def detect(
    current: DataFrame,
    history: DataFrame,
    tests: Sequence[ValueTest] = VALUE_TESTS,
    shift_threshold: float = SHIFT_THRESHOLD,
    types: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """All anomalies of the current runs (one per dataset) against their history.

    Both inputs have the columns of `run_metrics` plus run_id, run_ts and dataset_name. Call it
    before the current runs are appended to the history. `types` are the type counts of both in
    long form; without them, the metrics' maps are read.
    """
    parts = [value_anomalies(current, history, test) for test in tests]
    parts.append(distribution_shift(*(types or (current, history)), shift_threshold))
    return reduce(DataFrame.unionByName, parts).select(*ANOMALY_COLUMNS)


# ---------------------------------------------------------------- every run against earlier runs


def _kth(below: int, values: list[float], middle: float, k: int) -> float:
    """The k-th smallest (from 0) distance to `middle` of sorted values, `below` of them under it.

    Distances fall towards `middle` from the left and rise from it to the right; k + 1 of them
    split into some of either side, which a binary search finds.
    """
    left, right = below, len(values) - below
    low, high = max(0, k + 1 - right), min(k + 1, left)
    while low < high:
        take = (low + high) // 2
        if middle - values[below - 1 - take] < values[below + k - take] - middle:
            low = take + 1
        else:
            high = take
    ends = []
    if low:
        ends.append(middle - values[below - low])
    if k + 1 - low:
        ends.append(values[below + k - low] - middle)
    return max(ends)


class Running:
    """Median and unscaled MAD of the values added so far, which are kept sorted."""

    def __init__(self):
        self.values: list[float] = []

    def add(self, value: float) -> None:
        insort(self.values, value)

    def median(self) -> float | None:
        n = len(self.values)
        return (self.values[(n - 1) // 2] + self.values[n // 2]) / 2.0 if n else None

    def mad(self) -> float | None:
        n, middle = len(self.values), self.median()
        if middle is None:
            return None
        below = bisect_left(self.values, middle)
        return (_kth(below, self.values, middle, (n - 1) // 2) + _kth(below, self.values, middle, n // 2)) / 2.0


def prior_statistics(metrics: DataFrame, metric: str) -> DataFrame:
    """A3: per run, median and (unscaled) MAD of the metric over the dataset's earlier runs.

    Runs whose metric is NULL are judged like others but add nothing. A dataset's runs, one row
    each, are read in order by one task; its memory is the sorted list of their values.
    """

    def running(runs: pd.DataFrame) -> pd.DataFrame:
        runs, past = runs.sort_values(["_ts", "run_id"], na_position="first"), Running()
        medians, mads = [], []
        for value in runs["value"]:
            medians.append(past.median())
            mads.append(past.mad())
            if not pd.isna(value):
                past.add(value)
        return runs.assign(median=pd.array(medians, "Float64"), mad=pd.array(mads, "Float64"))

    columns = "run_id string, run_ts string, dataset_name string, _ts timestamp_ntz, value double"
    return (
        with_run_time(metrics)
        .select("run_id", "run_ts", "dataset_name", "_ts", F.col(metric).cast("double").alias("value"))
        .groupBy("dataset_name").applyInPandas(running, f"{columns}, median double, mad double")
        .where(F.col("median").isNotNull())
        .select("run_id", "run_ts", "dataset_name", "value", "median", "mad")
    )


def _numbered(metrics: DataFrame) -> DataFrame:
    """Metrics with the run's number `_no` in its dataset, from 1, and their number `_runs`."""
    in_order = Window.partitionBy("dataset_name").orderBy("_ts", "run_id")
    return with_run_time(metrics).withColumns(
        {
            "_no": F.row_number().over(in_order).cast("long"),
            "_runs": F.count(F.lit(1)).over(Window.partitionBy("dataset_name")),
        }
    )


def type_medians(numbered: DataFrame) -> DataFrame:
    """Every occurrence of a type (dataset_name, key, _no, _runs, current): its median share
    `before` it and `after` it, and the number of the next occurrence, `_until`."""

    def running(rows: pd.DataFrame) -> pd.DataFrame:
        rows, seen = rows.sort_values("_no"), Running()
        before, after = [], []
        for share in rows["current"]:
            before.append(seen.median())
            seen.add(share)
            after.append(seen.median())
        return rows.assign(
            before=pd.array(before, "Float64"), after=after,
            _until=pd.array([*rows["_no"].tolist()[1:], None], "Int64"),
        )

    columns = "dataset_name string, key string, _no long, _runs long, current double"
    return (
        numbered.select(
            "dataset_name", "_no", "_runs", F.explode("event_type_distribution").alias("key", "current")
        )
        .select("dataset_name", "key", "_no", "_runs", "current")
        .groupBy("dataset_name", "key")
        .applyInPandas(running, f"{columns}, before double, after double, _until long")
    )


def prior_baselines(metrics: DataFrame) -> DataFrame:
    """Per run and event type, the type's baseline over earlier runs and its share now.

    One row per run and type, for publishing baselines; `largest_shifts` tests without them.
    """
    numbered = _numbered(metrics)
    known = type_medians(numbered)
    # Runs after an occurrence up to and including the next one see this median.
    later = known.where(F.col("_no") < F.coalesce("_until", "_runs")).select(
        "dataset_name", "key", F.col("after").alias("baseline"),
        F.explode(F.sequence(F.col("_no") + 1, F.coalesce("_until", "_runs"))).alias("_no"),
    )
    shares = known.select("dataset_name", "key", "_no", "current")
    return (
        later.join(shares, ["dataset_name", "key", "_no"], "full_outer")
        .fillna(0.0, ["current", "baseline"])
        .join(_tested(numbered), ["dataset_name", "_no"])
        .drop("_no")
    )


def _tested(numbered: DataFrame) -> DataFrame:
    """Runs that have shares and a history to compare them with."""
    return numbered.where((F.col("_no") > 1) & (F.size("event_type_distribution") > 0)).select(
        "dataset_name", "_no", "run_id", "run_ts"
    )


# Blocks of 2^level runs; the largest covers any history.
_LEVELS = range(32)


def _covering(first: Column, end: Column) -> Column:
    """The aligned blocks (level, block) that make up the run numbers from `first` below `end`.

    At most two per level: where the range, in units of the level, begins or ends at an odd
    place, that place is a block of its own, and what remains doubles its unit.
    """
    blocks = []
    for level in _LEVELS:
        size = F.lit(1 << level).cast("long")
        low = F.floor((first + size - 1) / size).cast("long")
        high = F.floor(end / size).cast("long")
        inside = low < high
        for place, odd in ((low, low % 2 == 1), (high - 1, high % 2 == 1)):
            blocks.append(
                F.when(inside & odd, F.struct(F.lit(level).alias("_level"), place.alias("_block")))
            )
    return F.array_compact(F.array(*blocks))


def _worst(delta: Column) -> Column:
    """The largest change; the smallest name wins a tie."""
    return F.min(F.struct((-delta).alias("neg"), "key", "baseline", "current")).alias("w")


def largest_shifts(metrics: DataFrame) -> DataFrame:
    """Per run, the type whose share moved most from its median over earlier runs.

    (dataset_name, run_id, run_ts, key, baseline, current). Types that a run has are compared at
    their occurrences. A type that it lacks has fallen by its whole median, which holds from one
    occurrence to the next. These intervals are cut into at most 64 aligned blocks, of which the
    largest median is kept, and a run looks up the blocks it lies in: one per level.
    """
    numbered = _numbered(metrics)
    known = type_medians(numbered)
    present = known.where(F.col("_no") > 1).select(
        "dataset_name", "_no", "key", F.coalesce("before", F.lit(0.0)).alias("baseline"), "current"
    )
    of_run = present.groupBy("dataset_name", "_no").agg(_worst(F.abs(F.col("current") - F.col("baseline"))))
    end = F.coalesce("_until", F.col("_runs") + 1)
    absent = (
        known.select(
            "dataset_name", "key", F.col("after").alias("baseline"), F.lit(0.0).alias("current"),
            F.inline(_covering(F.col("_no") + 1, end)),
        )
        .groupBy("dataset_name", "_level", "_block").agg(_worst(F.col("baseline")))
    )
    levels = F.array(
        *[
            F.struct(F.lit(i).alias("_level"), F.floor(F.col("_no") / F.lit(1 << i)).cast("long").alias("_block"))
            for i in _LEVELS
        ]
    )
    tested = _tested(numbered)
    met = (
        tested.select("dataset_name", "_no", F.inline(levels))
        .join(absent, ["dataset_name", "_level", "_block"]).select("dataset_name", "_no", "w")
    )
    return (
        of_run.unionByName(met).groupBy("dataset_name", "_no").agg(F.min("w").alias("w"))
        .join(tested, ["dataset_name", "_no"])
        .select("dataset_name", "run_id", "run_ts", "w.key", "w.baseline", "w.current")
    )


def backtest(
    metrics: DataFrame,
    tests: Sequence[ValueTest] = VALUE_TESTS,
    shift_threshold: float = SHIFT_THRESHOLD,
) -> DataFrame:
    """A9 in batch form: the anomalies each run would have raised when it was the newest."""
    parts = [_value_records(prior_statistics(metrics, t.metric), t) for t in tests]
    parts.append(_shift_records(largest_shifts(metrics), shift_threshold))
    return reduce(DataFrame.unionByName, parts).select(*ANOMALY_COLUMNS)
