import random
from statistics import median

import pytest
from pyspark.sql import functions as F

from gaugeframe.operators import anomaly, profile
from gaugeframe.session import local_frame

METRIC = ("run_id string, run_ts string, dataset_name string, event_volume bigint, "
          "completion_count bigint, completion_rate double, event_type_counts map<string,bigint>, "
          "event_type_distribution map<string,double>")


def runs(spark, volumes, rates=None, shares=None, dataset="d", first=0):
    rows = []
    for i, volume in enumerate(volumes):
        share = (shares or [{"a": 1.0}] * len(volumes))[i]
        rate = (rates or [0.5] * len(volumes))[i]
        rows.append((f"r{first + i:02d}", f"2024-01-{first + i + 1:02d}T00:00:00", dataset, volume, 0, rate,
                     {k: 1 for k in share}, share))
    return local_frame(spark, rows, METRIC)


def test_run_metrics(spark):
    events = local_frame(spark, [("complete",), ("view",), (None,), ("",)], "event_type string")
    row = anomaly.run_metrics(events).first()
    assert (row.event_volume, row.completion_count, row.completion_rate) == (4, 1, 0.25)
    assert row.event_type_counts == {"complete": 1, "view": 1, "": 2}
    assert row.event_type_distribution[""] == 0.5
    empty = anomaly.run_metrics(events.limit(0)).first()
    assert (empty.event_volume, empty.completion_rate, empty.event_type_counts) == (0, 0.0, {})


def test_metrics_survive_their_json_form(spark):
    kept = anomaly.metrics_record(runs(spark, [1, 2], shares=[{"a": 0.25, "": 0.75}, {"b": 1.0}]))
    back = anomaly.parse_metrics(kept).orderBy("run_id").collect()
    assert back[0].event_type_distribution == {"a": 0.25, "": 0.75}
    bad = kept.withColumn("event_type_distribution", F.lit("not json"))
    assert anomaly.parse_metrics(bad).first().event_type_distribution is None


def test_value_anomaly(spark):
    past = runs(spark, [10, 12, 11, 13, 9])
    found = anomaly.detect(runs(spark, [30], first=9), past).collect()
    assert [(r.metric, r.baseline_value, r.baseline_spread, r.z_score) for r in found] == [
        ("event_volume", 11.0, 1.0, 19.0)]
    assert found[0].notes == "event_volume moved both to 30.0000 (median 11.0000, mad 1.0000)."
    assert anomaly.detect(runs(spark, [12], first=9), past).count() == 0
    assert anomaly.detect(runs(spark, [30], first=9, dataset="other"), past).count() == 0


def test_no_variation_flags_any_difference_in_any_direction(spark):
    past = runs(spark, [10, 10, 10], rates=[0.5, 0.5, 0.5])
    found = anomaly.detect(runs(spark, [10], rates=[0.9], first=9), past).collect()
    assert [(r.metric, r.z_score, r.direction) for r in found] == [("completion_rate", None, "down")]
    assert "without variation" in found[0].notes


def test_down_ignores_rises(spark):
    past = runs(spark, [5] * 4, rates=[0.4, 0.5, 0.6, 0.5])
    low = anomaly.detect(runs(spark, [5], rates=[0.0], first=9), past).collect()
    high = anomaly.detect(runs(spark, [5], rates=[1.0], first=9), past).collect()
    assert [r.metric for r in low] == ["completion_rate"] and high == []


def test_distribution_shift(spark):
    past = runs(spark, [1, 1, 1], shares=[{"a": 0.5, "b": 0.5}, {"a": 0.6, "b": 0.4}, {"b": 1.0}])
    now = runs(spark, [1], shares=[{"b": 0.6, "": 0.4}], first=9)
    row = anomaly.distribution_shift(now, past).first()
    # a: median over the runs that have it, 0.55, and nothing now.
    assert (row.baseline_value, row.metric_value, row.direction) == (0.55, 0.55, "shift")
    assert row.notes == "Event type 'a' shifted by 55.00% relative to baseline."
    same = runs(spark, [1], shares=[{"a": 0.5, "b": 0.5}], first=9)
    assert anomaly.distribution_shift(same, past).count() == 0
    nothing = runs(spark, [0], shares=[{}], first=9)
    assert anomaly.distribution_shift(nothing, past).count() == 0


def test_backtest_equals_one_detection_per_run(spark):
    volumes = [10, 11, 10, 40, 12, 10, 11, 3]
    rates = [0.5, 0.5, 0.5, 0.4, 0.6, 0.1, 0.5, 0.5]
    shares = [{"a": 0.5, "b": 0.5}, {"a": 0.5, "b": 0.5}, {"c": 1.0}, {"a": 0.4, "b": 0.6},
              {"b": 1.0}, {"a": 0.5, "b": 0.5}, {"a": 1.0}, {"a": 0.5, "c": 0.5}]
    metrics = runs(spark, volumes, rates, shares)
    every = sorted(tuple(r) for r in anomaly.backtest(metrics).drop("details").collect())
    single = []
    for i in range(1, len(volumes)):
        now = metrics.where(F.col("run_id") == f"r{i:02d}")
        past = metrics.where(F.col("run_id") < f"r{i:02d}")
        single += [tuple(r) for r in anomaly.detect(now, past).drop("details").collect()]
    assert [r[:2] for r in every] == [r[:2] for r in sorted(single)]
    assert every == sorted(single)


def test_prior_statistics_equal_brute_force(spark):
    volumes = [3, 9, 4, 4, 8, 1, 7, 7]
    for row in anomaly.prior_statistics(runs(spark, volumes), "event_volume").collect():
        past = volumes[: int(row.run_id[1:])]
        assert row.median == median(past)
        assert row.mad == median(abs(x - row.median) for x in past)


def test_shifts_from_the_long_form(spark):
    """Type counts in long form give what the maps give, for runs of several datasets."""
    rng = random.Random(2)
    rows = [(f"r{i}", f"2024-01-0{i + 1}T00:00:00", d, rng.choice(["a", "b", None, "c"]))
            for i in range(5) for d in ("x", "y") for _ in range(rng.randint(2, 9))]
    events = local_frame(spark, rows, "run_id string, run_ts string, dataset_name string, event_type string")
    run = ["run_id", "run_ts", "dataset_name"]
    counts, metrics = anomaly.type_counts(events, run), anomaly.run_metrics(events, run)
    last, past = F.col("run_id") == "r4", F.col("run_id") < "r4"
    short = anomaly.detect(metrics.where(last), metrics.where(past), [], 0.0).collect()
    long_ = anomaly.detect(metrics.where(last), metrics.where(past), [], 0.0, (counts.where(last), counts.where(past))).collect()
    assert sorted(map(str, short)) == sorted(map(str, long_)) and len(short) == 2
    assert anomaly.distribution_shift(counts.where("run_id = 'none'"), counts).count() == 0


def test_running_median_and_mad():
    rng = random.Random(5)
    for size in (1, 2, 3, 10, 60):
        values = [rng.choice([rng.random(), rng.randint(0, 4), -3.5]) for _ in range(size)]
        running = anomaly.Running()
        assert running.median() is None and running.mad() is None
        for i, value in enumerate(values, start=1):
            running.add(float(value))
            middle = median(values[:i])
            assert running.median() == middle
            assert running.mad() == pytest.approx(median(abs(x - middle) for x in values[:i]), abs=1e-12)


def test_largest_shifts_equal_all_types_of_all_runs(spark):
    rng = random.Random(7)
    shares = [{k: rng.choice([0.1, 0.25, 0.5]) for k in rng.sample("abcdefg", rng.randint(0, 4))} for _ in range(25)]
    metrics = runs(spark, [1] * 25, shares=shares).unionByName(runs(spark, [1] * 3, shares=shares[:3], dataset="e"))
    got = {(r.dataset_name, r.run_id): (r.key, r.baseline, r.current) for r in anomaly.largest_shifts(metrics).collect()}
    worst = {}
    for r in anomaly.prior_baselines(metrics).collect():
        place = (-abs(r.current - r.baseline), r.key, r.baseline, r.current)
        run = (r.dataset_name, r.run_id)
        worst[run] = min(worst.get(run, place), place)
    assert got == {run: place[1:] for run, place in worst.items()} and len(got) > 15


def test_blocks_cover_a_range_once(spark):
    ends = [(a, b) for a in range(1, 12) for b in range(a, 20)]
    df = local_frame(spark, ends, "a bigint, b bigint")
    for r in df.withColumn("blocks", anomaly._covering(F.col("a"), F.col("b"))).collect():
        covered = [x for k in r.blocks for x in range(k._block << k._level, (k._block + 1) << k._level)]
        assert sorted(covered) == list(range(r.a, r.b))


@pytest.fixture(scope="module")
def mixed(spark):
    return spark.sql("""
      SELECT * FROM VALUES
        ('1', 10, 1.5D, timestamp_ntz'2024-01-01', date'2024-01-02', true, 2.50BD),
        ('x', 9, null, null, date'2024-01-01', false, 10.25BD),
        (' 2.5 ', 10, 0.5D, timestamp_ntz'2024-01-03 10:00:00.25', null, null, null),
        (null, null, 1.5D, null, null, true, 2.50BD)
      AS t(s, n, x, ts, d, b, m)""")


def test_column_profiles(spark, mixed):
    rows = {r.column_name: r for r in profile.column_profiles(mixed, "t").collect()}
    got = {c: (r.row_count, r.null_count, r.distinct_count, r.min_value, r.max_value) for c, r in rows.items()}
    assert got == {
        "s": (4, 1, 3, None, None), "n": (4, 1, 2, "9", "10"), "x": (4, 1, 2, "0.5", "1.5"),
        "ts": (4, 2, 2, "2024-01-01T00:00:00", "2024-01-03T10:00:00.250000"),
        "d": (4, 2, 2, "2024-01-01", "2024-01-02"), "b": (4, 1, 2, None, None),
        "m": (4, 1, 2, "2.50", "10.25")}
    assert rows["ts"].null_rate == 0.5


def test_type_issues(spark, mixed):
    row = profile.type_issues(mixed, "t").first()
    assert (row.column_name, row.details.numeric_values, row.details.non_numeric_values) == ("s", 2, 1)
    assert row.issue == "Mixed numeric/text values (1 of 3 non-numeric rows)."


def test_top_values_order_numbers_as_numbers(spark, mixed):
    rows = profile.top_values(mixed, "t", 2).orderBy("ordinal", "rank").collect()
    top = {}
    for r in rows:
        top.setdefault(r.column_name, []).append((r.value, r.frequency, r.relative_frequency))
    assert top["n"] == [("10", 2, 0.5), ("9", 1, 0.25)]
    assert top["ts"] == [(None, 2, 0.5), ("2024-01-01T00:00:00", 1, 0.25)]
    assert top["m"][0] == ("2.50", 2, 0.5) and top["b"][0] == ("true", 2, 0.5)
    ties = local_frame(spark, [(9,), (10,), (None,)], "n int")
    assert [r.value for r in profile.top_values(ties, "t", 3).orderBy("rank").collect()] == ["9", "10", None]


def test_summaries_and_empty_tables(spark, mixed):
    summary = profile.table_summaries(profile.column_profiles(mixed, "t")).first()
    assert tuple(summary) == ("t", 4, 7, "ts", 0.5, "s", 3)
    empty = profile.column_profiles(mixed.limit(0), "e")
    assert {(r.row_count, r.null_count, r.null_rate, r.distinct_count) for r in empty.collect()} == {(0, 0, None, 0)}
    assert tuple(profile.table_summaries(empty).first()) == ("e", 0, 7, None, 0.0, None, 0)
    assert profile.type_issues(mixed.limit(0), "e").count() == 0


def test_profile_tables(spark, mixed):
    results = profile.profile({"a": mixed, "b": mixed.select("n")}, "r", "d")
    assert results["column_profiles"].count() == 8
    assert {r.table_name for r in results["table_summaries"].collect()} == {"a", "b"}
    assert results["profile_metadata"].first().tables == ["a", "b"]
    assert results["column_top_values"].where("run_id = 'r'").count() > 8
    assert results["column_type_issues"].count() == 1


def test_hot_value_and_wide_text(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("v"))
    row = profile.column_profiles(df, "t").first()
    assert (row.row_count, row.distinct_count) == (1000, 667)
    assert profile.top_values(df, "t", 1).first().frequency == 334


def test_long_texts_with_one_head(spark):
    """Ties among texts that only differ late go by the whole text; copies count together."""
    head = "same beginning of every text, longer than any head: "
    rows = [(f"{head}{i:03d}",) for i in range(40)] + [(f"{head}007",), ("short",), ("short",), (None,), ("",)]
    df = local_frame(spark, rows, "v string")
    want = [("short", 2), (head + "007", 2), ("", 1), (head + "000", 1), (head + "001", 1)]
    want.sort(key=lambda x: (-x[1], x[0]))
    for few in (2000, 3):
        profile._FEW, before = few, profile._FEW
        got = profile.top_values(df, "t", 5).orderBy("rank").collect()
        profile._FEW = before
        assert [(r.value, r.frequency) for r in got] == want
    row = profile.column_profiles(df, "t").first()
    assert (row.row_count, row.null_count, row.distinct_count) == (45, 1, 42)


def test_sketches_merge_over_runs(spark):
    df = spark.range(4000).select(
        F.concat(F.lit("r"), F.col("id") % 4).alias("run_id"), (F.col("id") % 3000).alias("n"),
        F.when(F.col("id") % 2 == 0, "").otherwise(None).alias("t"))
    kept = profile.distinct_sketches(df, "t", ["run_id"])
    assert kept.count() == 8
    found = {r.column_name: r.distinct_estimate for r in profile.distinct_estimates(kept).collect()}
    assert abs(found["n"] - 3000) <= 150 and found["t"] == 1
    nothing = profile.distinct_estimates(profile.distinct_sketches(df.limit(0), "t"))
    assert {r.distinct_estimate for r in nothing.collect()} == {0}


def test_extremes_of_intervals_follow_their_length(spark):
    df = spark.sql("""
        SELECT * FROM VALUES (INTERVAL '9' DAY, INTERVAL '2-1' YEAR TO MONTH, 1),
          (INTERVAL '10' DAY, INTERVAL '11-0' YEAR TO MONTH, 2), (NULL, NULL, NULL) t(d, m, n)""")
    d, m, n = profile.column_profiles(df, "t").orderBy("ordinal").collect()
    assert (d.min_value, d.max_value) == ("INTERVAL '9' DAY", "INTERVAL '10' DAY")
    assert (m.min_value, m.max_value) == (
        "INTERVAL '2-1' YEAR TO MONTH", "INTERVAL '11-0' YEAR TO MONTH")
    assert (n.min_value, n.max_value, d.null_count, d.distinct_count) == ("1", "2", 1, 2)
