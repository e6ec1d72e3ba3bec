"""The plans are the ones intended: few scans, early limits, no nested loops."""

import re

import pytest
from pyspark.sql import functions as F

from gaugeframe import defaults
from gaugeframe.config import Rule
from gaugeframe.operators import anomaly, profile
from gaugeframe.operators.rules import count_failures, findings
from gaugeframe.operators.samples import duplicate_rows, sample_rows
from workloads.queries import QUERIES, staged
from workloads.views import table

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_row_rules_scan_each_table_once(spark):
    tables = staged(spark, SF)
    rules = [r for r in defaults.RULES if r.table in ("users", "newsletter") and r.kind in
             ("NULL_PERCENTAGE", "PATTERN", "DATE_RANGE", "ENUM", "TIMESTAMP_ORDER")]
    text = plan(count_failures(tables, rules))
    assert len(re.findall(r"FileScan parquet", text)) == 2
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_key_rules_of_a_table_share_a_scan(spark):
    users = staged(spark, SF)["users"]
    rules = [r for r in defaults.RULES if r.table == "users" and r.kind == "DUPLICATE_PERCENTAGE"]
    assert len(rules) == 3
    text = plan(count_failures({"users": users}, rules))
    assert len(re.findall(r"FileScan parquet", text)) == 1 and "Expand" in text
    assert re.search(r"ReadSchema: struct<c_custkey:bigint,c_nationkey:int>", text)


def scans(text: str) -> int:
    return len(re.findall(r"FileScan parquet", text))


def test_reference_rules_add_counts_and_join_nothing(spark):
    tables = {n: table(spark, SF, n) for n in ("lineitem", "orders")}
    rule = Rule("f", "lineitem", "d", "FK", ("orders.o_orderkey",), ("l_orderkey",))
    text = plan(count_failures(tables, [rule]))
    assert "ReadSchema: struct<l_orderkey:bigint>" in text and "partial_count" in text
    assert scans(text) == 2 and "Join" not in text


def test_keys_meet_in_all_partitions_of_the_session(spark):
    text = plan(QUERIES["rule_foreign_key"](spark, SF))
    # Shares of summaries go straight to a shuffle whose partitions are never merged.
    assert re.search(r"hashpartitioning\(rule#\d+, key#\d+, _slice#\d+, 4\), REPARTITION_BY_NUM", text)
    for above, below in zip(text.splitlines(), text.splitlines()[1:]):
        assert not ("Aggregate" in above and "Union" in below)
    # Over many runs the window takes the same shuffle.
    daily = plan(QUERIES["issue_history_daily"](spark, SF))
    assert len(re.findall(r"hashpartitioning\([^)]*\bkey#", daily)) == 1 and "Window" in daily


def test_runs_are_not_folded_by_key_before_they_meet(spark):
    lines = plan(QUERIES["issue_history_daily"](spark, SF)).splitlines()
    above = [one for one, below in zip(lines, lines[1:]) if re.search(r"[ -] Union", below)]
    assert above and all("Exchange" in one for one in above)


def test_keys_of_several_sets_are_dealt_before_they_are_counted(spark):
    # A fold in the tasks of the scan holds several keys for every row of a split.
    for df in (QUERIES["issue_history_daily"](spark, SF), count_failures(staged(spark, SF), defaults.RULES)):
        lines = plan(df).splitlines()
        expanded = [i for i, one in enumerate(lines) if "- Expand" in one]
        assert len(expanded) == 4
        for i in expanded:
            folded, dealt = [one for one in lines[:i] if "- Project" not in one][-2:]
            assert re.search(r"hashpartitioning\(_set#.*REPARTITION_BY_NUM", dealt)
            # What counts the keys takes that shuffle.
            assert "partial_count" in folded


def test_a_kept_history_is_never_computed_again(spark):
    # Scalar subqueries and joins read what was kept, too.
    for name in ("lifecycle_counts", "issue_trend_matrix"):
        assert scans(plan(QUERIES[name](spark, SF))) == 0, name


def test_all_rules_scan_each_table_once(spark):
    text = plan(count_failures(staged(spark, SF), defaults.RULES))
    assert scans(text) == 5 and "Join" not in text
    assert scans(plan(QUERIES["check_results"](spark, SF))) == 5
    assert scans(plan(findings(staged(spark, SF), defaults.RULES))) == 5


def test_samples_take_one_more_scan_per_table(spark):
    # The counting scans are over when the plan is built; what it holds is the second pass.
    for name in ("rule_samples", "issue_log", "exceptions_export"):
        assert scans(plan(QUERIES[name](spark, SF))) == 5, name


@pytest.fixture
def no_broadcasts(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def test_rows_of_hot_keys_are_sliced(spark, no_broadcasts):
    for name in ("rule_unique_mapping_rows_hot_key", "rule_fk_rows_hot_key"):
        text = plan(QUERIES[name](spark, SF))
        exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
        rows = [e for e in exchanges if "_slice" in e]
        assert rows and all(re.match(r"l_returnflag#\d+, _slice#\d+|_key#\d+, _slice_of#\d+", e) for e in rows), name
        # Other exchanges bring keys together that were folded before.
        for above, below in zip(text.splitlines(), text.splitlines()[1:]):
            if "Exchange" in above and "_slice" not in above:
                assert "HashAggregate" in below, name


def test_repeated_vocabularies_are_never_broadcast(spark):
    # Tables this small would be broadcast by their planned size, which leaves out the repeats.
    text = plan(QUERIES["canonical_by_split_join"](spark, SF))
    assert "SortMergeJoin" in text and "Broadcast" not in text
    assert "BroadcastHashJoin" in plan(QUERIES["canonical_by_broadcast"](spark, SF))


def test_samples_are_cut_before_the_shuffle(spark):
    text = plan(sample_rows(staged(spark, SF), defaults.RULES.only("users_email_not_null", "users_state_valid")))
    assert "WindowGroupLimit" in text and "Partial" in text
    top = plan(profile.top_values(table(spark, SF, "customer"), "customer"))
    assert "WindowGroupLimit" in top and "Partial" in top


def test_duplicate_ranks_never_group_by_the_key_alone(spark):
    text = plan(duplicate_rows(table(spark, SF, "lineitem"), ["l_returnflag"]))
    assert "partial_count(1)" in text
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    alone = [e for e in exchanges if re.fullmatch(r"_key#\d+, \d+", e)]
    # Only the slice counts, of which a key has a bounded number, are brought together by key.
    assert len(alone) == 1
    assert "Window" in text


def test_profile_reads_a_table_once_and_shuffles_no_long_text(spark):
    docs = table(spark, SF, "documents")
    text = plan(profile.column_profiles(docs, "documents"))
    assert scans(text) == 1 and "sha2(" in text
    # What is grouped, hence shuffled: the column, heads, digests and values of other types.
    dealt = re.sub(r"#\d+L?", "", text)
    assert "hashpartitioning(_col, _text, _whole, _digest, _numeric, " in dealt
    assert set(re.findall(r"hashpartitioning\((\w+), ", dealt)) == {"_col"}
    # The counting scan of top values is over; long texts among them take a second one.
    top = plan(profile.top_values(docs, "documents"))
    # Counting rows for the shares reads no column.
    reading = scans(top) - len(re.findall(r"ReadSchema: struct<>", top))
    assert reading == 1 and "BroadcastHashJoin" in top
    assert "Exchange" not in plan(profile.distinct_sketches(docs, "documents")).replace("Exchange SinglePartition", "")


def test_backtests_keep_no_earlier_values_per_run(spark):
    metrics = spark.createDataFrame(
        [("r1", "2024-01-01T00:00:00", "d", 1, 1, 1.0, {"a": 1}, {"a": 1.0})],
        "run_id string, run_ts string, dataset_name string, event_volume long, completion_count long, "
        "completion_rate double, event_type_counts map<string,long>, event_type_distribution map<string,double>",
    )
    text = plan(anomaly.backtest(metrics))
    # No lists of earlier values, and no row per run and type.
    assert not re.search(r"\b(collect_list|sequence)\(", text)


def test_no_nested_loops_or_python_rows(spark):
    for name in ("check_results", "issue_trend_matrix", "issue_lifecycle", "distribution_baseline",
                 "anomaly_volume", "profile_table_summary", "gate_verdict", "project_metrics"):
        text = plan(QUERIES[name](spark, SF))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
        assert "EvalPython" not in text and "MapInPandas" not in text, name


def test_staged_filters_reach_the_scan(spark):
    df = table(spark, SF, "orders").where(F.col("o_orderkey") < 10).select("o_custkey")
    assert "PushedFilters: [IsNotNull(o_orderkey), LessThan(o_orderkey,10)]" in plan(df)
