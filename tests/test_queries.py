"""Registered queries against their SQL, exactly, at the smallest scale."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from workloads.compare import connect, difference
from workloads.oracle import ORACLE
from workloads.queries import QUERIES

SF = "/root/testdata/sf0.001"
# All queries run in workloads/compare.py; these cover every family.
CHECKED = (
    "clean_events", "clean_newsletter", "stable_ids", "rule_non_negative", "rule_unique_mapping",
    "rule_duplicate_compound", "rule_foreign_key", "rule_duplicate_rows_hot_key", "check_results",
    "rule_unique_mapping_rows_hot_key", "rule_fk_rows_hot_key", "canonical_by_split_join", "run_time",
    "profile_distinct_estimates", "anomaly_volume", "anomaly_distribution_shift", "score_record",
    "issue_log", "baseline_compare", "history_upsert", "issue_lifecycle", "issue_trend_matrix",
    "score_trend", "anomaly_current_run", "distribution_baseline", "schema_drift",
    "profile_columns", "profile_top_values", "profile_table_summary",
)


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_its_sql():  # those of optional subpackages may have none
    assert set(QUERIES) == set(ORACLE) and set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.count() == 27 and "penalty" in df.columns


@pytest.mark.parametrize("name", CHECKED)
def test_agrees(spark, con, name):
    assert difference(queries()[name](spark, SF), con, oracle_sql()[name]) is None
