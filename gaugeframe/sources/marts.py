"""Marts: per-run tables and histories as Parquet partitioned by run (IO4-IO7).

Adding a run touches only that run's partition: nothing is read back or rewritten, however
long the history grows, and re-running a run replaces its rows instead of duplicating them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeframe.session import local_frame

# The contract of every mart a later step reads. Knowing it, a step can read a mart that no run
# has written rows to yet.
SCHEMAS = {
    "dq_check_results": """
        run_id string, dataset_name string, table_name string, stage_table string,
        check_id string, dimension string, description string, rule_type string,
        columns array<string>, column_regex string, severity int, weight double,
        threshold_warning double, threshold_fail double, failure_rate double,
        failure_count bigint, total_rows bigint, status string, penalty double""",
    "dq_issue_history": """
        run_id string, run_ts string, dataset_name string, table_name string,
        check_name string, dimension string, issue_type string, severity int,
        affected_rows bigint, affected_pct double, sample_bad_rows_json string,
        probable_root_cause string, recommended_fix string, root_cause_candidates string""",
    "dq_run_history": """
        run_id string, run_ts string, dataset_name string, total_rows_by_table string""",
    "dq_issue_recurrence": """
        run_id string, check_name string, table_name string, issue_type string,
        occurrences bigint, median_affected_pct double, last_seen timestamp_ntz,
        probable_root_cause string, recommended_fix string""",
    "dq_metrics_history": """
        run_id string, run_ts string, dataset_name string, event_volume bigint,
        completion_count bigint, completion_rate double, event_type_counts string,
        event_type_distribution string""",
    "dq_event_types": """
        run_id string, run_ts string, dataset_name string, event_type string, event_count bigint""",
    "dq_anomalies": """
        run_id string, metric string, metric_value double, baseline_value double,
        baseline_spread double, z_score double, threshold double, direction string,
        notes string, details string, dataset_name string, run_ts string""",
    "dq_schema_drift": """
        run_id string, run_ts string, dataset_name string, table_name string,
        missing_columns string, new_columns string, type_changes string, notes string""",
    "dq_skipped_columns": """
        run_id string, run_ts string, dataset_name string, check_id string, table_name string,
        column_name string, type string""",
    "dq_expectation_results": """
        run_id string, run_ts string, dataset_name string, check_id string, table_name string,
        dimension string, success boolean, unexpected_count bigint, unexpected_percent double""",
    "dq_expectation_statistics": """
        run_id string, run_ts string, dataset_name string, evaluated_expectations bigint,
        successful_expectations bigint, unsuccessful_expectations bigint, success_percent double,
        success boolean""",
    "dq_rule_summary": """
        run_id string, run_ts string, dataset_name string, grouping string, value string,
        rules bigint""",
    "score_history": """
        run_id string, run_ts string, dataset_name string, score double, baseline double,
        minimum double, total_penalty double, total_weight double, total_checks bigint,
        failed_checks bigint, subscores string""",
}

PROJECT_KEY = ("run_id", "workflow_run_id", "workflow_attempt")


def write_run(df: DataFrame, path: str, files: int = 1, run_id: str | None = None) -> None:
    """IO4, IO5, D8: write rows into the partitions of the runs they belong to.

    Mart rows of a run are few (one per check, issue or metric), hence one file per run; raise
    `files` for profile tables of very wide datasets. With `run_id`, a frame without rows
    removes what an earlier attempt of that run wrote; without it, such a frame changes nothing.
    """
    if run_id is not None and df.isEmpty():
        _drop_run(df.sparkSession, path, run_id)
    (
        df.repartition(files, "run_id")
        .write.partitionBy("run_id")
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(path)
    )


def _drop_run(spark: SparkSession, path: str, run_id: str) -> None:
    """Removes the partition of one run through the table's own file system."""
    jvm = spark.sparkContext._jvm
    escape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    part = jvm.org.apache.hadoop.fs.Path(f"{path}/run_id={escape(run_id)}")
    part.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(part, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    """A whole mart; an empty frame for a known mart without rows.

    Run ids stay text: partition type inference would turn `007` into 7.
    """
    name = path.rstrip("/").rpartition("/")[2]
    if name in SCHEMAS:
        schema = T.StructType.fromDDL(SCHEMAS[name])
        if not path_exists(spark, path):
            return local_frame(spark, [], schema)
        return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
    found = spark.read.parquet(path).schema
    fields = [T.StructField(f.name, T.StringType() if f.name == "run_id" else f.dataType) for f in found]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def read_run(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """IO7: the rows of one run; other partitions are not read."""
    return read_mart(spark, path).where(F.col("run_id") == run_id)


def upsert_history(
    existing: DataFrame,
    new: DataFrame,
    key: Sequence[str] = PROJECT_KEY,
    order: str = "generated_at",
) -> DataFrame:
    """IO6: both histories together, the latest row per key; new rows win over existing ones.

    Columns that only one side has are NULL on the other.
    """
    both = existing.withColumn("_new", F.lit(0)).unionByName(
        new.withColumn("_new", F.lit(1)), allowMissingColumns=True
    )
    newest = Window.partitionBy(*key).orderBy(F.desc("_new"), F.desc_nulls_last(order))
    return (
        both.withColumn("_place", F.row_number().over(newest))
        .where(F.col("_place") == 1)
        .drop("_place", "_new")
    )
