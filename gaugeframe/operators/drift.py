"""Schema drift: declared against actual columns and types (D1-D8, IO11)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeframe.session import local_frame

# Declared type -> canonical type.
DECLARED_TYPES = {
    "uuid": "varchar",
    "email": "varchar",
    "enum": "varchar",
    "state_code": "varchar",
    "string": "varchar",
    "timestamp": "timestamp",
    "int": "integer",
    "integer": "integer",
    "float": "float",
    "decimal": "float",
}
# Spark type name -> the name the declared types canonicalise to. Others keep their name, so a
# bigint where an integer is declared is reported.
SPARK_TYPES = {
    "string": "varchar",
    "timestamp_ntz": "timestamp",
    "int": "integer",
}

DRIFT_COLUMNS = ("table_name", "missing_columns", "new_columns", "type_changes", "notes")
_COLUMN_SCHEMA = "table_name string, column_name string, ordinal int, type string"


def expected_columns(spark: SparkSession, expected: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """One row per declared column."""
    rows = [
        (table, column, i, type_)
        for table, columns in expected.items()
        for i, (column, type_) in enumerate(columns.items())
    ]
    return local_frame(spark, rows, _COLUMN_SCHEMA)


def actual_columns(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """D2, IO11: one row per column that exists, in ordinal order."""
    rows = [
        (name, column, i, type_)
        for name, df in tables.items()
        for i, (column, type_) in enumerate(df.dtypes)
    ]
    return local_frame(spark, rows, _COLUMN_SCHEMA)


def _canonical(c: Column, names: Mapping[str, str]) -> Column:
    entries = [F.lit(text) for pair in names.items() for text in pair]
    plain = F.nullif(F.lower(F.trim(c)), F.lit(""))
    return F.coalesce(F.try_element_at(F.create_map(*entries), plain), plain)


def type_changes(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Columns on both sides whose canonical types differ."""
    declared = expected.select(
        "table_name", "column_name", _canonical(F.col("type"), DECLARED_TYPES).alias("expected")
    )
    found = actual.select(
        "table_name", "column_name", _canonical(F.col("type"), SPARK_TYPES).alias("actual")
    )
    both = declared.join(found, ["table_name", "column_name"])
    return both.where(F.col("expected") != F.col("actual"))


def _listed(condition: Column) -> Column:
    return F.array_sort(F.collect_list(F.when(condition, F.col("column_name"))))


def compare_schemas(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """One row per drifting table, with sorted JSON lists and a readable note."""
    changes = type_changes(expected, actual)
    sides = (
        expected.select("table_name", "column_name", F.lit(True).alias("_declared"))
        .join(
            actual.select("table_name", "column_name", F.lit(True).alias("_found")),
            ["table_name", "column_name"],
            "full_outer",
        )
        .join(changes, ["table_name", "column_name"], "left")
    )
    change = F.struct(F.col("column_name").alias("column"), "expected", "actual")
    per_table = sides.groupBy("table_name").agg(
        F.bool_or(F.coalesce("_declared", F.lit(False))).alias("_table_declared"),
        F.bool_or(F.coalesce("_found", F.lit(False))).alias("_table_found"),
        _listed(F.col("_found").isNull()).alias("_missing"),
        _listed(F.col("_declared").isNull()).alias("_new"),
        F.array_sort(F.collect_list(F.when(F.col("expected").isNotNull(), change))).alias("_changes"),
    )
    drifting = per_table.where(
        (F.size("_missing") > 0) | (F.size("_new") > 0) | (F.size("_changes") > 0)
    )
    return drifting.select(
        "table_name",
        F.to_json("_missing").alias("missing_columns"),
        F.to_json("_new").alias("new_columns"),
        F.to_json("_changes").alias("type_changes"),
        _notes().alias("notes"),
    ).orderBy("table_name")


def _notes() -> Column:
    def listing(title: str, column: str) -> Column:
        text = F.concat(F.lit(title), F.array_join(column, ", "))
        return F.when(F.size(column) > 0, text)

    differences = F.transform(
        "_changes",
        lambda c: F.format_string("%s (%s→%s)", c["column"], c["expected"], c["actual"]),
    )
    changed = F.when(
        F.size("_changes") > 0,
        F.concat(F.lit("Type changes: "), F.array_join(differences, ", ")),
    )
    return (
        F.when(~F.col("_table_found"), "Expected staging table was not created.")
        .when(~F.col("_table_declared"), "Unexpected staging table appeared.")
        .otherwise(
            F.concat_ws(
                "; ",
                listing("Missing columns: ", "_missing"),
                listing("New columns: ", "_new"),
                changed,
            )
        )
    )


def stage_catalogue(tables: Mapping[str, DataFrame], counts: DataFrame) -> DataFrame:
    """IO11: every column of every table with its type and the table's row count."""
    return actual_columns(counts.sparkSession, tables).join(counts, "table_name")
