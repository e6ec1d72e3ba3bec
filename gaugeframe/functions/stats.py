"""Aggregates and ratios whose value does not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_EXACT = "decimal(38,12)"


def exact_sum(c: Column) -> Column:
    """Sum of doubles through decimals: the same result whatever order tasks finish in."""
    return F.coalesce(F.sum(c.cast(_EXACT)), F.lit(0).cast(_EXACT)).cast("double")


def count_when(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Numerator / denominator as double, 0.0 on a zero denominator."""
    return F.when(
        denominator != 0, numerator.cast("double") / denominator.cast("double")
    ).otherwise(F.lit(0.0))


def rounded_ratio(numerator: Column, denominator: Column) -> Column:
    """Ratio rounded to four places."""
    return F.round(ratio(numerator, denominator), 4)


def ranked(rows: DataFrame, *order: Column) -> DataFrame:
    """Rows in order with their place, from 1, as `rank`.

    Numbering all rows brings them to one task: for reports of one row per check, issue type or
    dimension.
    """
    place = F.row_number().over(Window.orderBy(*order))
    return rows.withColumn("rank", place).orderBy("rank")
