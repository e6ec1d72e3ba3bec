"""Table profiles.

How often each value of each column occurs is enough to derive the whole profile: row and null
counts, exact distinct counts, extremes, mixed types and top values. `value_counts` gets that
in one scan and one shuffle; partial aggregation folds frequent values (and NULLs) before the
shuffle. Values keep their type class, so numbers order as numbers.

A text travels as its first HEAD characters and, if it is longer, its SHA-256. Only the texts of
top values are fetched in full, by a second scan that compares digests.

Exact distinct counts shuffle every distinct value. `distinct_sketches` is the way around it: a
sketch of fixed size per column and run, which merges over runs, and no shuffle of values.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeframe.functions.stats import ratio
from gaugeframe.functions.text import strip_spaces
from gaugeframe.functions.timestamps import iso_text
from gaugeframe.session import local_frame

TOP_VALUES = 5
# Characters of a text that take part in a shuffle.
HEAD = 32
# At most so many winning values are looked up by literals; more are joined.
_FEW = 2000
# 2^12 registers: a relative standard error of 1.6 %.
SKETCH_BITS = 12
NUMERIC_TEXT = r"^[+-]?[0-9]+(\.[0-9]+)?\z"

# Slot a value travels in, by type class. Decimals get the widest scale of the table.
_SLOTS = ("text", "whole", "real", "exact", "time", "span", "months")


# Types narrower than their slot; text shows a value as its own type would.
_NARROWED = (T.DecimalType, T.FloatType, T.DayTimeIntervalType, T.YearMonthIntervalType)


def _slot_type(df: DataFrame, slot: str) -> str:
    if slot == "exact":
        scales = [f.dataType.scale for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)]
        return f"decimal(38,{max(scales)})"
    return {
        "text": "string", "whole": "bigint", "real": "double", "time": "timestamp_ntz",
        "span": "interval day to second", "months": "interval year to month",
    }[slot]


def _slot(kind: T.DataType) -> str:
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "whole"
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return "real"
    if isinstance(kind, T.DecimalType):
        return "exact"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "time"
    if isinstance(kind, T.DayTimeIntervalType):
        return "span"
    if isinstance(kind, T.YearMonthIntervalType):
        return "months"
    return "text"


def is_text(kind: T.DataType) -> bool:
    return isinstance(kind, (T.StringType, T.CharType, T.VarcharType))


def has_extremes(kind: T.DataType) -> bool:
    """Numbers, times and, for parity, intervals have a minimum and maximum."""
    return isinstance(
        kind,
        (T.NumericType, T.TimestampType, T.TimestampNTZType, T.DateType,
         T.DayTimeIntervalType, T.YearMonthIntervalType),
    )


def _used_slots(df: DataFrame) -> list[str]:
    present = {_slot(f.dataType) for f in df.schema.fields}
    return [s for s in _SLOTS if s in present]


def _keyed(text: Column) -> tuple[Column, Column]:
    """What stands for a text: its head, and its digest where it is longer."""
    return (
        F.substring(text, 1, HEAD),
        F.when(F.length(text) > HEAD, F.unhex(F.sha2(text.cast("binary"), 256))),
    )


def value_counts(df: DataFrame) -> DataFrame:
    """How often each value occurs: (_col, one typed slot per class, _n).

    A text slot is a head (`_text`), and `_digest` and `_numeric` say more about the whole text.
    """
    slots = _used_slots(df)
    names = [f"_{s}" for s in slots]
    if "text" in slots:
        names += ["_digest", "_numeric"]
    cells: list[Column] = []
    for i, field in enumerate(df.schema.fields):
        mine, c = _slot(field.dataType), F.col(field.name)
        cells.append(F.lit(i))
        if mine == "text":
            text = c.cast("string")
            head, digest = _keyed(text)
            numeric = F.coalesce(strip_spaces(text).rlike(NUMERIC_TEXT), F.lit(False))
        for s in slots:
            value = F.lit(None) if s != mine else head if s == "text" else c
            cells.append(value.cast(_slot_type(df, s)))
        if "text" in slots:
            cells += (
                [digest, numeric] if mine == "text"
                else [F.lit(None).cast("binary"), F.lit(None).cast("boolean")]
            )
    unfolded = df.select(F.stack(F.lit(len(df.columns)), *cells).alias("_col", *names))
    return unfolded.groupBy("_col", *names).agg(F.count(F.lit(1)).alias("_n"))


def _present(slots: list[str]) -> Column:
    return F.coalesce(*[F.col(f"_{s}").cast("string") for s in slots]).isNotNull()


def _as_text(df: DataFrame, slot: str, c: Column) -> Column:
    """A slot's value as text, in the type of the column the row stands for (`_col`)."""
    if slot == "text":
        return c
    text = iso_text(c) if slot == "time" else c.cast("string")
    for i, field in enumerate(df.schema.fields):
        kind = field.dataType
        if isinstance(kind, T.DateType) and slot == "time":
            text = F.when(F.col("_col") == i, F.date_format(c, "yyyy-MM-dd")).otherwise(text)
        elif isinstance(kind, _NARROWED) and _slot(kind) == slot:
            narrow = c.cast(kind.simpleString()).cast("string")
            text = F.when(F.col("_col") == i, narrow).otherwise(text)
    return text


def _columns_frame(df: DataFrame) -> DataFrame:
    rows = [
        (i, f.name, f.dataType.simpleString(), has_extremes(f.dataType), is_text(f.dataType))
        for i, f in enumerate(df.schema.fields)
    ]
    return local_frame(
        df.sparkSession,
        rows,
        "_col int, column_name string, column_type string, _extremes boolean, _is_text boolean",
    )


def _statistics(df: DataFrame, counts: DataFrame) -> DataFrame:
    """Per column, everything the profile tables need; empty tables give zero counts."""
    slots = _used_slots(df)
    present = _present(slots)
    measures = [
        F.sum("_n").alias("row_count"),
        F.sum(F.when(present, F.lit(0)).otherwise(F.col("_n"))).alias("null_count"),
        F.count_if(present).alias("distinct_count"),
    ]
    for slot in slots:
        if slot == "text":
            numeric = F.sum(F.when(F.col("_numeric"), F.col("_n")).otherwise(F.lit(0)))
            measures.append(numeric.alias("_numeric"))
        else:
            measures += [
                F.min(f"_{slot}").alias(f"_min_{slot}"), F.max(f"_{slot}").alias(f"_max_{slot}")
            ]
    sums = counts.groupBy("_col").agg(*measures)

    def extreme(side: str) -> Column:
        texts = [_as_text(df, s, F.col(f"_{side}_{s}")) for s in slots if s != "text"]
        return F.coalesce(F.lit(None).cast("string"), *texts)

    zero = F.lit(0).cast("long")
    return (
        _columns_frame(df)
        .join(sums, "_col", "left")
        .select(
            F.col("_col").alias("ordinal"), "column_name", "column_type", "_is_text",
            F.coalesce("row_count", zero).alias("row_count"),
            F.coalesce("null_count", zero).alias("null_count"),
            F.coalesce("distinct_count", zero).alias("distinct_count"),
            F.when(F.col("_extremes"), extreme("min")).alias("min_value"),
            F.when(F.col("_extremes"), extreme("max")).alias("max_value"),
            (F.coalesce("_numeric", zero) if "text" in slots else zero).alias("_numeric"),
        )
    )


def column_profiles(df: DataFrame, table: str, counts: DataFrame | None = None) -> DataFrame:
    """One row per column. Pass `counts` to share one `value_counts` among profiles."""
    stats = _statistics(df, value_counts(df) if counts is None else counts)
    rate = F.when(
        F.col("row_count") > 0,
        F.col("null_count").cast("double") / F.col("row_count").cast("double"),
    )
    return stats.select(
        F.lit(table).alias("table_name"), "ordinal", "column_name", "column_type", "row_count",
        "null_count", rate.alias("null_rate"), "distinct_count", "min_value", "max_value",
    )


def type_issues(df: DataFrame, table: str, counts: DataFrame | None = None) -> DataFrame:
    """P5: text columns that hold both numbers and other text."""
    stats = _statistics(df, value_counts(df) if counts is None else counts)
    filled = F.col("row_count") - F.col("null_count")
    return (
        stats.where("_is_text")
        .withColumn("numeric_values", F.col("_numeric"))
        .withColumn("non_numeric_values", filled - F.col("_numeric"))
        .where((F.col("numeric_values") > 0) & (F.col("non_numeric_values") > 0))
        .select(
            F.lit(table).alias("table_name"),
            "column_name",
            F.format_string(
                "Mixed numeric/text values (%d of %d non-numeric rows).",
                "non_numeric_values", filled,
            ).alias("issue"),
            F.struct("numeric_values", "non_numeric_values").alias("details"),
        )
    )


def _long_texts(df: DataFrame, wanted: DataFrame) -> DataFrame:
    """(_col, _text, _digest, _full): the long texts among `wanted`, from one scan of `df`."""
    cells = []
    texts = [(i, f) for i, f in enumerate(df.schema.fields) if _slot(f.dataType) == "text"]
    for i, field in texts:
        text = F.col(field.name).cast("string")
        cells += [F.lit(i), *_keyed(text), text]
    unfolded = df.select(F.stack(F.lit(len(texts)), *cells).alias("_col", "_text", "_digest", "_full"))
    keys = ["_col", "_text", "_digest"]
    # Copies of a text fold to one in every task.
    return unfolded.where("_digest IS NOT NULL").join(wanted, keys, "left_semi").groupBy(*keys).agg(
        F.any_value("_full").alias("_full")
    )


def top_values(
    df: DataFrame, table: str, top_n: int = TOP_VALUES, counts: DataFrame | None = None
) -> DataFrame:
    """The most frequent values of every column, NULL among them; ties go by value.

    The per-column limit is a window group limit: each task passes on at most `top_n` values and
    those that tie with them by count and head. These few are collected; for long texts among
    them a second scan fetches the whole values, and settles ties. Should more than _FEW tie
    (texts of one head and count), they are not collected but joined.
    """
    counted = value_counts(df) if counts is None else counts
    slots = _used_slots(df)
    order = [F.desc("_n"), *[F.col(f"_{s}").asc_nulls_last() for s in slots]]
    leading = counted.withColumn("_place", F.rank().over(Window.partitionBy("_col").orderBy(*order))).where(
        F.col("_place") <= top_n
    )
    few = leading.limit(_FEW + 1).collect()
    small = len(few) <= _FEW
    if small:
        leading = local_frame(df.sparkSession, few, leading.schema)
    if "text" in slots and (not small or any(r["_digest"] is not None for r in few)):
        wanted = leading.where("_digest IS NOT NULL").select("_col", "_text", "_digest")
        texts = _long_texts(df, F.broadcast(wanted) if small else wanted)
        keys = ["_col", "_text", "_digest"]
        leading = leading.join(texts, keys, "left").withColumn("_text", F.coalesce("_full", "_text"))
    place = F.row_number().over(Window.partitionBy("_col").orderBy(*order))
    rows = df.agg(F.count(F.lit(1)).alias("_total")) if counts is None else counts.groupBy("_col").agg(
        F.sum("_n").alias("_total")
    ).agg(F.max("_total").alias("_total"))
    names = _columns_frame(df).select("_col", "column_name")
    return (
        leading.withColumn("rank", place)
        .where(F.col("rank") <= top_n)
        .join(names, "_col")
        .select(
            F.lit(table).alias("table_name"),
            F.col("_col").alias("ordinal"),
            "column_name",
            "rank",
            F.coalesce(*[_as_text(df, s, F.col(f"_{s}")) for s in slots]).alias("value"),
            F.col("_n").alias("frequency"),
            ratio(F.col("_n"), rows.scalar()).alias("relative_frequency"),
        )
    )


# ---------------------------------------------------------------- approximate distinct counts


def distinct_sketches(df: DataFrame, table: str, by: Sequence[str] = ()) -> DataFrame:
    """P3, opt-in: a HyperLogLog sketch per column: (by..., table_name, ordinal, column_name, sketch).

    Sketches are built in the scanning tasks and merged; no values are shuffled. Kept per run,
    they merge over runs with `distinct_estimates`.
    """
    fields = [f for f in df.schema.fields if f.name not in by]
    # A leading mark: an empty text would not be counted.
    sketches = [
        F.hll_sketch_agg(F.concat(F.lit("."), F.col(f.name).cast("string")), F.lit(SKETCH_BITS)).alias(f"_s{i}")
        for i, f in enumerate(fields)
    ]
    wide = df.groupBy(*by).agg(*sketches) if by else df.agg(*sketches)
    columns = F.array(*[
        F.struct(F.lit(i).alias("ordinal"), F.lit(f.name).alias("column_name"), F.col(f"_s{i}").alias("sketch"))
        for i, f in enumerate(fields)
    ])
    return wide.select(*by, F.lit(table).alias("table_name"), F.inline(columns))


def distinct_estimates(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Estimated distinct counts per column (and `by`), over all runs that `sketches` holds."""
    return sketches.groupBy(*by, "table_name", "ordinal", "column_name").agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_estimate")
    )


def table_summaries(profiles: DataFrame) -> DataFrame:
    """Per table, the column with most NULLs and the one with most distinct values.

    Ties go to the earlier column; a table without NULLs (or values) names none.
    """
    nullest = F.max(F.struct("null_rate", (-F.col("ordinal")).alias("o"), "column_name"))
    widest = F.max(F.struct("distinct_count", (-F.col("ordinal")).alias("o"), "column_name"))
    return (
        profiles.groupBy("table_name")
        .agg(
            F.max("row_count").alias("row_count"),
            F.count(F.lit(1)).alias("column_count"),
            nullest.alias("n"),
            widest.alias("w"),
        )
        .select(
            "table_name", "row_count", "column_count",
            F.when(F.col("n.null_rate") > 0, F.col("n.column_name")).alias("nulliest_column"),
            F.coalesce("n.null_rate", F.lit(0.0)).alias("max_null_rate"),
            F.when(F.col("w.distinct_count") > 0, F.col("w.column_name")).alias(
                "high_cardinality_column"
            ),
            F.col("w.distinct_count").alias("max_cardinality"),
        )
    )


def profile(
    tables: Mapping[str, DataFrame], run_id: str, dataset_name: str, top_n: int = TOP_VALUES,
    keep: Callable[[str, DataFrame], DataFrame] = lambda name, counts: counts,
) -> dict[str, DataFrame]:
    """The profile tables of a run.

    All derive from the value counts of the tables. `keep` is given each table's name and counts
    and returns them from where they were kept, so that a job counts once and reads back.
    """
    counts = {name: keep(name, value_counts(df)) for name, df in tables.items()}

    def united(make) -> DataFrame:
        frames = [make(df, name, counts=counts[name]) for name, df in tables.items()]
        stamped = reduce(DataFrame.unionByName, frames)
        return stamped.withColumns(
            {"run_id": F.lit(run_id), "dataset_name": F.lit(dataset_name)}
        )

    columns = united(column_profiles)
    summaries = table_summaries(columns).withColumns(
        {"run_id": F.lit(run_id), "dataset_name": F.lit(dataset_name)}
    )
    spark = columns.sparkSession
    metadata = local_frame(
        spark, [(run_id, dataset_name, top_n, sorted(tables))],
        "run_id string, dataset_name string, top_n int, tables array<string>",
    )
    return {
        "column_profiles": columns,
        "column_top_values": united(
            lambda df, name, counts: top_values(df, name, top_n, counts=counts)
        ),
        "column_type_issues": united(type_issues),
        "table_summaries": summaries,
        "profile_metadata": metadata,
    }
