"""Failing rows and samples of them (R7-R9 rows, R11).

Samples are chosen by value, so re-running a check shows the same rows. What needs samples, and
of which keys, is known from the counting pass (`rules.findings`): a handful of rows per check.
One more scan per table then finds the sample rows of all its checks. Per-check and per-key
limits are window group limits, which cut every task's output before the shuffle.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeframe.config import Rule
from gaugeframe.functions.timestamps import iso_text
from gaugeframe.operators.rules import (
    RowCheck, failing_condition, findings, key_columns, order_text, reference_of, resolve,
    row_checks, shared_type,
)

SAMPLE_LIMIT = 5
_TEMPORAL = (T.TimestampType, T.TimestampNTZType)


def value_text(field: T.StructField) -> Column:
    """A value as text; timestamps in ISO form."""
    c = F.col(field.name)
    return iso_text(c) if isinstance(field.dataType, _TEMPORAL) else c.cast("string")


def _as_texts(df: DataFrame) -> list[Column]:
    return [value_text(field).alias(field.name) for field in df.schema.fields]


def _row_order(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in columns]


def _row_json(columns: Sequence[str], extra: Sequence[str] = ()) -> Column:
    return F.to_json(F.struct(*columns, *extra), {"ignoreNullFields": "false"})


def _first_rows(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") <= n)


# ---------------------------------------------------------------- whole failing sets


def failing_rows(
    tables: Mapping[str, DataFrame], rule: Rule, as_of: Column | None = None
) -> DataFrame:
    """Every failing row of one rule (duplicates carry their `dq_rank`)."""
    if rule.kind == "DUPLICATE_PERCENTAGE":
        return duplicate_rows(resolve(tables, rule.table), rule.columns)
    if rule.kind == "UNIQUE_MAPPING":
        df = resolve(tables, rule.table)
        return rows_with_keys(df, rule.args[0], mixed_keys(df, *rule.args))
    if rule.kind == "FK":
        df = resolve(tables, rule.table)
        return rows_with_keys(df, rule.columns[0], orphan_keys(tables, rule))
    if rule.kind == "NON_NEGATIVE_COUNTS":
        raise ValueError("A column sweep spans tables; use negative_rows per table")
    return resolve(tables, rule.table).where(failing_condition(rule, as_of))


def negative_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One output row per negative value, naming its `failed_column`."""
    failed = F.array(*[F.when(F.col(c) < 0, F.lit(c)) for c in columns])
    return df.withColumn(
        "failed_column", F.explode(F.filter(failed, lambda name: name.isNotNull()))
    )


def mixed_keys(df: DataFrame, key: str, value: str) -> DataFrame:
    """Non-null keys that occur with more than one distinct value."""
    pairs = df.where(F.col(key).isNotNull()).select(key, value).distinct()
    return pairs.groupBy(key).agg(F.count(value).alias("_values")).where("_values > 1").select(key)


def orphan_keys(tables: Mapping[str, DataFrame], rule: Rule) -> DataFrame:
    """Non-null keys of the rule's table that the referenced column does not hold."""
    table, column = reference_of(rule)
    own, far = resolve(tables, rule.table), resolve(tables, table)
    key = rule.columns[0]
    cast = shared_type(own.schema[key].dataType, far.schema[column].dataType)

    def side(df: DataFrame, name: str, known: bool) -> DataFrame:
        shared = F.col(name) if cast is None else F.col(name).cast(cast)
        kept = F.lit(None).cast(own.schema[key].dataType) if known else F.col(name)
        return df.where(F.col(name).isNotNull()).select(
            shared.alias("_shared"), kept.alias(key), F.lit(known).alias("_known")
        )

    # Sets of keys, not rows: both sides fold map-side.
    ends = side(own, key, False).unionByName(side(far, column, True))
    return (
        ends.groupBy("_shared").agg(F.collect_set(key).alias("_own"), F.max("_known").alias("_known"))
        .where("NOT _known").select(F.explode("_own").alias(key))
    )


def rows_with_keys(df: DataFrame, column: str, keys: DataFrame, slices: int = 64) -> DataFrame:
    """Rows of `df` whose `column` is among `keys`, without ever bringing a key's rows together.

    Rows are dealt by key and a slice of the row hash; the keys, which are slim and distinct, are
    repeated for every slice. A key that holds a third of all rows thus meets them in `slices`
    places.
    """
    slice_ = F.pmod(F.xxhash64(*df.columns), F.lit(slices)).cast("int")
    repeated = keys.select(
        F.col(column).alias("_key"), F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("_slice_of")
    )
    sliced = df.withColumn("_slice", slice_)
    same = (sliced[column] == repeated["_key"]) & (sliced["_slice"] == repeated["_slice_of"])
    return sliced.join(repeated, same, "left_semi").drop("_slice")


def duplicate_rows(
    df: DataFrame, columns: Sequence[str], slices: int = 4096, chunk: int = 65536
) -> DataFrame:
    """All rows but the first of each key, numbered from 2 in `dq_rank`.

    Rows of a key are ranked by a hash of the whole row. No task ever holds a whole key:

    * identical rows are folded to one row with a multiplicity, map-side, so a group of
      copies shrinks to one row per task;
    * the distinct rows of a key are spread over `slices` ranges of the row hash. Ranks inside
      a slice start where the counts of the key's earlier slices end. There is no join or
      grouping on the key alone, whose partitioning later steps would inherit;
    * multiplicities unfold at the end, in chunks spread over tasks again.
    """
    names = df.columns

    def placed(rows: DataFrame) -> DataFrame:
        share = F.col("_hash") / F.lit(2.0**64) + 0.5
        return rows.withColumns(
            {"_key": F.struct(*columns), "_hash": F.xxhash64(*names)}
        ).withColumn("_slice", F.floor(share * slices).cast("int"))

    # At most `slices` rows per key; keys that occur once are dropped here.
    of_key = Window.partitionBy("_key")
    earlier_slices = of_key.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed(df)
        .groupBy("_key", "_slice")
        .agg(F.count(F.lit(1)).alias("_slice_rows"))
        .withColumn("_key_rows", F.sum("_slice_rows").over(of_key))
        .withColumn("_start", F.coalesce(F.sum("_slice_rows").over(earlier_slices), F.lit(0)))
        .where("_key_rows > 1")
        .select("_key", "_slice", "_start")
    )
    folded = placed(df.groupBy(*names).agg(F.count(F.lit(1)).alias("_n")))
    earlier_rows = (
        Window.partitionBy("_key", "_slice")
        .orderBy("_hash", *names)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ranked = (
        folded.join(starts, ["_key", "_slice"])
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier_rows), F.lit(0)))
        .withColumn("_last", F.col("_start") + F.col("_before") + F.col("_n"))
        .withColumn("_first", F.greatest(F.lit(2), F.col("_last") - F.col("_n") + 1))
        .where(F.col("_first") <= F.col("_last"))
    )
    chunks = ranked.withColumn(
        "_from", F.explode(F.sequence("_first", "_last", F.lit(chunk).cast("long")))
    ).repartition("_hash", "_from")
    return chunks.select(
        *names,
        F.explode(
            F.sequence("_from", F.least(F.col("_last"), F.col("_from") + F.lit(chunk - 1)))
        ).alias("dq_rank"),
    )


# ---------------------------------------------------------------- samples


@dataclass(frozen=True)
class Sought:
    """Rows that one check wants samples of. Duplicates are ranked within their key."""

    check_id: str
    found: Column
    failed_column: str | None = None
    key: Column | None = None


def _sought(
    tables: Mapping[str, DataFrame], rules: Sequence[Rule], as_of: Column | None,
    failing: Mapping[str, list[list[str]]],
) -> dict[str, list[Sought]]:
    """By table, the conditions of all checks in `failing`, which has offending keys of key rules."""
    wanted = [rule for rule in rules if rule.id in failing]
    out: dict[str, list[Sought]] = defaultdict(list)
    for table, checks in row_checks(wanted, tables, as_of).items():
        out[table] += [Sought(c.rule.id, c.failing, c.failed_column) for c in checks]
    for rule in wanted:
        if rule.kind not in ("DUPLICATE_PERCENTAGE", "UNIQUE_MAPPING", "FK"):
            continue
        df = resolve(tables, rule.table)
        columns = key_columns(rule)[:1] if rule.kind == "UNIQUE_MAPPING" else key_columns(rule)
        cast = None
        if rule.kind == "FK":
            table, column = reference_of(rule)
            cast = shared_type(df.schema[columns[0]].dataType, resolve(tables, table).schema[column].dataType)
        parts = []
        for c in columns:
            kind = df.schema[c].dataType
            parts.append(
                order_text(F.col(c), kind) if cast is None
                else order_text(F.col(c).cast(cast), T.DataType.fromDDL(cast))
            )
        # Nulls are equal here, and a text never has this character alone for its value.
        key = F.to_json(F.array(*parts))
        keys = [F.to_json(F.array(*[F.lit(x).cast("string") for x in k])) for k in failing[rule.id]]
        found = F.coalesce(key.isin(*keys), F.lit(False))
        ranked = F.array(*parts) if rule.kind == "DUPLICATE_PERCENTAGE" else None
        out[rule.table].append(Sought(rule.id, found, key=ranked))
    return dict(out)


def _table_samples(df: DataFrame, sought: Sequence[Sought], ranked: Sequence[str]) -> DataFrame:
    """Samples of all checks of a table, from one scan: (check_id, at, row)."""
    names = df.columns
    no_key = F.lit(None).cast("array<string>")
    hits = F.array(
        *[
            F.when(
                s.found,
                F.struct(
                    F.lit(s.check_id).alias("check_id"),
                    F.lit(s.failed_column).cast("string").alias("failed_column"),
                    (no_key if s.key is None else s.key).alias("key"),
                ),
            )
            for s in sought
        ]
    )
    found = (
        df.withColumn("_hits", F.array_compact(hits)).where(F.size("_hits") > 0)
        .select(*_as_texts(df), F.explode("_hits").alias("_hit"))
        .select(*names, "_hit.check_id", F.col("_hit.failed_column").alias("_failed_column"),
                F.col("_hit.key").alias("_key"))
    )
    order = [F.col("_failed_column").asc_nulls_first(), *_row_order(names)]
    # The first of equal rows is no duplicate: one more is needed to fill the samples.
    rows = _first_rows(found, ["check_id", "_key"], order, SAMPLE_LIMIT + 1)
    rows = rows.withColumnRenamed("_place", "_rank")
    is_ranked = F.col("check_id").isin(*ranked)
    if ranked:
        rows = rows.where(~is_ranked | (F.col("_rank") > 1))
    first = _first_rows(rows, ["check_id"], [F.col("_key"), F.col("_rank")], SAMPLE_LIMIT)
    swept = F.struct(*names, F.col("_failed_column").alias("failed_column"))
    keyed = F.struct(*names, F.col("_rank").cast("string").alias("dq_rank"))
    options = {"ignoreNullFields": "false"}
    row = F.when(F.col("_failed_column").isNotNull(), F.to_json(swept, options))
    if ranked:
        row = row.when(is_ranked, F.to_json(keyed, options))
    return first.select(
        "check_id", F.col("_place").alias("_at"), row.otherwise(_row_json(names)).alias("row")
    )


def sample_rows(
    tables: Mapping[str, DataFrame], rules: Iterable[Rule], as_of: Column | None = None,
    found: Iterable | None = None,
) -> DataFrame:
    """Up to SAMPLE_LIMIT failing rows per check: (check_id, place, row as JSON).

    `found` are the collected rows of `rules.findings`, at most SAMPLE_LIMIT + 1 per check. By
    default they are counted here. Key rules show rows of their first offending keys.
    """
    rules = list(rules)
    if found is None:
        found = findings(tables, rules, as_of, SAMPLE_LIMIT).collect()
    failing: dict[str, list[list[str]]] = {}
    for r in found:
        if r["key"] is None and r["failure_count"]:
            failing.setdefault(r["check_id"], [])
    for r in found:
        if r["key"] is not None:
            failing.setdefault(r["check_id"], []).append(r["key"])
    ranked = [r.id for r in rules if r.kind == "DUPLICATE_PERCENTAGE" and r.id in failing]
    parts = [
        _table_samples(tables[name], sought, [s.check_id for s in sought if s.check_id in ranked])
        for name, sought in _sought(tables, rules, as_of, failing).items()
    ]
    if not parts:
        spark = next(iter(tables.values())).sparkSession
        return spark.createDataFrame([], "check_id string, place int, row string")
    united = reduce(DataFrame.unionByName, parts)
    # Sweeps sample every table they touch; the first SAMPLE_LIMIT rows are kept.
    first = _first_rows(united, ["check_id"], [F.col("_at"), F.col("row")], SAMPLE_LIMIT)
    return first.select("check_id", F.col("_place").alias("place"), "row")


def sample_json(samples: DataFrame) -> DataFrame:
    """Samples of each check as one JSON array: (check_id, sample_bad_rows_json)."""
    rows = F.array_sort(F.collect_list(F.struct("place", "row")))
    texts = F.transform(rows, lambda r: r["row"])
    return samples.groupBy("check_id").agg(
        F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]")).alias("sample_bad_rows_json")
    )
