"""The nine rule types as Spark plans.

A table is scanned once, whatever its rules. One aggregate, the table's summary, counts its rows
by several sets of columns: per

* set of row rules that fail together (NULL_PERCENTAGE, PATTERN, DATE_RANGE, TIMESTAMP_ORDER,
  ENUM, NON_NEGATIVE_COUNTS), as bits of a number;
* key of each duplicate rule and (key, value) of each mapping (DUPLICATE_PERCENTAGE,
  UNIQUE_MAPPING);
* key of each reference, on the referring and on the referred side alike (FK).

A summary by one set folds its rows in the tasks of the scan, which turns a hot key into one row per
task before anything is shuffled. With more sets that fold would hold several keys for every row of
a split, so rows are dealt by set and key to all the session's partitions and counted there: keys of
mappings and references, and NULL, in slices of the row hash, other keys of duplicate rules in one
place, as the rows of each are to be known. The summaries of all tables then become shares (rule,
key, rows, ...), which meet in one aggregate per rule and key: there a mapping sees the values of a
key, and a reference whether the other table knows the key. No rows are joined, and no table is read
for another's rule.

The outcome is `(check_id, failure_count, total_rows)`. With `by`, the same passes evaluate
many runs at once, one result per run and check.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeframe.config import Rule
from gaugeframe.functions.text import strip_spaces
from gaugeframe.functions.timestamps import utc_now
from gaugeframe.session import local_frame

ROW_KINDS = frozenset(
    {"NULL_PERCENTAGE", "PATTERN", "DATE_RANGE", "TIMESTAMP_ORDER", "ENUM", "NON_NEGATIVE_COUNTS"}
)
KEY_KINDS = frozenset({"DUPLICATE_PERCENTAGE", "UNIQUE_MAPPING"})
ALL_KINDS = ROW_KINDS | KEY_KINDS | {"FK"}


@dataclass(frozen=True)
class RowCheck:
    """One failing-row condition of one table; `failed_column` is set for column sweeps."""

    rule: Rule
    table: str
    failing: Column
    failed_column: str | None = None


# ---------------------------------------------------------------- row rules


def java_regex(pattern: str) -> str:
    """R2: a trailing `$` means the very end of the text, not "before a last line break"."""
    backslashes = len(pattern[:-1]) - len(pattern[:-1].rstrip("\\"))
    if pattern.endswith("$") and backslashes % 2 == 0:
        return pattern[:-1] + r"\z"
    return pattern


def time_bound(text: str, as_of: Column | None) -> Column:
    """A bound in ISO form, or `now`."""
    if text.strip().lower() == "now":
        return as_of if as_of is not None else utc_now()
    moment = datetime.fromisoformat(text.strip())
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def _column(rule: Rule) -> Column:
    if not rule.columns:
        raise ValueError(f"Rule {rule.id} names no column")
    return F.col(rule.columns[0])


def _out_of_order(before: Column, after: Column) -> Column:
    return after.isNotNull() & (before.isNull() | (before > after))


def failing_condition(rule: Rule, as_of: Column | None = None) -> Column:
    """The condition under which a row fails a row rule; never NULL."""
    if rule.kind == "NULL_PERCENTAGE":
        return _column(rule).isNull()
    if rule.kind == "PATTERN":
        matches = strip_spaces(_column(rule)).rlike(java_regex(rule.args[0]))
        condition = ~matches
    elif rule.kind == "DATE_RANGE":
        start, end = rule.args[0], rule.args[1]
        c = _column(rule)
        condition = (c < time_bound(start, as_of)) | (c > time_bound(end, as_of))
    elif rule.kind == "ENUM":
        allowed = [value.lower() for value in rule.args]
        condition = ~F.lower(strip_spaces(_column(rule))).isin(allowed)
    elif rule.kind == "TIMESTAMP_ORDER":
        steps = [
            _out_of_order(F.col(before), F.col(after))
            for before, after in zip(rule.columns, rule.columns[1:])
        ]
        condition = reduce(or_, steps) if steps else F.lit(False)
    else:
        raise ValueError(f"{rule.rule_type} is not a row rule")
    return F.coalesce(condition, F.lit(False))


def counted_columns(rule: Rule, tables: Mapping[str, DataFrame]) -> list[tuple[str, str]]:
    """Every numeric column, of any table, whose name matches the rule's pattern."""
    pattern = re.compile(rule.column_regex or "", re.IGNORECASE)
    return [
        (name, f.name)
        for name in sorted(tables)
        for f in tables[name].schema.fields
        if pattern.search(f.name) and isinstance(f.dataType, T.NumericType)
    ]


def skipped_columns(rule: Rule, tables: Mapping[str, DataFrame]) -> list[tuple[str, str]]:
    """Matching columns left out because they hold no numbers."""
    pattern = re.compile(rule.column_regex or "", re.IGNORECASE)
    return [
        (name, f.name)
        for name in sorted(tables)
        for f in tables[name].schema.fields
        if pattern.search(f.name) and not isinstance(f.dataType, T.NumericType)
    ]


def skipped_report(
    spark: SparkSession, rules: Iterable[Rule], tables: Mapping[str, DataFrame]
) -> DataFrame:
    """The columns that sweeps skipped, with their types."""
    rows = [
        (rule.id, table, column, tables[table].schema[column].dataType.simpleString())
        for rule in rules if rule.kind == "NON_NEGATIVE_COUNTS"
        for table, column in skipped_columns(rule, tables)
    ]
    return local_frame(spark, rows, "check_id string, table_name string, column_name string, type string")


def row_checks(
    rules: Iterable[Rule], tables: Mapping[str, DataFrame], as_of: Column | None = None
) -> dict[str, list[RowCheck]]:
    """Row rules compiled to conditions, grouped by the table they read."""
    grouped: dict[str, list[RowCheck]] = defaultdict(list)
    for rule in rules:
        if rule.kind == "NON_NEGATIVE_COUNTS":
            for table, column in counted_columns(rule, tables):
                failing = F.coalesce(F.col(column) < 0, F.lit(False))
                grouped[table].append(RowCheck(rule, table, failing, column))
        elif rule.kind in ROW_KINDS:
            resolve(tables, rule.table)
            failing = failing_condition(rule, as_of)
            grouped[rule.table].append(RowCheck(rule, rule.table, failing))
    return dict(grouped)


# ---------------------------------------------------------------- table summaries


def key_columns(rule: Rule) -> tuple[str, ...]:
    if rule.kind == "UNIQUE_MAPPING":
        key, value = rule.args
        return (key, value)
    if not rule.columns:
        raise ValueError(f"Rule {rule.id} names no column")
    return rule.columns


def reference_of(rule: Rule) -> tuple[str, str]:
    """The referenced table and column."""
    table, _, column = rule.args[0].partition(".")
    return table, column


@dataclass(frozen=True)
class Need:
    """Columns of one table whose keys a rule wants counted. `referred` is the far side of R9."""

    rule: Rule
    table: str
    columns: tuple[str, ...]
    referred: bool = False


def needs(rules: Iterable[Rule], tables: Mapping[str, DataFrame]) -> list[Need]:
    """What the rules read of each table; row rules need no keys."""
    out = []
    for rule in rules:
        if rule.kind == "NON_NEGATIVE_COUNTS":
            out += [Need(rule, t, ()) for t in dict.fromkeys(t for t, _ in counted_columns(rule, tables))]
        elif rule.kind in ROW_KINDS:
            out.append(Need(rule, rule.table, ()))
        else:
            out.append(Need(rule, rule.table, key_columns(rule)))
            if rule.kind == "FK":
                table, column = reference_of(rule)
                out.append(Need(rule, table, (column,), referred=True))
    return out


_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def shared_type(one: T.DataType, other: T.DataType) -> str | None:
    """The type in which two columns are compared; None where their own will do."""
    if one == other:
        return None
    if isinstance(one, _INTEGRAL) and isinstance(other, _INTEGRAL):
        return "bigint"
    if isinstance(one, T.NumericType) and isinstance(other, T.NumericType):
        return "double"
    return "string"


def order_text(c: Column, data_type: T.DataType) -> Column:
    """A text per value that tells values apart and, fractional numbers aside, sorts as they do."""
    if isinstance(data_type, T.DateType):
        c, data_type = F.unix_date(c), T.IntegerType()
    elif isinstance(data_type, T.TimestampNTZType | T.TimestampType):
        c, data_type = F.unix_micros(c.cast("timestamp")), T.LongType()
    if isinstance(data_type, _INTEGRAL):
        # Negative numbers sort as "0..", in complement; others as "1..".
        digits = F.lpad(F.hex(c.cast("bigint").bitwiseAND(F.lit(2**63 - 1))), 16, "0")
        return F.when(c.isNotNull(), F.concat(F.when(c < 0, "0").otherwise("1"), digits))
    if isinstance(data_type, T.FloatType | T.DoubleType):
        plain = F.when(c == 0, F.lit(0.0)).otherwise(c.cast("double"))  # one zero
        return plain.cast("string")
    return c.cast("string")


_MASK_BITS = 62
# Shares without a key of a rule, and the rows of a hot key, are dealt to this many places.
_SLICES = 64
# One share of a summary row in a rule's outcome.
_SHARE = (
    "rule int, key array<string>, rows bigint, failing bigint, filled int, known int"
)


@dataclass(frozen=True)
class Summary:
    """Rows of one table counted by every key its rules need: (by..., _set, _k..., _m..., _n).

    Counts of a key add up. Those of sets asked for whole come in one row, unless the key is NULL.
    """

    counted: DataFrame
    sets: Mapping[tuple[str, ...], int]
    names: Mapping[str, str]
    types: Mapping[str, T.DataType]
    checks: Sequence[RowCheck]

    def rows_of(self, columns: tuple[str, ...]) -> Column:
        return F.col("_set") == self.sets[tuple(sorted(set(columns)))]

    def key(self, columns: Sequence[str], cast: str | None = None) -> Column:
        kinds = {c: self.types[c] for c in columns}
        parts = []
        for c in columns:
            own = F.col(self.names[c])
            if cast is not None:
                own = own.cast(cast)
                kinds[c] = T.DataType.fromDDL(cast)
            parts.append(order_text(own, kinds[c]))
        return F.array(*parts)


def session_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def summarise(
    df: DataFrame, checks: Sequence[RowCheck], key_sets: Iterable[tuple[str, ...]], by: Sequence[str],
    whole: Iterable[tuple[str, ...]] = (),
) -> Summary:
    """One scan: counts per key of each set of columns, and per combination of failing checks.

    `whole` are the sets whose counts per key must not come in slices.
    """
    sets = list(dict.fromkeys(tuple(sorted(set(columns))) for columns in key_sets))
    keys = sorted({c for one in sets for c in one})
    names = {c: f"_k{i}" for i, c in enumerate(keys)}
    masks = []
    for at in range(0, len(checks), _MASK_BITS):
        bits = [
            F.when(check.failing, F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint")
            for i, check in enumerate(checks[at : at + _MASK_BITS])
        ]
        masks.append(reduce(Column.__add__, bits).alias(f"_m{at // _MASK_BITS}"))
    mask_names = [f"_m{i}" for i in range(len(masks))]
    slim = df.select(*by, *[F.col(c).alias(n) for c, n in names.items()], *masks)
    grouped = [*names.values(), *mask_names]
    wanted = [[names[c] for c in one] for one in sets]
    if masks:
        wanted.append(mask_names)
    count = F.count(F.lit(1)).alias("_n")
    if len(wanted) == 1:
        counted = slim.groupBy(*by, *grouped).agg(F.lit(0).cast("bigint").alias("_set"), count)
    else:
        marks = {f"_s{i}": F.lit(i).cast("bigint") for i in range(len(wanted))}
        deal = F.pmod(F.xxhash64(*slim.columns), F.lit(_SLICES)).cast("int")
        # A row per set, in which only the columns of the set are filled.
        rows = (
            slim.withColumns({"_deal": deal, **marks})
            .unpivot([*slim.columns, "_deal"], list(marks), "_mark", "_set")
            .withColumns({
                c: F.when(F.col("_set").isin([i for i, one in enumerate(wanted) if c in one]), F.col(c))
                for c in grouped
            })
        )
        exact = {tuple(sorted(set(columns))) for columns in whole}
        undealt = F.col("_set").isin([i for i, one in enumerate(sets) if one in exact])
        filled = reduce(or_, [F.col(n).isNotNull() for n in names.values()])
        rows = rows.withColumn("_deal", F.when(~(undealt & filled), F.col("_deal")))
        # No fold before this shuffle, and a number of partitions that is never merged: either would
        # make a task hold the keys of ever more rows. Run columns may be constants, by which the
        # planner would not know the rows dealt.
        place = ["_set", *grouped, "_deal"]
        dealt = rows.drop("_mark").repartition(session_partitions(df.sparkSession), *place)
        counted = dealt.groupBy(*by, *place).agg(count)
    by_columns = {one: i for i, one in enumerate([*sets, ()] if masks else sets)}
    types = {c: df.schema[c].dataType for c in keys}
    return Summary(counted, by_columns, names, types, checks)


def _share(rule: int, key: Column | None, rows: Column, **more: Column) -> Column:
    parts = {
        "key": F.lit(None) if key is None else key, "rows": rows, "failing": F.lit(0),
        "filled": F.lit(0), "known": F.lit(0), **more,
    }
    return F.struct(F.lit(rule).alias("rule"), *[c.alias(n) for n, c in parts.items()]).cast(
        f"struct<{', '.join(field.replace(' ', ': ', 1) for field in _SHARE.split(', '))}>"
    )


def _shares(
    summary: Summary, own: Sequence[Need], place: Mapping[str, int], casts: Mapping[str, str | None],
    with_keys: bool,
) -> list[Column]:
    """What each row of a summary adds to the rules; NULL where it adds nothing."""
    n, shares = F.col("_n"), []
    for i, check in enumerate(summary.checks):
        bit = F.lit(1 << (i % _MASK_BITS)).cast("bigint")
        fails = F.col(f"_m{i // _MASK_BITS}").bitwiseAND(bit) != 0
        failing = F.when(fails, n).otherwise(0)
        shares.append(
            F.when(summary.rows_of(()), _share(place[check.rule.id], None, n, failing=failing))
        )
    for need in own:
        if not need.columns:
            continue
        rule, columns = place[need.rule.id], need.columns
        if need.rule.kind == "DUPLICATE_PERCENTAGE":
            # Keys that occur once, and all keys where only counts are asked for, fold to one row.
            key = F.when(n > 1, summary.key(columns)) if with_keys else None
            share = _share(rule, key, n, failing=n - 1)
            # The NULL key's counts are yet to be added up.
            filled = reduce(or_, [F.col(summary.names[c]).isNotNull() for c in columns])
            share = F.when(filled, share).otherwise(_share(rule, summary.key(columns), n))
        elif need.rule.kind == "UNIQUE_MAPPING":
            held, value = (F.col(summary.names[c]).isNotNull() for c in columns)
            key = F.when(held, summary.key(columns[:1]))
            share = _share(rule, key, n, filled=value.cast("int"))
        else:
            held = F.col(summary.names[columns[0]]).isNotNull()
            key = F.when(held, summary.key(columns, casts[need.rule.id]))
            share = _share(rule, key, n)
            if need.referred:
                share = F.when(held, _share(rule, key, F.lit(0), known=F.lit(1)))
        shares.append(F.when(summary.rows_of(columns), share))
    return shares


def _reference_casts(rules: Iterable[Rule], tables: Mapping[str, DataFrame]) -> dict[str, str | None]:
    casts = {}
    for rule in rules:
        if rule.kind == "FK":
            table, column = reference_of(rule)
            ends = [resolve(tables, rule.table).schema[rule.columns[0]], resolve(tables, table).schema[column]]
            casts[rule.id] = shared_type(*[end.dataType for end in ends])
    return casts


def _per_key(
    tables: Mapping[str, DataFrame], rules: Sequence[Rule], as_of: Column | None,
    by: Sequence[str], with_keys: bool,
) -> DataFrame:
    """Rows (by..., rule, key, rows, failing) of every rule, by its place in `rules`.

    A key has one row (per run); rows without a key, which only add up, come in up to _SLICES.
    """
    row_checks_of = row_checks(rules, tables, as_of)
    needed: dict[str, list[Need]] = defaultdict(list)
    for need in needs(rules, tables):
        resolve(tables, need.table)
        needed[need.table].append(need)
    if not needed:
        raise ValueError("No rule applies to the given tables")
    place = {rule.id: i for i, rule in enumerate(rules)}
    casts = _reference_casts(rules, tables)
    # The far side of a reference need not know of runs; it then holds for all of them.
    kinds = {
        c: next(tables[t].schema[c].dataType for t in needed if c in tables[t].columns) for c in by
    }
    parts = []
    for name, own in needed.items():
        df = tables[name]
        runs = [c for c in by if c in df.columns]
        for need in own:
            if len(runs) < len(by) and not need.referred:
                raise ValueError(f"Table '{name}' has rules but lacks a column of {list(by)}")
        sets = [need.columns for need in own if need.columns]
        whole = [need.columns for need in own if need.rule.kind == "DUPLICATE_PERCENTAGE"]
        summary = summarise(df, row_checks_of.get(name, ()), sets, runs, whole)
        shares = F.array_compact(F.array(*_shares(summary, own, place, casts, with_keys)))
        run = [
            (F.when(F.col("known") == 0, F.col(c)) if c in runs else F.lit(None)).cast(kinds[c]).alias(c)
            for c in by
        ]
        spread = F.pmod(F.xxhash64(*summary.counted.columns), F.lit(_SLICES)).cast("int")
        counted = summary.counted.select(*runs, spread.alias("_slice"), F.inline(shares))
        slice_ = F.when(F.col("key").isNull(), F.col("_slice")).alias("_slice")
        parts.append(counted.select(*run, "rule", "key", slice_, "rows", "failing", "filled", "known"))
    of_kind = {
        kind: [place[r.id] for r in rules if r.kind == kind]
        for kind in ("DUPLICATE_PERCENTAGE", "UNIQUE_MAPPING", "FK")
    }
    # The summaries have folded what they could: another fold before the shuffle would hold all
    # keys of a task once more. The shuffle has all the session's partitions, so none is merged
    # into a task of many keys, and serves the window below too.
    united = reduce(DataFrame.unionByName, parts)
    partitions = session_partitions(united.sparkSession)
    place_of = ["rule", "key", "_slice"]
    met = united.repartition(partitions, *place_of).groupBy(*by, *place_of).agg(
        F.sum("rows").alias("rows"), F.sum("failing").alias("failing"),
        F.sum("filled").alias("filled"), F.max("known").alias("known"),
    )
    if by and of_kind["FK"]:
        # A key has a row per run here, so no partition of this window holds more than that.
        known = F.max("known").over(Window.partitionBy(*place_of))
        met = met.withColumn("known", known).where(" AND ".join(f"{c} IS NOT NULL" for c in by))
    offends = (F.col("rule").isin(of_kind["UNIQUE_MAPPING"]) & (F.col("filled") > 1)) | (
        F.col("rule").isin(of_kind["FK"]) & (F.col("known") == 0)
    )
    repeated = F.col("rule").isin(of_kind["DUPLICATE_PERCENTAGE"])
    failing = (
        F.when(F.col("key").isNull(), F.col("failing"))
        .when(repeated, F.col("rows") - 1)
        .when(offends, F.col("rows"))
        .otherwise(F.col("failing"))
    )
    return met.select(*by, "rule", "key", "rows", failing.alias("failing"))


# ---------------------------------------------------------------- all rules


def resolve(tables: Mapping[str, DataFrame], name: str) -> DataFrame:
    if name not in tables:
        raise ValueError(f"Missing staging table for '{name}'")
    return tables[name]


def _checked(rules: Iterable[Rule]) -> list[Rule]:
    rules = list(rules)
    unknown = sorted({r.rule_type for r in rules if r.kind not in ALL_KINDS})
    if unknown:
        raise ValueError(f"No handler for rule type {', '.join(unknown)}")
    return rules


def _ids(rules: Sequence[Rule]) -> Column:
    return F.get(F.array(*[F.lit(r.id) for r in rules]), F.col("rule")).alias("check_id")


def count_failures(
    tables: Mapping[str, DataFrame],
    rules: Iterable[Rule],
    as_of: Column | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Failing and total rows of every rule: (by..., check_id, failure_count, total_rows).

    A rule that finds no rows at all, or no column, is absent here; `check_results` adds it
    back with zero counts.
    """
    rules = _checked(rules)
    return (
        _per_key(tables, rules, as_of, by, with_keys=False)
        .groupBy(*by, "rule")
        .agg(F.sum("failing").alias("failure_count"), F.sum("rows").alias("total_rows"))
        .select(*by, _ids(rules), "failure_count", "total_rows")
    )


def findings(
    tables: Mapping[str, DataFrame],
    rules: Iterable[Rule],
    as_of: Column | None = None,
    keys: int = 5,
) -> DataFrame:
    """What `count_failures` counts, and from the same scans the first `keys` offending keys.

    (check_id, key, failure_count, total_rows): a row without key has the counts; each further
    row of a check has a key (as ordered texts, see `order_text`) with its failing rows. At
    most `keys` + 1 rows per check, cut in every task before the last shuffle.
    """
    rules = _checked(rules)
    whole = F.struct(F.lit(True).alias("whole"), F.lit(None).cast("array<string>").alias("key"))
    one = F.struct(F.lit(False).alias("whole"), F.col("key").alias("key"))
    both = F.array_compact(
        F.array(whole, F.when(F.col("key").isNotNull() & (F.col("failing") > 0), one))
    )
    tallies = (
        _per_key(tables, rules, as_of, (), with_keys=True)
        .select("rule", "failing", "rows", F.inline(both))
        .groupBy("rule", "whole", "key")
        .agg(F.sum("failing").alias("failure_count"), F.sum("rows").alias("total_rows"))
    )
    first = F.row_number().over(Window.partitionBy("rule", "whole").orderBy("key"))
    return (
        tallies.withColumn("place", first).where(F.col("place") <= keys)
        .select(_ids(rules), "key", "failure_count", "total_rows")
    )
