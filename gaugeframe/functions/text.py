"""Text cleaning expressions (CL1-CL6)."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The Unicode space separators (general category Zs). Tabs and line breaks
# are deliberately not among them.
SPACE_SEPARATORS = (
    "\u0020\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u202f\u205f\u3000"
)


def strip_spaces(c: Column) -> Column:
    """Remove leading and trailing Unicode space separators."""
    return F.trim(c, F.lit(SPACE_SEPARATORS))


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def clean_text(c: Column) -> Column:
    """CL1: strip; an empty result becomes NULL."""
    return empty_to_null(strip_spaces(c))


def clean_lower(c: Column) -> Column:
    """CL2: strip and lower-case; an empty result becomes NULL."""
    return empty_to_null(F.lower(strip_spaces(c)))


def alias_key(c: Column) -> Column:
    """The form in which synonyms are looked up."""
    return F.lower(strip_spaces(c))


def canonicalise(c: Column, aliases: Mapping[str, str], fallback: Column) -> Column:
    """CL3: replace known synonyms by their canonical value, else use `fallback`.

    The lookup is a constant map, folded once at planning time, which suits configuration-sized vocabularies. For
    vocabularies that are data, use `canonicalise_by_table`.
    """
    if not aliases:
        return empty_to_null(fallback)
    known = F.from_json(F.lit(json.dumps(dict(aliases))), "map<string,string>")
    found = F.try_element_at(known, alias_key(c))
    return empty_to_null(F.coalesce(found, fallback))


def canonicalise_by_table(
    df: DataFrame, column: str, aliases: DataFrame, fallback: Column,
    map_rows: int = 10_000, broadcast_bytes: int = 64 << 20, slices: int = 16,
) -> DataFrame:
    """CL3 for a vocabulary that is data: `aliases` has columns (alias, canonical).

    The vocabulary is made unique and measured first. Up to `map_rows` aliases become a constant
    map; up to `broadcast_bytes` of text are broadcast. A larger one is joined by alias and a
    slice of the row hash, to each of which the vocabulary is repeated: rows of a hot alias are
    dealt to `slices` places, not one. Planned sizes do not count the repeats, so that join is
    told to sort and merge: left to choose, it may broadcast `slices` vocabularies.
    """
    vocabulary = (
        aliases.where("alias IS NOT NULL").groupBy(F.col("alias").alias("_alias"))
        .agg(F.min("canonical").alias("_canonical"))
    )
    size = F.sum(F.octet_length("_alias") + F.coalesce(F.octet_length("_canonical"), F.lit(0)) + 32)
    rows, octets = vocabulary.agg(F.count(F.lit(1)), F.coalesce(size, F.lit(0))).first()
    if rows <= map_rows and octets <= broadcast_bytes:
        known = {r["_alias"]: r["_canonical"] for r in vocabulary.collect()}
        return df.withColumn(column, canonicalise(F.col(column), known, fallback))
    keyed = df.withColumn("_alias", alias_key(F.col(column)))
    keys = ["_alias"]
    if octets <= broadcast_bytes:
        vocabulary = F.broadcast(vocabulary)
    else:
        keys.append("_slice")
        keyed = keyed.withColumn("_slice", F.pmod(F.xxhash64(*df.columns), F.lit(slices)).cast("int"))
        places = F.sequence(F.lit(0), F.lit(slices - 1))
        vocabulary = vocabulary.withColumn("_slice", F.explode(places)).hint("merge")
    joined = keyed.join(vocabulary, keys, "left")
    value = empty_to_null(F.coalesce(F.col("_canonical"), fallback))
    return joined.select(*[value.alias(n) if n == column else F.col(n) for n in df.columns])
