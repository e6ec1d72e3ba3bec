"""Mixing sources to target weights: Sainte-Lague apportionment of equal-token blocks.

Sources get targets by weight, none above `limit` times its size, the excess shared again by
weight. Documents are dealt to shards by a hash of their ids, and the shard's documents of one
source, in seeded order, are one stream of words cut into equal blocks. In each shard the
blocks go to the sources by highest quotients t / (2q + 1), t being the part of the target that
falls to the shard by size. A source with quota q over n blocks takes every block q div n times
and the first q mod n blocks of its seeded order once more.

Skew: a hot source is spread over all shards; a shard holds a bounded number of documents. Sums
per source and shard are combined before they are shuffled. One row per source, and no more,
meets in one task for the targets.

Defined results: a null or empty text has size 0 and is never taken. A null source is a source,
the last one. Repeated rows are documents of their own; rows that agree in id and size are
interchangeable. Rows without id are dealt by size and source. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeframe.llm.common import stored, text_of, words


@dataclass(frozen=True)
class Mix:
    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    share: float = 1.5
    limit: int = 2
    block: int = 16
    shard_docs: int = 4096
    seed: int = 17


def targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """(source, source_size, target) from (source, source_size), sources in code-point order.

    Sources fill up to their limit in order of limit over weight. The first whose limit is not
    reached by what is left, shared by weight, ends this, and the rest share by weight.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(float(w)) for w in mix.weights])
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.element_at(weights, (F.col("rank") % len(mix.weights) + 1).cast("int"))
    )
    cap = (F.col("source_size") * mix.limit).cast("double")
    by_fill = Window.orderBy(cap / F.col("weight"), "rank")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    total = F.sum("source_size").over(everything) * mix.share
    filled = ranked.withColumns(
        {
            "left": total - F.coalesce(F.sum(cap).over(before), F.lit(0.0)),
            "open": F.sum("weight").over(everything)
            - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
        }
    ).withColumn("unit", F.col("left") / F.col("open"))
    # The unit only grows while sources fill, so the first that does not fill has the last one.
    final = F.min(F.when(F.col("unit") * F.col("weight") <= cap, F.struct("rank_fill", "unit")))
    filled = filled.withColumn("rank_fill", F.row_number().over(by_fill)).withColumn(
        "final", final.over(everything)["unit"]
    )
    return filled.select(
        "source", "source_size",
        F.coalesce(F.least(cap, F.col("final") * F.col("weight")), cap).alias("target"),
    )


def sainte_lague(parts: list[float], seats: int, most: list[int]) -> list[int]:
    """Quotas that sum to `seats`, as far as `most` allows, by highest quotients t / (2q + 1).

    Starts from the rounded shares, which hold the same quotients up to a few, and then takes
    back or hands out seats one by one. Ties go to the earlier part.
    """
    total = sum(parts)
    if total <= 0:
        return [0] * len(parts)
    quota = [min(m, max(0, int(t * seats / total) - 1)) for t, m in zip(parts, most)]
    heap = [(-t / (2 * q + 1), i) for i, (t, q) in enumerate(zip(parts, quota)) if q < most[i]]
    heapq.heapify(heap)
    left = seats - sum(quota)
    while left > 0 and heap:
        _, i = heapq.heappop(heap)
        quota[i] += 1
        left -= 1
        if quota[i] < most[i]:
            heapq.heappush(heap, (-parts[i] / (2 * quota[i] + 1), i))
    return quota


def _quotas(entitled: DataFrame, mix: Mix) -> DataFrame:
    """(shard, source, quota) from (shard, source, words, part)."""

    def apportion(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("source", na_position="last").reset_index(drop=True)
        blocks = [-(-int(w) // mix.block) for w in pdf["words"]]
        seats = round(float(pdf["part"].sum()) / mix.block)
        quota = sainte_lague(list(pdf["part"]), seats, [mix.limit * b for b in blocks])
        return pdf[["shard", "source"]].assign(quota=quota)

    return entitled.groupBy("shard").applyInPandas(
        apportion, "shard long, source string, quota long"
    )


def mixed(
    docs: DataFrame, mix: Mix = Mix(), doc_id: str = "doc_id", text: str = "text",
    source: str = "source", keep: tuple[str, ...] = (),
) -> DataFrame:
    """(doc_id, size, source, source_size, target, taken) and the columns `keep` per row."""
    base = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"),
        F.size(words(text_of(text))).cast("long").alias("size"), *keep,
    )
    n_docs = docs.count()
    shards = max(1, -(-n_docs // mix.shard_docs))
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("size", "source")).otherwise(
        F.xxhash64(F.lit(mix.seed), "doc_id")
    )
    slim = ("doc_id", "source", "size", "order", "shard")
    sized = base.withColumn("order", spread).withColumn(
        "shard", F.pmod(F.xxhash64("order"), F.lit(shards)).cast("long")
    )
    if not keep:
        sized = stored(sized.select(*slim), "sizes")
    by_shard = stored(
        sized.groupBy("shard", "source").agg(F.sum("size").alias("words")), "shard-sizes"
    )
    aims = stored(
        targets(by_shard.groupBy("source").agg(F.sum("words").alias("source_size")), mix), "targets"
    )

    def same(a: Column, b: Column) -> Column:
        return a.eqNullSafe(b)

    entitled = (
        by_shard.alias("s").join(aims.alias("t"), same(F.col("s.source"), F.col("t.source")))
        .select(
            "shard", "s.source", "words", "source_size", "target",
            F.when(F.col("source_size") > 0, F.col("target") * F.col("words") / F.col("source_size"))
            .otherwise(0.0).alias("part"),
        )
    )
    entitled = stored(entitled, "parts")
    quotas = stored(
        entitled.alias("e").join(
            _quotas(entitled.select("shard", "source", "words", "part"), mix).alias("q"),
            (F.col("e.shard") == F.col("q.shard")) & same(F.col("e.source"), F.col("q.source")),
        ).select("e.shard", "e.source", "words", "source_size", "target", "quota"),
        "quotas",
    )
    stream = Window.partitionBy("shard", "source").orderBy("order", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    placed = sized.withColumn("end", F.sum("size").over(stream))
    blocks = F.ceil(F.col("words") / mix.block)
    every = F.when(blocks > 0, F.floor(F.col("quota") / blocks)).otherwise(0)
    once_more = F.col("quota") - every * blocks
    start = F.col("end") - F.col("size")
    inside = F.greatest(F.lit(0), F.least(F.col("end"), once_more * mix.block) - start)
    return (
        placed.alias("d").join(
            quotas.alias("q"),
            (F.col("d.shard") == F.col("q.shard")) & same(F.col("d.source"), F.col("q.source")),
        )
        .select(
            F.col("doc_id").alias(doc_id), "size", F.col("d.source").alias("source"),
            "source_size", "target", (every * F.col("size") + inside).cast("long").alias("taken"),
            *keep,
        )
    )


def repeated(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it: whole texts, up to `limit` times.

    A text of which a block boundary takes a part is taken whole if that is at least half.
    """
    held = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = mixed(docs.select("doc_id", "text", "source", held), mix, keep=("_row",))
    copies = F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(0)
    return (
        rows.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), copies.cast("int"))))
        .select("_row.*")
    )
