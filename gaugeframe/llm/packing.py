"""Best-fit packing under conflicts.

Texts become pieces of at most `capacity` words; a piece that fills a bin has one of its own.
The others go, largest first, into the tightest bin that takes them. Open bins are ordered by
residual; each carries a bitmap of the sources that may not be added any more (those that fill
`source_share` of it) and one of the duplicate clusters it holds. The search starts at the
smallest sufficient residual and continues to the next until both bitmaps allow the piece.

Documents are dealt to groups by a hash, and each group is packed in one task. A group has about
`group_docs` documents, whatever the size of the table, so a hot source or cluster is spread
over all of them; only their small columns are shuffled.

Defined results: texts without words (or null) have one piece of 0 words and no bin. A null
source is a source of its own. Repeated rows are items of their own, of one cluster, so they
never share a bin. An empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeframe.llm.common import stored, text_of, words


@dataclass(frozen=True)
class Packing:
    capacity: int = 2048
    source_share: float = 0.5
    group_docs: int = 8192


class Bins:
    """Open bins of one group, ordered by residual, then number."""

    def __init__(self, p: Packing):
        self.p = p
        self.order: list[tuple[int, int]] = []
        self.full_sources: list[int] = []
        self.clusters: list[int] = []
        self.source_words: list[dict[int, int]] = []
        self.source_bit: dict[object, int] = {}
        self.cluster_bit: dict[object, int] = {}

    def place(self, size: int, source: object, cluster: object) -> tuple[int, int]:
        """(bin, offset) of a new item."""
        s = self.source_bit.setdefault(source, len(self.source_bit))
        c = self.cluster_bit.setdefault(cluster, len(self.cluster_bit))
        at = bisect_left(self.order, (size, -1))
        while at < len(self.order):
            number = self.order[at][1]
            if not (self.full_sources[number] >> s & 1 or self.clusters[number] >> c & 1):
                break
            at += 1
        if at < len(self.order):
            residual, number = self.order.pop(at)
        else:
            residual, number = self.p.capacity, len(self.clusters)
            self.full_sources.append(0)
            self.clusters.append(0)
            self.source_words.append({})
        held = self.source_words[number]
        held[s] = held.get(s, 0) + size
        if held[s] >= self.p.source_share * self.p.capacity:
            self.full_sources[number] |= 1 << s
        self.clusters[number] |= 1 << c
        if residual > size:
            insort(self.order, (residual - size, number))
        return number, self.p.capacity - residual


def pack(
    docs: DataFrame, p: Packing = Packing(), doc_id: str = "doc_id", text: str = "text",
    source: str = "source", cluster: str | None = None,
) -> DataFrame:
    """One row per piece: doc_id, source, piece, first_word, n_words, bin, bin_offset.

    `cluster` names a column of duplicate clusters; without one, equal texts are a cluster.
    Bins are numbered within groups: `<group>-<number>`.
    """
    same = F.col(cluster).cast("string") if cluster else F.sha1(text_of(text).cast("binary"))
    items = stored(
        docs.select(
            F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"),
            same.alias("cluster"), F.size(words(text_of(text))).cast("long").alias("size"),
        ),
        "items",
    )
    groups = max(1, -(-items.count() // p.group_docs))
    dealt = items.withColumn("group", F.pmod(F.xxhash64("doc_id", "cluster"), F.lit(groups)))

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        group = int(pdf["group"].iloc[0])
        keys = ["size", "order", "source", "cluster"]
        pdf["order"] = pd.array([None if d is None else int(d) for d in pdf["doc_id"]], "Int64")
        pdf = pdf.sort_values(keys, ascending=[False, True, True, True], na_position="last")
        out, rest, whole = [], [], 0
        for row in zip(pdf["doc_id"], pdf["source"], pdf["cluster"], pdf["size"]):
            doc, origin, _, size = row
            if size == 0:
                out.append((doc, origin, 0, 0, 0, None, None))
            for piece, first in enumerate(range(0, size, p.capacity)):
                n = min(p.capacity, size - first)
                if n == p.capacity:
                    out.append((doc, origin, piece, first, n, f"{group}-w{whole}", 0))
                    whole += 1
                else:
                    rest.append((n, piece, first, *row))
        bins = Bins(p)
        for n, piece, first, doc, origin, copies, _ in sorted(rest, key=lambda r: -r[0]):
            number, offset = bins.place(n, origin, copies)
            out.append((doc, origin, piece, first, n, f"{group}-{number}", offset))
        result = pd.DataFrame(
            out,
            columns=["doc_id", "source", "piece", "first_word", "n_words", "bin", "bin_offset"],
        )
        return result.astype({"bin_offset": "Int64"})

    # Ids as text: beside nulls pandas would round large numbers.
    return dealt.withColumn("doc_id", F.col("doc_id").cast("long").cast("string")).groupBy("group").applyInPandas(
        fill,
        "doc_id string, source string, piece int, first_word long, n_words long, bin string, "
        "bin_offset long",
    ).withColumn("doc_id", F.col("doc_id").cast("long"))
