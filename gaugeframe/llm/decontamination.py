"""Benchmark passages in documents, found by a prefix-filtered set join of word shingles.

A benchmark item gives its windows of consecutive words; an item with fewer words is one window.
A window occurs in a document where all its shingles do, at their places.

1. Windows become shingles. A bitmap of fixed size tells, without false negatives, which shingles
   some window has. Tasks read each document once and keep its passages: the longest runs of
   words whose shingles all pass. A window can only occur inside a passage. Equal texts are one
   text, and equal passages of different texts are one passage from here on.
2. Shingles are ordered by rarity, the number of texts whose passages hold them. Containment is
   asked in full, so that of a window's n shingles a prefix of n - n + 1 = 1 is necessary: its
   rarest. Windows with a shingle in no passage are out.
3. Passages join windows on the prefix. A match fixes the one place where the window could stand:
   it must begin in the passage (positional bound) and end in it (length bound).
4. The passage's words at that place, as many as the window has, are compared with the window's.

Windows shorter than a shingle are shingles themselves, joined apart from longer ones.

Hot passages: occurrences are found and merged once per distinct passage; what is joined back
are rows of texts, whose skew the adaptive join may split. Nothing is collected but the lengths
of windows and the bitmap.

Defined results: words are maximal runs of ASCII letters, digits and characters beyond ASCII,
lower-cased in A-Z. Null and texts without words give no window and have no hit. Every document
row gives one row, rows that share or lack an id included. Items that share an id are one item
with the windows of all; an item without id marks words but counts as no item. Overlapping
windows count their words once. Other columns play no part; empty tables are allowed.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from gaugeframe.llm.common import stored
from gaugeframe.llm.near_dedup import text_keys
from gaugeframe.llm.terms import TERM, Terms, mix, terms_of

_U = np.uint64


@dataclass(frozen=True)
class Decontamination:
    """Windows of `window` words, compared through shingles of `shingle` words."""

    window: int = 10
    shingle: int = 4
    # 2^26 bits are 8 MB. More windows than it can tell apart cost time, never a hit.
    bitmap_bits: int = 26


# ---------------------------------------------------------------- windows


def windows_of(items: DataFrame, p: Decontamination, item_id: str, text: str) -> DataFrame:
    """Distinct (item_id, w, m, k): a window as words joined by spaces, its number of words, and
    the length of its shingles."""
    lowered = F.translate(
        F.col(text).cast("string"), string.ascii_uppercase, string.ascii_lowercase
    )
    words = items.select(
        F.col(item_id).cast("string").alias("item_id"),
        F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0)).alias("words"),
    ).where(F.size("words") > 0)
    sized = words.withColumn("m", F.least(F.lit(p.window), F.size("words")))
    starts = F.sequence(F.lit(1), F.size("words") - F.col("m") + 1)
    return (
        sized.select("item_id", "words", "m", F.explode(starts).alias("at"))
        .select("item_id", F.array_join(F.slice("words", F.col("at"), F.col("m")), " ").alias("w"), "m")
        .distinct().withColumn("k", F.least("m", F.lit(p.shingle)))
    )


def shingles(words: str, k: str) -> F.Column:
    """The shingles of the array column `words` in order; `k` is not above its size."""
    starts = F.sequence(F.lit(1), F.size(words) - F.col(k) + 1)
    return F.transform(starts, lambda at: F.array_join(F.slice(words, at, F.col(k)), " "))


# ---------------------------------------------------------------- passages


def _shingle_hashes(t: Terms, k: int) -> np.ndarray:
    """A hash for each place where a shingle could begin, whether or not its text is that long."""
    n = max(0, len(t.hashes) - k + 1)
    out = np.full(n, k, _U)
    for i in range(k):
        out = mix(out ^ t.hashes[i : n + i]) + _U(i)
    return out


def _bitmap(windows: DataFrame, p: Decontamination) -> np.ndarray:
    """The bits of all shingles of the windows; at most 2^(bits - 6) rows are collected."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.empty(0, _U)]
            k = batch.column("k").to_numpy(zero_copy_only=False)
            for t in terms_of(batch.column("w")):
                own = k[t.row : t.row + len(t.first) - 1]
                for length in np.unique(own):
                    hashes = _shingle_hashes(t, int(length))
                    for i in np.flatnonzero(own == length):
                        found.append(hashes[t.first[i] : t.first[i + 1] - length + 1])
            bits = np.unique(np.concatenate(found) & _U((1 << p.bitmap_bits) - 1))
            yield pa.record_batch(
                [pa.array((bits >> _U(6)).astype(np.int64)), pa.array((bits & _U(63)).astype(np.int64))],
                names=["word", "bit"],
            )

    rows = (
        windows.select("w", "k").distinct().mapInArrow(places, "word long, bit long")
        .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, cast(bit AS int))")).alias("bits"))
        .toPandas()
    )
    out = np.zeros(1 << (p.bitmap_bits - 6), np.int64)
    out[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return out.view(_U)


def _runs(t: Terms, k: int, least: int, bitmap: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(text, first word, end) of the passages of shingle length `k`, of at least `least` words."""
    hashes = _shingle_hashes(t, k) & _U((len(bitmap) << 6) - 1)
    known = ((bitmap[hashes >> _U(6)] >> (hashes & _U(63))) & _U(1)).astype(bool)
    at = np.flatnonzero(known)
    text = np.searchsorted(t.first, at, side="right") - 1
    fits = at + k <= t.first[text + 1]
    at, text = at[fits], text[fits]
    if not len(at):
        return
    breaks = np.flatnonzero((np.diff(at) != 1) | (np.diff(text) != 0)) + 1
    first, last = np.concatenate(([0], breaks)), np.concatenate((breaks, [len(at)])) - 1
    begin, end = at[first], at[last] + k
    for i in np.flatnonzero(end - begin >= least):
        yield int(text[first[i]]), int(begin[i]), int(end[i])


def passages(
    docs: DataFrame, classes: dict[int, int], bitmap: np.ndarray, doc_id: str, text: str
) -> DataFrame:
    """Per document row: id, text keys, number of words, and its passages (k, start, words).

    `classes` has the shortest window for each shingle length.
    """
    id_type = docs.schema[doc_id].dataType
    run_type = pa.struct([("k", pa.int32()), ("start", pa.int64()), ("words", pa.string())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in terms_of(batch.column("text")):
                rows = len(t.first) - 1
                found: list[list[dict]] = [[] for _ in range(rows)]
                for k, least in classes.items():
                    for i, begin, end in _runs(t, k, least, bitmap):
                        found[i].append(
                            {"k": k, "start": begin - int(t.first[i]), "words": t.text(begin, end)}
                        )
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c).slice(t.row, rows) for c in ("doc", "t1", "t2")],
                        pa.array(np.diff(t.first).astype(np.int64)),
                        pa.array(found, pa.list_(run_type)),
                    ],
                    schema=pa.schema(
                        [("doc", to_arrow_type(id_type)), ("t1", pa.int64()), ("t2", pa.int64()),
                         ("n_words", pa.int64()), ("runs", pa.list_(run_type))]
                    ),
                )

    return docs.select(
        F.col(doc_id).alias("doc"), *text_keys(text), F.col(text).cast("string").alias("text")
    ).mapInArrow(
        scan,
        f"doc {id_type.simpleString()}, t1 long, t2 long, n_words long, "
        "runs array<struct<k: int, start: long, words: string>>",
    )


# ---------------------------------------------------------------- the join


def occurrences(held: DataFrame, windows: DataFrame) -> DataFrame:
    """(p1, p2, k, w, begin, end): where windows stand in the passages (p1, p2, k, words, n)."""
    tokens = stored(
        held.select("p1", "p2", "k", "n", F.size("words").alias("size"),
                    F.posexplode(shingles("words", "k")).alias("at", "token")),
        "tokens",
    )
    rarity = tokens.groupBy("token").agg(F.sum("n").alias("rarity"))
    prefixes = stored(
        windows.select("w", "m", "k").distinct().withColumn("own", F.split("w", " "))
        .select("w", "m", "k", F.posexplode(shingles("own", "k")).alias("offset", "token"))
        .join(rarity, "token").groupBy("w", "m", "k")
        .agg(F.min(F.struct("rarity", "token", "offset")).alias("rarest"), F.count("*").alias("met"))
        .where(F.col("met") == F.col("m") - F.col("k") + 1)
        .select("w", "m", "rarest.token", "rarest.offset"),
        "prefixes",
    )
    begin = F.col("at") - F.col("offset")
    candidates = stored(
        tokens.join(prefixes, "token").withColumn("begin", begin)
        .where((F.col("begin") >= 0) & (F.col("begin") + F.col("m") <= F.col("size")))
        .select("p1", "p2", "k", "w", "m", "begin").distinct(),
        "candidates",
    )
    return (
        candidates.join(held.select("p1", "p2", "k", "words"), ["p1", "p2", "k"])
        .where(F.array_join(F.slice("words", F.col("begin") + 1, F.col("m")), " ") == F.col("w"))
        .select("p1", "p2", "k", "w", F.col("begin").cast("long").alias("begin"),
                (F.col("begin") + F.col("m")).cast("long").alias("end"))
    )


def merged(intervals: DataFrame, keys: list[str]) -> DataFrame:
    """Overlapping and touching intervals (begin, end) of each key as one."""
    order = Window.partitionBy(*keys).orderBy("begin", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("begin") > reached, F.lit(True)).cast("long")
    return (
        intervals.withColumn("_opens", opens).withColumn("_island", F.sum("_opens").over(order))
        .groupBy(*keys, "_island").agg(F.min("begin").alias("begin"), F.max("end").alias("end"))
        .drop("_island")
    )


def contamination(
    docs: DataFrame, items: DataFrame, p: Decontamination = Decontamination(),
    doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text",
) -> DataFrame:
    """(doc_id, n_words, n_hit, items, spans) for every row of `docs`: the ids of the items found
    as sorted texts, and the marked word positions (begin, end)."""
    windows = stored(windows_of(items, p, item_id, text), "windows")
    shortest = windows.groupBy("k").agg(F.min("m").alias("m")).collect()  # one row per length
    classes = {r["k"]: r["m"] for r in shortest}
    found = stored(passages(docs, classes, _bitmap(windows, p), doc_id, text), "passages")
    keys, passage = ["t1", "t2"], ["p1", "p2", "k"]
    runs = stored(
        found.where(F.size("runs") > 0).dropDuplicates(keys).select(*keys, F.inline("runs"))
        .withColumns({"p1": F.xxhash64("words"), "p2": F.xxhash64(F.lit(1), "words")}),
        "runs",
    )
    held = stored(
        runs.groupBy(*passage).agg(F.first("words").alias("words"), F.count("*").alias("n"))
        .withColumn("words", F.split("words", " ")),
        "distinct-passages",
    )
    hits = stored(occurrences(held, windows), "occurrences")

    islands = stored(merged(hits.select(*passage, "begin", "end"), passage), "islands")
    placed = runs.select(*keys, *passage, "start").join(islands, passage).select(
        *keys, (F.col("start") + F.col("begin")).alias("begin"), (F.col("start") + F.col("end")).alias("end")
    )
    marked = stored(
        merged(placed, keys).groupBy(*keys).agg(
            F.sum(F.col("end") - F.col("begin")).alias("n_hit"),
            F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("spans"),
        ),
        "marked",
    )
    named = stored(
        hits.select(*passage, "w").distinct()
        .join(windows.where("item_id IS NOT NULL").select("w", "item_id"), "w")
        .select(*passage, "item_id").distinct(),
        "named",
    )
    of_text = stored(
        runs.select(*keys, *passage).distinct().join(named, passage).select(*keys, "item_id").distinct()
        .groupBy(*keys).agg(F.array_sort(F.collect_list("item_id")).alias("items")),
        "items",
    )
    no_items = F.array().cast("array<string>")
    no_spans = F.array().cast("array<struct<begin: bigint, end: bigint>>")
    return (
        found.select("doc", *keys, "n_words").join(marked, keys, "left").join(of_text, keys, "left")
        .select(
            F.col("doc").alias(doc_id), "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("items", no_items).alias("items"), F.coalesce("spans", no_spans).alias("spans"),
        )
    )


def digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    return contamination(docs, items).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
