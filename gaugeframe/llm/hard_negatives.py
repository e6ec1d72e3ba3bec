"""Hard negatives for anchors, by a secondary sort of packed pair scores.

1. Anchors come in blocks of bounded bytes. A block is broadcast to the vectors, which stay
   where they are; each task multiplies it with its rows, piece by piece.
2. First pass: each task keeps, per anchor, its first rows of the anchor's label. The first of
   all tasks are the anchor's positives, each of which has a window of scores.
3. Second pass: each task keeps, per anchor and window, its first rows of other labels inside.
   The first rows of all data are among the first rows of the tasks, so nothing is lost.
4. What is kept is packed into keys (anchor, descending score, positive before negative, id),
   dealt by anchor and sorted within partitions by `repartitionAndSortWithinPartitions`. One
   pass over the sorted keys opens a window at each positive and gives the negatives that fall
   into open windows. A window only holds scores below its positive's, so it is always open in
   time. The iterator holds an anchor's open windows, never its rows.

A task gives at most `positives * (1 + negatives)` keys per anchor, whatever its rows; so a label
or group of copies that holds most rows makes no key hot.

Defined results: rows without id, without label, or with a vector that is null, empty or holds
null or non-finite components take no part. Only vectors of equal length are compared. Rows that
share an anchor's id are not its candidates; other repeated rows each count. Identical anchor
rows are answered once; an id with several vectors or labels is answered for each. Scores equal,
the smaller id comes first. Positives with a score of 0 admit negatives of 0, those below 0 none.
Components are clipped at 2^62 and scores at 64 bits. Empty tables give no rows, and so do
anchors without positives or without negatives. Other columns play no part.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from gaugeframe.llm.common import stored
from gaugeframe.llm.topk_search import quantized

_NONE = np.iinfo(np.int64).min
_TOP = np.iinfo(np.int64).max
_POSITIVE, _NEGATIVE = 0, 1

RESULT = (
    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
    "negative_score long"
)


@dataclass(frozen=True)
class Mining:
    """Negatives score from `low` to `high` percent of their positive."""

    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90
    scale: int = 256
    block_bytes: int = 1 << 23  # of anchors' vectors in one broadcast
    anchors_at_once: int = 256
    rows_at_once: int = 2048


# ---------------------------------------------------------------- scores


def _matrix(vectors: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), np.int64).reshape(len(vectors), -1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of integer rows, exact, clipped to 64 bits."""
    largest = max(abs(int(x)) for m in (a, b) for x in (m.min(), m.max()))
    if largest**2 * a.shape[1] < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, _NONE + 1, _TOP).astype(np.int64)


class Firsts:
    """Per row of a table of `n` anchors, the first `k` (score, id) by score, then smaller id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), _NONE)
        self.ids = np.full((n, k), _TOP)
        self.place = np.full((n, k), _TOP)  # tells rows apart that share an id

    def offer(self, at: slice, scores: np.ndarray, ids: np.ndarray, place: int) -> None:
        """Scores of the anchors `at` with the next rows; `_NONE` marks those not admitted."""
        held = self.score[at]
        least = held[:, -1]
        if scores.shape[1] > self.k:
            least = np.maximum(least, np.partition(scores, -self.k, axis=1)[:, -self.k])
        who, which = np.nonzero((scores >= least[:, None]) & (scores != _NONE))
        if not len(who):
            return
        n, k = held.shape
        owner = np.concatenate((np.repeat(np.arange(n), k), who))
        score = np.concatenate((held.ravel(), scores[who, which]))
        found = np.concatenate((self.ids[at].ravel(), ids[which]))
        spot = np.concatenate((self.place[at].ravel(), place + which))
        order = np.lexsort((spot, found, ~score, owner))  # ~ reverses the order of integers
        owner = owner[order]
        kept = np.arange(len(owner)) - np.searchsorted(owner, np.arange(n))[owner] < k
        order = order[kept]
        self.score[at] = score[order].reshape(n, k)
        self.ids[at] = found[order].reshape(n, k)
        self.place[at] = spot[order].reshape(n, k)


@dataclass
class Block:
    """Anchors of one vector length: their numbers in the block, ids, labels and vectors."""

    number: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray

    def parts(self, size: int) -> Iterator[slice]:
        return (slice(i, min(i + size, len(self.ids))) for i in range(0, len(self.ids), size))


def _blocks(anchors: list[Row]) -> list[Block]:
    by_length: dict[int, list[int]] = {}
    for i, r in enumerate(anchors):
        by_length.setdefault(len(r["vector"]), []).append(i)
    return [
        Block(
            np.array(own), np.array([anchors[i]["vec_id"] for i in own]),
            np.array([anchors[i]["label"] for i in own]), _matrix([anchors[i]["vector"] for i in own]),
        )
        for own in by_length.values()
    ]


def _pieces(batches: Iterator[pd.DataFrame], size: int) -> Iterator[tuple[int, int, pd.DataFrame]]:
    """(bytes of a vector, rows seen before, rows), each piece of one vector length."""
    seen = 0
    for pdf in batches:
        for length, own in pdf.groupby(pdf["vector"].map(len), sort=False):
            for start in range(0, len(own), size):
                piece = own.iloc[start : start + size]
                yield int(length), seen, piece
                seen += len(piece)


def _emitted(number: np.ndarray, firsts: list[Firsts]) -> pd.DataFrame:
    """(anchor, score, vec_id) of all that is held; a row held for several windows once."""
    parts = [
        np.stack([np.repeat(number, f.k), f.place.ravel(), f.score.ravel(), f.ids.ravel()])
        for f in firsts
    ]
    rows = np.concatenate(parts, axis=1)
    rows = np.unique(rows[:, rows[2] != _NONE], axis=1)
    return pd.DataFrame({"anchor": rows[0], "score": rows[2], "vec_id": rows[3]})


def _positives(
    batches: Iterator[pd.DataFrame], blocks: list[Block], s: Mining
) -> Iterator[pd.DataFrame]:
    held = [Firsts(len(b.ids), s.positives) for b in blocks]
    for length, seen, piece in _pieces(batches, s.rows_at_once):
        ids, labels = piece["vec_id"].to_numpy(), piece["label"].to_numpy()
        for block, firsts in zip(blocks, held):
            if block.vectors.shape[1] * 8 != length:
                continue
            rows = _matrix(list(piece["vector"]))
            for at in block.parts(s.anchors_at_once):
                fits = block.labels[at, None] == labels
                fits &= block.ids[at, None] != ids
                scores = np.where(fits, products(block.vectors[at], rows), _NONE)
                firsts.offer(at, scores, ids, seen)
    for block, firsts in zip(blocks, held):
        yield _emitted(block.number, [firsts])


def _windows(block: Block, scores: dict[int, list[int]], s: Mining) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest negative score per anchor and positive; an empty window where none is."""
    low = np.full((len(block.ids), s.positives), _TOP)
    high = np.full((len(block.ids), s.positives), _NONE)
    for i, number in enumerate(block.number.tolist()):
        for j, score in enumerate(scores.get(number, ())):
            low[i, j] = -((-s.low * score) // 100)
            high[i, j] = s.high * score // 100
    return low, high


def _negatives(
    batches: Iterator[pd.DataFrame], blocks: list[Block], scores: dict[int, list[int]], s: Mining
) -> Iterator[pd.DataFrame]:
    windows = [_windows(b, scores, s) for b in blocks]
    held = [[Firsts(len(b.ids), s.negatives) for _ in range(s.positives)] for b in blocks]
    for length, seen, piece in _pieces(batches, s.rows_at_once):
        ids, labels = piece["vec_id"].to_numpy(), piece["label"].to_numpy()
        for block, (low, high), firsts in zip(blocks, windows, held):
            if block.vectors.shape[1] * 8 != length:
                continue
            rows = _matrix(list(piece["vector"]))
            for at in block.parts(s.anchors_at_once):
                other = block.labels[at, None] != labels
                other &= block.ids[at, None] != ids
                found = products(block.vectors[at], rows)
                for j, first in enumerate(firsts):
                    fits = other & (found >= low[at, j, None]) & (found <= high[at, j, None])
                    first.offer(at, np.where(fits, found, _NONE), ids, seen)
    for block, firsts in zip(blocks, held):
        yield _emitted(block.number, firsts)


# ---------------------------------------------------------------- secondary sort

_KEY = struct.Struct(">QQBQ")


def pack(anchor: int, score: int, kind: int, vec_id: int) -> bytes:
    """Bytes that sort by anchor, descending score, positives first, and id."""
    return _KEY.pack(anchor, _TOP - score, kind, vec_id + 2**63)


def unpack(key: bytes) -> tuple[int, int, int, int]:
    anchor, score, kind, vec_id = _KEY.unpack(key)
    return anchor, _TOP - score, kind, vec_id - 2**63


def mined(keys: Iterator[bytes], ids: np.ndarray, s: Mining) -> Iterator[tuple]:
    """Rows of the result from sorted keys; `ids` are the anchors' ids by number."""
    anchor, windows = None, []
    for number, score, kind, vec_id in map(unpack, keys):
        if number != anchor:
            anchor, windows = number, []
        if kind == _POSITIVE:
            windows.append([vec_id, score, 0])
            continue
        for window in windows:
            positive, top, given = window
            if given < s.negatives and s.low * top <= 100 * score <= s.high * top:
                window[2] += 1
                yield int(ids[number]), positive, given + 1, vec_id, top, score
        # Scores only fall from here on: windows that lie above or are full are done.
        windows = [w for w in windows if w[2] < s.negatives and s.low * w[1] <= 100 * score]


def secondary_sorted(pairs: DataFrame, ids: np.ndarray, s: Mining) -> DataFrame:
    """The result from pairs (anchor, score, kind, vec_id) of one block of anchors."""
    spark = pairs.sparkSession
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = pairs.rdd.map(lambda r: (pack(r["anchor"], r["score"], r["kind"], r["vec_id"]), None))
    ordered = keyed.repartitionAndSortWithinPartitions(
        count, lambda key: int.from_bytes(key[:8], "big") % count
    )
    rows = ordered.keys().mapPartitions(lambda keys: mined(keys, ids, s))
    return spark.createDataFrame(rows, RESULT, verifySchema=False)


# ---------------------------------------------------------------- the operator


def _anchor_blocks(anchors: DataFrame, s: Mining) -> Iterator[list[Row]]:
    """The anchors in lists of at most `block_bytes`, read one partition at a time."""
    block, size = [], 0
    for row in anchors.toLocalIterator():
        if block and size + len(row["vector"]) > s.block_bytes:
            yield block
            block, size = [], 0
        block.append(row)
        size += len(row["vector"])
    if block:
        yield block


def hard_negatives(
    rows: DataFrame, is_anchor: Column, s: Mining = Mining(), vec_id: str = "vec_id",
    vector: str = "embedding", label: str | Column = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""

    def quantize(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [quantized(v, s.scale) for v in pdf["vector"]]
            kept = np.array([v is not None for v in found], bool)
            yield pd.DataFrame(
                {c: pdf[c][kept] for c in ("vec_id", "label", "wanted")}
                | {"vector": [v.tobytes() for v in found if v is not None]}
            )

    vectors = stored(
        rows.select(
            F.col(vec_id).cast("long").alias("vec_id"),
            (F.col(label) if isinstance(label, str) else label).cast("long").alias("label"),
            F.coalesce(is_anchor, F.lit(False)).alias("wanted"), F.col(vector).alias("vector"),
        ).where("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
        .mapInPandas(quantize, "vec_id long, label long, wanted boolean, vector binary"),
        "vectors",
    )
    anchors = stored(vectors.where("wanted").drop("wanted").distinct(), "anchors")
    data, spark = vectors.drop("wanted"), rows.sparkSession
    pair, results = "anchor long, score long, vec_id long", []
    by_score = Window.partitionBy("anchor").orderBy(F.desc("score"), "vec_id")
    for block in _anchor_blocks(anchors, s):
        sides = spark.sparkContext.broadcast(_blocks(block))
        near = data.mapInPandas(lambda batches, b=sides: _positives(batches, b.value, s), pair)
        positives = stored(
            near.withColumn("place", F.row_number().over(by_score))
            .where(F.col("place") <= s.positives).drop("place"),
            "positives",
        )
        scores: dict[int, list[int]] = {}
        for r in positives.collect():  # a few rows per anchor of the block
            scores.setdefault(r["anchor"], []).append(r["score"])
        negatives = stored(
            data.mapInPandas(
                lambda batches, b=sides, w=scores: _negatives(batches, b.value, w, s), pair
            ),
            "negatives",
        )
        kinds = [
            frame.withColumn("kind", F.lit(kind))
            for frame, kind in ((positives, _POSITIVE), (negatives, _NEGATIVE))
        ]
        ids = np.array([r["vec_id"] for r in block])
        results.append(stored(secondary_sorted(kinds[0].union(kinds[1]), ids, s), "mined"))
        sides.unpersist()
    out = results[0] if results else spark.createDataFrame([], RESULT)
    for more in results[1:]:
        out = out.union(more)
    return out


def digest(rows: DataFrame) -> DataFrame:
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0, label=noisy)
