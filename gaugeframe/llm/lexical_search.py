"""Ranked lexical search over a length-stratified index.

A document's score for an item sums, over the item's terms, the term's weight times an impact
that depends on the term's frequency tf in the document and on the document's length only through
an integer normaliser m. Documents of equal m form a stratum; within it equal tf means equal impact.

1. Items come in batches of bounded size. One pass over the documents keeps, per document, its
   number of terms and how often it holds each asked term. N, L and the terms' document
   frequencies are counted over all documents, partly in the tasks.
2. Index: a stratum, cut into blocks of bounded size by a hash, is one row per block. Postings
   are ordered by term and by tf within the term; each tf's impact is computed once for all its postings.
3. A block's bound for an item takes each term's largest tf there. For every item the block of
   the highest bound is searched first, which gives the score its k-th document has at least.
4. All blocks are searched by the tasks that read them. Each item visits the blocks at hand from
   the highest bound down and stops where a bound is below its k-th score, be that from step 3
   or from the task's own visits. A task gives at most k documents per item; the best of all
   tasks are ranked. Nothing else is cut: a bound equal to the k-th score is still visited.

Blocks hold at most about `block_docs` documents and `block_postings` postings, so neither a
length that a third of all documents share nor very long documents make a task large.

Defined results: terms are maximal runs of ASCII letters, digits and characters beyond ASCII,
lower-cased in A-Z. Null has none. Every document row counts, rows that share an id included;
rows without id count in N, L and frequencies but are not listed. Items with neither terms nor
matches give no rows; identical item rows are answered once, an id with several texts for each.
Terms are told apart by 64-bit hashes. Ties go to the smaller id. Other columns play no part;
empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from gaugeframe.llm.common import stored
from gaugeframe.llm.terms import Known, terms_of

_U = np.uint64


@dataclass(frozen=True)
class Lexical:
    k: int = 50
    block_docs: int = 2048
    block_postings: int = 1 << 20
    batch_terms: int = 1 << 20  # (item, term) pairs in one broadcast
    buffer_postings: int = 1 << 22  # of the blocks that a task holds at a time


# ---------------------------------------------------------------- items


@dataclass
class Items:
    """A batch of items: the terms of item i are `at[first[i]:first[i + 1]]`, as places in
    `vocabulary`, with these weights."""

    ids: list[int | None]
    vocabulary: Known
    first: np.ndarray
    at: np.ndarray
    weights: np.ndarray

    def sums(self, of_term: np.ndarray) -> np.ndarray:
        """Per item, the sum over its terms. Every item has a term."""
        return np.add.reduceat(of_term[self.at], self.first[:-1])


def _item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item_id, hashes): the distinct terms of each distinct item that has some."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in terms_of(batch.column("text")):
                rows = len(t.first) - 1
                sets = [np.unique(t.hashes[t.first[i] : t.first[i + 1]]) for i in range(rows)]
                yield pa.record_batch(
                    [batch.column("item_id").slice(t.row, rows),
                     pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["item_id", "hashes"],
                )

    return (
        items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).cast("string").alias("text"))
        .mapInArrow(scan, "item_id long, hashes binary").where(F.length("hashes") > 0).distinct()
    )


def _batches(items: DataFrame, p: Lexical) -> Iterator[Items]:
    """All items, read one partition at a time, in batches of at most `batch_terms` terms."""

    def batch(rows: list[Row]) -> Items:
        sets = [np.frombuffer(r["hashes"], _U) for r in rows]
        known = Known(np.concatenate(sets))
        at = np.searchsorted(known.hashes, np.concatenate(sets))
        first = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
        return Items([r["item_id"] for r in rows], known, first, at, np.zeros(len(at), np.int64))

    held, size = [], 0
    for row in items.toLocalIterator():
        n = len(row["hashes"]) // 8
        if held and size + n > p.batch_terms:
            yield batch(held)
            held, size = [], 0
        held.append(row)
        size += n
    if held:
        yield batch(held)


# ---------------------------------------------------------------- documents


def _occurrences(docs: DataFrame, known, doc_id: str, text: str) -> DataFrame:
    """Per document row: id, number of terms `n`, the asked terms `at` and their `tf`. `salt` is
    a number that spreads even identical rows."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = 0
        for batch in batches:
            for t in terms_of(batch.column("text")):
                rows = len(t.first) - 1
                where, term = known.value.find(t.hashes)
                row = np.searchsorted(t.first, where, side="right") - 1
                width = len(known.value.hashes)
                pairs, tf = np.unique(row * width + term, return_counts=True)
                term, tf = (pairs % max(width, 1)).astype(np.int32), tf.astype(np.int32)
                cut = np.searchsorted(pairs, np.arange(rows + 1) * width).tolist()
                ends = list(zip(cut, cut[1:]))
                yield pa.record_batch(
                    [
                        batch.column("doc_id").slice(t.row, rows),
                        pa.array(np.diff(t.first).astype(np.int64)),
                        pa.array([term[a:b].tobytes() for a, b in ends], pa.binary()),
                        pa.array([tf[a:b].tobytes() for a, b in ends], pa.binary()),
                        pa.array(np.arange(salt, salt + rows, dtype=np.int64)),
                    ],
                    names=["doc_id", "n", "at", "tf", "salt"],
                )
                salt += rows

    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    ).mapInArrow(scan, "doc_id long, n long, at binary, tf binary, salt long")


def _frequencies(occurrences: DataFrame, terms: int) -> np.ndarray:
    """Documents per asked term; each task adds up its own first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms, np.int64)
        for batch in batches:
            at = np.frombuffer(b"".join(batch.column("at").to_pylist()), np.int32)
            total += np.bincount(at, minlength=terms)
        held = np.flatnonzero(total)
        yield pa.record_batch([pa.array(held), pa.array(total[held])], names=["at", "df"])

    rows = (
        occurrences.select("at").where(F.length("at") > 0).mapInArrow(count, "at long, df long")
        .groupBy("at").agg(F.sum("df").alias("df")).toPandas()
    )
    out = np.zeros(terms, np.int64)
    out[rows["at"].to_numpy(np.int64)] = rows["df"].to_numpy(np.int64)
    return out


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impact(tf: np.ndarray, m: int) -> np.ndarray:
    tf = tf.astype(np.int64)
    return (1000000000 * tf) // (1000 * tf + 20 * m)


# ---------------------------------------------------------------- the index

_INDEX = (
    "m long, block long, docs binary, terms binary, top_tf binary, term_start binary, "
    "tf binary, tf_start binary, places binary"
)


def _block_row(key: tuple, rows: pa.Table) -> pa.Table:
    """One block. Term i has the tf groups from `term_start[i]` on, tf group j the postings
    (places in `docs`) from `tf_start[j]` on; both have one entry more, the end."""
    docs = rows.column("doc_id").to_numpy()
    at = [np.frombuffer(x, np.int32) for x in rows.column("at").to_pylist()]
    tf = np.frombuffer(b"".join(rows.column("tf").to_pylist()), np.int32)
    place = np.repeat(np.arange(len(at), dtype=np.int32), [len(x) for x in at])
    term = np.concatenate(at)
    order = np.lexsort((place, -tf, term))
    term, tf, place = term[order], tf[order], place[order]
    new_term = np.diff(term, prepend=-1) != 0
    groups = np.flatnonzero(new_term | (np.diff(tf, prepend=-1) != 0))
    term_start = np.append(np.flatnonzero(new_term[groups]), len(groups)).astype(np.int32)
    parts = [
        docs.astype(np.int64), term[groups[term_start[:-1]]], tf[groups[term_start[:-1]]], term_start,
        tf[groups], np.append(groups, len(term)).astype(np.int32), place,
    ]
    names = [c.split()[0] for c in _INDEX.split(", ")]
    return pa.table(
        dict(zip(names, [pa.array([k.as_py()], pa.int64()) for k in key]
                 + [pa.array([x.tobytes()], pa.binary()) for x in parts]))
    )


def build_index(occurrences: DataFrame, n_docs: int, length: int, p: Lexical) -> DataFrame:
    """A row per block of documents of equal normaliser."""
    # 50 * n * N may exceed 64 bits on the way.
    m = F.expr(f"50L + (CAST(n AS DECIMAL(20, 0)) * CAST('{50 * n_docs}' AS DECIMAL(38, 0))) div {length}L")
    rows = occurrences.where("doc_id IS NOT NULL AND length(at) > 0").withColumn("m", m)
    cuts = stored(
        rows.groupBy("m").agg(
            F.greatest(
                F.ceil(F.count("*") / p.block_docs), F.ceil(F.sum(F.length("at") / 4) / p.block_postings)
            ).alias("cuts")
        ),
        "strata",
    )
    spread = F.pmod(F.xxhash64("doc_id", "at", "tf", "salt"), F.col("cuts"))
    return (
        rows.join(cuts, "m").withColumn("block", spread)
        .select("m", "block", "doc_id", "at", "tf")
        .groupBy("m", "block").applyInArrow(_block_row, _INDEX)
    )


class Block:
    """A row of the index, ready for searching."""

    def __init__(self, row: dict, items: Items):
        def ints(name: str, kind=np.int32) -> np.ndarray:
            return np.frombuffer(row[name], kind)

        self.m, self.docs = row["m"], ints("docs", np.int64)
        self.terms, self.places = ints("terms"), ints("places")
        tf_start = ints("tf_start")
        self.start = tf_start[ints("term_start")].astype(np.int64)
        # Once per tf, then shared by its postings.
        self.impacts = np.repeat(impact(ints("tf"), self.m), np.diff(tf_start))
        self.bounds = bounds(row, items)

    def scores(self, items: Items, i: int) -> np.ndarray:
        """The item's score of every document of the block."""
        own = slice(items.first[i], items.first[i + 1])
        terms, weights = items.at[own], items.weights[own]
        spot = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        here = self.terms[spot] == terms
        begin, size = self.start[spot[here]], np.diff(self.start)[spot[here]]
        ends = np.cumsum(size)
        postings = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - ends + size, size)
        out = np.zeros(len(self.docs), np.int64)
        np.add.at(out, self.places[postings], self.impacts[postings] * np.repeat(weights[here], size))
        return out


def bounds(row: dict, items: Items) -> np.ndarray:
    """Per item, a score that no document of the block exceeds."""
    top = np.zeros(len(items.vocabulary.hashes), np.int64)
    top[np.frombuffer(row["terms"], np.int32)] = impact(np.frombuffer(row["top_tf"], np.int32), row["m"])
    return np.add.reduceat(top[items.at] * items.weights, items.first[:-1])


class Ranking:
    """The k best documents found so far for each item."""

    def __init__(self, floors: np.ndarray, k: int):
        self.k, self.floors = k, np.maximum(floors, 1)
        self.held = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in floors]

    def visit(self, block: Block, items: Items, i: int) -> None:
        scores = block.scores(items, i)
        good = np.flatnonzero(scores >= self.floors[i])
        if not len(good):
            return
        score = np.concatenate((self.held[i][0], scores[good]))
        docs = np.concatenate((self.held[i][1], block.docs[good]))
        order = np.lexsort((docs, -score))[: self.k]
        self.held[i] = score[order], docs[order]
        if len(order) == self.k:
            self.floors[i] = max(self.floors[i], score[order[-1]])

    def rows(self, items: Items) -> pa.RecordBatch:
        n = [len(s) for s, _ in self.held]
        number = np.repeat(np.arange(len(n)), n)
        return pa.record_batch(
            [
                pa.array(number), pa.array([items.ids[i] for i in number], pa.int64()),
                *[pa.array(np.concatenate([np.empty(0, np.int64), *[h[j] for h in self.held]])) for j in (1, 0)],
            ],
            names=["item", "item_id", "doc_id", "score"],
        )


_FOUND = "item long, item_id long, doc_id long, score long"


def _search(
    batches: Iterator[pa.RecordBatch], items: Items, floors: np.ndarray, p: Lexical
) -> Iterator[pa.RecordBatch]:
    """The task's k best documents of every item."""
    ranking, held, size = Ranking(floors, p.k), [], 0

    def visit_held() -> None:
        table = np.stack([b.bounds for b in held])
        for i in np.flatnonzero(table.max(axis=0) >= ranking.floors):
            for j in np.argsort(-table[:, i], kind="stable"):
                if table[j, i] < ranking.floors[i]:
                    break
                ranking.visit(held[j], items, i)

    for batch in batches:
        for row in batch.to_pylist():
            held.append(Block(row, items))
            size += len(held[-1].places)
            if size >= p.buffer_postings:
                visit_held()
                held, size = [], 0
    if held:
        visit_held()
    yield ranking.rows(items)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _floors(index: DataFrame, items, p: Lexical) -> np.ndarray:
    """Per item, the k-th score in its block of the highest bound, or 0."""

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(items.value.ids)
        best, at = np.zeros(n, np.int64), np.zeros((n, 2), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                if row["docs"] >= p.k:
                    own = bounds(row, items.value)
                    better = own > best
                    best[better], at[better] = own[better], (row["m"], row["block"])
        found = np.flatnonzero(best)
        yield pa.record_batch(
            [pa.array(found), pa.array(best[found]), pa.array(at[found, 0]), pa.array(at[found, 1])],
            names=["item", "bound", "m", "block"],
        )

    chosen = (
        index.select("m", "block", (F.length("docs") / 8).cast("long").alias("docs"), "terms", "top_tf")
        .mapInArrow(tops, "item long, bound long, m long, block long")
        .groupBy("item").agg(F.max(F.struct("bound", "m", "block")).alias("best"))
        .groupBy("best.m", "best.block").agg(F.collect_list("item").alias("asked"))
    )

    def seed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranking = Ranking(np.zeros(len(items.value.ids)), p.k)
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row, items.value)
                for i in row["asked"]:
                    ranking.visit(block, items.value, i)
        yield ranking.rows(items.value)

    kth = _best(
        index.join(stored(chosen, "chosen"), ["m", "block"]).mapInArrow(seed, _FOUND), p.k
    ).where(F.col("rank") == p.k)
    out = np.zeros(len(items.value.ids), np.int64)
    for r in kth.select("item", "score").collect():  # a row per item of the batch
        out[r["item"]] = r["score"]
    return out


# ---------------------------------------------------------------- the operator


def _ranked(spark: SparkSession, docs: DataFrame, items: Items, p: Lexical, doc_id: str, text: str) -> DataFrame:
    vocabulary = spark.sparkContext.broadcast(items.vocabulary)
    occurrences = stored(_occurrences(docs, vocabulary, doc_id, text), "occurrences")
    total = occurrences.where("n > 0").agg(F.count("*").alias("n"), F.sum("n").alias("length")).first()
    df = _frequencies(occurrences, len(items.vocabulary.hashes))
    weights = np.array([weight(total["n"], int(d)) for d in df], np.int64)
    items.weights = weights[items.at]
    index = stored(build_index(occurrences, total["n"], total["length"] or 1, p), "index")
    asked = spark.sparkContext.broadcast(items)
    floors = _floors(index, asked, p)
    found = index.mapInArrow(lambda batches: _search(batches, asked.value, floors, p), _FOUND)
    return stored(
        _best(found, p.k).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"), "ranked"
    )


def ranked(
    docs: DataFrame, items: DataFrame, p: Lexical = Lexical(),
    doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents for every item."""
    spark = docs.sparkSession
    asked = stored(_item_terms(items, item_id, text), "items")
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for batch in _batches(asked, p):
        out = out.union(_ranked(spark, docs, batch, p, doc_id, text))
    return out
