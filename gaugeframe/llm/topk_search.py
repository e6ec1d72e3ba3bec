"""Exact top-k search by inner product with two cover trees.

Vectors are dealt to pivot groups; pivots are a farthest-first choice from a bounded sample,
and every row's distance to its pivot counts towards the group's covering radius. Queries go to
groups by the same pivots. First each query meets its own group, which gives it a k-th score.
A pair of groups is left out if no inner product between two balls of their radii can reach the
worst k-th score of the query group. What remains is searched in blocks of bounded size.

Within a block both sides become cover trees: each node's children are a farthest-first net of
its points, so they cover it within a smaller radius and lie at least that radius apart. Node
pairs are visited best bound first and pruned by the same test, against the worst k-th score of
the query node. Leaves are compared by a matrix product.

Pruning only leaves out what cannot enter a result: bounds are widened for rounding, and a bound
that equals the k-th score is searched, as a smaller id could win. The work of an exact search
grows with queries times rows where vectors have no structure; a block's memory does not.

Defined results: a vector that is null, empty or holds null or non-finite components takes no
part, nor does a row without id. Only vectors of equal length are compared. Rows that share an
id are never candidates for each other; if a query's id has different vectors, each is answered.
Identical query rows are answered once. Scores equal, the smaller id comes first. Scores beyond
64 bits are clamped. Other columns play no part; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeframe.llm.common import stored

_LIMIT = 2**62


@dataclass(frozen=True)
class Search:
    k: int = 5
    scale: int = 256
    rows_per_pivot: int = 8192
    max_pivots: int = 256
    pivot_sample: int = 4096
    data_block: int = 4096
    query_block: int = 1024
    fan: int = 16
    leaf: int = 64


# ---------------------------------------------------------------- trees


@dataclass
class Node:
    center: np.ndarray
    norm: float
    radius: float
    members: np.ndarray
    children: list["Node"] = field(default_factory=list)


def farthest_first(points: np.ndarray, most: int) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Indices of a net that begins with point 0, each point's centre, and its distance to it."""
    chosen, owner = [0], np.zeros(len(points), int)
    gap = np.linalg.norm(points - points[0], axis=1)
    while len(chosen) < most and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        away = np.linalg.norm(points - points[chosen[-1]], axis=1)
        closer = away < gap
        owner[closer], gap[closer] = len(chosen) - 1, away[closer]
    return chosen, owner, gap


def cover_tree(points: np.ndarray, members: np.ndarray, s: Search) -> Node:
    """A tree over `points[members]`, whose first member is the root's centre."""
    own = points[members]
    center = own[0]
    node = Node(
        center, float(np.linalg.norm(center)),
        float(np.linalg.norm(own - center, axis=1).max()), members,
    )
    if len(members) > s.leaf and node.radius > 0:
        chosen, owner, _ = farthest_first(own, s.fan)
        for i, at in enumerate(chosen):
            inside = np.flatnonzero(owner == i)
            inside = np.concatenate(([at], inside[inside != at]))
            node.children.append(cover_tree(points, members[inside], s))
    return node


def ball_bound(dot: float, q_norm: float, q_radius: float, d_norm: float, d_radius: float) -> float:
    """No inner product between the two balls is larger, rounding included."""
    top = dot + q_norm * d_radius + d_norm * q_radius + q_radius * d_radius
    return top + 1e-9 * (abs(dot) + q_norm * d_norm + abs(top)) + 1e-3


class Best:
    """The k best (score, id) of each query of a block."""

    def __init__(self, ids: np.ndarray, k: int):
        self.ids, self.k = ids, k
        self.score = np.full((len(ids), k), -np.inf)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.known = np.full(len(ids), -np.inf)  # what earlier searches guarantee

    def worst(self, members: np.ndarray) -> float:
        return float(np.maximum(self.score[members, -1], self.known[members]).min())

    def offer(self, members: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        scores = np.where(ids[None, :] == self.ids[members][:, None], -np.inf, scores)
        floor = np.maximum(self.score[members, -1], self.known[members])
        for row in np.flatnonzero((scores >= floor[:, None]).any(axis=1)):
            q = members[row]
            s = np.concatenate((self.score[q], scores[row]))
            i = np.concatenate((self.found[q], ids))
            order = np.lexsort((i, -s))[: self.k]
            self.score[q], self.found[q] = s[order], i[order]


def dual_tree(
    q: np.ndarray, best: Best, d: np.ndarray, d_ids: np.ndarray, s: Search
) -> None:
    """Fills `best` with the results of all queries over the data points."""
    q_root = cover_tree(q, np.arange(len(q)), s)
    d_root = cover_tree(d, np.arange(len(d)), s)
    tick = 0

    def entry(a: Node, b: Node):
        nonlocal tick
        tick += 1
        bound = ball_bound(float(a.center @ b.center), a.norm, a.radius, b.norm, b.radius)
        return -bound, tick, a, b

    heap = [entry(q_root, d_root)]
    while heap:
        bound, _, a, b = heapq.heappop(heap)
        if -bound < best.worst(a.members):
            continue
        if not a.children and not b.children:
            best.offer(a.members, q[a.members] @ d[b.members].T, d_ids[b.members])
            continue
        for x in a.children or (a,):
            for y in b.children or (b,):
                heapq.heappush(heap, entry(x, y))


# ---------------------------------------------------------------- vectors


def quantized(vector: object, scale: int) -> np.ndarray | None:
    """floor(scale * x) per component, or None if the vector takes no part."""
    if vector is None or len(vector) == 0:
        return None
    x = np.asarray(vector, np.float64)
    if not np.isfinite(x).all():
        return None
    return np.clip(np.floor(x * scale), -_LIMIT, _LIMIT).astype(np.int64)


def _matrix(rows: pd.Series) -> np.ndarray:
    """Vectors as float64 where that is exact for any inner product, else as Python integers."""
    ints = np.frombuffer(b"".join(rows), np.int64).reshape(len(rows), -1)
    largest = max(abs(int(ints.max())), abs(int(ints.min())))
    return ints.astype(np.float64) if largest**2 * ints.shape[1] < 2**53 else ints.astype(object)


def _search_block(
    queries: pd.DataFrame, data: pd.DataFrame, s: Search
) -> pd.DataFrame:
    columns = ["query_id", "query_key", "vec_id", "score"]
    if not len(queries) or not len(data):
        return pd.DataFrame(columns=columns)
    queries = queries.sort_values(["vec_id", "key"])
    data = data.sort_values("vec_id")
    q, d, ids = _matrix(queries["vector"]), _matrix(data["vector"]), data["vec_id"].to_numpy()
    best = Best(queries["vec_id"].to_numpy(), s.k)
    if q.dtype == object or d.dtype == object:  # too large for exact products of floats
        exact = q.astype(object) @ d.astype(object).T
        rows = []
        for i, own in enumerate(best.ids):
            order = sorted((-v, x) for v, x in zip(exact[i], ids) if x != own)[: s.k]
            rows += [(own, queries["key"].iat[i], x, max(-(2**63), min(2**63 - 1, -v))) for v, x in order]
        return pd.DataFrame(rows, columns=columns)
    best.known = queries["kth"].fillna(-np.inf).to_numpy(float)
    dual_tree(q, best, d, ids, s)
    at = np.nonzero(np.isfinite(best.score))
    return pd.DataFrame(
        {"query_id": best.ids[at[0]], "query_key": queries["key"].to_numpy()[at[0]],
         "vec_id": best.found[at], "score": best.score[at].astype(np.int64)}
    )


def _pivots(vectors: DataFrame, count: int, s: Search) -> dict[int, np.ndarray]:
    """Pivots per vector length, from the rows of the smallest id hashes."""
    sample = (
        vectors.orderBy(F.xxhash64("vec_id"), "vec_id", "vector").limit(s.pivot_sample)
        .select("vector").collect()
    )
    by_length: dict[int, list[np.ndarray]] = {}
    for r in sample:
        v = np.frombuffer(r["vector"], np.int64).astype(np.float64)
        by_length.setdefault(len(v), []).append(v)
    wanted = min(s.max_pivots, max(1, -(-count // s.rows_per_pivot)))
    return {
        n: np.stack(rows)[farthest_first(np.stack(rows), wanted)[0]] for n, rows in by_length.items()
    }


def top_k(
    rows: DataFrame, is_query, s: Search = Search(), vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for every row where `is_query` holds."""

    def quantize(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [quantized(v, s.scale) for v in pdf["vector"]]
            kept = np.array([v is not None for v in found], bool)
            yield pd.DataFrame(
                {"vec_id": pdf["vec_id"][kept], "wanted": pdf["wanted"][kept],
                 "vector": [v.tobytes() for v in found if v is not None]}
            )

    vectors = stored(
        rows.select(
            F.col(vec_id).cast("long").alias("vec_id"),
            F.coalesce(is_query, F.lit(False)).alias("wanted"), F.col(vector).alias("vector"),
        ).where("vec_id IS NOT NULL")
        .mapInPandas(quantize, "vec_id long, wanted boolean, vector binary"),
        "vectors",
    )
    pivots = _pivots(vectors, vectors.count(), s)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            groups, gaps = [], []
            for v in pdf["vector"]:
                x = np.frombuffer(v, np.int64).astype(np.float64)
                # A length the sample missed has the origin for its only pivot.
                own = pivots.get(len(x), np.zeros((1, len(x))))
                gap = np.linalg.norm(own - x, axis=1)
                at = int(gap.argmin())
                groups.append(f"{len(x)}.{at}")
                gaps.append(float(gap[at]))
            yield pdf.assign(group=groups, gap=gaps)

    placed = stored(
        vectors.mapInPandas(
            assign, "vec_id long, wanted boolean, vector binary, group string, gap double"
        ).withColumn("key", F.xxhash64("vector")),
        "placed",
    )
    # At most a row per pivot and side.
    groups = {
        (r["group"], r["wanted"]): r
        for r in placed.groupBy("group", "wanted").agg(F.count("*").alias("n"), F.max("gap").alias("radius")).collect()
    }
    names = sorted({g for g, _ in groups})

    def ball(name: str, wanted_only: bool) -> tuple[np.ndarray, float, int]:
        length, at = map(int, name.split("."))
        parts = [groups[k] for k in ((name, True), (name, False)) if k in groups and (k[1] or not wanted_only)]
        center = pivots[length][at] if length in pivots else np.zeros(length)
        return center, max((p["radius"] for p in parts), default=0.0), sum(p["n"] for p in parts)

    data = placed.select("vec_id", "vector", "key", "group")
    asked = placed.where("wanted").select("vec_id", "vector", "key", "group").distinct()
    spark = rows.sparkSession

    def searched(pairs: list[tuple[str, str]], queries: DataFrame) -> DataFrame:
        """All queries of the first groups against all rows of the second."""
        schema = "q_group string, d_group string, q_blocks int, d_blocks int"
        keys = ("q_group", "d_group", "q_block", "d_block")
        plan = spark.createDataFrame(
            [(a, b, -(-ball(a, True)[2] // s.query_block), -(-ball(b, False)[2] // s.data_block)) for a, b in pairs],
            schema,
        )
        spread = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("blocks")).cast("int")

        def side(frame: DataFrame, own: str, other: str, *more: str) -> DataFrame:
            return (
                frame.join(plan, frame["group"] == plan[f"{own}_group"])
                .withColumn("blocks", F.col(f"{own}_blocks")).withColumn(f"{own}_block", spread)
                .withColumn(f"{other}_block", F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)))
                # New names keep apart the two sides, which come from the same tables.
                .select(*[F.col(c).alias(f"{c}_{own}") for c in (*keys, "vec_id", "vector", "key", *more)])
            )

        def search(queries: pd.DataFrame, data: pd.DataFrame) -> pd.DataFrame:
            bare = [x.rename(columns=lambda c: c[:-2]) for x in (queries, data)]
            return _search_block(*bare, s)

        return (
            side(queries, "q", "d", "kth").groupBy(*[f"{c}_q" for c in keys])
            .cogroup(side(data, "d", "q").groupBy(*[f"{c}_d" for c in keys]))
            .applyInPandas(
                search,
                "query_id long, query_key long, vec_id long, score long",
            )
        )

    def best_of(found: DataFrame) -> DataFrame:
        by_score = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= s.k)

    q_names = [g for g in names if (g, True) in groups]
    first = stored(
        best_of(searched([(g, g) for g in q_names], asked.withColumn("kth", F.lit(None).cast("double")))),
        "own-groups",
    )
    reached = first.where(F.col("rank") == s.k).select(
        F.col("query_id").alias("vec_id"), F.col("query_key").alias("key"),
        F.col("score").cast("double").alias("kth"),
    )
    known = stored(asked.join(reached, ["vec_id", "key"], "left"), "asked")
    worst = {
        r["group"]: r["kth"]
        for r in known.groupBy("group").agg(F.min(F.coalesce("kth", F.lit(float("-inf")))).alias("kth")).collect()
    }

    def reaches(a: str, b: str) -> bool:
        (qc, qr, _), (dc, dr, _) = ball(a, True), ball(b, False)
        bound = ball_bound(float(qc @ dc), float(np.linalg.norm(qc)), qr, float(np.linalg.norm(dc)), dr)
        return bound >= worst[a]

    pairs = [
        (a, b) for a in q_names for b in names
        if a != b and a.split(".")[0] == b.split(".")[0] and reaches(a, b)
    ]
    found = first.drop("rank")
    if pairs:
        found = found.union(searched(pairs, known))
    return best_of(found).select("query_id", "rank", "vec_id", "score")


def digest(rows: DataFrame) -> DataFrame:
    return top_k(rows, F.col("vec_id") % 50 == 0)
