"""Boosted trees over a table of feature combinations, and their scores as SQL expressions.

The features are small integers, so the number of different combinations has a bound that the
number of rows does not move. Spark counts the combinations over all rows; the trees are grown
on these counts and come back as CASE expressions that Spark evaluates.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Split:
    """`left` holds for values up to `at`; both sides are a leaf value or another split."""

    feature: str
    at: int
    left: "Split | float"
    right: "Split | float"


@dataclass(frozen=True)
class Boosted:
    base: float
    trees: tuple[Split | float, ...]

    def score(self, row: dict[str, int]) -> float:
        """Log-odds of one combination."""
        total = self.base
        for node in self.trees:
            while isinstance(node, Split):
                node = node.left if row[node.feature] <= node.at else node.right
            total += node
        return total

    def score_column(self, feature: dict[str, Column]) -> Column:
        """The same sum as an expression, its terms in the same order."""

        def tree(node: Split | float) -> Column:
            if not isinstance(node, Split):
                return F.lit(float(node))
            return F.when(feature[node.feature] <= node.at, tree(node.left)).otherwise(
                tree(node.right)
            )

        total = F.lit(float(self.base))
        for node in self.trees:
            total = total + tree(node)
        return total


def fit(
    rows: list[dict[str, int]], features: tuple[str, ...], rounds: int = 12, depth: int = 2,
    rate: float = 0.5, ridge: float = 1.0,
) -> Boosted:
    """Trees for the log-loss from rows that carry the features, `positive` and `total`.

    Newton steps: a leaf is the sum of residuals over the sum of p(1-p) plus `ridge`. Ties
    between splits go to the earlier feature and the smaller value, so a refit agrees.
    """
    n, k = sum(r["total"] for r in rows), sum(r["positive"] for r in rows)
    base = math.log((k + 0.5) / (n - k + 0.5))
    score = [base] * len(rows)
    trees = []

    def grow(members: list[int], grad: list[float], hess: list[float], left: int) -> Split | float:
        g, h = sum(grad[i] for i in members), sum(hess[i] for i in members)
        best = (1e-6, None)
        for name in features if left else ():
            by_value: dict[int, list[float]] = defaultdict(lambda: [0.0, 0.0])
            for i in members:
                cell = by_value[rows[i][name]]
                cell[0] += grad[i]
                cell[1] += hess[i]
            gl = hl = 0.0
            for value in sorted(by_value)[:-1]:
                gl, hl = gl + by_value[value][0], hl + by_value[value][1]
                gain = (
                    gl * gl / (hl + ridge)
                    + (g - gl) ** 2 / (h - hl + ridge)
                    - g * g / (h + ridge)
                )
                if gain > best[0]:
                    best = (gain, (name, value))
        if best[1] is None:
            return rate * g / (h + ridge)
        name, value = best[1]
        return Split(
            name, value,
            grow([i for i in members if rows[i][name] <= value], grad, hess, left - 1),
            grow([i for i in members if rows[i][name] > value], grad, hess, left - 1),
        )

    for _ in range(rounds):
        p = [1 / (1 + math.exp(-s)) for s in score]
        grad = [r["positive"] - r["total"] * q for r, q in zip(rows, p)]
        hess = [r["total"] * q * (1 - q) for r, q in zip(rows, p)]
        tree = grow(list(range(len(rows))), grad, hess, depth)
        trees.append(tree)
        step = Boosted(0.0, (tree,))
        score = [s + step.score(r) for s, r in zip(score, rows)]
    return Boosted(base, tuple(trees))
