"""Gradient-boosted trees for two classes, small enough to be compiled into expressions.

Fitting works on a bounded table of examples on the driver; a model scores matrices, or
becomes an SQL expression over feature columns that runs inside a Spark projection.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32


@dataclass(frozen=True)
class Node:
    """``feature <= at`` goes to ``low``; a leaf has no feature and adds ``value``."""

    value: float = 0.0
    feature: int = -1
    at: float = 0.0
    low: Node | None = None
    high: Node | None = None


@dataclass(frozen=True)
class Boosted:
    start: float
    trees: tuple[Node, ...]

    def margin(self, rows: np.ndarray) -> np.ndarray:
        out = np.full(len(rows), self.start)
        for tree in self.trees:
            todo = [(tree, np.arange(len(rows)))]
            while todo:
                node, at = todo.pop()
                if node.feature < 0:
                    out[at] += node.value
                elif len(at):
                    low = rows[at, node.feature] <= node.at
                    todo += [(node.low, at[low]), (node.high, at[~low])]
        return out

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(rows)))

    def sql(self, features: list[str]) -> str:
        """The margin as an SQL expression of the given feature expressions."""

        def text(node: Node) -> str:
            if node.feature < 0:
                return f"{node.value:.6f}D"
            test = f"{features[node.feature]} <= {node.at:.6f}D"
            return f"if({test}, {text(node.low)}, {text(node.high)})"

        return " + ".join([f"{self.start:.6f}D", *[text(t) for t in self.trees]])


def fit(
    rows: np.ndarray,
    labels: np.ndarray,
    weights: np.ndarray | None = None,
    trees: int = 30,
    depth: int = 3,
    rate: float = 0.3,
    ridge: float = 1.0,
    least: float = 4.0,
) -> Boosted:
    """Logistic loss, second-order steps, splits at quantile cuts."""
    rows = np.asarray(rows, dtype=np.float64)
    weights = np.ones(len(rows)) if weights is None else np.asarray(weights, dtype=np.float64)
    # rounded to the places that the compiled expression shows
    cuts = [
        np.unique(np.round(np.quantile(column, np.linspace(0, 1, BINS + 1)[:-1]), 6))
        for column in rows.T
    ]
    bins = np.stack(
        [np.searchsorted(c, column, side="left") for c, column in zip(cuts, rows.T, strict=True)],
        axis=1,
    )
    share = np.clip(np.average(labels, weights=weights), 1e-4, 1 - 1e-4)
    start = float(np.round(np.log(share / (1 - share)), 6))
    margin = np.full(len(rows), start)
    grown = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grower = _Grower(
            bins, cuts, weights * (labels - p), weights * p * (1 - p), rate, ridge, least
        )
        grown.append(grower.grow(np.arange(len(rows)), depth))
        margin += grower.step
    return Boosted(start, tuple(grown))


class _Grower:
    def __init__(self, bins, cuts, gradient, curvature, rate, ridge, least):
        self.bins, self.cuts = bins, cuts
        self.gradient, self.curvature = gradient, curvature
        self.rate, self.ridge, self.least = rate, ridge, least
        self.step = np.zeros(len(bins))

    def grow(self, at: np.ndarray, depth: int) -> Node:
        g, h = self.gradient[at], self.curvature[at]
        split = self._split(at, g, h) if depth else None
        if split is None:
            value = float(np.round(self.rate * g.sum() / (h.sum() + self.ridge), 6))
            self.step[at] = value
            return Node(value)
        feature, place = split
        low = self.bins[at, feature] <= place
        return Node(
            0.0,
            feature,
            float(self.cuts[feature][place]),
            self.grow(at[low], depth - 1),
            self.grow(at[~low], depth - 1),
        )

    def _split(self, at, g, h):
        """Feature and cut with the largest gain, if any gains."""
        best, found = 1e-6, None
        whole = g.sum() ** 2 / (h.sum() + self.ridge)
        for feature, cuts in enumerate(self.cuts):
            own = self.bins[at, feature]
            left_g = np.bincount(own, weights=g, minlength=len(cuts) + 1)[: len(cuts)].cumsum()
            left_h = np.bincount(own, weights=h, minlength=len(cuts) + 1)[: len(cuts)].cumsum()
            left_n = np.bincount(own, minlength=len(cuts) + 1)[: len(cuts)].cumsum()
            right_g, right_h = g.sum() - left_g, h.sum() - left_h
            gain = (
                left_g**2 / (left_h + self.ridge) + right_g**2 / (right_h + self.ridge) - whole
            )
            gain[(left_n < self.least) | (len(at) - left_n < self.least)] = 0.0
            place = int(gain.argmax()) if len(gain) else 0
            if len(gain) and gain[place] > best:
                best, found = gain[place], (feature, place)
        return found
