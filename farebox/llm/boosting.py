"""Gradient-boosted trees for a yes or no, over binned columns."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

BINS = 32


@dataclass
class Tree:
    column: np.ndarray  # by node of a complete binary tree
    limit: np.ndarray  # rows with a value up to it go left
    value: np.ndarray  # of the leaves


@dataclass
class BoostedTrees:
    base: float
    trees: list[Tree] = field(default_factory=list)

    def logits(self, data: np.ndarray) -> np.ndarray:
        total = np.full(len(data), self.base)
        rows = np.arange(len(data))
        for tree in self.trees:
            node = np.zeros(len(data), dtype=np.int64)
            while_inner = int(np.log2(len(tree.value)))
            for _ in range(while_inner):
                node = 2 * node + 1 + (data[rows, tree.column[node]] > tree.limit[node])
            total += tree.value[node - len(tree.column)]
        return total


def _limits(column: np.ndarray) -> np.ndarray:
    cuts = np.unique(np.quantile(column, np.linspace(0, 1, BINS)[1:-1], method="lower"))
    return cuts[cuts < column.max(initial=0)] if len(column) else cuts


def fit(
    data: np.ndarray, labels: np.ndarray, rounds: int = 40, depth: int = 4, rate: float = 0.3, shrink: float = 1.0
) -> BoostedTrees:
    """Second-order boosting of the logistic loss; every split is the best over all bins."""
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    model = BoostedTrees(float(np.log(share / (1 - share))))
    limits = [_limits(data[:, c]) for c in range(data.shape[1])]
    # Columns of two values are summed all at once, by the few rows that have the higher one.
    two_valued = [c for c, cuts in enumerate(limits) if len(cuts) == 1]
    cuts_of_two = np.array([limits[c][0] for c in two_valued], dtype=data.dtype)
    high_rows, high_columns = np.nonzero(data[:, two_valued] > cuts_of_two)
    many = [c for c, cuts in enumerate(limits) if len(cuts) > 1]
    binned = {c: np.searchsorted(limits[c], data[:, c], side="left") for c in many}
    logits = np.full(len(labels), model.base)
    rows = np.arange(len(labels))

    def gains(left: list[np.ndarray], totals: list[np.ndarray]) -> np.ndarray:
        right = [t[:, None] - x for t, x in zip(totals, left, strict=True)]
        parents = totals[0] ** 2 / (totals[1] + shrink)
        gain = left[0] ** 2 / (left[1] + shrink) + right[0] ** 2 / (right[1] + shrink) - parents[:, None]
        gain[(left[1] < 1e-3) | (right[1] < 1e-3)] = 0
        return gain

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-logits))
        slope, curve = labels - p, p * (1 - p)
        inner = (1 << depth) - 1
        tree = Tree(np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(inner + 1))
        node = np.zeros(len(labels), dtype=np.int64)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            local = node - first
            best = np.zeros(width)
            totals = [np.bincount(local, w, minlength=width) for w in (slope, curve)]

            def offered(gain: np.ndarray, columns: list[int], cuts: list[float], best=best, tree=tree, first=first) -> None:
                at = gain.argmax(axis=1)
                found = gain[np.arange(len(best)), at]
                for i in np.flatnonzero(found > best + 1e-9):
                    best[i] = found[i]
                    tree.column[first + i], tree.limit[first + i] = columns[at[i]], cuts[at[i]]

            if two_valued:
                cell = high_columns * width + local[high_rows]
                high = [
                    np.bincount(cell, w[high_rows], minlength=len(two_valued) * width).reshape(-1, width).T
                    for w in (slope, curve)
                ]
                left = [t[:, None] - x for t, x in zip(totals, high, strict=True)]
                offered(gains(left, totals), two_valued, cuts_of_two)
            for c in many:
                size = len(limits[c]) + 1
                cell = local * size + binned[c]
                left = [
                    np.bincount(cell, w, minlength=width * size).reshape(width, size).cumsum(axis=1)[:, :-1]
                    for w in (slope, curve)
                ]
                offered(gains(left, totals), [c] * len(limits[c]), limits[c])
            node = 2 * node + 1 + (data[rows, tree.column[node]] > tree.limit[node])
        leaf = node - inner
        sums = [np.bincount(leaf, w, minlength=inner + 1) for w in (slope, curve)]
        tree.value = rate * sums[0] / (sums[1] + shrink)
        logits += tree.value[leaf]
        model.trees.append(tree)
    return model
