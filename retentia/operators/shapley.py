"""Shapley values of tree ensembles (path-dependent, with node covers).

The value of a set S of known features at a row is the tree's expectation
where splits on features outside S are followed by both branches, weighed by
the rows that trained them (the cover).  For one leaf this is

    value * product of o_j over j in S * product of z_j over j not in S,

with one factor for each feature on the leaf's path: z_j, the share of the
cover that takes the path at j's splits, and o_j, 1 if the row itself takes
it at all of them, else 0.  A feature's Shapley value at a leaf is then

    value * (o_i - z_i) * sum over k of k! (d - 1 - k)! / d! * c_k,

where c_k is the coefficient of t**k in the product of (z_j + o_j t) over the
other features: polynomial in the path's length d, with no sum over subsets.
Rows are handled a batch at a time; rows that take a leaf's splits in the same
way share one computation, made once for all batches.

The values of a row add up to its margin less ``base_value``.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import factorial

import numpy as np


@dataclass(frozen=True)
class Tree:
    """Flat arrays by node: children (-1 at leaves), split feature, threshold (numeric: left if <=) or codes that go left, leaf values, covers."""

    weight: float
    value: np.ndarray
    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    is_category: np.ndarray
    cover: np.ndarray
    category_left: np.ndarray


@dataclass(frozen=True)
class Leaf:
    """value: the leaf's, with its tree's weight; features: those on its path; shares: their z; steps: for each the (node, goes left) on the path."""

    value: float
    features: tuple[int, ...]
    shares: np.ndarray
    steps: tuple[tuple[tuple[int, bool], ...], ...]


def leaves(tree: Tree) -> list[Leaf]:
    out = []
    stack: list[tuple[int, list[tuple[int, bool]]]] = [(0, [])]
    while stack:
        node, path = stack.pop()
        if tree.left[node] >= 0:
            stack.append((int(tree.right[node]), [*path, (node, False)]))
            stack.append((int(tree.left[node]), [*path, (node, True)]))
            continue
        by_feature: dict[int, list[tuple[int, bool]]] = {}
        share: dict[int, float] = {}
        for at, goes_left in path:
            f = int(tree.feature[at])
            child = tree.left[at] if goes_left else tree.right[at]
            by_feature.setdefault(f, []).append((at, goes_left))
            share[f] = share.get(f, 1.0) * (float(tree.cover[child]) / float(tree.cover[at]) if tree.cover[at] else 0.5)
        out.append(Leaf(tree.weight * float(tree.value[node]), tuple(by_feature), np.array([share[f] for f in by_feature]), tuple(tuple(s) for s in by_feature.values())))
    return out


def goes_left(tree: Tree, x: np.ndarray) -> np.ndarray:
    """(rows, nodes): whether each row goes left at each split; a code that no split knows goes right."""
    out = np.zeros((len(x), len(tree.left)), bool)
    for node in np.flatnonzero(tree.left >= 0):
        v = x[:, tree.feature[node]]
        if tree.is_category[node]:
            width = tree.category_left.shape[1]
            code = np.clip(np.nan_to_num(v, nan=-1), -1, width).astype(np.int64)
            known = (code >= 0) & (code < width)
            out[:, node] = known & tree.category_left[node, np.where(known, code, 0)]
        else:
            out[:, node] = v <= tree.threshold[node]
    return out


def _leaf_values(taken: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Shapley values of a leaf of value 1 for each pattern (rows of ``taken``: o_j as 0 or 1)."""
    rows, d = taken.shape
    out = np.empty((rows, d))
    weight = np.array([factorial(k) * factorial(d - 1 - k) / factorial(d) for k in range(d)])
    for i in range(d):
        c = np.zeros((rows, d))
        c[:, 0] = 1
        for j in range(d):
            if j != i:
                c[:, 1:] = c[:, 1:] * shares[j] + c[:, :-1] * taken[:, j, None]
                c[:, 0] *= shares[j]
        out[:, i] = (taken[:, i] - shares[i]) * (c @ weight)
    return out


TABLE_BITS = 10  # features of a leaf's path up to which all patterns are tabled; beyond it only those that rows have


def prepared(trees: list[Tree]) -> list[list[tuple[Leaf, np.ndarray | None]]]:
    """Each tree's leaves with the Shapley values of all patterns of their path's features (bit j of a pattern: o_j)."""
    out = []
    for tree in trees:
        found = [leaf for leaf in leaves(tree) if leaf.features]
        out.append([(leaf, _pattern_values(np.arange(1 << len(leaf.features)), leaf) if len(leaf.features) <= TABLE_BITS else None) for leaf in found])
    return out


def _pattern_values(patterns: np.ndarray, leaf: Leaf) -> np.ndarray:
    taken = patterns[:, None] >> np.arange(len(leaf.features)) & 1
    return leaf.value * _leaf_values(taken.astype(float), leaf.shares)


def shapley_values(trees: list[Tree], x: np.ndarray, features: int, ready: list | None = None) -> np.ndarray:
    """(rows, features) for a batch of rows; ``ready``: ``prepared(trees)``, for more batches than one."""
    out = np.zeros((features, len(x)))
    for tree, tables in zip(trees, ready or prepared(trees)):
        left = np.ascontiguousarray(goes_left(tree, x).T)
        for leaf, table in tables:
            pattern = np.zeros(len(x), np.int64)
            for j, steps in enumerate(leaf.steps):
                taken = np.logical_and.reduce([left[at] if way else ~left[at] for at, way in steps])
                pattern |= taken.astype(np.int64) << j
            if table is None:
                patterns, pattern = np.unique(pattern, return_inverse=True)
                table = _pattern_values(patterns, leaf)
            for j, f in enumerate(leaf.features):
                out[f] += table[:, j][pattern]
    return np.ascontiguousarray(out.T)


def base_value(trees: list[Tree]) -> float:
    """The expectation with no feature known."""
    return sum(leaf.value * float(np.prod(leaf.shares)) for tree in trees for leaf in leaves(tree))
