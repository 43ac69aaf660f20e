"""One regression tree from cells: rows of equal bins and categories, as counts and sums.

A tree cannot part rows of equal features, so nothing is lost by their merging: the best cuts follow
from how many rows a cell has and from their sum. Which rows a tree draws is decided row by row
(``drawn``). Work of a level is in proportion to the cells that are still apart, whatever the number
of categories: of each feature only values that occur in a node are looked at.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# Runs in Python workers; they need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CELLS = ("cell bigint, part int, weight double, total double, squares double, "
         "drawn array<int>, sums array<double>")
NODES = ("tree int, node int, feature int, value int, below int, price double, "
         "n double, total double, squares double")
FALLEN = "tree int, cell bigint, leaf int, price double"
# Of the five features the first and the last are bins, cut into lower and higher; the others are categories,
# one of them against the rest.
ORDERED = np.array([True, False, False, False, True])
# Gains below this share of a node's squares are rounding.
_NOISE = 1e-18
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
# How often a row is drawn, by 16 bits: Poisson with mean 1, the bootstrap of many rows.
_TIMES = np.searchsorted(
    np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)]), (np.arange(1 << 16) + 0.5) / (1 << 16), "right",
).astype(np.uint8)


def times_drawn(numbers: np.ndarray, trees: int) -> np.ndarray:
    """How often each tree (a column) draws the row of each 64-bit number."""
    steps = _STEP * np.arange(1, -(-trees // 4) + 1, dtype=np.uint64)
    z = numbers.view(np.uint64)[:, None] + steps
    z = (z ^ (z >> np.uint64(30))) * _MIX[0]
    z = (z ^ (z >> np.uint64(27))) * _MIX[1]
    return _TIMES[(z ^ (z >> np.uint64(31))).view(np.uint16)[:, :trees]]


def _lists(values: np.ndarray) -> pa.ListArray:
    rows, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * width), pa.array(values.ravel()))


def drawn(firsts: list[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows in the order of their cells to ``CELLS``: what each part of the trees sees and draws of a cell.

    Part i has the trees from ``firsts[i]`` on and sees no row of fold i, unless it is the only one.
    A cell that goes on in the next batch comes in two rows, to be added.
    """
    folds, trees = len(firsts) - 1, firsts[-1]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cell, fold, label, number = (
                batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "fold", "label", "number"))
            starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
            cells, place = cell[starts], np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(cell)]))
            times = times_drawn(number, trees).astype(np.float64)
            if folds > 1:
                for part in range(folds):
                    times[np.flatnonzero(fold == part), firsts[part]:firsts[part + 1]] = 0
            often = np.add.reduceat(times, starts, axis=0).astype(np.int32)
            sums = np.add.reduceat(times * label[:, None], starts, axis=0)
            own = np.stack([
                np.bincount(place * folds + fold, weights=x, minlength=len(cells) * folds).reshape(-1, folds)
                for x in (np.ones_like(label), label, label * label)])
            for part in range(folds):
                weight, total, squares = (np.delete(own, part, axis=2) if folds > 1 else own).sum(axis=2)
                seen, its = weight > 0, slice(firsts[part], firsts[part + 1])
                if seen.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cells[seen]), pa.array(np.full(seen.sum(), part, np.int32)),
                         *[pa.array(x[seen]) for x in (weight, total, squares)],
                         _lists(often[seen, its]), _lists(sums[seen, its])],
                        ["cell", "part", "weight", "total", "squares", "drawn", "sums"])

    return counted


def features(cell: np.ndarray, sizes: list[int]) -> np.ndarray:
    """The five numbers that a cell's number was made of."""
    found, rest = [], cell
    for size in reversed(sizes):
        rest, value = np.divmod(rest, size)
        found.append(value.astype(np.int32))
    return np.stack(found[::-1])


def _goes_first(values: np.ndarray, rows: np.ndarray, feature: np.ndarray, value: np.ndarray) -> np.ndarray:
    x = values[feature, rows]
    return np.where(ORDERED[feature], x <= value, x == value)


def _best_cuts(values, n, s, order, starts, sizes, total, mean, least):
    """For every node the feature (-1: none) and the value of the cut that lessens the squared error most."""
    at = np.repeat(np.arange(len(starts)), sizes)
    gain, feature, value = _NOISE * total * mean * mean, np.full(len(starts), -1), np.zeros(len(starts), np.int64)
    for f, rows in enumerate(order):
        x, many = values[f][rows], n[rows]
        new = np.r_[True, x[1:] != x[:-1]]
        new[starts] = True
        runs = np.flatnonzero(new)
        node, firsts = at[runs], np.searchsorted(runs, starts)
        first = np.add.reduceat(many, runs)
        # From the node's mean: sums stay small, and those of the two sides are opposite.
        off = np.add.reduceat(s[rows] - many * mean[at], runs)
        if ORDERED[f]:
            first, off = np.cumsum(first), np.cumsum(off)
            before = np.r_[0, first][firsts], np.r_[0, off][firsts]
            first, off = first - before[0][node], off - before[1][node]
        other = total[node] - first
        kept = (first >= least) & (other >= least)
        own = np.zeros(len(runs))
        own[kept] = off[kept] * off[kept] * total[node[kept]] / (first[kept] * other[kept])
        most = np.maximum.reduceat(own, firsts)
        equal = np.flatnonzero(own == most[node])[::-1]
        chosen = np.empty(len(starts), np.int64)
        chosen[node[equal]] = equal  # of equal ones the first, which is written last
        better = most > gain
        gain[better], feature[better], value[better] = most[better], f, x[runs[chosen[better]]]
    return feature, value


def grow(values: np.ndarray, n: np.ndarray, s: np.ndarray, max_depth: int, least: int) -> tuple[np.ndarray, ...]:
    """feature (-1: a leaf), value, number of the first node below (the other is the next) and mean of every node.

    Cells are ``values``, drawn ``n`` times with the sum ``s``. A leaf has ``least`` drawn rows or more.
    """
    order = [np.argsort(x, kind="stable") for x in values]
    starts, sizes, end, grown = np.array([0]), np.array([len(n)]), 1, []
    for depth in range(max_depth + 1):
        rows = order[0]
        total = np.add.reduceat(n[rows], starts)
        mean = np.add.reduceat(s[rows], starts) / total
        if depth < max_depth:
            feature, value = _best_cuts(values, n, s, order, starts, sizes, total, mean, least)
        else:
            feature, value = np.full(len(starts), -1), np.zeros(len(starts), np.int64)
        cut = feature >= 0
        grown.append((feature, value, np.where(cut, end + 2 * (np.cumsum(cut) - 1), -1), mean))
        if not cut.any():
            break
        end += 2 * cut.sum()
        at = np.repeat(np.arange(len(starts)), sizes)
        live = cut[at]
        goes_first = np.zeros(len(n), bool)
        goes_first[rows] = live & _goes_first(values, rows, feature[at], value[at])
        # Within each node the first side before the other, both in their order.
        sizes = sizes[cut]
        starts = np.r_[0, np.cumsum(sizes)[:-1]]
        firsts = np.add.reduceat(goes_first[rows[live]].astype(np.int64), starts)
        base, split, places = np.repeat(starts, sizes), np.repeat(firsts, sizes), np.arange(sizes.sum())
        for f in range(len(order)):
            rows = order[f][live]
            side = goes_first[rows]
            upto = np.cumsum(side)
            rank = upto - np.repeat((upto - side)[starts], sizes)
            order[f] = np.empty_like(rows)
            order[f][np.where(side, base + rank - 1, places + split - rank)] = rows
        sizes = np.stack([firsts, sizes - firsts], axis=1).ravel()
        starts = np.r_[0, np.cumsum(sizes)[:-1]]
    return tuple(np.concatenate(x) for x in zip(*grown))


def leaves_of(values: np.ndarray, feature: np.ndarray, value: np.ndarray, below: np.ndarray) -> np.ndarray:
    """The leaf of every cell."""
    node, rows = np.zeros(values.shape[1], np.int64), np.arange(values.shape[1])
    while len(rows := rows[feature[node[rows]] >= 0]):
        at = node[rows]
        node[rows] = below[at] + ~_goes_first(values, rows, feature[at], value[at])
    return node


def grown(sizes: list[int], max_depth: int, least: int) -> Callable[[pa.Table], pa.Table]:
    """The cells of one tree to its nodes; a leaf also knows the labels of all rows seen, drawn or not."""

    def fit(table: pa.Table) -> pa.Table:
        tree, columns = table["tree"][0].as_py(), ("cell", "weight", "total", "squares", "drawn", "sums")
        cell, *numbers = (table[c].to_numpy() for c in columns)
        order = np.argsort(cell, kind="stable")
        cell = cell[order]
        starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        weight, total, squares, n, s = (np.add.reduceat(x[order].astype(np.float64), starts) for x in numbers)
        values = features(cell[starts], sizes)
        if not n.any():
            n, s = weight, total  # of very few rows, perhaps none is drawn: then each is once
        feature, value, below, price = grow(values[:, n > 0], n[n > 0], s[n > 0], max_depth, least)
        leaf, count = leaves_of(values, feature, value, below), len(feature)
        return pa.table({
            "tree": np.full(count, tree, np.int32), "node": np.arange(count, dtype=np.int32),
            "feature": feature.astype(np.int32), "value": value.astype(np.int32), "below": below.astype(np.int32),
            "price": price, **{k: np.bincount(leaf, x, count) for k, x in
                               (("n", weight), ("total", total), ("squares", squares))},
        })

    return fit


def fallen(sizes: list[int]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Nodes of one tree and cells to ``FALLEN``: the leaf each cell falls into, and the leaf's price."""

    def fall(nodes: pa.Table, asked: pa.Table) -> pa.Table:
        if not (nodes.num_rows and asked.num_rows):
            asked, leaf, price = asked.slice(0, 0), np.empty(0, np.int32), np.empty(0)
        else:
            nodes = nodes.sort_by("node")
            feature, value, below, price = (nodes[c].to_numpy() for c in ("feature", "value", "below", "price"))
            leaf = leaves_of(features(asked["cell"].to_numpy(), sizes), feature, value, below)
            price = price[leaf]
        return pa.table({"tree": asked["tree"], "cell": asked["cell"], "leaf": leaf.astype(np.int32), "price": price})

    return fall
