"""Gradient-boosted trees for several labels over one frame.

The trees are those of Spark ML's ``GBTClassifier`` (logistic loss, step 0.1, 32 bins, variance,
all rows and all features): same candidate splits, same gain, same leaves. Its jobs are one for each label,
round and level; here the labels grow together, so a level is one job for all of them, and the
result is read back as ``GBTClassificationModel``, which scores in the JVM.

* Candidate splits come from all rows (``GBTClassifier`` takes 10,000 of them above that number): value
  counts of each part of the frame, with more than ``SUMMARY`` distinct values cut to as many cells. They
  weigh rows as the label does, so each label has its own; columns are binned by those of all labels.
* The frame is cut into blocks of rows: columns as mixed-radix codes of several columns together
  (columns of one one-hot encoding are one), so one count serves several features. Scores of the
  labels are a second table, new in each round; every ``CHECKPOINT`` rounds it is written.
* A level counts weight and residual for the lighter child of each split; the other is its parent's
  less that. Partitions send sums for each column, whose number does not grow with the rows.

Residuals are kept with 32 bits, scores and sums with 64. Sums are added in another order than by ``GBTClassifier``, and which of two equally good splits is
taken depends on that (as it does there on the partitions).
"""

from __future__ import annotations

import json
import os
import sys
from concurrent.futures import ThreadPoolExecutor
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.linalg import Vectors
from pyspark.serializers import BatchedSerializer, CPickleSerializer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_BINS = 32
STEP = 0.1
SUMMARY = 4096
CHECKPOINT = 10
#: Rows of a block, and about of a partition of blocks: at most, and at least in small frames.
CHUNK = 1 << 16
MOST_ROWS = 1_000_000
LEAST_ROWS = 50_000

# Workers need not be able to import this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def parts_of(n_rows: int, slots: int) -> int:
    """Partitions of the blocks: one for each slot or whole waves of them, fewer for small frames."""
    if n_rows <= MOST_ROWS * slots:
        return max(1, min(slots, n_rows // LEAST_ROWS))
    return -(-n_rows // (MOST_ROWS * slots)) * slots


def _matrix(batch: pa.RecordBatch, names: Sequence[str]) -> np.ndarray:
    """The columns ``names`` as rows of a matrix."""
    out = np.empty((len(names), batch.num_rows))
    for k, n in enumerate(names):
        column = batch.column(n)
        if column.null_count:
            raise ValueError(f"column {n} of the train rows has nulls")
        out[k] = column.to_numpy(zero_copy_only=False)
        if np.isnan(out[k]).any():
            raise ValueError(f"column {n} of the train rows has NaN")
    return out


def _gathered(batches, features: Sequence[str], labels: Sequence[str]):
    """(features, labels) of ``CHUNK`` rows and up to a batch more at a time."""
    held, n = [], 0
    for batch in batches:
        held.append((_matrix(batch, features), _matrix(batch, labels) == 1))
        n += batch.num_rows
        if n >= CHUNK:
            yield tuple(np.concatenate(x, axis=1) for x in zip(*held))
            held, n = [], 0
    if n:
        yield tuple(np.concatenate(x, axis=1) for x in zip(*held))


def _merged(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``values`` in order, with their ``counts`` (a row for each value) summed."""
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    new = np.flatnonzero(np.r_[True, values[1:] != values[:-1]][:len(values)])
    return (values[new], np.add.reduceat(counts, new, axis=0)) if len(new) else (values, counts)


def _cells(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At most ``SUMMARY`` cells of neighbouring values with about as many rows, each at its largest value."""
    if len(values) <= SUMMARY:
        return values, counts
    rows = np.cumsum(counts[:, 0])
    cell = (rows - 1) * SUMMARY // rows[-1]
    last = np.flatnonzero(np.r_[cell[1:] != cell[:-1], True])
    sums = np.cumsum(counts, axis=0)[last]
    return values[last], np.diff(sums, axis=0, prepend=np.zeros((1, counts.shape[1]), sums.dtype))


def thresholds_of(values: np.ndarray, weight: np.ndarray, n_bins: int = MAX_BINS) -> np.ndarray:
    """Candidate splits of ``GBTClassifier`` for distinct ascending values with their weights."""
    if len(values) <= n_bins:
        return (values[1:] + values[:-1]) / 2.0
    stride = weight.sum() / n_bins
    out, target, now = [], stride, weight[0]
    for k in range(1, len(values)):
        before, now = now, now + weight[k]
        if abs(before - target) < abs(now - target):
            out.append((values[k - 1] + values[k]) / 2.0)
            target += stride
    return np.array(out)


def _value_counts(frame: DataFrame, features: list[str], labels: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each feature (distinct values or cells, their rows and positives of each label)."""
    def count(batches):
        held = [(np.zeros(0), np.zeros((0, 1 + len(labels)), np.int64))] * len(features)
        for x, y in _gathered(batches, features, labels):
            positive = [np.flatnonzero(p) for p in y]
            for k in range(len(features)):
                values, code = np.unique(x[k] + 0.0, return_inverse=True)
                counts = np.array([np.bincount(code, minlength=len(values)), *(np.bincount(code[p], minlength=len(values)) for p in positive)]).T
                held[k] = _merged(np.r_[held[k][0], values], np.r_[held[k][1], counts])
        held = [_cells(*x) for x in held]
        yield pa.RecordBatch.from_pydict({"feature": pa.array(range(len(features)), pa.int32()), "x": [x.tobytes() for x, _ in held],
                                          "n": [n.tobytes() for _, n in held]})

    parts: list[list] = [[] for _ in features]
    for r in frame.mapInArrow(count, "feature int, x binary, n binary").collect():  # parts x features x SUMMARY at most
        parts[r["feature"]].append((np.frombuffer(r["x"]), np.frombuffer(r["n"], np.int64).reshape(-1, 1 + len(labels))))
    return [_merged(np.concatenate([x for x, _ in p]), np.concatenate([n for _, n in p])) for p in parts]


class Layout:
    """Columns of the blocks, and where each feature is in them.

    ``columns``: (group, stride, size) of a column: its code is ``code of group // stride % size``.
    ``feature``: (column, k) of a feature; k is its place in a one-hot column, else 0.
    """

    def __init__(self, cuts: list[np.ndarray], exclusive: list[list[int]], cells: int):
        self.cuts = cuts
        self.feature: dict[int, tuple[int, int]] = {}
        sizes = []
        together = [[f for f in some if len(cuts[f]) == 1] for some in exclusive]
        for some in [x for x in together if len(x) > 1]:
            for k, f in enumerate(some):
                self.feature[f] = (len(sizes), k + 1)
            sizes.append(len(some) + 1)
        for f, x in enumerate(cuts):
            if f not in self.feature and len(x):
                self.feature[f] = (len(sizes), 0)
                sizes.append(len(x) + 1)
        self.groups: list[int] = []
        self.columns: list = [None] * len(sizes)
        for c in sorted(range(len(sizes)), key=lambda c: -sizes[c]):
            g = next((g for g, n in enumerate(self.groups) if n * sizes[c] <= cells), len(self.groups))
            if g == len(self.groups):
                self.groups.append(1)
            self.columns[c] = (g, self.groups[g], sizes[c])
            self.groups[g] *= sizes[c]
        self.type = np.uint16 if max(self.groups, default=1) <= 1 << 16 else np.uint32
        self.begin = np.r_[0, np.cumsum(sizes)].astype(int)  # of the columns in the sums

    def codes(self, x: np.ndarray) -> np.ndarray:
        """The groups' codes of rows x (features, rows)."""
        out = np.zeros((len(self.groups), x.shape[1]), self.type)
        for f, (c, k) in self.feature.items():
            g, stride, _ = self.columns[c]
            at = np.searchsorted(self.cuts[f], x[f], side="left")
            out[g] += (at * max(k, 1) * stride).astype(self.type)
        return out

    def goes_right(self, f: int, p: int) -> np.ndarray:
        """For each code of the feature's group: is its value over the ``p``-th cut?"""
        c, k = self.feature[f]
        g, stride, size = self.columns[c]
        code = np.arange(self.groups[g]) // stride % size
        return code == k if k else code > p

    def by_column(self, group: int, sums: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """(column, sums by its codes) from sums (slots, codes of the group)."""
        return [(c, sums.reshape(len(sums), -1, size, stride).sum(axis=(1, 3)))
                for c, (g, stride, size) in enumerate(self.columns) if g == group]

    def left_of(self, f: int, p: int) -> np.ndarray:
        """Flags of the sums' entries that are left of the ``p``-th cut."""
        c, k = self.feature[f]
        a, b = self.begin[c:c + 2]
        out = np.zeros(self.begin[-1])
        out[a:b] = np.arange(b - a) != k if k else np.arange(b - a) <= p
        return out


def _residual(y: np.ndarray, score: np.ndarray | None) -> np.ndarray:
    """What the next tree is fitted to: the label as -1 or 1, then the loss's negative gradient."""
    sign = y * 2.0 - 1.0
    return sign if score is None else 4.0 * sign / (1.0 + np.exp(2.0 * sign * score))


def _weight(w: tuple[float, float], residual: np.ndarray) -> np.ndarray:
    """Weights of rows; a residual has the sign of its label."""
    return np.array(w[::-1])[np.signbit(residual).view(np.uint8)]


class Sums:
    """Sums of values by slot and code, in the codes of the groups until they are asked for."""

    def __init__(self, layout: Layout, n_slots: int, n_values: int):
        self.layout, self.n_slots = layout, n_slots
        self.sums = [[np.zeros(n_slots * n) for n in layout.groups] for _ in range(n_values)]

    def add(self, codes, slot, at, values: list) -> None:
        """Rows ``at`` of ``codes`` (None for all) with their slots."""
        for g, n in enumerate(self.layout.groups):
            code = codes[g] if at is None else codes[g].take(at)
            if self.n_slots > 1:
                code += slot * n
            for k, v in enumerate(values):
                self.sums[k][g] += np.bincount(code, v, n * self.n_slots)

    def by_column(self) -> np.ndarray:
        """(values, slots, columns' codes)."""
        out = np.zeros((len(self.sums), self.n_slots, int(self.layout.begin[-1])))
        for k, groups in enumerate(self.sums):
            for g, x in enumerate(groups):
                for c, y in self.layout.by_column(g, x.reshape(self.n_slots, -1)):
                    out[k, :, self.layout.begin[c]:self.layout.begin[c + 1]] = y
        return out


def _last(blocks, at_end):
    """Pairs (of a block, None); the last has ``at_end()`` in place of None."""
    held = None
    for x in blocks:
        if held:
            yield held[0], None
        held = (x,)
    if held:
        yield held[0], at_end()


def _roots(layout: Layout, weights, blocks):
    """For each label the sums of a partition's first residuals: (weight and residual; columns' codes)."""
    sums = [Sums(layout, 1, 2) for _ in weights]
    for codes, y in blocks:
        code = codes.astype(np.int64)
        for t, w in enumerate(weights):
            r = _residual(y[t], None)
            weight = _weight(w, r)
            sums[t].add(code, None, None, [weight, weight * r])
    yield [x.by_column()[:, 0] for x in sums]


def _moved(layout: Layout, splits: list, code: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Nodes of rows a level down; ``splits``: (feature, cut) of each node, or None. Rows of a leaf go left."""
    split = [k for k, s in enumerate(splits) if s is not None]
    if not split:
        return node * 2
    group = [layout.columns[layout.feature[splits[k][0]][0]][0] for k in split]
    width, n = max(layout.groups[g] for g in group), code.shape[1]
    begin, right = np.full(len(splits), group[0] * n), np.zeros((len(splits), width), np.uint8)
    for k, g in zip(split, group):
        begin[k] = g * n
        right[k, :layout.groups[g]] = layout.goes_right(*splits[k])
    at = begin.take(node)
    at += np.arange(n)
    at = code.ravel().take(at)
    at += np.arange(0, len(splits) * width, width).take(node)
    return node * 2 + right.ravel().take(at)


def _level(layout: Layout, weights, splits: list, slots: list, kind, blocks):
    """(nodes, sums) of each block: rows a level down; with the last the partition's sums (2, slots, columns'
    codes) of the nodes that have a slot, for each label."""
    sums = [Sums(layout, int(s.max(initial=-1)) + 1, 2) for s in slots]

    def moved():
        for (codes, _), residual, nodes in blocks:
            code = codes.astype(np.int64)
            new = np.zeros((len(weights), codes.shape[1]), kind)
            for t, w in enumerate(weights):
                new[t] = node = _moved(layout, splits[t], code, np.zeros(codes.shape[1], kind) if nodes is None else nodes[t])
                if sums[t].n_slots:
                    slot = slots[t].take(node)
                    at = np.flatnonzero(slot >= 0)
                    r = residual[t].take(at)
                    weight = _weight(w, r)
                    sums[t].add(code, slot.take(at), at, [weight, weight * r])
            yield new

    return _last(moved(), lambda: [x.by_column() for x in sums])


def _closed(layout: Layout, weights, step: float, splits: list, leaves: list, kind, blocks):
    """((scores with a tree more, their residuals), sums) of each block; with the last the partition's sums for each label:
    rows, weight, residual and its square at each leaf, and residuals for the next root."""
    at_leaves = [np.zeros((4, len(v))) for v in leaves]
    root = [Sums(layout, 1, 1) for _ in weights]

    def scored():
        for (codes, y), (score, residual), nodes in blocks:
            code = codes.astype(np.int64)
            out, new = np.empty(y.shape), np.empty(y.shape, np.float32)  # residuals are read at each level
            for t, w in enumerate(weights):
                node = _moved(layout, splits[t], code, np.zeros(codes.shape[1], kind) if nodes is None else nodes[t]).astype(np.int64)
                r = residual[t]
                weight = _weight(w, r)
                for k, v in enumerate((None, weight, weight * r, weight * r * r)):
                    at_leaves[t][k] += np.bincount(node, v, len(leaves[t]))
                out[t] = step * leaves[t].take(node) + (0.0 if score is None else score[t])
                new[t] = _residual(y[t], out[t])
                root[t].add(code, None, None, [weight * new[t]])
            yield out, new

    return _last(scored(), lambda: (at_leaves, [x.by_column()[:, 0] for x in root]))


def _kept(rdd: RDD) -> RDD:
    """One element a block, each stored by itself, so such tables can be zipped as they are. They are bytes
    already: kept as they are, and not compressed, while memory lasts."""
    return rdd._reserialize(BatchedSerializer(CPickleSerializer(), 1)).persist(StorageLevel(True, True, False, True))


class Tree:
    """A growing tree: nodes of each level by their place; ``open``: sums of those that may be split."""

    def __init__(self, depth: int, any_column: slice, sums: np.ndarray):
        """``any_column``: a column's part of the sums (weight and residual, by the columns' codes)."""
        self.depth, self.any_column = depth, any_column
        self.split: list[dict] = [{} for _ in range(depth)]  # place -> (feature, cut, threshold, gain)
        w, s = sums[:, any_column].sum(axis=1)
        self.value: list[dict] = [{0: s / w}, *({} for _ in range(depth))]  # place -> prediction
        self.open = {0: sums}

    def grow(self, level: int, candidates) -> tuple[list, np.ndarray]:
        """Splits the open nodes of a level: (splits by place, slots of their lighter children by place)."""
        features, cuts, thresholds, left_of = candidates
        splits: list = [None] * (1 << level)
        slots = np.full(2 << level, -1, np.int64)
        self.light: list[tuple[int, int, np.ndarray]] = []  # lighter child, other child, sums of the parent
        places = sorted(self.open)
        if places and len(features):
            sums = np.stack([self.open[p] for p in places])
            total = sums[:, :, self.any_column].sum(axis=2)
            left = sums @ left_of.T
            w, s = total[:, :1], total[:, 1:]
            lw, ls = left[:, 0], left[:, 1]
            rw, rs = w - lw, s - ls
            least = 1e-9 * w
            with np.errstate(all="ignore"):
                gain = np.where((lw > least) & (rw > least), (ls * ls / lw + rs * rs / rw - s * s / w) / w, -1.0)
            best = gain.argmax(axis=1)
            for i, p in enumerate(places):
                b = best[i]
                if gain[i, b] <= 1e-13 * max(1.0, (s[i, 0] / w[i, 0]) ** 2):
                    continue
                self.split[level][p] = (int(features[b]), int(cuts[b]), float(thresholds[b]), float(gain[i, b]))
                splits[p] = (int(features[b]), int(cuts[b]))
                self.value[level + 1][2 * p] = ls[i, b] / lw[i, b]
                self.value[level + 1][2 * p + 1] = rs[i, b] / rw[i, b]
                small = 2 * p + int(rw[i, b] < lw[i, b])
                slots[small] = len(self.light)
                self.light.append((small, small ^ 1, self.open[p]))
        self.open = {}
        return splits, slots

    def fill(self, sums: np.ndarray) -> None:
        """Sums of the children, from those of the lighter ones (2, slots, codes)."""
        for k, (small, other, parent) in enumerate(self.light):
            self.open[small] = sums[:, k]
            self.open[other] = parent - sums[:, k]

    def leaves(self) -> np.ndarray:
        """Predictions by the place that a leaf's rows have at the deepest level."""
        out = np.zeros(1 << self.depth)
        for level, values in enumerate(self.value):
            for p, v in values.items():
                if level == self.depth or p not in self.split[level]:
                    out[p << (self.depth - level)] = v
        return out

    def rows(self, tree_id: int, at_leaves: np.ndarray) -> list[tuple]:
        """The tree as Spark ML stores it; ``at_leaves``: rows, weight, residual, its square by place."""
        out: list = []

        def add(level: int, p: int) -> int:
            wide = self.depth - level
            rows, w, s, ss = at_leaves[:, p << wide:(p + 1) << wide].sum(axis=1)
            value = self.value[level][p]
            impurity = max(0.0, (ss - s * s / w) / w) if w else 0.0
            me, split = len(out), self.split[level].get(p) if level < self.depth else None
            out.append(None)
            left = right = -1
            if split:
                left, right = add(level + 1, 2 * p), add(level + 1, 2 * p + 1)
                a, b = out[left], out[right]
                if a[6] == b[6] == -1 and a[1] == b[1]:  # leaves with one prediction are one, as in GBTClassifier
                    del out[me + 1:]
                    split, left, right = None, -1, -1
            out[me] = (me, float(value), float(impurity), [float(w), float(s), float(ss)], int(rows), split[3] if split else -1.0,
                       left, right, (split[0], [split[2]], -1) if split else (-1, [], -1))
            return me

        add(0, 0)
        return [(tree_id, x) for x in out]


def boosted_trees(frame: DataFrame, features: list[str], labels: list[str], weights: list[tuple[float, float]],
                  exclusive: list[list[int]] = (), rounds: int = 100, depth: int = 6, n_rows: int | None = None) -> list[list[list[tuple]]]:
    """For each label its trees, as rows of Spark ML's storage.

    frame: numeric columns ``features`` and 0/1 columns ``labels``, read several times. weights: of the
    rows with label 0 and 1. exclusive: features that are 0 or 1, of each list at most one 1 in a row.
    """
    sc = frame.sparkSession.sparkContext
    n_rows = frame.count() if n_rows is None else n_rows
    n_parts = parts_of(n_rows, sc.defaultParallelism)
    counts = _value_counts(frame, features, labels)
    own = [[thresholds_of(x, n[:, 0] * w[0] + n[:, 1 + t] * (w[1] - w[0])) for x, n in counts] for t, w in enumerate(weights)]
    cuts = [np.unique(np.concatenate([o[f] for o in own])) for f in range(len(features))]
    layout = Layout(cuts, [list(x) for x in exclusive], max(64, min(4096, n_rows // n_parts // 64)))
    candidates = []
    for o in own:
        some = [(f, int(np.searchsorted(cuts[f], c)), c) for f in range(len(features)) for c in o[f]]
        candidates.append((np.array([x[0] for x in some]), np.array([x[1] for x in some]), np.array([x[2] for x in some]),
                           np.array([layout.left_of(f, p) for f, p, _ in some]).reshape(len(some), -1)))

    def block(batches):
        for x, y in _gathered(batches, features, labels):
            yield pa.RecordBatch.from_pydict({"codes": [layout.codes(x).tobytes()], "y": [y.astype(np.uint8).tobytes()]})

    def arrays(r):
        y = np.frombuffer(r[1], np.uint8).reshape(len(labels), -1)
        return np.frombuffer(r[0], layout.type).reshape(len(layout.groups), y.shape[1]), y

    blocks = _kept(frame.mapInArrow(block, "codes binary, y binary").repartition(n_parts).rdd.map(arrays))
    kind = np.uint8 if depth <= 8 else np.uint32
    any_column = slice(int(layout.begin[0]), int(layout.begin[1]))
    trees: list[list[Tree]] = [[] for _ in labels]
    at_leaves: list[list] = [[] for _ in labels]
    root = _added(blocks.mapPartitions(lambda x: _roots(layout, weights, x)).collect())
    root_weight = [r[0] for r in root]
    closed = _kept(blocks.map(lambda x: ((None, _residual(x[1], None).astype(np.float32)), None)))
    written: list[str] = []
    for k in range(rounds):
        for t in range(len(labels)):
            trees[t].append(Tree(depth, any_column, np.stack([root_weight[t], root[t][-1]])))
        residuals, nodes = _kept(closed.map(lambda x: x[0][1])), None
        rows, used = blocks.zip(residuals), [closed, residuals]
        for level in range(depth):
            grown = [trees[t][k].grow(level, candidates[t]) for t in range(len(labels))]
            splits, slots = [x[0] for x in grown], [x[1] for x in grown]
            if level == depth - 1:
                break
            at = rows.map(lambda x: (*x, None)) if nodes is None else rows.zip(nodes).map(lambda x: (*x[0], x[1][0]))
            nodes = _kept(at.mapPartitions(lambda x, a=(splits, slots, kind): _level(layout, weights, *a, x)))
            used.append(nodes)
            for t, s in enumerate(_added(nodes.map(lambda x: x[1]).collect())):
                trees[t][k].fill(s)
        given = 1.0 if k == 0 else STEP, splits, [trees[t][k].leaves() for t in range(len(labels))], kind
        rows = blocks.zip(closed)
        at = rows.map(lambda x: (x[0], x[1][0], None)) if nodes is None else rows.zip(nodes).map(lambda x: (x[0][0], x[0][1][0], x[1][0]))
        closed = _kept(at.mapPartitions(lambda x, a=given: _closed(layout, weights, *a, x)))
        if k % CHECKPOINT == CHECKPOINT - 1:
            closed.checkpoint()
        told = [x for x in closed.map(lambda x: x[1]).collect() if x is not None]
        for t, s in enumerate(_added([x[0] for x in told])):
            at_leaves[t].append(s)
        root = _added([x[1] for x in told])
        for rdd in used:
            rdd.unpersist()
        if closed.isCheckpointed():
            _remove(sc, written)
            written = [closed.getCheckpointFile()]
    for rdd in (blocks, closed):
        rdd.unpersist()
    _remove(sc, written)
    return [[row for i, tree in enumerate(trees[t]) for row in tree.rows(i, at_leaves[t][i])] for t in range(len(labels))]


def _added(parts: list) -> list:
    """Sums of the partitions added up, for each label."""
    return [np.sum(x, axis=0) for x in zip(*(p for p in parts if p is not None))]


def _remove(sc, paths: list[str]) -> None:
    """Deletes checkpoints of this fit that nothing reads any more."""
    for p in paths:
        path = sc._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


NODES = ("treeID int, nodeData struct<id:int,prediction:double,impurity:double,impurityStats:array<double>,rawCount:bigint,gain:double,"
         "leftChild:int,rightChild:int,split:struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>>")


def as_models(spark: SparkSession, trees: list[list[tuple]], n_features: int, rounds: int, path: str,
              **params) -> list[GBTClassificationModel]:
    """Trees as ``GBTClassificationModel``, through its storage under ``path``; ``params``: of the classifier."""
    # The head of the storage is that of a model which Spark ML has written: it knows its version and parameters.
    rows = [(Vectors.sparse(n_features, {}), float(k), 1.0) for k in (0, 1)]
    sample = spark.createDataFrame(rows, ["features", "_label", "_w"]).coalesce(1)
    GBTClassifier(maxIter=1, **params).fit(sample).write().save(os.path.join(path, "head"))
    head = json.loads(spark.read.text(os.path.join(path, "head", "metadata")).first()[0])
    tree = spark.read.parquet(os.path.join(path, "head", "treesMetadata"))
    head["paramMap"]["maxIter"], head["numTrees"], head["numFeatures"] = rounds, rounds, n_features
    heads = tree.select(F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("k"), "*").select(
        F.col("k").cast("int").alias(tree.columns[0]), tree.columns[1],
        F.when(F.col("k") == 0, 1.0).otherwise(STEP).alias(tree.columns[2])).coalesce(1)

    def load(t: int) -> GBTClassificationModel:
        at = os.path.join(path, str(t))
        one = head | {"uid": f"{head['uid']}_{t}"}
        spark.createDataFrame([(json.dumps(one),)], "value string").coalesce(1).write.text(os.path.join(at, "metadata"))
        heads.write.parquet(os.path.join(at, "treesMetadata"))
        spark.createDataFrame(trees[t], NODES).coalesce(1).write.parquet(os.path.join(at, "data"))
        return GBTClassificationModel.load(at)

    with ThreadPoolExecutor(max_workers=max(1, min(8, len(trees)))) as pool:
        return list(pool.map(load, range(len(trees))))
