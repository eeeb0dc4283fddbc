"""Decision trees and boosted trees over sparse vectors: Spark's estimators and models with another way to fit.

Spark's own fit holds every row as one bin for each feature and adds up a statistic for each of them, at every level.
Encoded listings have hundreds of features, nearly all of them zero: here a row costs what its vector stores. The
statistics of zeros are those of the node less the stored ones. A level is one Spark job: tasks add up the stored bins of
their rows by node, the sums are shuffled by node, and the tasks that receive them name the best split of each node. Nodes
of few rows don't go on level by level: their rows are shuffled once, and a task grows what is below them. The
driver sees splits, never rows. Candidate splits, gains and stopping follow the parameters of the estimators.
"""

from __future__ import annotations

import heapq
import json
import math
import pickle
import time
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import classification, regression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.session import importable
from forecourt.sources.storage import scratch

#: Nodes whose sums lie open at a time, and nodes for which one more task is worth its start.
OPEN_NODES = 64
NODES_PER_TASK = 32
#: Levels of no more nodes, and of no more sums in all tasks, are put together on the driver: a shuffle would take longer.
FEW_NODES, FEW_SUMS = 8, 1_000_000
#: Rows of a task, once every core has one.
ROWS_PER_TASK = 250_000
#: Rows of a node below which one task grows the rest.
SUBTREE_ROWS = 200_000
#: Stored values of a table whose boosted rounds one task does, all of them: a job for each level would take longer.
ROUNDS_VALUES = 16_000_000
#: Stored values that such a task works through at a time, and sums that it may hold open for the nodes of a level.
CHUNK_VALUES, OPEN_SUMS = 250_000, 4_000_000
#: Gains that differ by less, as a share of the node's impurity, are equal: the earlier split wins.
EVEN = 1e-11
EPSILON = 2.0 ** -52


@dataclass(frozen=True)
class Bins:
    """The bins of all features end to end: feature f has those from start[f] on, one more than it has cuts."""

    cuts: np.ndarray
    start: np.ndarray

    @property
    def count(self) -> int:
        return int(self.start[-1])

    def feature_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.start) - 1), np.diff(self.start))

    def first_cut(self) -> np.ndarray:
        return self.start - np.arange(len(self.start))

    def of(self, feature: np.ndarray, value: np.ndarray) -> np.ndarray:
        """The bin of each value: the number of its feature's cuts below it."""
        first = self.first_cut()
        low, high = first[feature], first[feature + 1]
        begin = low.copy()
        while len(low) and (open_ := low < high).any():
            middle = (low + high) // 2
            above = open_ & (self.cuts[np.minimum(middle, len(self.cuts) - 1)] < value)
            low, high = np.where(above, middle + 1, low), np.where(open_ & ~above, middle, high)
        return self.start[feature] + low - begin

    def zero(self) -> np.ndarray:
        features = np.arange(len(self.start) - 1)
        return self.of(features, np.zeros(len(features)))


@dataclass
class Tree:
    """Nodes in the order in which they came; the right child follows the left one. A leaf has the feature -1. `name` is the
    node's place in a full tree, whatever the order: 0 for the root, 2 n + 1 and 2 n + 2 for the children of n."""

    feature: list = field(default_factory=list)
    bin: list = field(default_factory=list)
    left: list = field(default_factory=list)
    gain: list = field(default_factory=list)
    stats: list = field(default_factory=list)
    name: list = field(default_factory=list)

    def add(self, stats, name: int = 0) -> int:
        for column, value in ((self.feature, -1), (self.bin, -1), (self.left, -1), (self.gain, -1.0), (self.stats, stats), (self.name, name)):
            column.append(value)
        return len(self.feature) - 1

    def split(self, node: int, gain: float, feature: int, cut: int, stats, left) -> tuple[int, int]:
        """The children of a node that is split."""
        self.feature[node], self.bin[node], self.gain[node] = feature, cut, gain
        self.left[node] = self.add(left, 2 * self.name[node] + 1)
        return self.left[node], self.add(stats - left, 2 * self.name[node] + 2)

    def graft(self, roots: list[int], other: Tree) -> None:
        """Puts the trees of `other`, whose first nodes are their roots, in the place of the nodes `roots`."""
        shift = len(self.feature) - len(roots)
        for k, left in enumerate(other.left):
            left = left + shift if left >= 0 else left
            if k < len(roots):
                at = roots[k]
                self.feature[at], self.bin[at], self.left[at], self.gain[at], self.stats[at] = (
                    other.feature[k], other.bin[k], left, other.gain[k], other.stats[k])
            else:
                at = self.add(other.stats[k], other.name[k])
                self.feature[at], self.bin[at], self.left[at], self.gain[at] = other.feature[k], other.bin[k], left, other.gain[k]

    def packed(self) -> tuple:
        return tuple(np.array(c, dtype=np.int64) for c in (self.feature, self.bin, self.left))


def impurity(stats: np.ndarray, classes: bool) -> tuple[np.ndarray, np.ndarray]:
    """(rows, impurity) from the last axis: rows by class, or rows, sum and sum of squares."""
    n = stats.sum(-1) if classes else stats[..., 0]
    of = np.maximum(n, 1)
    if classes:
        left = np.where(n > 0, 1.0, 0.0)
        for k in range(stats.shape[-1]):
            share = stats[..., k] / of
            left = left - share * share
        return n, left
    return n, (stats[..., 2] - stats[..., 1] ** 2 / of) / of


def varied(stats: np.ndarray, classes: bool) -> bool:
    """Whether the rows of these sums differ in what is learnt, by more than what rounding leaves of equal numbers."""
    n, spread = impurity(stats, classes)
    return bool(spread > EPSILON * (1.0 if classes else max(1.0, 64 * stats[2] / max(n, 1))))


def _thresholds(x: np.ndarray, n: np.ndarray, most: int, rows: int) -> list[float]:
    """Cuts of a feature from its different stored values, in order, and their numbers: between all values, or at even
    strides of the rows."""
    if (zeros := rows - n.sum()) > 0:
        at = np.searchsorted(x, 0.0)
        x, n = np.insert(x, at, 0.0), np.insert(n, at, zeros)
    between = (x[:-1] + x[1:]) / 2
    if len(between) <= most:
        return between.tolist()
    stride = rows / (most + 1)
    found, target, seen = [], stride, np.cumsum(n).tolist()
    for i in range(1, len(x)):
        if abs(seen[i - 1] - target) < abs(seen[i] - target):
            found.append(float(between[i - 1]))
            target += stride
    return found


def _stored(df: DataFrame, features: str, label: str) -> DataFrame:
    """(y, i, x): label, positions and values that a vector stores."""
    v = F.unwrap_udt(F.col(features))
    return df.select(F.col(label).cast("double").alias("y"), F.coalesce(v["indices"], F.sequence(F.lit(0), F.size(v["values"]) - 1)).alias("i"),
                     v["values"].alias("x"), F.coalesce(v["size"], F.size(v["values"])).alias("size"))


def binned(stored: DataFrame, rows: int, size: int, most: int, seed: int) -> Bins:
    """Bins from all rows, or, as Spark's trees do, from a sample of max(most squared, 10,000) of a larger table."""
    wanted = max(most * most, 10_000)
    some = stored if rows <= wanted else stored.sample(wanted / rows, seed)
    counted = some.count() if rows > wanted else rows
    values = some.select(F.inline(F.arrays_zip(F.col("i"), F.col("x")))).where("x <> 0").groupBy("i", "x").agg(F.count(F.lit(1)).alias("n"))
    most = min(most, rows) - 1

    def cuts(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None  # the last feature of a batch may go on in the next one
        for b in batches:
            kept = b if kept is None else pd.concat([kept, b])
            i, x, n = (kept[c].to_numpy() for c in ("i", "x", "n"))
            at = np.flatnonzero(np.diff(i, prepend=-1)) if len(i) else []
            if len(at) > 1:
                yield pd.DataFrame({"i": i[at[:-1]], "cuts": [_thresholds(x[a:b], n[a:b], most, counted) for a, b in zip(at, at[1:])]})
                kept = kept.iloc[at[-1]:]
        if kept is not None and len(kept):
            yield pd.DataFrame({"i": [kept["i"].iloc[0]], "cuts": [_thresholds(kept["x"].to_numpy(), kept["n"].to_numpy(), most, counted)]})

    ordered = values.where(~F.isnan("x")).repartition("i").sortWithinPartitions("i", "x")
    found = {r.i: r.cuts for r in ordered.mapInPandas(cuts, "i int, cuts array<double>").collect()}
    every = [found.get(f, []) for f in range(size)]
    return Bins(np.array([c for cuts in every for c in cuts], dtype=float), np.concatenate([[0], np.cumsum([len(c) + 1 for c in every])]))


def _blocks(bins: Bins):
    zero = bins.zero()

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                y, i, x = b.column(0), b.column(1), b.column(2)
                if y.null_count or i.null_count:
                    raise ValueError("a label or a vector is NULL")
                feature = i.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                place = bins.of(feature, x.flatten().to_numpy(zero_copy_only=False))
                row = np.repeat(np.arange(b.num_rows), i.value_lengths().to_numpy(zero_copy_only=False))
                kept = place != zero[feature]
                block = row[kept].astype(np.int32), place[kept].astype(np.int32), y.to_numpy(zero_copy_only=False).copy()
                yield pa.RecordBatch.from_pydict({"block": pa.array([pickle.dumps(block)], pa.binary())})

    return pack


def reached(block: tuple, tree: tuple, feature_of: np.ndarray, zero: np.ndarray) -> np.ndarray:
    """The node of every row, down from the root."""
    (row, place, y), feature = block[:3], tree[0]
    node = np.zeros(len(y), dtype=np.int64)
    entry = feature_of[place]
    while (feature[node] >= 0).any():
        node = _below(node, row, place, entry, tree, zero)
    return node


def _below(node: np.ndarray, row: np.ndarray, place: np.ndarray, entry: np.ndarray, tree: tuple, zero: np.ndarray) -> np.ndarray:
    """The child of its node that each row belongs to; in a leaf a row stays."""
    feature, cut, left = tree
    asked = feature[node]
    at = zero[asked]
    hit = entry == asked[row]
    at[row[hit]] = place[hit]
    return np.where(asked >= 0, left[node] + (at > cut[node]), node)


def _summed(keys: np.ndarray, weights: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different keys and the sums of their weights, one column for each row of `weights`."""
    if room <= 4 * len(keys) + 1_000_000:
        there = np.flatnonzero(np.bincount(keys, minlength=room))
        return there, np.stack([np.bincount(keys, w, minlength=room)[there] for w in weights], 1)
    there, back = np.unique(keys, return_inverse=True)
    return there, np.stack([np.bincount(back, w, minlength=len(there)) for w in weights], 1)


@dataclass(frozen=True)
class Learner:
    """What the tasks of a fit need."""

    bins: Bins
    classes: int  # 0: a number is learnt
    least_rows: int
    least_gain: float
    columns: int  # features that a node may look at
    seed: int
    binary: np.ndarray  # features that are named as such: the value whose rows say less is the left one

    def weights(self, y: np.ndarray) -> np.ndarray:
        """What a row adds to the sums, a row of this array for each of them."""
        return np.eye(self.classes)[:, y.astype(int)] if self.classes else np.stack([np.ones(len(y)), y, y * y])

    def level(self, blocks: RDD, shared, tree: Tree, nodes: list[int], turn: int, target, drawn, split: bool = True) -> list:
        """(node, sums, gain, feature, bin, sums of the left) of the nodes; without `split` just the sums."""
        active = np.full(len(tree.feature), -1)
        active[nodes] = np.arange(len(nodes))
        packed, width, names = tree.packed(), self.bins.count + 1, [tree.name[n] for n in nodes]
        tasks = max(1, min(blocks.getNumPartitions(), -(-len(nodes) // NODES_PER_TASK)))
        per = -(-len(nodes) // tasks)

        def sums(part: int, rows: Iterable[tuple]) -> Iterator[tuple]:
            me, feature_of, zero = shared.value
            keys, weights = [], []
            for number, block in enumerate(rows):
                slot = active[reached(block, packed, feature_of, zero)]
                slot[~drawn(part, number, len(slot))] = -1
                w = me.weights(target(block))
                here = slot >= 0
                keys.append(slot[here] * width + width - 1)
                weights.append(w[:, here])
                if split:
                    row, place = block[0], block[1]
                    kept = here[row]
                    keys.append(slot[row[kept]] * width + place[kept])
                    weights.append(w.take(row[kept], 1))
            if keys:
                there, total = _summed(np.concatenate(keys), np.concatenate(weights, 1), len(nodes) * width)
                ends = np.searchsorted(there, np.arange(tasks + 1) * per * width)
                for task, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
                    if b > a:
                        yield task, (part, there[a:b], total[a:b])

        def best(parts: Iterable[tuple]) -> Iterator[tuple]:
            parts = sorted((p for _, p in parts), key=lambda p: p[0])  # sums do not depend on who came first
            if parts:
                keys, weights = np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
                yield from shared.value[0].best(keys, weights, nodes, names, turn, split)

        found = blocks.mapPartitionsWithIndex(sums)
        if len(nodes) <= FEW_NODES and len(nodes) * width * blocks.getNumPartitions() <= FEW_SUMS:
            return list(best(found.collect()))
        return found.partitionBy(tasks, int).mapPartitions(best).collect()

    def best(self, keys: np.ndarray, weights: np.ndarray, nodes: list[int], names: list[int], turn: int, split: bool = True) -> Iterator[tuple]:
        """What `level` gives of its nodes, from sums by slot, the node's number in `nodes`, and bin."""
        width = self.bins.count + 1
        slots = keys // width
        order = np.argsort(slots, kind="stable")
        keys, weights, slots = keys[order], weights[order], slots[order]
        for a in range(int(slots[0]), int(slots[-1]) + 1, OPEN_NODES):
            b = min(a + OPEN_NODES, int(slots[-1]) + 1)
            lo, hi = np.searchsorted(slots, [a, b])
            dense = np.stack([np.bincount(keys[lo:hi] - a * width, w, minlength=(b - a) * width)
                              for w in weights[lo:hi].T], 1).reshape(b - a, width, -1)
            if split:
                yield from self.splits(nodes[a:b], names[a:b], dense, turn)
            else:
                yield from ((n, d[-1], 0.0, -1, -1, None) for n, d in zip(nodes[a:b], dense))

    def splits(self, nodes: list[int], names: list[int], dense: np.ndarray, turn: int) -> Iterator[tuple]:
        """The best split of each node from the sums of its stored bins."""
        bins, first = self.bins, self.bins.first_cut()
        total, size = dense[:, -1], len(self.bins.start) - 1
        rest = total[:, None] - np.add.reduceat(dense[:, :-1], bins.start[:-1], axis=1)
        rest[(rest.sum(-1) if self.classes else rest[..., 0]) <= 0] = 0.0
        dense[:, bins.zero()] += rest
        left = np.empty((len(nodes), len(bins.cuts), dense.shape[2]))
        lengths = np.diff(first)
        for length in np.unique(lengths[lengths > 0]):
            alike = np.flatnonzero(lengths == length)
            steps = np.arange(length)
            left[:, first[alike][:, None] + steps] = dense[:, bins.start[alike][:, None] + steps].cumsum(2)
        (n, whole), (nl, below), (nr, above) = (impurity(s, bool(self.classes)) for s in (total, left, total[:, None] - left))
        n, whole = n[:, None], whole[:, None]
        parts = nl / n * below, nr / n * above
        gain = whole - parts[0] - parts[1]
        feature_of_cut = np.repeat(np.arange(size), lengths)
        if self.classes == 2:  # gains of classes are exact, and the order of a difference decides between equal ones
            turned = self.binary[feature_of_cut] & (np.argmax(left, -1) > np.argmax(total[:, None] - left, -1))
            gain = np.where(turned, whole - parts[1] - parts[0], gain)
        gain[(np.minimum(nl, nr) < self.least_rows) | (gain < self.least_gain)] = -np.inf
        for k, node in enumerate(nodes):
            if self.columns < size:
                seen = np.zeros(size, dtype=bool)
                seen[np.random.default_rng((self.seed, turn, names[k])).permutation(size)[: self.columns]] = True
                gain[k, ~seen[feature_of_cut]] = -np.inf
            even = 0.0 if self.classes else EVEN * whole[k, 0]
            if not gain.shape[1] or not varied(total[k], bool(self.classes)) or (most := gain[k].max()) <= even:
                yield node, total[k], 0.0, -1, -1, None
            else:
                at = int(np.argmax(gain[k] >= most - even))
                yield node, total[k], float(gain[k, at]), int(feature_of_cut[at]), int(at + feature_of_cut[at]), left[k, at]

    def grown(self, blocks: RDD, shared, depth: int, turn: int = 0, target=lambda block: block[2],
              drawn=lambda part, number, n: np.ones(n, dtype=bool), last: bool = False) -> Tree:
        """A tree, level by level. `last`: the sums of leaves are taken from their rows, not from their parents' split."""
        tree, level = Tree(), 0
        nodes, small = [tree.add(None)], []
        while nodes and level < max(depth, 1):
            after = []
            for node, stats, gain, feature, cut, left in sorted(self.level(blocks, shared, tree, nodes, turn, target, drawn, depth > 0)):
                tree.stats[node] = stats
                if feature >= 0:
                    for child in tree.split(node, gain, feature, cut, stats, left):
                        if level + 1 < depth and varied(tree.stats[child], bool(self.classes)):
                            n = impurity(tree.stats[child], bool(self.classes))[0]
                            (after if n > SUBTREE_ROWS else small).append(child)
            nodes, level = after, level + 1
        if tree.stats[0] is None:
            raise ValueError("no rows to fit")
        leaves = sorted({k for k, f in enumerate(tree.feature) if f < 0 and k} - set(small)) if last else []
        if leaves:
            for node, stats, *_ in self.level(blocks, shared, tree, leaves, turn, target, drawn, split=False):
                tree.stats[node] = stats
        if small:
            for roots, grown in self.subtrees(blocks, shared, tree, small, depth, turn, target, drawn, last):
                tree.graft(roots, grown)
        return tree

    def subtrees(self, blocks: RDD, shared, tree: Tree, nodes: list[int], depth: int, turn: int, target, drawn, last: bool) -> list:
        """(nodes, tree with them as its first nodes), one for each task: the rows of a node meet in one task, which grows
        all that is below it. Nodes are dealt so that tasks have about as many rows."""
        tasks = min(len(nodes), blocks.getNumPartitions())
        dealt, load = [[] for _ in range(tasks)], [(0.0, k) for k in range(tasks)]
        for n, node in sorted(((-float(impurity(tree.stats[n], bool(self.classes))[0]), n) for n in nodes)):
            held, k = heapq.heappop(load)
            dealt[k].append(node)
            heapq.heappush(load, (held - n, k))
        task_of, slot_of = np.full(len(tree.feature), -1), np.full(len(tree.feature), -1)
        for k, mine in enumerate(dealt):
            task_of[mine], slot_of[mine] = k, np.arange(len(mine))
        packed = tree.packed()
        begun = [[(tree.stats[n], tree.name[n]) for n in mine] for mine in dealt]

        def sent(part: int, rows: Iterable[tuple]) -> Iterator[tuple]:
            _, feature_of, zero = shared.value
            for number, block in enumerate(rows):
                node = reached(block, packed, feature_of, zero)
                task = task_of[node]
                task[~drawn(part, number, len(task))] = -1
                order = np.argsort(task, kind="stable")
                ends = np.searchsorted(task[order], np.arange(tasks + 1))
                to = np.empty(len(order), dtype=np.int32)
                to[order] = np.arange(len(order))
                row, place = to[block[0]], block[1]
                entries = np.argsort(row, kind="stable")
                row, place = row[entries], place[entries]
                between = np.searchsorted(row, ends)
                slot, y = slot_of[node][order].astype(np.int32), target(block)[order]
                for k in range(tasks):
                    (a, b), (c, d) = ends[k:k + 2], between[k:k + 2]
                    if b > a:
                        yield k, (part, number, slot[a:b].copy(), y[a:b].copy(), (row[c:d] - a).astype(np.int32), place[c:d].copy())

        def grow(k: int, parts: Iterable[tuple]) -> Iterator[tuple]:
            parts = sorted((p for _, p in parts), key=lambda p: p[:2])
            if parts:
                yield dealt[k], shared.value[0].forest(begun[k], parts, depth, turn, last, *shared.value[1:])

        return blocks.mapPartitionsWithIndex(sent).partitionBy(tasks, int).mapPartitionsWithIndex(grow).collect()

    def forest(self, begun: list[tuple], parts: list[tuple], depth: int, turn: int, last: bool, feature_of: np.ndarray, zero: np.ndarray) -> Tree:
        """The trees below some nodes, from all of their rows. `begun`: (sums, name) of the nodes."""
        tree, width = Tree(), self.bins.count + 1
        nodes = [tree.add(*b) for b in begun]
        node, y = (np.concatenate([p[k] for p in parts]) for k in (2, 3))
        first = np.cumsum([0] + [len(p[2]) for p in parts])
        row, place = np.concatenate([p[4] + f for p, f in zip(parts, first)]), np.concatenate([p[5] for p in parts])
        node, weights, entry = node.astype(np.int64), self.weights(y), feature_of[place]
        while nodes:
            active = np.full(len(tree.feature), -1)
            active[nodes] = np.arange(len(nodes))
            slot = active[node]
            begin = slot * width
            there, total = _summed(np.concatenate([begin + (width - 1), begin[row] + place]),
                                   np.concatenate([weights, weights.take(row, 1)], 1), len(nodes) * width)
            after = []
            for n, stats, gain, feature, cut, left in self.best(there, total, nodes, [tree.name[n] for n in nodes], turn):
                tree.stats[n] = stats
                if feature >= 0:
                    for child in tree.split(n, gain, feature, cut, stats, left):
                        # A full tree has level d from the name 2^d - 1 on.
                        if (tree.name[child] + 1).bit_length() <= depth and varied(tree.stats[child], bool(self.classes)):
                            after.append(child)
            node = _below(node, row, place, entry, tree.packed(), zero)
            goes = np.zeros(len(tree.feature), dtype=bool)
            goes[after] = True
            goes = goes[node]
            if last:
                ended, back = np.unique(node[~goes], return_inverse=True)
                sums = np.stack([np.bincount(back, w, minlength=len(ended)) for w in weights[:, ~goes]], 1)
                for n, stats in zip(ended.tolist(), sums):
                    tree.stats[n] = stats
            if not goes.all():
                to, kept = np.cumsum(goes) - 1, goes[row]
                node, weights, row, place, entry = node[goes], weights[:, goes], to[row[kept]], place[kept], entry[kept]
            nodes = after
        return tree

    def said(self, stats: np.ndarray) -> float:
        return float(np.argmax(stats)) if self.classes else float(stats[1] / max(stats[0], 1))

    def rows(self, tree: Tree, middle: float = 0.0) -> list[tuple]:
        """The nodes as a saved model has them, in the order of a walk; leaves that say the same are merged. `middle` was
        taken from the numbers before they were learnt."""
        out = []

        def walk(node: int) -> tuple[int, int, float, bool]:
            me, stats = len(out), tree.stats[node]
            out.append(None)
            n, spread = impurity(stats, bool(self.classes))
            said = self.said(stats) + middle
            kept = stats if self.classes else np.array([n, stats[1] + n * middle, stats[2] + 2 * middle * stats[1] + n * middle ** 2])
            leaf = (said, max(float(spread), 0.0), [float(s) for s in kept], int(n))
            if tree.feature[node] >= 0:
                a, says_a, leaf_a = walk(tree.left[node])
                b, says_b, leaf_b = walk(tree.left[node] + 1)
                if not (leaf_a and leaf_b and says_a == says_b):
                    f = tree.feature[node]
                    cut = float(self.bins.cuts[tree.bin[node] - f])
                    out[me] = (me, *leaf, tree.gain[node], a, b, (f, [cut], -1))
                    return me, said, False
                del out[me + 1:]
            out[me] = (me, *leaf, -1.0, -1, -1, (-1, [], -1))
            return me, said, True

        walk(0)
        return out


class Table:
    """All rows of a fit in one task, for boosted rounds: bins by row in columns, rows of about as many stored values
    together, some at a time.

    A level passes over the rows of the smaller child of each split only; the sums of the larger one are those of its
    parent less these.
    """

    def __init__(self, learner: Learner, parts: Iterable[tuple]):
        """`parts`: (partition, number, block), in this order."""
        self.learner, self.bins = learner, learner.bins
        self.width, self.zero = self.bins.count + 1, self.bins.zero()
        self.feature_of_cut = np.repeat(np.arange(len(self.bins.start) - 1), np.diff(self.bins.first_cut()))
        self.lengths = np.diff(self.bins.first_cut())
        self.sizes, self.chunks, self.order = [], [], []
        labels, some, n, values = [], [], 0, 0
        for part, number, block in parts:
            self.sizes.append((part, number, len(block[2])))
            labels.append(block[2])
            some.append(block)
            values += max(len(block[0]), len(block[2]))
            if values >= CHUNK_VALUES:
                n, some, values = self._packed(some, n), [], 0
        n = self._packed(some, n)
        self.order = np.concatenate(self.order) if self.order else np.empty(0, dtype=np.int64)
        self.y = np.concatenate(labels)[self.order] if labels else np.empty(0)

    def _packed(self, blocks: list[tuple], n: int) -> int:
        if not blocks:
            return n
        first = np.cumsum([0] + [len(b[2]) for b in blocks])
        row, place = np.concatenate([b[0] + f for b, f in zip(blocks, first)]), np.concatenate([b[1] for b in blocks])
        held = np.bincount(row, minlength=first[-1])
        begin = np.cumsum(held) - held
        nth = np.arange(len(row)) - begin[row]
        # A power of two of places for each row: no more than twice what it stores.
        room = np.maximum(held, 1)
        room = 1 << np.ceil(np.log2(room)).astype(np.int64)
        a = n
        for k in np.unique(room):
            mine = np.flatnonzero(room == k)
            to = np.full(first[-1], -1)
            to[mine] = np.arange(len(mine))
            here = to[row] >= 0
            bins = np.full((int(k), len(mine)), self.width - 1, dtype=np.int32)
            bins[nth[here], to[row[here]]] = place[here]
            self.chunks.append((a, a + len(mine), bins))
            self.order.append(mine + n)
            a += len(mine)
        return a

    def drawn(self, share: float, turn: int) -> np.ndarray | None:
        """Which rows a round learns from; None: all."""
        if share >= 1:
            return None
        return np.concatenate([np.random.default_rng((self.learner.seed, turn, part, number)).random(n) < share
                               for part, number, n in self.sizes])[self.order]

    def sums(self, slot_of: np.ndarray, slots: int, node: np.ndarray, target: np.ndarray, drawn: np.ndarray | None) -> np.ndarray:
        """(rows, sum of the target) by slot of the node and bin."""
        counts, sums = np.zeros(slots * self.width), np.zeros(slots * self.width)
        for a, b, bins in self.chunks:
            slot = slot_of.take(node[a:b])
            here = np.flatnonzero(slot >= 0 if drawn is None else (slot >= 0) & drawn[a:b])
            if len(here):
                keys = (bins.take(here, 1) + slot.take(here) * self.width).ravel()
                counts += np.bincount(keys, minlength=len(counts))
                sums += np.bincount(keys, np.tile(target[a:b].take(here), len(bins)), len(sums))
        return np.stack([counts, sums]).reshape(2, slots, self.width)[:, :, :-1]

    def below(self, node: np.ndarray, tree: Tree, first: int) -> np.ndarray:
        """The child of its node that each row belongs to. Nodes before `first` are settled."""
        split = [k for k in range(first, len(tree.feature)) if tree.feature[k] >= 0]
        low, long = np.zeros(len(tree.feature), dtype=np.uint32), np.zeros(len(tree.feature), dtype=np.uint32)
        turned, child = np.zeros(len(tree.feature), dtype=bool), np.arange(len(tree.feature))
        for k in split:
            f, cut = tree.feature[k], tree.bin[k]
            # A row whose zero goes right goes left by a stored bin up to the cut, any other one right by one beyond it.
            turned[k] = self.zero[f] > cut
            begin, end = (self.bins.start[f], cut + 1) if turned[k] else (cut + 1, self.bins.start[f + 1])
            low[k], long[k], child[k] = begin, end - begin, tree.left[k]
        out = np.empty_like(node)
        for a, b, bins in self.chunks:
            at = node[a:b]
            begin, length, right = low.take(at), long.take(at), turned.take(at)
            off, hit = np.empty_like(begin), np.empty_like(right)
            for column in bins.view(np.uint32):
                np.less(np.subtract(column, begin, out=off), length, out=hit)
                right ^= hit  # a row has one bin of a feature
            np.add(child.take(at), right, out=out[a:b])
        return out

    def best(self, held: np.ndarray, stats: np.ndarray, names: list[int], turn: int) -> list[tuple]:
        """(gain, feature, bin) of the best split of each node, the feature -1 for none. `held`: as `sums` gives them."""
        bins, first, me = self.bins, self.bins.first_cut(), self.learner
        size = len(bins.start) - 1
        n, total = stats[:, 0], stats[:, 1]
        whole = impurity(stats, False)[1]
        if not len(bins.cuts):
            return [(0.0, -1, -1)] * len(names)
        held = held * (held[0] > 0)  # what rounding leaves of a difference where no row is
        rest = np.stack([n, total])[:, :, None] - np.add.reduceat(held, bins.start[:-1], axis=2)
        held[:, :, self.zero] = rest * (rest[0] > 0)  # no stored bin is that of zero
        left = np.empty((2, len(names), len(bins.cuts)))
        for length in np.unique(self.lengths[self.lengths > 0]):
            alike = np.flatnonzero(self.lengths == length)
            if length == 1:
                left[:, :, first[alike]] = held[:, :, bins.start[alike]]
            else:
                steps = np.arange(length)
                left[:, :, first[alike][:, None] + steps] = held[:, :, bins.start[alike][:, None] + steps].cumsum(3)
        nl, sl = left
        nr = n[:, None] - nl
        # The impurity of the node less those of its children, by their shares of the rows.
        product = nl * nr
        gain = sl - nl * (total / np.maximum(n, 1))[:, None]
        gain *= gain
        gain /= np.maximum(product, 1, out=product)
        np.copyto(gain, -np.inf, where=(nl < me.least_rows) | (nr < me.least_rows) | (gain < me.least_gain))
        out = []
        for k, name in enumerate(names):
            if me.columns < size:
                unseen = np.ones(size, dtype=bool)
                unseen[np.random.default_rng((me.seed, turn, name)).permutation(size)[: me.columns]] = False
                np.copyto(gain[k], -np.inf, where=unseen.take(self.feature_of_cut))
            most, even = gain[k].max(), EVEN * whole[k]
            if not varied(stats[k], False) or most <= even:
                out.append((0.0, -1, -1))
            else:
                at = int(np.argmax(gain[k] >= most - even))
                out.append((float(gain[k, at]), int(self.feature_of_cut[at]), int(at + self.feature_of_cut[at])))
        return out

    def grown(self, depth: int, turn: int, target: np.ndarray, drawn: np.ndarray | None) -> tuple[Tree, np.ndarray]:
        """A tree of the rows drawn, and the leaf that each row is in, drawn or not."""
        tree, node = Tree(), np.zeros(len(target), dtype=np.int64)
        here = slice(None) if drawn is None else np.flatnonzero(drawn)
        learnt = target[here]
        squares = learnt * learnt
        root = np.array([len(learnt), learnt.sum(), squares.sum()])
        if not root[0]:
            raise ValueError("no rows to fit")
        tree.add(root)
        nodes, first = [0], 0
        held = self.sums(np.zeros(1, dtype=np.int64), 1, node, target, drawn) if depth else None
        for level in range(depth):
            stats = np.array([tree.stats[k] for k in nodes])
            found = self.best(held, stats, [tree.name[k] for k in nodes], turn)
            parents = []
            for slot, (k, (gain, feature, cut)) in enumerate(zip(nodes, found)):
                if feature >= 0:
                    tree.split(k, gain, feature, cut, stats[slot], stats[slot])  # the sums of the children follow
                    parents.append((slot, k))
            if not parents:
                break
            node = self.below(node, tree, first)
            first = tree.left[parents[0][1]]
            at = node[here]
            each = np.stack([np.bincount(at, w, len(tree.feature)) for w in (None, learnt, squares)], 1)
            goes = np.zeros(len(tree.feature), dtype=bool)
            for _, k in parents:
                for child in (tree.left[k], tree.left[k] + 1):
                    tree.stats[child] = each[child]
                    goes[child] = level + 1 < depth and varied(each[child], False)
            slot_of, passed = np.full(len(tree.feature), -1), []
            for slot, k in parents:
                a, b = tree.left[k], tree.left[k] + 1
                if goes[a] or goes[b]:
                    few, many = (a, b) if each[a, 0] <= each[b, 0] else (b, a)
                    slot_of[few] = len(passed)
                    passed.append((slot, few, many))
            if not passed:
                break
            less = self.sums(slot_of, len(passed), node, target, drawn)
            more = held[:, [slot for slot, *_ in passed]] - less
            kept = [(child, sums[:, k]) for k, (_, few, many) in enumerate(passed) for child, sums in ((few, less), (many, more)) if goes[child]]
            nodes, held = [child for child, _ in kept], np.stack([s for _, s in kept], 1)
        return tree, node

    def rounds(self, rounds: int, depth: int, step: float, share: float, classify: bool) -> Iterator[list[tuple]]:
        """The nodes of the tree of each round, as a saved model has them."""
        said = None
        for turn in range(rounds):
            tree, node = self.grown(depth, turn, slope(self.y, said, classify), self.drawn(share, turn))
            leaves = np.array([self.learner.said(s) for s in tree.stats]) * (step if turn else 1.0)
            said = leaves[node] if said is None else said + leaves[node]
            yield self.learner.rows(tree)


def slope(y: np.ndarray, said: np.ndarray | None, classify: bool) -> np.ndarray:
    """What a round learns: the label, later on the slope of the loss."""
    if said is None:
        return y
    return 4 * y / (1 + np.exp(2 * y * said)) if classify else 2 * (y - said)


NODE = ("id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, gain: double, leftChild: int, "
        "rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>")


def _note(estimator, kind: str, **more) -> str:
    named = lambda params: {p.name: v for p, v in params.items()}
    return json.dumps({"class": f"org.apache.spark.ml.{kind}", "timestamp": int(time.time() * 1000),
                       "sparkVersion": SparkSession.active().version, "uid": estimator.uid, "paramMap": named(estimator._paramMap),
                       "defaultParamMap": named(estimator._defaultParamMap), **more})


def _model(estimator, model, trees: list[list[tuple]], weights: list[float] | None, spark: SparkSession, **more):
    """A model of Spark's own, from its saved form."""
    path, kind = scratch(spark, "trees"), f"{model.__module__.split('.')[-1]}.{model.__name__}"
    table = lambda rows, schema, name: spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/{name}")
    if weights is None:
        table(trees[0], f"struct<{NODE}>", "data")
    else:
        table([(k, row) for k, rows in enumerate(trees) for row in rows], f"treeID int, nodeData struct<{NODE}>", "data")
        tree = {p.name: v for p, v in {**estimator._defaultParamMap, **estimator._paramMap}.items()
                if regression.DecisionTreeRegressor().hasParam(p.name)}
        one = json.loads(_note(estimator, "regression.DecisionTreeRegressionModel"))
        notes = [json.dumps({**one, "uid": f"{estimator.uid}_{k}", "paramMap": {}, "defaultParamMap": tree}) for k in range(len(trees))]
        table([(k, note, w) for k, (note, w) in enumerate(zip(notes, weights))], "_1 int, _2 string, _3 double", "treesMetadata")
        more["numTrees"] = len(trees)
    spark.createDataFrame([(_note(estimator, kind, **more),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    return estimator._copyValues(model.load(path))


class _Sparse:
    """Fits by the sums of stored values. Weighted rows, validation rows and other losses, and features of more than two unordered values, go the way of
    Spark's own fit."""

    def _usual(self, df: DataFrame) -> bool:
        unset = lambda name: not self.hasParam(name) or not self.isSet(name)
        strategy = self.getOrDefault("featureSubsetStrategy") if self.hasParam("featureSubsetStrategy") else "all"
        share = strategy if strategy in ("all", "auto") else _number(strategy)
        if any(len(a.get("vals", ())) != 2 and a.get("num_vals") != 2 for a in _attributes(df, self.getFeaturesCol()).get("nominal", ())):
            return False  # features of several unordered values
        return (unset("weightCol") and unset("validationIndicatorCol") and self.getMinWeightFractionPerNode() == 0 and share is not None
                and self.getOrDefault("impurity") in ("gini", "variance")
                and (not self.hasParam("lossType") or self.getOrDefault("lossType") in ("squared", "logistic")))

    def _columns(self, size: int) -> int:
        strategy = self.getOrDefault("featureSubsetStrategy") if self.hasParam("featureSubsetStrategy") else "all"
        if strategy in ("all", "auto"):
            return size
        return min(size, math.ceil(_number(strategy) * size) if "." in strategy else int(strategy))

    def _prepared(self, df: DataFrame, classes: bool) -> tuple:
        """(learner, blocks, what tasks share, vector size, mean of the labels, stored values)"""
        spark = df.sparkSession
        importable(spark)
        stored = _stored(df, self.getFeaturesCol(), self.getLabelCol())
        rows, size, most, least, mean, whole, values = stored.agg(
            F.count(F.lit(1)), F.max("size"), F.max("y"), F.min("y"), F.avg("y"), F.bool_and(F.col("y") == F.floor("y")),
            F.sum(F.greatest(F.size("x"), F.lit(1)).cast("bigint"))).first()
        if not rows:
            raise ValueError("no rows to fit")
        if classes and not (whole and least >= 0):
            raise ValueError("classes are whole numbers from 0 on")
        seed = self.getSeed()
        named = _attributes(df, self.getFeaturesCol())
        binary = np.zeros(size, dtype=bool)
        binary[[a["idx"] for kind in ("binary", "nominal") for a in named.get(kind, ())]] = True
        bins = binned(stored, rows, size, self.getMaxBins(), seed)
        learner = Learner(bins, int(most) + 1 if classes else 0, self.getMinInstancesPerNode(), self.getMinInfoGain(), self._columns(size),
                          abs(seed), binary)
        most_tasks = max(spark.sparkContext.defaultParallelism, -(-rows // ROWS_PER_TASK))
        blocks = stored.mapInArrow(_blocks(bins), "block binary").rdd.map(lambda r: pickle.loads(r[0])).coalesce(most_tasks).persist(
            StorageLevel.MEMORY_AND_DISK)
        return learner, blocks, spark.sparkContext.broadcast((learner, bins.feature_of(), bins.zero())), size, mean, values


def _attributes(df: DataFrame, features: str) -> dict:
    """What the vector column says of its places, by kind."""
    return df.schema[features].metadata.get("ml_attr", {}).get("attrs", {})


def _number(text: str) -> float | None:
    try:
        return float(text) if float(text) > 0 else None
    except ValueError:
        return None


class _SparseTree(_Sparse):
    def _fit(self, df: DataFrame):
        if not self._usual(df):
            return super()._fit(df)
        classify = isinstance(self, classification.DecisionTreeClassifier)
        learner, blocks, shared, size, mean, _ = self._prepared(df, classify)
        try:
            # Numbers are learnt as distances from their mean, whose squares are small enough to be added up.
            middle = 0.0 if classify else mean
            tree = learner.grown(blocks, shared, self.getMaxDepth(), target=lambda block: block[2] - middle, last=True)
        finally:
            blocks.unpersist()
        rows = learner.rows(tree, middle)
        model = classification.DecisionTreeClassificationModel if classify else regression.DecisionTreeRegressionModel
        return _model(self, model, [rows], None, df.sparkSession, numFeatures=size, **({"numClasses": learner.classes} if classify else {}))


class DecisionTreeClassifier(_SparseTree, classification.DecisionTreeClassifier):
    pass


class DecisionTreeRegressor(_SparseTree, regression.DecisionTreeRegressor):
    pass


class _SparseBoosting(_Sparse):
    """The first tree learns the label, each further one the slope of the loss; rows and features are drawn by the seed, so
    the draws, though not their shares, differ from those of Spark's own fit."""

    def _fit(self, df: DataFrame):
        if not self._usual(df):
            return super()._fit(df)
        classify = isinstance(self, classification.GBTClassifier)
        learned = df.withColumn(self.getLabelCol(), 2.0 * F.col(self.getLabelCol()) - 1) if classify else df
        learner, blocks, shared, size, _, values = self._prepared(learned, False)
        rounds, depth, step = self.getMaxIter(), self.getMaxDepth(), self.getStepSize()
        if values <= ROUNDS_VALUES and (learner.bins.count + 1) << max(depth - 1, 0) <= OPEN_SUMS:
            trees = self._at_once(learner, blocks, shared, rounds, depth, step, classify)
        else:
            trees = self._by_rounds(learner, blocks, shared, rounds, depth, step, classify, df.sparkSession)
        model = classification.GBTClassificationModel if classify else regression.GBTRegressionModel
        return _model(self, model, trees, [step if k else 1.0 for k in range(rounds)], df.sparkSession, numFeatures=size)

    def _at_once(self, learner: Learner, blocks: RDD, shared, rounds: int, depth: int, step: float, classify: bool) -> list:
        """All rounds in one task, to which the rows are sent once."""
        share = self.getSubsamplingRate()

        def sent(part: int, rows: Iterable[tuple]) -> Iterator[tuple]:
            yield from ((0, (part, number, block)) for number, block in enumerate(rows))

        def fitted(parts: Iterable[tuple]) -> Iterator[list[tuple]]:
            parts = sorted((p for _, p in parts), key=lambda p: p[:2])
            yield from Table(shared.value[0], parts).rounds(rounds, depth, step, share, classify)

        try:
            return blocks.mapPartitionsWithIndex(sent).partitionBy(1, int).mapPartitions(fitted).collect()
        finally:
            blocks.unpersist()

    def _by_rounds(self, learner: Learner, blocks: RDD, shared, rounds: int, depth: int, step: float, classify: bool,
                   spark: SparkSession) -> list:
        """Jobs for each round."""
        context, share, seed, every = blocks.context, self.getSubsamplingRate(), learner.seed, self.getCheckpointInterval()
        if every > 0 and not context.getCheckpointDir():
            context.setCheckpointDir(scratch(spark, "boosting"))

        def target(block: tuple) -> np.ndarray:
            return slope(block[2], block[3] if len(block) > 3 else None, classify)

        trees, held = [], [blocks]
        try:
            for turn in range(rounds):
                def drawn(part: int, number: int, n: int, turn=turn) -> np.ndarray:
                    return np.ones(n, dtype=bool) if share >= 1 else np.random.default_rng((seed, turn, part, number)).random(n) < share

                tree = learner.grown(held[-1], shared, depth, turn, target, drawn)
                trees.append(learner.rows(tree))
                packed = tree.packed()
                leaves = np.array([learner.said(s) for s in tree.stats]) * (step if turn else 1.0)

                def said(block: tuple, packed=packed, leaves=leaves) -> tuple:
                    _, feature_of, zero = shared.value
                    more = leaves[reached(block, packed, feature_of, zero)]
                    return (*block[:3], more if len(block) == 3 else block[3] + more)

                held.append(held[-1].map(said).persist(StorageLevel.MEMORY_AND_DISK))
                if every > 0 and (turn + 1) % every == 0:
                    held[-1].checkpoint()
                if len(held) > 3:  # the round before the last is the source of the last one
                    held.pop(0).unpersist()
        finally:
            for rows in held:
                rows.unpersist()
        return trees


class GBTClassifier(_SparseBoosting, classification.GBTClassifier):
    pass


class GBTRegressor(_SparseBoosting, regression.GBTRegressor):
    pass
