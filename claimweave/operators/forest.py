"""Random forests over tables of many rows.

Spark ML keeps each row as an object with a count for every tree, and reads these for each level of the trees. Here rows are brought
to bins once and stored in blocks of columns, a byte for a feature. A level of all trees is one scan: tasks add up weights and
labels by tree, node, feature and bin, and the sums of a tree meet in one group, which chooses its splits. What a task holds and
what reaches the driver grows with trees, nodes, features and bins, not with rows.

Nodes are numbered as in a heap: 0 is the root, 2 i + 1 and 2 i + 2 are the children of i. A node without a split sends all rows
left, to a child of its own value, so that every row's way is as long as the trees are deep.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage

BINS = 32  # of a feature
BLOCK = 32_768  # rows of a block
SHARE = 2_000_000  # most rows a task reads
SUMS = 64 << 20  # bytes of sums a task holds: a level with more is scanned for some trees after the others
STAY = 255  # above all bins: every row goes left

# Poisson draws of mean 1 by 16 random bits: how often a tree takes a row, in a bootstrap of as many rows as there are.
POISSON = np.searchsorted(np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)]) * 65536, np.arange(65536), "right").astype(np.uint8)


@dataclass
class Forest:
    """``feature``, ``cut``, ``value`` and ``gain`` by tree and node; bins up to ``cut`` go left."""

    cuts: list[np.ndarray]
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    depth: int

    def importances(self) -> np.ndarray:
        """Each tree's gains by feature as shares, their mean over the trees that have splits."""
        found = np.stack([np.bincount(f, g, len(self.cuts)) for f, g in zip(self.feature, self.gain)])
        total = found.sum(axis=1, keepdims=True)
        mean = (found / np.where(total > 0, total, 1)).sum(axis=0)
        return mean / (mean.sum() or 1)

    def prediction(self, features: Sequence[str]) -> Column:
        """Mean of the trees' values."""

        def predict(*columns: pd.Series) -> pd.Series:
            bins = binned(self.cuts, [c.to_numpy() for c in columns])
            rows = np.arange(len(columns[0]))
            total = np.zeros(len(rows))
            for feature, cut, value in zip(self.feature, self.cut, self.value):
                total += value[walk(bins, rows, feature, cut, self.depth)]
            return pd.Series(total / len(self.value))

        return F.pandas_udf(predict, "double")(*[filled(c) for c in features])


def filled(name: str) -> Column:
    return F.coalesce(F.col(name).cast("double"), F.lit(0.0))


def binned(cuts: Sequence[np.ndarray], columns: Sequence[np.ndarray]) -> np.ndarray:
    """A value's bin is the number of cuts below it."""
    return np.stack([np.searchsorted(c, v) for c, v in zip(cuts, columns)]).astype(np.uint8)


def walk(bins: np.ndarray, rows: np.ndarray, feature: np.ndarray, cut: np.ndarray, depth: int) -> np.ndarray:
    """The node of each row at a depth."""
    node = np.zeros(len(rows), np.int64)
    for _ in range(depth):
        right = picked(bins, feature, node, rows) > cut.take(node, mode="clip")
        node *= 2
        node += 1
        node += right
    return node


def picked(bins: np.ndarray, feature: np.ndarray, node: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Each row's bin of the feature of its node."""
    place = (feature * bins.shape[1]).take(node, mode="clip")
    place += rows
    return bins.ravel().take(place, mode="clip")


def draws(seed: int, part: int, block: int, tree: int, rows: int) -> np.ndarray:
    return POISSON.take(np.random.default_rng([seed, part, block, tree]).integers(0, 65536, rows, np.uint16))


def parts(rows: DataFrame, count: int) -> int:
    """As many for each core, of ``SHARE`` rows at most."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return cores * max(1, -(-count // (cores * SHARE)))


def cut_points(rows: DataFrame, features: Sequence[str]) -> list[np.ndarray]:
    """Cuts between all values of a feature where these are few, else at its quantiles."""
    few = {c: [r[0] for r in rows.select(c).distinct().limit(BINS + 1).collect()] for c in features}
    many = [c for c in features if len(few[c]) > BINS]
    shares = [i / BINS for i in range(1, BINS)]
    found = rows.agg(*[F.percentile_approx(c, shares, 10_000).alias(c) for c in many]).first() if many else {}
    middles = {c: (np.sort(few[c])[1:] + np.sort(few[c])[:-1]) / 2 for c in features if c not in many}
    return [np.unique(found[c]) if c in many else middles[c] for c in features]


def store_blocks(rows: DataFrame, count: int, cuts: Sequence[np.ndarray], label: str, features: Sequence[str], middle: float) -> DataFrame:
    """Blocks of bins and of labels less ``middle``, in even partitions."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held = TaskContext.get().partitionId(), 0, []

        def block() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            bins = binned(cuts, [table[c].to_numpy() for c in features])
            y = table[label].to_numpy() - middle
            return pa.RecordBatch.from_pydict({"part": [part], "block": [number], "bins": [bins.tobytes()], "y": [y.tobytes()]})

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= BLOCK:
                yield block()
                number, held = number + 1, []
        if sum(b.num_rows for b in held):
            yield block()

    even = rows.repartition(parts(rows, count))
    return cut_lineage(even.mapInArrow(pack, "part long, block long, bins binary, y binary"))


class Splits(NamedTuple):
    """Of each node: whether it has a split, the place of its feature, the last bin that goes left, what the split takes from the squared
    error, and the means of the node and its children."""

    found: np.ndarray
    place: np.ndarray
    cut: np.ndarray
    gain: np.ndarray
    value: np.ndarray
    low: np.ndarray
    high: np.ndarray


def best_splits(n: np.ndarray, s: np.ndarray, least: int = 1) -> Splits:
    """The best split of each node, from weights and labels added up by feature, node and bin; children weigh ``least`` or more."""
    nodes = n.shape[1]
    left_n, left_s = n.cumsum(axis=2), s.cumsum(axis=2)
    all_n, all_s = left_n[:, :, -1:], left_s[:, :, -1:]
    right_n, right_s = all_n - left_n, all_s - left_s
    with np.errstate(divide="ignore", invalid="ignore"):
        whole = all_s**2 / all_n
        gain = left_s**2 / left_n + right_s**2 / right_n - whole
        gain = np.where((left_n >= least) & (right_n >= least) & (gain > 1e-12 * whole), gain, -np.inf)
    # The best of a node's features and bins, the first of equal ones.
    best = gain.swapaxes(0, 1).reshape(nodes, -1).argmax(axis=1)
    node, j, b = np.arange(nodes), best // BINS, best % BINS

    def mean(total: np.ndarray, count: np.ndarray) -> np.ndarray:
        return total / np.maximum(count, 1)

    low, high = mean(left_s[j, node, b], left_n[j, node, b]), mean(right_s[j, node, b], right_n[j, node, b])
    return Splits(np.isfinite(gain[j, node, b]), j, b, gain[j, node, b], mean(all_s[0, :, 0], all_n[0, :, 0]), low, high)


def level_splits(
    blocks: DataFrame, forest: Forest, level: int, offered: np.ndarray, alive: np.ndarray, seed: int, some: Sequence[int]
) -> DataFrame:
    """The best split of each node of a level in ``some`` trees: ``tree``, ``node``, ``feature`` (null: none), ``cut``, ``gain`` and the values
    of the node and its children. ``offered``: the features of a node; ``alive``: whether it may be split."""
    _, nodes, k = offered.shape
    first, of, cuts = nodes - 1, forest.feature, forest.cut

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(some), k, 2, nodes * BINS))
        for batch in batches:
            for row in batch.to_pylist():
                y = np.frombuffer(row["y"])
                bins = np.frombuffer(row["bins"], np.uint8).reshape(-1, len(y))
                for i, t in enumerate(some):
                    taken = draws(seed, row["part"], row["block"], t, len(y))
                    at = np.flatnonzero(taken > 0)
                    w = taken.take(at).astype(float)
                    wy = w * y.take(at)
                    node = walk(bins, at, of[t], cuts[t], level) - first
                    for j in range(k):
                        cell = node * BINS + picked(bins, offered[t, :, j], node, at)
                        sums[i, j, 0] += np.bincount(cell, w, nodes * BINS)
                        sums[i, j, 1] += np.bincount(cell, wy, nodes * BINS)
        for i in np.flatnonzero(sums.any(axis=(1, 2, 3))):
            yield pa.RecordBatch.from_pydict({"tree": [some[i]], "sums": [sums[i].tobytes()]})

    def choose(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        t = int(key[0])
        n, s = sum(np.frombuffer(p) for p in parts["sums"]).reshape(k, 2, nodes, BINS).swapaxes(0, 1)
        best = best_splits(n, s)
        node, found = np.arange(nodes), best.found & alive[t]
        return pd.DataFrame({
            "tree": t, "node": first + node, "feature": pd.array(np.where(found, offered[t, node, best.place], -1)), "cut": best.cut,
            "gain": np.where(found, best.gain, 0.0), "value": best.value, "low": best.low, "high": best.high,
        })

    found = blocks.mapInArrow(add, "tree long, sums binary").groupBy("tree").applyInPandas(
        choose, "tree long, node long, feature long, cut long, gain double, value double, low double, high double"
    )
    return found.withColumn("feature", F.nullif("feature", F.lit(-1)))


def prepared(df: DataFrame, features: Sequence[str], label: str) -> tuple[list[np.ndarray], DataFrame, float]:
    """Cuts, blocks and the mean of the labels. Nulls of features are zero; labels are not null."""
    names = [f"f{i}" for i in range(len(features))]
    rows = df.select(*[filled(c).alias(n) for n, c in zip(names, features)], F.col(label).cast("double").alias("y"))
    odd = [F.isnan(c) | (F.abs(F.col(c)) == float("inf")) for c in [*names, "y"]]
    facts = rows.agg(F.count("y").alias("n"), F.avg("y").alias("middle"), F.max(F.greatest(*odd)).alias("odd")).first()
    if facts["odd"]:
        raise ValueError("features and labels must be finite")
    # One task merges the quantiles of all others: few of these, however small the stored files are.
    cuts = cut_points(rows.coalesce(parts(rows, facts["n"])), names)
    return cuts, store_blocks(rows, facts["n"], cuts, "y", names, facts["middle"]), facts["middle"]


def grow(df: DataFrame, features: Sequence[str], label: str, trees: int = 50, depth: int = 8, seed: int = 0) -> Forest:
    """Regression trees on bootstraps of all rows; a third of the features is offered to each node, as Spark ML does.

    Splits take the most from the squared error. Nulls of features are zero; labels are not null.
    """
    cuts, blocks, middle = prepared(df, features, label)
    size = 2 ** (depth + 1) - 1
    forest = Forest(
        cuts, np.zeros((trees, size), np.int64), np.full((trees, size), STAY, np.uint8), np.zeros((trees, size)), np.zeros((trees, size)), depth
    )
    random = np.random.default_rng(seed)
    alive = np.ones((trees, 1), bool)
    for level in range(depth):
        nodes, k = 2**level, max(1, -(-len(features) // 3))
        offered = random.permuted(np.tile(np.arange(len(features)), (trees, nodes, 1)), axis=2)[:, :, :k]
        below = np.zeros((trees, 2 * nodes), bool)
        at_once, left = max(1, SUMS // (k * nodes * BINS * 16)), np.flatnonzero(alive.any(axis=1)).tolist()
        splits = []
        for i in range(0, len(left), at_once):
            splits += level_splits(blocks, forest, level, offered, alive, seed, left[i : i + at_once]).collect()
        if not level:
            for r in splits:
                forest.value[r["tree"], 0] = r["value"]
        forest.value[:, 2 * nodes - 1 : 4 * nodes - 1] = forest.value[:, nodes - 1 : 2 * nodes - 1].repeat(2, axis=1)
        for r in splits:
            if r["feature"] is not None:
                t, i = r["tree"], r["node"]
                forest.feature[t, i], forest.cut[t, i], forest.gain[t, i] = r["feature"], r["cut"], r["gain"]
                forest.value[t, 2 * i + 1], forest.value[t, 2 * i + 2] = r["low"], r["high"]
                below[t, 2 * (i - nodes + 1) : 2 * (i - nodes + 1) + 2] = True
        alive = below
    forest.value += middle
    return forest
