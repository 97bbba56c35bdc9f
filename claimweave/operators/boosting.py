"""Boosted regression trees over tables of many rows.

Spark ML holds each row as an object with its count for the tree, and walks these for each level of each tree. Here, as in ``forest``, rows
are blocks of bins, each with what the trees so far leave of its labels: Spark keeps the blocks, in memory or on disk, and they are made anew
once for each tree. A level is one scan: tasks add up rows and labels by node, feature and bin. Where the sums of all tasks are few they meet
on the driver, else by node in groups that choose the splits, and a row per node reaches the driver.

The model is Spark ML's for squared errors: the first tree explains the labels and counts in full, each later one twice what is left and
counts at the rate; a tree sees a share of the rows, drawn anew.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame

from .forest import BINS, STAY, SUMS, Splits, best_splits, prepared, walk
from ..session import drop_checkpoint

GATHERED = 16 << 20  # bytes of sums that meet on the driver
PIECE = 64  # nodes whose sums meet in a group, beyond
AGAIN = 10  # trees after which the blocks are stored, so that a lost one is made from these and not from the first

Block = tuple[int, int, bytes, bytes]  # part, number, bins by feature, labels


@dataclass
class Tree:
    """``feature``, ``cut``, ``value`` and ``gain`` by node, numbered as in ``forest``."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    gain: np.ndarray


def drawn(seed: int, part: int, block: int, tree: int, rows: int, sampling: float) -> np.ndarray:
    """Places of the rows a tree sees."""
    return np.flatnonzero(np.random.default_rng([seed, part, block, tree]).integers(0, 65536, rows, np.uint16) < round(sampling * 65536))


def level_splits(
    blocks: RDD, tree: Tree, number: int, level: int, low: int, high: int, k: int, sampling: float, least: int, seed: int
) -> dict[int, Splits]:
    """The best splits of the nodes ``low`` to ``high`` of a level, by the first node of each piece of them."""
    nodes, first, feature, cut = high - low, 2**level - 1, tree.feature, tree.cut

    def add(some: Iterator[Block]) -> Iterator[tuple[int, np.ndarray]]:
        sums = np.zeros((2, k, nodes * BINS))
        for part, block, held, labels in some:
            y = np.frombuffer(labels)
            at = drawn(seed, part, block, number, len(y), sampling)
            y, bins = y.take(at), np.frombuffer(held, np.uint8).reshape(k, -1).take(at, axis=1)
            node = walk(bins, np.arange(len(at)), feature, cut, level) - (first + low)
            if nodes <= first:
                inside = np.flatnonzero((node >= 0) & (node < nodes))
                y, bins, node = y.take(inside), bins.take(inside, axis=1), node.take(inside)
            node *= BINS
            for j in range(k):
                cell = node + bins[j]
                sums[0, j] += np.bincount(cell, minlength=nodes * BINS)
                sums[1, j] += np.bincount(cell, y, nodes * BINS)
        for i in range(0, nodes, PIECE):
            yield low + i, sums.reshape(2, k, nodes, BINS)[:, :, i : i + PIECE]

    def choose(sums: np.ndarray) -> Splits:
        return best_splits(*sums, least)

    sums = blocks.mapPartitions(add)
    if blocks.getNumPartitions() * nodes * k * BINS * 16 > GATHERED:
        groups = min(-(-nodes // PIECE), blocks.ctx.defaultParallelism)
        return dict(sums.reduceByKey(np.add, groups).mapValues(choose).collect())
    total: dict[int, np.ndarray] = {}
    for i, part in sums.collect():
        total[i] = total[i] + part if i in total else part
    return {i: choose(t) for i, t in total.items()}


def grow_tree(blocks: RDD, number: int, k: int, depth: int, sampling: float, least: int, seed: int) -> Tree:
    size = 2 ** (depth + 1) - 1
    tree = Tree(np.zeros(size, np.int64), np.full(size, STAY, np.uint8), np.zeros(size), np.zeros(size))
    alive = np.ones(1, bool)
    for level in range(depth):
        nodes = 2**level
        at_once, below = max(1, SUMS // (k * BINS * 16)), np.zeros(2 * nodes, bool)
        # A node without a split sends all rows left, to a child of its own value.
        tree.value[2 * nodes - 1 : 4 * nodes - 1] = tree.value[nodes - 1 : 2 * nodes - 1].repeat(2)
        for low in range(0, nodes, at_once):
            high = min(low + at_once, nodes)
            if not alive[low:high].any():
                continue
            for piece, best in level_splits(blocks, tree, number, level, low, high, k, sampling, least, seed).items():
                if not level:
                    tree.value[:3] = best.value[0]
                for i in np.flatnonzero(best.found & alive[piece : piece + len(best.found)]):
                    place = nodes - 1 + piece + i
                    tree.feature[place], tree.cut[place], tree.gain[place] = best.place[i], best.cut[i], best.gain[i]
                    tree.value[2 * place + 1], tree.value[2 * place + 2] = best.low[i], best.high[i]
                    below[2 * (piece + i) : 2 * (piece + i) + 2] = True
        alive = below
    return tree


def left_over(blocks: RDD, tree: Tree, k: int, depth: int, share: float, scale: float) -> RDD:
    """The blocks with what is left of their labels after ``share`` of the tree's values, times ``scale``."""
    feature, cut, value = tree.feature, tree.cut, tree.value

    def renew(some: Iterator[Block]) -> Iterator[Block]:
        for part, block, held, labels in some:
            y, bins = np.frombuffer(labels), np.frombuffer(held, np.uint8).reshape(k, -1)
            node = walk(bins, np.arange(len(y)), feature, cut, depth)
            yield part, block, held, (scale * (y - share * value.take(node))).tobytes()

    return blocks.mapPartitions(renew, preservesPartitioning=True)


def grow(
    df: DataFrame, features: Sequence[str], label: str, trees: int, depth: int, rate: float, sampling: float = 1.0, least: int = 1, seed: int = 0
) -> list[Tree]:
    """Boosted trees on all rows. Nulls of features are zero; labels are not null."""
    _, stored, _ = prepared(df, features, label)
    k, grown, olds, kept = len(features), [], [], []
    blocks = stored.rdd.map(lambda r: (r["part"], r["block"], bytes(r["bins"]), bytes(r["y"]))).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for m in range(trees):
            grown.append(grow_tree(blocks, m, k, depth, sampling, least, seed))
            # By now the blocks are made, and those they were made from are needed no more.
            while olds:
                olds.pop().unpersist()
            if blocks.isCheckpointed():
                kept.append(blocks.getCheckpointFile())
                while len(kept) > 1:
                    drop_checkpoint(df.sparkSession, kept.pop(0))
            if m + 1 < trees:
                olds.append(blocks)
                blocks = left_over(blocks, grown[-1], k, depth, 2 * rate if m else 1.0, 1.0 if m else 2.0)
                blocks.persist(StorageLevel.MEMORY_AND_DISK)
                if (m + 1) % AGAIN == 0:
                    blocks.checkpoint()
    finally:
        for held in [*olds, blocks]:
            held.unpersist()
        for path in kept:
            drop_checkpoint(df.sparkSession, path)
    return grown


def importances(grown: Sequence[Tree], features: int) -> np.ndarray:
    """What the splits on each feature take from the squared errors of all trees, as shares."""
    found = sum(np.bincount(t.feature, t.gain, features) for t in grown)
    return found / (found.sum() or 1)
