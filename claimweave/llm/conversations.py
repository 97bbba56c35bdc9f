"""Prefix trie of conversations, with subtree sums by centroid decomposition.

A node is a distinct sequence of first turns. It is named by its smallest conversation and its depth, and found by sums
of hashes of (place, role, text) along each conversation, so no list of turns is built and a conversation may be of any
length. Subtree sums are taken over the forest of edges to parents: a component is split at a centroid, the total of
what lies below it in the component is added to the nodes on the path from it to the component's top, and the parts
are split on. Components of over ``MOST`` nodes are split by joins, all at once in a round, at the deepest node with
half of the component's turns below it; smaller ones within tasks.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..operators.ordering import ranked, running_sums
from ..session import store_table
from .texts import bounded_batches

MOST = 20_000
SHARED = 3  # first turns that a rebuilt conversation may take from another one
BLOCK = 20
PRIME = 2**61 - 1


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``d`` (from 1), two hashes of role and text, ``words``: turns in order, null first.

    Turns with equal numbers are ordered by a hash of role and text. Rows without an id are left out.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.xxhash64(role, text).alias("a"),
        F.xxhash64(F.lit("second"), role, text).alias("b"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )
    return ranked(turns, ["turn", "a", "b"], ["conv_id"], "d").drop("turn")


def rebuilt_turns(turns: DataFrame) -> DataFrame:
    """Conversations that share first turns: each takes the first 0 to 3 (by its id's hash) from the first conversation
    of its block of 20 ids, if that one exists, then goes on with its own turns after as many."""
    sizes = turns.groupBy("conv_id").agg(F.max("d").alias("n")).withColumn("h", F.crc32(F.col("conv_id").cast("string")) % (SHARED + 1))
    heads = turns.where(F.col("d") <= SHARED).groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(F.struct("d", "a", "b", "words"))).alias("head"))
    base = F.col("conv_id") - F.pmod("conv_id", F.lit(BLOCK))
    taken = F.slice(F.coalesce("head", F.array()), F.lit(1), F.col("h").cast("int"))
    plan = sizes.withColumn("base", base).join(heads, "base", "left").select("conv_id", "n", "h", taken.alias("taken"))
    plan = plan.withColumn("k", F.size("taken").cast("long"))
    length = (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")
    plan = store_table(plan.select("conv_id", "h", "k", "taken", length), "plan")
    lent = plan.select("conv_id", "length", F.inline("taken"))
    own = turns.join(plan.drop("taken"), "conv_id").where("d > h")
    own = own.select("conv_id", "length", (F.col("d") - F.col("h") + F.col("k")).alias("d"), "a", "b", "words")
    none = plan.select("conv_id", "length", *[F.lit(0).cast("long").alias(c) for c in ("d", "a", "b", "words")])
    return lent.unionByName(own).unionByName(none)


def with_root(turns: DataFrame) -> DataFrame:
    """The conversations as they are, each with the empty sequence at depth 0 and its ``length``."""
    sizes = turns.groupBy("conv_id").agg(F.max("d").alias("length"))
    none = sizes.select("conv_id", "length", *[F.lit(0).cast("long").alias(c) for c in ("d", "a", "b", "words")])
    return turns.join(sizes, "conv_id").unionByName(none)


def _keyed(turns: DataFrame) -> DataFrame:
    """Adds the node's key and its parent's: sums of hashes over the turns so far."""
    code = {"x": F.xxhash64("d", "a", "b"), "y": F.xxhash64("d", "b", "a", F.lit(1))}
    coded = turns.select("conv_id", "length", "d", "words", *[F.when(F.col("d") > 0, c).otherwise(F.lit(0)).cast("decimal(20,0)").alias(n) for n, c in code.items()])
    summed = running_sums(coded, ["d"], {"sx": "x", "sy": "y"}, ["conv_id"])
    key = lambda c: (c % F.lit(PRIME).cast("decimal(20,0)")).cast("long")
    own = [key(F.col(f"s{n}")).alias(n) for n in code]
    before = [key(F.col(f"s{n}") - F.col(n)).alias(f"p{n}") for n in code]
    return summed.select("conv_id", "length", "d", "words", *own, *before)


def subtree_sums(parent: list[int], values: list[tuple[int, ...]]) -> list[list[int]]:
    """The sums of values over the subtree of each node, parents before children; a top's parent is -1."""
    n = len(parent)
    width = len(values[0]) if values else 0
    total = [[0] * width for _ in range(n)]
    tops: dict[int, list[int]] = {}
    top_of = [0] * n
    for i, p in enumerate(parent):
        top_of[i] = i if p < 0 else top_of[p]
        tops.setdefault(top_of[i], []).append(i)
    stack = list(tops.values())
    size = [0] * n
    mark = [-1] * n  # the child of the centroid above a node, the centroid itself, or -1
    while stack:
        part = stack.pop()
        top = part[0]
        if len(part) == 1:
            total[top] = [t + v for t, v in zip(total[top], values[top])]
            continue
        for i in part:
            size[i] = 1
        for i in reversed(part[1:]):
            size[parent[i]] += size[i]
        centroid = next(i for i in reversed(part) if 2 * size[i] >= len(part))
        below: dict[int, list[int]] = {}
        rest, added = [], list(values[centroid])
        for i in part:
            mark[i] = -1
            if i == centroid:
                mark[i] = i
                continue
            above = mark[parent[i]] if i != top else -1
            if above < 0:
                rest.append(i)
                continue
            mark[i] = i if above == centroid else above
            below.setdefault(mark[i], []).append(i)
            for k, v in enumerate(values[i]):
                added[k] += v
        i = centroid
        while True:
            for k, v in enumerate(added):
                total[i][k] += v
            if i == top:
                break
            i = parent[i]
        stack.extend(below.values())
        if rest:
            stack.append(rest)
    return total


def _small(batches, most: int):
    """Sums within whole components, which come one after the other, parents first."""
    columns = ["top_conv", "top_depth", "conv_id", "depth", "parent_conv_id", "leaves", "saved", "leaves_in", "saved_in"]
    rows = np.empty((0, len(columns)), np.int64)

    def settle(part: np.ndarray) -> pd.DataFrame:
        at = {(c, d): i for i, (c, d) in enumerate(part[:, 2:4].tolist())}
        parent = [-1 if d == t else at[p, d - 1] for t, d, p in part[:, [1, 3, 4]].tolist()]
        sums = np.array(subtree_sums(parent, part[:, 5:7].tolist()), np.int64).reshape(-1, 2) + part[:, 7:9]
        return pd.DataFrame({"conv_id": part[:, 2], "depth": part[:, 3], "n_leaves": sums[:, 0], "saved_tokens": sums[:, 1]})

    for pdf in batches:
        rows = np.concatenate([rows, pdf[columns].to_numpy(np.int64)])
        ends = np.flatnonzero((rows[1:, :2] != rows[:-1, :2]).any(axis=1)) + 1
        if len(rows) >= most and len(ends):
            yield settle(rows[: ends[-1]])
            rows = rows[ends[-1] :]
    if len(rows):
        yield settle(rows)


TOP = ["top_conv", "top_depth"]


def _split_once(big: DataFrame, line: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One round over large components: the sums of the centroids, which leave, and the parts that they leave."""
    weights = big.groupBy(*TOP).agg(F.max("weight").alias("whole"))
    half = big.join(weights, TOP).where(2 * F.col("weight") >= F.col("whole"))
    centre = half.groupBy(*TOP).agg(F.max(F.struct("depth", "conv_id", "weight")).alias("c"))
    centre = store_table(centre.select(*TOP, F.col("c.depth").alias("cd"), F.col("c.conv_id").alias("cc"), F.col("c.weight").alias("cw")), "centroids")
    # The conversation that names a node runs through all the node's ancestors.
    here = line.select("conv_id", F.col("d").alias("cd"), F.col("node").alias("at"))
    under = line.select("conv_id", (F.col("d") - 1).alias("cd"), F.col("node").alias("next"))
    marked = big.join(centre, TOP).join(here, ["conv_id", "cd"], "left").join(under, ["conv_id", "cd"], "left")
    marked = marked.withColumn("inside", F.coalesce(F.col("at") == F.col("cc"), F.lit(False)) & (F.col("depth") >= F.col("cd")))
    trunk = line.join(centre.select(F.col("cc").alias("conv_id"), "top_depth", "cd"), "conv_id").where("d < cd and d >= top_depth")
    trunk = trunk.select(F.col("node").alias("conv_id"), F.col("d").alias("depth"), F.lit(True).alias("on_path"))
    marked = store_table(marked.join(trunk, ["conv_id", "depth"], "left"), "marked")
    below = marked.where("inside").groupBy(*TOP).agg(F.sum("leaves").alias("sum_leaves"), F.sum("saved").alias("sum_saved"))
    met = marked.join(below, TOP)
    is_centre = F.col("inside") & (F.col("depth") == F.col("cd"))
    gains = F.coalesce("on_path", F.lit(False)) | is_centre
    met = met.withColumns({f"{n}_in": F.col(f"{n}_in") + F.when(gains, F.col(f"sum_{n}")).otherwise(F.lit(0)) for n in ("leaves", "saved")})
    done = met.where(is_centre).select("conv_id", "depth", F.col("leaves_in").alias("n_leaves"), F.col("saved_in").alias("saved_tokens"))
    left = met.where(~is_centre).withColumns(
        {
            "weight": F.col("weight") - F.when(F.col("on_path"), F.col("cw")).otherwise(F.lit(0)),
            "top_conv": F.when(F.col("inside"), F.col("next")).otherwise(F.col("top_conv")),
            "top_depth": F.when(F.col("inside"), F.col("cd") + 1).otherwise(F.col("top_depth")),
        }
    )
    return done, store_table(left.select(*big.columns), "parts")


def rolled_up(tree: DataFrame, line, most: int = MOST) -> DataFrame:
    """``conv_id``, ``depth``, ``n_leaves``, ``saved_tokens`` of each node: sums over its subtree.

    ``line()`` gives the ``node`` (smallest conversation) at each depth ``d`` of each ``conv_id``; it is only asked for
    where a component has over ``most`` nodes.
    """
    root = tree.where("depth = 0").agg(F.min("conv_id")).scalar()
    zero = F.lit(0).cast("long")
    state = tree.select("conv_id", "depth", "parent_conv_id", "weight", "leaves", "saved", zero.alias("leaves_in"), zero.alias("saved_in"), zero.alias("top_depth"))
    state = store_table(state.withColumn("top_conv", root), "state")
    found, small, lines = [], [], None
    while True:
        sizes = store_table(state.groupBy(*TOP).agg((F.count("*") > most).alias("big")), "sizes")
        small.append(state.join(sizes.where("not big"), TOP, "left_semi"))
        if sizes.where("big").isEmpty():
            break
        if lines is None:
            lines = line()
        done, state = _split_once(state.join(sizes.where("big"), TOP, "left_semi"), lines)
        found.append(done)
    rest = reduce(DataFrame.unionByName, small).withColumn("parent_conv_id", F.coalesce("parent_conv_id", F.lit(-1)))
    rest = rest.repartition(*TOP).sortWithinPartitions(*TOP, "depth")
    found.append(rest.mapInPandas(lambda b: _small(b, most), "conv_id long, depth long, n_leaves long, saved_tokens long"))
    return reduce(DataFrame.unionByName, found)


def _digests(batches):
    """The digest of each node's list of ids, of rows in order of node and id; a list is never held whole."""
    last, state = None, None
    for pdf in batches:
        out = []
        for node, ids in pdf.groupby(["node", "depth"], sort=False)["conv_id"]:
            text = ",".join(map(str, ids.tolist())).encode()
            if node == last:
                state.update(b"," + text)
                continue
            if last is not None:
                out.append((*last, state.hexdigest()))
            last, state = node, hashlib.sha256(text)
        yield pd.DataFrame(out, columns=["conv_id", "depth", "ends_sha256"])
    if last is not None:
        yield pd.DataFrame([(*last, state.hexdigest())], columns=["conv_id", "depth", "ends_sha256"])


def prefix_trie(turns: DataFrame, most: int = MOST) -> DataFrame:
    """One row per node of the trie of conversations (``conv_id``, ``length``, ``d``, hashes ``a`` and ``b``, ``words``;
    with a row at depth 0 each).

    ``conv_id`` and ``depth`` name the node: its last turn is the turn of that conversation at that depth.
    ``n_convs``: conversations that start with it, ``n_children``, ``n_leaves``: childless nodes in its subtree,
    ``saved_tokens``: words that are not stored again in its subtree, ``ends_sha256``: of the ids that end here. No
    conversations give no rows.
    """
    bounded_batches(turns.sparkSession)
    keyed = store_table(_keyed(turns), "keyed")
    nodes = keyed.groupBy("d", "x", "y").agg(
        F.count("*").alias("n_convs"),
        F.min("conv_id").alias("node"),
        F.min("words").alias("words"),
        F.min(F.struct("px", "py")).alias("p"),
        F.sum(F.col("length") - F.col("d") + 1).alias("weight"),
    )
    nodes = store_table(nodes.select("*", F.col("p.px").alias("px"), F.col("p.py").alias("py")).drop("p"), "nodes")
    up = nodes.where("d > 0").select((F.col("d") - 1).alias("d"), F.col("px").alias("x"), F.col("py").alias("y"), F.col("node").alias("kid"))
    names = nodes.select("d", "x", "y", "node")
    kids = up.groupBy("d", "x", "y").agg(F.count("*").alias("n_children"))
    parents = up.join(names, ["d", "x", "y"]).select(F.col("kid").alias("node"), (F.col("d") + 1).alias("d"), F.col("node").alias("parent_conv_id"))
    tree = nodes.join(kids, ["d", "x", "y"], "left").join(parents, ["node", "d"], "left")
    tree = tree.select(
        F.col("node").alias("conv_id"),
        F.col("d").alias("depth"),
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
        "weight",
        F.col("n_children").isNull().cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    )
    tree = store_table(tree, "tree")

    def line() -> DataFrame:
        return store_table(keyed.select("conv_id", "d", "x", "y").join(names, ["d", "x", "y"]).select("conv_id", "d", "node"), "line")

    sums = rolled_up(tree, line, most)
    ends = keyed.where("d = length").select("conv_id", "d", "x", "y").join(names, ["d", "x", "y"]).select("node", F.col("d").alias("depth"), "conv_id")
    digests = ends.repartition("node", "depth").sortWithinPartitions("node", "depth", "conv_id").mapInPandas(_digests, "conv_id long, depth long, ends_sha256 string")
    out = tree.join(sums, ["conv_id", "depth"]).join(digests, ["conv_id", "depth"], "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")
    )


def rebuilt_trie(conversations: DataFrame, most: int = MOST) -> DataFrame:
    """The trie of the rebuilt conversations. Null roles and texts are empty, repeated rows are turns of their own,
    other columns are left out."""
    return prefix_trie(rebuilt_turns(store_table(numbered_turns(conversations), "turns")), most)
