"""SimHash near duplicates by a hierarchical index in Gray order.

Fingerprints that differ in at most 3 of 64 bits agree in one of 4 blocks of 16 bits, so each fingerprint joins the
group of each of its blocks. All groups together are sorted over the cluster by block and Gray rank (the block turned
to the front), which brings alike fingerprints together. In a group, nodes of ``FAN`` successive entries keep the bits
on which all their entries agree; a node's own pattern leaves out what its parent has. A search goes down from the top
of its group, adds up the differences of the patterns met and leaves a node as soon as they exceed the limit. A node
whose entries all lie in the searcher's component is left too, so that a large group of copies makes no pairs.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..session import store_table
from .components import components
from .texts import LOWER, chunks, text_rows, with_null_ids

WIDTH = 3
BITS = 3  # that linked fingerprints may differ in: one less than there are blocks
BLOCK = 16
FAN = 8
PILE = 1 << 16  # fingerprints that are searched at once; a larger group is cut into slices
FRONT = 1 << 19  # nodes that searches are at, at once
SEED = 42
TOP = -(2**63)

_LOWER = LOWER.tobytes()


def fingerprint(text: bytes, width: int = WIDTH) -> int:
    """Each bit as in over half of the hashes of the text's word shingles, repeats included; without words zero."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(width)))) if len(words) >= width else iter([b" ".join(words)])
    n = max(1, len(words) - width + 1)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), ">u8", n)
    ones = sum(np.unpackbits(hashes[i : i + 8192].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64) for i in range(0, n, 8192))
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def _fingerprints(batches, width: int):
    for pdf in batches:
        found = [fingerprint(t.encode(), width) for t in pdf["text"]]
        yield pd.DataFrame({"doc_id": pdf["doc_id"].to_numpy(), "node": np.array(found, np.int64)})


def fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id``, ``node`` (the 64 bits as a signed number) for each row; null text is empty."""
    return with_null_ids(text_rows(docs).mapInPandas(lambda b: _fingerprints(b, width), "doc_id long, node long"))


class GrayIndex:
    """Groups of entries in Gray order, with their levels of nodes; level 0 are the entries, the last has one node a group."""

    def __init__(self, codes: np.ndarray, first: np.ndarray):
        """``first``: where each group starts."""
        group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(codes))))
        self.group, self.first = group, first
        self.bits, self.masks, self.starts = [codes], [np.full(len(codes), 2**64 - 1, np.uint64)], []
        #: The last entry of each node, by level.
        self.last = [np.arange(len(codes))]
        while len(self.bits[-1]) > len(first) or not self.starts:
            begins = np.searchsorted(group, np.arange(len(first)))
            place = np.arange(len(group)) - begins[group]
            starts = np.flatnonzero(place % FAN == 0)
            counts = np.diff(np.append(starts, len(group)))
            bits, masks = self.bits[-1], self.masks[-1]
            shared = np.bitwise_and.reduceat(masks & ~(bits ^ np.repeat(bits[starts], counts)), starts)
            self.masks[-1] = masks & ~np.repeat(shared, counts)  # what the parent has not
            self.bits.append(bits[starts])
            self.masks.append(shared)
            self.last.append(self.last[-1][starts + counts - 1])
            self.starts.append(np.append(starts, len(group)))
            group = group[starts]

    def parts(self, label: np.ndarray) -> list[np.ndarray]:
        """By level, the component that all entries of a node have, or -1."""
        low, high, out = label, label, [label]
        for starts in self.starts:
            low, high = np.minimum.reduceat(low, starts[:-1]), np.maximum.reduceat(high, starts[:-1])
            out.append(np.where(low == high, low, -1))
        return out

    def near(self, codes: np.ndarray, roots: np.ndarray, own: np.ndarray, parts: list[np.ndarray], after: np.ndarray, most: int):
        """Pairs of a place in ``codes`` and an entry that differ in ``most`` bits at most, in pieces. ``roots``: the
        group to search; ``own``: the component to leave out; ``after``: only entries behind this one."""
        top = len(self.bits) - 1
        apart = np.bitwise_count((codes ^ self.bits[top][roots]) & self.masks[top][roots])
        stack = [(top, np.arange(len(codes)), roots, apart)]
        while stack:
            level, who, node, apart = stack.pop()
            keep = (apart <= most) & (self.last[level][node] > after[who]) & (parts[level][node] != own[who])
            who, node, apart = who[keep], node[keep], apart[keep]
            if not level:
                if len(who):
                    yield who, node
                continue
            for i in range(0, len(who), FRONT // FAN):
                w, n, d = (x[i : i + FRONT // FAN] for x in (who, node, apart))
                begin, count = self.starts[level - 1][n], np.diff(self.starts[level - 1])[n]
                child = np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(count.sum())
                w, d = np.repeat(w, count), np.repeat(d, count)
                d = d + np.bitwise_count((codes[w] ^ self.bits[level - 1][child]) & self.masks[level - 1][child])
                stack.append((level - 1, w, child, d))


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after places ``a`` and ``b`` are linked; a label is the least place of its component."""
    while True:
        la, lb = label[a], label[b]
        differ = la != lb
        if not differ.any():
            return label
        to = np.arange(len(label))
        np.minimum.at(to, np.maximum(la, lb)[differ], np.minimum(la, lb)[differ])
        while (to[to] != to).any():
            to = to[to]
        label = to[label]


def link_groups(codes: np.ndarray, first: np.ndarray, most: int) -> np.ndarray:
    """For each entry the least place that links within its group reach.

    Searches start with a few entries of each group and take twice as many each time: what they have joined is left
    out by the next ones.
    """
    index = GrayIndex(codes, first)
    label = np.arange(len(codes))
    # Neighbours in Gray order are often alike.
    same = index.group[1:] == index.group[:-1]
    close = np.flatnonzero(same & (np.bitwise_count(codes[1:] ^ codes[:-1]) <= most))
    label = merge(label, close, close + 1)
    place = label * 0 + np.arange(len(codes)) - first[index.group]
    done, step = 0, FAN
    while done <= place.max(initial=-1):
        turn = np.flatnonzero((place >= done) & (place < done + step))
        for i in range(0, len(turn), FRONT // FAN):
            who = turn[i : i + FRONT // FAN]
            for w, e in index.near(codes[who], index.group[who], label[who], index.parts(label), who, most):
                label = merge(label, who[w], e)
        done, step = done + step, min(2 * step, 1024)
    return label


FOUND = "a long, b long, block int, grp int, slice long, codes array<long>"


def _search(batches, most: int, pile: int):
    """Links to the least entry of each component of a group; and the slices of groups that may go on elsewhere: those
    at either end of the task's rows, and those of a group of over ``pile`` entries."""
    rows = np.empty((0, 4), np.int64)
    begun = False

    def settle(part: np.ndarray, open_first: bool, open_last: bool) -> pd.DataFrame:
        first = np.flatnonzero(np.append(True, (part[1:, :2] != part[:-1, :2]).any(axis=1)))
        codes = part[:, 3]
        label = link_groups(codes.view(np.uint64), first, most)
        at = np.flatnonzero(label != np.arange(len(label)))
        links = pd.DataFrame({"a": codes[at], "b": codes[label[at]]})
        cuts = ([0] if open_first else []) + ([len(first) - 1] if open_last else [])
        ends = np.append(first[1:], len(part))
        held = [(*part[first[k], :3].tolist(), codes[first[k] : ends[k]]) for k in sorted(set(cuts))]
        slices = pd.DataFrame(held, columns=["block", "grp", "slice", "codes"])
        whole = pd.concat([links.astype("Int64"), slices.astype({"block": "Int32", "grp": "Int32", "slice": "Int64"})], ignore_index=True)
        return whole.assign(codes=pd.Series([None] * len(links) + [h[3] for h in held], dtype=object))

    for pdf in batches:
        rows = np.concatenate([rows, pdf[["block", "grp", "rank", "node"]].to_numpy(np.int64)])
        while len(rows) > pile:
            # Up to the last group that ends within the pile, or a slice of a group that does not.
            new = np.flatnonzero((rows[1 : pile + 1, :2] != rows[:pile, :2]).any(axis=1)) + 1
            cut = int(new[-1]) if len(new) else pile
            goes_on = not len(new)
            yield settle(rows[:cut], not begun, goes_on)
            begun = not goes_on
            rows = rows[cut:]
    if len(rows):
        yield settle(rows, not begun, True)


def _turned(node: Column, by: int) -> Column:
    return node if not by else F.shiftleft(node, by).bitwiseOR(F.shiftrightunsigned(node, 64 - by))


def gray_rank(x: Column) -> Column:
    """Where a code stands in the order in which successive codes differ in one bit, as a signed number."""
    for shift in (1, 2, 4, 8, 16, 32):
        x = x.bitwiseXOR(F.shiftrightunsigned(x, shift))
    return x.bitwiseXOR(F.lit(TOP))


def in_gray_order(nodes: DataFrame) -> DataFrame:
    """Each fingerprint once for each block: ``block``, ``grp`` (the block's bits), ``rank``, ``node``, sorted over the cluster."""
    turned = F.array(*[F.struct(F.lit(b).alias("block"), gray_rank(_turned(F.col("node"), b * BLOCK)).alias("rank")) for b in range(64 // BLOCK)])
    each = nodes.select("node", F.inline(turned)).withColumn("grp", F.shiftright("rank", 64 - BLOCK).cast("int"))
    return each.repartitionByRange("block", "rank").sortWithinPartitions("block", "rank")


def _cross(batches, most: int):
    """Links between two slices of one group, of entries that are not in one component yet."""
    for pdf in batches:
        out = [pd.DataFrame({"a": [], "b": []}, dtype=np.int64)]
        for r in pdf.itertuples(index=False):
            codes, other = (np.array([e["node"] for e in x], np.int64) for x in (r.entries, r.others))
            named = [e["part"] for x in (r.entries, r.others) for e in x]
            label = np.unique(np.array(named, np.int64), return_inverse=True)[1]
            n = len(codes)
            index = GrayIndex(other.view(np.uint64), np.array([0]))
            for i in range(0, n, 64):
                who = np.arange(i, min(i + 64, n))
                zero = np.zeros(len(who), np.int64)
                for w, e in index.near(codes[who].view(np.uint64), zero, label[who], index.parts(label[n:]), zero - 1, most):
                    # One link of each two components is enough.
                    one = np.unique(np.stack([label[who[w]], label[n + e]]), axis=1, return_index=True)[1]
                    out.append(pd.DataFrame({"a": codes[who[w[one]]], "b": other[e[one]]}))
                    label = merge(label, who[w], n + e)
        yield pd.concat(out)


def _across(slices: DataFrame, links: DataFrame, most: int) -> DataFrame:
    """Links between slices of one group. Two slices are compared unless their common patterns differ too much or all
    their entries lie in one component."""
    several = slices.groupBy("block", "grp").count().where("count > 1")
    each = slices.join(several, ["block", "grp"], "left_semi").select("block", "grp", "slice", F.explode("codes").alias("node"))
    named = each.join(components(links), "node", "left").select("block", "grp", "slice", F.struct("node", F.coalesce("component", "node").alias("part")).alias("entry"))
    node = F.col("entry.node")
    agg = named.groupBy("block", "grp", "slice").agg(
        F.collect_list("entry").alias("entries"),
        F.bit_and(node).alias("ones"),
        F.bit_or(node).alias("any"),
        F.min("entry.part").alias("low"),
        F.max("entry.part").alias("high"),
    )
    open_slices = store_table(agg, "slices")
    left = open_slices.select("block", "grp", F.struct("slice", "ones", "any", "low", "high").alias("x"))
    right = left.withColumnRenamed("x", "y")

    def shared(s: str) -> Column:
        return F.bitwise_not(F.col(f"{s}.ones").bitwiseXOR(F.col(f"{s}.any")))

    differ = F.col("x.ones").bitwiseXOR(F.col("y.ones")).bitwiseAND(shared("x")).bitwiseAND(shared("y"))
    settled = (F.col("x.low") == F.col("x.high")) & (F.col("x.low") == F.col("y.low")) & (F.col("y.low") == F.col("y.high"))
    pairs = left.join(right, ["block", "grp"]).where((F.col("x.slice") < F.col("y.slice")) & (F.bit_count(differ) <= most) & ~settled)
    pairs = pairs.select("block", "grp", F.col("x.slice").alias("slice"), F.col("y.slice").alias("other"))
    bodies = open_slices.select("block", "grp", "slice", "entries")
    both = pairs.join(bodies, ["block", "grp", "slice"]).join(bodies.select("block", "grp", F.col("slice").alias("other"), F.col("entries").alias("others")), ["block", "grp", "other"])
    return both.select("entries", "others").mapInPandas(lambda b: _cross(b, most), "a long, b long")


def near_fingerprints(nodes: DataFrame, most: int = BITS, pile: int = PILE) -> DataFrame:
    """``node``, ``component`` for each fingerprint that links, but the least of its component itself. ``nodes`` are
    distinct; ``most`` must be below the number of blocks."""
    found = store_table(in_gray_order(nodes).mapInPandas(lambda b: _search(b, most, pile), FOUND), "searched")
    links = found.where("a is not null").select("a", "b")
    slices = found.where("codes is not null").select("block", "grp", "slice", "codes")
    return components(links.unionByName(_across(slices, links, most)))


def simhash_groups(docs: DataFrame, width: int = WIDTH, most: int = BITS, pile: int = PILE) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hexadecimal digits), ``component_id`` (the smallest id that links reach) for each row.

    Fingerprints link where ``most`` bits or fewer differ; equal ones are one node. Null, empty and blank texts have the
    fingerprint zero and link like any other. Repeated rows are rows of their own in the component of their
    fingerprint. A row without an id links with nothing, and its component is null. Other columns are left out; an
    empty table gives no rows.
    """
    each = store_table(fingerprints(docs, width), "fingerprints")
    least = store_table(each.where("doc_id is not null").groupBy("node").agg(F.min("doc_id").alias("least")), "nodes")
    parts = near_fingerprints(least.select("node"), most, pile)
    placed = least.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lowest = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    known = placed.join(lowest, "component").select("node", "component_id")
    out = each.join(known, "node", "left")
    code = F.lower(F.lpad(F.hex("node"), 16, "0"))
    return out.select("doc_id", code.alias("fingerprint"), F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
