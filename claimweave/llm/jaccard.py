"""Similarity join of word shingles by exact Jaccard likeness, with adaptive multi-match prefixes.

Sets are ordered by a hash. Two sets of likeness t share at least ``l`` elements of their first ``n - ceil(t n) + l``
(the window, with ``l`` growing with n), so a document with too few repeated elements in its window has no partner.
Among the windows left the elements are ordered by how many documents have them, rare ones first: partners share
one element of their rarest ``window - l' + 1``, and ``j`` elements of the rarest ``window - l' + j``. Each document's
``j`` grows with the candidates it would meet, and a pair is verified only if it shares the smaller of its two ``j``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..session import store_table
from .components import components
from .texts import LOWER, bounded_batches, chunks, joined, mix, words

WIDTH = 5
PERCENT = 80
STRETCH = 60  # percent of the plain prefix by which the window is longer
CHEAP = 32  # candidates that a document may meet before its prefix is lengthened
WORDS = 8  # of 64 bits, in a sketch of a set
KEPT_SETS = 1_000_000  # sets that a task remembers to send the elements of equal sets once

GAINS = np.random.default_rng(11).integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's word shingles; a shorter text is one shingle, without words none."""
    data, starts = joined(texts)
    at, _, hashes = words(LOWER[data])
    bounds = np.searchsorted(at, starts)
    rolled = np.zeros(len(hashes), np.uint64)
    for i in range(width):
        rolled[: max(0, len(hashes) - i)] += hashes[i:] * GAINS[i]
    rolled = mix(rolled)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(rolled[a : b - width + 1]))
        elif b > a:
            out.append(mix((hashes[a:b] * GAINS[: b - a]).sum(keepdims=True) + np.uint64(b - a)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def signature(items: np.ndarray) -> int:
    """A 64-bit hash of a set: equal sets, equal numbers."""
    with np.errstate(over="ignore"):
        total = mix(items ^ np.uint64(0xD6E8FEB86659FD93)).sum(dtype=np.uint64) * GAINS[0] + np.bitwise_xor.reduce(items, initial=np.uint64(len(items)))
    return int(mix(np.array([total], np.uint64)).view(np.int64)[0])


def slack(n: int, percent: int) -> int:
    """Elements of a set of ``n`` that a partner may lack."""
    return n - -(-percent * n // 100)


def window_matches(n: int, percent: int, stretch: int) -> int:
    return 1 + stretch * slack(n, percent) // 100


def _sets(batches, width: int, percent: int, stretch: int):
    seen: set[int] = set()
    for pdf in batches:
        texts = [t.encode() for t in pdf["text"]]
        out = []
        for lo, hi in chunks(texts):
            for items in shingle_sets(texts[lo:hi], width):
                n, sig, window = len(items), signature(items), None
                if n and sig not in seen:
                    if len(seen) >= KEPT_SETS:
                        seen.clear()
                    seen.add(sig)
                    window = (items[: slack(n, percent) + window_matches(n, percent, stretch)] >> np.uint64(16)).astype(np.int64)
                out.append((n, sig, window))
        frame = pd.DataFrame(out, columns=["n", "sig", "window"])
        yield frame.assign(doc_id=pdf["doc_id"].to_numpy())


def _full(batches, width: int):
    for pdf in batches:
        texts, wanted, out = [t.encode() for t in pdf["text"]], pdf["sig"].tolist(), []
        for lo, hi in chunks(texts):
            for sig, items in zip(wanted[lo:hi], shingle_sets(texts[lo:hi], width)):
                if signature(items) == sig:
                    out.append((sig, items.view(np.int64)))
        yield pd.DataFrame(out, columns=["sig", "items"])


def _slack(n: Column, percent: int) -> Column:
    return n - F.ceil(n * percent / 100).cast("long")


def _least_matches(n: Column, percent: int, stretch: int) -> Column:
    """Elements that the windows of a set of ``n`` and of its smallest possible partner share."""
    small = F.ceil(n * percent / 100).cast("long")
    return 1 + F.floor(_slack(small, percent) * stretch / 100).cast("long")


def survivors(sets: DataFrame, percent: int, stretch: int) -> DataFrame:
    """``sig``, ``n``, ``least`` and the window's elements that other sets have too, where they are enough for a partner."""
    each = sets.where("window is not null").select("sig", "n", F.explode("window").alias("token"))
    shared = each.groupBy("token").count().where("count > 1").select("token")
    found = each.join(shared, "token").groupBy("sig", "n").agg(F.collect_set("token").alias("tokens"))
    return found.withColumn("least", _least_matches(F.col("n"), percent, stretch)).where(F.size("tokens") >= F.col("least"))


def prefixes(windows: DataFrame, cheap: int = CHEAP) -> DataFrame:
    """``sig``, ``n``, ``j``, ``token``: the elements by which each document meets candidates."""
    each = windows.select("sig", "n", "least", F.explode("tokens").alias("token"))
    freq = each.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    found = each.join(freq, "token").groupBy("sig", "n", "least").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("tokens"))
    base = F.size("tokens") - F.col("least") + 1
    found = found.withColumn("base", base.cast("int")).where("base >= 1")
    cost = F.aggregate(F.slice("tokens", 1, F.col("base")), F.lit(0).cast("long"), lambda s, t: s + t["df"] - 1)
    more = F.when(cost > cheap, F.floor(2 * F.log2(cost / cheap)).cast("long")).otherwise(F.lit(0))
    found = found.withColumn("j", F.least(1 + more, F.col("least")))
    taken = F.slice("tokens", 1, (F.col("base") + F.col("j") - 1).cast("int"))
    return found.select("sig", "n", "j", F.explode(F.transform(taken, lambda t: t["token"])).alias("token"))


def _alike(n: Column, m: Column, percent: int) -> Column:
    return (100 * n >= percent * m) & (100 * m >= percent * n)


def sketches(full: DataFrame) -> DataFrame:
    """``sig``, ``lonely`` (elements that no other one of these sets has) and ``odd``: for each of 512 classes of the
    other elements, a bit that tells whether the set has an odd number of them."""
    items = full.select("sig", F.explode("items").alias("item"))
    single = items.groupBy("item").agg(F.count("*").alias("df"), F.min("sig").alias("sig")).where("df = 1")
    own = single.groupBy("sig").agg(F.collect_list("item").alias("own"))
    shared = F.array_except("items", F.coalesce("own", F.array().cast("array<long>")))
    both = full.join(own, "sig", "left").select("sig", F.size("items").alias("n"), shared.alias("shared"))
    zero = F.lit(0).cast("long")

    def word(k: int) -> Column:
        bit = lambda e: F.call_function("shiftleft", F.lit(1).cast("long"), e.bitwiseAND(63).cast("int"))
        mine = F.filter("shared", lambda e: F.shiftrightunsigned(e, 6).bitwiseAND(7) == k)
        return F.aggregate(mine, zero, lambda t, e: t.bitwiseXOR(bit(e)))

    return both.select("sig", (F.col("n") - F.size("shared")).cast("long").alias("lonely"), F.struct(*[word(k).alias(f"w{k}") for k in range(WORDS)]).alias("odd"))


def _may_be_alike(a: str, b: str, percent: int) -> Column:
    """Sizes, and elements that must lie outside the intersection, still allow the likeness.

    What one set has and the other has not differs by ``n - m`` in number between the two sides; each side holds
    the lonely elements. Sets that are alike differ in at most (100 - percent) / (100 + percent) of ``n + m``.
    """
    n, m, own, other = (F.col(c) for c in (f"{a}.n", f"{b}.n", f"{a}.lonely", f"{b}.lonely"))
    differ = F.greatest(own, other + n - m) + F.greatest(other, own + m - n)
    return _alike(n, m, percent) & ((100 + percent) * differ <= (100 - percent) * (n + m))


def _sketches_may_be_alike(a: str, b: str, percent: int) -> Column:
    """Each element that one set has and the other has not turns one bit, so the bits that differ bound their number."""
    turned = [F.bit_count(F.col(f"{a}.odd.w{k}").bitwiseXOR(F.col(f"{b}.odd.w{k}"))) for k in range(WORDS)]
    differ = sum(turned, F.col(f"{a}.lonely") + F.col(f"{b}.lonely"))
    return (100 + percent) * differ <= (100 - percent) * (F.col(f"{a}.n") + F.col(f"{b}.n"))


def _enough(met: DataFrame) -> DataFrame:
    """The pairs of documents that meet as often as the smaller of their ``j``."""
    pairs = met.groupBy(F.col("x.sig").alias("a"), F.col("y.sig").alias("b")).agg(F.count("*").alias("shared"), F.min(F.least("x.j", "y.j")).alias("j"))
    return pairs.where("shared >= j").select("a", "b")


def hub_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Each document with one hub per element: the document with the fewest lonely elements, which is the nearest to
    what a group of copies has in common. There are as many pairs as elements at most."""
    hubs = rows.groupBy("token").agg(F.min(F.struct("lonely", "sig", "n", "j")).alias("y"))
    own = rows.select("token", F.struct("lonely", "sig", "n", "j").alias("x"))
    return _enough(own.join(hubs, "token").where((F.col("x.sig") != F.col("y.sig")) & _may_be_alike("x", "y", percent)))


def cross_pairs(rows: DataFrame, odd: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs that are not in one component yet; elements met in one component alone are left out first."""
    known = rows.join(parts.withColumnRenamed("node", "sig"), "sig", "left").withColumn("component", F.coalesce("component", "sig"))
    mixed = known.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("token")
    slim = known.join(mixed, "token").select("token", F.struct("lonely", "sig", "n", "j", "component").alias("x"))
    slim = store_table(slim, "open")
    # Rows without any possible partner go first, before the rows are given all elements of their document.
    other = slim.select(F.col("token").alias("met"), F.col("x").alias("y"))
    possible = (F.col("x.component") != F.col("y.component")) & _may_be_alike("x", "y", percent)
    left = slim.join(other, (F.col("token") == F.col("met")) & possible, "left_semi")
    left = left.groupBy("x").agg(F.sort_array(F.collect_set("token")).alias("tokens"))
    left = left.join(odd.select("sig", "odd"), F.col("x.sig") == F.col("sig"))
    open_rows = store_table(left.select(F.struct("x.*", "tokens", "odd").alias("x"), F.explode("tokens").alias("token")), "possible")
    met = open_rows.join(open_rows.withColumnRenamed("x", "y"), "token")
    common = F.array_intersect("x.tokens", "y.tokens")
    # Of all elements that a pair shares, it is formed at the first.
    first = (F.get(common, F.lit(0)) == F.col("token")) & (F.size(common) >= F.least("x.j", "y.j"))
    allowed = _may_be_alike("x", "y", percent) & _sketches_may_be_alike("x", "y", percent) & first
    pairs = met.where((F.col("x.component") < F.col("y.component")) & allowed)
    return pairs.select(F.col("x.sig").alias("a"), F.col("y.sig").alias("b"))


def verified(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets are alike enough."""
    left = full.select(F.col("sig").alias("a"), F.col("items").alias("items_a"))
    right = full.select(F.col("sig").alias("b"), F.col("items").alias("items_b"))
    both = pairs.join(left, "a").join(right, "b").withColumn("common", F.size(F.array_intersect("items_a", "items_b")))
    union = F.size("items_a") + F.size("items_b") - F.col("common")
    return both.where(100 * F.col("common") >= percent * union).select("a", "b")


def near_groups(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, stretch: int = STRETCH) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` for each row: the smallest id that links reach.

    Two documents link where ``100 * intersection >= percent * union``. Equal sets are one node, so exact copies make
    no pairs; each document is first verified against one hub per element, and what is then still apart is compared
    pair by pair, so no link is lost and none within a component is tested again. Null and blank text has no shingles
    and links with nothing. Rows that repeat an id are compared as texts of their own. A row without an id links with
    nothing, and its component is null. Other columns are left out.
    """
    bounded_batches(docs.sparkSession)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    schema = "n long, sig long, window array<long>, doc_id long"
    sets = store_table(texts.where("doc_id is not null").mapInPandas(lambda b: _sets(b, width, percent, stretch), schema), "sets")
    windows = store_table(survivors(sets, percent, stretch), "windows")
    rows = store_table(prefixes(windows), "prefixes")
    nodes = rows.select("sig").distinct()
    sample = sets.join(nodes, "sig").groupBy("sig").agg(F.min("doc_id").alias("doc_id"))
    full = store_table(texts.join(sample, "doc_id").mapInPandas(lambda b: _full(b, width), "sig long, items array<long>").dropDuplicates(["sig"]), "full")
    odd = store_table(sketches(full), "sketches")
    rows = store_table(rows.join(odd.select("sig", "lonely"), "sig"), "rows")
    links = store_table(verified(hub_pairs(rows, percent), full, percent), "links")
    rest = verified(cross_pairs(rows, odd, components(links), percent), full, percent)
    parts = components(links.unionByName(rest))
    first = sets.where("n > 0").groupBy("sig").agg(F.min("doc_id").alias("least"))
    labelled = first.join(parts.withColumnRenamed("node", "sig"), "sig", "left").withColumn("component", F.coalesce("component", "sig"))
    least = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    by_set = labelled.join(least, "component").select("sig", "component_id")
    out = sets.join(by_set, "sig", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
    none = texts.where("doc_id is null").mapInPandas(lambda b: _sets(b, width, percent, stretch), schema)
    return out.unionByName(none.select("doc_id", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id")))
