"""Removal of long strings that repeat across a corpus, by longest-previous-factor arrays.

Bytes that a string of ``LENGTH`` covers are removed where the string also starts elsewhere. Suffixes are brought
together by anchors: the least hash of ``GRAM`` bytes within a string is the same place in each of its copies. The
strings of one anchor are a context, a stretch of bytes. Equal contexts are settled by counting hashes; the others
that share an anchor are laid out in suffix order, where a string's neighbours are its earlier and later matches.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import store_table
from .texts import BYTE_CODE, mix, text_rows, with_null_ids

LENGTH = 400
GRAM = 200
PILE_BYTES = 2 << 20  # of contexts that are put in suffix order at once
HOT_CONTEXTS = 16_384  # different contexts of an anchor beyond which they are dealt to several piles
SEEN_TEXTS = 500_000

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, 1 << 20), base, np.uint64)
        steps[0] = 1
        known = _POWERS[base] = np.multiply.accumulate(steps)
    return known[:n]


class Rolling:
    """Hashes of any stretches of a byte array."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_CODE[data] * powers(BASE, len(data)), out=self.sums[1:])
        self.back = powers(INVERSE, len(data) + 1)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.back[starts])

    def grams(self, n: int) -> np.ndarray:
        return mix((self.sums[n:] - self.sums[:-n]) * self.back[: len(self.sums) - n])


def window_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` successive values."""
    done = 1
    out = values
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[:-step], out[step:])
        done += step
    return out


def contexts(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, context hash, first and last start of the strings of each context of one text."""
    roll = Rolling(data)
    grams = roll.grams(gram)
    width = length - gram + 1
    least = window_least(grams, width)
    # A new anchor begins where the least value changes or its first place leaves the string.
    fresh = np.ones(len(least), bool)
    fresh[1:] = (least[1:] != least[:-1]) | (grams[: len(least) - 1] == least[:-1])
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(least)) - 1
    place = np.empty(len(first), np.int64)
    for a in range(0, len(first), 20_000):
        part = first[a : a + 20_000]
        place[a : a + 20_000] = part + (grams[part[:, None] + np.arange(width)] == least[part, None]).argmax(axis=1)
    whole = mix(roll(first, last + length) + mix((place - first).astype(np.uint64)))
    return grams[place], whole, first, last


CONTEXTS = "key long, n_bytes long, anchor long, context long, first int, last int"


def _contexts(batches, length: int, gram: int):
    seen: set[int] = set()
    for pdf in batches:
        parts = []
        for text, key in zip(pdf["text"], pdf["key"].tolist()):
            data = np.frombuffer(text.encode(), np.uint8)
            if key in seen or len(data) < length:
                continue
            if len(seen) >= SEEN_TEXTS:
                seen.clear()
            seen.add(key)
            anchor, whole, first, last = contexts(data, length, gram)
            parts.append(pd.DataFrame({"key": key, "n_bytes": len(data), "anchor": anchor.view(np.int64), "context": whole.view(np.int64), "first": first, "last": last}))
            if len(parts) >= 500:
                yield pd.concat(parts)
                parts = []
        if parts:
            yield pd.concat(parts)


def suffix_classes(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """The rank, in suffix order cut at ``length`` bytes, of each start; equal strings have equal ranks. The order
    is found by doubling: ranks of 8 bytes, then of twice as many from pairs of ranks."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    packed = np.zeros(len(data), np.uint64)
    for j in range(8):
        packed = (packed << np.uint64(8)) | padded[j : j + len(data)]
    rank = np.unique(packed, return_inverse=True)[1].astype(np.int64)
    done = 8
    while done * 2 <= length:
        ahead = np.zeros(len(rank), np.int64)
        ahead[:-done] = rank[done:] + 1
        rank = np.unique(rank * (len(rank) + 1) + ahead, return_inverse=True)[1].astype(np.int64)
        done *= 2
    if done == length:
        return rank[starts]
    return np.unique(rank[starts] * (len(rank) + 1) + rank[starts + length - done], return_inverse=True)[1]


def matches(rank: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each string has an earlier and a later match. In suffix order, ties by place, the previous smaller
    place with the same string is the neighbour before, the next larger one the neighbour after."""
    suffixes = np.lexsort((order, rank))
    same = rank[suffixes][1:] == rank[suffixes][:-1]
    earlier, later = np.zeros(len(rank), bool), np.zeros(len(rank), bool)
    earlier[suffixes[1:][same]] = True
    later[suffixes[:-1][same]] = True
    return earlier, later


def _slices(batches, length: int):
    """The bytes of wanted contexts out of whole texts."""
    for pdf in batches:
        out = []
        for r in pdf.itertuples(index=False):
            data = r.text.encode()
            for w in r.wanted:
                out.append((w["anchor"], w["pile"], r.key, r.n_bytes, r.order_id, w["first"], data[w["first"] : w["last"] + length]))
        yield pd.DataFrame(out, columns=["anchor", "pile", "key", "n_bytes", "order_id", "first", "data"])


FOUND = "key long, n_bytes long, start int, stop int, string long, single boolean"


def _pile(rows: list, length: int, first_stays: bool):
    """Matches among the contexts of whole anchors: runs of removed starts, and, of anchors that were dealt to several
    piles, a row for each different string."""
    data = np.frombuffer(b"".join(r.data for r in rows), np.uint8)
    counts = np.array([len(r.data) - length + 1 for r in rows])
    base = np.cumsum([0, *(len(r.data) for r in rows[:-1])])
    owner = np.repeat(np.arange(len(rows)), counts)
    inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = base[owner] + inner
    rank = suffix_classes(data, starts, length)
    by_text = sorted(range(len(rows)), key=lambda i: (rows[i].order_id, rows[i].key, rows[i].first))
    turn = np.empty(len(rows), np.int64)
    turn[by_text] = np.arange(len(rows))
    # Contexts of one text overlap in bytes but not in starts, so this is the order of places.
    earlier, later = matches(rank, turn[owner] * (1 << 32) + inner)
    gone = earlier if first_stays else earlier | later
    edge = np.flatnonzero(gone & ~np.concatenate([[False], gone[:-1] & (owner[1:] == owner[:-1])]))
    stop = np.flatnonzero(gone & ~np.concatenate([gone[1:] & (owner[1:] == owner[:-1]), [False]]))
    out = [(rows[o].key, rows[o].n_bytes, int(rows[o].first + a), int(rows[o].first + b + length), None, None) for o, a, b in zip(owner[edge], inner[edge], inner[stop])]
    if rows[0].pile >= 0:
        hashes = Rolling(data)(starts, starts + length).view(np.int64)
        for i in np.flatnonzero(~earlier).tolist():
            r = rows[owner[i]]
            out.append((r.key, r.n_bytes, int(r.first + inner[i]), int(r.first + inner[i]) + length, int(hashes[i]), not bool(later[i])))
    found = pd.DataFrame([x[:4] for x in out], columns=["key", "n_bytes", "start", "stop"])
    # With missing values a plain column of whole numbers would turn into inexact ones.
    return found.assign(string=pd.array([x[4] for x in out], "Int64"), single=pd.array([x[5] for x in out], "boolean"))


def _piles(batches, length: int, first_stays: bool, most: int):
    rows, size, last = [], 0, None
    for pdf in batches:
        for r in pdf.itertuples(index=False):
            group = (r.anchor, r.pile)
            if rows and group != last and (size >= most or (r.pile >= 0 or rows[0].pile >= 0)):
                yield _pile(rows, length, first_stays)
                rows, size = [], 0
            rows.append(r)
            size += len(r.data)
            last = group
    if rows:
        yield _pile(rows, length, first_stays)


def repeated_spans(texts: DataFrame, length: int = LENGTH, gram: int = GRAM, first_stays: bool = True, hot: int = HOT_CONTEXTS) -> DataFrame:
    """``key``, ``n_bytes``, ``spans``: the stretches to remove from each different text (``key``, ``n_bytes``,
    ``order_id``, ``text``; rows of one key hold one text). Order is that of ``order_id``, key and place.

    An anchor with more than ``hot`` different contexts is dealt to several piles; their different strings, one row
    each, are then counted across the piles.
    """
    found = store_table(texts.where(F.col("n_bytes") >= length).select("key", "text").mapInPandas(lambda b: _contexts(b, length, gram), CONTEXTS), "contexts")
    often = found.groupBy("anchor").count().where("count > 1").select("anchor")
    orders = texts.groupBy("key", "n_bytes").agg(F.min("order_id").alias("order_id"))
    # Texts met in several tasks are told apart last: that way the join by anchors stands alone, and a hot anchor is split.
    shared = found.join(often, "anchor").join(orders, ["key", "n_bytes"]).distinct()
    shared = store_table(shared, "shared")
    place = F.struct("order_id", "key", "first")
    kinds = shared.groupBy("anchor", "context").agg(F.count("*").alias("copies"), F.min(place).alias("least"))
    per_anchor = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.count_if(F.col("copies") == 1).alias("alone"))
    settled = kinds.where("copies > 1").select("anchor", "context", "least")
    whole = shared.join(settled, ["anchor", "context"])
    if first_stays:
        whole = whole.where(place != F.col("least"))
    spans = whole.select("key", "n_bytes", F.col("first").alias("start"), (F.col("last") + length).alias("stop"))
    # One copy of each context where an anchor has several.
    open_kinds = kinds.join(per_anchor.where("kinds > 1 and (alone > 0 or {})".format(str(first_stays).lower())), "anchor")
    ranked = open_kinds.select("anchor", "context", F.col("least.key").alias("key"), F.col("least.first").alias("first"), "kinds")
    pile = F.when(F.col("kinds") > hot, F.pmod(F.xxhash64("context"), F.ceil(F.col("kinds") / hot))).otherwise(F.lit(-1)).cast("int")
    wanted = shared.join(ranked, ["anchor", "context", "key", "first"]).select("key", "n_bytes", "order_id", F.struct("anchor", pile.alias("pile"), "first", "last").alias("w"))
    wanted = wanted.groupBy("key", "n_bytes").agg(F.min("order_id").alias("order_id"), F.collect_list("w").alias("wanted"))
    bodies = texts.select("key", "n_bytes", "text").join(wanted, ["key", "n_bytes"])
    cut = bodies.mapInPandas(lambda b: _slices(b, length), "anchor long, pile int, key long, n_bytes long, order_id long, first int, data binary")
    sorted_cut = cut.dropDuplicates(["anchor", "pile", "key", "n_bytes", "first"]).repartition("anchor", "pile").sortWithinPartitions("anchor", "pile", "key", "first")
    laid = store_table(sorted_cut.mapInPandas(lambda b: _piles(b, length, first_stays, PILE_BYTES), FOUND), "matches")
    spans = spans.unionByName(laid.where("string is null").select("key", "n_bytes", "start", "stop"))
    strings = laid.where("string is not null").join(orders, ["key", "n_bytes"])
    at = F.struct("order_id", "key", "start")
    across = strings.groupBy("string").agg(F.count("*").alias("piles"), F.min(at).alias("least")).where("piles > 1")
    late = strings.join(across, "string").where(at != F.col("least") if first_stays else F.col("single"))
    spans = spans.unionByName(late.select("key", "n_bytes", "start", "stop"))
    return spans.groupBy("key", "n_bytes").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


def merged(spans) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["start"], s["stop"]) for s in spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _cut(batches, length: int, first_stays: bool):
    for pdf in batches:
        out = []
        for r in pdf.itertuples(index=False):
            data = r.text.encode()
            spans = [] if r.spans is None else merged(r.spans)
            if r.copies > 1 and len(data) >= length and not (first_stays and r.is_first):
                spans = [(0, len(data))]
            kept = b"".join(data[a:b] for a, b in zip([0, *(b for _, b in spans)], [*(a for a, _ in spans), len(data)]))
            out.append((r.doc_id, len(data), len(data) - len(kept), len(spans), kept))
        yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, first_stays: bool = True, hot: int = HOT_CONTEXTS) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (bytes) for each row.

    With ``first_stays`` the first copy of a repeated string stays, in the order of ids and then of the texts'
    hashes; otherwise no copy does. Null text is empty. Rows that repeat an id with other texts, or have none, are
    rows of their own; rows without one come before all ids. Of rows equal in id and text all are the first copy. Strings are judged on the input.
    """
    texts = text_rows(docs).withColumn("key", F.xxhash64("text")).withColumn("n_bytes", F.octet_length("text").cast("long"))
    keyed = texts.select("key", "n_bytes", F.col("doc_id").alias("order_id"), "text")
    spans = repeated_spans(keyed, length, gram, first_stays, hot)
    copies = keyed.groupBy("key", "n_bytes").agg(F.count("*").alias("copies"), F.min("order_id").alias("order_id"))
    facts = copies.join(spans, ["key", "n_bytes"], "left")
    rows = texts.join(facts, ["key", "n_bytes"]).withColumn("is_first", F.col("doc_id") == F.col("order_id"))
    rows = rows.select("doc_id", "text", "copies", "is_first", "spans")
    return with_null_ids(rows.mapInPandas(lambda b: _cut(b, length, first_stays), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"))


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
