"""Benchmark passages in documents: CGK embedding of item-sized windows, bit-sampling LSH, exact edit distance.

Texts are sequences of lower-case words without ASCII punctuation. A passage is an item with at most ``RATE`` of its
words inserted, removed or replaced. The random walk of Chakraborty, Goldenberg and Koucky maps such edits to few
places of a longer sequence; samples of its places are hash keys, as many as the target recall asks for. The walks of
long texts drift apart, so longer items are cut into short pieces for the keys: of a passage's pieces, one at least
holds no larger share of edits than the whole.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .texts import LOWER, NO_ID, chunks, joined, mix, text_rows, with_null_ids, words

RATE = 0.2
RECALL = 0.995
SAMPLED = 4  # places in a key
PIECE = 16  # words of a piece at most
STEPS = 1.6  # of the walk, for each word
RATIO = 1.15  # of the largest to the smallest piece of one window size
TRIALS, WALKS = 400, 60  # of edited pieces for each kind of edit, and of each of them, when rounds are measured
SIDE_BY_SIDE = 1 << 17  # words of stretches whose edits are counted at once
BLOCK_ITEMS = 4000  # items that a task holds at once; more are matched block by block

CLEAN = LOWER.copy()
CLEAN[[c for c in range(128) if not chr(c).isalnum() and c != 10]] = 32
_RANDOM = np.random.default_rng(4)
ODD = _RANDOM.integers(0, 2**63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BIGRAM = np.uint64(0x9DDFEA08EB382D69)


def edits_allowed(n: int, rate: float) -> int:
    return int(rate * n + 1e-9)


def bigrams(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A hash of each word and the next one of its text; 0 for the last."""
    out = np.zeros(len(hashes), np.uint64)
    out[:-1] = mix(hashes[:-1] * BIGRAM + hashes[1:]) | np.uint64(1)
    ends = bounds[1:] - 1
    out[ends[bounds[1:] > bounds[:-1]]] = 0
    return out


def walk(hashes: np.ndarray, starts: np.ndarray, stops: np.ndarray, steps: int, r: int):
    """The word at each step of the walk with the bits of round ``r``, for all starts at once; 0 behind the stops."""
    at = starts.copy()
    for j in range(steps):
        word = np.where(at < stops, hashes[np.minimum(at, len(hashes) - 1)], np.uint64(0))
        yield word
        at += ((word ^ ODD[(r * 131 + j) & 4095]) * ODD[j & 4095] >> np.uint64(63)).astype(at.dtype)


def walk_key(hashes: np.ndarray, starts: np.ndarray, stops: np.ndarray, steps: int, r: int) -> np.ndarray:
    """A key for each start: the hash of the words at the round's sampled steps."""
    sampled = set(np.random.default_rng((steps, r)).choice(steps, min(SAMPLED, steps), replace=False).tolist())
    key = np.zeros(len(starts), np.uint64)
    for j, word in enumerate(walk(hashes, starts, stops, max(sampled) + 1, r)):
        if j in sampled:
            key = mix(key * BIGRAM + word)
    return key


def edited(n: int, kind: str, k: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """A piece of ``n`` random words, and a text that starts with it after ``k`` edits and has ``n + k`` words."""
    piece, new = (rng.integers(1, 2**63, size, dtype=np.uint64) for size in (n, 2 * n + k))
    at = np.sort(rng.choice(n, k, replace=False))
    if kind == "replace":
        text = piece.copy()
        text[at] = new[:k]
    else:
        text = np.insert(piece, at, new[:k]) if kind == "insert" else np.delete(piece, at)
    return piece, np.concatenate([text, new[k:]])[: n + k]


@lru_cache(maxsize=None)
def repeats(n: int, steps: int, rate: float = RATE, recall: float = RECALL) -> int:
    """Rounds that find a piece of ``n`` words at ``rate`` edits with the target recall, whatever the kind of edit.

    Measured: the share of places that the walks of a piece and its edited text have in common gives each trial's
    chance that a round's key is the same, and rounds are added until the trials' mean recall is reached.
    """
    k = edits_allowed(n, rate)
    if not k:
        return 1
    sampled = min(SAMPLED, steps)
    chance = np.array([math.comb(same, sampled) / math.comb(steps, sampled) for same in range(steps + 1)])
    most = 1
    for kind in ("replace", "insert", "remove"):
        rng = np.random.default_rng(n)
        pieces, texts = (np.concatenate(x) for x in zip(*(edited(n, kind, k, rng) for _ in range(TRIALS))))
        p, q = np.arange(TRIALS) * n, np.arange(TRIALS) * (n + k)
        hit = np.zeros(TRIALS)
        for r in range(WALKS):
            both = zip(walk(pieces, p, p + n, steps, r), walk(texts, q, q + n + k, steps, r))
            hit += chance[sum((a == b).astype(int) for a, b in both)] / WALKS
        missed = 1 - np.maximum(hit, 1e-4)
        while (missed**most).mean() > 1 - recall:
            most += 1
    return most


def edit_distances(items: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewest word edits from each item (a row of words) to any stretch of its text (the same row, 0 behind its end),
    and where the best stretch ends.

    A stretch that reaches behind the end is never nearer than the one that stops there.
    """
    steps = np.arange(texts.shape[1] + 1, dtype=np.int32)
    row = np.zeros((len(texts), len(steps)), np.int32)
    for i in range(items.shape[1]):
        new = np.full_like(row, i + 1)
        np.minimum(row[:, 1:] + 1, row[:, :-1] + (texts != items[:, i, None]), out=new[:, 1:])
        row = np.minimum.accumulate(new - steps, axis=1) + steps
    return row.min(axis=1), row.argmin(axis=1)


def edit_distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    edits, end = edit_distances(item[None], text[None])
    return int(edits[0]), int(end[0])


@dataclass
class SizeClass:
    words: np.ndarray  # of the pieces
    longest: int
    need: int  # bigrams of the benchmark that a piece keeps at least
    steps: int
    keys: list[tuple[np.ndarray, np.ndarray]]  # of each round: sorted keys, and their pieces


class Benchmark:
    """The items of a block, ready to be looked for."""

    def __init__(self, ids: list[int], texts: list[bytes], rate: float, recall: float):
        data, starts = joined(texts)
        at, _, hashes = words(CLEAN[data])
        bounds = np.searchsorted(at, starts)
        self.ids, self.rate = ids, rate
        self.words = [hashes[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        pairs = bigrams(hashes, bounds)
        self.pairs = np.unique(pairs[pairs > 0])
        self.filter = np.zeros(1 << 22, bool)
        self.filter[(self.pairs >> np.uint64(42)).astype(np.int64)] = True
        self.sizes = np.diff(bounds)
        self.allowed = np.array([edits_allowed(n, rate) for n in self.sizes.tolist()], np.int64)
        parts = [(i, k * n // m, (k + 1) * n // m) for i, n in enumerate(self.sizes.tolist()) for m in [-(-n // PIECE)] for k in range(m)]
        self.item, self.offset, stop = np.array(parts, np.int64).reshape(-1, 3).T
        sizes = stop - self.offset
        begin = bounds[self.item] + self.offset
        order = np.argsort(sizes, kind="stable")
        self.classes = []
        while len(order):
            small = int(sizes[order[0]])
            group = order[sizes[order] <= small * RATIO]
            order = order[len(group) :]
            lengths = np.unique(sizes[group]).tolist()
            need = min(n - 1 - 2 * edits_allowed(n, rate) for n in lengths)
            steps = max(1, int(STEPS * small))
            keys = []
            for r in range(max(repeats(n, steps, rate, recall) for n in lengths)):
                key = walk_key(hashes, begin[group], begin[group] + sizes[group], steps, r)
                ranked = np.argsort(key, kind="stable")
                keys.append((key[ranked], group[ranked]))
            held = np.unique(np.concatenate([hashes[a : a + n] for a, n in zip(begin[group], sizes[group])]))
            self.classes.append(SizeClass(held, lengths[-1] + edits_allowed(lengths[-1], rate), max(0, need), steps, keys))

    def known_pairs(self, pairs: np.ndarray) -> np.ndarray:
        """Which bigrams are in the benchmark."""
        likely = np.flatnonzero(self.filter[(pairs >> np.uint64(42)).astype(np.int64)])
        out = np.zeros(len(pairs), bool)
        if len(self.pairs):
            place = np.minimum(np.searchsorted(self.pairs, pairs[likely]), len(self.pairs) - 1)
            out[likely] = self.pairs[place] == pairs[likely]
        return out

    def passages(self, texts: list[bytes]) -> list[tuple[int, int, int, int]]:
        """(text, item, edits, first word of the window) for each passage: the least edits, the first such window."""
        data, starts = joined(texts)
        at, _, hashes = words(CLEAN[data])
        if not len(hashes):
            return []
        bounds = np.searchsorted(at, starts)
        total = np.concatenate([[0], np.cumsum(self.known_pairs(bigrams(hashes, bounds)))])
        ends = np.arange(len(hashes))
        tries: list[np.ndarray] = []
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for c in self.classes:
            held = total[np.minimum(ends + c.longest, len(hashes))] - total[:-1]
            if c.need:
                begin = np.flatnonzero(held >= c.need)
            else:  # items of one word
                begin = np.flatnonzero(np.isin(hashes, c.words))
            if not len(begin):
                continue
            text = np.searchsorted(bounds, begin, side="right") - 1
            stops = np.minimum(bounds[text + 1], begin + c.longest)
            for window, piece in self.hits(c, hashes, begin, stops):
                item, first = self.item[piece], begin[window] - self.offset[piece]
                half = np.maximum(1, self.sizes[item] // 2)
                tries.append(np.column_stack([text[window], item, first // half, first]))
        if not tries:
            return []
        # One test stands for all windows of a mark: it takes the whole stretch that they can reach.
        tried = np.concatenate(tries)
        tried = tried[np.lexsort(tried.T[::-1])]
        tried = tried[np.concatenate([[True], (tried[1:, :3] != tried[:-1, :3]).any(axis=1)])]
        text, item, mark, first = tried.T
        n, allowed = self.sizes[item], self.allowed[item]
        half = np.maximum(1, n // 2)
        lo = np.maximum(bounds[text], mark * half - allowed - 1)
        hi = np.minimum(bounds[text + 1], (mark + 1) * half + n + allowed + 1)
        # The stretch must keep enough word pairs for the whole item, too.
        kept = np.flatnonzero(total[hi] - total[lo] >= n - 1 - 2 * allowed)
        for k, edits in zip(kept.tolist(), self.edits(item[kept], hashes, lo[kept], hi[kept]).tolist()):
            word = max(0, int(first[k] - bounds[text[k]]))
            if edits <= allowed[k] and (edits, word) < best.get((int(text[k]), int(item[k])), (int(n[k]) + 1, 0)):
                best[int(text[k]), int(item[k])] = (edits, word)
        return [(t, i, e, w) for (t, i), (e, w) in sorted(best.items())]

    def edits(self, item: np.ndarray, hashes: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Fewest edits of each item in its stretch of words; items of one length are tested side by side."""
        out = np.empty(len(item), np.int64)
        sizes, wide = self.sizes[item], hi - lo
        order = np.lexsort((wide, sizes))
        while len(order):
            n = sizes[order[0]]
            same = order[: np.searchsorted(sizes[order], n, side="right")]
            same = same[: max(1, SIDE_BY_SIDE // int(wide[same].max()))]
            order = order[len(same) :]
            at = lo[same, None] + np.arange(wide[same].max())
            texts = np.where(at < hi[same, None], hashes[np.minimum(at, len(hashes) - 1)], np.uint64(0))
            out[same] = edit_distances(np.stack([self.words[i] for i in item[same]]), texts)[0]
        return out

    def hits(self, c: SizeClass, hashes: np.ndarray, begin: np.ndarray, stops: np.ndarray):
        """For each round: windows and the pieces with the same key."""
        for r, (known, pieces) in enumerate(c.keys):
            keys = walk_key(hashes, begin, stops, c.steps, r)
            lo = np.searchsorted(known, keys, "left")
            window = np.flatnonzero(known[np.minimum(lo, len(known) - 1)] == keys)
            lo = lo[window]
            count = np.searchsorted(known, keys[window], "right") - lo
            place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            yield np.repeat(window, count), pieces[np.repeat(lo, count) + place]


def _find(batches, block: Benchmark):
    for pdf in batches:
        texts, docs, rows, out = [t.encode() for t in pdf["text"]], pdf["doc_id"], pdf["row"], []
        for lo, hi in chunks(texts):
            for t, item, edits, word in block.passages(texts[lo:hi]):
                out.append((docs.iloc[lo + t], rows.iloc[lo + t], block.ids[item], edits, word))
        yield pd.DataFrame(out, columns=["doc_id", "row", "item_id", "edits", "word"])


def item_blocks(items: DataFrame, size: int):
    """The benchmark's rows, ``size`` at a time; null text is empty, and empty items are nowhere found."""
    ids, texts = [], []
    for r in items.select("item_id", F.coalesce("text", F.lit("")).alias("text")).orderBy("item_id", "text").toLocalIterator():
        ids.append(NO_ID if r["item_id"] is None else r["item_id"])
        texts.append(r["text"].encode())
        if len(ids) == size:
            yield ids, texts
            ids, texts = [], []
    if ids:
        yield ids, texts


def find_passages(docs: DataFrame, items: DataFrame, rate: float = RATE, recall: float = RECALL, block: int = BLOCK_ITEMS) -> DataFrame:
    """``doc_id``, ``row``, ``item_id``, ``edits``, ``word``: each item that each row of ``docs`` (with ``row``) holds.

    A window must keep as many of the benchmark's word pairs as the allowed edits leave to an item: windows with fewer
    cannot hold one and are not embedded. Verification is exact, so nothing else is reported; an item at ``rate``
    edits is found with the target recall, an unedited one always. Each item is reported once for a document.
    """
    schema = "doc_id long, row long, item_id long, edits int, word int"
    found = []
    for ids, texts in item_blocks(items, block):
        held = Benchmark(ids, texts, rate, recall)
        found.append(docs.select("doc_id", "row", "text").mapInPandas(lambda b, held=held: _find(b, held), schema))
    if not found:
        return docs.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, found).withColumn("item_id", F.nullif(F.col("item_id"), F.lit(NO_ID)))


def contaminated(docs: DataFrame, items: DataFrame, rate: float = RATE, recall: float = RECALL) -> DataFrame:
    """``doc_id``, ``item_id``, ``edits``, ``word`` for each benchmark passage in the documents.

    Null text is empty. Repeated rows and null ids are reported as rows of their own.
    """
    rows = text_rows(docs).withColumn("row", F.monotonically_increasing_id())
    return with_null_ids(find_passages(rows, items, rate, recall)).drop("row")
