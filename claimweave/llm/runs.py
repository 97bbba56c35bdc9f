"""Periodic runs of words, by Baier grouping.

The first phase of the suffix sorter groups suffixes by ever longer contexts, highest group first; when it ends, a
suffix's context is the longest Lyndon word that starts there. Done under the order of the words and under the reverse
one, this gives the root of every run: each root is extended to both sides as far as words one period apart agree.

A run of ``least`` words or more holds ``least / 2`` successive words that stand in the text again, so only stretches
covered by such repeats are sorted; the stretches of a batch are laid one after the other, with a word of its own
behind each.
"""

from __future__ import annotations

from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .texts import chunks, mix, text_rows, with_null_ids

LEAST = 12
GAINS = np.random.default_rng(7).integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def lyndon_lengths(codes: np.ndarray) -> np.ndarray:
    """The length of the longest Lyndon word that starts at each place."""
    n = len(codes)
    names, group_of = np.unique(codes, return_inverse=True)
    by_name = np.split(np.argsort(group_of, kind="stable"), np.cumsum(np.bincount(group_of, minlength=len(names)))[:-1])
    members = [m.tolist() for m in by_name]
    group_of = group_of.tolist()
    size = [1] * len(members)
    lower = list(range(-1, len(members) - 1))
    higher = list(range(1, len(members))) + [-1]
    #: Steps to the left over places of finished groups; place 0 stands before the text.
    left = list(range(n + 1))
    group = len(members) - 1
    while group >= 0:
        mine = [i for i in members[group] if group_of[i] == group]
        for i in mine:
            left[i + 1] = i
        hits: dict[int, int] = {}
        for i in mine:
            j = i
            while left[j] != j:
                left[j] = left[left[j]]
                j = left[j]
            left[i + 1] = j
            if j:
                hits[j - 1] = hits.get(j - 1, 0) + 1
        # The suffix before a group's member gains the member's context, once for each that follows it.
        by_times: dict[int, list[int]] = {}
        for j, times in hits.items():
            by_times.setdefault(times, []).append(j)
        for times in sorted(by_times, reverse=True):
            made: dict[int, int] = {}
            for j in by_times[times]:
                old = group_of[j]
                new = made.get(old)
                if new is None:
                    new = made[old] = len(members)
                    members.append([])
                    size.append(size[old] + times * size[group])
                    above = higher[old]
                    higher[old], lower[above] = new, new
                    higher.append(above)
                    lower.append(old)
                members[new].append(j)
                group_of[j] = new
        group = lower[group]
    return np.array(size, np.int64)[group_of]


class Agreement:
    """How far two places agree to the right or to the left, by names of blocks of 1, 2, 4, ... words."""

    def __init__(self, codes: np.ndarray, longest: int):
        self.names = [np.unique(codes, return_inverse=True)[1].astype(np.int32)]
        while 2 << (len(self.names) - 1) <= longest:
            last, step = self.names[-1].astype(np.int64), 1 << (len(self.names) - 1)
            pairs = last[:-step] * (len(codes) + 1) + last[step:]
            self.names.append(np.unique(pairs, return_inverse=True)[1].astype(np.int32))

    def right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of places ``a < b``."""
        found = np.zeros(len(a), np.int64)
        for level in range(len(self.names) - 1, -1, -1):
            name = self.names[level]
            at = np.flatnonzero(b + found < len(name))
            same = at[name[a[at] + found[at]] == name[b[at] + found[at]]]
            found[same] += 1 << level
        return found

    def left(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of the words before places ``a < b``."""
        found = np.zeros(len(a), np.int64)
        for level in range(len(self.names) - 1, -1, -1):
            name, step = self.names[level], 1 << level
            at = np.flatnonzero((a - found >= step) & (b - found - step < len(name)))
            same = at[name[a[at] - found[at] - step] == name[b[at] - found[at] - step]]
            found[same] += step
        return found


def runs(codes: np.ndarray, longest: int, least: int = LEAST) -> np.ndarray:
    """Rows of start, length and smallest period: each run of ``least`` words and two periods or more."""
    agree = Agreement(codes, longest)
    found = []
    for ordered in (codes, -codes):
        place = np.arange(len(codes))
        period = lyndon_lengths(ordered)
        before, after = agree.left(place, place + period), agree.right(place, place + period)
        length = before + period + after
        keep = length >= np.maximum(least, 2 * period)
        found.append(np.stack([(place - before)[keep], length[keep], period[keep]], axis=1))
    return np.unique(np.concatenate(found), axis=0)


def repeated_places(codes: np.ndarray, texts: np.ndarray, width: int) -> np.ndarray:
    """Whether each word is covered by ``width`` successive words that its text has again; ``texts`` numbers the words' texts."""
    covered = np.zeros(len(codes), bool)
    n = len(codes) - width + 1
    if n < 2:
        return covered
    hashes = mix(texts[:n].astype(np.uint64) * GAINS[width])
    for i in range(width):
        hashes += codes[i : n + i].astype(np.uint64) * GAINS[i]
    inside = np.flatnonzero(texts[:n] == texts[width - 1 :])
    order = inside[np.argsort(hashes[inside], kind="stable")]
    same = hashes[order[1:]] == hashes[order[:-1]]
    again = np.zeros(len(codes) + 1, np.int32)
    starts = np.zeros(n, bool)
    starts[order[1:][same]] = True
    starts[order[:-1][same]] = True
    starts = np.flatnonzero(starts)
    np.add.at(again, starts, 1)
    np.add.at(again, starts + width, -1)
    return np.cumsum(again[:-1]) > 0


def batch_runs(words: list[list[bytes]], least: int = LEAST) -> list[list[tuple[int, int, int]]]:
    """The runs of each text's words, by start and period."""
    sizes = np.array([len(w) for w in words], np.int64)
    out: list[list[tuple[int, int, int]]] = [[] for _ in words]
    numbers: dict[bytes, int] = {}
    ticket = count()
    codes = np.concatenate([np.empty(0, np.int64), *(np.fromiter(map(numbers.setdefault, w, ticket), np.int64, len(w)) for w in words)])
    texts = np.repeat(np.arange(len(words)), sizes)
    places = np.flatnonzero(repeated_places(codes, texts, (least + 1) // 2))
    if not len(places):
        return out
    fresh = np.ones(len(places), bool)
    fresh[1:] = (np.diff(places) > 1) | (texts[places[1:]] != texts[places[:-1]])
    stretch = np.cumsum(fresh) - 1
    # One more word, different from all, ends each stretch.
    laid = np.arange(len(places)) + stretch
    total = len(places) + int(stretch[-1]) + 1
    line = np.arange(total) + len(codes) * 2 + 1
    line[laid] = codes[places]
    origin = np.full(total, -1)
    origin[laid] = places
    firsts = np.cumsum(sizes) - sizes
    for start, length, period in runs(line, int(np.bincount(stretch).max()), least).tolist():
        place = origin[start]
        text = int(texts[place])
        out[text].append((int(place - firsts[text]), length, period))
    return out


def kept_words(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run repeats: those outside runs, or among the first period of each run that holds them."""
    if not found:
        return words
    gone = np.zeros(len(words) + 1, np.int32)
    for start, length, period in found:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [w for w, g in zip(words, np.cumsum(gone[:-1]).tolist()) if not g]


def _runs(batches, least: int):
    for pdf in batches:
        texts = [t.encode() for t in pdf["text"]]
        out = []
        for lo, hi in chunks(texts):
            words = [t.split() for t in texts[lo:hi]]
            for own, found in zip(words, batch_runs(words, least)):
                out.append(([dict(zip(("start", "length", "period"), r)) for r in found], b" ".join(kept_words(own, found)).decode()))
        frame = pd.DataFrame(out, columns=["runs", "collapsed"])
        yield frame.assign(doc_id=pdf["doc_id"].to_numpy())


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``doc_id``, ``runs`` (array of start, length and period in words, by start and period) and ``collapsed`` (the
    words that no run repeats, joined by one space) for each row.

    A run is a stretch of words of smallest period q, with ``least`` words and two periods at least, that neither
    neighbour extends. Null, empty and blank texts have no runs and collapse to an empty text. Repeated rows and rows
    without an id are rows of their own; other columns are left out. An empty table gives no rows.
    """
    schema = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return with_null_ids(text_rows(docs).mapInPandas(lambda b: _runs(b, least), schema))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``: of every tenth document by its id's hash, the words from some place on repeat with a
    period. Rows without an id stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    sized = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
    n = F.size("words")
    g = F.floor(F.col("h") / 10)
    sized = sized.withColumns({"n": n, "g": g}).withColumn("a", (F.col("g") % F.nullif(F.col("n"), F.lit(0))).cast("int"))
    sized = sized.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    rest = F.col("n") - F.col("a")
    turns = F.ceil(rest / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), turns)), F.lit(1), rest)
    text = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return sized.select("doc_id", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), text).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """Number of runs, the longest one (ties: smallest start, then period), and digests of all runs and of the collapsed text."""
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("start"), r["period"].alias("period"))))
    with_best = found.withColumn("best", best)
    return with_best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.l")).alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * -best.l div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
