"""Quality of documents: a linear-chain conditional random field labels each line good or bad."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .texts import LOWER, bounded_batches, chunks, joined, mix, words

TRAIN_DOCS = 4000  # bound of the labelled sample
ROUNDS = 3  # relabelling rounds
STEPS = 150
RATE = 0.05
PENALTY = 1e-3
THRESHOLD = 0.3

LETTER, UPPER, DIGIT, BLANK, MARK, STOP, BAR, HIGH = range(8)
CLASS = np.full(256, MARK, np.uint8)
CLASS[list(range(97, 123))] = LETTER
CLASS[list(range(65, 91))] = UPPER
CLASS[list(range(48, 58))] = DIGIT
CLASS[[9, 11, 12, 13, 32]] = BLANK
CLASS[[ord(c) for c in ".,;:'-"]] = STOP
CLASS[[ord(c) for c in "|/\\<>{}[]=_"]] = BAR
CLASS[128:] = HIGH
#: UTF-8 continuation bytes 0x80-0x9E that follow 0xC3 are capitals of the Latin-1 block.
FEATURES = 16


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of each line, its length, and how many lines each text has. An empty text has one empty line."""
    data, starts = joined(texts)
    ends = np.flatnonzero(data == 10)
    begins = np.concatenate([[0], ends[:-1] + 1])
    size = ends - begins
    line_of_text = np.searchsorted(begins, starts)
    per_text = np.diff(line_of_text)
    kind = CLASS[data].copy()
    high_capital = np.zeros(len(data), bool)
    high_capital[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    kind[high_capital] = UPPER
    kind[ends] = 255
    counts = np.empty((len(size), 8), np.float64)
    for k in range(8):
        counts[:, k] = np.add.reduceat((kind == k).astype(np.int32), begins)
    at, _, hashes = words(data)
    line = np.searchsorted(begins, at, side="right") - 1
    n_words = np.bincount(line, minlength=len(size))
    same = np.zeros(len(at), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1])
    repeats = np.bincount(line, weights=same, minlength=len(size))
    keyed = np.unique(mix(hashes ^ (line.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))), return_index=True)[1]
    distinct = np.bincount(line[keyed], minlength=len(size))
    chars, w = np.maximum(size, 1), np.maximum(n_words, 1)
    last = data[np.maximum(ends - 1, begins)]
    features = np.column_stack(
        [
            np.ones(len(size)),
            counts[:, UPPER] / np.maximum(1, counts[:, LETTER] + counts[:, UPPER] + counts[:, HIGH]),
            counts[:, DIGIT] / chars * 4,
            counts[:, MARK] / chars * 4,
            np.minimum(counts[:, MARK] / w, 3),
            counts[:, STOP] / w * 2,
            counts[:, BAR] / w * 2,
            1 - distinct / w,
            (repeats / w),
            np.minimum(chars / w, 30) / 10,
            np.log1p(size) / 5,
            np.log1p(n_words) / 4,
            (LOWER[last] == ord(".")).astype(float),
            counts[:, BLANK] / chars * 4,
            (counts[:, MARK] + counts[:, BAR] > 0.3 * w).astype(float),
            (size == 0).astype(float),
        ]
    )
    return features, size, per_text


def with_neighbours(features: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Own features, then those of the line before and after in the same text (zeros at the ends)."""
    before, after = np.zeros_like(features), np.zeros_like(features)
    before[1:], after[:-1] = features[:-1], features[1:]
    first = np.cumsum(per_text) - per_text
    before[first] = 0
    after[np.cumsum(per_text) - 1] = 0
    return np.column_stack([features, before, after])


@dataclass
class LineField:
    """Two states, 0 bad and 1 good: ``weights`` of the good state's features, ``moves`` between lines."""

    weights: np.ndarray
    moves: np.ndarray

    def marginals(self, features: np.ndarray, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Chance of good for each line, chances of each move summed, and the summed log normaliser.

        Texts are run side by side, longest first, so that step t handles all texts with more than t lines.
        """
        unary = np.column_stack([np.zeros(len(features)), features @ self.weights])
        order = np.argsort(-per_text, kind="stable")
        lengths = per_text[order]
        first = (np.cumsum(per_text) - per_text)[order]
        alive = [int(np.searchsorted(-lengths, -t, side="left")) for t in range(int(lengths[0]) if len(lengths) else 0)]
        forward, backward = np.empty_like(unary), np.empty_like(unary)
        for t, n in enumerate(alive):
            rows = first[:n] + t
            if t == 0:
                forward[rows] = unary[rows]
            else:
                forward[rows] = unary[rows] + np.logaddexp(forward[rows - 1, :1] + self.moves[0], forward[rows - 1, 1:] + self.moves[1])
        last = np.cumsum(per_text) - 1
        backward[last] = 0
        moved = np.zeros((2, 2))
        norm = np.logaddexp(forward[last, 0], forward[last, 1])
        norm_by_order = norm[order]
        for t in range(len(alive) - 1, 0, -1):
            rows = first[: alive[t]] + t
            ahead = unary[rows] + backward[rows]
            both = forward[rows - 1][:, :, None] + self.moves + ahead[:, None, :]
            moved += np.exp(both - norm_by_order[: alive[t], None, None]).sum(axis=0)
            back = ahead[:, None, :] + self.moves
            backward[rows - 1] = np.logaddexp(back[:, :, 0], back[:, :, 1])
        total = forward + backward
        good = 1 / (1 + np.exp(np.clip(total[:, 0] - total[:, 1], -500, 500)))
        return good, moved, float(norm.sum())


def fit_field(features: np.ndarray, per_text: np.ndarray, labels: np.ndarray, start: LineField | None, steps: int) -> LineField:
    """Adam on the penalised likelihood of the line labels."""
    field = start or LineField(np.zeros(features.shape[1]), np.zeros((2, 2)))
    inner = np.ones(len(labels), bool)
    inner[np.cumsum(per_text) - per_text] = False
    seen = np.zeros((2, 2))
    at = np.flatnonzero(inner)
    np.add.at(seen, (labels[at - 1], labels[at]), 1)
    wanted = features.T @ labels
    values = [field.weights, field.moves]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    for step in range(1, steps + 1):
        good, moved, _ = field.marginals(features, per_text)
        grads = [(wanted - features.T @ good) / len(labels) - PENALTY * field.weights, (seen - moved) / len(labels) - PENALTY * field.moves]
        for v, g, m, s in zip(values, grads, first, second):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            v += RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return field


@dataclass
class QualityModel:
    field: LineField
    slope: float
    shift: float

    def score(self, texts: list[bytes]) -> np.ndarray:
        features, size, per_text = line_features(texts)
        good = self.field.marginals(with_neighbours(features, per_text), per_text)[0]
        return chance(self.slope * weighted_logit(good, size, per_text) + self.shift)


def chance(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def weighted_logit(good: np.ndarray, size: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """The length-weighted mean of the lines' marginals of each text, as log odds."""
    first = np.cumsum(per_text) - per_text
    weight = size + 1.0
    mean = np.add.reduceat(good * weight, first) / np.add.reduceat(weight, first)
    mean = np.clip(mean, 1e-4, 1 - 1e-4)
    return np.log(mean / (1 - mean))


def fit_scale(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the label on the aggregate, by Newton steps."""
    a, b = 1.0, 0.0
    for _ in range(30):
        p = chance(a * x + b)
        g = np.array([((y - p) * x).sum() - 1e-2 * a, (y - p).sum() - 1e-2 * b])
        w = p * (1 - p)
        h = np.array([[(w * x * x).sum() + 1e-2, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-2]])
        step = np.linalg.solve(h, g)
        a, b = a + float(np.clip(step[0], -1, 1)), b + float(np.clip(step[1], -1, 1))
    return a, b


def train_quality(texts: list[bytes], labels: np.ndarray, rounds: int = ROUNDS, steps: int = STEPS) -> QualityModel:
    """Labels belong to documents. Lines of good documents are good; which lines of a bad one are bad is found in
    rounds: at first all, then those that the field finds more bad than good, and its worst line in any case."""
    # Chunk by chunk: the passes over bytes need many times the memory of the text.
    parts = [line_features(texts[a:b]) for a, b in chunks(texts, 1 << 20)]
    features, size, per_text = (np.concatenate(x) for x in zip(*parts))
    features = with_neighbours(features, per_text)
    owner = np.repeat(np.arange(len(texts)), per_text)
    lines = labels[owner].astype(int)
    field = None
    for _ in range(rounds):
        field = fit_field(features, per_text, lines, field, steps)
        good = field.marginals(features, per_text)[0]
        first = np.cumsum(per_text) - per_text
        worst = np.minimum.reduceat(good, first)[owner]
        lines = np.where(labels[owner] == 1, 1, (good > 0.5) & (good > worst)).astype(int)
    good = field.marginals(features, per_text)[0]
    return QualityModel(field, *fit_scale(weighted_logit(good, size, per_text), labels))


def fit_quality(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS) -> QualityModel | None:
    """Train on the documents of at most ``most`` labels (``doc_id``, ``quality``), drawn by a hash of the id among
    those with a document, and their whole texts. Returns None where there are none.

    The labels are drawn first, against ids alone: at most ``most`` of them are broadcast, and no other text is moved.
    """
    drawn = labels.distinct().join(docs.select("doc_id"), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(most)
    body = F.struct(F.coalesce("text", F.lit("")).alias("text"))
    held = docs.select("doc_id", body.alias("body")).join(F.broadcast(drawn), "doc_id")
    seen = held.groupBy("doc_id", "quality").agg(F.min("body").alias("body")).orderBy("doc_id", "quality").select("body.text", "quality").toPandas()
    if seen.empty:
        return None
    return train_quality([t.encode() for t in seen["text"]], (seen["quality"] > 0).to_numpy(int))


def score_quality(docs: DataFrame, model: QualityModel | None, out: str = "score") -> DataFrame:
    """Adds ``out``, the chance of good quality of ``text``; 0.5 where nothing could be learnt. Null text is empty."""

    def score(texts: pd.Series) -> pd.Series:
        held = [t.encode() for t in texts]
        found = np.full(len(held), 0.5)
        for lo, hi in chunks(held) if model else ():
            found[lo:hi] = model.score(held[lo:hi])
        return pd.Series(found)

    bounded_batches(docs.sparkSession)
    return docs.withColumn(out, F.pandas_udf(score, "double")(F.coalesce("text", F.lit(""))))


def learned_quality(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0) -> QualityModel | None:
    """The model learnt from the labels of the other folds (crc32 of the id as text)."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
    known = labels.where(F.col("quality").isNotNull() & (fold != held)).select("doc_id", "quality")
    return fit_quality(docs, known)


def classify_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, folds: int = 5, held: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Labels, language, source and id are no inputs of a score. Null text is empty: one empty line. Repeated rows
    are scored alike; a null id is not held out. A document with several labels is learnt from each of them.
    """
    model = learned_quality(docs, labels, folds, held)
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
    rows = docs.select("doc_id", "text", F.coalesce(fold == held, F.lit(False)).alias("held_out"))
    return score_quality(rows, model).select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
