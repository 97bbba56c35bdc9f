"""Language of a text: a small convolutional network over bytes, trained in NumPy, read in fixed windows."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..session import store_table
from .texts import chunks, text_rows, with_null_ids

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 10
TRAIN_DOCS = 800  # of each language that are learnt from at most
TRAIN_ALL = 16_000  # of all languages together; with many languages each has an equal part
TRAIN_WINDOWS = 2  # windows of each of them
EPOCHS = 6
RATE = 0.02
UNKNOWN = "und"
BATCH_WINDOWS = 2048


@dataclass
class ByteNet:
    """Filters of several widths over one-hot bytes, the largest answer of each, and a softmax.

    ``tables[w][j]`` holds each filter's weight for a byte in place j, so a filter's answer is a sum of look-ups.
    """

    languages: list[str]
    tables: list[list[np.ndarray]]
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def answers(self, data: np.ndarray) -> list[np.ndarray]:
        found = []
        for group in self.tables:
            n = data.shape[1] - len(group) + 1
            total = group[0][data[:, :n]]
            for j in range(1, len(group)):
                total += group[j][data[:, j : j + n]]
            found.append(total)
        return found

    def pooled(self, data: np.ndarray) -> np.ndarray:
        """Largest answers of each window, rectified."""
        best = np.concatenate([a.max(axis=1) for a in self.answers(data)], axis=1)
        return np.maximum(best + self.bias, 0)

    def log_chances(self, data: np.ndarray) -> np.ndarray:
        score = self.pooled(data) @ self.out + self.out_bias
        score -= score.max(axis=1, keepdims=True)
        return score - np.log(np.exp(score).sum(axis=1, keepdims=True))


def windows_of(texts: list[bytes], size: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """All windows of the texts, padded with zero bytes, and the text of each. Whole texts are covered."""
    counts = np.array([max(1, -(-len(t) // size)) for t in texts])
    data = np.zeros(counts.sum() * size, np.uint8)
    at = 0
    for t, c in zip(texts, counts):
        data[at : at + len(t)] = np.frombuffer(t, np.uint8)
        at += c * size
    return data.reshape(-1, size), np.repeat(np.arange(len(texts)), counts)


def train(data: np.ndarray, labels: list[str], epochs: int = EPOCHS, rate: float = RATE, filters: int = FILTERS, seed: int = 7) -> ByteNet:
    """Adam on the cross-entropy. Through the pooling a gradient reaches one place of each filter only."""
    rng = np.random.default_rng(seed)
    languages = sorted(set(labels))
    target = np.searchsorted(languages, labels)
    k, f = len(languages), filters
    draw = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
    net = ByteNet(languages, [[draw(256, f) for _ in range(w)] for w in WIDTHS], np.zeros(f * len(WIDTHS), np.float32), draw(f * len(WIDTHS), k), np.zeros(k, np.float32))
    weights = [t for group in net.tables for t in group] + [net.bias, net.out, net.out_bias]
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(data)), max(1, len(data) // 64)):
            x = data[rows]
            found = net.answers(x)
            places = [a.argmax(axis=1) for a in found]
            best = np.concatenate([np.take_along_axis(a, p[:, None], 1)[:, 0] for a, p in zip(found, places)], axis=1) + net.bias
            hidden = np.maximum(best, 0)
            score = hidden @ net.out + net.out_bias
            chance = np.exp(score - score.max(axis=1, keepdims=True))
            chance /= chance.sum(axis=1, keepdims=True)
            chance[np.arange(len(x)), target[rows]] -= 1
            chance /= len(x)
            back = (chance @ net.out.T) * (best > 0)
            grads = []
            for g, (group, place) in enumerate(zip(net.tables, places)):
                part = back[:, g * f : (g + 1) * f]
                for j in range(len(group)):
                    grad = np.zeros((256, f), np.float32)
                    seen = np.take_along_axis(x, place + j, axis=1)
                    np.add.at(grad, (seen, np.arange(f)[None, :]), part)
                    grads.append(grad)
            grads += [back.sum(axis=0), hidden.T @ chance, chance.sum(axis=0)]
            step += 1
            for w, g, m, v in zip(weights, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def drawn_texts(docs: DataFrame, most: int, every: int) -> DataFrame:
    """``lang``, ``text`` of at most ``most`` different labelled texts with a letter of each language, by a hash.

    The languages' counts give each a bound of the hash that leaves about twice as many as wanted; only these few
    hashes are ranked. A language of few texts is drawn whole.
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("lang", "text", F.xxhash64("text", "lang").alias("h"))
    counts = rows.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("n"))
    counts = store_table(counts, "languages")
    each = max(1, min(most, every // max(1, counts.count())))
    # Hashes are even numbers of chances: of n texts about 2 * each lie below this share of all.
    share = F.least(F.lit(1.0), (F.lit(2.0) * each + 20) / F.col("n"))
    low = rows.select("lang", "h").join(counts, "lang").where(F.shiftrightunsigned("h", 11) / F.lit(float(2**53)) <= share)
    order = Window.partitionBy("lang").orderBy(F.shiftrightunsigned("h", 11), "h")
    chosen = low.select("lang", "h").distinct().withColumn("k", F.row_number().over(order)).where(F.col("k") <= each).select("lang", "h")
    held = rows.join(F.broadcast(chosen), ["lang", "h"])  # at most `every` pairs of a name and a number
    return held.groupBy("lang", "h").agg(F.min("text").alias("text")).select("lang", "h", "text")


def fit_language(docs: DataFrame, most: int = TRAIN_DOCS, every: int = TRAIN_ALL, each: int = TRAIN_WINDOWS, window: int = WINDOW) -> ByteNet | None:
    """Train on at most ``most`` documents of each language and ``each`` windows of them, at hashed places of the whole text.

    ``docs``: text, lang. Only hashes are ranked; the windows of the drawn texts alone are moved. Returns None where
    no labelled text has a letter.
    """
    room = F.greatest(F.char_length("text") - window // 2, F.lit(1))
    starts = [(F.pmod(F.xxhash64("h", F.lit(k)), room) + 1).cast("int") for k in range(each)]
    cut = F.array(*[F.col("text").substr(s, F.lit(window)) for s in starts])
    parts = drawn_texts(docs, most, every).select("lang", "h", F.posexplode(cut).alias("k", "part")).orderBy("h", "lang", "k").select("lang", "part").toPandas()
    if parts.empty:
        return None
    texts = [p.encode()[:window] for p in parts["part"]]
    return train(windows_of(texts, window)[0], list(parts["lang"]))


def _predict(batches, net: ByteNet | None, window: int):
    for pdf in batches:
        texts = [t.encode() for t in pdf["text"]]
        best, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        for lo, hi in chunks(texts, window * BATCH_WINDOWS) if net else ():
            data, owner = windows_of(texts[lo:hi], window)
            logs = np.zeros((hi - lo, len(net.languages)))
            for at in range(0, len(data), BATCH_WINDOWS):
                np.add.at(logs, owner[at : at + BATCH_WINDOWS], net.log_chances(data[at : at + BATCH_WINDOWS]))
            mean = logs / np.bincount(owner, minlength=hi - lo)[:, None]
            chance = np.exp(mean - mean.max(axis=1, keepdims=True))
            chance /= chance.sum(axis=1, keepdims=True)
            for i, k in enumerate(chance.argmax(axis=1)):
                if has_letter(pdf["text"].iloc[lo + i]):
                    best[lo + i], score[lo + i] = net.languages[k], min(1.0, float(chance[i, k]))
        yield pdf[["doc_id", "held_out"]].assign(lang_pred=best, score=score)


def predict_language(docs: DataFrame, net: ByteNet | None, window: int = WINDOW) -> DataFrame:
    """Language and score of each row (``doc_id``, ``text``, ``held_out``).

    The windows' mean log chances decide; ties go to the first language by name. Text without a letter is ``und``
    with score 0, and so is all text where there was nothing to learn from.
    """
    return with_null_ids(docs.mapInPandas(lambda b: _predict(b, net, window), "doc_id long, held_out boolean, lang_pred string, score double"))


def identify_languages(docs: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """Learn from the labelled documents of the other folds (crc32 of the id as text) and predict all.

    Null text is empty; rows with a null id belong to no fold: not held out, and not learnt from.
    """
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
    net = fit_language(docs.where(fold != held).select("text", "lang"))
    rows = text_rows(docs, F.coalesce(fold == held, F.lit(False)).alias("held_out"))
    return predict_language(rows, net)
