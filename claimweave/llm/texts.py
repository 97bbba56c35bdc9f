"""Helpers on columns of text: inputs, row keys and NumPy passes over batches of UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

CHUNK = 4 << 20  # bytes of text that one NumPy pass takes at once

_RANDOM = np.random.default_rng(20240607)
#: A random odd number per byte value and per place in a word: word hashes are sums of products.
BYTE_CODE = _RANDOM.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PLACE_CODE = _RANDOM.integers(0, 2**63, 1 << 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fresh(name: str, columns: list[str]) -> str:
    """A column name that none of the columns has, whatever its case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Stands for a missing id within tasks, where a column with missing numbers would lose digits.
NO_ID = -(2**63)


def bounded_batches(spark: SparkSession) -> None:
    """Few rows and bytes in each batch that goes to Python: texts may be long, and tasks share little memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def text_rows(docs: DataFrame, *more: Column) -> DataFrame:
    """Document id, text and the given columns only, so that other columns cannot clash; null text is empty."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *more)


def with_null_ids(found: DataFrame) -> DataFrame:
    return found.withColumn("doc_id", F.nullif(F.col("doc_id"), F.lit(NO_ID)))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(texts: list[bytes], most: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of the list that hold about ``most`` bytes; a longer text stands alone."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > most:
            yield start, i
            start, size = i, 0
        size += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts in one byte array, each followed by a line feed, and where each starts."""
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    starts = np.concatenate([[0], np.cumsum(lengths)])
    return np.frombuffer(b"\n".join(texts) + b"\n", np.uint8), starts


def words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each run of bytes without white space starts, its length and a 64-bit hash of it."""
    solid = ~SPACE[data]
    edge = np.diff(np.concatenate([[False], solid, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return starts, starts, np.empty(0, np.uint64)
    lengths = ends - starts
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(lengths.sum()) - np.repeat(first, lengths)
    codes = BYTE_CODE[data[solid]] * PLACE_CODE[place & 0xFFFF]
    codes ^= codes >> np.uint64(32)
    return starts, lengths, mix(np.add.reduceat(codes, first) + lengths.astype(np.uint64))
