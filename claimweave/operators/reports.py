"""Sorting, limiting, stacking and storing of report rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .ordering import best_rows, ranked


def sorted_report(df: DataFrame, order: Sequence[Column], position: str | None = None) -> DataFrame:
    """Rows in report order; ``position`` adds the row number, so the order survives storage."""
    if position is None:
        return df.orderBy(*order)
    return ranked(df, order, (), position)


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def threshold_rows(df: DataFrame, least: Mapping[str, float]) -> DataFrame:
    """Rows that reach any of the thresholds; a null reaches none."""
    tests = [F.coalesce(F.col(c) >= v, F.lit(False)) for c, v in least.items()]
    return df.where(reduce(lambda a, b: a | b, tests))


def union_by_position(first: DataFrame, second: DataFrame) -> DataFrame:
    return first.unionByName(second.toDF(*first.columns))


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def one_row_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return best_rows(df, keys, order)


def add_results(df: DataFrame, path: str, replace: bool = False) -> DataFrame:
    """Append to (or replace) a stored result table and return the table."""
    df.write.mode("overwrite" if replace else "append").parquet(path)
    return df.sparkSession.read.parquet(path)


def columns_by_key(frames: Mapping[str, DataFrame], keys: Sequence[str], value: str) -> DataFrame:
    """One column per frame, rows aligned by key; frames without the key give null.

    Stacking and one aggregate replace a chain of full outer joins: one shuffle for any number
    of frames.
    """
    stacked = union_by_name(
        [f.select(*keys, F.lit(n).alias("_name"), F.col(value).alias("_value")) for n, f in frames.items()]
    )
    return stacked.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_name") == n, F.col("_value"))).alias(n) for n in frames]
    )
