"""Long, wide, array and JSON reshaping."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from .joins import attach
from .ordering import ranked
from ..functions import as_col
from ..session import store_table


def melt_codes(df: DataFrame, ids: Sequence[str], columns: Sequence[str], value: str = "value") -> DataFrame:
    long = df.select(*ids, *columns).unpivot(list(ids), list(columns), "_column", value)
    return long.where(F.col(value).isNotNull()).drop("_column")


MOST_LEVELS = 10_000  # a frame of more columns is of no use


def levels_of(df: DataFrame, column: str, most: int = MOST_LEVELS) -> list[str]:
    """Distinct levels in order, for columns that get a column per level. More than ``most`` are an error, found
    without bringing them all to the driver; ``one_hot`` has no such limit."""
    found = df.select(F.col(column).cast("string").alias("l")).where("l is not null").distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"{column} has more than {most} levels")
    return sorted(r.l for r in found)


def dummy_code(df: DataFrame, column: str, levels: Sequence[str] | None = None, prefix: str | None = None, drop: bool = True) -> DataFrame:
    names = levels if levels is not None else levels_of(df, column)
    stem = prefix if prefix is not None else f"{column}_"
    text = F.col(column).cast("string")
    coded = df.withColumns({f"{stem}{v}": F.when(text == v, 1).otherwise(0) for v in names})
    return coded.drop(column) if drop else coded


def level_index(df: DataFrame, column: str) -> DataFrame:
    """``level`` and its ``index`` (from 0, in order): a stored table with a row per distinct level."""
    levels = df.select(F.col(column).cast("string").alias("level")).where("level is not null").distinct()
    return store_table(ranked(levels, ["level"], (), "index").withColumn("index", F.col("index") - 1), "levels")


def one_hot(df: DataFrame, column: str, output: str, index: DataFrame | None = None) -> DataFrame:
    """A sparse vector with a 1 at the place of the row's level; all zero for null and for levels not in ``index``.

    The levels stay a table that is joined to the rows: only their number reaches the driver.
    """
    table = level_index(df, column) if index is None else index
    size = table.agg(F.coalesce(F.max("index") + 1, F.lit(0)).cast("int")).first()[0]
    coder = OneHotEncoder(inputCol="_index", outputCol=output, dropLast=False, handleInvalid="keep")
    # The encoder only needs to know how many levels there are.
    sizes = df.sparkSession.range(max(1, size)).select(F.col("id").cast("double").alias("_index"))
    text = df.withColumn("_text", F.col(column).cast("string"))
    placed = attach(text, table, {"_text": "level"}, ["index"]).withColumn("_index", F.coalesce(F.col("index").cast("double"), F.lit(float(max(1, size)))))
    return coder.fit(sizes).transform(placed.drop("index", "_text")).drop("_index")


def levels_to_columns(df: DataFrame, keys: Sequence[str], column: str, levels: Sequence[str], prefix: str = "") -> DataFrame:
    """One row per key with 1 where the level occurs."""
    present = [
        F.max(F.when(F.col(column) == v, 1).otherwise(0)).alias(f"{prefix}{v}") for v in levels
    ]
    return df.groupBy(*keys).agg(*present)


def any_levels(df: DataFrame, keys: Sequence[str], column: str, levels: Sequence[str], stem: str) -> DataFrame:
    """``levels_to_columns`` plus the number of distinct listed levels and a has-any flag."""
    wide = levels_to_columns(df, keys, column, levels)
    count = sum((F.col(f"`{v}`") for v in levels), F.lit(0))
    return wide.withColumns(
        {f"num_{stem}": count.cast("int"), f"has_{stem}": (count > 0).cast("int")}
    )


def setting_pmpm(df: DataFrame, keys: Sequence[str], setting: str, amount: str, names: Mapping[str, str], months: int = 24) -> DataFrame:
    sums = [
        (F.coalesce(F.sum(F.when(F.col(setting) == v, F.col(amount))), F.lit(0.0)) / months).alias(n)
        for n, v in names.items()
    ]
    return df.groupBy(*keys).agg(*sums)


def align_features(df: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Exactly the listed features: absent or null ones are zero, others are dropped."""
    have = set(df.columns)
    return df.select(
        *keys,
        *[(F.coalesce(F.col(f"`{c}`"), F.lit(0)) if c in have else F.lit(0)).alias(c) for c in features],
    )


def source_flags(df: DataFrame, keys: Sequence[str], column: str, sources: Mapping[str, str]) -> DataFrame:
    return df.groupBy(*keys).agg(
        *[F.max(F.when(F.col(column) == v, 1).otherwise(0)).alias(n) for n, v in sources.items()]
    )


def multi_hot(codes: Column | str, vocabulary: Sequence[str]) -> Column:
    """0/1 array over a fixed vocabulary."""
    have = as_col(codes)
    return F.transform(
        F.array(*[F.lit(v) for v in vocabulary]),
        lambda v: F.coalesce(F.array_contains(have, v), F.lit(False)).cast("int"),
    )


def columns_to_rows(df: DataFrame, keys: Sequence[str], columns: Sequence[str], value: str = "value") -> DataFrame:
    return df.select(*keys, F.explode(F.array(*[F.col(c) for c in columns])).alias(value))


def _leaves(schema: StructType, path: str = "") -> list[str]:
    names = []
    for field in schema.fields:
        full = f"{path}.{field.name}" if path else field.name
        names += _leaves(field.dataType, full) if isinstance(field.dataType, StructType) else [full]
    return names


def json_schema(df: DataFrame, column: str) -> str:
    """The keys and types that the JSON objects of a column have together; keys of several types are text."""
    found = df.agg(F.schema_of_variant_agg(F.try_parse_json(column)).alias("s")).first()["s"]
    if not found or not found.startswith("OBJECT<"):
        raise ValueError(f"{column} holds no JSON objects: {found}")
    return re.sub(r"\b(VOID|VARIANT)\b", "STRING", found.replace("OBJECT<", "STRUCT<"))


def flatten_json(df: DataFrame, column: str, schema: StructType | str | None = None, prefix: str = "") -> DataFrame:
    """JSON text to columns named by their dotted path; invalid text gives nulls.

    Without a ``schema`` a first pass over the column finds one.
    """
    parsed = df.withColumn("_j", F.from_json(column, json_schema(df, column) if schema is None else schema))
    inner = parsed.schema["_j"].dataType
    flat = [F.col("_j." + ".".join(f"`{p}`" for p in leaf.split("."))).alias(prefix + leaf) for leaf in _leaves(inner)]
    return parsed.select(*df.drop(column).columns, *flat)


def pivot_scenarios(df: DataFrame, key: str, scenario: str, value: str, scenarios: Sequence[str], prefix: str) -> DataFrame:
    picked = [F.max(F.when(F.col(scenario) == s, F.col(value))).alias(f"{prefix}{s}") for s in scenarios]
    return df.groupBy(key).agg(*picked)


def melt_impacts(df: DataFrame, keys: Sequence[str], columns: Sequence[str], position: int = 1) -> DataFrame:
    """Impact columns to rows, with the code taken from the column name."""
    long = df.select(*keys, *columns).unpivot(list(keys), list(columns), "name", "impact")
    return long.withColumn("code", F.split("name", "_")[position])


def stack_code_columns(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    rest = [c for c in df.columns if c not in columns]
    return melt_codes(df, rest, columns, name)
