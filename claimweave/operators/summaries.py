"""Group summaries, counts and profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType, StringType

from .ordering import quantile_row, with_grand_totals, with_group_totals
from ..functions import as_col


def age_sex_counts(people: DataFrame, by: Sequence[str] = (), sex: str = "sex", age: str = "age", adult: int = 18) -> DataFrame:
    grown = F.col(age) >= adult
    return people.groupBy(*by).agg(
        F.count_if(grown & (F.col(sex) == "M")).alias("adult_male"),
        F.count_if(grown & (F.col(sex) == "F")).alias("adult_female"),
        F.count_if(F.col(age) < adult).alias("children"),
    )


def census_summary(census: DataFrame, by: Sequence[str], member: str, factor: str) -> DataFrame:
    return census.groupBy(*by).agg(
        F.count(member).alias("quoted_members"), F.avg(factor).alias("quoted_pfm_rel")
    )


def collapse_names(df: DataFrame, code: str, name: str, carried: Sequence[str] = ()) -> DataFrame:
    """One row per code; codes with more than one name are named by the code."""
    single = F.min(name) == F.max(name)
    return df.groupBy(code).agg(
        F.when(single, F.max(name)).otherwise(F.max(F.col(code))).alias(name),
        *[F.max(c).alias(c) for c in carried],
    )


def mean_and_count(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    aggs = []
    for c in columns:
        aggs += [F.avg(c).alias(f"{c}_mean"), F.count(c).alias(f"{c}_count")]
    return df.groupBy(*by).agg(*aggs)


def group_totals(
    df: DataFrame, by: Sequence[str], member: str, monthly: Sequence[str], flags: Sequence[str], months: int = 12
) -> DataFrame:
    """Member count, months, yearly sums and means of monthly amounts, and members per flag."""
    return df.groupBy(*by).agg(
        F.count(member).alias("counts_mbr"),
        (F.count(F.lit(1)) * months).alias("mths_est"),
        *[F.sum(F.col(c) * months).alias(c.removesuffix("_pmpm")) for c in monthly],
        *[F.avg(c).alias(c) for c in monthly],
        *[F.sum(F.col(c).cast("int")).alias(c) for c in flags],
    )


def mean_of_means(df: DataFrame, inner: Sequence[str], column: str, outer: Sequence[str] = ()) -> DataFrame:
    first = df.groupBy(*inner).agg(F.avg(column).alias("_m"))
    return first.groupBy(*outer).agg(F.avg("_m").alias(f"mean_{column}"))


def sorted_codes(df: DataFrame, by: Sequence[str], arrays: Mapping[str, str]) -> DataFrame:
    """Sorted distinct codes per group from array columns.

    Codes are exploded and made distinct before they are collected, so a hot group holds at most
    one entry per code of the vocabulary.
    """
    long = df.select(
        *by,
        F.explode(
            F.array(*[F.struct(F.lit(n).alias("name"), F.col(c).alias("codes")) for n, c in arrays.items()])
        ).alias("a"),
    ).select(*by, "a.name", F.explode("a.codes").alias("code"))
    once = long.where(F.col("code").isNotNull()).distinct()
    collected = [
        F.coalesce(
            F.array_sort(F.collect_list(F.when(F.col("name") == n, F.col("code")))),
            F.array().cast("array<string>"),
        ).alias(n)
        for n in arrays
    ]
    return once.groupBy(*by).agg(*collected)


def distinct_months(df: DataFrame, by: Sequence[str], year: Column, month: Column, sums: Mapping[str, str]) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count_distinct(year, month).alias("months_enrolled"),
        *[F.sum(c).alias(n) for n, c in sums.items()],
    )


def grand_total(df: DataFrame) -> DataFrame:
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    return df.agg(*[F.sum(c).alias(c) for c in numeric])


def named_agg(df: DataFrame, by: Sequence[str], aggregates: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(*by).agg(*[a.alias(n) for n, a in aggregates.items()])


def freq_table(df: DataFrame, column: str, missing: str = "(missing)") -> DataFrame:
    counted = df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit(missing)).alias(column)).agg(
        F.count(F.lit(1)).alias("n")
    )
    share = with_grand_totals(counted, {"_all": F.sum("n")})
    return share.withColumn("share", F.col("n") / F.col("_all")).drop("_all")


def profile_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per numeric column: count, missing, min, quartiles, mean, max.

    Columns are unpivoted, so one exact distributed quantile pass serves them all.
    """
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], list(columns), "variable", "value")
    basic = long.groupBy("variable").agg(
        F.count("value").alias("n"),
        F.count_if(F.col("value").isNull()).alias("missing"),
        F.min("value").alias("min"),
        F.avg("value").alias("mean"),
        F.max("value").alias("max"),
    )
    quartiles = quantile_row(long, "value", {"q1": 0.25, "median": 0.5, "q3": 0.75}, ["variable"])
    return basic.join(quartiles, "variable", "left")


def profile_categories(df: DataFrame, columns: Sequence[str], missing: str = "(missing)") -> DataFrame:
    """Counts of every value of the text columns, long form."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit(missing)).alias(c) for c in columns]
    long = df.select(*texts).unpivot([], list(columns), "variable", "level")
    return long.groupBy("variable", "level").agg(F.count(F.lit(1)).alias("n"))


def split_by_type(df: DataFrame) -> tuple[list[str], list[str]]:
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return numeric, text


def histogram(df: DataFrame, column: str, bins: int = 20, inner: bool = False) -> DataFrame:
    """Equal-width counts between min and max, or between the 5 % and 95 % quantiles."""
    value = F.col(column)
    rows = df.where(value.isNotNull()).select(value.cast("double").alias(column))
    if inner:
        bounds = quantile_row(rows, column, {"low": 0.05, "high": 0.95})
    else:
        bounds = rows.agg(F.min(column).alias("low"), F.max(column).alias("high"))
    held = rows.withColumn("_b", bounds.select(F.struct("low", "high").alias("b")).scalar())
    inside = held.where(value.between(F.col("_b.low"), F.col("_b.high")))
    width = (F.col("_b.high") - F.col("_b.low")) / F.lit(float(bins))
    index = F.coalesce(F.try_divide(value - F.col("_b.low"), width), F.lit(0.0))
    binned = inside.withColumn("bin", F.least(F.lit(bins), F.floor(index).cast("int") + 1))
    return binned.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))


def weighted_corr(df: DataFrame, x: str, y: str, weight: str | Column, by: Sequence[str] = ()) -> DataFrame:
    """Weighted correlation per group, from deviations from the group's means, which a first pass finds."""
    rows = df.select(*by, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"), as_col(weight).cast("double").alias("_w"))
    rows = rows.where("_x is not null and _y is not null and _w is not null")
    w, a, b = F.col("_w"), F.col("_x"), F.col("_y")
    held = with_group_totals(rows, by, {"_mx": F.sum(w * a) / F.sum(w), "_my": F.sum(w * b) / F.sum(w)})
    dx, dy = a - F.col("_mx"), b - F.col("_my")
    sums = held.groupBy(*by).agg(F.sum(w * dx * dy).alias("_xy"), F.sum(w * dx * dx).alias("_xx"), F.sum(w * dy * dy).alias("_yy"))
    return sums.select(*by, F.try_divide("_xy", F.sqrt(F.col("_xx") * F.col("_yy"))).alias("corr"))


def group_event_risk(
    events: DataFrame, by: Sequence[str], cost: str, members: str, rate: str | None = None, manual_rate: float = 350.0
) -> DataFrame:
    """Event cost of a group relative to its yearly cost at ``rate`` per member and month."""
    level = F.max(rate) if rate else F.lit(manual_rate)
    level = F.coalesce(level, F.lit(manual_rate))
    total = F.sum(cost)
    return events.groupBy(*by).agg(
        total.alias("med_debits"),
        F.max(members).alias("total_members"),
        (total / (12 * level * F.max(members) + F.lit(1e-5))).alias("med_debit_rs"),
    )


def truncated_pmpm(df: DataFrame, by: Sequence[str], amounts: Mapping[str, str], months: str) -> DataFrame:
    """Sums over summed months; the helper sums do not show in the result."""
    return df.groupBy(*by).agg(
        F.sum(months).alias(months),
        *[F.try_divide(F.sum(c), F.sum(months)).alias(n) for n, c in amounts.items()],
    )


def distinct_count(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct().agg(F.count(F.lit(1)).alias("n"))


def mean_count_by_flag(df: DataFrame, flag: str, columns: Sequence[str]) -> DataFrame:
    return mean_and_count(df, [flag], columns)
