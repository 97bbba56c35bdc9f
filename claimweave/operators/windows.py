"""Per-group shares, detection spans, most frequent codes and quantile bins.

Shares and spans need group totals only, so they aggregate and join rather than open a window
over the group; ranks and cumulative curves go through the range-sorted ``running_sums``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .ordering import best_rows, quantile_row, ranked, running_sums, with_group_totals
from ..functions import as_col


def detection_span(rows: DataFrame, by: Sequence[str], months: str) -> DataFrame:
    """First (largest) and last (smallest) months before underwriting, on every row."""
    return with_group_totals(rows, by, {"last_detected": F.min(months), "first_detected": F.max(months)})


def most_frequent(rows: DataFrame, by: Sequence[str], code: str, output: str = "mode_code") -> DataFrame:
    """The code seen most often per group; ties go to the smallest code."""
    counted = rows.where(F.col(code).isNotNull()).groupBy(*by, code).agg(F.count(F.lit(1)).alias("_n"))
    top = best_rows(counted, by, [-F.col("_n"), F.col(code)])
    return top.select(*by, F.col(code).alias(output))


def shares_of_group(
    rows: DataFrame, by: Sequence[str], shares: Mapping[str, str], eps: float = 0.01, bounded: bool = False
) -> DataFrame:
    """Share of each amount in its group total; ``shares`` maps output to amount column.

    ``bounded`` says that a group has few rows by construction (say, one per code of a
    vocabulary); a plain window then saves the second read of ``rows``.
    """
    totals = {f"_t_{n}": F.sum(c) for n, c in shares.items()}
    if bounded:
        group = Window.partitionBy(*by)
        held = rows.withColumns({n: total.over(group) for n, total in totals.items()})
    else:
        held = with_group_totals(rows, by, totals)
    parts = {n: F.col(c) / (F.col(f"_t_{n}") + F.lit(eps)) for n, c in shares.items()}
    return held.withColumns(parts).drop(*totals)


def share_of_group(rows: DataFrame, by: Sequence[str], amount: str, output: str, eps: float = 0.01) -> DataFrame:
    return shares_of_group(rows, by, {output: amount}, eps)


def prediction_share(rows: DataFrame, by: Sequence[str], prediction: str, output: str, eps: float = 0.01) -> DataFrame:
    held = with_group_totals(rows, by, {"_total": F.sum(prediction)})
    share = (F.col(prediction) + F.lit(eps)) / (F.col("_total") + F.lit(eps))
    return held.withColumn(output, share).drop("_total")


def lorenz_curve(
    rows: DataFrame, prediction: str, actual: str, weight: Column | str, by: Sequence[str] = ()
) -> DataFrame:
    """Cumulative weight and cumulative actual over falling predictions.

    Equal predictions are one step of the curve, so rows are first summed per distinct
    prediction; only that much smaller table is sorted.
    """
    w = as_col(weight).cast("double")
    steps = rows.groupBy(*by, prediction).agg(F.sum(w).alias("w"), F.sum(w * F.col(actual)).alias("wa"))
    summed = running_sums(steps, [F.col(prediction).desc()], {"cum_w": "w", "cum_wa": "wa"}, by, totals=True)
    named = summed.withColumnsRenamed({"cum_w_total": "all_w", "cum_wa_total": "all_wa"})
    return named.withColumns(
        {
            "share_weight": F.try_divide(F.col("cum_w"), F.col("all_w")),
            "share_actual": F.try_divide(F.col("cum_wa"), F.col("all_wa")),
        }
    )


def bin_edges(rows: DataFrame, column: str, bins: int) -> list[float]:
    """Quantile break points with repeated ones merged: ``bins`` + 1 numbers at most."""
    points = {f"e{i}": i / bins for i in range(bins + 1)}
    row = quantile_row(rows, column, points, kind="nearest").first()
    return sorted({float(row[n]) for n in points if row[n] is not None})


def bin_index(value: Column | str, edges: Sequence[float]) -> Column:
    """1-based bin of (edge, edge], the lowest edge included; null outside."""
    v = as_col(value)
    if len(edges) < 2:
        return F.when(v.isNotNull(), 1)
    inside = (v >= edges[0]) & (v <= edges[-1])
    above = F.size(F.filter(F.array(*[F.lit(e) for e in edges[1:-1]]), lambda e: e < v)) if len(edges) > 2 else F.lit(0)
    return F.when(inside, above + 1)


def quantile_bins(rows: DataFrame, column: str, bins: int, output: str = "bin") -> DataFrame:
    return rows.withColumn(output, bin_index(column, bin_edges(rows, column, bins)))


def ranked_by(rows: DataFrame, order: Sequence[Column], by: Sequence[str] = (), output: str = "impact_rank") -> DataFrame:
    return ranked(rows, order, by, output)
