"""Ranks, running sums, order statistics and group totals without one task per group.

A plain window over a key sends all rows of the key to one task. Here rows are sorted by
range over the whole cluster and stored once. Each sorted slice is then run through in its
order; what it takes over from the slices before is a few numbers, however hot a key is.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..session import computed_once, cut_lineage, store_table

_RANGE = "_range"


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality on all keys: null keys form groups like any other."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def sorted_ranges(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Global sort, stored; ``_range`` numbers the sorted slices."""
    return cut_lineage(df.sort(*order).select("*", F.spark_partition_id().alias(_RANGE)))


def running_sums(
    df: DataFrame,
    order: Sequence[Column | str],
    sums: Mapping[str, Column | str],
    by: Sequence[str] = (),
    totals: bool = False,
) -> DataFrame:
    """Add running totals (current row included) in ``order``, restarted per ``by``.

    ``order`` should be a total order, or ties are broken arbitrarily (though once only). With
    ``totals``, each sum also comes as its group's total, under ``<name>_total``.

    After the sort nothing is shuffled again: each sorted slice tells what it adds to its first and
    last group, and a second pass over the slices adds up from what the slices before left over.
    """
    by = list(by)
    inputs = {f"_in_{name}": F.col(c) if isinstance(c, str) else c for name, c in sums.items()}
    kinds = df.select(*[F.sum(c).alias(n) for n, c in inputs.items()]).schema
    filled = {n: F.coalesce(c.cast(kinds[n].dataType), F.lit(0).cast(kinds[n].dataType)) for n, c in inputs.items()}
    placed = sorted_ranges(df.withColumns(filled), [*by, *order])
    found = placed.select(_RANGE, *by, *inputs).mapInArrow(partial(_slice_ends, by=by, names=list(inputs)), _ends_schema(placed, by, list(inputs)))
    carried, whole = _carried(found.orderBy(_RANGE).toArrow().to_pylist(), by, list(inputs))
    results = [StructField(name, kinds[f"_in_{name}"].dataType) for name in sums]
    schema = StructType([*df.schema.fields, *results])
    summed = placed.mapInArrow(partial(_run_on, by=by, names=list(sums), columns=df.columns, carried=carried), schema)
    if not totals:
        return summed
    if not by:
        return summed.withColumns({f"{n}_total": F.lit(whole.get(f"_in_{n}", 0)).cast(kinds[f"_in_{n}"].dataType) for n in sums})
    last = placed.groupBy(*by).agg(*[F.sum(f"_in_{n}").alias(f"{n}_total") for n in sums])
    return _with_totals(summed, last, by, [f"{n}_total" for n in sums])


def _ends_schema(placed: DataFrame, by: Sequence[str], names: Sequence[str]) -> StructType:
    kind = {f.name: f.dataType for f in placed.schema.fields}
    sides = [StructField(f"{side}_{c}", kind[c]) for side in ("first", "last") for c in [*by, *names]]
    return StructType([StructField(_RANGE, IntegerType()), StructField("groups", LongType()), *sides])


def _starts(batch: pa.RecordBatch, by: Sequence[str]) -> list[int]:
    """Rows of a sorted batch at which a group begins; the first row is one."""
    fresh = np.zeros(batch.num_rows, bool)
    fresh[:1] = True
    for c in by:
        column = batch.column(c)
        codes = column.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False) if column.type != pa.null() else np.zeros(len(column))
        fresh[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(fresh).tolist()


def _values(batch: pa.RecordBatch, name: str) -> np.ndarray:
    column = batch.column(name)
    if pa.types.is_decimal(column.type):
        return np.array(column.to_pylist() or [], object)
    return column.to_numpy(zero_copy_only=False)


def _groups_of(batches: Iterable[pa.RecordBatch], by: Sequence[str], names: Sequence[str]):
    """Runs of rows of one group: the batch, whether the run goes on from the batch before, and its bounds."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        starts = _starts(batch, by)
        keys = [tuple(batch.column(c)[a].as_py() for c in by) for a in (starts[0], starts[-1])]
        bounds = [*starts, batch.num_rows]
        yield batch, last == keys[0] if last is not None else False, bounds, keys, {n: _values(batch, n) for n in names}
        last = keys[1]


def _slice_ends(batches: Iterable[pa.RecordBatch], by: list[str], names: list[str]):
    """One row for a sorted slice: its first and last group with their sums, and how many groups it has."""
    groups, here, schema = 0, None, None
    ends: dict[str, tuple] = {}
    for batch, goes_on, bounds, keys, values in _groups_of(batches, by, names):
        here = batch.column(_RANGE)[0].as_py() if here is None else here
        schema = schema or batch.schema
        for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
            if 0 < k < len(bounds) - 2 and groups:
                groups += 1
                continue
            part = [values[n][a:b].sum() for n in names]
            if k or not goes_on:
                groups += 1
                ends["last"] = (keys[0] if k == 0 else keys[1], part)
            else:
                ends["last"] = (ends["last"][0], [x + y for x, y in zip(ends["last"][1], part)])
            if groups == 1:
                ends["first"] = ends["last"]
    if here is None:
        return
    row = {_RANGE: pa.array([here], pa.int32()), "groups": pa.array([groups], pa.int64())}
    for side in ("first", "last"):
        for c, v in zip([*by, *names], [*ends[side][0], *ends[side][1]]):
            row[f"{side}_{c}"] = pa.array([v], schema.field(c).type)
    yield pa.RecordBatch.from_pydict(row)


def _carried(slices: list[dict], by: Sequence[str], names: Sequence[str]) -> tuple[dict[int, list], dict[str, object]]:
    """What each slice's first group has from the slices before; and the sums of the last group of all."""
    out, key, left = {}, None, None
    for s in slices:
        first, last = (tuple(s[f"{side}_{c}"] for c in by) for side in ("first", "last"))
        sums = {side: [s[f"{side}_{n}"] for n in names] for side in ("first", "last")}
        same = left is not None and key == first
        if same:
            out[s[_RANGE]] = left
        if s["groups"] == 1 and same:
            left = [a + b for a, b in zip(left, sums["first"])]
        else:
            key, left = last, sums["last"]
    return out, dict(zip(names, left or []))


def _run_on(batches: Iterable[pa.RecordBatch], by: list[str], names: list[str], columns: list[str], carried: dict[int, list]):
    """The rows of a sorted slice with their running sums."""
    left = None
    for batch, goes_on, bounds, _, values in _groups_of(batches, by, [f"_in_{n}" for n in names]):
        if left is None:  # the first batch of the slice
            left, goes_on = carried.get(batch.column(_RANGE)[0].as_py()), True
        out = {n: np.empty(batch.num_rows, values[f"_in_{n}"].dtype) for n in names}
        for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
            before = left if k == 0 and goes_on else None
            for j, n in enumerate(names):
                run = values[f"_in_{n}"][a:b].copy()
                if before is not None:
                    run[0] += before[j]
                out[n][a:b] = np.cumsum(run)
        left = [out[n][-1] for n in names]
        added = [pa.array(out[n].tolist() if out[n].dtype == object else out[n], batch.column(f"_in_{n}").type) for n in names]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *added], names=[*columns, *names])


def ranked(df: DataFrame, order: Sequence[Column | str], by: Sequence[str] = (), name: str = "rank") -> DataFrame:
    """Position of each row in ``order`` (1-based) within ``by``."""
    return running_sums(df, order, {name: F.lit(1).cast("bigint")}, by)


def with_group_totals(
    df: DataFrame, by: Sequence[str], aggregates: Mapping[str, Column]
) -> DataFrame:
    """Attach aggregates of each group to its rows.

    The rows are computed once: they are stored unless they are a plain scan. The totals are stored
    too, so their size is known when the join is planned: few groups are broadcast and the rows stay
    where they are, else both sides are shuffled and hot keys split.
    """
    by = list(by)
    if not by:
        return with_grand_totals(df, aggregates)
    held = computed_once(df)
    totals = store_table(held.groupBy(*by).agg(*[a.alias(n) for n, a in aggregates.items()]), "totals")
    keep = [c for c in df.columns if c not in aggregates]
    return _with_totals(held.select(*keep), totals, by, list(aggregates))


def _with_totals(rows: DataFrame, totals: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
    keys = {k: f"_k_{k}" for k in by}
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(keys[k])) for k in by])
    return rows.join(totals.withColumnsRenamed(keys), match).select(*rows.columns, *names)


def with_grand_totals(df: DataFrame, aggregates: Mapping[str, Column]) -> DataFrame:
    """Attach totals over all rows: one aggregated row, read as a scalar subquery.

    The rows are computed once: they are stored unless they are a plain scan.
    """
    held = computed_once(df)
    one = held.agg(F.struct(*[a.alias(n) for n, a in aggregates.items()]).alias("t"))
    keep = [c for c in df.columns if c not in aggregates]
    return held.withColumn("_t", one.scalar()).select(*keep, *[F.col(f"_t.{n}").alias(n) for n in aggregates])


def value_counts(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count(F.lit(1)).alias("_n"))


def _positions(df: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    """Distinct values with the last rank they hold and the group's row count."""
    counts = value_counts(df, column, by)
    ranks = running_sums(counts, [column], {"_upto": "_n"}, by, totals=True)
    return ranks.withColumnRenamed("_upto_total", "_total")


def _holds(rank: Column) -> Column:
    return (F.col("_upto") - F.col("_n") < rank) & (rank <= F.col("_upto"))


def quantile_row(
    df: DataFrame,
    column: str,
    points: Mapping[str, float],
    by: Sequence[str] = (),
    kind: str = "linear",
) -> DataFrame:
    """Exact quantiles, one output column per point and one row per group.

    ``linear`` interpolates between the neighbouring ranks; ``nearest`` takes the rank nearest
    to n*p with halves to the even rank; ``lowest`` takes the smallest value whose share is >= p.
    """
    placed = _positions(df, column, by)
    total = F.col("_total")

    def at(rank: Column) -> Column:
        return F.max(F.when(_holds(rank), F.col(column)))

    outputs = []
    for name, p in points.items():
        if kind == "linear":
            h = (total - 1) * F.lit(float(p))
            low = F.floor(h)
            a, b = at(low + 1), at(F.least(low + 2, total))
            part = F.max(h - low)
            outputs.append((a + (b - a) * part).alias(name))
        elif kind == "nearest":
            h = F.round(total * F.lit(float(p)), 9) - 0.5
            j = F.floor(h)
            rank = F.when((h == j) & (j % 2 == 0), j).otherwise(j + 1)
            outputs.append(at(F.greatest(F.lit(1), F.least(rank, total))).alias(name))
        elif kind == "lowest":
            rank = F.ceil(F.round(total * F.lit(float(p)), 9))
            outputs.append(at(F.greatest(F.lit(1), rank)).alias(name))
        else:
            raise ValueError(f"unknown kind of quantile: {kind}")
    return placed.groupBy(*by).agg(*outputs) if by else placed.agg(*outputs)


def quantile_values(
    df: DataFrame, column: str, probabilities: Sequence[float], kind: str = "linear"
) -> list[float]:
    """Ungrouped quantiles on the driver: as many numbers as probabilities."""
    points = {f"q{i}": p for i, p in enumerate(probabilities)}
    row = quantile_row(df, column, points, kind=kind).first()
    return [float(row[n]) for n in points]


def best_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """The full row that sorts first within each key.

    The engine's group limit keeps one row per key in every task before the shuffle, so a hot key sends as many
    rows as there are tasks; no aggregate carries whole rows.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(first)).where(F.col("_nth") == 1).drop("_nth")
