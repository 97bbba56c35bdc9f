"""Whole-frame projection, cleaning and sampling."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, DateType, TimestampNTZType, TimestampType

from ..config import DEFAULTS


def require_columns(df: DataFrame, names: Sequence[str]) -> None:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def cast_types(df: DataFrame, types: Mapping[str, DataType]) -> DataFrame:
    """Cast the listed columns in one projection and leave the others."""
    wrong = [c for c, t in types.items() if not isinstance(t, DataType)]
    if wrong:
        raise TypeError(f"not a data type for: {', '.join(wrong)}")
    require_columns(df, list(types))
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def rename_cols(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    require_columns(df, list(names))
    return df.withColumnsRenamed(dict(names))


def fill_defaults(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.na.fill(dict(values))


def _columns_of(df: DataFrame, *types: type) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types)]


def instants_to_dates(df: DataFrame) -> DataFrame:
    names = _columns_of(df, TimestampType, TimestampNTZType)
    return df.withColumns({c: F.col(c).cast("date") for c in names}) if names else df


def instants_to_strings(df: DataFrame, date_format: str = "yyyy-MM-dd", time_format: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    changes = {c: F.date_format(c, date_format) for c in _columns_of(df, DateType)}
    changes |= {c: F.date_format(c, time_format) for c in _columns_of(df, TimestampType, TimestampNTZType)}
    return df.withColumns(changes) if changes else df


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def select_columns(
    df: DataFrame,
    prefix: str | None = None,
    regex: str | None = None,
    exclude: Sequence[str] = (),
) -> DataFrame:
    def wanted(name: str) -> bool:
        if name in exclude:
            return False
        if prefix is not None and not name.startswith(prefix):
            return False
        return regex is None or re.search(regex, name) is not None

    return df.select(*[c for c in df.columns if wanted(c)])


def sample_rows(df: DataFrame, key: Sequence[str], n: int, seed: int = 0) -> DataFrame:
    """``n`` rows in the order of a hash of their key: the same rows on every run."""
    draw = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(str(seed))))
    return df.orderBy(draw, *key).limit(n)


def keep_sources(
    df: DataFrame,
    source: str,
    inpatient: bool = True,
    outpatient: bool = True,
    rx: bool = True,
    settings=DEFAULTS,
) -> DataFrame:
    switches = {
        settings.inpatient_code: inpatient,
        settings.outpatient_code: outpatient,
        settings.rx_code: rx,
    }
    dropped = [code for code, on in switches.items() if not on]
    return df.where(~F.coalesce(F.col(source).isin(dropped), F.lit(False))) if dropped else df


def drop_null_rows(df: DataFrame, how: str = "all", subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(how=how, subset=list(subset) if subset else None)


def exceeds_group(counts: str = "_counts") -> Column:
    """True when a rule row needs more people of a kind than its group has, or is not for display."""
    kinds = ("adult_male", "adult_female", "children")
    short = [F.coalesce(F.col(k) > F.coalesce(F.col(f"{counts}.{k}"), F.lit(0)), F.lit(False)) for k in kinds]
    return short[0] | short[1] | short[2] | F.coalesce(F.col("display_flag") == "N", F.lit(False))


def with_people_counts(df: DataFrame, counts: DataFrame, by: Sequence[str] = (), output: str = "_counts") -> DataFrame:
    """Attach the people counts of the row's group; without ``by``, of the one-row ``counts``."""
    people = F.struct("adult_male", "adult_female", "children")
    if not by:
        return df.withColumn(output, counts.select(people.alias("c")).scalar())
    side = counts.select(*[F.col(k).alias(f"_g_{k}") for k in by], people.alias(output))
    match = F.lit(True)
    for k in by:
        match = match & F.col(k).eqNullSafe(F.col(f"_g_{k}"))
    return df.join(side, match, "left").drop(*[f"_g_{k}" for k in by])


def hide_small_cells(
    df: DataFrame,
    counts: DataFrame,
    labels: Sequence[str],
    by: Sequence[str] = (),
    placeholder: object = DEFAULTS.hidden_label,
) -> DataFrame:
    """Replace labels whose rule asks for more people than the group holds."""
    held = with_people_counts(df, counts, by)
    return held.withColumns(
        {c: F.when(exceeds_group(), F.lit(placeholder)).otherwise(F.col(c)) for c in labels}
    ).drop("_counts")
