"""Numeric transforms."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import as_col


def parse_money(text: Column | str) -> Column:
    return F.replace(as_col(text), F.lit(","), F.lit("")).try_cast("double")


def charge_sign(amount: Column | str) -> Column:
    return F.signum(F.coalesce(as_col(amount), F.lit(0.0))).cast("int")


def signed_sqrt(x: Column | str, outer: float = 1.0, inner_inter: float = 0.0, inner: float = 1.0) -> Column:
    """Square root of the magnitude on both sides of zero, steepness set by the three factors."""
    c = as_col(x)
    bend = F.sqrt(F.lit(inner_inter) + F.lit(inner) * F.abs(c)) - F.sqrt(F.lit(inner_inter))
    return F.signum(c) * F.lit(outer) * bend


def box_cox(x: Column | str, lam: float = 0.0) -> Column:
    c = as_col(x)
    # The offsets keep zero scores inside the domain.
    if lam == 0:
        return F.log(c + 0.001)
    return (F.pow(c + 0.0001, F.lit(lam)) - 1) / F.lit(lam)


def clamp(x: Column | str, low: float, high: float) -> Column:
    c = as_col(x)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def mask(value: Column | str, condition: Column, replacement: object) -> Column:
    return F.when(condition, F.lit(replacement)).otherwise(as_col(value))


def floor_at_zero(x: Column | str) -> Column:
    """Negative and missing amounts count as zero."""
    c = as_col(x)
    return F.when(c > 0, c).otherwise(0.0)


def rounded(x: Column | str, digits: int) -> Column:
    return F.round(as_col(x), digits)
