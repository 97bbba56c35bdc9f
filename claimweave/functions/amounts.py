"""Repricing rules: which amount a claim line is worth."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import as_col
from .codes import is_present
from ..config import DEFAULTS


def repriced(
    units: Column | str,
    price: Column | str,
    limit: Column | str,
    rule: str = "cap",
    whole_limit: bool = True,
) -> Column:
    """Unit price times limited units, signed like the units.

    ``cap`` limits the units to ``limit`` from above, ``floor`` lifts them to it. A missing
    limit leaves the units as they are.
    """
    pick = {"cap": F.least, "floor": F.greatest}[rule]
    bound = as_col(limit).cast("int") if whole_limit else as_col(limit)
    count = as_col(units)
    return F.signum(count) * as_col(price) * pick(bound.cast("double"), F.abs(count))


def capped_by_charge(amount: Column | str, charge: Column | str) -> Column:
    """The amount while its magnitude is below the charge's; otherwise, or if unknown, the charge."""
    a, c = as_col(amount), as_col(charge)
    return F.when(F.abs(a) < F.abs(c), a).otherwise(c)


def signed_cap(amount: Column | str, charge: Column | str) -> Column:
    a, c = as_col(amount), as_col(charge)
    return F.when(a > c, c).otherwise(a)


def history_amount(
    kind: Column | str,
    ndc: Column | str,
    procedure: Column | str,
    ndc_amount: Column | str,
    procedure_amount: Column | str,
    revenue_amount: Column | str,
    allowed: Column | str,
    charge: Column | str,
) -> Column:
    """Amount of one long code row.

    Diagnoses carry none. A claim with neither drug nor procedure is priced by revenue code;
    any other claim is priced on its procedure row and leaves the revenue row at zero.
    """
    k = as_col(kind)
    only_revenue = ~is_present(ndc) & ~is_present(procedure)
    amount = (
        F.when(k == DEFAULTS.diagnosis_kind, F.lit(0.0))
        .when(only_revenue, F.coalesce(as_col(revenue_amount), as_col(allowed)))
        .when(k == DEFAULTS.revenue_kind, F.lit(0.0))
        .otherwise(F.coalesce(as_col(ndc_amount), as_col(procedure_amount), as_col(allowed)))
    )
    return capped_by_charge(amount, charge)


def target_amount(
    ndc_amount: Column | str,
    procedure_amount: Column | str,
    revenue_amount: Column | str,
    allowed: Column | str,
    charge: Column | str,
) -> Column:
    best = F.coalesce(*[as_col(c) for c in (ndc_amount, procedure_amount, revenue_amount, allowed)])
    return capped_by_charge(best, charge)


def rx_amount(allowed: Column | str, reprice: Column | str, charge: Column | str) -> Column:
    return capped_by_charge(F.coalesce(as_col(allowed), as_col(reprice), F.lit(0.0)), charge)


def rx_vendor_amount(
    allowed: Column | str, days: Column | str, limit: Column | str, price: Column | str
) -> Column:
    return F.coalesce(as_col(allowed), F.least(as_col(days), as_col(limit)) * as_col(price), F.lit(0.0))


def vendor_line_amount(
    debit_cost: Column | str,
    ndc_amount: Column | str,
    procedure_amount: Column | str,
    charge: Column | str,
) -> Column:
    """Debit cost when there is one, else the best price limited by the signed charge."""
    c = as_col(charge)
    best = F.coalesce(as_col(ndc_amount), as_col(procedure_amount), c, F.lit(0.0))
    return F.coalesce(as_col(debit_cost), signed_cap(best, c))


def period_debit_cost(debits: Column | str, times: Column | str) -> Column:
    """129 per debit point, spread over the part of the year the period stands for."""
    t = as_col(times)
    share = F.when(t == 1, 4.0).when(t == 2, 2.0).when(t == 3, 1.0)
    return F.lit(129.0) * as_col(debits) / share
