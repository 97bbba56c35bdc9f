"""Date and month arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import as_col
from ..config import DEFAULTS


def parse_date_key(key: Column | str) -> Column:
    """``yyyyMMdd`` integer key to date; text that is no date becomes null."""
    return F.try_to_timestamp(as_col(key).cast("string"), F.lit("yyyyMMdd")).cast("date")


def parse_plan_month(text: Column | str) -> Column:
    """``ddMMMyyyy`` text to the first day of its month."""
    return first_of_month(F.to_date(as_col(text), "ddMMMyyyy"))


def first_of_month(day: Column | str) -> Column:
    return F.trunc(as_col(day), "MM")


def underwriting_date(effective: Column | str, lead: int = DEFAULTS.underwriting_lead_months) -> Column:
    return F.add_months(as_col(effective), -lead)


def months_before(reference: Column | str, day: Column | str) -> Column:
    """Whole months, rounded up, from ``day`` to ``reference``."""
    return F.ceil(F.months_between(as_col(reference), as_col(day))).cast("int")


def calendar_month_diff(day: Column | str, reference: Column | str) -> Column:
    """Calendar months from ``day`` to ``reference``, the days as a fraction of a mean month."""
    a, b = as_col(day), as_col(reference)
    return (
        (F.year(b) - F.year(a)) * 12.0
        + (F.month(b) - F.month(a))
        + (F.dayofmonth(b) - F.dayofmonth(a)) / F.lit(DEFAULTS.days_per_month)
    )


def fixed_month_diff(day: Column | str, reference: Column | str) -> Column:
    return F.datediff(as_col(reference), as_col(day)) / F.lit(30.0)


def month_index(last_day: Column | str, day: Column | str) -> Column:
    """1 for the month of ``last_day``, 2 for the month before it, and so on."""
    a, b = as_col(last_day), as_col(day)
    return (F.year(a) - F.year(b)) * 12 + F.month(a) - F.month(b) + 1


def times_bucket(months: Column | str) -> Column:
    """1 for months 1-3, 2 for 4-9, 3 for all else, nulls included."""
    m = as_col(months)
    return F.when(m.between(1, 3), 1).when(m.between(4, 9), 2).otherwise(3)


def times_bucket_from(months: Column | str, first_interval: int = DEFAULTS.first_interval) -> Column:
    m = as_col(months)
    return F.when(m >= first_interval + 7, 3).when(m > first_interval, 2).otherwise(1)


def detection_range(months: Column | str) -> Column:
    m = as_col(months)
    return (
        F.when(m < 4, "0-3 Months to UW").when(m < 12, "4-12 Months to UW").otherwise("13+ Months to UW")
    )


def detection_rank(label: Column | str) -> Column:
    """Sort key of ``detection_range``: the most recent range is the highest."""
    c = as_col(label)
    return F.when(c.startswith("0-3"), 3).when(c.startswith("4-12"), 2).when(c.startswith("13+"), 1)


def age_at(day: Column | str, birth: Column | str, clip: bool = True) -> Column:
    years = F.floor(F.datediff(as_col(day), as_col(birth)) / F.lit(DEFAULTS.days_per_year)).cast("int")
    return F.when(years > 0, years).otherwise(0) if clip else years


def batch_month(batch: Column | str) -> Column:
    """First day of the month named by the leading ``yyyyMM`` of a batch label."""
    return F.to_date(F.concat(F.substring(as_col(batch), 1, 6), F.lit("01")), "yyyyMMdd")


def month_end(text: Column | str) -> Column:
    """``yyyyMMdd`` is taken as it is, ``yyyyMM`` becomes the last day of that month."""
    s = as_col(text).cast("string")
    return F.when(F.length(s) == 8, F.try_to_timestamp(s, F.lit("yyyyMMdd")).cast("date")).when(
        F.length(s) == 6,
        F.last_day(F.try_to_timestamp(F.concat(s, F.lit("01")), F.lit("yyyyMMdd")).cast("date")),
    )


def history_months(underwriting: Column | str, start: Column | str, most: int = DEFAULTS.history_months) -> Column:
    months = F.months_between(as_col(underwriting), as_col(start)).cast("int")
    return F.when(months.isNotNull(), F.greatest(F.lit(0), F.least(F.lit(most), months)))


def covered_months(
    effective: Column | str,
    start: Column | str,
    end: Column | str,
    plan_year: int = DEFAULTS.plan_year_months,
) -> Column:
    """Whole plan-year months between coverage start and the day after coverage end."""
    eff = as_col(effective)
    upper = F.least(F.date_add(as_col(end), 1), F.add_months(eff, plan_year))
    lower = F.greatest(as_col(start), eff)
    return F.months_between(upper, lower).cast("int")
