"""Cleaning and labelling of codes and categories."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from . import as_col
from ..config import DEFAULTS


def is_present(code: Column | str) -> Column:
    """Neither null nor empty; never null itself."""
    return F.coalesce(as_col(code) != "", F.lit(False))


def claim_setting(revenue: Column | str, empty_counts: bool = False) -> Column:
    """Inpatient when a revenue code is there; ``empty_counts`` tests for null only."""
    c = as_col(revenue)
    present = c.isNotNull() if empty_counts else is_present(c)
    return F.when(present, DEFAULTS.inpatient_code).otherwise(DEFAULTS.outpatient_code)


def clean_ndc(code: Column | str) -> Column:
    """Drug code as eleven digits; null, zero and non-numeric text become null."""
    number = as_col(code).cast("string").try_cast("bigint")
    return F.when(number > 0, F.lpad(number.cast("string"), 11, "0"))


def clean_revenue(code: Column | str) -> Column:
    """Numbers read as ``450.0`` and text alike become four digits."""
    text = F.regexp_replace(as_col(code).cast("string"), r"\.0$", "")
    return F.when(F.length(text) >= 4, text).otherwise(F.lpad(text, 4, "0"))


def clean_icd(code: Column | str) -> Column:
    return F.replace(F.trim(as_col(code)), F.lit("."), F.lit(""))


def strip_prefix_char(code: Column | str) -> Column:
    return F.substring(as_col(code), 2, 2**31 - 1)


def normalize_sex(sex: Column | str, null_as: str = "F") -> Column:
    c = as_col(sex)
    return F.when(c.isNull(), null_as).when(c == "F", "F").otherwise("M")


def subscriber_flag(relation: Column | str) -> Column:
    return F.when(as_col(relation) == DEFAULTS.subscriber_code, 1).otherwise(0)


def value_switch(value: Column | str, cases: Mapping[str, object], default: object = None) -> Column:
    """Vectorised case: first matching key wins, else the default."""
    c = as_col(value)
    chain = None
    for key, result in cases.items():
        chain = F.when(c == key, F.lit(result)) if chain is None else chain.when(c == key, F.lit(result))
    return F.lit(default) if chain is None else chain.otherwise(F.lit(default))


def contains_flag(text: Column | str, part: str) -> Column:
    return F.coalesce(F.contains(F.lower(as_col(text)), F.lit(part.lower())), F.lit(False)).cast("int")


def concat_key(*parts: Column | str, sep: str = "|", null_marker: str = "~") -> Column:
    return F.concat_ws(sep, *[F.coalesce(as_col(p).cast("string"), F.lit(null_marker)) for p in parts])


def code_label(procedure: Column | str, diagnosis: Column | str) -> Column:
    """``CPT: x ICD: y`` with absent codes left out."""
    p, d = as_col(procedure), as_col(diagnosis)
    return F.concat_ws(
        " ",
        F.when(is_present(p), F.concat(F.lit("CPT: "), p)),
        F.when(is_present(d), F.concat(F.lit("ICD: "), d)),
    )
