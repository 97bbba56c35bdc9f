"""Medical and drug claims: repricing, long code rows, history and target amounts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .coverage import ACCOUNT, GROUP, MEMBER
from .joins import attach, lookback_filter, plan_year_filter
from ..config import DEFAULTS, Settings
from ..functions import amounts, codes, dates, numbers

MED_DATES = ("serv_from_date", "load_date")
RX_DATES = ("service_date", "process_date")
PERIPHERAL = (
    "cov_months_medical", "hist_mths_avail", "total_members", "quoted_members",
    "quoted_pfm_rel", "member_level_incl", "group_level_incl",
)
TARGET_KEYS = (GROUP, MEMBER, "underwriting_date", "effective_date")


def filter_dates_and_platforms(
    claims: DataFrame,
    platform: str,
    date_columns: Sequence[str],
    first: dt.date,
    last: dt.date,
    platforms: Sequence[str] = DEFAULTS.platforms,
) -> DataFrame:
    keep = F.col(platform).isin(*platforms)
    for d in date_columns:
        keep = keep & F.col(d).between(first, last)
    return claims.where(keep)


def join_line_codes(claims: DataFrame, lines: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return attach(claims, lines, ["medclm_key"], columns)


def unit_reprice(
    claims: DataFrame,
    prices: DataFrame,
    code: str,
    output: str,
    units: str = "serv_unit_cnt",
    rule: str = "cap",
    whole_limit: bool = True,
) -> DataFrame:
    """Add ``output``: the line repriced by the unit price of ``code``, null without a price."""
    priced = attach(claims, prices, [code], ["allowed_per_unit", "serv_unit_cnt_max"])
    amount = amounts.repriced(units, "allowed_per_unit", "serv_unit_cnt_max", rule, whole_limit)
    return priced.withColumn(output, amount).drop("allowed_per_unit", "serv_unit_cnt_max")


def reprice_by_all_codes(claims: DataFrame, ndc: DataFrame, revenue: DataFrame, procedure: DataFrame) -> DataFrame:
    step = unit_reprice(claims, ndc, "ndc_id", "ndc_amt")
    step = unit_reprice(step, revenue, "revenue_cd", "rev_amt")
    return unit_reprice(step, procedure, "hcpcs_cpt4_base_cd1", "cpt_amt")


def _code_row(kind: str, code: Column, when: Column) -> Column:
    return F.when(when, F.struct(F.lit(kind).alias("datatype"), code.alias("value")))


def verticalize(
    claims: DataFrame,
    revenue: str,
    procedure: str,
    ndc: str,
    diagnoses: Sequence[str],
    distinct_codes: bool = False,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """One row per code of a claim, as (datatype, value); claims without codes yield none.

    A drug code without a procedure still yields a procedure row, with the procedure as it is,
    so that the drug amount has a row to sit on.
    """
    proc = F.col(procedure)
    rows = [
        _code_row(settings.revenue_kind, F.col(revenue), codes.is_present(revenue)),
        _code_row(settings.procedure_kind, proc, codes.is_present(procedure) | codes.is_present(ndc)),
        *[_code_row(settings.diagnosis_kind, F.col(d), codes.is_present(d)) for d in diagnoses],
    ]
    codes_of_claim = F.array_distinct(F.array(*rows)) if distinct_codes else F.array(*rows)
    # Exploding first and dropping absent codes as rows stays in generated code, which a filter
    # over the array would leave.
    long = claims.withColumn("_code", F.explode(codes_of_claim)).where(F.col("_code").isNotNull())
    return long.drop(revenue, *diagnoses).select("*", "_code.*").drop("_code")


def _diagnoses_of(lines: DataFrame, settings: Settings) -> list[str]:
    return [c for c in settings.diag_columns if c in lines.columns]


def genetic_list(icd: DataFrame, cpt: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    a = icd.select(F.lit(settings.diagnosis_kind).alias("datatype"), F.col("icd10").alias("value"))
    b = cpt.select(F.lit(settings.procedure_kind).alias("datatype"), F.col("symp").alias("value"))
    return a.unionByName(b).distinct()


def replace_genetic(rows: DataFrame, genetic: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    marked = attach(rows, genetic.withColumn("_hit", F.lit(True)), ["datatype", "value"], ["_hit"])
    return marked.withColumn("value", F.when(F.col("_hit"), settings.genetic_code).otherwise(F.col("value"))).drop("_hit")


def replace_by_category(rows: DataFrame, icd_map: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Diagnosis codes become their category, unknown ones the unknown category."""
    categories = icd_map.select(
        F.lit(settings.diagnosis_kind).alias("datatype"),
        F.col("diag_cd").alias("value"),
        F.col("prefx_map_id").alias("_category"),
    )
    mapped = attach(rows, categories, ["datatype", "value"], ["_category"])
    known = F.when(codes.is_present("_category"), F.col("_category")).otherwise(settings.unknown_category)
    is_diagnosis = F.col("datatype") == settings.diagnosis_kind
    return mapped.withColumn("value", F.when(is_diagnosis, known).otherwise(F.col("value"))).drop("_category")


def aggregate_history(rows: DataFrame, keys: Sequence[str], amount: str = "ag_allow_amt") -> DataFrame:
    summed = rows.groupBy(*keys).agg(F.sum(amount).alias(amount))
    return summed.withColumn(amount, numbers.floor_at_zero(amount))


def med_history(
    claims: DataFrame,
    lines: DataFrame,
    coverage: DataFrame,
    ndc_price: DataFrame,
    rev_price: DataFrame,
    cpt_price: DataFrame,
    genetic: DataFrame,
    icd_map: DataFrame,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Two years of medical claims before underwriting per member, period, setting and code."""
    members = coverage.where(F.col("member_level_incl") == 1).select(GROUP, MEMBER, ACCOUNT, "underwriting_date")
    kept = filter_dates_and_platforms(
        claims, "src_clm_platform_cd", MED_DATES, settings.claim_from, settings.claim_to, settings.platforms
    )
    # The range join removes most lines, so it comes before the code and price lookups.
    near = lookback_filter(kept, members, [MEMBER, ACCOUNT], MED_DATES, settings.history_months)
    timed = near.withColumns(
        {
            "times": dates.times_bucket(dates.months_before("underwriting_date", "serv_from_date")),
            "med_sample": codes.claim_setting("revenue_cd"),
        }
    )
    priced = reprice_by_all_codes(join_line_codes(timed, lines), ndc_price, rev_price, cpt_price)
    diagnoses = ["primary_diag_cd", *_diagnoses_of(priced, settings)]
    rows = verticalize(priced, "revenue_cd", "hcpcs_cpt4_base_cd1", "ndc_id", diagnoses, settings=settings)
    worth = rows.withColumn(
        "ag_allow_amt",
        amounts.history_amount(
            "datatype", "ndc_id", "hcpcs_cpt4_base_cd1", "ndc_amt", "cpt_amt", "rev_amt", "allow_icob_amt", "chrg_amt"
        ),
    )
    keys = [GROUP, MEMBER, "underwriting_date", "times", "med_sample", "datatype", "value"]
    # Codes repeat a lot: sum per raw code first, then map the few codes and sum again.
    raw = worth.groupBy(*keys).agg(F.sum("ag_allow_amt").alias("ag_allow_amt"))
    mapped = replace_by_category(replace_genetic(raw, genetic, settings), icd_map, settings)
    return aggregate_history(mapped, keys)


def rx_priced(claims: DataFrame, ndc_price: DataFrame) -> DataFrame:
    priced = unit_reprice(claims, ndc_price, "ndc_id", "_reprice", "payable_metric_cnt", whole_limit=False)
    amount = amounts.rx_amount("rx_cost", "_reprice", "wac_ingrd_cost_amt")
    return priced.withColumn("ag_allow_amt", amount).drop("_reprice")


def rx_history(
    claims: DataFrame, coverage: DataFrame, ndc_price: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    members = coverage.where(F.col("member_level_incl") == 1).select(GROUP, MEMBER, ACCOUNT, "underwriting_date")
    kept = filter_dates_and_platforms(
        claims, "src_platform_cd", RX_DATES, settings.claim_from, settings.claim_to, settings.platforms
    )
    near = lookback_filter(kept, members, [MEMBER, ACCOUNT], RX_DATES, settings.history_months)
    months = dates.months_before("underwriting_date", "service_date")
    timed = rx_priced(near, ndc_price).withColumn("times", dates.times_bucket(months))
    keys = [GROUP, MEMBER, "underwriting_date", "times", "ndc_id"]
    return aggregate_history(timed, keys).withColumn("rx_sample", F.lit(settings.rx_code))


def aggregate_target(rows: DataFrame, prefix: str, priced: str, allowed: str) -> DataFrame:
    """Member totals of a plan year: two sums, and the coverage columns under a prefix."""
    total = rows.groupBy(*TARGET_KEYS).agg(
        F.sum(priced).alias(f"total_{prefix}_ag_allow_amt"),
        F.sum(allowed).alias(f"total_{prefix}_allow_amt"),
        *[F.max(c).alias(f"{prefix}_{c}") for c in PERIPHERAL],
    )
    first = f"total_{prefix}_ag_allow_amt"
    return total.withColumn(first, numbers.floor_at_zero(first))


def med_target(
    claims: DataFrame,
    lines: DataFrame,
    coverage: DataFrame,
    ndc_price: DataFrame,
    rev_price: DataFrame,
    cpt_price: DataFrame,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    members = coverage.select(*TARGET_KEYS, ACCOUNT, *PERIPHERAL)
    kept = filter_dates_and_platforms(
        claims, "src_clm_platform_cd", MED_DATES, settings.effective_from, settings.claim_to, settings.platforms
    )
    near = plan_year_filter(kept, members, [MEMBER, ACCOUNT], MED_DATES, settings.plan_year_months)
    priced = reprice_by_all_codes(join_line_codes(near, lines, ["ndc_id"]), ndc_price, rev_price, cpt_price)
    amount = amounts.target_amount("ndc_amt", "cpt_amt", "rev_amt", "allow_icob_amt", "chrg_amt")
    return aggregate_target(priced.withColumn("ag_allow_amt", amount), "med", "ag_allow_amt", "allow_icob_amt")


def rx_target(
    claims: DataFrame, coverage: DataFrame, ndc_price: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    members = coverage.select(*TARGET_KEYS, ACCOUNT, *PERIPHERAL)
    kept = filter_dates_and_platforms(
        claims, "src_platform_cd", RX_DATES, settings.effective_from, settings.claim_to, settings.platforms
    )
    near = plan_year_filter(kept, members, [MEMBER, ACCOUNT], RX_DATES, settings.plan_year_months)
    return aggregate_target(rx_priced(near, ndc_price), "rx", "ag_allow_amt", "rx_cost")
