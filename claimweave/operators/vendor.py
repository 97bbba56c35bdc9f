"""Vendor files: monthly spine, code-level aggregates and debit costs per group and member."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .joins import attach, drug_by_ndc_or_procedure, eligible_claims, exclude_values, keyed_join, month_range_join
from .reshape import melt_codes
from ..config import DEFAULTS, Settings
from ..functions import amounts, codes, numbers
from ..session import store_table

PERSON = ("group_id", "member_id", "underwriting_date", "times")
LINE = (*PERSON, "setting")


def med_lines(claims: DataFrame, groups: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Claim lines inside the month spine, cleaned, with setting and charge sign."""
    near = month_range_join(claims, groups, "from_date", settings.spine_months, settings.first_interval)
    return near.na.fill(0.0, ["units", "charged"]).withColumns(
        {
            "charge_sign": numbers.charge_sign("charged"),
            "setting": codes.claim_setting("revenue_cd", empty_counts=True),
        }
    )


def _unit_amount(lines: DataFrame, prices: DataFrame, code: str, price_code: str, output: str, rule: str) -> DataFrame:
    """Signed unit reprice of vendor lines; the sign is that of the charge."""
    price = prices.select(F.col(price_code).alias("_code"), "allowed_per_unit", "serv_unit_cnt_max")
    held = keyed_join(lines, price, {code: "_code"}, "left")
    pick = {"cap": F.least, "floor": F.greatest}[rule]
    amount = F.col("charge_sign") * F.col("allowed_per_unit") * pick("units", "serv_unit_cnt_max")
    return held.withColumn(output, amount).drop("_code", "allowed_per_unit", "serv_unit_cnt_max")


def priced_procedures(
    lines: DataFrame, ndc_price: DataFrame, cpt_price: DataFrame, drugs: DataFrame, rule: str = "floor"
) -> DataFrame:
    """Lines with a procedure, priced by drug and by procedure, with the drug's debit."""
    rows = lines.where(F.col("proc_cd").isNotNull())
    rows = _unit_amount(rows, ndc_price, "ndc_id", "ndc_id", "ndc_amt", rule)
    rows = _unit_amount(rows, cpt_price, "proc_cd", "hcpcs_cpt4_base_cd1", "cpt_amt", rule)
    columns = ["drug_name", "debits", "plan_yr_dollar", "earliest_period", "latest_period"]
    return drug_by_ndc_or_procedure(rows, drugs, "ndc_id", "proc_cd", columns)


def priced_revenue(lines: DataFrame, rev_price: DataFrame, rule: str = "floor") -> DataFrame:
    """Lines with a revenue code and no procedure."""
    rows = lines.where(F.col("proc_cd").isNull() & F.col("revenue_cd").isNotNull())
    return _unit_amount(rows, rev_price, "revenue_cd", "revenue_cd", "rev_amt", rule)


def rx_lines(claims: DataFrame, groups: DataFrame, ndc_price: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    near = month_range_join(claims, groups, "rx_month", settings.spine_months, settings.first_interval)
    priced = attach(near, ndc_price, ["ndc_id"], ["allowed_per_unit", "serv_unit_cnt_max"])
    amount = amounts.rx_vendor_amount("allowed", "days_supply", "serv_unit_cnt_max", "allowed_per_unit")
    return priced.withColumns(
        {"ag_allow": amount, "allowed": F.coalesce("allowed", F.lit(0.0))}
    ).drop("allowed_per_unit", "serv_unit_cnt_max")


def debit_summary(
    rows: DataFrame, keys: Sequence[str], actual: Column | None = None, override: float | None = None
) -> DataFrame:
    """Debit cost per key.

    Largest debit of each drug, summed over drugs and divided by the rows behind them, times the
    period factor. With ``actual``, only debit costs above the actual amount stay.
    """
    spent = F.sum(actual) if actual is not None else F.lit(0.0)
    drugs = rows.groupBy(*keys, "drug_name").agg(
        F.max("debits").alias("debits"), F.count(F.lit(1)).alias("rows"), spent.alias("actual")
    )
    summed = drugs.groupBy(*keys).agg(
        F.sum("debits").alias("debits"), F.sum("rows").alias("rows"), F.sum("actual").alias("actual")
    )
    cost = amounts.period_debit_cost(F.col("debits") / F.col("rows"), "times")
    priced = summed.withColumn("debit_cost", cost)
    if actual is not None:
        priced = priced.where(F.col("debit_cost") > F.col("actual"))
    if override is not None:
        priced = priced.withColumn("debit_cost", F.lit(float(override)))
    return priced.select(*keys, "debit_cost")


def debit_by_code(rows: DataFrame, cost: DataFrame, keys: Sequence[str], code_columns: Sequence[str]) -> DataFrame:
    """The key's debit cost once per row, summed per code; rows with a null code take no part."""
    whole = rows.where(" and ".join(f"{c} is not null" for c in code_columns))
    counted = whole.groupBy(*keys, *code_columns).agg(F.count(F.lit(1)).alias("_rows"))
    joined = attach(counted, cost, list(keys), ["debit_cost"]).where(F.col("debit_cost").isNotNull())
    return joined.select(*keys, *code_columns, (F.col("debit_cost") * F.col("_rows")).alias("debit_cost"))


def _code_sums(units: str, charge: str) -> list[Column]:
    n = F.count(F.lit(1))
    return [
        n.alias("occurrences"),
        (F.sum(units) / n).alias("units_per_occurrence"),
        F.sum(charge).alias("charge_amt"),
    ]


def procedure_codes(rows: DataFrame, debit: DataFrame, genetic: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    listed = genetic.select(F.col("symp").alias("_symp")).distinct()
    held = keyed_join(
        attach(rows, debit, [*LINE, "proc_cd", "ndc_id"], ["debit_cost"]), listed, {"proc_cd": "_symp"}, "left"
    )
    value = F.when(F.col("_symp").isNotNull(), settings.genetic_code).otherwise(F.col("proc_cd"))
    amount = amounts.vendor_line_amount("debit_cost", "ndc_amt", "cpt_amt", "charged")
    return (
        held.withColumns({"value": value, "_amount": amount})
        .groupBy(*LINE, "value", "ndc_id")
        .agg(*_code_sums("units", "charged"), F.sum("_amount").alias("ag_allow_amt"))
        .withColumn("datatype", F.lit(settings.procedure_kind))
    )


def revenue_codes(rows: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    amount = amounts.signed_cap(F.coalesce("rev_amt", "charged", F.lit(0.0)), "charged")
    return (
        rows.withColumns({"value": codes.clean_revenue("revenue_cd"), "_amount": amount})
        .groupBy(*LINE, "value")
        .agg(*_code_sums("units", "charged"), F.sum("_amount").alias("ag_allow_amt"))
        .withColumns({"datatype": F.lit(settings.revenue_kind), "ndc_id": F.lit("")})
    )


def uncounted_revenue_codes(lines: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Revenue codes of lines priced by procedure: present, but with zero amounts."""
    both = lines.where(F.col("proc_cd").isNotNull() & F.col("revenue_cd").isNotNull())
    zero = {
        "occurrences": F.lit(0).cast("bigint"), "units_per_occurrence": F.lit(0.0), "charge_amt": F.lit(0.0),
        "ag_allow_amt": F.lit(0.0), "datatype": F.lit(settings.revenue_kind), "ndc_id": F.lit(""),
    }
    return both.select(*LINE, codes.clean_revenue("revenue_cd").alias("value")).distinct().withColumns(zero)


def diagnosis_codes(
    lines: DataFrame, icd_map: DataFrame, genetic: DataFrame, diagnoses: Sequence[str], settings: Settings = DEFAULTS
) -> DataFrame:
    """Diagnosis categories and how often they occur; genetic codes are left out before mapping."""
    long = melt_codes(lines, LINE, diagnoses)
    counted = long.groupBy(*LINE, "value").agg(F.count(F.lit(1)).alias("occurrences"))
    kept = exclude_values(counted, "value", genetic, "icd10")
    mapped = attach(kept, icd_map.select(F.col("diag_cd").alias("value"), "prefx_map_id"), ["value"])
    category = F.coalesce("prefx_map_id", F.lit(settings.unknown_category))
    return (
        mapped.groupBy(*LINE, category.alias("value"))
        .agg(F.sum("occurrences").alias("occurrences"))
        .withColumn("datatype", F.lit(settings.diagnosis_kind))
    )


def rx_codes(rows: DataFrame, debit: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    held = attach(rows, debit, [*PERSON, "ndc_id"], ["debit_cost"])
    n = F.count(F.lit(1))
    return (
        held.groupBy(*PERSON, "ndc_id")
        .agg(
            n.alias("occurrences"),
            (F.sum("days_supply") / n).alias("units_per_occurrence"),
            F.sum("allowed").alias("allow_amt"),
            F.sum(F.coalesce("debit_cost", "ag_allow")).alias("ag_allow_amt"),
        )
        .withColumns({"rx_sample": F.lit(settings.rx_code), "datatype": F.lit("rg")})
    )


def in_period(rows: DataFrame) -> DataFrame:
    return rows.where((F.col("times") <= F.col("earliest_period")) & (F.col("times") >= F.col("latest_period")))


def period_debits(
    drug_rows: Sequence[DataFrame],
    diagnosis_rows: DataFrame,
    diag_debits: DataFrame,
) -> DataFrame:
    """Plan-year dollars per group: drugs count once per group, diagnosis groups once per member."""
    key = ["group_id", "underwriting_date"]
    columns = [*key, "times", "drug_name", "plan_yr_dollar", "earliest_period", "latest_period"]
    drugs = drug_rows[0].select(*columns)
    for more in drug_rows[1:]:
        drugs = drugs.unionByName(more.select(*columns))
    rx = in_period(drugs).groupBy(*key, "drug_name").agg(F.max("plan_yr_dollar").alias("d"))
    rx = rx.groupBy(*key).agg(F.sum("d").alias("rx_debits"))
    once = diagnosis_rows.select(*key, "member_id", "times", "value").distinct()
    dx = in_period(once.join(diag_debits, F.col("value") == F.col("diag_cd")))
    dx = dx.groupBy(*key, "member_id", "diag_grouping").agg(F.max("plan_yr_dollar").alias("d"))
    dx = dx.groupBy(*key).agg(F.sum("d").alias("med_debits"))
    both = rx.unionByName(dx, allowMissingColumns=True).na.fill(0.0, ["rx_debits", "med_debits"])
    return both.groupBy(*key).agg(F.sum("med_debits").alias("med_debits"), F.sum("rx_debits").alias("rx_debits"))


def claimants(sources: Sequence[DataFrame], groups: DataFrame, history: int = DEFAULTS.history_months) -> DataFrame:
    """Distinct members with any claim, joined to their group, with a constant history."""
    people = sources[0].select("group_id", "member_id")
    for more in sources[1:]:
        people = people.unionByName(more.select("group_id", "member_id"))
    return attach(people.distinct(), groups, ["group_id"], how="inner").withColumn("hist_mths_avail", F.lit(history))


def _debited(lines: DataFrame, lookups: Mapping[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    procedures = priced_procedures(lines, lookups["ndc_price"], lookups["cpt_price"], lookups["drugs"])
    return procedures, procedures.where(F.col("debits").isNotNull())


def score_inputs_med(
    med: DataFrame, groups: DataFrame, lookups: Mapping[str, DataFrame], diagnoses: Sequence[str], settings: Settings = DEFAULTS
) -> DataFrame:
    """Long medical codes for scoring. The lines inside the spine feed five parts, so they are stored once."""
    lines = store_table(med_lines(med, groups, settings), "med_lines")
    procedures, debited = _debited(lines, lookups)
    debit = debit_by_code(debited, debit_summary(debited, LINE), LINE, ["ndc_id", "proc_cd"])
    return (
        procedure_codes(procedures, debit, lookups["cpt_genetic"], settings)
        .unionByName(revenue_codes(priced_revenue(lines, lookups["rev_price"]), settings))
        .unionByName(uncounted_revenue_codes(lines, settings))
        .unionByName(
            diagnosis_codes(lines, lookups["icd_map"], lookups["icd_genetic"], diagnoses, settings),
            allowMissingColumns=True,
        )
    )


def score_inputs_rx(rx: DataFrame, groups: DataFrame, lookups: Mapping[str, DataFrame], settings: Settings = DEFAULTS) -> DataFrame:
    """Drug codes for scoring; reads no medical line. The drug lines feed three parts and are stored once."""
    lines = store_table(rx_lines(rx, groups, lookups["ndc_price"], settings), "rx_lines")
    debited = lines.join(lookups["drugs"], "ndc_id")
    debit = debit_by_code(debited, debit_summary(debited, PERSON, F.col("ag_allow")), PERSON, ["ndc_id"])
    return rx_codes(lines, debit, settings)


def score_inputs_groups(
    med: DataFrame, rx: DataFrame, groups: DataFrame, lookups: Mapping[str, DataFrame], diagnoses: Sequence[str],
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Groups with the debits of their medical and drug claims."""
    lines = store_table(med_lines(med, groups, settings), "med_lines")
    debited = _debited(lines, lookups)[1]
    rx_debited = rx_lines(rx, groups, lookups["ndc_price"], settings).join(lookups["drugs"], "ndc_id")
    eligible = eligible_claims(lines, lookups["eligible_cpt"])
    debits = period_debits([rx_debited, debited], melt_codes(eligible, LINE, diagnoses), lookups["diag_debits"])
    return attach(groups, debits, ["group_id", "underwriting_date"]).na.fill(0.0, ["med_debits", "rx_debits"])
