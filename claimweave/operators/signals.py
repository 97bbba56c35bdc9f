"""Event signals, specialty drugs and diagnosis reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .frames import exceeds_group, hide_small_cells, with_people_counts
from .joins import attach, keyed_join, signal_join_any
from .ordering import best_rows, ranked
from .vendor import LINE
from .windows import most_frequent, shares_of_group
from ..config import DEFAULTS, Settings
from ..functions import amounts, as_col, dates

EVENT_KEYS = ("event", "underwriting_date", "group_id", "member_id")
LIKELIHOOD_MONTHS = 17


def latest_signals(claims: DataFrame, rules: DataFrame, diagnoses: Sequence[str]) -> DataFrame:
    """The latest claim behind every signal of a member, before underwriting."""
    before = claims.where(F.col("from_date") < F.col("underwriting_date"))
    matched = signal_join_any(before, rules, "proc_cd", diagnoses)
    order = [-F.unix_date("from_date"), F.col("claim_id"), F.col("proc_cd"), F.col("diag")]
    return best_rows(matched, [*EVENT_KEYS, "cpt_signal", "dx_signal"], order)


def plan_likelihood(since_signal: Column | str, monthly: Sequence[str], tail: str, partial: bool = False) -> Column:
    """Likelihood that falls into the twelve plan months, ``since_signal`` months after the signal."""
    start = as_col(since_signal)
    end = start + F.lit(float(DEFAULTS.plan_year_months))

    def part(i: int) -> Column:
        if partial:
            head = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.lit(float(i + 1)) - start))
            rest = F.least(F.lit(1.0), F.greatest(F.lit(0.0), end - F.lit(float(i))))
            return F.col(monthly[i]) * head * rest
        return F.when((F.lit(i + 1) > start) & (end > F.lit(i)), F.col(monthly[i])).otherwise(0.0)

    total = F.when(end > F.lit(len(monthly)), F.col(tail)).otherwise(0.0)
    for i in range(len(monthly)):
        total = total + part(i)
    return total


def member_event_cost(signals: DataFrame, monthly: Sequence[str], tail: str, partial: bool = False) -> DataFrame:
    """Expected cost of each signal; per event and member the costliest one."""
    since = dates.calendar_month_diff("from_date", "effective_date")
    priced = signals.withColumn("months_since_signal", since).withColumn(
        "event_likelihood", plan_likelihood("months_since_signal", monthly, tail, partial)
    )
    costed = priced.withColumn("event_est_cost", F.col("event_cost") * F.col("event_likelihood"))
    order = [-F.round("event_est_cost", 9), F.col("cpt_signal"), F.col("dx_signal"), F.col("claim_id")]
    return best_rows(costed, EVENT_KEYS, order)


def imminent_events(
    member_events: DataFrame, groups: DataFrame, counts: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    """Report rows of expected events, with hidden labels and the impact on the group score."""
    held = attach(member_events, groups, ["group_id", "underwriting_date"], ["total_members", "pfm_calibrated"])
    yearly = 12 * F.col("pfm_calibrated") * F.col("total_members")
    rows = held.where(F.col("pfm_calibrated").isNotNull()).withColumns(
        {
            "event_label": F.col("event"),
            "signal_label": F.col("signal"),
            "detected": dates.detection_range(dates.calendar_month_diff("from_date", "underwriting_date")),
            "impact": F.round(F.col("event_est_cost") / (yearly + F.lit(1e-5)), settings.impact_decimals),
        }
    )
    hidden = hide_small_cells(rows, counts, ["event_label", "signal_label"], ["group_id"])
    return hidden.select(
        "group_id", "member_id", "underwriting_date", "event_label", "signal_label",
        F.col("from_date").alias("signal_date"), "detected", "event_cost", "event_est_cost", "impact",
    )


def _seen(rows: DataFrame, day: str) -> DataFrame:
    keys = ["group_id", "member_id", "underwriting_date", "drug_name"]
    span = rows.groupBy(*keys).agg(F.min(day).alias("_first"), F.max(day).alias("_last"))
    label = {
        f"{n}_detected": dates.detection_range(dates.calendar_month_diff(f"_{n}", "underwriting_date"))
        for n in ("first", "last")
    }
    return span.withColumns(label).drop("_first", "_last")


def drug_periods(rx: DataFrame, med: DataFrame) -> DataFrame:
    """When each drug was first and last seen, per source."""
    return _seen(rx, "rx_month").unionByName(_seen(med, "from_date"))


def drug_report(
    rx: DataFrame, med: DataFrame, drugs: DataFrame, groups: DataFrame, counts: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    """Specialty drugs of a member: assumed yearly cost, impact and when they were seen."""
    keys = ["group_id", "member_id", "drug_name", "underwriting_date"]
    columns = [*keys, "times", "earliest_period", "latest_period", "plan_yr_dollar"]
    both = rx.select(*columns).unionByName(med.select(*columns))
    assumed = both.groupBy(*[c for c in columns if c != "plan_yr_dollar"]).agg(F.max("plan_yr_dollar").alias("plan_yr_dollar"))
    held = attach(assumed, groups, ["group_id", "underwriting_date"], ["total_members", "pfm_calibrated"])
    ratio = F.round(
        F.col("plan_yr_dollar") / (12 * F.col("total_members") * F.col("pfm_calibrated")), settings.impact_decimals
    )
    recent = (F.col("times") <= F.col("earliest_period")) & (F.col("times") >= F.col("latest_period"))
    impact = held.groupBy(*keys, "plan_yr_dollar").agg(F.max(F.when(recent, ratio)).alias("impact"))
    rules = drugs.groupBy("drug_name").agg(
        *[F.max(c).alias(c) for c in ("adult_male", "adult_female", "children")],
        F.count_if(F.col("display_flag") == "N").alias("_hidden"),
    )
    rules = rules.withColumn("display_flag", F.when(F.col("_hidden") > 0, "N").otherwise("Y")).drop("_hidden")
    joined = impact.join(drug_periods(rx, med), keys).join(rules, "drug_name")
    labelled = hide_small_cells(joined.withColumn("drug_label", F.col("drug_name")), counts, ["drug_label"], ["group_id"])
    kept = labelled.where((F.col("plan_yr_dollar") >= 1000) | (F.col("impact") >= 0.01))
    return kept.select(*keys, "drug_label", "last_detected", "first_detected", "plan_yr_dollar", "impact",
                       F.when(F.col("impact").isNull(), "Lower/Not Detected Recently").alias("impact_note"))


def dated_categories(lines: DataFrame, icd_map: DataFrame, diagnoses: Sequence[str]) -> DataFrame:
    """Diagnosis rows with their category and months before underwriting; unmapped codes drop out."""
    keys = ["group_id", "member_id", "underwriting_date", "from_date"]
    long = lines.select(*keys, *diagnoses).unpivot(keys, list(diagnoses), "_column", "diag").where("diag is not null")
    mapped = long.join(icd_map.select(F.col("diag_cd").alias("diag"), F.col("prefx_map_id").alias("category")), "diag")
    return mapped.withColumn("months", dates.calendar_month_diff("from_date", "underwriting_date")).drop("_column")


def diagnosis_table(
    lines: DataFrame,
    med_codes: DataFrame,
    icd_map: DataFrame,
    prevalence: DataFrame,
    counts: DataFrame,
    diagnoses: Sequence[str],
) -> DataFrame:
    """Conditions of a member with first and last detection and the most frequent code."""
    dated = dated_categories(lines, icd_map, diagnoses)
    span = dated.groupBy("group_id", "member_id", "underwriting_date", "category").agg(
        F.min("months").alias("last_detected"), F.max("months").alias("first_detected")
    )
    modes = most_frequent(dated, ["member_id", "category"], "diag")
    known = med_codes.where(F.col("datatype") == "md").select("group_id", "member_id", F.col("value").alias("category"))
    described = known.distinct().join(prevalence, "category")
    open_rows = with_people_counts(described, counts, ["group_id"])
    masked = open_rows.withColumns(
        {
            "description": F.when(exceeds_group(), F.lit(DEFAULTS.hidden_label)).otherwise(F.col("description")),
            "yearly_cost": F.when(~exceeds_group(), F.col("yearly_cost")),
        }
    ).select("group_id", "member_id", "category", "description", "yearly_cost")
    rows = span.join(modes, ["member_id", "category"]).join(masked, ["group_id", "member_id", "category"])
    return rows.withColumns(
        {f"{n}_range": dates.detection_range(f"{n}_detected") for n in ("first", "last")}
    )


def category_cost_weights(
    procedures: DataFrame,
    revenue: DataFrame,
    debit: DataFrame,
    icd_map: DataFrame,
    diagnoses: Sequence[str],
    eps: float = 0.01,
) -> DataFrame:
    """Cost of each diagnosis category of a member and its share of the member's cost.

    The debit cost of a key applies to each of its lines, summed over the key's codes; it is
    summed before the join, so lines and codes are never paired.
    """
    keys = list(LINE)
    per_key = debit.groupBy(*keys).agg(F.sum("debit_cost").alias("_debit"))
    held = attach(procedures, per_key, keys, ["_debit"])
    cost = amounts.vendor_line_amount("_debit", "ndc_amt", "cpt_amt", "charged")

    def by_category(rows: DataFrame, value: Column, name: str) -> DataFrame:
        part = rows.select(*keys, *diagnoses, value.alias(name))
        long = part.unpivot([*keys, name], list(diagnoses), "_column", "diag_cd").where("diag_cd is not null")
        summed = long.groupBy(*keys, "diag_cd").agg(F.sum(name).alias(name))
        mapped = summed.join(icd_map, "diag_cd")
        return mapped.groupBy(*keys, F.col("prefx_map_id").alias("category")).agg(F.sum(name).alias(name))

    a = by_category(held, cost, "cpt_allowed")
    b = by_category(revenue, F.col("rev_amt"), "rev_allowed")
    stacked = a.unionByName(b, allowMissingColumns=True).groupBy(*keys, "category")
    costs = stacked.agg(
        *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in ("cpt_allowed", "rev_allowed")]
    ).withColumn("combined_allowed", F.col("cpt_allowed") + F.col("rev_allowed"))
    names = ("cpt_allowed", "rev_allowed", "combined_allowed")
    # A key has one row per category, so its rows are few.
    return shares_of_group(costs, keys, {f"weight_{c}": c for c in names}, eps, bounded=True)


def condition_report(
    conditions: DataFrame, impacts: DataFrame, groups: DataFrame, icd_info: DataFrame, counts: DataFrame,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """High-cost conditions per group, ranked by their impact on the group score."""
    priced = conditions.join(impacts, ["group_id", "member_id", "category"])
    joined = attach(priced, groups, ["group_id"], ["pfm_calibrated"], how="inner")
    scored = joined.withColumn(
        "score_impact", F.round(F.col("impact") / F.col("pfm_calibrated"), settings.impact_decimals)
    )
    order = [F.col("score_impact").desc(), F.col("member_id"), F.col("category"), F.col("underwriting_date")]
    placed = ranked(scored, order, ["group_id"], "impact_rank")
    kept = placed.where((F.col("yearly_cost") >= 1000) | (F.col("score_impact") >= 0.01))
    info = icd_info.withColumnRenamed("diag", "mode_code")
    shown = with_people_counts(kept.join(info, "mode_code"), counts, ["group_id"])
    return shown.select(
        "group_id", "description", "last_range", "first_range", "impact_rank",
        F.when(exceeds_group(), "").otherwise(F.col("mode_code")).alias("mode_code"),
        F.when(exceeds_group(), "").otherwise(F.initcap("diag_desc")).alias("mode_description"),
    )


def quarterly_specialty_med(rows: DataFrame, drugs: DataFrame) -> DataFrame:
    """Medical specialty drugs per quarter: amounts and the debit of the drug or procedure."""
    columns = ["drug_name", "debits", "minimum_charge"]
    by_ndc = drugs.select(F.col("ndc_id").alias("_n"), *[F.col(c).alias(f"n_{c}") for c in columns])
    by_proc = drugs.select(F.col("hcpcs").alias("_h"), *[F.col(c).alias(f"h_{c}") for c in columns])
    joined = keyed_join(keyed_join(rows, by_proc, {"proc_cd": "_h"}, "left"), by_ndc, {"ndc_id": "_n"}, "left")
    hit = joined.where(F.coalesce("_n", "_h").isNotNull())
    n = F.count(F.lit(1))
    amount = amounts.vendor_line_amount(F.lit(None), "ndc_amt", "cpt_amt", "charged")
    zero = F.lit(0.0)
    return hit.groupBy("quarter", "group_id", "member_id", "underwriting_date", "proc_cd", "ndc_id", "setting").agg(
        F.max(F.coalesce("n_drug_name", "h_drug_name")).alias("drug_name"),
        n.alias("occurrences"),
        (F.sum("units") / n).alias("units_per_occurrence"),
        F.sum("charged").alias("charge_amt"),
        F.sum(amount).alias("ag_allow_amt"),
        F.max(F.coalesce("n_debits", "h_debits", zero)).alias("debits"),
        F.max("n_debits").alias("ndc_debits"),
        F.max("h_debits").alias("procedure_debits"),
        F.max(F.coalesce("n_minimum_charge", "h_minimum_charge", zero)).alias("minimum_charge"),
    )


def quarterly_specialty_rx(rows: DataFrame, drugs: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    side = drugs.select("ndc_id", "drug_name", "debits", "minimum_charge")
    return rows.join(side, "ndc_id").groupBy("quarter", "group_id", "member_id", "underwriting_date", "ndc_id").agg(
        F.max("drug_name").alias("drug_name"),
        n.alias("occurrences"),
        (F.sum("days_supply") / n).alias("units_per_occurrence"),
        F.sum("allowed").alias("allow_amt"),
        F.sum("ag_allow").alias("ag_allow_amt"),
        F.max("debits").alias("debits"),
        F.max("minimum_charge").alias("minimum_charge"),
    )


def apply_event_debit(groups: DataFrame, events: DataFrame, keys: Sequence[str] = ("group_id", "underwriting_date")) -> DataFrame:
    """Group risk plus the event debit; groups without events add zero."""
    summed = events.groupBy(*keys).agg(F.sum("med_debit_rs").alias("med_debit_rs"))
    held = attach(groups, summed, list(keys), ["med_debit_rs"])
    debit = F.coalesce("med_debit_rs", F.lit(0.0))
    return held.withColumns({"med_debit_rs": debit, "risk_pfm": F.col("risk_pfm") + debit})
