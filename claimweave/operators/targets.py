"""Per-member-per-month targets and the member and customer tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .claims import PERIPHERAL, TARGET_KEYS
from .coverage import GROUP, MEMBER
from .joins import attach, full_outer_coalesce
from ..config import DEFAULTS, Settings
from ..functions import as_col

AMOUNTS = ("total_med_ag_allow_amt", "total_med_allow_amt", "total_rx_ag_allow_amt", "total_rx_allow_amt")


def pmpm(amount: Column | str, months: Column | str) -> Column:
    return F.try_divide(as_col(amount), as_col(months))


def combine_targets(med: DataFrame, rx: DataFrame) -> DataFrame:
    shared = {c: (f"rx_{c}", f"med_{c}") for c in PERIPHERAL}
    return full_outer_coalesce(med, rx, TARGET_KEYS, shared).na.fill(0, list(AMOUNTS))


def target(med: DataFrame, rx: DataFrame) -> DataFrame:
    both = combine_targets(med, rx)
    months = "cov_months_medical"
    priced = F.col("total_med_ag_allow_amt") + F.col("total_rx_ag_allow_amt")
    allowed = F.col("total_med_allow_amt") + F.col("total_rx_allow_amt")
    return both.withColumns(
        {"mbr_mth_ag_cmpl_allow": pmpm(priced, months), "mbr_mth_allow_icob_amt": pmpm(allowed, months)}
    ).drop(*AMOUNTS)


def customer_info(info: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    inside = info.where(F.col("effective_date").between(settings.effective_from, settings.effective_to))
    return inside.na.fill(0, ["comm_rt", "lf_group", "aso_group"])


def join_customer(targets: DataFrame, info: DataFrame) -> DataFrame:
    return attach(targets, info, [GROUP, "effective_date"], how="inner").drop("effective_date")


def member_data(targets: DataFrame, info: DataFrame) -> DataFrame:
    kept = targets.where(F.col("member_level_incl") == 1).select(
        GROUP, MEMBER, "underwriting_date", "effective_date", "hist_mths_avail", "quoted_members",
        "quoted_pfm_rel", "mbr_mth_ag_cmpl_allow",
    )
    return join_customer(kept, info)


def group_pmpm(rows: DataFrame) -> DataFrame:
    """Group means weighted by covered months."""
    months = F.col("cov_months_medical")

    def weighted(column: str) -> Column:
        return F.try_divide(F.sum(F.col(column) * months), F.sum(months))

    carried = (
        "total_members", "quoted_members", "quoted_pfm_rel", "bus_segment_cd", "comm_rt",
        "lf_group", "train_subpartition",
    )
    return rows.groupBy(GROUP, "underwriting_date").agg(
        F.sum(months).alias("total_member_months"),
        weighted("mbr_mth_ag_cmpl_allow").alias("agnostic_claims_pmpm"),
        weighted("mbr_mth_allow_icob_amt").alias("allowed_claims_pmpm"),
        *[F.max(c).alias(c) for c in carried],
    )


def customer_data(targets: DataFrame, info: DataFrame) -> DataFrame:
    return group_pmpm(join_customer(targets.where(F.col("group_level_incl") == 1), info))


def attach_rate(members: DataFrame, rates: DataFrame) -> DataFrame:
    keys = [GROUP, MEMBER, "underwriting_date"]
    return attach(members, rates, keys, ["rate_calibrated"]).na.fill(0, ["rate_calibrated"])
