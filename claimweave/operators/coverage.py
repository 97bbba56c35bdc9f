"""Member coverage: continuous spans, age factors, member and group counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .joins import attach
from ..config import DEFAULTS, Settings
from ..functions import codes, dates
from ..session import store_table

GROUP = "src_rpt_cust_id"
ACCOUNT = "src_cust_id"
MEMBER = "sdr_person_id"


def collapse_coverage(coverage: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One span per member and account: first start, last end, subscriber if ever one."""
    listed = coverage.where(F.col("src_platform_cd").isin(*settings.platforms))
    return listed.groupBy(MEMBER, ACCOUNT).agg(
        F.min("cov_eff_date").alias("cov_eff_date"),
        F.max("cov_end_date").alias("cov_end_date"),
        F.max(codes.subscriber_flag("rel_type_cd")).alias("subscriber_flag"),
    )


def unique_persons(person: DataFrame, settings: Settings = DEFAULTS, null_sex: str = "F") -> DataFrame:
    listed = person.where(F.col("src_platform_cd").isin(*settings.platforms))
    latest = listed.groupBy(MEMBER).agg(F.max("sex_cd").alias("sex_cd"), F.max("birth_date").alias("birth_date"))
    return latest.withColumn("sex_cd", codes.normalize_sex("sex_cd", null_sex))


def unique_crosswalk(crosswalk: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    inside = crosswalk.where(F.col("effective_date").between(settings.effective_from, settings.effective_to))
    return inside.groupBy(ACCOUNT, "effective_date").agg(F.max(GROUP).alias(GROUP))


def account_coverage(crosswalk: DataFrame, coverage: DataFrame) -> DataFrame:
    return crosswalk.join(coverage, ACCOUNT)


def continuous_span(rows: DataFrame) -> DataFrame:
    """Coverage of a member in all accounts of a group counts as one span.

    A member has few accounts, so one shuffle by group and member and a window do; the rows are not computed twice.
    """
    own = Window.partitionBy(GROUP, MEMBER)
    return rows.withColumns(
        {
            "cov_eff_date": F.min("cov_eff_date").over(own),
            "cov_end_date": F.max("cov_end_date").over(own),
            "subscriber_flag": F.max("subscriber_flag").over(own),
        }
    )


def eligible(rows: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    begins = F.add_months("cov_eff_date", -settings.plan_year_months)
    return rows.where(
        F.col("effective_date").between(begins, F.col("cov_end_date")) & codes.is_present(MEMBER)
    )


def expand_age_range(factors: DataFrame) -> DataFrame:
    ages = F.explode(F.sequence(F.col("min_mbr_age").cast("int"), F.col("max_mbr_age").cast("int")))
    return factors.withColumn("age", ages).drop("min_mbr_age", "max_mbr_age")


def factor_by_age(factors: DataFrame) -> DataFrame:
    """One factor per sex, subscriber flag and age: the largest, compared as a number."""
    return (
        expand_age_range(factors)
        .groupBy("sex_cd", F.col("subscriber_ind").cast("int").alias("subscriber_flag"), "age")
        .agg(F.max(F.col("age_gender_factor").cast("double")).alias("age_gender_factor"))
    )


def age_factor_join(members: DataFrame, factors: DataFrame) -> DataFrame:
    aged = members.withColumn("age", dates.age_at("effective_date", "birth_date"))
    return attach(aged, factor_by_age(factors), ["sex_cd", "subscriber_flag", "age"])


def total_members(rows: DataFrame) -> DataFrame:
    return rows.groupBy(GROUP, "effective_date").agg(F.countDistinct(MEMBER).alias("total_members"))


def quoted_members(rows: DataFrame) -> DataFrame:
    """Members covered by the effective date, and their mean age factor."""
    begun = rows.where(F.col("effective_date") >= F.col("cov_eff_date"))
    once = begun.select(GROUP, "effective_date", MEMBER, "age_gender_factor").distinct()
    return once.groupBy(GROUP, "effective_date").agg(
        F.count(MEMBER).alias("quoted_members"), F.avg("age_gender_factor").alias("quoted_pfm_rel")
    )


def with_months(rows: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    uw = dates.underwriting_date("effective_date", settings.underwriting_lead_months)
    return rows.withColumns(
        {
            "underwriting_date": uw,
            "hist_mths_avail": dates.history_months(uw, "cov_eff_date", settings.history_months),
            "cov_months_medical": dates.covered_months(
                "effective_date", "cov_eff_date", "cov_end_date", settings.plan_year_months
            ),
        }
    )


def covered_rows(
    crosswalk: DataFrame, coverage: DataFrame, person: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    """Eligible member rows of every group and effective date, with sex and birth date."""
    known = coverage.where(codes.is_present(MEMBER))
    spans = account_coverage(unique_crosswalk(crosswalk, settings), collapse_coverage(known, settings))
    rows = eligible(continuous_span(spans), settings)
    return attach(rows, unique_persons(person, settings), [MEMBER])


def member_spans(crosswalk: DataFrame, coverage: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One row per group and member: the whole span, and the ``places`` (account and effective date) it has there.

    The platform rows meet the crosswalk as they are: the first start of an account's spans is that of its rows, so
    one aggregate replaces a collapse per account, a total per member and a join of both.
    """
    listed = coverage.where(F.col("src_platform_cd").isin(*settings.platforms) & codes.is_present(MEMBER))
    rows = account_coverage(unique_crosswalk(crosswalk, settings), listed)
    return rows.groupBy(GROUP, MEMBER).agg(
        F.min("cov_eff_date").alias("cov_eff_date"),
        F.max("cov_end_date").alias("cov_end_date"),
        F.max(codes.subscriber_flag("rel_type_cd")).alias("subscriber_flag"),
        F.collect_set(F.struct("effective_date", ACCOUNT)).alias("places"),
    )


def dated_members(
    crosswalk: DataFrame, coverage: DataFrame, person: DataFrame, factors: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    """One row per group, effective date and eligible member, with its ``accounts``, months and age factor."""
    spans = member_spans(crosswalk, coverage, settings)
    when = F.explode(F.array_distinct(F.transform("places", lambda p: p["effective_date"]))).alias("effective_date")
    dated = eligible(spans.select("*", when), settings)
    here = F.filter("places", lambda p: p["effective_date"] == F.col("effective_date"))
    dated = dated.withColumn("accounts", F.transform(here, lambda p: p[ACCOUNT])).drop("places")
    return age_factor_join(with_months(attach(dated, unique_persons(person, settings), [MEMBER]), settings), factors)


def counts_of_groups(dated: DataFrame) -> DataFrame:
    """Total and quoted members of each group and date: rows of ``dated_members`` are distinct members, so plain counts do."""
    begun = F.col("effective_date") >= F.col("cov_eff_date")
    return dated.groupBy(GROUP, "effective_date").agg(
        F.count(MEMBER).alias("total_members"),
        F.count(F.when(begun, F.col(MEMBER))).alias("quoted_members"),
        F.avg(F.when(begun, F.col("age_gender_factor"))).alias("quoted_pfm_rel"),
    )


def member_coverage(
    crosswalk: DataFrame,
    coverage: DataFrame,
    person: DataFrame,
    factors: DataFrame,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Coverage of each member and account by group and effective date.

    The dated members are computed once and stored, by member: the group counts and every consumer read that table.
    """
    dated = dated_members(crosswalk, coverage, person, factors, settings).drop("sex_cd", "birth_date", "age", "subscriber_flag")
    dated = store_table(dated, "dated_members")
    counts = store_table(counts_of_groups(dated), "group_counts")
    long_enough = dated.where(F.col("cov_months_medical") > settings.min_covered_months)
    counted = attach(long_enough, counts, [GROUP, "effective_date"])
    return counted.select(
        GROUP,
        MEMBER,
        F.explode("accounts").alias(ACCOUNT),
        "effective_date",
        "underwriting_date",
        "cov_eff_date",
        "cov_end_date",
        "hist_mths_avail",
        "cov_months_medical",
        F.col("total_members").cast("int").alias("total_members"),
        F.coalesce("quoted_members", F.lit(0)).cast("int").alias("quoted_members"),
        "quoted_pfm_rel",
        F.when(F.col("hist_mths_avail") > 0, 1).otherwise(0).alias("member_level_incl"),
        F.lit(1).alias("group_level_incl"),
    )
