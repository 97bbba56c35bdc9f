"""Summaries, counts and profiles."""

from pyspark.sql import functions as F

from ..registry import query
from ...functions import codes, dates
from ...operators import summaries

SCORES = [f"pred_{s}_{i}" for s in ("ixx", "xox", "xxr") for i in (1, 2, 3)]


@query(
    "a16_mean_and_count",
    f"""select group_id, {', '.join(f'avg({c}) as {c}_mean, count({c}) as {c}_count' for c in SCORES)}
        from fx_member_scores group by 1""",
    round={f"{c}_mean": 6 for c in SCORES},
)
def _(t):
    return summaries.mean_and_count(t.fx_member_scores, ["group_id"], SCORES)


@query(
    "a17_group_totals",
    """select group_id, count(*) as counts_mbr, count(*) * 12 as mths_est, sum(op_pmpm) * 12 as op, sum(rx_pmpm) * 12 as rx,
       avg(op_pmpm) as op_pmpm, avg(rx_pmpm) as rx_pmpm, cast(sum(any_xox) as bigint) as any_xox from
       (select group_id, coalesce(pred_xox_1, 0) as op_pmpm, coalesce(pred_xxr_1, 0) as rx_pmpm,
       case when pred_xox_1 is not null then 1 else 0 end as any_xox from fx_member_scores) x group by 1""",
    round={"op": 4, "rx": 4, "op_pmpm": 6, "rx_pmpm": 6},
)
def _(t):
    rows = t.fx_member_scores.select(
        "group_id", "member_id", F.coalesce("pred_xox_1", F.lit(0.0)).alias("op_pmpm"),
        F.coalesce("pred_xxr_1", F.lit(0.0)).alias("rx_pmpm"), F.col("pred_xox_1").isNotNull().alias("any_xox"),
    )
    return summaries.group_totals(rows, ["group_id"], "member_id", ["op_pmpm", "rx_pmpm"], ["any_xox"])


CENSUS = """
    cs as (select c.group_id, member_id, case when sex_cd is null or sex_cd = 'F' then 'F' else 'M' end as sex,
      greatest(0, cast(floor(date_diff('day', birth_date, effective_date) / 365.25) as int)) as age, subscriber_flag
      from fx_census c join fx_vendor_group g on c.group_id = g.group_id)
"""


def census(t):
    return t.fx_census.join(t.fx_vendor_group.select("group_id", "effective_date"), "group_id").select(
        "group_id", "member_id", codes.normalize_sex("sex_cd").alias("sex"),
        dates.age_at("effective_date", "birth_date").alias("age"), "subscriber_flag",
    )


@query(
    "a18_census_summary",
    f"""with {CENSUS} --main-- select group_id, count(member_id) as quoted_members, avg(age_gender_factor) as quoted_pfm_rel
        from cs left join fx_age_factor f on sex = sex_cd and subscriber_flag = subscriber_ind and age between min_mbr_age
        and max_mbr_age group by 1""",
    round={"quoted_pfm_rel": 6},
)
def _(t):
    from ...operators.coverage import factor_by_age
    from ...operators.joins import attach

    factors = factor_by_age(t.fx_age_factor).withColumnRenamed("sex_cd", "sex")
    return summaries.census_summary(
        attach(census(t), factors, ["sex", "subscriber_flag", "age"]), ["group_id"], "member_id", "age_gender_factor"
    )


@query(
    "a19_age_sex_counts",
    f"""with {CENSUS} --main-- select group_id, count(*) filter (where age >= 18 and sex = 'M') as adult_male,
        count(*) filter (where age >= 18 and sex = 'F') as adult_female, count(*) filter (where age < 18) as children
        from cs group by 1""",
)
def _(t):
    return summaries.age_sex_counts(census(t), ["group_id"])


@query(
    "a20_mean_of_means",
    """select o_orderstatus, avg(m) as mean_o_totalprice from (select o_orderstatus, o_custkey, avg(o_totalprice) as m from orders
       group by 1, 2) x group by 1""",
    round={"mean_o_totalprice": 4},
)
def _(t):
    return summaries.mean_of_means(t.orders, ["o_orderstatus", "o_custkey"], "o_totalprice", ["o_orderstatus"])


@query(
    "a21_distinct_months",
    """select o_custkey, count(distinct (year(o_orderdate), month(o_orderdate))) as months_enrolled,
       sum(o_totalprice) as total from orders group by 1""",
    round={"total": 4},
)
def _(t):
    return summaries.distinct_months(
        t.orders, ["o_custkey"], F.year("o_orderdate"), F.month("o_orderdate"), {"total": "o_totalprice"}
    )


@query(
    "a21_sorted_codes",
    """select member_id, coalesce(array_to_string(list_sort(list(distinct dx) filter (where dx is not null)), ','), '') as dx_codes,
       coalesce(array_to_string(list_sort(list(distinct proc_cd) filter (where proc_cd is not null)), ','), '') as proc_codes from
       (select member_id, proc_cd, unnest([diag_1, diag_2, diag_3]) as dx from fx_vendor_med) x group by 1""",
)
def _(t):
    rows = t.fx_vendor_med.select(
        "member_id", F.array("diag_1", "diag_2", "diag_3").alias("dx"), F.array("proc_cd").alias("proc")
    )
    found = summaries.sorted_codes(rows, ["member_id"], {"dx_codes": "dx", "proc_codes": "proc"})
    return found.select("member_id", *[F.array_join(c, ",").alias(c) for c in ("dx_codes", "proc_codes")])


@query(
    "a22_grand_total",
    """select cast(sum(l_orderkey) as bigint) as l_orderkey, cast(sum(l_linenumber) as bigint) as l_linenumber,
       sum(l_quantity) as l_quantity, sum(l_tax) as l_tax from lineitem""",
    round={"l_quantity": 2, "l_tax": 2},
)
def _(t):
    return summaries.grand_total(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_tax", "l_returnflag"))


@query(
    "a23_named_agg",
    """select l_returnflag, l_linestatus, sum(l_quantity) as sum_qty, min(l_extendedprice) as low, max(l_extendedprice) as high,
       avg(l_discount) as avg_disc, count(*) as n from lineitem group by 1, 2""",
    round={"sum_qty": 2, "avg_disc": 8},
)
def _(t):
    return summaries.named_agg(
        t.lineitem, ["l_returnflag", "l_linestatus"],
        {"sum_qty": F.sum("l_quantity"), "low": F.min("l_extendedprice"), "high": F.max("l_extendedprice"),
         "avg_disc": F.avg("l_discount"), "n": F.count(F.lit(1))},
    )


@query(
    "a24_freq_table",
    """select coalesce(revenue_cd, '(missing)') as revenue_cd, count(*) as n, count(*) / sum(count(*)) over () as share
       from fx_med_line_fact group by 1""",
    round={"share": 8},
)
def _(t):
    return summaries.freq_table(t.fx_med_line_fact, "revenue_cd")


PROFILE = ["l_quantity", "l_extendedprice", "l_discount", "l_suppkey"]


@query(
    "a25_profile_numeric",
    " union all ".join(
        f"""select '{c}' as variable, count({c}) as n, count(*) - count({c}) as missing, cast(min({c}) as double) as min,
        avg({c}) as mean, cast(max({c}) as double) as max, quantile_cont(cast({c} as double), 0.25) as q1,
        quantile_cont(cast({c} as double), 0.5) as median, quantile_cont(cast({c} as double), 0.75) as q3 from lineitem"""
        for c in PROFILE
    ),
    round={c: 6 for c in ("mean", "q1", "median", "q3")},
)
def _(t):
    return summaries.profile_numeric(t.lineitem, PROFILE)


@query(
    "a25_profile_categories",
    """select 'event_type' as variable, event_type as level, count(*) as n from events group by 2 union all
       select 'props', props, count(*) from events group by 2""",
)
def _(t):
    return summaries.profile_categories(t.events, ["event_type", "props"])


@query(
    "a25_histogram",
    """select cast(least(20, floor((o_totalprice - lo) / ((hi - lo) / 20)) + 1) as int) as bin, count(*) as n from orders,
       (select min(o_totalprice) as lo, max(o_totalprice) as hi from orders) b group by 1""",
)
def _(t):
    return summaries.histogram(t.orders, "o_totalprice")


@query(
    "a25_histogram_inner",
    """select cast(least(20, floor((o_totalprice - lo) / ((hi - lo) / 20)) + 1) as int) as bin, count(*) as n from orders,
       (select quantile_cont(o_totalprice, 0.05) as lo, quantile_cont(o_totalprice, 0.95) as hi from orders) b
       where o_totalprice between lo and hi group by 1""",
)
def _(t):
    return summaries.histogram(t.orders, "o_totalprice", inner=True)


@query(
    "a26_weighted_corr",
    """select partition_name, (sum(weight * pred * actual) / sum(weight) - sum(weight * pred) / sum(weight) * sum(weight * actual)
       / sum(weight)) / sqrt((sum(weight * pred * pred) / sum(weight) - pow(sum(weight * pred) / sum(weight), 2))
       * (sum(weight * actual * actual) / sum(weight) - pow(sum(weight * actual) / sum(weight), 2))) as corr
       from fx_scored group by 1""",
    round={"corr": 8},
)
def _(t):
    return summaries.weighted_corr(t.fx_scored, "pred", "actual", "weight", ["partition_name"])


@query(
    "a27_group_event_risk",
    """select group_id, sum(c) as med_debits, max(m) as total_members, sum(c) / (12 * coalesce(max(r), 350) * max(m) + 1e-5)
       as med_debit_rs from (select cast(c_nationkey as varchar) as group_id, o_totalprice / 100 as c, 40 as m,
       case when c_nationkey % 4 <> 0 then 200.0 + c_nationkey end as r from orders join customer on o_custkey = c_custkey) x group by 1""",
    round={"med_debits": 4, "med_debit_rs": 8},
)
def _(t):
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_nationkey").cast("string").alias("group_id"), (F.col("o_totalprice") / 100).alias("c"), F.lit(40).alias("m"),
        F.when(F.col("c_nationkey") % 4 != 0, 200.0 + F.col("c_nationkey")).alias("r"),
    )
    return summaries.group_event_risk(rows, ["group_id"], "c", "m", "r")


@query(
    "a28_truncated_pmpm",
    """select c_nationkey, cast(sum(l_linenumber) as bigint) as months, sum(l_extendedprice) / sum(l_linenumber) as claims_pmpm,
       sum(least(l_extendedprice, 60000)) / sum(l_linenumber) as claims_trunc_pmpm from lineitem join orders
       on l_orderkey = o_orderkey join customer on o_custkey = c_custkey group by 1""",
    round={"claims_pmpm": 4, "claims_trunc_pmpm": 4},
)
def _(t):
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        t.customer, F.col("o_custkey") == F.col("c_custkey")
    )
    named = rows.select(
        "c_nationkey", F.col("l_linenumber").alias("months"), F.col("l_extendedprice").alias("amt"),
        F.least("l_extendedprice", F.lit(60000.0)).alias("amt_60"),
    )
    return summaries.truncated_pmpm(
        named, ["c_nationkey"], {"claims_pmpm": "amt", "claims_trunc_pmpm": "amt_60"}, "months"
    )


@query(
    "a29_distinct_count",
    "select count(*) as n from (select distinct l_suppkey, l_returnflag, l_linestatus from lineitem) x",
)
def _(t):
    return summaries.distinct_count(t.lineitem, ["l_suppkey", "l_returnflag", "l_linestatus"])


@query(
    "a29_mean_count_by_flag",
    """select l_returnflag, avg(l_quantity) as l_quantity_mean, count(l_quantity) as l_quantity_count, avg(l_tax) as l_tax_mean,
       count(l_tax) as l_tax_count from lineitem group by 1""",
    round={"l_quantity_mean": 6, "l_tax_mean": 8},
)
def _(t):
    return summaries.mean_count_by_flag(t.lineitem, "l_returnflag", ["l_quantity", "l_tax"])
