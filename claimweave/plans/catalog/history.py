"""Coverage, history, targets, customer tables."""

from pyspark.sql import functions as F

from .joins import SPANS, member_rows
from .repricing import FACT_CODES, RX_PRICED, VERTICAL, priced
from ..fixture_settings import SETTINGS
from ..registry import query
from ..steps import Node, run_graph
from ...functions import dates
from ...operators import claims, coverage, targets
from ...session import store_table

MED_KEYS = "src_rpt_cust_id, sdr_person_id, underwriting_date, times, med_sample, datatype, value"
TIMES = """case when (year(underwriting_date) - year({d})) * 12 + month(underwriting_date) - month({d}) between 1 and 3 then 1
    when (year(underwriting_date) - year({d})) * 12 + month(underwriting_date) - month({d}) between 4 and 9 then 2 else 3 end"""


def _near(table, first, second, start, end):
    return f"""{first} >= {start} and {second} >= {start} and {first} < {end} and {second} < {end}"""


MED_NEAR = f"""
    mh as (select v.*, m.src_rpt_cust_id, m.underwriting_date, {TIMES.format(d='serv_from_date')} as times,
      case when revenue_cd is not null then 'i' else 'o' end as med_sample from vc v join mc m
      on v.sdr_person_id = m.sdr_person_id and v.src_cust_id = m.src_cust_id where member_level_incl = 1
      and src_clm_platform_cd in ('EM', 'LV') and {_near('', 'serv_from_date', 'load_date',
      'underwriting_date - interval 24 month', 'underwriting_date')}),
    mv as (select *, case when datatype = 'md' then coalesce(prefx_map_id, 'hcup_unk') else g end as value2 from
      (select mh.*, case when (datatype = 'md' and icd10 is not null) or (datatype = 'mc' and symp is not null) then '99999'
      else value end as g from mh left join fx_icd_genetic on value = icd10 left join fx_cpt_genetic on value = symp) x
      left join fx_icd_map on g = diag_cd)
"""


def _floor(c):
    return f"case when sum({c}) > 0 then sum({c}) else 0 end"


@query(
    "a01_aggregate_claims",
    f"""with {FACT_CODES}, {VERTICAL} --main-- select sdr_person_id, src_cust_id, datatype, value,
        {_floor('ag_allow_amt')} as ag_allow_amt from vc group by 1, 2, 3, 4""",
    round={"ag_allow_amt": 4},
)
def _(t):
    rows = claims.verticalize(
        priced(t), "revenue_cd", "hcpcs_cpt4_base_cd1", "ndc_id", ["primary_diag_cd", "diag_cd2", "diag_cd3"]
    )
    amount = claims.amounts.history_amount(
        "datatype", "ndc_id", "hcpcs_cpt4_base_cd1", "ndc_amt", "cpt_amt", "rev_amt", "allow_icob_amt", "chrg_amt"
    )
    keys = ["sdr_person_id", "src_cust_id", "datatype", "value"]
    return claims.aggregate_history(rows.withColumn("ag_allow_amt", amount), keys)


@query(
    "a02_aggregate_rx",
    f"""with {RX_PRICED} --main-- select sdr_person_id, ndc_id, {_floor('ag_allow_amt')} as ag_allow_amt, 'r' as rx_sample
        from rp group by 1, 2""",
    round={"ag_allow_amt": 4},
)
def _(t):
    rows = claims.rx_priced(t.fx_rx_claims, t.fx_ndc_price)
    return claims.aggregate_history(rows, ["sdr_person_id", "ndc_id"]).withColumn("rx_sample", F.lit("r"))


PERIPHERAL_MAX = ", ".join(f"max({c}) as {{p}}_{c}" for c in claims.PERIPHERAL)
TARGETS = f"""
    mt as (select src_rpt_cust_id, m.sdr_person_id, underwriting_date, effective_date, {_floor('amt')} as total_med_ag_allow_amt,
      sum(allow_icob_amt) as total_med_allow_amt, {PERIPHERAL_MAX.format(p='med')}
      from (select *, case when abs(a) < abs(chrg_amt) then a else chrg_amt end as amt from
      (select *, coalesce(ndc_amt, cpt_amt, rev_amt, allow_icob_amt) as a from fp) x) f
      join mc m on f.sdr_person_id = m.sdr_person_id and f.src_cust_id = m.src_cust_id
      where src_clm_platform_cd in ('EM', 'LV') and serv_from_date >= date '1998-01-01' and load_date >= date '1998-01-01'
      and {_near('', 'serv_from_date', 'load_date', 'effective_date', 'effective_date + interval 12 month')}
      group by 1, 2, 3, 4),
    rt as (select src_rpt_cust_id, m.sdr_person_id, underwriting_date, effective_date, {_floor('ag_allow_amt')}
      as total_rx_ag_allow_amt, sum(rx_cost) as total_rx_allow_amt, {PERIPHERAL_MAX.format(p='rx')}
      from rp f join mc m on f.sdr_person_id = m.sdr_person_id and f.src_cust_id = m.src_cust_id
      where src_platform_cd in ('EM', 'LV') and service_date >= date '1998-01-01' and process_date >= date '1998-01-01'
      and {_near('', 'service_date', 'process_date', 'effective_date', 'effective_date + interval 12 month')}
      group by 1, 2, 3, 4)
"""
KEYS = ("src_rpt_cust_id", "sdr_person_id", "underwriting_date", "effective_date")
COMBINED = f"""
    tc as (select {', '.join(f'coalesce(mt.{k}, rt.{k}) as {k}' for k in KEYS)},
      {', '.join(f'coalesce(rx_{c}, med_{c}) as {c}' for c in claims.PERIPHERAL)},
      {', '.join(f'coalesce({c}, 0) as {c}' for c in targets.AMOUNTS)}
      from mt full join rt on {' and '.join(f'mt.{k} = rt.{k}' for k in KEYS)}),
    tg as (select {', '.join(KEYS)}, {', '.join(claims.PERIPHERAL)},
      (total_med_ag_allow_amt + total_rx_ag_allow_amt) / cov_months_medical as mbr_mth_ag_cmpl_allow,
      (total_med_allow_amt + total_rx_allow_amt) / cov_months_medical as mbr_mth_allow_icob_amt from tc),
    ci as (select src_rpt_cust_id, effective_date, train_subpartition, coalesce(comm_rt, 0) as comm_rt,
      coalesce(lf_group, 0) as lf_group, coalesce(aso_group, 0) as aso_group, bus_segment_cd from fx_cust_info
      where effective_date between date '1998-01-01' and date '1999-12-31')
"""
ALL = f"with {FACT_CODES}, {RX_PRICED}, {SPANS}, {TARGETS}, {COMBINED} --main-- "
TARGET_ROUND = {"mbr_mth_ag_cmpl_allow": 4, "mbr_mth_allow_icob_amt": 4, "quoted_pfm_rel": 6}


def med_target(t, members=None):
    members = member_rows(t) if members is None else members
    return claims.med_target(
        t.fx_med_line_fact, t.fx_med_line, members, t.fx_ndc_price, t.fx_rev_price, t.fx_cpt_price, SETTINGS
    )


def rx_target(t, members=None):
    members = member_rows(t) if members is None else members
    return claims.rx_target(t.fx_rx_claims, members, t.fx_ndc_price, SETTINGS)


def target(t):
    # Both targets read the coverage, so it is computed once.
    members = store_table(member_rows(t), "coverage")
    return targets.target(med_target(t, members), rx_target(t, members))


def info(t):
    return targets.customer_info(t.fx_cust_info, SETTINGS)


@query(
    "a03_med_target",
    ALL + "select * from mt",
    round={"total_med_ag_allow_amt": 4, "total_med_allow_amt": 4, "med_quoted_pfm_rel": 6},
)
def _(t):
    return med_target(t)


@query(
    "k07_rx_target",
    ALL + "select * from rt",
    round={"total_rx_ag_allow_amt": 4, "total_rx_allow_amt": 4, "rx_quoted_pfm_rel": 6},
)
def _(t):
    return rx_target(t)


@query(
    "k07_med_target",
    ALL + "select src_rpt_cust_id, count(*) as members, sum(total_med_allow_amt) as total_med_allow_amt from mt group by 1",
    round={"total_med_allow_amt": 4},
)
def _(t):
    return med_target(t).groupBy("src_rpt_cust_id").agg(
        F.count("*").alias("members"), F.sum("total_med_allow_amt").alias("total_med_allow_amt")
    )


@query(
    "j13_combine_targets",
    ALL + "select * from tc",
    round={**{c: 4 for c in targets.AMOUNTS}, "quoted_pfm_rel": 6},
)
def _(t):
    members = store_table(member_rows(t), "coverage")
    return targets.combine_targets(med_target(t, members), rx_target(t, members))


@query("k08_target", ALL + "select * from tg", round=TARGET_ROUND)
def _(t):
    return target(t)


@query(
    "a05_pmpm",
    "select l_orderkey, l_linenumber, l_extendedprice / nullif(l_linenumber - 1, 0) as pmpm from lineitem",
    round={"pmpm": 6},
)
def _(t):
    months = (F.col("l_linenumber") - 1).cast("double")
    return t.lineitem.select("l_orderkey", "l_linenumber", targets.pmpm("l_extendedprice", months).alias("pmpm"))


@query(
    "j14_join_customer",
    ALL + """select tg.src_rpt_cust_id, sdr_person_id, underwriting_date, bus_segment_cd, comm_rt from tg join ci
    on tg.src_rpt_cust_id = ci.src_rpt_cust_id and tg.effective_date = ci.effective_date""",
)
def _(t):
    joined = targets.join_customer(target(t), info(t))
    return joined.select("src_rpt_cust_id", "sdr_person_id", "underwriting_date", "bus_segment_cd", "comm_rt")


MEMBER_DATA = """select tg.src_rpt_cust_id, sdr_person_id, underwriting_date, hist_mths_avail, quoted_members, quoted_pfm_rel,
    mbr_mth_ag_cmpl_allow, train_subpartition, bus_segment_cd, comm_rt, lf_group, aso_group from tg join ci
    on tg.src_rpt_cust_id = ci.src_rpt_cust_id and tg.effective_date = ci.effective_date where member_level_incl = 1"""


@query(
    "k09_member_data", ALL + MEMBER_DATA, round={"mbr_mth_ag_cmpl_allow": 4, "quoted_pfm_rel": 6}
)
def _(t):
    return targets.member_data(target(t), info(t))


@query(
    "j15_attach_rate",
    ALL + f"""select md.src_rpt_cust_id, sdr_person_id, underwriting_date, case when bus_segment_cd = 'U' then 0
    else hist_mths_avail * 10.0 end as rate_calibrated from ({MEMBER_DATA}) md""",
    round={"rate_calibrated": 4},
)
def _(t):
    members = targets.member_data(target(t), info(t))
    rates = members.where("bus_segment_cd <> 'U'").withColumn("rate_calibrated", F.col("hist_mths_avail") * 10.0)
    return targets.attach_rate(members, rates).select("src_rpt_cust_id", "sdr_person_id", "underwriting_date", "rate_calibrated")


CUSTOMER_DATA = """select tg.src_rpt_cust_id, underwriting_date, cast(sum(cov_months_medical) as bigint) as total_member_months,
    sum(mbr_mth_ag_cmpl_allow * cov_months_medical) / sum(cov_months_medical) as agnostic_claims_pmpm,
    sum(mbr_mth_allow_icob_amt * cov_months_medical) / sum(cov_months_medical) as allowed_claims_pmpm,
    max(total_members) as total_members, max(quoted_members) as quoted_members, max(quoted_pfm_rel) as quoted_pfm_rel,
    max(bus_segment_cd) as bus_segment_cd, max(comm_rt) as comm_rt, max(lf_group) as lf_group,
    max(train_subpartition) as train_subpartition from tg join ci on tg.src_rpt_cust_id = ci.src_rpt_cust_id
    and tg.effective_date = ci.effective_date where group_level_incl = 1 group by 1, 2"""


@query(
    "k09_customer_data",
    ALL + CUSTOMER_DATA,
    round={"agnostic_claims_pmpm": 4, "allowed_claims_pmpm": 4, "quoted_pfm_rel": 6},
)
def _(t):
    return targets.customer_data(target(t), info(t))


@query(
    "a04_group_pmpm",
    """select src_rpt_cust_id, underwriting_date, cast(sum(m) as bigint) as total_member_months,
       sum(a * m) / sum(m) as agnostic_claims_pmpm, sum(b * m) / sum(m) as allowed_claims_pmpm from
       (select cast(c_nationkey as varchar) as src_rpt_cust_id, cast(date_trunc('year', o_orderdate) as date) as underwriting_date,
       l_linenumber as m, l_extendedprice as a, l_extendedprice * l_discount as b from lineitem join orders
       on l_orderkey = o_orderkey join customer on o_custkey = c_custkey) x group by 1, 2""",
    round={"agnostic_claims_pmpm": 4, "allowed_claims_pmpm": 4},
)
def _(t):
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        t.customer, F.col("o_custkey") == F.col("c_custkey")
    )
    named = rows.select(
        F.col("c_nationkey").cast("string").alias("src_rpt_cust_id"),
        F.trunc("o_orderdate", "year").alias("underwriting_date"),
        F.col("l_linenumber").alias("cov_months_medical"),
        F.col("l_extendedprice").alias("mbr_mth_ag_cmpl_allow"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("mbr_mth_allow_icob_amt"),
        *[F.lit(0).alias(c) for c in ("total_members", "quoted_members", "quoted_pfm_rel", "bus_segment_cd", "comm_rt",
                                      "lf_group", "train_subpartition")],
    )
    return targets.group_pmpm(named).select(
        "src_rpt_cust_id", "underwriting_date", "total_member_months", "agnostic_claims_pmpm", "allowed_claims_pmpm"
    )


@query(
    "a06_collapse_coverage",
    f"""with {SPANS} --main-- select sdr_person_id, src_cust_id, s as cov_eff_date, e as cov_end_date, f as subscriber_flag from cv""",
)
def _(t):
    return coverage.collapse_coverage(t.fx_coverage, SETTINGS)


@query("a07_unique_persons", f"with {SPANS} --main-- select * from pe")
def _(t):
    return coverage.unique_persons(t.fx_person, SETTINGS)


@query("a07_unique_crosswalk", f"with {SPANS} --main-- select * from cw")
def _(t):
    return coverage.unique_crosswalk(t.fx_crosswalk, SETTINGS)


def _factored(t):
    rows = coverage.with_months(coverage.covered_rows(t.fx_crosswalk, t.fx_coverage, t.fx_person, SETTINGS), SETTINGS)
    return coverage.age_factor_join(rows, t.fx_age_factor)


@query("a08_total_members", f"with {SPANS} --main-- select * from tm")
def _(t):
    return coverage.total_members(_factored(t))


@query("a09_quoted_members", f"with {SPANS} --main-- select * from qm", round={"quoted_pfm_rel": 6})
def _(t):
    return coverage.quoted_members(_factored(t))


@query(
    "a10_factor_by_age",
    """select c_custkey % 7 as band, cast(a as int) as age, max(f) as age_gender_factor from (select c_custkey, c_acctbal / 1000 as f,
       unnest(range(c_custkey % 30, c_custkey % 30 + 5)) as a from customer) x group by 1, 2""",
    round={"age_gender_factor": 6},
)
def _(t):
    low = (F.col("c_custkey") % 30).cast("int")
    factors = t.customer.select(
        (F.col("c_custkey") % 7).alias("subscriber_ind"), F.lit("F").alias("sex_cd"), low.alias("min_mbr_age"),
        (low + 4).alias("max_mbr_age"), (F.col("c_acctbal") / 1000).cast("string").alias("age_gender_factor"),
    )
    rows = coverage.factor_by_age(factors)
    return rows.select(F.col("subscriber_flag").cast("bigint").alias("band"), "age", "age_gender_factor")


@query(
    "w01_continuous_span",
    f"""with {SPANS} --main-- select src_rpt_cust_id, src_cust_id, sdr_person_id, effective_date, cov_eff_date, cov_end_date,
        subscriber_flag from sp""",
)
def _(t):
    rows = coverage.account_coverage(
        coverage.unique_crosswalk(t.fx_crosswalk, SETTINGS), coverage.collapse_coverage(t.fx_coverage, SETTINGS)
    )
    return coverage.continuous_span(rows).select(
        "src_rpt_cust_id", "src_cust_id", "sdr_person_id", "effective_date", "cov_eff_date", "cov_end_date", "subscriber_flag"
    )


@query(
    "k01_coverage_eligibility",
    f"with {SPANS} --main-- select src_rpt_cust_id, src_cust_id, sdr_person_id, effective_date from el",
)
def _(t):
    rows = coverage.account_coverage(
        coverage.unique_crosswalk(t.fx_crosswalk, SETTINGS), coverage.collapse_coverage(t.fx_coverage, SETTINGS)
    )
    kept = coverage.eligible(coverage.continuous_span(rows), SETTINGS)
    return kept.select("src_rpt_cust_id", "src_cust_id", "sdr_person_id", "effective_date")


@query(
    "k02_history_months",
    f"""with {SPANS} --main-- select src_cust_id, sdr_person_id, effective_date, underwriting_date,
        cast(hist_mths_avail as int) as hist_mths_avail from mm""",
)
def _(t):
    rows = coverage.with_months(coverage.covered_rows(t.fx_crosswalk, t.fx_coverage, t.fx_person, SETTINGS), SETTINGS)
    return rows.select("src_cust_id", "sdr_person_id", "effective_date", "underwriting_date", "hist_mths_avail")


@query(
    "k03_covered_months",
    f"""with {SPANS} --main-- select src_cust_id, sdr_person_id, effective_date,
        cast(cov_months_medical as int) as cov_months_medical from mm""",
)
def _(t):
    rows = coverage.covered_rows(t.fx_crosswalk, t.fx_coverage, t.fx_person, SETTINGS)
    months = dates.covered_months("effective_date", "cov_eff_date", "cov_end_date")
    return rows.select("src_cust_id", "sdr_person_id", "effective_date", months.alias("cov_months_medical"))


@query("k04_member_coverage", f"with {SPANS} --main-- select * from mc", round={"quoted_pfm_rel": 6})
def _(t):
    return member_rows(t)


@query(
    "k05_med_history",
    f"""with {FACT_CODES}, {VERTICAL}, {SPANS}, {MED_NEAR} --main-- select src_rpt_cust_id, sdr_person_id, underwriting_date, times,
        med_sample, datatype, value2 as value, {_floor('ag_allow_amt')} as ag_allow_amt from mv group by 1, 2, 3, 4, 5, 6, 7""",
    round={"ag_allow_amt": 4},
)
def _(t):
    return claims.med_history(
        t.fx_med_line_fact, t.fx_med_line, member_rows(t), t.fx_ndc_price, t.fx_rev_price, t.fx_cpt_price,
        claims.genetic_list(t.fx_icd_genetic, t.fx_cpt_genetic), t.fx_icd_map, SETTINGS,
    )


@query(
    "k06_rx_history",
    f"""with {RX_PRICED}, {SPANS} --main-- select m.src_rpt_cust_id, r.sdr_person_id, underwriting_date,
        {TIMES.format(d='service_date')} as times, ndc_id, {_floor('ag_allow_amt')} as ag_allow_amt, 'r' as rx_sample
        from rp r join mc m on r.sdr_person_id = m.sdr_person_id and r.src_cust_id = m.src_cust_id where member_level_incl = 1
        and src_platform_cd in ('EM', 'LV') and {_near('', 'service_date', 'process_date',
        'underwriting_date - interval 24 month', 'underwriting_date')} group by 1, 2, 3, 4, 5""",
    round={"ag_allow_amt": 4},
)
def _(t):
    return claims.rx_history(t.fx_rx_claims, member_rows(t), t.fx_ndc_price, SETTINGS)


HISTORY_STEPS = [
    Node("members", ("crosswalk", "coverage", "person", "age_factor"), coverage.member_coverage),
    Node("genetic", ("icd_genetic", "cpt_genetic"), lambda icd, cpt, settings: claims.genetic_list(icd, cpt)),
    Node("med", ("med_facts", "med_lines", "members", "ndc_price", "rev_price", "cpt_price", "genetic", "icd_map"), claims.med_history),
    Node("rx", ("rx_facts", "members", "ndc_price"), claims.rx_history),
    Node(
        "out",
        ("med", "rx"),
        lambda med, rx, settings: med.select(*HISTORY_KEYS, F.col("med_sample").alias("sample"), "value", "ag_allow_amt").unionByName(
            rx.select(*HISTORY_KEYS, F.col("rx_sample").alias("sample"), F.col("ndc_id").alias("value"), "ag_allow_amt")
        ),
    ),
]
HISTORY_KEYS = ["src_rpt_cust_id", "sdr_person_id", "underwriting_date", "times"]


def history_frames(t):
    return {
        "crosswalk": t.fx_crosswalk, "coverage": t.fx_coverage, "person": t.fx_person, "age_factor": t.fx_age_factor,
        "med_facts": t.fx_med_line_fact, "med_lines": t.fx_med_line, "rx_facts": t.fx_rx_claims, "ndc_price": t.fx_ndc_price,
        "rev_price": t.fx_rev_price, "cpt_price": t.fx_cpt_price, "icd_genetic": t.fx_icd_genetic,
        "cpt_genetic": t.fx_cpt_genetic, "icd_map": t.fx_icd_map,
    }


@query(
    "k11_history_graph",
    f"""with {FACT_CODES}, {VERTICAL}, {RX_PRICED}, {SPANS}, {MED_NEAR} --main-- select src_rpt_cust_id, sdr_person_id, underwriting_date,
        times, med_sample as sample, value2 as value, {_floor('ag_allow_amt')} as ag_allow_amt from mv
        group by src_rpt_cust_id, sdr_person_id, underwriting_date, times, med_sample, datatype, value2
        union all select m.src_rpt_cust_id, r.sdr_person_id, underwriting_date,
        {TIMES.format(d='service_date')} as times, 'r' as sample, ndc_id as value, {_floor('ag_allow_amt')} as ag_allow_amt
        from rp r join mc m on r.sdr_person_id = m.sdr_person_id and r.src_cust_id = m.src_cust_id where member_level_incl = 1
        and src_platform_cd in ('EM', 'LV') and {_near('', 'service_date', 'process_date',
        'underwriting_date - interval 24 month', 'underwriting_date')} group by 1, 2, 3, 4, 5, 6""",
    round={"ag_allow_amt": 4},
)
def _(t):
    """Both histories through one graph of steps, which computes the coverage that both read once."""
    return run_graph(history_frames(t), HISTORY_STEPS, SETTINGS, schema={"times": "int", "ag_allow_amt": "double"})
