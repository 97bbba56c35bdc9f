"""Joins."""

from pyspark.sql import functions as F

from ..fixture_settings import SETTINGS
from ..registry import query
from ...operators import claims, coverage, joins
from ...functions import codes

# Eligible member rows per account and effective date; shared by the coverage and claims checks.
SPANS = """
    cw as (select src_cust_id, effective_date, max(src_rpt_cust_id) as src_rpt_cust_id from fx_crosswalk
      where effective_date between date '1998-01-01' and date '1999-12-31' group by 1, 2),
    cv as (select sdr_person_id, src_cust_id, min(cov_eff_date) as s, max(cov_end_date) as e,
      max(case when rel_type_cd = '18' then 1 else 0 end) as f from fx_coverage
      where src_platform_cd in ('EM', 'LV') group by 1, 2),
    sp as (select src_rpt_cust_id, src_cust_id, sdr_person_id, effective_date,
      min(s) over (partition by src_rpt_cust_id, sdr_person_id) as cov_eff_date,
      max(e) over (partition by src_rpt_cust_id, sdr_person_id) as cov_end_date,
      max(f) over (partition by src_rpt_cust_id, sdr_person_id) as subscriber_flag
      from cw join cv using (src_cust_id)),
    el as (select * from sp where effective_date >= cov_eff_date - interval 12 month and effective_date <= cov_end_date
      and sdr_person_id <> ''),
    pe as (select sdr_person_id, case when max(sex_cd) = 'F' or max(sex_cd) is null then 'F' else 'M' end as sex_cd,
      max(birth_date) as birth_date from fx_person where src_platform_cd in ('EM', 'LV') group by 1),
    af as (select sex_cd, subscriber_ind, a as age, max(age_gender_factor) as factor from
      (select *, unnest(range(min_mbr_age, max_mbr_age + 1)) as a from fx_age_factor) z group by 1, 2, 3),
    mr as (select el.*, sex_cd, birth_date, cast(effective_date - interval 3 month as date) as underwriting_date,
      greatest(0, cast(floor(date_diff('day', birth_date, effective_date) / 365.25) as int)) as raw_age
      from el left join pe using (sdr_person_id)),
    mm as (select mr.*, coalesce(raw_age, 0) as age,
      greatest(0, least(24, (year(underwriting_date) - year(cov_eff_date)) * 12 + month(underwriting_date)
        - month(cov_eff_date))) as hist_mths_avail,
      (year(least(cast(cov_end_date + interval 1 day as date), cast(effective_date + interval 12 month as date)))
        - year(greatest(cov_eff_date, effective_date))) * 12
        + month(least(cast(cov_end_date + interval 1 day as date), cast(effective_date + interval 12 month as date)))
        - month(greatest(cov_eff_date, effective_date)) as cov_months_medical from mr),
    mf as (select mm.*, af.factor as age_gender_factor from mm left join af on mm.sex_cd = af.sex_cd
      and mm.subscriber_flag = af.subscriber_ind and mm.age = af.age),
    tm as (select src_rpt_cust_id, effective_date, count(distinct sdr_person_id) as total_members from mf group by 1, 2),
    qm as (select src_rpt_cust_id, effective_date, count(sdr_person_id) as quoted_members,
      avg(age_gender_factor) as quoted_pfm_rel from (select distinct src_rpt_cust_id, effective_date, sdr_person_id,
      age_gender_factor from mf where effective_date >= cov_eff_date) z group by 1, 2),
    mc as (select mf.src_rpt_cust_id, sdr_person_id, src_cust_id, mf.effective_date, underwriting_date, cov_eff_date,
      cov_end_date, cast(hist_mths_avail as int) as hist_mths_avail, cast(cov_months_medical as int) as cov_months_medical,
      cast(total_members as int) as total_members, cast(coalesce(quoted_members, 0) as int) as quoted_members,
      quoted_pfm_rel, case when hist_mths_avail > 0 then 1 else 0 end as member_level_incl, 1 as group_level_incl
      from mf left join tm on mf.src_rpt_cust_id = tm.src_rpt_cust_id and mf.effective_date = tm.effective_date
      left join qm on mf.src_rpt_cust_id = qm.src_rpt_cust_id and mf.effective_date = qm.effective_date
      where cov_months_medical > 6)
"""


def member_rows(t):
    return coverage.member_coverage(t.fx_crosswalk, t.fx_coverage, t.fx_person, t.fx_age_factor, SETTINGS)


@query(
    "j01_join_line_codes",
    """select f.medclm_key, f.sdr_person_id, f.primary_diag_cd, l.ndc_id, l.diag_cd2, l.diag_cd3
       from fx_med_line_fact f left join (select * from fx_med_line where medclm_key % 3 <> 0) l
       on f.medclm_key = l.medclm_key""",
)
def _(t):
    lines = t.fx_med_line.where("medclm_key % 3 <> 0")
    facts = t.fx_med_line_fact.select("medclm_key", "sdr_person_id", "primary_diag_cd")
    return claims.join_line_codes(facts, lines)


@query(
    "j02_member_account_join",
    f"""with {SPANS} --main-- select medclm_key, f.sdr_person_id, f.src_cust_id, chrg_amt, src_rpt_cust_id, effective_date
       from fx_med_line_fact f join mc on f.sdr_person_id = mc.sdr_person_id and f.src_cust_id = mc.src_cust_id""",
)
def _(t):
    facts = t.fx_med_line_fact.select("medclm_key", "sdr_person_id", "src_cust_id", "chrg_amt")
    members = member_rows(t).select("sdr_person_id", "src_cust_id", "src_rpt_cust_id", "effective_date")
    return facts.join(members, ["sdr_person_id", "src_cust_id"])


@query(
    "j03_lookback_filter",
    f"""with {SPANS} --main-- select medclm_key, f.sdr_person_id, serv_from_date, load_date, src_rpt_cust_id, underwriting_date
       from fx_med_line_fact f join mc on f.sdr_person_id = mc.sdr_person_id and f.src_cust_id = mc.src_cust_id
       where serv_from_date < underwriting_date and load_date < underwriting_date
       and serv_from_date >= underwriting_date - interval 24 month and load_date >= underwriting_date - interval 24 month""",
)
def _(t):
    members = member_rows(t).select("sdr_person_id", "src_cust_id", "src_rpt_cust_id", "underwriting_date")
    near = joins.lookback_filter(
        t.fx_med_line_fact, members, ["sdr_person_id", "src_cust_id"], ["serv_from_date", "load_date"]
    )
    return near.select("medclm_key", "sdr_person_id", "serv_from_date", "load_date", "src_rpt_cust_id", "underwriting_date")


@query(
    "j04_plan_year_filter",
    f"""with {SPANS} --main-- select medclm_key, f.sdr_person_id, serv_from_date, load_date, src_rpt_cust_id, effective_date
       from fx_med_line_fact f join mc on f.sdr_person_id = mc.sdr_person_id and f.src_cust_id = mc.src_cust_id
       where serv_from_date >= effective_date and load_date >= effective_date
       and serv_from_date < effective_date + interval 12 month and load_date < effective_date + interval 12 month""",
)
def _(t):
    members = member_rows(t).select("sdr_person_id", "src_cust_id", "src_rpt_cust_id", "effective_date")
    near = joins.plan_year_filter(
        t.fx_med_line_fact, members, ["sdr_person_id", "src_cust_id"], ["serv_from_date", "load_date"]
    )
    return near.select("medclm_key", "sdr_person_id", "serv_from_date", "load_date", "src_rpt_cust_id", "effective_date")


SPINE = """
    sn as (select group_id, underwriting_date, m as month_from_uw,
      cast(date_trunc('month', data_thru) - to_months(m - 1) as date) as month_start,
      last_day(cast(date_trunc('month', data_thru) - to_months(m - 1) as date)) as month_end,
      case when m >= 10 then 3 when m > 3 then 2 else 1 end as times
      from (select *, cast(unnest(range(1, 27)) as int) as m from fx_vendor_group) z)
"""


@query(
    "j05_month_range_join",
    f"""with {SPINE} --main-- select v.group_id, member_id, claim_id, from_date, charged, month_from_uw, times
       from fx_vendor_med v join sn on v.group_id = sn.group_id and from_date between month_start and month_end""",
)
def _(t):
    near = joins.month_range_join(t.fx_vendor_med, t.fx_vendor_group, "from_date")
    return near.select("group_id", "member_id", "claim_id", "from_date", "charged", "month_from_uw", "times")


@query(
    "j06_month_spine",
    f"""with {SPINE} --main-- select * from sn""",
)
def _(t):
    spine = joins.month_spine(t.fx_vendor_group)
    return spine.select("group_id", "underwriting_date", "month_from_uw", "month_start", "month_end", "times")


@query(
    "j07_members_by_period",
    "select c_custkey, times from customer, (values (1), (2), (3)) as p(times)",
)
def _(t):
    return joins.with_periods(t.customer.select("c_custkey"))


@query(
    "j08_age_factor_join",
    f"""with {SPANS} --main-- select src_rpt_cust_id, src_cust_id, sdr_person_id, effective_date, sex_cd, subscriber_flag,
       cast(age as int) as age, age_gender_factor from mf""",
)
def _(t):
    rows = coverage.covered_rows(t.fx_crosswalk, t.fx_coverage, t.fx_person, SETTINGS)
    aged = coverage.age_factor_join(rows, t.fx_age_factor)
    return aged.select(
        "src_rpt_cust_id", "src_cust_id", "sdr_person_id", "effective_date", "sex_cd", "subscriber_flag", "age",
        "age_gender_factor",
    )


LONG_CODES = """
    lc as (select medclm_key, 'md' as datatype, primary_diag_cd as value from fx_med_line_fact union all
      select medclm_key, 'mc', hcpcs_cpt4_base_cd1 from fx_med_line_fact where hcpcs_cpt4_base_cd1 is not null)
"""


def long_codes(t):
    facts = t.fx_med_line_fact
    dx = facts.select("medclm_key", F.lit("md").alias("datatype"), F.col("primary_diag_cd").alias("value"))
    proc = facts.select("medclm_key", F.lit("mc").alias("datatype"), F.col("hcpcs_cpt4_base_cd1").alias("value"))
    return dx.union(proc.where("value is not null"))


@query(
    "j09_replace_genetic",
    f"""with {LONG_CODES} --main-- select medclm_key, datatype, case when datatype = 'md' and icd10 is not null then '99999'
       when datatype = 'mc' and symp is not null then '99999' else value end as value
       from lc left join fx_icd_genetic on value = icd10 left join fx_cpt_genetic on value = symp""",
)
def _(t):
    return claims.replace_genetic(long_codes(t), claims.genetic_list(t.fx_icd_genetic, t.fx_cpt_genetic))


@query(
    "j10_replace_by_category",
    f"""with {LONG_CODES} --main-- select medclm_key, datatype, case when datatype = 'md' then coalesce(prefx_map_id, 'hcup_unk')
       else value end as value from lc left join fx_icd_map on value = diag_cd""",
)
def _(t):
    return claims.replace_by_category(long_codes(t), t.fx_icd_map)


@query(
    "j11_two_edition_category",
    """select medclm_key, primary_diag_cd, coalesce(a.prefx_map_id, b.prefx_map_id, 'hcup_unk') as category
       from fx_med_line_fact left join (select diag_cd, 'first_' || prefx_map_id as prefx_map_id from fx_icd_map
       where diag_cd < 'D2') a on primary_diag_cd = a.diag_cd left join fx_icd_map b on primary_diag_cd = b.diag_cd""",
)
def _(t):
    first = t.fx_icd_map.where("diag_cd < 'D2'").withColumn("prefx_map_id", F.concat(F.lit("first_"), "prefx_map_id"))
    rows = t.fx_med_line_fact.select("medclm_key", "primary_diag_cd")
    return joins.two_edition_category(rows, "primary_diag_cd", first, t.fx_icd_map, SETTINGS.unknown_category)


@query(
    "j12_coverage_person",
    f"""with {SPANS} --main-- select src_rpt_cust_id, src_cust_id, sdr_person_id, effective_date, cov_eff_date, cov_end_date,
       subscriber_flag, sex_cd, birth_date from mr""",
)
def _(t):
    return coverage.covered_rows(t.fx_crosswalk, t.fx_coverage, t.fx_person, SETTINGS).select(
        "src_rpt_cust_id", "src_cust_id", "sdr_person_id", "effective_date", "cov_eff_date", "cov_end_date",
        "subscriber_flag", "sex_cd", "birth_date",
    )


@query(
    "j17_eligible_claims",
    """with l as (select *, case when revenue_cd is not null then 'i' else 'o' end as setting from fx_vendor_med),
       ids as (select claim_id from l where setting = 'i' union select claim_id from l join fx_drug_debits on proc_cd = hcpcs
       where setting = 'o')
       --main-- select claim_id, member_id, proc_cd, setting from l where claim_id in (select claim_id from ids)""",
)
def _(t):
    lines = t.fx_vendor_med.withColumn("setting", codes.claim_setting("revenue_cd"))
    kept = joins.eligible_claims(lines, t.fx_drug_debits.select(F.col("hcpcs").alias("cpt")))
    return kept.select("claim_id", "member_id", "proc_cd", "setting")


@query(
    "j18_exclude_values",
    "select medclm_key, primary_diag_cd from fx_med_line_fact where primary_diag_cd not in (select icd10 from fx_icd_genetic)",
)
def _(t):
    rows = t.fx_med_line_fact.select("medclm_key", "primary_diag_cd")
    return joins.exclude_values(rows, "primary_diag_cd", t.fx_icd_genetic, "icd10")


@query(
    "j16_new_keys_only",
    """select distinct o_custkey as key from orders where o_custkey not in
       (select c_custkey from customer where c_mktsegment = 'BUILDING')""",
)
def _(t):
    candidates = t.orders.select(F.col("o_custkey").alias("key"))
    known = t.customer.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("key"))
    return joins.new_keys_only(candidates, known, ["key"])


@query(
    "j19_drug_by_ndc_or_procedure",
    """select claim_id, v.ndc_id, proc_cd, coalesce(n.drug_name, h.drug_name) as drug_name, coalesce(n.debits, h.debits) as debits
       from fx_vendor_med v left join fx_drug_debits n on v.ndc_id = n.ndc_id left join fx_drug_debits h on proc_cd = h.hcpcs""",
)
def _(t):
    rows = t.fx_vendor_med.select("claim_id", "ndc_id", "proc_cd")
    drugs = t.fx_drug_debits.withColumn("debits", F.col("debits").cast("decimal(4,1)"))
    return joins.drug_by_ndc_or_procedure(rows, drugs, "ndc_id", "proc_cd", ["drug_name", "debits"])


@query(
    "j20_signal_join",
    """select claim_id, member_id, proc_cd, diag_1, event, signal, coalesce(cpt_signal, '') as cpt_signal,
       coalesce(dx_signal, '') as dx_signal from fx_vendor_med join fx_event_rules on
       (cpt_signal is not null and dx_signal is not null and proc_cd = cpt_signal and diag_1 = dx_signal)
       or (cpt_signal is null and diag_1 = dx_signal) or (dx_signal is null and proc_cd = cpt_signal)""",
)
def _(t):
    rows = t.fx_vendor_med.select("claim_id", "member_id", "proc_cd", "diag_1")
    rules = t.fx_event_rules.select("event", "signal", "cpt_signal", "dx_signal")
    return joins.signal_join(rows, rules, "proc_cd", "diag_1")


@query(
    "j21_source_match",
    """select o_orderkey, o_custkey, max(case when o2.o_orderpriority = '1-URGENT' then 1 else 0 end) as urgent,
       max(case when o2.o_orderpriority = '5-LOW' then 1 else 0 end) as low
       from (select o_orderkey, o_custkey, cast(o_orderdate as date) as d from orders) o
       left join (select o_custkey as k, cast(o_orderdate as date) as e, o_orderpriority from orders) o2
       on o_custkey = k and e between d - interval 820 day and d - interval 90 day group by 1, 2""",
)
def _(t):
    orders = t.orders.withColumn("day", F.col("o_orderdate").cast("date"))
    submissions = orders.select("o_orderkey", "o_custkey", "day")
    matched = joins.source_match(
        submissions, orders, {"o_custkey": "o_custkey"}, "day", "day", "o_orderpriority",
        {"urgent": "1-URGENT", "low": "5-LOW"},
    )
    return matched.drop("day")


@query(
    "j22_partition_lookup",
    """select o_orderkey, o_custkey, part_name from orders left join (select c_custkey, case when c_custkey % 10 < 6 then 'train'
       when c_custkey % 10 < 8 then 'valid' end as part_name from customer where c_custkey % 10 <> 9) p on o_custkey = c_custkey""",
)
def _(t):
    digit = F.col("c_custkey") % 10
    stored = t.customer.where(digit != 9).select(
        F.col("c_custkey"), F.when(digit < 6, "train").when(digit < 8, "valid").alias("part_name")
    )
    return joins.attach(t.orders.select("o_orderkey", "o_custkey"), stored, {"o_custkey": "c_custkey"}, ["part_name"])


@query(
    "j23_area_lookup",
    """select c_custkey, n_regionkey, n_name, r_name from customer join nation on c_nationkey = n_nationkey
       left join (select * from region where r_regionkey < 3) r on n_regionkey = r_regionkey and substr(n_name, 1, 6) = 'NATION'""",
)
def _(t):
    places = t.customer.select("c_custkey", "c_nationkey").join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = places.select("c_custkey", "n_regionkey", "n_name", F.substring("n_name", 1, 6).alias("stem"))
    areas = t.region.where("r_regionkey < 3").withColumn("r_stem", F.lit("NATION"))
    return joins.attach(rows, areas, {"n_regionkey": "r_regionkey", "stem": "r_stem"}, ["r_name"]).drop("stem")


@query(
    "j24_merge_features",
    """select c_custkey, times, coalesce(n_med, 0) as n_med, coalesce(s_med, 0) as s_med, coalesce(n_rx, 0) as n_rx
       from customer cross join (values (1), (2), (3)) as p(times)
       left join (select cast(member_id as bigint) as k, t, count(*) as n_med, sum(units) as s_med from
       (select *, case when month(from_date) < 4 then 1 when month(from_date) < 7 then 2 else 3 end as t from fx_vendor_med) z
       group by 1, 2) a on c_custkey = a.k and times = a.t
       left join (select cast(member_id as bigint) as k, t, count(*) as n_rx from
       (select *, case when month(rx_month) < 4 then 1 when month(rx_month) < 7 then 2 else 3 end as t from fx_vendor_rx) z
       group by 1, 2) b on c_custkey = b.k and times = b.t""",
)
def _(t):
    def period(day):
        return F.when(F.month(day) < 4, 1).when(F.month(day) < 7, 2).otherwise(3).alias("times")

    key = F.col("member_id").cast("bigint").alias("c_custkey")
    med = t.fx_vendor_med.groupBy(key, period("from_date")).agg(
        F.count("*").alias("n_med"), F.sum("units").alias("s_med")
    )
    rx = t.fx_vendor_rx.groupBy(key, period("rx_month")).agg(F.count("*").alias("n_rx"))
    base = joins.with_periods(t.customer.select("c_custkey"))
    return joins.merge_features(base, {"med": med, "rx": rx}, ["c_custkey", "times"], ["n_med", "s_med", "n_rx"])
