"""Vendor files."""

from pyspark.sql import functions as F

from .joins import SPINE
from ..fixture_settings import SETTINGS
from ..registry import query
from ...operators import joins, ordering, reshape, summaries, vendor

DIAGS = ["diag_1", "diag_2", "diag_3"]

LINES = f"""{SPINE},
    ql as (select v.group_id, member_id, claim_id, from_date, proc_cd, revenue_cd, ndc_id, coalesce(units, 0) as units,
      coalesce(charged, 0) as charged, diag_1, diag_2, diag_3, underwriting_date, month_from_uw, times,
      cast(sign(coalesce(charged, 0)) as int) as charge_sign, case when revenue_cd is not null then 'i' else 'o' end as setting
      from fx_vendor_med v join sn on v.group_id = sn.group_id and from_date between month_start and month_end),
    qc as (select ql.*, charge_sign * n.allowed_per_unit * greatest(units, n.serv_unit_cnt_max) as ndc_amt,
      charge_sign * c.allowed_per_unit * greatest(units, c.serv_unit_cnt_max) as cpt_amt,
      coalesce(d.drug_name, h.drug_name) as drug_name, coalesce(d.debits, h.debits) as debits,
      coalesce(d.plan_yr_dollar, h.plan_yr_dollar) as plan_yr_dollar,
      coalesce(d.earliest_period, h.earliest_period) as earliest_period,
      coalesce(d.latest_period, h.latest_period) as latest_period
      from ql left join fx_ndc_price n on ql.ndc_id = n.ndc_id left join fx_cpt_price c on proc_cd = c.hcpcs_cpt4_base_cd1
      left join fx_drug_debits d on ql.ndc_id = d.ndc_id left join fx_drug_debits h on proc_cd = h.hcpcs where proc_cd is not null)
"""
COST = "129.0 * (sum(mx) / sum(n)) / case times when 1 then 4 when 2 then 2 else 1 end"
MED_DEBIT = f"""
    dm as (select group_id, member_id, underwriting_date, times, setting, {COST} as debit_cost from
      (select group_id, member_id, underwriting_date, times, setting, drug_name, max(debits) as mx, count(*) as n from qc
      where debits is not null group by 1, 2, 3, 4, 5, 6) z group by 1, 2, 3, 4, 5),
    dc as (select group_id, member_id, underwriting_date, times, setting, ndc_id, proc_cd, sum(debit_cost) as debit_cost
      from qc join dm using (group_id, member_id, underwriting_date, times, setting)
      where debits is not null and ndc_id is not null and proc_cd is not null group by 1, 2, 3, 4, 5, 6, 7)
"""
AMOUNT = "coalesce(debit_cost, case when coalesce({a}, charged, 0) > charged then charged else coalesce({a}, charged, 0) end)"


def lines(t):
    return vendor.med_lines(t.fx_vendor_med, t.fx_vendor_group, SETTINGS)


def procedures(t):
    return vendor.priced_procedures(lines(t), t.fx_ndc_price, t.fx_cpt_price, t.fx_drug_debits)


def debited(t):
    return procedures(t).where("debits is not null")


def med_debit(t):
    rows = debited(t)
    return vendor.debit_by_code(rows, vendor.debit_summary(rows, vendor.LINE), vendor.LINE, ["ndc_id", "proc_cd"])


PROC_SQL = f"""
    pc as (select group_id, member_id, underwriting_date, times, setting, value, ndc_id, count(*) as occurrences,
      sum(units) / count(*) as units_per_occurrence, sum(charged) as charge_amt, sum(amt) as ag_allow_amt, 'mc' as datatype
      from (select qc.*, case when symp is not null then '99999' else proc_cd end as value,
      {AMOUNT.format(a='ndc_amt, cpt_amt')} as amt from qc left join dc using (group_id, member_id, underwriting_date, times,
      setting, proc_cd, ndc_id) left join fx_cpt_genetic on proc_cd = symp) z group by 1, 2, 3, 4, 5, 6, 7)
"""
CODE_ROUND = {"units_per_occurrence": 6, "charge_amt": 4, "ag_allow_amt": 4}


@query("a11_procedure_codes", f"with {LINES}, {MED_DEBIT}, {PROC_SQL} --main-- select * from pc", round=CODE_ROUND)
def _(t):
    return vendor.procedure_codes(procedures(t), med_debit(t), t.fx_cpt_genetic, SETTINGS)


REV_SQL = """
    rv as (select group_id, member_id, underwriting_date, times, setting, lpad(revenue_cd, 4, '0') as value,
      count(*) as occurrences, sum(units) / count(*) as units_per_occurrence, sum(charged) as charge_amt,
      sum(case when coalesce(rev_amt, charged, 0) > charged then charged else coalesce(rev_amt, charged, 0) end) as ag_allow_amt,
      'mr' as datatype, '' as ndc_id from (select ql.*, charge_sign * allowed_per_unit * greatest(units, serv_unit_cnt_max)
      as rev_amt from ql left join fx_rev_price r on ql.revenue_cd = r.revenue_cd where proc_cd is null
      and ql.revenue_cd is not null) z group by 1, 2, 3, 4, 5, 6),
    ru as (select distinct group_id, member_id, underwriting_date, times, setting, lpad(revenue_cd, 4, '0') as value,
      cast(0 as bigint) as occurrences, cast(0 as double) as units_per_occurrence, cast(0 as double) as charge_amt,
      cast(0 as double) as ag_allow_amt, 'mr' as datatype, '' as ndc_id from ql where proc_cd is not null
      and revenue_cd is not null)
"""


@query("a11_revenue_codes", f"with {LINES}, {REV_SQL} --main-- select * from rv union all select * from ru", round=CODE_ROUND)
def _(t):
    rows = lines(t)
    counted = vendor.revenue_codes(vendor.priced_revenue(rows, t.fx_rev_price), SETTINGS)
    return counted.unionByName(vendor.uncounted_revenue_codes(rows, SETTINGS))


DX_SQL = """
    dl as (select group_id, member_id, claim_id, underwriting_date, times, setting, unnest([diag_1, diag_2, diag_3]) as value
      from ql),
    dg as (select group_id, member_id, underwriting_date, times, setting, coalesce(prefx_map_id, 'hcup_unk') as value,
      count(*) as occurrences, 'md' as datatype from dl left join fx_icd_map on dl.value = diag_cd where dl.value is not null
      and dl.value not in (select icd10 from fx_icd_genetic) group by 1, 2, 3, 4, 5, 6)
"""


@query("a11_diagnosis_codes", f"with {LINES}, {DX_SQL} --main-- select * from dg")
def _(t):
    return vendor.diagnosis_codes(lines(t), t.fx_icd_map, t.fx_icd_genetic, DIAGS, SETTINGS)


RX_SQL = f"""
    qx as (select v.group_id, member_id, rx_month, v.ndc_id, days_supply, coalesce(allowed, 0) as allowed, underwriting_date,
      times, coalesce(allowed, least(days_supply, serv_unit_cnt_max) * allowed_per_unit, 0) as ag_allow
      from fx_vendor_rx v join sn on v.group_id = sn.group_id and rx_month between month_start and month_end
      left join fx_ndc_price p on v.ndc_id = p.ndc_id),
    qd as (select qx.*, drug_name, debits, plan_yr_dollar, earliest_period, latest_period from qx
      join fx_drug_debits d on qx.ndc_id = d.ndc_id),
    xm as (select * from (select group_id, member_id, underwriting_date, times, {COST} as debit_cost, sum(a) as a from
      (select group_id, member_id, underwriting_date, times, drug_name, max(debits) as mx, count(*) as n, sum(ag_allow) as a
      from qd group by 1, 2, 3, 4, 5) z group by 1, 2, 3, 4) y where debit_cost > a),
    xc as (select group_id, member_id, underwriting_date, times, ndc_id, sum(debit_cost) as debit_cost
      from qd join xm using (group_id, member_id, underwriting_date, times) group by 1, 2, 3, 4, 5),
    xr as (select group_id, member_id, underwriting_date, times, ndc_id, count(*) as occurrences,
      sum(days_supply) / count(*) as units_per_occurrence, sum(allowed) as allow_amt,
      sum(coalesce(debit_cost, ag_allow)) as ag_allow_amt, 'r' as rx_sample, 'rg' as datatype
      from qx left join xc using (group_id, member_id, underwriting_date, times, ndc_id) group by 1, 2, 3, 4, 5)
"""
RX_ROUND = {"units_per_occurrence": 6, "allow_amt": 4, "ag_allow_amt": 4}


def rx_rows(t):
    return vendor.rx_lines(t.fx_vendor_rx, t.fx_vendor_group, t.fx_ndc_price, SETTINGS)


@query("a11_rx_codes", f"with {LINES}, {RX_SQL} --main-- select * from xr", round=RX_ROUND)
def _(t):
    rows = rx_rows(t)
    hit = rows.join(t.fx_drug_debits, "ndc_id")
    cost = vendor.debit_summary(hit, vendor.PERSON, F.col("ag_allow"))
    return vendor.rx_codes(rows, vendor.debit_by_code(hit, cost, vendor.PERSON, ["ndc_id"]), SETTINGS)


@query("a12_debit_summary", f"with {LINES}, {MED_DEBIT} --main-- select * from dm", round={"debit_cost": 6})
def _(t):
    return vendor.debit_summary(debited(t), vendor.LINE)


@query(
    "a12_debit_override",
    f"""with {LINES}, dg as (select group_id, member_id, underwriting_date, times, setting, drug_name, max(debits) as mx, count(*) as n,
        sum(coalesce(charged, 0)) as spent from qc where debits is not null group by 1, 2, 3, 4, 5, 6) --main-- select group_id, member_id,
        underwriting_date, times, setting, 2500.0 as debit_cost from dg group by 1, 2, 3, 4, 5 having {COST} > sum(spent)""",
    round={"debit_cost": 6},
)
def _(t):
    """A constant takes the place of debit costs above what was charged."""
    return vendor.debit_summary(debited(t), vendor.LINE, F.coalesce("charged", F.lit(0.0)), override=2500.0)


@query("a12_debit_by_code", f"with {LINES}, {MED_DEBIT} --main-- select * from dc", round={"debit_cost": 6})
def _(t):
    return med_debit(t)


DEBITS = """
    dr as (select group_id, underwriting_date, sum(d) as rx_debits from (select group_id, underwriting_date, drug_name,
      max(plan_yr_dollar) as d from (select group_id, underwriting_date, times, drug_name, plan_yr_dollar, earliest_period,
      latest_period from qd union all select group_id, underwriting_date, times, drug_name, plan_yr_dollar, earliest_period,
      latest_period from qc where debits is not null) u where times <= earliest_period and times >= latest_period
      group by 1, 2, 3) z group by 1, 2),
    ec as (select claim_id from ql where setting = 'i' union select claim_id from ql join fx_drug_debits on proc_cd = hcpcs
      where setting = 'o'),
    dd as (select group_id, underwriting_date, sum(d) as med_debits from (select group_id, member_id, underwriting_date,
      diag_grouping, max(plan_yr_dollar) as d from dl join fx_diag_debits on value = diag_cd
      where claim_id in (select claim_id from ec) and times <= earliest_period and times >= latest_period group by 1, 2, 3, 4) z
      group by 1, 2),
    pd as (select coalesce(dr.group_id, dd.group_id) as group_id, coalesce(dr.underwriting_date, dd.underwriting_date)
      as underwriting_date, coalesce(med_debits, 0) as med_debits, coalesce(rx_debits, 0) as rx_debits
      from dr full join dd on dr.group_id = dd.group_id and dr.underwriting_date = dd.underwriting_date)
"""


@query(
    "a13_period_debits",
    f"with {LINES}, {DX_SQL}, {RX_SQL}, {DEBITS} --main-- select * from pd",
    round={"med_debits": 4, "rx_debits": 4},
)
def _(t):
    rows = lines(t)
    kept = joins.eligible_claims(rows, t.fx_drug_debits.select(F.col("hcpcs").alias("cpt")))
    dx = reshape.melt_codes(kept, vendor.LINE, DIAGS)
    return vendor.period_debits([rx_rows(t).join(t.fx_drug_debits, "ndc_id"), debited(t)], dx, t.fx_diag_debits)


def score_lookups(t):
    return {
        "ndc_price": t.fx_ndc_price, "cpt_price": t.fx_cpt_price, "rev_price": t.fx_rev_price, "drugs": t.fx_drug_debits,
        "cpt_genetic": t.fx_cpt_genetic, "icd_genetic": t.fx_icd_genetic, "icd_map": t.fx_icd_map,
        "diag_debits": t.fx_diag_debits, "eligible_cpt": t.fx_drug_debits.select(F.col("hcpcs").alias("cpt")),
    }


@query(
    "k10_score_inputs_med",
    f"""with {LINES}, {MED_DEBIT}, {PROC_SQL}, {REV_SQL}, {DX_SQL} --main-- select * from pc union all by name select * from rv
        union all by name select * from ru union all by name select * from dg""",
    round=CODE_ROUND,
)
def _(t):
    return vendor.score_inputs_med(t.fx_vendor_med, t.fx_vendor_group, score_lookups(t), DIAGS, SETTINGS)


@query("k10_score_inputs_rx", f"with {LINES}, {RX_SQL} --main-- select * from xr", round=RX_ROUND)
def _(t):
    return vendor.score_inputs_rx(t.fx_vendor_rx, t.fx_vendor_group, score_lookups(t), SETTINGS)


@query(
    "k10_score_inputs_groups",
    f"""with {LINES}, {DX_SQL}, {RX_SQL}, {DEBITS} --main-- select g.*, coalesce(med_debits, 0) as med_debits,
        coalesce(rx_debits, 0) as rx_debits from fx_vendor_group g left join pd on g.group_id = pd.group_id
        and g.underwriting_date = pd.underwriting_date""",
    round={"med_debits": 4, "rx_debits": 4},
)
def _(t):
    return vendor.score_inputs_groups(
        t.fx_vendor_med, t.fx_vendor_rx, t.fx_vendor_group, score_lookups(t), DIAGS, SETTINGS
    )


@query(
    "k11_injected_frames",
    """select group_id, member_id, ndc_id, count(*) as occurrences from fx_vendor_rx where rx_month >= date '1998-01-01'
       group by 1, 2, 3""",
)
def _(t):
    from ..steps import run_steps

    return run_steps(
        {"rx": t.fx_vendor_rx},
        [
            lambda f, s: {**f, "rx": f["rx"].where(F.col("rx_month") >= s.effective_from)},
            lambda f, s: {
                **f, "out": f["rx"].groupBy("group_id", "member_id", "ndc_id").agg(F.count("*").alias("occurrences"))
            },
        ],
        SETTINGS,
        schema={"group_id": "string", "member_id": "string", "ndc_id": "string", "occurrences": "bigint"},
    )


@query(
    "k12_claimants",
    """select distinct m.group_id, member_id, effective_date, underwriting_date, data_thru, 24 as hist_mths_avail from
       (select group_id, member_id from fx_vendor_med union select group_id, member_id from fx_vendor_rx) m
       join fx_vendor_group g on m.group_id = g.group_id""",
)
def _(t):
    return vendor.claimants([t.fx_vendor_rx, t.fx_vendor_med], t.fx_vendor_group)


@query(
    "a14_argmax_rows",
    """select * from fx_vendor_med qualify row_number() over (partition by member_id, proc_cd order by from_date desc,
       coalesce(charged, 0) desc, claim_id, ndc_id nulls first, revenue_cd nulls first, diag_1, units, diag_2 nulls first,
       diag_3 nulls first) = 1""",
)
def _(t):
    order = [
        (-F.unix_date("from_date")), (-F.coalesce("charged", F.lit(0.0))), F.col("claim_id"), F.col("ndc_id"),
        F.col("revenue_cd"), F.col("diag_1"), F.col("units"), F.col("diag_2"), F.col("diag_3"),
    ]
    return ordering.best_rows(t.fx_vendor_med, ["member_id", "proc_cd"], order)


@query(
    "a15_collapse_names",
    """select brand_key, case when min(p_name) = max(p_name) then max(p_name) else brand_key end as p_name,
       max(p_size) as p_size from (select *, p_brand || '-' || cast(p_size as varchar) || '-' || p_type as brand_key from part) x
       group by 1""",
)
def _(t):
    key = F.concat_ws("-", "p_brand", F.col("p_size").cast("string"), "p_type").alias("brand_key")
    return summaries.collapse_names(t.part.select(key, "p_name", "p_size"), "brand_key", "p_name", ["p_size"])
