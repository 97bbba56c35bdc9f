"""Repricing rules."""

from pyspark.sql import functions as F

from ..registry import query
from ...functions import amounts
from ...operators import claims

FACT_CODES = """
    fc as (select f.*, l.ndc_id, l.diag_cd2, l.diag_cd3 from fx_med_line_fact f left join fx_med_line l
      on f.medclm_key = l.medclm_key),
    fp as (select fc.*, sign(serv_unit_cnt) * n.allowed_per_unit * least(trunc(n.serv_unit_cnt_max), abs(serv_unit_cnt)) as ndc_amt,
      sign(serv_unit_cnt) * r.allowed_per_unit * least(trunc(r.serv_unit_cnt_max), abs(serv_unit_cnt)) as rev_amt,
      sign(serv_unit_cnt) * c.allowed_per_unit * least(trunc(c.serv_unit_cnt_max), abs(serv_unit_cnt)) as cpt_amt
      from fc left join fx_ndc_price n on fc.ndc_id = n.ndc_id left join fx_rev_price r on fc.revenue_cd = r.revenue_cd
      left join fx_cpt_price c on fc.hcpcs_cpt4_base_cd1 = c.hcpcs_cpt4_base_cd1)
"""


def priced(t):
    lines = claims.join_line_codes(t.fx_med_line_fact, t.fx_med_line)
    return claims.reprice_by_all_codes(lines, t.fx_ndc_price, t.fx_rev_price, t.fx_cpt_price)


@query(
    "c01_unit_reprice",
    f"with {FACT_CODES} --main-- select medclm_key, ndc_amt, rev_amt, cpt_amt from fp",
    round={"ndc_amt": 6, "rev_amt": 6, "cpt_amt": 6},
)
def _(t):
    return priced(t).select("medclm_key", "ndc_amt", "rev_amt", "cpt_amt")


@query(
    "c02_rx_unit_reprice",
    """select sdr_person_id, service_date, r.ndc_id, sign(payable_metric_cnt) * allowed_per_unit
       * least(serv_unit_cnt_max, abs(payable_metric_cnt)) as amount from fx_rx_claims r left join fx_ndc_price p
       on r.ndc_id = p.ndc_id""",
    round={"amount": 6},
)
def _(t):
    rows = claims.unit_reprice(t.fx_rx_claims, t.fx_ndc_price, "ndc_id", "amount", "payable_metric_cnt", whole_limit=False)
    return rows.select("sdr_person_id", "service_date", "ndc_id", "amount")


@query(
    "c03_unit_reprice_floor",
    """select medclm_key, sign(serv_unit_cnt) * allowed_per_unit * greatest(trunc(serv_unit_cnt_max), abs(serv_unit_cnt)) as amount
       from fx_med_line_fact f left join fx_cpt_price c on f.hcpcs_cpt4_base_cd1 = c.hcpcs_cpt4_base_cd1""",
    round={"amount": 6},
)
def _(t):
    rows = claims.unit_reprice(t.fx_med_line_fact, t.fx_cpt_price, "hcpcs_cpt4_base_cd1", "amount", rule="floor")
    return rows.select("medclm_key", "amount")


VERTICAL = """
    vt as (select fp.*, 'mr' as datatype, revenue_cd as value from fp where revenue_cd is not null union all
      select fp.*, 'mc', hcpcs_cpt4_base_cd1 from fp where hcpcs_cpt4_base_cd1 is not null or ndc_id is not null union all
      select fp.*, 'md', primary_diag_cd from fp where primary_diag_cd is not null union all
      select fp.*, 'md', diag_cd2 from fp where diag_cd2 is not null union all
      select fp.*, 'md', diag_cd3 from fp where diag_cd3 is not null),
    va as (select *, case when datatype = 'md' then 0 when ndc_id is null and hcpcs_cpt4_base_cd1 is null
      then coalesce(rev_amt, allow_icob_amt) when datatype = 'mr' then 0 else coalesce(ndc_amt, cpt_amt, allow_icob_amt) end as a
      from vt),
    vc as (select *, case when abs(a) < abs(chrg_amt) then a else chrg_amt end as ag_allow_amt from va)
"""


@query(
    "c04_history_amount",
    f"with {FACT_CODES}, {VERTICAL} --main-- select medclm_key, datatype, value, ag_allow_amt from vc",
    round={"ag_allow_amt": 6},
)
def _(t):
    rows = claims.verticalize(
        priced(t), "revenue_cd", "hcpcs_cpt4_base_cd1", "ndc_id", ["primary_diag_cd", "diag_cd2", "diag_cd3"]
    )
    amount = amounts.history_amount(
        "datatype", "ndc_id", "hcpcs_cpt4_base_cd1", "ndc_amt", "cpt_amt", "rev_amt", "allow_icob_amt", "chrg_amt"
    )
    return rows.select("medclm_key", "datatype", "value", amount.alias("ag_allow_amt"))


@query(
    "c05_capped_by_charge",
    """select l_orderkey, l_linenumber, case when abs(a) < abs(c) then a else c end as amount from (select l_orderkey, l_linenumber,
       case when l_linenumber = 3 then null else (l_quantity - 25) * 1000 end as a,
       case when l_linenumber = 4 then null when l_linenumber = 5 then -l_extendedprice else l_extendedprice end as c
       from lineitem) x""",
)
def _(t):
    line, price = F.col("l_linenumber"), F.col("l_extendedprice")
    a = F.when(line != 3, (F.col("l_quantity") - 25) * 1000)
    c = F.when(line == 4, None).when(line == 5, -price).otherwise(price)
    return t.lineitem.select("l_orderkey", "l_linenumber", amounts.capped_by_charge(a, c).alias("amount"))


@query(
    "c06_target_amount",
    f"""with {FACT_CODES} --main-- select medclm_key, case when abs(a) < abs(chrg_amt) then a else chrg_amt end as amount
        from (select *, coalesce(ndc_amt, cpt_amt, rev_amt, allow_icob_amt) as a from fp) x""",
    round={"amount": 6},
)
def _(t):
    amount = amounts.target_amount("ndc_amt", "cpt_amt", "rev_amt", "allow_icob_amt", "chrg_amt")
    return priced(t).select("medclm_key", amount.alias("amount"))


RX_PRICED = """
    rp as (select r.*, case when abs(a) < abs(wac_ingrd_cost_amt) then a else wac_ingrd_cost_amt end as ag_allow_amt
      from (select q.*, coalesce(rx_cost, sign(payable_metric_cnt) * allowed_per_unit
      * least(serv_unit_cnt_max, abs(payable_metric_cnt)), 0) as a from fx_rx_claims q left join fx_ndc_price p
      on q.ndc_id = p.ndc_id) r)
"""


@query(
    "c07_rx_amount",
    f"with {RX_PRICED} --main-- select sdr_person_id, service_date, ndc_id, ag_allow_amt from rp",
    round={"ag_allow_amt": 6},
)
def _(t):
    return claims.rx_priced(t.fx_rx_claims, t.fx_ndc_price).select("sdr_person_id", "service_date", "ndc_id", "ag_allow_amt")


@query(
    "c08_vendor_line_amount",
    """select claim_id, member_id, proc_cd, coalesce(d, case when b > charged then charged else b end) as amount from
       (select *, case when claim_id % 10 = 0 then 129.0 end as d, coalesce(case when claim_id % 3 = 0 then units * 700 end,
       case when claim_id % 2 = 0 then units * 400 end, charged, 0) as b from fx_vendor_med) x""",
    round={"amount": 6},
)
def _(t):
    c, units = F.col("claim_id"), F.col("units")
    amount = amounts.vendor_line_amount(
        F.when(c % 10 == 0, 129.0), F.when(c % 3 == 0, units * 700), F.when(c % 2 == 0, units * 400), "charged"
    )
    return t.fx_vendor_med.select("claim_id", "member_id", "proc_cd", amount.alias("amount"))


@query(
    "c09_rx_vendor_amount",
    """select member_id, rx_month, v.ndc_id, coalesce(allowed, least(days_supply, serv_unit_cnt_max) * allowed_per_unit, 0) as amount
       from fx_vendor_rx v join fx_ndc_price p on v.ndc_id = p.ndc_id""",
    round={"amount": 6},
)
def _(t):
    rows = t.fx_vendor_rx.join(t.fx_ndc_price, "ndc_id")
    amount = amounts.rx_vendor_amount("allowed", "days_supply", "serv_unit_cnt_max", "allowed_per_unit")
    return rows.select("member_id", "rx_month", "ndc_id", amount.alias("amount"))


@query(
    "c10_period_debit_cost",
    """select l_orderkey, l_linenumber, 129.0 * l_quantity / case l_linenumber % 3 when 0 then 4 when 1 then 2 else 1 end as cost
       from lineitem""",
    round={"cost": 6},
)
def _(t):
    cost = amounts.period_debit_cost("l_quantity", F.col("l_linenumber") % 3 + 1)
    return t.lineitem.select("l_orderkey", "l_linenumber", cost.alias("cost"))
