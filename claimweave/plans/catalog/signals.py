"""Event signals, specialty drugs, diagnosis reports, term counts."""

from pyspark.sql import functions as F

from .aggregates import CENSUS, census
from .vendor import DIAGS, DX_SQL, LINES, MED_DEBIT, RX_SQL, debited, lines, procedures, rx_rows
from ..fixture_settings import SETTINGS
from ..registry import query
from ...functions import dates
from ...operators import joins, signals, summaries, vendor, words
from ...session import store_table

MONTHLY = [f"l_{i}" for i in range(17)]
GROUPS = """
    gr as (select g.group_id, underwriting_date, effective_date, data_thru, n as total_members,
      cast(300 + 20 * cast(g.group_id as int) as double) as pfm_calibrated from fx_vendor_group g
      join (select group_id, count(*) as n from fx_census group by 1) c on g.group_id = c.group_id)
"""
COUNTS = f"""{CENSUS},
    ct as (select group_id, count(*) filter (where age >= 18 and sex = 'M') as cm,
      count(*) filter (where age >= 18 and sex = 'F') as cf, count(*) filter (where age < 18) as cc from cs group by 1)
"""
SIGNALS = """
    eg as (select v.group_id, member_id, claim_id, from_date, proc_cd, underwriting_date, effective_date,
      unnest([diag_1, diag_2, diag_3]) as diag from fx_vendor_med v join fx_vendor_group g on v.group_id = g.group_id
      where from_date < underwriting_date),
    sg as (select eg.*, event, signal, event_cost, coalesce(cpt_signal, '') as cpt_signal, coalesce(dx_signal, '') as dx_signal,
      adult_male, adult_female, children, display_flag, base, step from eg join fx_event_rules on
      (cpt_signal is not null and dx_signal is not null and proc_cd = cpt_signal and diag = dx_signal)
      or (cpt_signal is null and diag = dx_signal) or (dx_signal is null and proc_cd = cpt_signal)),
    ls as (select * from sg qualify row_number() over (partition by event, underwriting_date, group_id, member_id, cpt_signal,
      dx_signal order by from_date desc, claim_id, proc_cd nulls first, diag nulls first) = 1)
"""
DIFF = """((year({b}) - year({a})) * 12.0 + (month({b}) - month({a})) + (day({b}) - day({a})) / cast(30.436875 as double))"""


def _likelihood(s, partial):
    parts = [f"case when {s} + 12 > 17 then base + step * 17 else 0 end"]
    for i in range(17):
        if partial:
            parts.append(f"(base + step * {i}) * least(1, greatest(0, {i + 1} - {s})) * least(1, greatest(0, {s} + 12 - {i}))")
        else:
            parts.append(f"case when {i + 1} > {s} and {s} + 12 > {i} then base + step * {i} else 0 end")
    return " + ".join(parts)


EVENTS = f"""{SIGNALS},
    ms as (select *, {DIFF.format(a='from_date', b='effective_date')} as s from ls),
    me as (select *, {_likelihood('s', False)} as event_likelihood from ms),
    mx as (select *, event_cost * event_likelihood as event_est_cost from me qualify row_number() over (partition by event,
      underwriting_date, group_id, member_id order by round(event_cost * event_likelihood, 9) desc, cpt_signal, dx_signal,
      claim_id) = 1)
"""


def rules(t):
    base = t.fx_event_rules
    monthly = {c: F.col("base") + F.col("step") * i for i, c in enumerate(MONTHLY)}
    typed = base.withColumns({c: F.col(c).cast("double") for c in ("event_cost", "base", "step")})
    return typed.withColumns({**monthly, "l_tail": F.col("base") + F.col("step") * 17}).drop("base", "step")


def groups(t):
    members = t.fx_census.groupBy("group_id").agg(F.count("*").alias("total_members"))
    rate = (F.lit(300.0) + 20 * F.col("group_id").cast("int")).alias("pfm_calibrated")
    return t.fx_vendor_group.join(members, "group_id").select("*", rate)


def people(t):
    return summaries.age_sex_counts(census(t), ["group_id"])


def latest(t):
    info = t.fx_vendor_group.select("group_id", "underwriting_date", "effective_date")
    claims = t.fx_vendor_med.join(info, "group_id").select(
        "group_id", "member_id", "claim_id", "from_date", "proc_cd", "underwriting_date", "effective_date", *DIAGS
    )
    return signals.latest_signals(claims, rules(t), DIAGS)


def member_events(t):
    return signals.member_event_cost(latest(t), MONTHLY, "l_tail")


@query(
    "e01_latest_signals",
    f"""with {SIGNALS} --main-- select event, group_id, member_id, underwriting_date, cpt_signal, dx_signal, from_date, claim_id,
        proc_cd, diag from ls""",
)
def _(t):
    return latest(t).select(
        "event", "group_id", "member_id", "underwriting_date", "cpt_signal", "dx_signal", "from_date", "claim_id", "proc_cd", "diag"
    )


@query(
    "e02_plan_likelihood",
    f"""with {SIGNALS}, ms as (select *, {DIFF.format(a='from_date', b='effective_date')} as s from sg)
        --main-- select claim_id, event, signal, diag, {_likelihood('s', False)} as whole, {_likelihood('s', True)} as part from ms""",
    round={"whole": 8, "part": 8},
)
def _(t):
    info = t.fx_vendor_group.select("group_id", "underwriting_date", "effective_date")
    claims = t.fx_vendor_med.join(info, "group_id").where("from_date < underwriting_date")
    keys = ["claim_id", "from_date", "effective_date", "proc_cd"]
    long = claims.select(*keys, *DIAGS).unpivot(keys, DIAGS, "c", "diag").drop("c")
    since = dates.calendar_month_diff("from_date", "effective_date")
    rows = joins.signal_join(long, rules(t), "proc_cd", "diag").withColumn("s", since)
    return rows.select(
        "claim_id", "event", "signal", "diag",
        signals.plan_likelihood("s", MONTHLY, "l_tail").alias("whole"),
        signals.plan_likelihood("s", MONTHLY, "l_tail", partial=True).alias("part"),
    )


@query(
    "e03_member_event_cost",
    f"""with {EVENTS} --main-- select event, group_id, member_id, underwriting_date, cpt_signal, dx_signal, event_likelihood,
        event_est_cost from mx""",
    round={"event_likelihood": 8, "event_est_cost": 4},
)
def _(t):
    return member_events(t).select(
        "event", "group_id", "member_id", "underwriting_date", "cpt_signal", "dx_signal", "event_likelihood", "event_est_cost"
    )


HIDE = "adult_male > cm or adult_female > cf or children > cc or display_flag = 'N'"


@query(
    "e04_imminent_events",
    f"""with {EVENTS}, {GROUPS}, {COUNTS} --main-- select mx.group_id, member_id, mx.underwriting_date,
        case when {HIDE} then 'Cannot Disclose' else event end as event_label,
        case when {HIDE} then 'Cannot Disclose' else signal end as signal_label, from_date as signal_date,
        case when d < 4 then '0-3 Months to UW' when d < 12 then '4-12 Months to UW' else '13+ Months to UW' end as detected,
        cast(event_cost as double) as event_cost, event_est_cost,
        event_est_cost / (12 * pfm_calibrated * total_members + 1e-5) as impact from
        (select *, {DIFF.format(a='from_date', b='underwriting_date')} as d from mx) mx join gr on mx.group_id = gr.group_id
        and mx.underwriting_date = gr.underwriting_date left join ct on mx.group_id = ct.group_id""",
    round={"event_est_cost": 4, "impact": 4},
)
def _(t):
    return signals.imminent_events(member_events(t), groups(t), people(t), SETTINGS)


RANGE = """case when {d} < 4 then '0-3 Months to UW' when {d} < 12 then '4-12 Months to UW' else '13+ Months to UW' end"""


def _period_sql(source, day):
    first, last = DIFF.format(a="f", b="underwriting_date"), DIFF.format(a="l", b="underwriting_date")
    return f"""select group_id, member_id, underwriting_date, drug_name, {RANGE.format(d=first)} as first_detected,
        {RANGE.format(d=last)} as last_detected from (select group_id, member_id, underwriting_date, drug_name, min({day}) as f,
        max({day}) as l from {source} group by 1, 2, 3, 4) z"""


PERIODS = f"""
    qm as (select * from qc where debits is not null),
    dp as ({_period_sql('qd', 'rx_month')} union all {_period_sql('qm', 'from_date')})
"""


def drug_rows(t):
    return rx_rows(t).join(t.fx_drug_debits, "ndc_id"), debited(t)


@query("e05_drug_periods", f"with {LINES}, {RX_SQL}, {PERIODS} --main-- select * from dp")
def _(t):
    return signals.drug_periods(*drug_rows(t))


@query(
    "e06_drug_report",
    f"""with {LINES}, {RX_SQL}, {PERIODS}, {GROUPS}, {COUNTS},
        au as (select group_id, member_id, drug_name, underwriting_date, times, earliest_period, latest_period,
        max(plan_yr_dollar) as d from (select group_id, member_id, drug_name, underwriting_date, times, earliest_period,
        latest_period, plan_yr_dollar from qd union all select group_id, member_id, drug_name, underwriting_date, times,
        earliest_period, latest_period, plan_yr_dollar from qm) u group by 1, 2, 3, 4, 5, 6, 7),
        im as (select au.group_id, member_id, drug_name, au.underwriting_date, cast(d as double) as plan_yr_dollar,
        max(case when times <= earliest_period and times >= latest_period then round(d / (12 * total_members * pfm_calibrated), 4)
        end) as impact from au join gr on au.group_id = gr.group_id and au.underwriting_date = gr.underwriting_date
        group by 1, 2, 3, 4, 5),
        dr as (select drug_name, max(adult_male) as adult_male, max(adult_female) as adult_female, max(children) as children,
        case when count(*) filter (where display_flag = 'N') > 0 then 'N' else 'Y' end as display_flag from fx_drug_debits group by 1)
        --main-- select im.group_id, im.member_id, im.drug_name, im.underwriting_date, case when {HIDE} then 'Cannot Disclose' else
        im.drug_name end as drug_label, last_detected, first_detected, plan_yr_dollar, impact,
        case when impact is null then 'Lower/Not Detected Recently' end as impact_note
        from im join dp using (group_id, member_id, drug_name, underwriting_date) join dr on im.drug_name = dr.drug_name
        left join ct on im.group_id = ct.group_id where plan_yr_dollar >= 1000 or impact >= 0.01""",
    round={"plan_yr_dollar": 2, "impact": 4},
)
def _(t):
    rx, med = drug_rows(t)
    return signals.drug_report(rx, med, t.fx_drug_debits, groups(t), people(t), SETTINGS)


CONDITIONS = f"""
    da as (select group_id, member_id, underwriting_date, diag, prefx_map_id as category,
      {DIFF.format(a='from_date', b='underwriting_date')} as months from (select *, unnest([diag_1, diag_2, diag_3]) as diag from ql) z
      join fx_icd_map on diag = diag_cd),
    sn2 as (select group_id, member_id, underwriting_date, category, min(months) as last_detected, max(months) as first_detected
      from da group by 1, 2, 3, 4),
    md as (select member_id, category, diag as mode_code from (select member_id, category, diag, count(*) as n from da
      group by 1, 2, 3) z qualify row_number() over (partition by member_id, category order by n desc, diag) = 1),
    kn as (select distinct group_id, member_id, value as category from dg),
    cd as (select sn2.group_id, sn2.member_id, sn2.underwriting_date, sn2.category, mode_code, last_detected, first_detected,
      case when {HIDE} then 'Cannot Disclose' else description end as description, case when {HIDE} then null else yearly_cost end
      as yearly_cost, {RANGE.format(d='last_detected')} as last_range, {RANGE.format(d='first_detected')} as first_range
      from sn2 join md using (member_id, category) join kn using (group_id, member_id, category)
      join fx_category_prevalence p on sn2.category = p.category left join ct on sn2.group_id = ct.group_id)
"""


def conditions(t):
    rows = lines(t)
    med_codes = vendor.diagnosis_codes(rows, t.fx_icd_map, t.fx_icd_genetic, DIAGS, SETTINGS)
    return signals.diagnosis_table(rows, med_codes, t.fx_icd_map, t.fx_category_prevalence, people(t), DIAGS)


@query(
    "e07_diagnosis_table",
    f"with {LINES}, {DX_SQL}, {COUNTS}, {CONDITIONS} --main-- select * from cd",
    round={"last_detected": 6, "first_detected": 6},
)
def _(t):
    return conditions(t)


WEIGHTS = """
    dk as (select group_id, member_id, underwriting_date, times, setting, sum(debit_cost) as dsum from dc group by 1, 2, 3, 4, 5),
    ca as (select group_id, member_id, underwriting_date, times, setting, prefx_map_id as category, sum(cost) as cpt_allowed
      from (select q.*, unnest([diag_1, diag_2, diag_3]) as diag, coalesce(dsum, case when coalesce(ndc_amt, cpt_amt, charged, 0)
      > charged then charged else coalesce(ndc_amt, cpt_amt, charged, 0) end) as cost from qc q
      left join dk using (group_id, member_id, underwriting_date, times, setting)) z join fx_icd_map on diag = diag_cd
      group by 1, 2, 3, 4, 5, 6),
    cb as (select group_id, member_id, underwriting_date, times, setting, prefx_map_id as category, sum(rev_amt) as rev_allowed
      from (select ql.*, unnest([diag_1, diag_2, diag_3]) as diag, charge_sign * allowed_per_unit
      * greatest(units, serv_unit_cnt_max) as rev_amt from ql left join fx_rev_price r on ql.revenue_cd = r.revenue_cd
      where proc_cd is null and ql.revenue_cd is not null) z join fx_icd_map on diag = diag_cd group by 1, 2, 3, 4, 5, 6),
    cw as (select group_id, member_id, underwriting_date, times, setting, category, coalesce(cpt_allowed, 0) as cpt_allowed,
      coalesce(rev_allowed, 0) as rev_allowed, coalesce(cpt_allowed, 0) + coalesce(rev_allowed, 0) as combined_allowed
      from ca full join cb using (group_id, member_id, underwriting_date, times, setting, category)),
    cx as (select *, cpt_allowed / (sum(cpt_allowed) over k + 0.01) as weight_cpt_allowed,
      rev_allowed / (sum(rev_allowed) over k + 0.01) as weight_rev_allowed,
      combined_allowed / (sum(combined_allowed) over k + 0.01) as weight_combined_allowed from cw
      window k as (partition by group_id, member_id, underwriting_date, times, setting))
"""
WEIGHT_ROUND = {
    **{c: 4 for c in ("cpt_allowed", "rev_allowed", "combined_allowed")},
    **{f"weight_{c}": 8 for c in ("cpt_allowed", "rev_allowed", "combined_allowed")},
}


def weights(t):
    stored = store_table(lines(t), "med_lines")
    rows = vendor.priced_procedures(stored, t.fx_ndc_price, t.fx_cpt_price, t.fx_drug_debits)
    hit = rows.where("debits is not null")
    debit = vendor.debit_by_code(hit, vendor.debit_summary(hit, vendor.LINE), vendor.LINE, ["ndc_id", "proc_cd"])
    revenue = vendor.priced_revenue(stored, t.fx_rev_price)
    return signals.category_cost_weights(rows, revenue, debit, t.fx_icd_map, DIAGS)


@query("e08_category_cost_weights", f"with {LINES}, {MED_DEBIT}, {WEIGHTS} --main-- select * from cx", round=WEIGHT_ROUND)
def _(t):
    return weights(t)


IMPACTS = """
    ip as (select group_id, member_id, category, sum(combined_allowed) / 100 as impact from cx group by 1, 2, 3),
    ii as (select diag_cd as diag, 'diagnosis number ' || substr(diag_cd, 2) as diag_desc, case when diag_cd = 'D12' then 'N' else 'Y'
      end as display_flag, 1 as adult_male, 1 as adult_female, case when diag_cd = 'D16' then 9000000 else 0 end as children
      from fx_icd_map)
"""


@query(
    "e09_condition_report",
    f"""with {LINES}, {MED_DEBIT}, {DX_SQL}, {GROUPS}, {COUNTS}, {CONDITIONS}, {WEIGHTS}, {IMPACTS},
        rk as (select cd.*, round(impact / pfm_calibrated, 4) as score_impact from cd join ip using (group_id, member_id, category)
        join gr on cd.group_id = gr.group_id),
        rr as (select *, row_number() over (partition by group_id order by score_impact desc, member_id, category,
        underwriting_date) as impact_rank from rk)
        --main-- select rr.group_id, description, last_range, first_range, impact_rank, case when {HIDE} then '' else mode_code end
        as mode_code, case when {HIDE} then '' else 'Diagnosis Number ' || substr(mode_code, 2) end as mode_description
        from rr join ii on mode_code = diag left join ct on rr.group_id = ct.group_id
        where yearly_cost >= 1000 or score_impact >= 0.01""",
)
def _(t):
    impacts = weights(t).groupBy("group_id", "member_id", "category").agg((F.sum("combined_allowed") / 100).alias("impact"))
    code = F.col("diag_cd")
    info = t.fx_icd_map.select(
        code.alias("diag"), F.concat(F.lit("diagnosis number "), F.substring(code, 2, 9)).alias("diag_desc"),
        F.when(code == "D12", "N").otherwise("Y").alias("display_flag"), F.lit(1).alias("adult_male"),
        F.lit(1).alias("adult_female"), F.when(code == "D16", 9000000).otherwise(0).alias("children"),
    )
    return signals.condition_report(conditions(t), impacts, groups(t), info, people(t), SETTINGS)


def quarter():
    return F.ceil(F.col("month_from_uw") / 3).cast("int").alias("quarter")


QROUND = {"units_per_occurrence": 6, "ag_allow_amt": 4}


@query(
    "e10_quarterly_specialty_med",
    f"""with {LINES} --main-- select cast(ceil(month_from_uw / 3.0) as int) as quarter, group_id, member_id, underwriting_date,
        proc_cd, q.ndc_id, setting, max(coalesce(n.drug_name, h.drug_name)) as drug_name, count(*) as occurrences,
        sum(units) / count(*) as units_per_occurrence, sum(charged) as charge_amt,
        sum(case when coalesce(ndc_amt, cpt_amt, charged, 0) > charged then charged else coalesce(ndc_amt, cpt_amt, charged, 0) end)
        as ag_allow_amt, cast(max(coalesce(n.debits, h.debits, 0)) as double) as debits, cast(max(n.debits) as double) as ndc_debits,
        cast(max(h.debits) as double) as procedure_debits, cast(max(coalesce(n.debits, h.debits, 0)) * 10 as double) as minimum_charge
        from qc q left join fx_drug_debits h on proc_cd = h.hcpcs left join fx_drug_debits n on q.ndc_id = n.ndc_id
        where coalesce(n.ndc_id, h.hcpcs) is not null group by 1, 2, 3, 4, 5, 6, 7""",
    round={**QROUND, "charge_amt": 4},
)
def _(t):
    drugs = t.fx_drug_debits.withColumn("debits", F.col("debits").cast("double")).withColumn("minimum_charge", F.col("debits") * 10)
    rows = procedures(t).drop("drug_name", "debits").withColumn("quarter", quarter())
    return signals.quarterly_specialty_med(rows, drugs)


@query(
    "e10_quarterly_specialty_rx",
    f"""with {LINES}, {RX_SQL} --main-- select cast(ceil((year(data_thru) * 12 + month(data_thru) - year(rx_month) * 12
        - month(rx_month) + 1) / 3.0) as int) as quarter, qd.group_id, member_id, qd.underwriting_date, ndc_id,
        max(drug_name) as drug_name, count(*) as occurrences, sum(days_supply) / count(*) as units_per_occurrence,
        sum(allowed) as allow_amt, sum(ag_allow) as ag_allow_amt, cast(max(debits) as double) as debits,
        cast(max(debits) * 10 as double) as minimum_charge from qd join fx_vendor_group g on qd.group_id = g.group_id
        group by 1, 2, 3, 4, 5""",
    round={**QROUND, "allow_amt": 4},
)
def _(t):
    drugs = t.fx_drug_debits.withColumn("debits", F.col("debits").cast("double")).withColumn("minimum_charge", F.col("debits") * 10)
    return signals.quarterly_specialty_rx(rx_rows(t).withColumn("quarter", quarter()), drugs)


STOP = ", ".join("'" + w.replace("'", "''") + "'" for w in words.ENGLISH_STOP_WORDS)


@query(
    "e11_term_counts",
    f"""select term, count(*) as n from (select coalesce(lang, '') as lang, unnest(string_split_regex(regexp_replace(lower(text), '[[:punct:]0-9]', '', 'g'),
        '[ \\t\\n\\v\\f\\r]+')) as term from documents) x where length(term) >= 1 and not (lang = 'en' and term in ({STOP})) group by 1""",
)
def _(t):
    return words.term_counts(t.documents, "text", language="lang")


@query(
    "e12_apply_event_debit",
    f"""with {EVENTS}, {GROUPS} --main-- select gr.group_id, underwriting_date, coalesce(d, 0) as med_debit_rs, pfm_calibrated / 300
        + coalesce(d, 0) as risk_pfm from gr left join (select mx.group_id, sum(event_est_cost) / (12 * max(pfm_calibrated)
        * max(total_members) + 1e-5) as d from mx join gr on mx.group_id = gr.group_id where mx.group_id <> '3' group by 1) e
        on gr.group_id = e.group_id""",
    round={"med_debit_rs": 8, "risk_pfm": 8},
)
def _(t):
    info = groups(t)
    rows = member_events(t).where("group_id <> '3'").join(
        info.select("group_id", "total_members", "pfm_calibrated"), "group_id"
    )
    risk = summaries.group_event_risk(
        rows, ["group_id", "underwriting_date"], "event_est_cost", "total_members", "pfm_calibrated"
    )
    base = info.select("group_id", "underwriting_date", (F.col("pfm_calibrated") / 300).alias("risk_pfm"))
    return signals.apply_event_debit(base, risk)
