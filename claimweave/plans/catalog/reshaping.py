"""Reshaping."""

from pyspark.sql import functions as F

from .repricing import FACT_CODES
from ..registry import query
from ...functions import codes
from ...operators import claims, coverage, reshape

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
TYPES = ["click", "error", "purchase", "signup", "view"]


@query(
    "r01_verticalize",
    f"""with {FACT_CODES} --main-- select medclm_key, 'mr' as datatype, revenue_cd as value from fc where revenue_cd is not null
        union all select medclm_key, 'mc', hcpcs_cpt4_base_cd1 from fc where hcpcs_cpt4_base_cd1 is not null or ndc_id is not null
        union all select medclm_key, 'md', primary_diag_cd from fc union all select medclm_key, 'md', diag_cd2 from fc
        where diag_cd2 is not null union all select medclm_key, 'md', diag_cd3 from fc where diag_cd3 is not null""",
)
def _(t):
    rows = claims.join_line_codes(t.fx_med_line_fact, t.fx_med_line)
    long = claims.verticalize(
        rows, "revenue_cd", "hcpcs_cpt4_base_cd1", "ndc_id", ["primary_diag_cd", "diag_cd2", "diag_cd3"]
    )
    return long.select("medclm_key", "datatype", "value")


@query(
    "r02_melt_diagnoses",
    """select * from (select claim_id, member_id, unnest([diag_1, diag_2, diag_3]) as value from fx_vendor_med) x
       where value is not null""",
)
def _(t):
    return reshape.melt_codes(t.fx_vendor_med, ["claim_id", "member_id"], ["diag_1", "diag_2", "diag_3"])


@query(
    "r03_expand_age_range",
    """select c_custkey, cast(unnest(range(c_custkey % 40, c_custkey % 40 + c_nationkey % 5 + 1)) as int) as age from customer""",
)
def _(t):
    low = (F.col("c_custkey") % 40).cast("int")
    ranges = t.customer.select(
        "c_custkey", low.alias("min_mbr_age"), (low + F.col("c_nationkey") % 5).alias("max_mbr_age")
    )
    return coverage.expand_age_range(ranges)


@query(
    "r04_dummy_code",
    "select c_custkey, "
    + ", ".join(f"case when c_mktsegment = '{s}' then 1 else 0 end as seg_{s}" for s in SEGMENTS)
    + " from customer",
)
def _(t):
    return reshape.dummy_code(t.customer.select("c_custkey", "c_mktsegment"), "c_mktsegment", prefix="seg_")


@query(
    "r05_levels_to_columns",
    "select user_id, " + ", ".join(f"max(case when event_type = '{e}' then 1 else 0 end) as has_{e}" for e in TYPES)
    + " from events group by 1",
)
def _(t):
    return reshape.levels_to_columns(t.events, ["user_id"], "event_type", TYPES, "has_")


@query(
    "r06_any_levels",
    "select *, " + " + ".join(TYPES) + " as num_event, case when " + " + ".join(TYPES)
    + " > 0 then 1 else 0 end as has_event from (select user_id, cast(ts as date) as day, "
    + ", ".join(f"max(case when event_type = '{e}' then 1 else 0 end) as {e}" for e in TYPES)
    + " from events group by 1, 2) x",
)
def _(t):
    rows = t.events.withColumn("day", F.col("ts").cast("date"))
    return reshape.any_levels(rows, ["user_id", "day"], "event_type", TYPES, "event")


@query(
    "r07_setting_pmpm",
    """select member_id, coalesce(sum(case when revenue_cd is not null then charged end), 0) / 24 as ip_pmpm,
       coalesce(sum(case when revenue_cd is null then charged end), 0) / 24 as op_pmpm from fx_vendor_med group by 1""",
    round={"ip_pmpm": 4, "op_pmpm": 4},
)
def _(t):
    rows = t.fx_vendor_med.withColumn("setting", codes.claim_setting("revenue_cd"))
    return reshape.setting_pmpm(rows, ["member_id"], "setting", "charged", {"ip_pmpm": "i", "op_pmpm": "o"})


@query(
    "r08_align_features",
    """select member_id, coalesce(pred_xox_1, 0) as pred_xox_1, coalesce(pred_xxr_2, 0) as pred_xxr_2, 0 as pred_new
       from fx_member_scores""",
    round={"pred_xox_1": 6, "pred_xxr_2": 6},
)
def _(t):
    return reshape.align_features(t.fx_member_scores, ["member_id"], ["pred_xox_1", "pred_xxr_2", "pred_new"])


@query(
    "r09_source_flags",
    """select user_id, max(case when event_type = 'click' then 1 else 0 end) as clicked,
       max(case when event_type = 'purchase' then 1 else 0 end) as bought from events group by 1""",
)
def _(t):
    return reshape.source_flags(t.events, ["user_id"], "event_type", {"clicked": "click", "bought": "purchase"})


VOCABULARY = [f"D{i}" for i in range(0, 31, 3)]


@query(
    "r10_multi_hot",
    "select claim_id, member_id, "
    + " || ".join(f"cast(cast(coalesce(list_contains(d, '{v}'), false) as int) as varchar)" for v in VOCABULARY)
    + " as hot from (select *, [diag_1, diag_2, diag_3] as d from fx_vendor_med) x",
)
def _(t):
    hot = reshape.multi_hot(F.array("diag_1", "diag_2", "diag_3"), VOCABULARY)
    return t.fx_vendor_med.select("claim_id", "member_id", F.array_join(hot, "").alias("hot"))


@query(
    "r11_columns_to_rows",
    "select l_orderkey, l_linenumber, unnest([l_quantity, l_discount, l_tax]) as value from lineitem",
)
def _(t):
    return reshape.columns_to_rows(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"])


@query(
    "r12_flatten_json",
    """select event_id, cast(json_extract(props, '$.k') as bigint) as k, cast(json_extract(props, '$.k') as bigint) + 1 as in_j
       from events""",
)
def _(t):
    k = F.get_json_object("props", "$.k").cast("bigint")
    nested = F.to_json(F.struct(k.alias("k"), F.struct((k + 1).alias("j")).alias("in")))
    rows = t.events.select("event_id", nested.alias("doc"))
    return reshape.flatten_json(rows, "doc", "k bigint, `in` struct<j: bigint>").withColumnRenamed("in.j", "in_j")


@query("r12_flatten_props", "select event_id, cast(json_extract(props, '$.k') as bigint) as k from events")
def _(t):
    return reshape.flatten_json(t.events.select("event_id", "props"), "props")


@query(
    "r13_pivot_scenarios",
    """select o_custkey, max(case when o_orderstatus = 'F' then o_totalprice end) as price_F,
       max(case when o_orderstatus = 'O' then o_totalprice end) as price_O,
       max(case when o_orderstatus = 'P' then o_totalprice end) as price_P from orders group by 1""",
)
def _(t):
    return reshape.pivot_scenarios(t.orders, "o_custkey", "o_orderstatus", "o_totalprice", ["F", "O", "P"], "price_")


IMPACTS = ["hcup_a_shap", "hcup_b_shap"]


@query(
    "r14_melt_impacts",
    """select l_orderkey, l_linenumber, 'hcup_a_shap' as name, l_quantity as impact, 'a' as code from lineitem union all
       select l_orderkey, l_linenumber, 'hcup_b_shap', l_tax, 'b' from lineitem""",
)
def _(t):
    wide = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias(IMPACTS[0]), F.col("l_tax").alias(IMPACTS[1])
    )
    return reshape.melt_impacts(wide, ["l_orderkey", "l_linenumber"], IMPACTS)


@query(
    "r15_concat_key",
    """select medclm_key, sdr_person_id || '|' || coalesce(revenue_cd, '~') || '|' || coalesce(hcpcs_cpt4_base_cd1, '~') as key
       from fx_med_line_fact""",
)
def _(t):
    return t.fx_med_line_fact.select(
        "medclm_key", codes.concat_key("sdr_person_id", "revenue_cd", "hcpcs_cpt4_base_cd1").alias("key")
    )


@query(
    "r16_code_label",
    """select claim_id, member_id, concat_ws(' ', 'CPT: ' || proc_cd, 'ICD: ' || diag_2) as label from fx_vendor_med""",
)
def _(t):
    return t.fx_vendor_med.select("claim_id", "member_id", codes.code_label("proc_cd", "diag_2").alias("label"))


@query(
    "r17_stack_code_columns",
    """select claim_id, member_id, proc_cd as code from fx_vendor_med where proc_cd is not null union all
       select claim_id, member_id, ndc_id from fx_vendor_med where ndc_id is not null""",
)
def _(t):
    return reshape.stack_code_columns(
        t.fx_vendor_med.select("claim_id", "member_id", "proc_cd", "ndc_id"), ["proc_cd", "ndc_id"], "code"
    )
