"""Shares, spans, ranks, curves and bins."""

from pyspark.sql import functions as F

from ..registry import query
from ...operators import windows

LONG_DX = """
    dx as (select group_id, member_id, claim_id, from_date, dx, coalesce(prefx_map_id, 'hcup_unk') as category from
      (select group_id, member_id, claim_id, from_date, unnest([diag_1, diag_2, diag_3]) as dx from fx_vendor_med) z
      left join fx_icd_map on dx = diag_cd where dx is not null)
"""


def long_dx(t):
    from ...operators.joins import attach
    from ...operators.reshape import melt_codes

    long = melt_codes(
        t.fx_vendor_med, ["group_id", "member_id", "claim_id", "from_date"], ["diag_1", "diag_2", "diag_3"], "dx"
    )
    mapped = attach(long, t.fx_icd_map, {"dx": "diag_cd"}, ["prefx_map_id"])
    return mapped.select("group_id", "member_id", "claim_id", "from_date", "dx",
                         F.coalesce("prefx_map_id", F.lit("hcup_unk")).alias("category"))


@query(
    "w02_detection_span",
    f"""with {LONG_DX} --main-- select group_id, member_id, category, claim_id, months,
        min(months) over (partition by group_id, member_id, category) as last_detected,
        max(months) over (partition by group_id, member_id, category) as first_detected
        from (select *, date_diff('day', from_date, date '2002-01-01') as months from dx) y""",
)
def _(t):
    import datetime as dt

    rows = long_dx(t).withColumn("months", F.datediff(F.lit(dt.date(2002, 1, 1)), "from_date").cast("bigint"))
    kept = rows.select("group_id", "member_id", "category", "claim_id", "months")
    return windows.detection_span(kept, ["group_id", "member_id", "category"], "months")


@query(
    "w03_most_frequent",
    f"""with {LONG_DX} --main-- select member_id, category, dx as mode_code from (select member_id, category, dx, count(*) as n
        from dx group by 1, 2, 3) y qualify row_number() over (partition by member_id, category order by n desc, dx) = 1""",
)
def _(t):
    return windows.most_frequent(long_dx(t), ["member_id", "category"], "dx")


@query(
    "w04_share_of_group",
    """select group_id, member_id, claim_id, proc_cd, coalesce(charged, 0) as amt, coalesce(charged, 0)
       / (sum(coalesce(charged, 0)) over (partition by group_id) + 0.01) as share from fx_vendor_med""",
    round={"share": 10},
)
def _(t):
    rows = t.fx_vendor_med.select("group_id", "member_id", "claim_id", "proc_cd", F.coalesce("charged", F.lit(0.0)).alias("amt"))
    return windows.share_of_group(rows, ["group_id"], "amt", "share")


@query(
    "w05_lorenz_curve",
    """select partition_name, pred, sum(w) over c / sum(w) over a as share_weight, sum(wa) over c / sum(wa) over a as share_actual
       from (select partition_name, pred, sum(weight) as w, sum(weight * actual) as wa from fx_scored group by 1, 2) x
       window c as (partition by partition_name order by pred desc rows unbounded preceding), a as (partition by partition_name)""",
    round={"pred": 4, "share_weight": 8, "share_actual": 8},
)
def _(t):
    curve = windows.lorenz_curve(t.fx_scored, "pred", "actual", "weight", ["partition_name"])
    return curve.select("partition_name", "pred", "share_weight", "share_actual")


@query(
    "w06_quantile_bins",
    """with n as (select o_totalprice as x, row_number() over (order by o_totalprice) as r, count(*) over () as n from orders),
       k as (select i, case when n * i / 10.0 - 0.5 = floor(n * i / 10.0 - 0.5) and cast(floor(n * i / 10.0 - 0.5) as bigint) % 2 = 0
       then floor(n * i / 10.0 - 0.5) else floor(n * i / 10.0 - 0.5) + 1 end as pos, n
       from (select distinct n from n) a, (select unnest(range(11)) as i) b),
       e as (select distinct x from n join k on r = greatest(1, least(k.n, pos)))
       --main-- select o_orderkey, o_totalprice, cast(greatest(1, (select count(*) from e where e.x < o_totalprice)) as int) as bin
       from orders""",
)
def _(t):
    return windows.quantile_bins(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", 10)


@query(
    "w07_rank_by_impact",
    """select o_orderstatus, o_orderkey, row_number() over (partition by o_orderstatus order by o_totalprice desc, o_orderkey)
       as impact_rank from orders""",
)
def _(t):
    rows = t.orders.select("o_orderstatus", "o_orderkey", "o_totalprice")
    ranked = windows.ranked_by(rows, [F.col("o_totalprice").desc(), F.col("o_orderkey")], ["o_orderstatus"])
    return ranked.drop("o_totalprice")


@query(
    "w08_prediction_share",
    """select group_id, member_id, (coalesce(pred_xox_1, 0) + 0.01) / (sum(coalesce(pred_xox_1, 0)) over (partition by group_id)
       + 0.01) as share from fx_member_scores""",
    round={"share": 10},
)
def _(t):
    rows = t.fx_member_scores.select("group_id", "member_id", F.coalesce("pred_xox_1", F.lit(0.0)).alias("p"))
    return windows.prediction_share(rows, ["group_id"], "p", "share").drop("p")
