"""Sort, limit and set operations."""

from pyspark.sql import functions as F

from ..registry import query
from ...functions import dates
from ...operators import reports
from ...session import scratch_path


@query(
    "o01_report_sort",
    """select o_orderkey, detected, o_totalprice, row_number() over (order by rk desc, o_totalprice desc, o_orderkey) as position
       from (select *, case when m < 4 then '0-3 Months to UW' when m < 12 then '4-12 Months to UW' else '13+ Months to UW' end
       as detected, case when m < 4 then 3 when m < 12 then 2 else 1 end as rk from (select o_orderkey, o_totalprice,
       o_orderkey % 20 as m from orders) y) x""",
)
def _(t):
    rows = t.orders.select(
        "o_orderkey", dates.detection_range(F.col("o_orderkey") % 20).alias("detected"), "o_totalprice"
    )
    order = [dates.detection_rank("detected").desc(), F.col("o_totalprice").desc(), F.col("o_orderkey")]
    return reports.sorted_report(rows, order, "position")


@query(
    "o02_top_k",
    "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 100",
)
def _(t):
    return reports.top_k(t.orders.select("o_orderkey", "o_totalprice"), [F.col("o_totalprice").desc(), F.col("o_orderkey")], 100)


@query(
    "o03_threshold_rows",
    "select l_orderkey, l_linenumber, l_extendedprice, l_discount from lineitem where l_extendedprice >= 60000 or l_discount >= 0.09",
)
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount")
    return reports.threshold_rows(rows, {"l_extendedprice": 60000.0, "l_discount": 0.09})


@query(
    "o04_union_codes",
    "select 'md' as datatype, primary_diag_cd as value from fx_med_line_fact union all select 'nd', ndc_id from fx_rx_claims",
)
def _(t):
    a = t.fx_med_line_fact.select(F.lit("md").alias("datatype"), F.col("primary_diag_cd").alias("value"))
    return reports.union_by_position(a, t.fx_rx_claims.select(F.lit("nd"), "ndc_id"))


@query(
    "o05_union_by_name",
    """select group_id, member_id, proc_cd, charged, null as days_supply from fx_vendor_med union all
       select group_id, member_id, null, null, days_supply from fx_vendor_rx""",
)
def _(t):
    return reports.union_by_name(
        [t.fx_vendor_med.select("group_id", "member_id", "proc_cd", "charged"),
         t.fx_vendor_rx.select("days_supply", "group_id", "member_id")]
    )


@query(
    "o06_one_row_per_key",
    """select * from (select o_custkey, o_orderkey, o_totalprice from orders) x
       qualify row_number() over (partition by o_custkey order by o_orderkey) = 1""",
)
def _(t):
    return reports.one_row_per_key(t.orders.select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], [F.col("o_orderkey")])


@query(
    "o06_distinct_rows",
    "select distinct l_suppkey, l_returnflag from lineitem",
)
def _(t):
    return t.lineitem.select("l_suppkey", "l_returnflag").distinct()


@query(
    "o07_running_results",
    """select 'a' as run, o_orderstatus, count(*) as n from orders group by 2 union all
       select 'b', o_orderstatus, count(*) from orders where o_orderkey % 2 = 0 group by 2""",
)
def _(t):
    path = scratch_path(t.spark, "results")
    first = t.orders.groupBy("o_orderstatus").agg(F.count("*").alias("n")).withColumn("run", F.lit("a"))
    second = t.orders.where("o_orderkey % 2 = 0").groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    reports.add_results(first, path, replace=True)
    return reports.add_results(second.withColumn("run", F.lit("b")), path)


@query(
    "o08_stack_by_key",
    """select o_custkey, sum(case when o_orderstatus = 'F' then o_totalprice end) as preds_f,
       sum(case when o_orderstatus = 'O' then o_totalprice end) as preds_o from orders where o_orderstatus in ('F', 'O') group by 1""",
    round={"preds_f": 4, "preds_o": 4},
)
def _(t):
    frames = {
        f"preds_{s.lower()}": t.orders.where(F.col("o_orderstatus") == s).groupBy("o_custkey").agg(F.sum("o_totalprice").alias("p"))
        for s in ("F", "O")
    }
    return reports.columns_by_key(frames, ["o_custkey"], "p")


@query(
    "o09_assemble_predictions",
    """select member_id, pred_ixx_1, pred_ixx_2, pred_ixx_3, pred_xox_1, pred_xox_2, pred_xox_3, pred_xxr_1, pred_xxr_2,
       pred_xxr_3 from fx_member_scores where coalesce(pred_ixx_1, pred_ixx_2, pred_ixx_3, pred_xox_1, pred_xox_2, pred_xox_3,
       pred_xxr_1, pred_xxr_2, pred_xxr_3) is not null""",
    round={f"pred_{s}_{i}": 6 for s in ("ixx", "xox", "xxr") for i in (1, 2, 3)},
)
def _(t):
    scores = t.fx_member_scores
    frames = {
        c: scores.where(F.col(c).isNotNull()).select("member_id", F.col(c).alias("p"))
        for c in scores.columns if c.startswith("pred_")
    }
    return reports.columns_by_key(frames, ["member_id"], "p")
