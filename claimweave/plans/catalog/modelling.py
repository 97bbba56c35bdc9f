"""Features, models and scoring."""

from pyspark.ml.feature import RFormula
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from .history import ALL, MEMBER_DATA, info, target
from ..fixture_settings import SETTINGS
from ..registry import query
from ...operators import features, models, ordering, penalized, targets, vendor

PREDS = [f"pred_{s}_{i}" for s in ("ixx", "xox", "xxr") for i in (1, 2, 3)]


def order_lines(t):
    """Line items with the price of their order: plenty of rows for the model queries."""
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))


@query("f01_rate_calibration")
def _(t):
    members = targets.member_data(target(t), info(t))
    fitted = models.rate_calibration(members, "mbr_mth_ag_cmpl_allow")
    return fitted.select("src_rpt_cust_id", "sdr_person_id", "underwriting_date", "bus_segment_cd", "rate_calibrated")


@query(
    "f01_rate_of_training_cells",
    ALL + f"""select src_rpt_cust_id, sdr_person_id, underwriting_date, avg(mbr_mth_ag_cmpl_allow) over (partition by bus_segment_cd, comm_rt,
    lf_group, aso_group) as rate_calibrated from ({MEMBER_DATA}) md where bus_segment_cd <> 'U' and train_subpartition = 'train'""",
    round={"rate_calibrated": 2},
)
def _(t):
    """The training groups have a level of their own each, so least squares gives them the mean of their members."""
    members = targets.member_data(target(t), info(t))
    fitted = models.rate_calibration(members, "mbr_mth_ag_cmpl_allow").where("train_subpartition = 'train'")
    return fitted.select("src_rpt_cust_id", "sdr_person_id", "underwriting_date", "rate_calibrated")


@query(
    "f02_apply_linear_rate",
    ALL + f"""select src_rpt_cust_id, sdr_person_id, underwriting_date, 310.5 + 12.25 * comm_rt - 7.5 * lf_group
    + case bus_segment_cd when 'S' then 21.0 when 'T' then -4.5 else 0 end as rate_calibrated from ({MEMBER_DATA}) md""",
    round={"rate_calibrated": 4},
)
def _(t):
    members = targets.member_data(target(t), info(t))
    rated = features.apply_linear_rate(
        members, {"comm_rt": 12.25, "lf_group": -7.5}, {"S": 21.0, "T": -4.5}, "bus_segment_cd", 310.5
    )
    return rated.select("src_rpt_cust_id", "sdr_person_id", "underwriting_date", "rate_calibrated")


TFIDF = """
    tf as (select member_id, month(from_date) % 3 + 1 as times, proc_cd, count(*) as tf from fx_vendor_med
      where proc_cd is not null group by 1, 2, 3),
    nn as (select count(*) as n from (select distinct member_id, times from tf) z),
    dd as (select proc_cd, count(*) as df from tf group by 1),
    rw as (select member_id, times, tf.proc_cd, tf * (ln((1 + n) / (1 + df)) + 1) as raw from tf join dd on tf.proc_cd = dd.proc_cd, nn),
    ti as (select member_id, times, proc_cd, raw / sqrt(sum(raw * raw) over (partition by member_id, times)) as tfidf from rw)
"""


def _tfidf(t):
    rows = t.fx_vendor_med.select("member_id", (F.month("from_date") % 3 + 1).alias("times"), "proc_cd")
    return features.code_tfidf(rows, ["member_id", "times"], "proc_cd")


@query("f03_code_tfidf", f"with {TFIDF} --main-- select * from ti", round={"tfidf": 8})
def _(t):
    return _tfidf(t)


VOCABULARY = ["C1", "C2", "C3", "C7", "C11", "C13"]


@query(
    "f03_code_tfidf_features",
    f"with {TFIDF} --main-- select member_id, times, "
    + ", ".join(f"coalesce(max(case when proc_cd = '{v}' then tfidf end), 0) as {v}" for v in VOCABULARY)
    + ", coalesce(sum(case when proc_cd in (" + ", ".join(f"'{v}'" for v in VOCABULARY)
    + ") then tfidf end), 0) as sum_cpt, 1 as has_cpt from ti group by 1, 2",
    round={**{v: 8 for v in VOCABULARY}, "sum_cpt": 8},
)
def _(t):
    return features.code_tfidf_features(_tfidf(t), ["member_id", "times"], "proc_cd", VOCABULARY)


@query("f04_period_models")
def _(t):
    lines = vendor.med_lines(t.fx_vendor_med, t.fx_vendor_group, SETTINGS)
    keys = ["group_id", "member_id"]
    med = lines.groupBy(*keys, "times", F.when(F.col("setting") == "i", "ixx").otherwise("xox").alias("setting")).agg(
        F.count("*").alias("n"), F.sum("charged").alias("charged"), F.sum("units").alias("units")
    )
    drugs = vendor.rx_lines(t.fx_vendor_rx, t.fx_vendor_group, t.fx_ndc_price, SETTINGS)
    rx = drugs.groupBy(*keys, "times").agg(
        F.count("*").alias("n"), F.sum("ag_allow").alias("charged"), F.sum("days_supply").alias("units")
    ).withColumn("setting", F.lit("xxr"))
    later = t.fx_vendor_med.groupBy("member_id").agg(F.sum("charged").alias("cost"))
    rows = med.unionByName(rx).join(later, "member_id")
    return models.period_models(rows, keys, ["n", "charged", "units"], "cost", ["ixx", "xox", "xxr"])


FLAGS = ("A", "N", "R")


@query(
    "f04_period_cells",
    "select count(distinct l_orderkey) as n, "
    + ", ".join(
        f"count(distinct case when l_returnflag = '{s}' and l_linenumber % 3 + 1 = {p} then l_orderkey end) as pred_{s}_{p}"
        for s in FLAGS for p in (1, 2, 3)
    )
    + " from lineitem",
)
def _(t):
    """Each key has a prediction of exactly the settings and periods in which it has rows."""
    rows = t.lineitem.select(
        "l_orderkey", F.col("l_returnflag").alias("setting"), (F.col("l_linenumber") % 3 + 1).cast("int").alias("times"),
        "l_quantity", "l_tax", "l_extendedprice",
    )
    found = models.period_models(rows, ["l_orderkey"], ["l_quantity", "l_tax"], "l_extendedprice", FLAGS, trees=2)
    return found.agg(F.count("*").alias("n"), *[F.count(f"pred_{s}_{p}").alias(f"pred_{s}_{p}") for s in FLAGS for p in (1, 2, 3)])


# Which sources have a prediction, and the stacked model for each mix of them.
SOURCES = ("ixx", "xox", "xxr")
HAS = ", ".join(f"coalesce(pred_{s}_1, pred_{s}_2, pred_{s}_3) is not null as has_{s}" for s in SOURCES)
MIXES = ", ".join(
    "(" + ", ".join(["true" if s in src else "false" for s in SOURCES] + [f"'{n}'"]) + ")" for n, src in models.STACKS.items()
)
SUMS = {
    n: " + ".join(f"coalesce(pred_{s}_{i}, 0)" for s in src for i in (1, 2, 3)) for n, src in models.STACKS.items()
}


@query(
    "f05_stacked_score",
    f"""with facts as (select *, {HAS} from fx_member_scores), mixes as (select * from (values {MIXES}) v(m_ixx, m_xox, m_xxr, pattern)),
      named as (select facts.*, coalesce(mixes.pattern, 'ior') as pattern from facts left join mixes on has_ixx = m_ixx and has_xox = m_xox
      and has_xxr = m_xxr) --main-- select group_id, member_id, pattern, case pattern """
    + " ".join(f"when '{n}' then {s}" for n, s in SUMS.items())
    + " end as score from named",
    round={"score": 6},
)
def _(t):
    stacked = t.fx_member_scores.withColumns(
        {
            f"pred_{n}": sum((F.coalesce(f"pred_{s}_{i}", F.lit(0.0)) for s in src for i in (1, 2, 3)), F.lit(0.0))
            for n, src in models.STACKS.items()
        }
    )
    return features.stacked_score(stacked).select("group_id", "member_id", "pattern", "score")


@query("f05_fit_stacked")
def _(t):
    cost = t.orders.groupBy(F.col("o_custkey").cast("string").alias("member_id")).agg(F.sum("o_totalprice").alias("cost"))
    rows = t.fx_member_scores.join(cost, "member_id")
    return models.fit_stacked(rows, "cost").select("group_id", "member_id", "pattern", "score")


@query(
    "f05_stacked_patterns",
    f"""with facts as (select *, {HAS} from fx_member_scores), mixes as (select * from (values {MIXES}) v(m_ixx, m_xox, m_xxr, pattern))
      --main-- select coalesce(mixes.pattern, 'ior') as pattern, count(*) as n, count(*) as scored from facts
      join (select distinct o_custkey from orders) o on member_id = cast(o_custkey as varchar)
      left join mixes on has_ixx = m_ixx and has_xox = m_xox and has_xxr = m_xxr group by 1""",
)
def _(t):
    """Every member is scored by the model of its mix of sources."""
    cost = t.orders.groupBy(F.col("o_custkey").cast("string").alias("member_id")).agg(F.sum("o_totalprice").alias("cost"))
    scored = models.fit_stacked(t.fx_member_scores.join(cost, "member_id"), "cost", trees=2)
    return scored.groupBy("pattern").agg(F.count("*").alias("n"), F.count("score").alias("scored"))


GROUP_SQL = """
    gq as (select c_nationkey as k, cast(count(*) as double) as w, avg(c_acctbal) / 1000 as x, avg(o_totalprice) / 100 as y
      from orders join customer on o_custkey = c_custkey group by 1),
    gb as (select (sum(w * x * y) / sum(w) - sum(w * x) / sum(w) * sum(w * y) / sum(w)) / (sum(w * x * x) / sum(w)
      - pow(sum(w * x) / sum(w), 2)) as b, sum(w * x) / sum(w) as mx, sum(w * y) / sum(w) as my from gq)
"""


def _groups(t):
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy(F.col("c_nationkey").alias("k")).agg(
        F.count("*").cast("double").alias("w"), (F.avg("c_acctbal") / 1000).alias("x"), (F.avg("o_totalprice") / 100).alias("y")
    )


@query(
    "f06_calibrated_offset",
    f"with {GROUP_SQL} --main-- select k, ln(greatest(my + b * (x - mx), 0) + 0.001) as offset_value from gq, gb",
    round={"offset_value": 6},
)
def _(t):
    scored = models.calibrated_offset(_groups(t), ["x"], "y", "w", "offset_value")
    return scored.select("k", "offset_value")


FEATURES_SQL = """
    gf as (select group_id, count(*) as total_members, avg(pred_xox_1) as score, count(pred_xox_1) as score_count,
      count(pred_ixx_1) as pred_ixx_1_count, cast(count(pred_xxr_1) as double) as any_xxr from fx_member_scores group by 1)
"""


def _features(t):
    return t.fx_member_scores.groupBy("group_id").agg(
        F.count("*").alias("total_members"), F.avg("pred_xox_1").alias("score"), F.count("pred_xox_1").alias("score_count"),
        F.count("pred_ixx_1").alias("pred_ixx_1_count"), F.count("pred_xxr_1").cast("double").alias("any_xxr"),
    )


@query(
    "f07_group_features",
    f"""with {FEATURES_SQL}, gg as (select *, score_count / total_members as score_pct, pred_ixx_1_count / total_members
        as pred_ixx_1_pct, (pow(score + 0.0001, -0.2) - 1) / (-0.2) as bc_score, ln(score + 0.001) as log_score from gf)
        --main-- select group_id, score_pct, pred_ixx_1_pct, any_xxr / total_members as any_xxr, bc_score, log_score,
        score_pct * score as score_ttl, log_score * score_pct as log_score_pct, bc_score * score_pct as bc_score_pct,
        ln(1.1 + 0.001) as log_quoted_pfm_rel from gg""",
    round={c: 8 for c in ("score_pct", "pred_ixx_1_pct", "any_xxr", "bc_score", "log_score", "score_ttl", "log_score_pct",
                          "bc_score_pct", "log_quoted_pfm_rel")},
)
def _(t):
    rows = _features(t).withColumn("quoted_pfm_rel", F.lit(1.1))
    return features.group_features(rows, ["score_count", "pred_ixx_1_count"], ["any_xxr"]).select(
        "group_id", "score_pct", "pred_ixx_1_pct", "any_xxr", "bc_score", "log_score", "score_ttl", "log_score_pct",
        "bc_score_pct", "log_quoted_pfm_rel",
    )


@query(
    "f08_group_risk",
    f"""with {FEATURES_SQL} --main-- select group_id, exp(o) as pfm_calibrated, score / (0.00001 + exp(o)) as risk_pfm,
        50000 / (12 * total_members * exp(o)) as rx_debit_rs, cast(0 as double) as med_debit_rs
        from (select *, ln(score * 0.9 + 0.001) as o from gf) x""",
    round={"pfm_calibrated": 6, "risk_pfm": 8, "rx_debit_rs": 8},
)
def _(t):
    rows = _features(t).withColumns(
        {"offset": features.log_offset(F.col("score") * 0.9), "rx_debits": F.lit(50000.0), "med_debits": F.lit(None).cast("double")}
    )
    return features.group_risk(rows, "score").select("group_id", "pfm_calibrated", "risk_pfm", "rx_debit_rs", "med_debit_rs")


DRAW = "cast(('0x' || substr(md5(cast({k} as varchar) || '|{s}'), 1, 8)) as bigint) / 4294967296.0"


@query(
    "f09_assign_partition",
    f"""select o_orderkey, o_custkey, coalesce(p, case when u <= 0.6 then 'train' when u <= 0.8 then 'valid' else 'test' end)
        as partition_name, coalesce(f, cast(floor(u * 10) + 1 as int)) as fold from (select o_orderkey, o_custkey,
        cast({DRAW.format(k='o_custkey', s=11)} as double) as u from orders) x left join (select c_custkey, 'valid' as p, 3 as f
        from customer where c_custkey % 50 = 0) s on o_custkey = c_custkey""",
)
def _(t):
    stored = t.customer.where("c_custkey % 50 = 0").select(
        F.col("c_custkey").alias("o_custkey"), F.lit("valid").alias("partition_name"), F.lit(3).alias("fold")
    )
    return features.assign_partition(t.orders.select("o_orderkey", "o_custkey"), ["o_custkey"], 0.6, 0.2, 11, stored)


@query(
    "f10_surrogate_ids",
    """select o_custkey, coalesce(id, sha256('salt' || cast(o_custkey as varchar))) as surrogate_id from
       (select o_custkey from orders union select c_custkey from customer where c_custkey % 20 = 0) x left join
       (select c_custkey, 'id-' || cast(c_custkey as varchar) as id from customer where c_custkey % 20 = 0) s on o_custkey = c_custkey""",
)
def _(t):
    stored = t.customer.where("c_custkey % 20 = 0").select(
        F.col("c_custkey").alias("o_custkey"), F.concat(F.lit("id-"), F.col("c_custkey").cast("string")).alias("surrogate_id")
    )
    return features.surrogate_ids(t.orders, "o_custkey", "salt", stored)


def _rcs_sql(x, k, j, before="k4", last="k5", scale="pow(k5 - k1, 2.0 / 3.0)"):
    def cube(t):
        return f"pow(greatest(({x} - {t}) / {scale}, 0), 3)"

    return f"{cube(k)} + (({before} - {k}) * {cube(last)} - ({last} - {k}) * {cube(before)}) / ({last} - {before})"


@query(
    "f11_rcs_basis",
    """with k as (select quantile_cont(l_extendedprice, 0.05) as k1, quantile_cont(l_extendedprice, 0.275) as k2,
       quantile_cont(l_extendedprice, 0.5) as k3, quantile_cont(l_extendedprice, 0.725) as k4,
       quantile_cont(l_extendedprice, 0.95) as k5 from lineitem) --main-- select l_orderkey, l_linenumber, l_extendedprice, """
    + ", ".join(f"{_rcs_sql('l_extendedprice', f'k{j}', j)} as l_extendedprice_{j}" for j in (1, 2, 3))
    + " from lineitem, k",
    round={f"l_extendedprice_{j}": 2 for j in (1, 2, 3)},
)
def _(t):
    return features.rcs_basis(t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice"), "l_extendedprice", 5, 2)


LINE_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber", "p_size", "p_retailprice"]


def line_features(t):
    joined = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select("l_orderkey", "l_returnflag", "l_extendedprice", *LINE_FEATURES)


N_LAMBDAS = 8
NET_ALPHA = 0.6
STEPS = "(select range as k from range(" + str(N_LAMBDAS) + ")) st"

# One column: every fit has a closed form, the soft threshold of its weighted covariance.
NET_ROWS = """
    nr as (select o_orderkey, cast(count(*) as double) as x, max(o_totalprice) / 1000.0 as y, cast(max(o_custkey % 3) + 1 as double) as w,
      cast(max(o_custkey % 7) as double) as o, cast(max(o_custkey % 4) as int) as f from lineitem join orders on l_orderkey = o_orderkey group by 1),
    nf as (select distinct f as held from nr union all select -1),
    nm as (select held, sum(w) as n, sum(w * x) / sum(w) as mx, sum(w * (y - o)) / sum(w) as my from nf, nr where f <> held group by 1),
    nc as (select nm.held, any_value(n) as n, any_value(mx) as mx, any_value(my) as my, sum(w * (x - mx) * (y - o - my)) / any_value(n) as c,
      sqrt(sum(w * (x - mx) * (x - mx)) / any_value(n)) as sd from nm, nr where f <> nm.held group by 1),
    nl as (select k, (select abs(c) / (sd * {alpha}) from nc where held = -1) * pow(0.01, k / {last}) as lam from {steps}),
    nb as (select held, k, lam, mx, my, sign(c) * greatest(abs(c) / sd - {alpha} * lam, 0) / (1 + (1 - {alpha}) * lam) / sd as b from nc, nl),
    nd as (select held, k, sum(w) as wf, sum(w * (y - o - my - b * (x - mx)) * (y - o - my - b * (x - mx))) / sum(w) as d
      from nb join nr on f = held group by 1, 2),
    nv as (select k, sum(wf * d) / sum(wf) as mid from nd group by 1),
    ns as (select nv.k, any_value(mid) as deviance, sqrt(sum(wf * (d - mid) * (d - mid)) / sum(wf) / (count(*) - 1)) as spread from nv join nd on nv.k = nd.k group by 1)
""".format(alpha=NET_ALPHA, last=float(N_LAMBDAS - 1), steps=STEPS)
CHOSEN = """deviance = (select min(deviance) from {t}) as is_min, lam = (select max(lam) from {t} where deviance <= (select arg_min(deviance + spread, deviance)
    from {t})) as is_1se"""


def cv_rows(t, path, names):
    """A row per penalty: coefficients by name, deviance, spread and the choices."""
    coefs = path.table(t.spark).groupBy("lam").pivot("name", ["(intercept)", *names]).agg(F.first("coef"))
    coefs = coefs.withColumnRenamed("(intercept)", "intercept")
    return coefs.join(path.cv_table(t.spark).drop("n_nonzero"), "lam")


@query(
    "f12_net_path",
    f"""with {NET_ROWS}, nt as (select lam, my - b * mx as intercept, b as x, deviance, spread from nb join ns on nb.k = ns.k where held = -1)
        --main-- select *, {CHOSEN.format(t="nt")} from nt""",
    round={"lam": 7, "intercept": 6, "x": 6, "deviance": 4, "spread": 4},
)
def _(t):
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_orderkey").agg(
        F.count("*").alias("x"), (F.max("o_totalprice") / 1000).alias("y"), (F.max(F.col("o_custkey") % 3) + 1).alias("w"),
        F.max(F.col("o_custkey") % 7).alias("o"), F.max(F.col("o_custkey") % 4).alias("f"),
    )
    path = penalized.fit_path(
        rows, ["x"], "y", alpha=NET_ALPHA, n_lambdas=N_LAMBDAS, ratio=0.01, weight="w", offset="o", fold="f"
    )
    return cv_rows(t, path, ["x"])


# One column of 0 and 1: the penalised Poisson means of both sides are their weighted sums, drawn together by the penalty.
POISSON_ROWS = """
    pr as (select c_custkey, case when any_value(c_nationkey) % 2 = 0 then 1 else 0 end as x, cast(count(o_orderkey) as double) as y,
      cast(c_custkey % 3 + 1 as double) as w, ln(1.0 + c_custkey % 5) as o, cast(c_custkey % 4 as int) as f
      from customer left join orders on o_custkey = c_custkey group by c_custkey),
    pf as (select distinct f as held from pr union all select -1),
    ps as (select held, sum(case when x = 0 then w else 0 end) as w0, sum(case when x = 1 then w else 0 end) as w1,
      sum(case when x = 0 then w * y else 0 end) as s0, sum(case when x = 1 then w * y else 0 end) as s1,
      sum(case when x = 0 then w * exp(o) else 0 end) as e0, sum(case when x = 1 then w * exp(o) else 0 end) as e1
      from pf, pr where f <> held group by 1),
    pg as (select *, s1 - e1 * (s0 + s1) / (e0 + e1) as g, sqrt(w0 * w1) as nsd from ps),
    pl as (select k, (select abs(g) / nsd from pg where held = -1) * pow(0.01, k / {last}) as lam from {steps}),
    pm as (select held, k, lam, case when abs(g) <= lam * nsd * (1 + 1e-12) then (s0 + s1) / (e0 + e1) else (s0 + lam * nsd * sign(g)) / e0 end as m0,
      case when abs(g) <= lam * nsd * (1 + 1e-12) then (s0 + s1) / (e0 + e1) else (s1 - lam * nsd * sign(g)) / e1 end as m1 from pg, pl),
    pd as (select held, k, sum(w) as wf, 2 * sum(w * (case when y > 0 then y * ln(y / (exp(o) * m)) else 0 end - y + exp(o) * m)) / sum(w) as d
      from (select pm.held, k, w, y, o, case when x = 1 then m1 else m0 end as m from pm join pr on f = held) z group by 1, 2),
    pv as (select k, sum(wf * d) / sum(wf) as mid from pd group by 1),
    pe as (select pv.k, any_value(mid) as deviance, sqrt(sum(wf * (d - mid) * (d - mid)) / sum(wf) / (count(*) - 1)) as spread from pv join pd on pv.k = pd.k group by 1)
""".format(last=float(N_LAMBDAS - 1), steps=STEPS)


def poisson_counts(t):
    """Orders of each customer, with weight, offset and fold."""
    counts = t.customer.join(t.orders, F.col("o_custkey") == F.col("c_custkey"), "left").groupBy("c_custkey").agg(
        F.count("o_orderkey").alias("y"), F.first("c_nationkey").alias("nation"), F.first("c_acctbal").alias("acctbal"),
        F.coalesce(F.avg("o_totalprice"), F.lit(0.0)).alias("price"),
    )
    key = F.col("c_custkey")
    return counts.withColumns(
        {"x": F.when(F.col("nation") % 2 == 0, 1).otherwise(0), "w": key % 3 + 1, "o": F.log(1.0 + key % 5), "f": key % 4,
         "balance": F.col("acctbal") / 1e3, "price": F.col("price") / 1e5, "zone": F.col("nation") % 5}
    )


@query(
    "f12_poisson_path",
    f"""with {POISSON_ROWS}, pt as (select lam, ln(m0) as intercept, ln(m1 / m0) as x, deviance, spread from pm join pe on pm.k = pe.k where held = -1)
        --main-- select *, {CHOSEN.format(t="pt")} from pt""",
    round={"lam": 7, "intercept": 6, "x": 6, "deviance": 6, "spread": 6},
)
def _(t):
    path = penalized.fit_path(poisson_counts(t), ["x"], "y", "poisson", n_lambdas=N_LAMBDAS, ratio=0.01, weight="w", offset="o", fold="f")
    return cv_rows(t, path, ["x"])


COUNT_FEATURES = ["price", "balance", "zone", "x"]


def poisson_1se(t):
    return penalized.fit_path(poisson_counts(t), COUNT_FEATURES, "y", "poisson", weight="w", offset="o", fold="f")


@query("f12_poisson_1se")
def _(t):
    """The Poisson lasso of the 1-SE penalty out of 100, four folds."""
    path = poisson_1se(t)
    return path.table(t.spark).where(F.col("lam") == path.lambda_1se).select("name", "coef")


@query(
    "f12_poisson_1se_optimal",
    " union all ".join(f"select '{n}' as name, true as optimal" for n in ["(intercept)", *COUNT_FEATURES]),
)
def _(t):
    """Whether the 1-SE fit is a minimum: each column's gradient over all rows meets its penalty, or stays below it at zero."""
    path = poisson_1se(t)
    lam = path.lambda_1se
    coefs = path.at(lam)[1]
    scored = penalized.predicted(poisson_counts(t), path, lam, "o")
    w = F.col("w").cast("double")
    left = w * (F.col("y") - F.col("prediction"))
    means = {n: F.sum(w * F.col(n)) / F.sum(w) for n in COUNT_FEATURES}
    facts = [F.sum(w).alias("n"), F.sum(left).alias("g_intercept"), *[F.sum(left * F.col(n)).alias(f"g_{n}") for n in COUNT_FEATURES]]
    facts += [(F.sum(w * F.col(n) ** 2) / F.sum(w) - m**2).alias(f"v_{n}") for n, m in means.items()]
    one = scored.agg(*facts)
    close = F.col("n") * 1e-6
    rows = [F.struct(F.lit("(intercept)").alias("name"), (F.abs("g_intercept") < close).alias("optimal"))]
    for n, c in coefs.items():
        limit = F.lit(lam) * F.col("n") * F.sqrt(f"v_{n}")
        met = F.abs(F.col(f"g_{n}") - limit * (1 if c > 0 else -1)) < close if c else F.abs(f"g_{n}") <= limit + close
        rows.append(F.struct(F.lit(n).alias("name"), met.alias("optimal")))
    return one.select(F.inline(F.array(*rows)))


@query("f12_elastic_net")
def _(t):
    formula = "l_extendedprice ~ l_quantity + p_size + p_retailprice + l_returnflag"
    _, scored = models.elastic_net(line_features(t), formula, alpha=1.0, lam=50.0)
    return scored.select("l_orderkey", "l_extendedprice", "prediction")


@query("f12_elastic_net_mean", "select avg(l_extendedprice) as mean_prediction, count(*) as n from lineitem", round={"mean_prediction": 1})
def _(t):
    """The intercept is free, so a fit's predictions have the mean of the response."""
    formula = "l_extendedprice ~ l_quantity + p_size + p_retailprice + l_returnflag"
    _, scored = models.elastic_net(line_features(t), formula, alpha=1.0, lam=50.0)
    return scored.agg(F.avg("prediction").alias("mean_prediction"), F.count("prediction").alias("n"))


@query("f12_poisson_lasso")
def _(t):
    counts = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"), F.avg("o_totalprice").alias("price"))
    rows = counts.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "n", (F.col("price") / 1e5).alias("price"), (F.col("c_acctbal") / 1e3).alias("balance"),
        (F.col("c_nationkey") % 5).alias("zone"),
    )
    names = ["price", "balance", "zone"]
    intercept, coefs = models.poisson_lasso(rows, names, "n", lam=0.01)
    return models.coefficient_table(t.spark, names, coefs, intercept)


@query(
    "f13_std_coefs",
    """select 'l_quantity' as name, stddev_samp(l_quantity) * 2.0 as std_coef from lineitem union all
       select 'l_tax', stddev_samp(l_tax) * -3.0 from lineitem union all
       select 'l_discount', stddev_samp(l_discount) * 10.0 from lineitem""",
    round={"std_coef": 8},
)
def _(t):
    return models.std_coefs(t.lineitem, {"l_quantity": 2.0, "l_tax": -3.0, "l_discount": 10.0})


@query("f14_gbt_importance")
def _(t):
    return models.gbt_importance(line_features(t), LINE_FEATURES, "l_extendedprice")


def deep_importance(t):
    """The second setting: few deep trees with large leaves and a low rate."""
    return models.gbt_importance(line_features(t), LINE_FEATURES, "l_extendedprice", trees=5, depth=10, rate=0.01, min_leaf=1000)


@query("f14_gbt_importance_deep")
def _(t):
    return deep_importance(t)


@query(
    "f14_importance_shares",
    "select cast(6 as bigint) as features, 1.0 as total, count(*) >= 2000 as split from lineitem",
    round={"total": 6},
)
def _(t):
    """Importances are shares of all features; with two large leaves' worth of rows the first feature splits them."""
    found = deep_importance(t)
    return found.agg(F.countDistinct("name").alias("features"), F.sum("importance").alias("total"), (F.max("importance") > 0).alias("split"))


@query("f15_forest_score")
def _(t):
    scored, _ = models.forest_score(line_features(t), LINE_FEATURES, "l_extendedprice")
    return scored.select("l_orderkey", "l_extendedprice", "prediction")


@query(
    "f15_forest_range",
    "select count(*) as n, min(l_extendedprice) as low, max(l_extendedprice) as high, true as within from lineitem",
    round={"low": 4, "high": 4},
)
def _(t):
    """A forest's predictions are means of responses: one for each row, all within their range."""
    scored, _ = models.forest_score(line_features(t), LINE_FEATURES, "l_extendedprice", trees=10)
    facts = scored.agg(
        F.count("prediction").alias("n"), F.min("l_extendedprice").alias("low"), F.max("l_extendedprice").alias("high"),
        F.min("prediction").alias("_a"), F.max("prediction").alias("_b"),
    )
    within = (F.col("_a") >= F.col("low") - 1e-6) & (F.col("_b") <= F.col("high") + 1e-6)
    return facts.withColumn("within", within).drop("_a", "_b")


@query("f15_forest_importance")
def _(t):
    return models.forest_score(line_features(t), LINE_FEATURES, "l_extendedprice")[1]


AREA = ["c_nationkey", "c_mktsegment"]


def area_rows(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        *AREA, "c_acctbal", (F.year("o_orderdate") - 1992).alias("year"), F.dayofyear("o_orderdate").alias("day"), "o_totalprice"
    )


@query("f15_area_importance")
def _(t):
    return models.area_scores(area_rows(t), AREA, ["c_acctbal", "year", "day"], "o_totalprice")[1]


@query(
    "f15_area_scores",
    """select c_nationkey, c_mktsegment, count(*) as n_rows, avg(o_totalprice) as o_totalprice, true as scored from orders
       join customer on o_custkey = c_custkey group by 1, 2""",
    round={"o_totalprice": 4},
)
def _(t):
    """The score table of areas: one row each, the score within the range of the areas' means."""
    scored, _ = models.area_scores(area_rows(t), AREA, ["c_acctbal", "year", "day"], "o_totalprice", trees=50)
    within = F.col("area_score").between(F.col("low") - 1e-6, F.col("high") + 1e-6)
    held = ordering.with_grand_totals(scored, {"low": F.min("o_totalprice"), "high": F.max("o_totalprice")})
    return held.select(*AREA, "n_rows", "o_totalprice", within.alias("scored"))


@query("f16_pca_scores")
def _(t):
    scored, _ = models.pca_scores(line_features(t), LINE_FEATURES, 4, rank="p_size")
    return scored.select("l_orderkey", "pc1", "pc2", "pc3", "pc4")


@query(
    "f16_pca_moments",
    "select count(*) as n, (count(*) - 1) * 6.0 as squares, 0.0 as cross_1_2, 0.0 as cross_2_3 from lineitem",
    round={"squares": 2, "cross_1_2": 6, "cross_2_3": 6},
)
def _(t):
    """All components of six scaled columns keep their sum of squares, and no two go together."""
    scored, _ = models.pca_scores(line_features(t), LINE_FEATURES, 6)
    squares = sum(F.sum(F.col(f"pc{i}") ** 2) for i in range(1, 7))
    return scored.agg(F.count("*").alias("n"), squares.alias("squares"), F.corr("pc1", "pc2").alias("cross_1_2"), F.corr("pc2", "pc3").alias("cross_2_3"))


@query("f17_spline_pca_mean", "select count(*) as n, 0.0 as mean_score, true as varies from customer", round={"mean_score": 6})
def _(t):
    """Component scores of all rows, about zero."""
    found = spline_scores(t)
    return found.agg(F.count("pc1").alias("n"), F.avg("pc1").alias("mean_score"), (F.stddev_samp("pc1") > 0.1).alias("varies"))


def spline_scores(t):
    rows = t.customer.join(
        t.orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("total"), F.count("*").alias("n")),
        F.col("c_custkey") == F.col("o_custkey"), "left",
    )
    scored, _ = models.spline_pca(rows, "c_custkey", ["c_acctbal", "total", "n"])
    return scored.select("c_custkey", "pc1")


@query("f17_spline_pca")
def _(t):
    return spline_scores(t)


@query("f18_cluster_rows")
def _(t):
    return models.cluster_rows(line_features(t), LINE_FEATURES, 10).select("l_orderkey", "cluster")


@query("f18_cluster_sizes", "select cast(10 as bigint) as clusters, count(*) as n, cast(0 as int) as first, cast(9 as int) as last from lineitem")
def _(t):
    """All rows are in one of ten clusters, each of which has rows."""
    found = models.cluster_rows(line_features(t), LINE_FEATURES, 10)
    return found.agg(F.countDistinct("cluster").alias("clusters"), F.count("cluster").alias("n"), F.min("cluster").alias("first"), F.max("cluster").alias("last"))


@query(
    "f19_formula_from_table",
    """select l_orderkey, l_linenumber, l_quantity as x1, l_tax as x2, l_extendedprice as label from lineitem""",
)
def _(t):
    formula = features.formula_from_table(t.fx_attributes, "in_v1")
    coded = RFormula(formula=formula).fit(t.lineitem).transform(t.lineitem)
    return coded.select(
        "l_orderkey", "l_linenumber", *[vector_to_array("features")[i].alias(f"x{i + 1}") for i in range(2)], "label"
    )


ALLOCATE = """
    mp as (select group_id, member_id, c as component, coalesce(p, 0) as prediction from (select group_id, member_id,
      'xox' as c, pred_xox_1 as p from fx_member_scores union all select group_id, member_id, 'ixx', pred_ixx_1
      from fx_member_scores) z),
    ct as (select distinct v.group_id, member_id, component, coalesce(prefx_map_id, 'hcup_unk') as category
      from fx_vendor_med v left join fx_icd_map on diag_1 = diag_cd, (values ('xox'), ('ixx')) as c(component)),
    cw as (select *, cast(length(category) as double) as weight from ct),
    sh as (select *, (prediction + 0.01) / (sum(prediction) over (partition by group_id, component) + 0.01)
      * case component when 'xox' then 1000.0 else 500.0 end as part from mp),
    al as (select cw.group_id, cw.member_id, category, sum(part * weight / tot) as impact from (select *, sum(weight) over
      (partition by group_id, component, member_id) as tot from cw) cw join sh on cw.group_id = sh.group_id
      and cw.member_id = sh.member_id and cw.component = sh.component group by 1, 2, 3)
"""


@query("f20_allocate_contribution", f"with {ALLOCATE} --main-- select * from al", round={"impact": 6})
def _(t):
    scores = t.fx_member_scores
    members = scores.select(
        "group_id", "member_id",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("component"), F.coalesce(f"pred_{c}_1", F.lit(0.0)).alias("prediction"))
                    for c in ("xox", "ixx")
                ]
            )
        ).alias("p"),
    ).select("group_id", "member_id", "p.*")
    amount = F.when(F.col("component") == "xox", 1000.0).otherwise(500.0).alias("contribution")
    totals = members.select("group_id", "component").distinct().select("group_id", "component", amount)
    mapped = t.fx_vendor_med.join(t.fx_icd_map, F.col("diag_1") == F.col("diag_cd"), "left").select(
        "group_id", "member_id", F.coalesce("prefx_map_id", F.lit("hcup_unk")).alias("category")
    )
    categories = mapped.distinct().withColumns(
        {"weight": F.length("category").cast("double"), "component": F.explode(F.array(F.lit("xox"), F.lit("ixx")))}
    )
    return features.allocate_contribution(totals, members, categories, ["group_id"], "member_id")


@query(
    "f21_linear_contribution",
    """select l_orderkey, l_linenumber, 2.5 * (l_quantity - avg(l_quantity) over ()) as l_quantity_contrib,
       -40.0 * (l_tax - avg(l_tax) over ()) as l_tax_contrib from lineitem""",
    round={"l_quantity_contrib": 6, "l_tax_contrib": 8},
)
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    return features.linear_contribution(rows, {"l_quantity": 2.5, "l_tax": -40.0}).drop("l_quantity", "l_tax")


@query(
    "f22_split_by_partition",
    """select partition_name, count(*) as n, sum(actual) as actual from fx_scored where partition_name in ('train', 'valid') group by 1""",
    round={"actual": 2},
)
def _(t):
    parts = features.split_by_partition(t.fx_scored, "partition_name", ["train", "valid"])
    summed = [
        p.agg(F.count("*").alias("n"), F.sum("actual").alias("actual")).withColumn("partition_name", F.lit(name))
        for name, p in parts.items()
    ]
    return summed[0].unionByName(summed[1])
