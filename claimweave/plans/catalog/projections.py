"""Projection, cleaning and predicates."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..registry import query
from ...functions import codes, dates, numbers
from ...operators import claims, frames, summaries


@query(
    "p01_cast_types",
    """select l_orderkey, l_linenumber, cast(l_quantity as int) as l_quantity,
       cast(l_shipdate as date) as l_shipdate from lineitem""",
)
def _(t):
    df = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    return frames.cast_types(df, {"l_quantity": T.IntegerType(), "l_shipdate": T.DateType()})


@query("p02_rename_cols", "select c_custkey as member_id, c_nationkey as account_id, c_mktsegment from customer")
def _(t):
    df = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    return frames.rename_cols(df, {"c_custkey": "member_id", "c_nationkey": "account_id"})


@query(
    "p03_filter_dates_and_platforms",
    """select medclm_key, sdr_person_id, src_cust_id, serv_from_date, load_date, chrg_amt from fx_med_line_fact
       where src_clm_platform_cd in ('EM', 'LV') and serv_from_date between date '1996-01-01' and date '1999-12-31'
       and load_date between date '1996-01-01' and date '1999-12-31'""",
)
def _(t):
    kept = claims.filter_dates_and_platforms(
        t.fx_med_line_fact, "src_clm_platform_cd", ["serv_from_date", "load_date"],
        dt.date(1996, 1, 1), dt.date(1999, 12, 31),
    )
    return kept.select("medclm_key", "sdr_person_id", "src_cust_id", "serv_from_date", "load_date", "chrg_amt")


@query(
    "p04_parse_date_key",
    "select o_orderkey, cast(o_orderdate as date) as order_date from orders",
)
def _(t):
    key = F.date_format("o_orderdate", "yyyyMMdd").cast("int")
    return t.orders.select("o_orderkey", key.alias("k")).select("o_orderkey", dates.parse_date_key("k").alias("order_date"))


@query(
    "p05_first_of_month",
    """select o_orderkey, cast(date_trunc('month', o_orderdate) as date) as month_start,
       cast(date_trunc('month', o_orderdate) as date) as plan_month from orders""",
)
def _(t):
    text = F.upper(F.date_format("o_orderdate", "ddMMMyyyy"))
    return t.orders.select(
        "o_orderkey",
        dates.first_of_month(F.col("o_orderdate").cast("date")).alias("month_start"),
        dates.parse_plan_month(text).alias("plan_month"),
    )


@query(
    "p06_claim_setting",
    """select medclm_key, case when revenue_cd is not null and revenue_cd <> '' then 'i' else 'o' end as setting,
       case when r is not null then 'i' else 'o' end as setting_null_only
       from (select *, case when revenue_cd = 'R1' then '' else revenue_cd end as r from fx_med_line_fact) x""",
)
def _(t):
    df = t.fx_med_line_fact.withColumn("r", F.when(F.col("revenue_cd") == "R1", "").otherwise(F.col("revenue_cd")))
    return df.select(
        "medclm_key",
        codes.claim_setting("revenue_cd").alias("setting"),
        codes.claim_setting("r", empty_counts=True).alias("setting_null_only"),
    )


@query(
    "p07_times_bucket",
    """select l_orderkey, m, case when m between 1 and 3 then 1 when m between 4 and 9 then 2 else 3 end as times
       from (select l_orderkey, case when l_linenumber = 7 then null else cast(l_quantity as int) % 14 end as m
       from lineitem) x""",
)
def _(t):
    m = F.when(F.col("l_linenumber") != 7, F.col("l_quantity").cast("int") % 14)
    return t.lineitem.select("l_orderkey", m.alias("m")).withColumn("times", dates.times_bucket("m"))


@query(
    "p08_times_bucket_from",
    """select l_orderkey, m, case when m >= 10 then 3 when m > 3 then 2 else 1 end as times,
       case when m >= 12 then 3 when m > 5 then 2 else 1 end as times_5
       from (select l_orderkey, cast(l_quantity as int) % 26 + 1 as m from lineitem) x""",
)
def _(t):
    df = t.lineitem.select("l_orderkey", (F.col("l_quantity").cast("int") % 26 + 1).alias("m"))
    return df.withColumns({"times": dates.times_bucket_from("m"), "times_5": dates.times_bucket_from("m", 5)})


@query(
    "p09_months_before",
    """select l_orderkey, l_linenumber, cast((year(uw) - year(d)) * 12 + month(uw) - month(d) as int) as months
       from (select l_orderkey, l_linenumber, cast(l_shipdate as date) as d, date '2001-10-01' as uw from lineitem) x""",
)
def _(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber",
        dates.months_before(F.lit(dt.date(2001, 10, 1)), F.col("l_shipdate").cast("date")).alias("months"),
    )


@query(
    "p10_calendar_month_diff",
    """select l_orderkey, l_linenumber, (year(b) - year(a)) * 12.0 + (month(b) - month(a))
       + (day(b) - day(a)) / cast(30.436875 as double) as months
       from (select l_orderkey, l_linenumber, cast(l_shipdate as date) as a, date '2001-10-15' as b from lineitem) x""",
    round={"months": 6},
)
def _(t):
    day = F.col("l_shipdate").cast("date")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber",
        dates.calendar_month_diff(day, F.lit(dt.date(2001, 10, 15))).alias("months"),
    )


@query(
    "p11_fixed_month_diff",
    """select l_orderkey, l_linenumber, date_diff('day', cast(l_shipdate as date), date '2001-10-15') / cast(30.0 as double)
       as months from lineitem""",
    round={"months": 6},
)
def _(t):
    day = F.col("l_shipdate").cast("date")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", dates.fixed_month_diff(day, F.lit(dt.date(2001, 10, 15))).alias("months")
    )


@query(
    "p12_detection_range",
    """select l_orderkey, l_linenumber, case when m < 4 then '0-3 Months to UW' when m < 12 then '4-12 Months to UW'
       else '13+ Months to UW' end as detected, case when m < 4 then 3 when m < 12 then 2 else 1 end as detected_rank
       from (select l_orderkey, l_linenumber, l_quantity / 2 as m from lineitem) x""",
)
def _(t):
    df = t.lineitem.select("l_orderkey", "l_linenumber", (F.col("l_quantity") / 2).alias("m"))
    return df.select(
        "l_orderkey", "l_linenumber", dates.detection_range("m").alias("detected")
    ).withColumn("detected_rank", dates.detection_rank("detected"))


@query(
    "p13_age_at",
    """select sdr_person_id, greatest(0, cast(floor(n / 365.25) as int)) as age, cast(floor(n / 365.25) as int) as raw_age
       from (select sdr_person_id, date_diff('day', birth_date, date '1970-01-01') as n from fx_person) x""",
)
def _(t):
    day = F.lit(dt.date(1970, 1, 1))
    return t.fx_person.select(
        "sdr_person_id",
        dates.age_at(day, "birth_date").alias("age"),
        dates.age_at(day, "birth_date", clip=False).alias("raw_age"),
    )


@query(
    "p14_normalize_sex",
    """select sdr_person_id, case when sex_cd is null then 'F' when sex_cd = 'F' then 'F' else 'M' end as sex,
       case when sex_cd is null then 'U' when sex_cd = 'F' then 'F' else 'M' end as sex_u from fx_person""",
)
def _(t):
    return t.fx_person.select(
        "sdr_person_id", codes.normalize_sex("sex_cd").alias("sex"), codes.normalize_sex("sex_cd", "U").alias("sex_u")
    )


@query(
    "p15_subscriber_flag",
    "select sdr_person_id, src_cust_id, case when rel_type_cd = '18' then 1 else 0 end as subscriber_flag from fx_coverage",
)
def _(t):
    return t.fx_coverage.select(
        "sdr_person_id", "src_cust_id", codes.subscriber_flag("rel_type_cd").alias("subscriber_flag")
    )


@query(
    "p16_clean_ndc",
    """select l_orderkey, l_linenumber, case when try_cast(raw as bigint) > 0
       then lpad(cast(try_cast(raw as bigint) as varchar), 11, '0') end as ndc_id
       from (select l_orderkey, l_linenumber, case when l_linenumber = 1 then 'na' when l_linenumber = 2 then '0'
       when l_linenumber = 3 then null else '00' || cast(l_partkey * 137 as varchar) end as raw from lineitem) x""",
)
def _(t):
    raw = (
        F.when(F.col("l_linenumber") == 1, "na")
        .when(F.col("l_linenumber") == 2, "0")
        .when(F.col("l_linenumber") == 3, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("00"), (F.col("l_partkey") * 137).cast("string")))
    )
    return t.lineitem.select("l_orderkey", "l_linenumber", codes.clean_ndc(raw).alias("ndc_id"))


@query(
    "p17_clean_revenue",
    """select l_orderkey, l_linenumber, case when l_linenumber = 1 then null
       else lpad(cast(l_suppkey as varchar), cast(greatest(4, length(cast(l_suppkey as varchar))) as int), '0') end as revenue_cd
       from lineitem""",
)
def _(t):
    raw = F.when(F.col("l_linenumber") != 1, F.col("l_suppkey").cast("double").cast("string"))
    return t.lineitem.select("l_orderkey", "l_linenumber", codes.clean_revenue(raw).alias("revenue_cd"))


@query(
    "p18_clean_icd",
    "select p_partkey, p_brand || cast(p_size as varchar) as icd from part",
)
def _(t):
    raw = F.concat(F.lit("  "), F.col("p_brand"), F.lit("."), F.col("p_size").cast("string"), F.lit(" "))
    return t.part.select("p_partkey", codes.clean_icd(raw).alias("icd"))


@query("p19_strip_prefix_char", "select p_partkey, substr(p_brand, 2) as code from part")
def _(t):
    return t.part.select("p_partkey", codes.strip_prefix_char("p_brand").alias("code"))


@query(
    "p20_parse_money",
    "select o_orderkey, case when o_orderstatus = 'P' then null else round(o_totalprice, 2) end as amount from orders",
    round={"amount": 2},
)
def _(t):
    text = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.format_number("o_totalprice", 2))
    return t.orders.select("o_orderkey", numbers.parse_money(text).alias("amount"))


@query(
    "p21_charge_sign",
    """select l_orderkey, l_linenumber, cast(sign(coalesce(case when l_linenumber = 6 then null
       when l_linenumber = 5 then 0 when l_linenumber = 4 then -l_quantity else l_quantity end, 0)) as int) as s from lineitem""",
)
def _(t):
    line = F.col("l_linenumber")
    amount = F.when(line == 6, F.lit(None)).when(line == 5, 0.0).when(line == 4, -F.col("l_quantity")).otherwise(F.col("l_quantity"))
    return t.lineitem.select("l_orderkey", "l_linenumber", numbers.charge_sign(amount).alias("s"))


@query(
    "p22_fill_defaults",
    """select medclm_key, coalesce(revenue_cd, 'none') as revenue_cd, coalesce(hcpcs_cpt4_base_cd1, 'none') as
       hcpcs_cpt4_base_cd1 from fx_med_line_fact""",
)
def _(t):
    df = t.fx_med_line_fact.select("medclm_key", "revenue_cd", "hcpcs_cpt4_base_cd1")
    return frames.fill_defaults(df, {"revenue_cd": "none", "hcpcs_cpt4_base_cd1": "none"})


@query("p23_instants_to_dates", "select event_id, cast(ts as date) as ts, event_type from events")
def _(t):
    return frames.instants_to_dates(t.events.select("event_id", "ts", "event_type"))


@query(
    "p24_instants_to_strings",
    """select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as ts, strftime(ts, '%Y-%m-%d') as day from events""",
)
def _(t):
    return frames.instants_to_strings(t.events.select("event_id", "ts", F.col("ts").cast("date").alias("day")))


@query("p25_lower_columns", "select n_nationkey, n_name, c_custkey from nation join customer on n_nationkey = c_nationkey")
def _(t):
    upper = t.nation.select(F.col("n_nationkey").alias("N_NATIONKEY"), F.col("n_name").alias("N_Name"))
    joined = upper.join(t.customer, F.col("N_NATIONKEY") == F.col("c_nationkey")).select("N_NATIONKEY", "N_Name", "c_custkey")
    return frames.lower_columns(joined)


@query(
    "p26_signed_sqrt",
    "select s_suppkey, sign(s_acctbal) * 2.0 * (sqrt(0.5 + 3.0 * abs(s_acctbal)) - sqrt(0.5)) as y from supplier",
    round={"y": 6},
)
def _(t):
    return t.supplier.select("s_suppkey", numbers.signed_sqrt("s_acctbal", 2.0, 0.5, 3.0).alias("y"))


@query(
    "p27_box_cox",
    """select p_partkey, ln(p_retailprice + 0.001) as log_price,
       (pow(p_retailprice + 0.0001, -0.2) - 1) / (-0.2) as bc_price from part""",
    round={"log_price": 8, "bc_price": 8},
)
def _(t):
    return t.part.select(
        "p_partkey",
        numbers.box_cox("p_retailprice").alias("log_price"),
        numbers.box_cox("p_retailprice", -0.2).alias("bc_price"),
    )


@query("p28_clamp", "select p_partkey, least(greatest(p_size * 60, 10), 1000) as members from part")
def _(t):
    return t.part.select("p_partkey", numbers.clamp(F.col("p_size") * 60, 10, 1000).alias("members"))


@query(
    "p29_value_switch",
    """select o_orderkey, case o_orderpriority when '1-URGENT' then 3 when '2-HIGH' then 2 else 0 end as urgency from orders""",
)
def _(t):
    return t.orders.select(
        "o_orderkey", codes.value_switch("o_orderpriority", {"1-URGENT": 3, "2-HIGH": 2}, 0).alias("urgency")
    )


@query(
    "p30_contains_flag",
    """select doc_id, cast(coalesce(contains(lower(text), 'the'), false) as int) as has_the,
       cast(coalesce(contains(lower(case when lang = 'en' then text end), 'and'), false) as int) as has_and from documents""",
)
def _(t):
    english = F.when(F.col("lang") == "en", F.col("text"))
    return t.documents.select(
        "doc_id", codes.contains_flag("text", "The").alias("has_the"), codes.contains_flag(english, "and").alias("has_and")
    )


@query(
    "p31_mask",
    "select c_custkey, case when c_mktsegment = 'BUILDING' then 0 else c_acctbal end as balance from customer",
)
def _(t):
    return t.customer.select(
        "c_custkey", numbers.mask("c_acctbal", F.col("c_mktsegment") == "BUILDING", 0.0).alias("balance")
    )


@query("p32_select_columns", "select p_partkey, p_size, p_retailprice from part")
def _(t):
    return frames.select_columns(t.part, prefix="p_", regex="key$|size|price|name", exclude=["p_name"])


@query(
    "p33_hide_small_cells",
    """with n as (select cast(sum(case when age >= 18 and sex = 'M' then 1 else 0 end) as bigint) as m,
       cast(sum(case when age >= 18 and sex = 'F' then 1 else 0 end) as bigint) as f,
       cast(sum(case when age < 18 then 1 else 0 end) as bigint) as c from (select case when sex_cd is null then 'F' when
       sex_cd = 'F' then 'F' else 'M' end as sex, floor(date_diff('day', birth_date, date '1998-01-01') / 365.25) as age
       from fx_census) x)
       select event, signal, case when adult_male > m or adult_female > f or children > c or display_flag = 'N'
       then 'Cannot Disclose' else event end as event_label, case when adult_male > m or adult_female > f or children > c
       or display_flag = 'N' then 'Cannot Disclose' else signal end as signal_label from fx_event_rules, n""",
)
def _(t):
    people = summaries.age_sex_counts(
        t.fx_census.select(
            codes.normalize_sex("sex_cd").alias("sex"),
            dates.age_at(F.lit(dt.date(1998, 1, 1)), "birth_date", clip=False).alias("age"),
        )
    )
    rules = t.fx_event_rules.withColumns({"event_label": F.col("event"), "signal_label": F.col("signal")})
    hidden = frames.hide_small_cells(rules, people, ["event_label", "signal_label"])
    return hidden.select("event", "signal", "event_label", "signal_label")


@query(
    "p34_batch_month",
    "select o_orderkey, cast(date_trunc('month', o_orderdate) as date) as batch_month from orders",
)
def _(t):
    batch = F.concat(F.date_format("o_orderdate", "yyyyMM"), F.lit("_"), F.col("o_orderstatus"))
    return t.orders.select("o_orderkey", dates.batch_month(batch).alias("batch_month"))


@query(
    "p35_month_end",
    """select o_orderkey, last_day(o_orderdate) as from_month, cast(o_orderdate as date) as from_day from orders""",
)
def _(t):
    return t.orders.select(
        "o_orderkey",
        dates.month_end(F.date_format("o_orderdate", "yyyyMM")).alias("from_month"),
        dates.month_end(F.date_format("o_orderdate", "yyyyMMdd")).alias("from_day"),
    )


@query(
    "p36_sample_rows",
    "select c_custkey, c_acctbal from customer order by md5(cast(c_custkey as varchar) || '|7'), c_custkey limit 100",
)
def _(t):
    return frames.sample_rows(t.customer.select("c_custkey", "c_acctbal"), ["c_custkey"], 100, seed=7)


@query(
    "p37_keep_sources",
    """select medclm_key, case when revenue_cd is not null then 'i' else 'o' end as setting, chrg_amt
       from fx_med_line_fact where revenue_cd is null""",
)
def _(t):
    lines = t.fx_med_line_fact.select("medclm_key", codes.claim_setting("revenue_cd").alias("setting"), "chrg_amt")
    return frames.keep_sources(lines, "setting", inpatient=False)


@query(
    "p38_drop_null_rows",
    """select medclm_key, revenue_cd, hcpcs_cpt4_base_cd1 from fx_med_line_fact
       where revenue_cd is not null or hcpcs_cpt4_base_cd1 is not null""",
)
def _(t):
    df = t.fx_med_line_fact.select("medclm_key", "revenue_cd", "hcpcs_cpt4_base_cd1")
    return frames.drop_null_rows(df, "all", ["revenue_cd", "hcpcs_cpt4_base_cd1"])
