"""Bindings: the claims tables as portable SQL over the driver tables.

Each statement runs unchanged in Spark SQL and DuckDB, so a query and its check share inputs.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..session import size_shuffles, stored_bytes

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

BINDINGS: dict[str, str] = {
    "fx_crosswalk": """
        select cast(n_nationkey as string) as src_cust_id, cast(n_regionkey as string) as src_rpt_cust_id,
        make_date(cast(1998 + n_regionkey % 2 as int), cast(1 + n_regionkey as int), 1) as effective_date
        from nation""",
    "fx_coverage": """
        select cast(c_custkey as string) as sdr_person_id, cast(c_nationkey as string) as src_cust_id, case
        when c_custkey % 4 = 0 then 'LV' when c_custkey % 11 = 0 then 'XX' else 'EM' end as src_platform_cd,
        make_date(cast(1995 + c_custkey % 5 as int), cast(1 + c_custkey % 12 as int), 1) as cov_eff_date,
        make_date(cast(1999 + c_custkey % 3 as int), 6, 30) as cov_end_date, case when c_custkey % 3 = 0
        then '18' else '01' end as rel_type_cd from customer""",
    "fx_person": """
        select cast(c_custkey as string) as sdr_person_id, case when c_custkey % 4 = 0 then 'LV' else 'EM'
        end as src_platform_cd, case when c_custkey % 2 = 0 then 'F' when c_custkey % 7 = 0 then null else
        'M' end as sex_cd, make_date(cast(1935 + c_custkey % 60 as int), cast(1 + c_custkey % 12 as int),
        cast(1 + c_custkey % 28 as int)) as birth_date from customer""",
    "fx_med_line_fact": """
        select l_orderkey * 10 + l_linenumber as medclm_key, cast(o_custkey as string) as sdr_person_id,
        cast(c_nationkey as string) as src_cust_id, case when o_custkey % 4 = 0 then 'LV' when o_custkey %
        11 = 0 then 'XX' else 'EM' end as src_clm_platform_cd, cast(o_orderdate as date) as serv_from_date,
        cast(l_shipdate as date) as load_date, l_extendedprice as chrg_amt, l_extendedprice * (1 -
        l_discount) as allow_icob_amt, case when l_linenumber = 7 then -l_quantity else l_quantity end as
        serv_unit_cnt, case when l_suppkey % 3 = 0 then 'R' || cast(l_suppkey % 7 as string) end as
        revenue_cd, case when l_partkey % 5 <> 0 then 'C' || cast(l_partkey % 97 as string) end as
        hcpcs_cpt4_base_cd1, 'D' || cast(l_partkey % 31 as string) as primary_diag_cd from lineitem join
        orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey""",
    "fx_med_line": """
        select l_orderkey * 10 + l_linenumber as medclm_key, max(case when l_partkey % 4 = 0 then 'N' ||
        cast(l_partkey % 53 as string) end) as ndc_id, max(case when l_linenumber > 2 then 'D' ||
        cast(l_suppkey % 29 as string) end) as diag_cd2, max(case when l_linenumber > 4 then 'D' ||
        cast(l_suppkey % 17 as string) end) as diag_cd3 from lineitem group by l_orderkey * 10 +
        l_linenumber""",
    "fx_rx_claims": """
        select cast(o_custkey as string) as sdr_person_id, cast(c_nationkey as string) as src_cust_id, case
        when o_custkey % 4 = 0 then 'LV' else 'EM' end as src_platform_cd, cast(o_orderdate as date) as
        service_date, cast(l_shipdate as date) as process_date, 'N' || cast(l_partkey % 53 as string) as
        ndc_id, case when l_linenumber = 2 then null else l_extendedprice * (1 - l_discount) / 10 end as
        rx_cost, l_quantity as payable_metric_cnt, l_extendedprice / 10 as wac_ingrd_cost_amt from lineitem
        join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey where l_linenumber % 2
        = 0""",
    "fx_ndc_price": """
        select 'N' || cast(p_partkey % 53 as string) as ndc_id, max(p_retailprice) / 25 as allowed_per_unit,
        cast(max(p_size) as double) / 2 as serv_unit_cnt_max from part where p_partkey % 53 < 45 group by
        p_partkey % 53""",
    "fx_cpt_price": """
        select 'C' || cast(p_partkey % 97 as string) as hcpcs_cpt4_base_cd1, max(p_retailprice) / 20 as
        allowed_per_unit, case when p_partkey % 97 % 6 = 0 then null else cast(max(p_size) as double) / 3
        end as serv_unit_cnt_max from part where p_partkey % 97 < 80 group by p_partkey % 97""",
    "fx_rev_price": """
        select 'R' || cast(s_suppkey % 7 as string) as revenue_cd, max(s_acctbal) / 100 as allowed_per_unit,
        cast(20 as double) as serv_unit_cnt_max from supplier where s_suppkey % 7 < 5 group by s_suppkey % 7""",
    "fx_icd_map": """
        select distinct 'D' || cast(p_partkey % 31 as string) as diag_cd, 'hcup_' || cast(p_partkey % 31 % 9
        as string) as prefx_map_id from part where p_partkey % 31 < 25""",
    "fx_icd_genetic": """
        select distinct 'D' || cast(p_partkey % 31 as string) as icd10 from part where p_partkey % 31 in (3,
        7)""",
    "fx_cpt_genetic": """
        select distinct 'C' || cast(p_partkey % 97 as string) as symp from part where p_partkey % 97 in (5,
        11)""",
    "fx_age_factor": """
        select * from (values ('F', 1, 0, 17, 0.6), ('F', 1, 18, 44, 1.2), ('F', 1, 45, 120, 1.9), ('F', 0,
        0, 17, 0.5), ('F', 0, 18, 120, 1.1), ('M', 1, 0, 17, 0.6), ('M', 1, 18, 44, 0.8), ('M', 1, 45, 120,
        2.1), ('M', 0, 0, 17, 0.5), ('M', 0, 18, 99, 0.9)) as t(sex_cd, subscriber_ind, min_mbr_age,
        max_mbr_age, age_gender_factor)""",
    "fx_cust_info": """
        select distinct cast(n_regionkey as string) as src_rpt_cust_id, make_date(cast(1998 + n_regionkey %
        2 as int), cast(1 + n_regionkey as int), 1) as effective_date, case when n_regionkey % 3 = 0 then
        'valid' else 'train' end as train_subpartition, n_regionkey % 2 as comm_rt, case when n_regionkey >
        2 then 1 else 0 end as lf_group, 0 as aso_group, case n_regionkey % 3 when 0 then 'S' when 1 then
        'T' else 'U' end as bus_segment_cd from nation""",
    "fx_scored": """
        select o_orderkey as row_id, l_pred as pred, o_totalprice as actual, o_orderkey % 5 + 1 as weight,
        case when o_orderkey % 10 < 6 then 'train' else 'valid' end as partition_name from orders join
        (select l_orderkey, cast(sum(cast(l_extendedprice as decimal(18,
        2))) as double) as l_pred from lineitem group by l_orderkey) x on
        l_orderkey = o_orderkey""",
    # Attributes of the line items as a model table lists them, with the model versions that use each.
    "fx_attributes": """
        select * from (values ('l_extendedprice', 'Response', 0, 1, 1), ('l_quantity', 'Predictor', 0, 1, 1),
        ('l_tax', 'Predictor', 0, 1, 0), ('l_discount', 'Predictor', 0, 0, 1), ('l_returnflag', 'Predictor', 1, 0, 1))
        as t(Attribute, Variable_Category, IsChar, in_v1, in_v2)""",
    # Vendor files: claim lines per region group, with the codes of the line itself.
    "fx_vendor_group": """
        select cast(r_regionkey as string) as group_id,
        make_date(cast(1998 + r_regionkey % 2 as int), cast(1 + r_regionkey as int), 1) as effective_date,
        cast(make_date(cast(1998 + r_regionkey % 2 as int), cast(1 + r_regionkey as int), 1)
        - interval '3' month as date) as underwriting_date,
        cast(cast(make_date(cast(1998 + r_regionkey % 2 as int), cast(1 + r_regionkey as int), 1)
        - interval '4' month as date) - interval '1' day as date) as data_thru
        from region""",
    "fx_vendor_med": """
        select cast(n_regionkey as string) as group_id, cast(o_custkey as string) as member_id,
        l_orderkey as claim_id, cast(o_orderdate as date) as from_date,
        case when l_partkey % 5 <> 0 then 'C' || cast(l_partkey % 97 as string) end as proc_cd,
        case when l_suppkey % 3 = 0 then 'R' || cast(l_suppkey % 7 as string) end as revenue_cd,
        case when l_partkey % 4 = 0 then 'N' || cast(l_partkey % 53 as string) end as ndc_id,
        case when l_linenumber = 7 then -l_quantity else l_quantity end as units,
        case when l_linenumber = 6 then null else l_extendedprice end as charged,
        'D' || cast(l_partkey % 31 as string) as diag_1,
        case when l_linenumber > 2 then 'D' || cast(l_suppkey % 29 as string) end as diag_2,
        case when l_linenumber > 4 then 'D' || cast(l_suppkey % 17 as string) end as diag_3
        from lineitem join orders on l_orderkey = o_orderkey
        join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey""",
    "fx_vendor_rx": """
        select cast(n_regionkey as string) as group_id, cast(o_custkey as string) as member_id,
        make_date(cast(year(o_orderdate) as int), cast(month(o_orderdate) as int), 1) as rx_month,
        'N' || cast(l_partkey % 53 as string) as ndc_id, l_quantity as days_supply,
        case when l_linenumber = 2 then null else l_extendedprice / 10 end as allowed
        from lineitem join orders on l_orderkey = o_orderkey
        join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
        where l_linenumber % 2 = 0""",
    # Lookups of a few rows, as they come with a rule set.
    "fx_drug_debits": """
        select * from (values
        ('N3', 'C3', 'drug a', 400.0, 52000.0, 3, 1, 'Y', 1, 0, 0),
        ('N8', 'C8', 'drug b', 90.0, 11800.0, 1, 1, 'Y', 0, 1, 0),
        ('N12', 'C12', 'drug a', 410.0, 53500.0, 3, 1, 'Y', 1, 0, 0),
        ('N20', 'C20', 'drug c', 12.0, 900.0, 2, 1, 'N', 0, 0, 1),
        ('N33', 'C33', 'drug d', 6.5, 850.0, 3, 2, 'Y', 0, 0, 0),
        ('N41', 'C41', 'drug e', 220.0, 28000.0, 2, 1, 'Y', 9000000, 0, 0)) as t(ndc_id, hcpcs, drug_name,
        debits, plan_yr_dollar, earliest_period, latest_period, display_flag, adult_male, adult_female, children)""",
    "fx_diag_debits": """
        select * from (values
        ('D2', 'grp x', 3, 1, 14000.0), ('D5', 'grp x', 1, 1, 21000.0), ('D9', 'grp y', 3, 2, 7000.0),
        ('D14', 'grp z', 2, 1, 32000.0), ('D21', 'grp z', 3, 1, 2500.0), ('D27', 'grp w', 3, 3, 1200.0))
        as t(diag_cd, diag_grouping, earliest_period, latest_period, plan_yr_dollar)""",
    "fx_event_rules": """
        select event, signal, event_cost, cpt_signal, dx_signal, adult_male, adult_female, children,
        display_flag, base, step from (values
        ('birth', 'scan', 15000.0, 'C4', 'D4', 0, 1, 0, 'Y', 0.02, 0.004),
        ('birth', 'visit', 15000.0, cast(null as string), 'D7', 0, 1, 0, 'Y', 0.03, 0.003),
        ('surgery', 'imaging', 42000.0, 'C13', cast(null as string), 1, 0, 0, 'Y', 0.05, -0.002),
        ('surgery', 'referral', 42000.0, 'C22', 'D22', 1, 0, 0, 'Y', 0.04, 0.0),
        ('transplant', 'listing', 250000.0, cast(null as string), 'D11', 1, 1, 0, 'N', 0.01, 0.001),
        ('transplant', 'lab', 250000.0, 'C29', cast(null as string), 1, 1, 9000000, 'Y', 0.015, 0.0005))
        as t(event, signal, event_cost, cpt_signal, dx_signal, adult_male, adult_female, children,
        display_flag, base, step)""",
    "fx_category_prevalence": """
        select distinct 'hcup_' || cast(p_partkey % 9 as string) as category,
        'condition ' || cast(p_partkey % 9 as string) as description,
        cast(400 + 600 * (p_partkey % 9) as double) as yearly_cost,
        case when p_partkey % 9 = 4 then 'N' else 'Y' end as display_flag,
        case when p_partkey % 9 = 6 then 9000000 else 1 end as adult_male,
        cast(1 as int) as adult_female, cast(0 as int) as children from part""",
    "fx_census": """
        select cast(n_regionkey as string) as group_id, cast(c_custkey as string) as member_id,
        case when c_custkey % 2 = 0 then 'F' when c_custkey % 7 = 0 then null else 'M' end as sex_cd,
        make_date(cast(1935 + c_custkey % 75 as int), cast(1 + c_custkey % 12 as int),
        cast(1 + c_custkey % 28 as int)) as birth_date,
        case when c_custkey % 3 = 0 then 1 else 0 end as subscriber_flag
        from customer join nation on c_nationkey = n_nationkey""",
    # Member-level scores of the three settings and three periods, with gaps.
    "fx_member_scores": """
        select cast(n_regionkey as string) as group_id, cast(c_custkey as string) as member_id,
        case when c_custkey % 3 <> 0 then sum(case when l_linenumber = 1 then l_extendedprice end) / 1000 end as pred_ixx_1,
        case when c_custkey % 3 <> 0 then sum(case when l_linenumber = 2 then l_extendedprice end) / 1000 end as pred_ixx_2,
        case when c_custkey % 3 <> 0 then sum(case when l_linenumber = 3 then l_extendedprice end) / 1000 end as pred_ixx_3,
        case when c_custkey % 7 <> 0 then sum(case when l_linenumber = 4 then l_extendedprice end) / 1000 end as pred_xox_1,
        case when c_custkey % 7 <> 0 then sum(case when l_linenumber = 5 then l_extendedprice end) / 1000 end as pred_xox_2,
        case when c_custkey % 7 <> 0 then sum(case when l_linenumber = 6 then l_extendedprice end) / 1000 end as pred_xox_3,
        case when c_custkey % 5 <> 0 then sum(case when l_linenumber = 7 then l_extendedprice end) / 1000 end as pred_xxr_1,
        case when c_custkey % 5 <> 0 then sum(l_tax) end as pred_xxr_2,
        case when c_custkey % 5 <> 0 then sum(l_discount) end as pred_xxr_3
        from customer join nation on c_nationkey = n_nationkey join orders on o_custkey = c_custkey
        join lineitem on l_orderkey = o_orderkey group by n_regionkey, c_custkey""",
}

_WORD = re.compile(r"\b[a-z_]+\b")


def names_used(sql: str, candidates) -> list[str]:
    words = set(_WORD.findall(sql))
    return [name for name in candidates if name in words]


class Inputs:
    """The driver tables of one folder and the claims tables bound to them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._frames: dict[str, DataFrame] = {}
        self._stored = 0

    def table(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            self._stored += stored_bytes(self._frames[name])
            size_shuffles(self.spark, self._stored)
        return self._frames[name]

    def bound(self, name: str) -> DataFrame:
        if name not in self._frames:
            sql = BINDINGS[name]
            for base in names_used(sql, BASE_TABLES):
                self.table(base).createOrReplaceTempView(base)
            self._frames[name] = self.spark.sql(sql)
        return self._frames[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in BINDINGS:
            return self.bound(name)
        if name in BASE_TABLES:
            return self.table(name)
        raise AttributeError(name)


def with_bindings(sql: str) -> str:
    """Prefix a check query with the bindings it names, as common table expressions."""
    used = names_used(sql, BINDINGS)
    if not used:
        return sql
    parts = ", ".join(f"{name} as ({BINDINGS[name]})" for name in used)
    text = sql.strip()
    if text.lower().startswith("with recursive "):
        return f"with recursive {parts}, {text[15:]}"
    if text.lower().startswith("with "):
        return f"with {parts}, {text[5:]}"
    return f"with {parts} {text}"
