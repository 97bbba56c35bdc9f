"""Tables written to the shared folder and read back, and views.

S10 (database tables) has no query: it needs a database, and none may be started here.
"""

from pyspark.sql import functions as F

from ..registry import query
from ...operators.reshape import align_features
from ...session import scratch_path
from ...sources import readers, writers


@query("s01_parquet_table", "select o_orderkey, o_custkey, o_totalprice from orders")
def _(t):
    return readers.read_parquet_table(
        t.spark, f"{t.folder}/orders.parquet", "o_orderkey bigint, o_custkey bigint, o_totalprice double"
    )


@query("s02_lookup_csv", "select p_partkey as part_id, p_size, p_retailprice as price from part")
def _(t):
    path = scratch_path(t.spark, "part_csv")
    writers.write_csv(t.part, path)
    schema = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    return readers.read_lookup_csv(
        t.spark, path, schema, ["p_partkey", "p_size", "p_retailprice"], {"p_partkey": "part_id", "p_retailprice": "price"}
    )


@query("s03_delimited", "select c_custkey, c_name, c_acctbal from customer")
def _(t):
    path = scratch_path(t.spark, "customer_txt")
    upper = t.customer.select("c_custkey", "c_name", "c_acctbal").toDF("C_CUSTKEY", "C_Name", "C_AcctBal")
    upper.write.option("sep", "|").option("header", True).csv(path)
    return readers.read_delimited(t.spark, path, "C_CUSTKEY bigint, C_Name string, C_AcctBal double")


@query(
    "s04_header_detail",
    """select cast(c_nationkey as varchar) as group_id, 'group ' || cast(c_nationkey as varchar) as group_name,
       cast(c_custkey as varchar) as member_id, nullif(c_mktsegment, 'BUILDING') as segment from customer""",
)
def _(t):
    path = scratch_path(t.spark, "census")
    nation = F.col("c_nationkey").cast("string")
    head = t.customer.select(
        "c_nationkey", F.lit(0).alias("o"), F.concat(F.lit("H|"), nation, F.lit("|group "), nation).alias("value")
    ).distinct()
    segment = F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_mktsegment"))
    body = t.customer.select(
        "c_nationkey", F.lit(1).alias("o"), F.concat_ws("|", F.lit("D"), F.col("c_custkey").cast("string"), segment).alias("value")
    )
    # One file per group: its header first, then its members.
    lines = head.unionByName(body).repartition(F.col("c_nationkey")).sortWithinPartitions("c_nationkey", "o")
    lines.select("c_nationkey", "value").write.partitionBy("c_nationkey").text(path)
    rows = readers.read_header_detail(t.spark, f"{path}/*/*.txt", ["group_id", "group_name"], ["member_id", "segment"])
    return rows


@query("s05_xml_records", "select s_suppkey, s_name, s_acctbal from supplier")
def _(t):
    path = scratch_path(t.spark, "supplier_xml")
    rows = t.supplier.select("s_suppkey", "s_name", "s_acctbal")
    rows.write.format("xml").option("rowTag", "supplier").option("rootTag", "suppliers").save(path)
    return readers.read_xml_records(t.spark, path, "supplier", "s_suppkey bigint, s_name string, s_acctbal double")


@query(
    "s06_json_model_sample",
    "select l_orderkey, l_linenumber, l_tax, 0 as extra, l_quantity from lineitem",
)
def _(t):
    path = scratch_path(t.spark, "sample_json")
    t.lineitem.limit(20).select("l_tax", F.lit(1).alias("extra"), "l_quantity").write.json(path)
    columns = readers.read_json_model_sample(t.spark, path)
    return align_features(t.lineitem, ["l_orderkey", "l_linenumber"], columns)


@query("s07_materialize", "select o_custkey, sum(o_totalprice) as total from orders group by 1", round={"total": 4})
def _(t):
    path = scratch_path(t.spark, "totals")
    build = lambda: t.orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("total"))
    writers.materialize(t.spark, build, path)
    return writers.materialize(t.spark, build, path)


@query("s08_write_delimited", "select s_suppkey, s_name, s_acctbal from supplier")
def _(t):
    path = scratch_path(t.spark, "supplier_txt")
    writers.write_delimited(t.supplier.select("s_suppkey", "s_name", "s_acctbal"), path)
    return readers.read_delimited(t.spark, path, "s_suppkey bigint, s_name string, s_acctbal double", lineSep="\r\n")


@query("s09_write_csv", "select p_partkey, p_name, p_retailprice from part")
def _(t):
    path = scratch_path(t.spark, "part_out")
    writers.write_csv(t.part.select("p_partkey", "p_name", "p_retailprice"), path)
    return readers.read_lookup_csv(t.spark, path, "p_partkey bigint, p_name string, p_retailprice double")


@query("s11_register_view", "select n_regionkey, count(*) as n from nation group by 1")
def _(t):
    writers.register_view(t.nation, "shared_nation")
    return t.spark.sql("select n_regionkey, count(*) as n from shared_nation group by n_regionkey")
