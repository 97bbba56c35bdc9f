"""Plans keep their shape when a key is hot or a lookup is too large to broadcast."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from claimweave.operators import joins

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
}


@pytest.fixture
def large_data_settings(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def hot_claims(spark):
    hot = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("m"), F.col("id") % 400))
    return spark.range(0, 60000, 1, 8).select(
        hot.alias("member"), F.date_add(F.lit(dt.date(2016, 1, 1)), (F.col("id") % 900).cast("int")).alias("d"),
        F.rand(3).alias("amount"),
    )


def test_hot_member_is_split_before_an_aggregate_on_it(large_data_settings):
    spark = large_data_settings
    claims = hot_claims(spark)
    coverage = claims.select("member").distinct().withColumn("underwriting_date", F.lit(dt.date(2018, 1, 1)))
    near = joins.lookback_filter(claims, coverage, ["member"], ["d"])
    got = near.groupBy("member").agg(F.count("*").alias("n"))
    assert "skew=true" in final_plan(got)
    want = claims.where((F.col("d") >= dt.date(2016, 1, 1)) & (F.col("d") < dt.date(2018, 1, 1))).count()
    assert got.agg(F.sum("n")).first()[0] == want


def test_lookup_too_large_to_broadcast_is_shuffled_and_split(large_data_settings):
    spark = large_data_settings
    claims = hot_claims(spark)
    lookup = spark.range(400).select(F.concat(F.lit("m"), F.col("id")).alias("member"), F.col("id").alias("rate"))
    got = joins.attach(claims, lookup, ["member"])
    plan = final_plan(got)
    assert "BroadcastHashJoin" not in plan and "skew=true" in plan
    assert got.count() == 60000


@pytest.mark.parametrize("name", ["k05_med_history", "k08_target", "j05_month_range_join", "j20_signal_join", "e06_drug_report"])
def test_no_pairing_joins(spark, name):
    df = entry.queries()[name](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_shuffles_start_with_partitions_for_the_stored_input(spark, tmp_path, monkeypatch):
    from claimweave import session
    from claimweave.plans.bindings import Inputs

    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    spark.range(20000).selectExpr("id as o_orderkey", "uuid() as o_comment").write.parquet(f"{tmp_path}/orders.parquet")
    session.tune(spark)
    stored = session.stored_bytes(Inputs(spark, str(tmp_path)).orders)
    assert stored > 100_000 and spark.conf.get(name, None) is None
    monkeypatch.setattr(session, "PARTITION_BYTES", stored // 40)
    try:
        rows = Inputs(spark, str(tmp_path)).orders.repartition("o_orderkey")
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1k")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1k")
        assert int(spark.conf.get(name)) >= 40 and rows.rdd.getNumPartitions() >= 40
    finally:
        spark.conf.unset(name)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
        session.tune(spark)
