"""Inputs are computed once, rows are not carried by aggregates, and sorted slices are run through without a second shuffle."""

import itertools
import random
import re
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimweave.operators import joins, models, ordering, reshape
from claimweave.plans.catalog import load_all
from claimweave.plans.catalog.modelling import line_features
from claimweave.plans.bindings import Inputs
from claimweave.plans.steps import Node, run_graph
from claimweave.session import only_reads, shared_dir

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def whole_paths(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("batch", [3, 1000])
@pytest.mark.parametrize("keys", [1, 7, 900])
def test_running_sums_over_slices_and_batches(spark, keys, batch):
    r = random.Random(keys)
    rows = [(None if (k := r.randrange(keys)) == 5 else f"k{k}", i, r.randint(-5, 9), Decimal(r.randint(0, 9999)) / 100, r.random()) for i in range(2500)]
    df = spark.createDataFrame(rows, "k string, i int, n int, d decimal(12,2), x double").repartition(5)
    before = {c: spark.conf.get(c, None) for c in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ordering.running_sums(df, ["i"], {"sn": "n", "sd": "d", "sx": "x"}, ["k"], totals=True)
        found = {tuple(r)[:2]: tuple(r)[5:] for r in got.collect()}
        plain = {r[1]: r[5] for r in ordering.running_sums(df, ["i"], {"s": "n"}, totals=True).collect()}
        whole = ordering.running_sums(df, ["i"], {"s": "n"}, totals=True).select("s_total").distinct().collect()
    finally:
        for c, v in before.items():
            spark.conf.unset(c) if v is None else spark.conf.set(c, v)
    rows.sort(key=lambda r: (str(r[0]), r[1]))
    for key, group in itertools.groupby(rows, key=lambda r: r[0]):
        group = list(group)
        totals = [sum(g[c] for g in group) for c in (2, 3)]
        sums = [0, Decimal(0), 0.0]
        for row in group:
            sums = [s + v for s, v in zip(sums, row[2:])]
            sn, sd, sx, tn, td, tx = found[row[:2]]
            assert (sn, sd, tn, td) == (sums[0], sums[1], *totals) and abs(sx - sums[2]) < 1e-9 and tx >= sx - 1e-9
    running = list(itertools.accumulate(r[2] for r in sorted(rows, key=lambda r: r[1])))
    assert [plain[i] for i in range(2500)] == running and [w[0] for w in whole] == [running[-1]]


def test_running_sums_of_no_rows_and_nulls(frame):
    empty = ordering.running_sums(frame([], "k string, v int"), ["v"], {"s": "v"}, ["k"], totals=True)
    assert empty.collect() == [] and empty.columns == ["k", "v", "s", "s_total"]
    assert ordering.running_sums(frame([], "k string, v int"), ["v"], {"s": "v"}, totals=True).collect() == []
    got = ordering.running_sums(frame([("a", 1, None), ("a", 2, 5), (None, 1, 7)], "k string, i int, v int"), ["i"], {"s": "v"}, ["k"])
    assert sorted((tuple(r) for r in got.collect()), key=str) == [("a", 1, None, 0), ("a", 2, 5, 5), (None, 1, 7, 7)]


def test_nothing_is_shuffled_after_the_sort(spark):
    df = spark.range(0, 5000, 1, 4).withColumn("k", F.col("id") % 3)
    plan = final_plan(ordering.ranked(df, ["id"], ["k"]))
    assert "Exchange" not in plan and "Window" not in plan and "MapInArrow" in plan


def test_best_rows_carry_no_rows_in_aggregates(spark):
    df = spark.range(0, 900, 1, 4).select((F.col("id") % 5).alias("k"), F.concat(F.lit("x"), F.col("id")).alias("c"))
    plan = final_plan(ordering.best_rows(df, ["k"], [F.col("c")]))
    assert "SortAggregate" not in plan and "WindowGroupLimit" in plan
    for name in ("a14_argmax_rows", "o06_one_row_per_key", "e01_latest_signals"):
        assert not re.search(r"SortAggregate|min_by|max_by", final_plan(load_all()[name].run(spark, SMALL)).lower()), name


def test_scans_are_read_again_other_frames_are_stored(spark, frame):
    scan = spark.read.parquet(f"{SMALL}/orders.parquet").where("o_orderkey > 5").select("o_custkey", "o_totalprice")
    counted = scan.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("t"))
    joined = scan.join(spark.read.parquet(f"{SMALL}/customer.parquet"), F.col("o_custkey") == F.col("c_custkey"))
    assert only_reads(scan) and not only_reads(counted) and not only_reads(joined)
    held = ordering.with_group_totals(joined, ["c_nationkey"], {"t": F.sum("o_totalprice")})
    plan = final_plan(held)
    assert plan.count("orders.parquet") == 0 and "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("name", ["w02_detection_span", "w04_share_of_group", "w08_prediction_share", "f20_allocate_contribution", "m09_scale_and_r2"])
def test_totals_evaluate_their_input_once(spark, name):
    # Two scans of a table with joins or aggregates above them would be the input computed twice.
    plan = final_plan(load_all()[name].run(spark, SMALL))
    for table in ("orders", "customer", "nation"):
        assert plan.count(f"/{table}.parquet") <= 1, (name, table)


def test_coverage_reads_each_table_once(spark):
    t = Inputs(spark, SMALL)
    plain = Inputs.bound

    from claimweave.operators import coverage
    from claimweave.plans.fixture_settings import SETTINGS

    frames = [plain(t, n) for n in ("fx_crosswalk", "fx_coverage", "fx_person", "fx_age_factor")]
    dated = coverage.dated_members(*frames, SETTINGS)
    plan = final_plan(dated)
    assert plan.count("nation.parquet") == 1 and plan.count("customer.parquet") == 2  # coverage and persons
    for name in ("k04_member_coverage", "k05_med_history", "k06_rx_history"):
        plan = final_plan(load_all()[name].run(spark, SMALL))
        assert plan.count("dated_members") <= 2 and plan.count("nation.parquet") <= 1, name


def test_signal_keys_are_one_array(spark):
    plan = final_plan(load_all()["e01_latest_signals"].run(spark, SMALL))
    assert "Expand" not in plan and plan.count("Generate explode") == 1, plan


def test_procedure_rules_meet_a_claim_once(frame):
    claims = frame([(1, "p", "a", "a", None), (2, "p", "b", "a", "c"), (3, None, "a", None, None), (4, "p", None, None, None)], "id int, p string, x string, y string, z string")
    rules = frame([("p", None, 1), ("p", "a", 2), (None, "a", 3), (None, None, 4)], "cpt_signal string, dx_signal string, rule int")
    got = joins.signal_join_any(claims, rules, "p", ["x", "y", "z"]).select("id", "diag", "rule").collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted(
        [(1, None, 1), (1, "a", 2), (1, "a", 3), (2, "a", 1), (2, "a", 2), (2, "a", 3), (3, "a", 3), (4, None, 1)], key=str
    )


def test_one_hot_by_a_joined_index(frame):
    df = frame([(1, "b"), (2, "a"), (3, None), (4, "c"), (5, "b")], "id int, c string")
    index = reshape.level_index(df.where("c <> 'c'"), "c")
    assert sorted(map(tuple, index.collect())) == [("a", 0), ("b", 1)]
    got = {r["id"]: r["v"].toArray().tolist()[:2] for r in reshape.one_hot(df, "c", "v", index).collect()}
    assert got == {1: [0.0, 1.0], 2: [1.0, 0.0], 3: [0.0, 0.0], 4: [0.0, 0.0], 5: [0.0, 1.0]}
    own = {r["id"]: r["v"].toArray().tolist()[:3] for r in reshape.one_hot(df, "c", "v").collect()}
    assert own[4] == [0.0, 0.0, 1.0] and own[3] == [0.0] * 3
    assert reshape.one_hot(df.where("c is null"), "c", "v").count() == 1
    with pytest.raises(ValueError):
        reshape.levels_of(df, "c", most=2)


def test_graph_builds_what_is_needed_once(frame):
    built = []

    def step(name, needs, make):
        return Node(name, needs, lambda *a: built.append(name) or make(*a[:-1]))

    df = frame([(1, 2), (1, 3), (2, 4)], "k int, v int")
    nodes = [
        step("out", ("sums", "most"), lambda s, m: s.join(m, "k")),
        step("most", ("shared",), lambda d: d.groupBy("k").agg(F.max("v").alias("m"))),
        step("sums", ("shared",), lambda d: d.groupBy("k").agg(F.sum("v").alias("s"))),
        step("shared", ("raw",), lambda d: d.distinct()),
        step("unused", ("raw",), lambda d: d),
    ]
    got = run_graph({"raw": df}, nodes, schema={"s": "int"})
    assert sorted(map(tuple, got.collect())) == [(1, 5, 3), (2, 4, 4)] and sorted(built) == ["most", "out", "shared", "sums"]
    assert dict(got.dtypes)["s"] == "int" and final_plan(got).count("shared") >= 1
    built.clear()
    assert run_graph({"raw": df, "most": df.select("k").distinct()}, nodes).count() == 2 and "most" not in built
    with pytest.raises(ValueError):
        run_graph({}, [Node("out", ("b",), None), Node("b", ("out",), None)])
    with pytest.raises(KeyError):
        run_graph({}, [Node("out", ("missing",), None)])


def test_complete_linkage_matches_plain_search():
    g = np.random.default_rng(5)
    for n, k in ((1, 3), (8, 1), (30, 4), (60, 10)):
        points = g.normal(size=(n, 3))
        groups = [[i] for i in range(n)]
        distance = lambda a, b: max(((points[i] - points[j]) ** 2).sum() for i in a for j in b)
        while len(groups) > k:
            a, b = min(itertools.combinations(range(len(groups)), 2), key=lambda p: distance(groups[p[0]], groups[p[1]]))
            groups[a] += groups.pop(b)
        found = models.complete_linkage(points, k)
        assert {frozenset(np.flatnonzero(found == c).tolist()) for c in set(found.tolist())} == {frozenset(x) for x in groups}


def test_cells_are_bounded_and_hold_all_rows(spark):
    rows = line_features(Inputs(spark, SMALL))
    columns = ["l_quantity", "l_tax", "p_retailprice"]
    placed, table, steps = models.clustering_features(rows, columns, most=100)
    n = rows.count()
    assert steps and 1 < table.count() <= 100 and table.agg(F.sum("n")).first()[0] == n
    assert placed.join(table, "_cell").count() == n
    total = table.select(*[F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(3)], F.sum(F.get("squares", F.lit(0))).alias("q")).first()
    assert all(abs(total[i]) < 1e-6 * n for i in range(3)) and abs(total.q - (n - 1)) < 1e-6 * n
    # Few different rows are linked as they are, repeats and nulls too.
    df = spark.createDataFrame([(0.0,), (0.0,), (0.1,), (5.0,), (5.2,), (None,)], "x double")
    got = sorted((r["x"] or 0.0, r["cluster"]) for r in models.cluster_rows(df, ["x"], 2).collect())
    assert got == [(0.0, 0), (0.0, 0), (0.0, 0), (0.1, 0), (5.0, 1), (5.2, 1)]
    assert models.cluster_rows(df.limit(0), ["x"], 2).count() == 0


def test_area_scores_have_a_row_for_each_area(frame):
    rows = [(f"z{i % 30}", float(i % 30), None if i % 7 == 0 else float(i % 5), 2.0 * (i % 30)) for i in range(300)] + [("none", 4.0, 1.0, None)]
    df = frame(rows, "zip string, a double, b double, y double")
    scored, top = models.area_scores(df, ["zip"], ["a", "b"], "y", trees=10, top=1)
    found = {r["zip"]: r for r in scored.collect()}
    assert len(found) == 31 and found["z3"]["n_rows"] == 10 and found["none"]["y"] is None and found["none"]["area_score"] is not None
    assert [r["name"] for r in top.collect()] == ["a"]


def test_scratch_is_named_for_the_application(spark):
    from claimweave.session import scratch_path

    assert scratch_path(spark, "x").startswith(f"{shared_dir(spark)}/scratch/{spark.sparkContext.applicationId}/")


def test_different_rows_are_not_cells_of_their_own(spark, monkeypatch):
    """Nearly all rows differ, so cells of different rows would be a table as long as the rows."""
    stored, store = [], models.store_table

    def counted(df, name="table", by=()):
        stored.append((name, (out := store(df, name, by)).count()))
        return out

    monkeypatch.setattr(models, "store_table", counted)
    columns = ["a", "b", "c"]
    rows = spark.range(20000).select(*[F.rand(i).alias(c) for i, c in enumerate(columns)])
    plan = models.cluster_rows(rows, columns, 4, most=200)._jdf.queryExecution().executedPlan().toString()
    assert all(n <= 200 for name, n in stored if name == "cells")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_trees_keep_no_node_ids_per_row(frame, monkeypatch):
    """A row's node in every tree, stored anew for each level, is larger than the row itself."""
    made = []
    for name in ("GBTRegressor", "RandomForestRegressor"):
        whole = getattr(models, name)
        monkeypatch.setattr(models, name, lambda *a, whole=whole, **k: made.append(whole(*a, **k)) or made[-1])
    df = frame([(float(i % 7), float(i % 3), float(i)) for i in range(60)], "a double, b double, y double")
    assert models.gbt_importance(df, ["a", "b"], "y", trees=2).count() == 2
    assert models.forest_score(df, ["a", "b"], "y", trees=2)[0].count() == 60
    assert len(made) == 2 and not any(m.getCacheNodeIds() for m in made)
