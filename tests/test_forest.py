"""Forests grown by the sums of a level: against brute force, and next to Spark ML's."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimweave.operators import forest, models

FEATURES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    """Equal rows, null features, 0.5 % null labels; ``a`` has more values than bins, ``d`` is always null."""
    made = spark.range(12_000).selectExpr(
        "id % 4000 as k", "double(hash(id % 4000, 1) % 1000) as a", "if(id % 7 = 0, null, id % 3) as b", "int(id % 5) as c", "cast(null as double) as d"
    )
    label = F.expr("if(k % 200 = 0, null, if(a > 100, 50.0, 0.0) + coalesce(b, 0) * 10 - c + hash(k, 2) % 3)")
    return models.store_table(made.withColumn("y", label), "rows")


def test_many_rows_grow_by_sums(spark, rows, monkeypatch):
    before, ranked = models.forest_score(rows, FEATURES, "y", trees=20, depth=5)
    usual, shares = before.where("y is not null").agg(F.avg(F.expr("pow(y - prediction, 2)"))).first()[0], {r["name"]: r["importance"] for r in ranked.collect()}

    def held(*_):
        raise AssertionError("the rows were held as objects")

    monkeypatch.setattr(models, "OBJECTS", 10_000, raising=False)
    monkeypatch.setattr(models.RandomForestRegressor, "fit", held)
    scored, ranked = models.forest_score(rows, FEATURES, "y", trees=20, depth=5)
    assert scored.columns == before.columns and [t for _, t in scored.dtypes] == [t for _, t in before.dtypes]
    assert scored.count() == 12_000 and scored.where("prediction is null").count() == 0
    assert scored.drop("prediction").exceptAll(rows).isEmpty()
    error = scored.where("y is not null").agg(F.avg(F.expr("pow(y - prediction, 2)"))).first()[0]
    # Other draws of the same forest.
    assert 0.6 < error / usual < 1.6
    found = [(r["name"], r["importance"]) for r in ranked.collect()]
    assert found == sorted(found, key=lambda r: (-r[1], r[0])) and abs(sum(v for _, v in found) - 1) < 1e-9
    assert found[0][0] == "a" and dict(found)["d"] == 0 and all(abs(v - shares[n]) < 0.15 for n, v in found)


def test_deep_trees_end_at_means_of_equal_rows(spark):
    df = spark.range(4_000).selectExpr("id % 8 as a", "id % 8 * id % 8 * 10.0 + 1e6 as y")
    grown = forest.grow(df, ["a"], "y", trees=3, depth=7)
    assert df.withColumn("p", grown.prediction(["a"])).where("abs(p - y) > 1e-6").isEmpty()
    one = forest.grow(df.withColumn("y", F.lit(7.0)), ["a"], "y", trees=2, depth=3)
    assert (one.feature == 0).all() and np.allclose(one.value, 7) and (one.importances() == 0).all()


def test_sums_of_a_task_are_bounded(spark, monkeypatch):
    """Two features, one offered: a tree's sums at the second level are 1,024 bytes, so three trees take two scans of it."""
    monkeypatch.setattr(forest, "SUMS", 2_048)
    scan, seen = forest.level_splits, []
    monkeypatch.setattr(forest, "level_splits", lambda *a: seen.append((a[2], a[6])) or scan(*a))
    df = spark.range(1_000).selectExpr("id % 8 as a", "id % 8 as b", "id % 8 * 1.0 as y")
    grown = forest.grow(df, ["a", "b"], "y", trees=3, depth=2)
    assert seen == [(0, [0, 1, 2]), (1, [0, 1]), (1, [2])] and (grown.gain[:, :3] > 0).all()


def test_quantiles_are_merged_from_few_tasks(spark, monkeypatch):
    cut, seen = forest.cut_points, []
    monkeypatch.setattr(forest, "cut_points", lambda rows, names: seen.append(rows.rdd.getNumPartitions()) or cut(rows, names))
    cores = spark.sparkContext.defaultParallelism
    df = spark.range(0, 4_000, 1, 3 * cores).selectExpr("id as a", "id * 2.0 as y")
    grown = forest.grow(df, ["a"], "y", trees=1, depth=1)
    monkeypatch.setattr(forest, "SHARE", -(-2_000 // cores))
    again = forest.grow(df, ["a"], "y", trees=1, depth=1)
    assert seen == [cores, 2 * cores]
    for f in (grown, again):
        assert np.allclose(f.cuts[0], np.arange(1, 32) * 125, atol=2)


def test_numbers_that_are_not_finite_are_refused(spark):
    df = spark.range(50).selectExpr("double(id) as a", "if(id = 3, double('NaN'), double(id)) as y")
    with pytest.raises(ValueError, match="finite"):
        forest.grow(df, ["a"], "y", trees=1, depth=1)


def test_splits_of_a_level_match_brute_force(spark, rows, monkeypatch):
    monkeypatch.setattr(forest, "BLOCK", 700)
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(size)
    spark.conf.set(size, "200")
    labelled = rows.where("y is not null").select(*[forest.filled(c).alias(c) for c in FEATURES], F.col("y").cast("double").alias("y"))
    count = labelled.count()
    cuts = forest.cut_points(labelled, FEATURES)
    assert [len(c) for c in cuts] == [31, 2, 4, 0]
    blocks = forest.store_blocks(labelled, count, cuts, "y", FEATURES, 20.0)
    spark.conf.set(size, usual)
    held = blocks.collect()
    assert sum(len(r["y"]) // 8 for r in held) == count and len(held) > 12_000 // 1_500
    grown = forest.Forest(cuts, np.zeros((2, 7), np.int64), np.full((2, 7), forest.STAY, np.uint8), np.zeros((2, 7)), np.zeros((2, 7)), 2)
    grown.feature[:, 0], grown.cut[:, 0] = [0, 1], [12, 0]
    offered = np.array([[[0, 2], [1, 3]], [[2, 0], [3, 1]]])
    alive = np.array([[True, True], [True, False]])
    found = {(r["tree"], r["node"]): r for r in forest.level_splits(blocks, grown, 1, offered, alive, 5, [0, 1]).collect()}
    apart = [r for t in (0, 1) for r in forest.level_splits(blocks, grown, 1, offered, alive, 5, [t]).collect()]
    assert {(r["tree"], r["node"]): (r["feature"], r["cut"]) for r in apart} == {at: (r["feature"], r["cut"]) for at, r in found.items()}
    assert sorted(found) == [(0, 1), (0, 2), (1, 1), (1, 2)] and found[1, 2]["feature"] is None
    y = np.concatenate([np.frombuffer(r["y"]) for r in held])
    bins = np.concatenate([np.frombuffer(r["bins"], np.uint8).reshape(4, -1) for r in held], axis=1)
    for t, n in [(0, 1), (0, 2), (1, 1)]:
        w = np.concatenate([forest.draws(5, r["part"], r["block"], t, len(r["y"]) // 8) for r in held]).astype(float)
        inside = (bins[grown.feature[t, 0]] > grown.cut[t, 0]) == (n == 2)

        def error(some):
            return (w[some] * (y[some] - np.average(y[some], weights=w[some])) ** 2).sum() if w[some].sum() else 0.0

        gains = {(int(f), c): error(inside) - error(inside & (bins[f] <= c)) - error(inside & (bins[f] > c)) for f in offered[t, n - 1] for c in range(len(cuts[f]))}
        r = found[t, n]
        assert r["gain"] == pytest.approx(max(gains.values())) and gains[r["feature"], r["cut"]] == pytest.approx(r["gain"])
        low = inside & (bins[r["feature"]] <= r["cut"])
        assert r["low"] == pytest.approx(np.average(y[low], weights=w[low])) and r["value"] == pytest.approx(np.average(y[inside], weights=w[inside]))


def test_draws_are_poisson():
    counts = np.bincount(forest.draws(0, 1, 2, 3, 1_000_000), minlength=6)[:6] / 1e6
    assert np.allclose(counts, [0.36788, 0.36788, 0.18394, 0.06131, 0.01533, 0.00307], atol=2e-3)
