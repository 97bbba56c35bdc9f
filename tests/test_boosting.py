"""Boosted trees grown by the sums of a level: Spark ML's trees where no rows are drawn, and next to these where they are."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimweave.operators import boosting, forest, models

FEATURES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    """Equal rows, null features, 0.5 % null labels; no feature has more values than bins, ``d`` is always null."""
    made = spark.range(12_000).selectExpr(
        "id % 4000 as k", "double(hash(id % 4000, 1) % 13) as a", "if(id % 7 = 0, null, id % 3) as b", "int(hash(id, 3) % 6) as c", "cast(null as double) as d"
    )
    label = F.expr("if(k % 200 = 0, null, if(a > 4, 50.0, 0.0) + coalesce(b, 0) * 10 * if(c > 0, 1, -1) - c + hash(k, 2) % 30)")
    return models.store_table(made.withColumn("y", label), "rows")


def shares(df):
    found = [(r["name"], r["importance"]) for r in df.collect()]
    assert found == sorted(found, key=lambda r: (-r[1], r[0])) and abs(sum(v for _, v in found) - 1) < 1e-9
    return dict(found)


@pytest.mark.parametrize("setting", [{"trees": 25, "depth": 4}, {"trees": 3, "depth": 7, "rate": 0.01, "min_leaf": 90}])
def test_many_rows_boost_as_spark_ml_does(spark, rows, monkeypatch, setting):
    whole = shares(models.gbt_importance(rows, FEATURES, "y", sampling=1.0, **setting))
    half = shares(models.gbt_importance(rows, FEATURES, "y", **setting))

    def held(*_):
        raise AssertionError("the rows were held as objects")

    monkeypatch.setattr(models, "OBJECTS", 10_000)
    monkeypatch.setattr(models.GBTRegressor, "fit", held)
    monkeypatch.setattr(forest, "BLOCK", 700)
    assert shares(models.gbt_importance(rows, FEATURES, "y", sampling=1.0, **setting)) == pytest.approx(whole, rel=1e-9)
    found = shares(models.gbt_importance(rows, FEATURES, "y", **setting))
    # Other draws of the same share of the rows.
    assert found["d"] == 0 and found == pytest.approx(half, abs=0.03)


def test_nodes_in_pieces_give_the_same_trees(spark, rows, monkeypatch):
    """Sums that meet in groups, and levels scanned for some nodes after the others."""
    df = rows.where("y is not null")
    usual = boosting.grow(df, FEATURES, "y", 2, 5, 0.1, 0.5, 5)
    scan, seen = boosting.level_splits, []
    monkeypatch.setattr(boosting, "level_splits", lambda *a: seen.append(a[3:6]) or scan(*a))
    monkeypatch.setattr(boosting, "GATHERED", 0)
    monkeypatch.setattr(boosting, "PIECE", 3)
    monkeypatch.setattr(boosting, "SUMS", 7 * len(FEATURES) * forest.BINS * 16)
    again = boosting.grow(df, FEATURES, "y", 2, 5, 0.1, 0.5, 5)
    assert seen[:5] == [(0, 0, 1), (1, 0, 2), (2, 0, 4), (3, 0, 7), (3, 7, 8)] and (4, 14, 16) in seen
    for one, other in zip(usual, again):
        assert (one.feature == other.feature).all() and (one.cut == other.cut).all()
        assert np.allclose(one.value, other.value) and np.allclose(one.gain, other.gain)


def test_leaves_hold_what_is_left(spark):
    """Eight different rows, a leaf for each: the first tree explains all, unsplit nodes pass their value on."""
    df = spark.range(4_000).selectExpr("id % 8 as a", "id % 8 * (id % 8) * 10.0 + 1e6 as y")
    first, second = boosting.grow(df, ["a"], "y", 2, 6, 0.1)
    squares = np.arange(8) ** 2 * 10.0
    assert set(np.round(first.value[63:], 6)) == set(np.round(squares - squares.mean(), 6))
    assert first.gain.sum() == pytest.approx(500 * ((squares - squares.mean()) ** 2).sum()) and abs(second.value).max() < 1e-6
    same = boosting.grow(df.withColumn("y", F.lit(7.1)), ["a"], "y", 2, 3, 0.1)
    assert (boosting.importances(same, 1) == 0).all()


def test_blocks_are_let_go(spark, rows, monkeypatch):
    """Neither kept blocks nor stored ones grow with the trees."""
    monkeypatch.setattr(boosting, "AGAIN", 2)
    drop, dropped = boosting.drop_checkpoint, []
    monkeypatch.setattr(boosting, "drop_checkpoint", lambda s, path: dropped.append(path) or drop(s, path))
    context = spark.sparkContext
    before = set(context._jsc.getPersistentRDDs())
    boosting.grow(rows.where("y is not null"), FEATURES, "y", 6, 2, 0.1)
    assert len(dropped) == len(set(dropped)) == 2 and set(context._jsc.getPersistentRDDs()) == before
    place = context._jvm.org.apache.hadoop.fs.Path
    assert not any(place(p).getFileSystem(context._jsc.hadoopConfiguration()).exists(place(p)) for p in dropped)


def test_draws_are_a_share_of_the_rows():
    one, other = (set(boosting.drawn(0, 1, 2, tree, 100_000, 0.3)) for tree in (3, 4))
    assert abs(len(one) - 30_000) < 600 and abs(len(one & other) - 9_000) < 400
    assert len(boosting.drawn(0, 1, 2, 3, 100, 1.0)) == 100
