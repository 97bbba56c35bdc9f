import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimweave.operators import features, models


def test_partition_shares_and_stability(spark):
    df = spark.range(20000).withColumn("k", F.col("id") % 5000)
    got = features.assign_partition(df, ["k"], 0.6, 0.3, seed=4)
    assert got.groupBy("k").agg(F.countDistinct("partition_name").alias("n")).where("n > 1").count() == 0
    shares = {r.partition_name: r["count"] / 20000 for r in got.groupBy("partition_name").count().collect()}
    assert abs(shares["train"] - 0.6) < 0.03 and abs(shares["valid"] - 0.3) < 0.03
    again = features.assign_partition(df, ["k"], 0.6, 0.3, seed=4)
    assert got.exceptAll(again).count() == 0
    assert got.agg(F.min("fold"), F.max("fold")).first() == (1, 10)


def test_stored_partition_and_fold_win(frame):
    stored = frame([("a", "kept", 7)], "k string, partition_name string, fold int")
    got = {r.k: (r.partition_name, r.fold) for r in features.assign_partition(frame([("a",), ("b",)], "k string"), ["k"], 0.5, 0.2, 1, stored).collect()}
    assert got["a"] == ("kept", 7) and got["b"][0] in ("train", "valid", "test")


def test_surrogate_ids_keep_old_and_add_new(frame):
    first = features.surrogate_ids(frame([("a",), ("b",), (None,)], "k string"), "k", "s")
    again = features.surrogate_ids(frame([("b",), ("c",), ("c",)], "k string"), "k", "other", first)
    old, new = ({r.k: r.surrogate_id for r in x.collect()} for x in (first, again))
    assert set(new) == {"a", "b", "c"} and new["a"] == old["a"] and new["b"] == old["b"]
    assert len(set(new.values())) == 3


@pytest.mark.parametrize("norm", [0, 1, 2])
def test_spline_is_linear_beyond_the_outer_knots(frame, norm):
    knots = [1.0, 3.0, 4.0, 8.0]
    xs = [-5.0, 0.0, 0.9, 8.0, 9.0, 10.0, 20.0]
    got = features.rcs_basis(frame([(x,) for x in xs], "x double"), "x", at=knots, norm=norm).orderBy("x").collect()
    for name in ("x_1", "x_2"):
        assert [r[name] for r in got[:3]] == [0.0, 0.0, 0.0]
        slope = (got[4][name] - got[3][name]) / 1.0
        assert math.isclose(got[5][name] - got[4][name], slope, rel_tol=1e-9)
        assert math.isclose((got[6][name] - got[5][name]) / 10, slope, rel_tol=1e-9)


def test_spline_knots_snap_to_zero(frame):
    assert features.spline_knots(frame([(0.0,), (1e-12,), (0.0,)], "x double"), "x", 3) == [0.0, 0.0, 0.0]


def test_tfidf_matches_formula(frame):
    docs = {"d1": ["a", "a", "b"], "d2": ["b"], "d3": ["c", "b"]}
    df = frame([(k, c) for k, cs in docs.items() for c in cs], "k string, c string")
    got = {(r.k, r.c): r.tfidf for r in features.code_tfidf(df, ["k"], "c").collect()}
    seen = {c: sum(c in cs for cs in docs.values()) for c in "abc"}
    for k, cs in docs.items():
        raw = {c: cs.count(c) * (math.log(4 / (1 + seen[c])) + 1) for c in set(cs)}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        for c, v in raw.items():
            assert math.isclose(got[k, c], v / norm)
    wide = features.code_tfidf_features(features.code_tfidf(df, ["k"], "c"), ["k"], "c", ["a", "zz"])
    row = {r.k: r for r in wide.collect()}["d2"]
    assert (row.a, row.zz, row.sum_cpt, row.has_cpt) == (0.0, 0.0, 0.0, 1)


PREDS = [f"pred_{s}_{i}" for s in ("ixx", "xox", "xxr") for i in (1, 2, 3)]


@pytest.mark.parametrize(
    "inp, out, rx, want",
    [(0, 1, 1, "op_rx"), (0, 1, 0, "op"), (0, 0, 1, "rx"), (1, 1, 0, "med"), (1, 1, 1, "ior"), (0, 0, 0, "ior"), (1, 0, 0, "ior")],
)
def test_source_patterns(frame, inp, out, rx, want):
    row = [1.0 if flag and i == 0 else None for flag in (inp, out, rx) for i in range(3)]
    df = frame([tuple(row)], ", ".join(f"{c} double" for c in PREDS))
    assert df.select(features.source_pattern()).first()[0] == want


def test_allocation_keeps_the_total(frame):
    totals = frame([("g", "x", 100.0), ("g", "y", 10.0)], "g string, component string, contribution double")
    members = frame([("g", m, c, p) for m, p in (("a", 3.0), ("b", 1.0)) for c in "xy"], "g string, m string, component string, prediction double")
    cats = frame([("g", m, c, k, w) for m in "ab" for c in "xy" for k, w in (("k1", 1.0), ("k2", 3.0))],
                 "g string, m string, component string, category string, weight double")
    got = features.allocate_contribution(totals, members, cats, ["g"], "m", eps=0.0)
    assert math.isclose(got.agg(F.sum("impact")).first()[0], 110.0)
    assert math.isclose(got.where("m = 'a' and category = 'k2'").first().impact, 110 * 0.75 * 0.75)


def test_formula_from_table(frame):
    table = frame([("y", "Response", 0, 1), ("b", "P", 1, 1), ("a", "P", 0, 1), ("c", "P", 0, 0)],
                  "Attribute string, Variable_Category string, IsChar int, v1 int")
    assert features.formula_from_table(table, "v1") == "y ~ a + b"
    with pytest.raises(ValueError):
        features.formula_from_table(table.where("Attribute <> 'y'"), "v1")


def regression_rows(n=400, seed=0):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, seg = r.gauss(0, 1), r.gauss(0, 2), r.choice("STU")
        rows.append((i, a, b, seg, "train" if i % 4 else "valid", 3 + 2 * a - b + 5 * (seg == "S") + r.gauss(0, 0.01)))
    return rows


ROWS = "id int, a double, b double, seg string, part string, y double"


def test_rate_calibration_fits_train_and_drops_unknown(frame):
    rows = [(i, int(10 * a), 1, 0, seg, part, float(int(10 * a)) + 5 * (seg == "S")) for i, a, b, seg, part, y in regression_rows()]
    df = frame(rows, "id int, comm_rt int, lf_group int, aso_group int, bus_segment_cd string, train_subpartition string, y double")
    got = models.rate_calibration(df, "y")
    assert got.where("bus_segment_cd = 'U'").count() == 0 and "bus_segment_S" not in got.columns
    assert got.agg(F.max(F.abs(F.col("rate_calibrated") - F.col("y")))).first()[0] < 1e-3


def test_offset_matches_weighted_least_squares(frame):
    rows = [(float(i), float(i % 7), 1.0 + i % 3) for i in range(30)]
    got = models.calibrated_offset(frame(rows, "x double, y double, w double"), ["x"], "y", "w")
    x, y, w = map(np.array, zip(*rows))
    a = np.stack([np.ones_like(x), x], 1)
    beta = np.linalg.solve(a.T @ (w[:, None] * a), a.T @ (w * y))
    for r in got.collect():
        assert math.isclose(r.offset, math.log(max(beta @ [1, r.x], 0) + 0.001), rel_tol=1e-6)


def test_poisson_lasso_recovers_signs_and_shrinks(frame):
    g = np.random.default_rng(1)
    a, b, c = g.normal(size=(3, 800))
    y = g.poisson(np.exp(0.3 + 0.8 * a - 0.5 * b))
    df = frame([(float(u), float(v), float(x), int(z), i % 3) for i, (u, v, x, z) in enumerate(zip(a, b, c, y))],
               "a double, b double, c double, y int, fold int")
    intercept, coefs = models.poisson_lasso(df, ["a", "b", "c"], "y", lam=0.001)
    assert abs(intercept - 0.3) < 0.15 and abs(coefs[0] - 0.8) < 0.1 and abs(coefs[1] + 0.5) < 0.1
    assert models.poisson_lasso(df, ["a", "b", "c"], "y", lam=50.0)[1] == [0.0, 0.0, 0.0]
    picked = models.poisson_lasso_1se(df, ["a", "b", "c"], "y", "fold", [0, 1], [0.001, 0.1])
    assert picked["lambda_1se"] >= picked["lambda_min"]


def test_elastic_net_by_formula(frame):
    model, scored = models.elastic_net(frame(regression_rows(), ROWS), "y ~ a + b + seg", lam=0.0)
    assert scored.agg(F.max(F.abs(F.col("prediction") - F.col("y")))).first()[0] < 0.1


def test_importance_finds_the_driver(frame):
    rows = [(float(i % 17), float((i * 7) % 5), 3.0 * (i % 17)) for i in range(300)]
    df = frame(rows, "a double, b double, y double")
    assert models.gbt_importance(df, ["b", "a"], "y", trees=3, sampling=1.0).first().name == "a"
    scored, top = models.forest_score(df, ["a", "b"], "y", trees=5, top=1)
    assert scored.count() == 300 and [r.name for r in top.collect()] == ["a"]


def test_std_coefs_are_ranked(frame):
    df = frame([(1.0, 10.0), (3.0, 50.0)], "a double, b double")
    got = models.std_coefs(df, {"a": 100.0, "b": 1.0}).collect()
    assert [r.name for r in got] == ["a", "b"] and math.isclose(got[1].std_coef, math.sqrt(800))


def test_pca_and_spline_pca_match_numpy(frame):
    g = np.random.default_rng(3)
    base = g.normal(size=200)
    x = np.stack([base + g.normal(size=200) * 0.3, base**3 + g.normal(size=200) * 0.2, g.normal(size=200)], 1)
    df = frame([(i, *map(float, row)) for i, row in enumerate(x)], "id int, a double, b double, c double")
    scored, shares = models.pca_scores(df, ["a", "b", "c"], 2)
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    values = np.linalg.eigvalsh(np.cov(z.T))[::-1]
    assert np.allclose(shares, values[:2] / values.sum())
    scored, shares = models.spline_pca(df, "id", ["a", "b", "c"], rounds=2)
    knots = {c: np.quantile(x[:, j], [0.05, 0.5, 0.95]) for j, c in enumerate("abc")}

    def basis(v, k):
        s = (k[2] - k[0]) ** (2 / 3)
        cube = lambda t: np.maximum((v - t) / s, 0) ** 3
        return np.stack([v, cube(k[0]) + ((k[1] - k[0]) * cube(k[2]) - (k[2] - k[0]) * cube(k[1])) / (k[2] - k[1])], 1)

    lead = z @ np.linalg.eigh(np.cov(z.T))[1][:, -1]
    for _ in range(2):
        fits = []
        for j, c in enumerate("abc"):
            b = np.column_stack([np.ones(200), basis(x[:, j], knots[c])])
            fits.append(b @ np.linalg.lstsq(b, lead, rcond=None)[0])
        fits = np.stack(fits, 1)
        fz = (fits - fits.mean(0)) / fits.std(0, ddof=1)
        lead = fz @ np.linalg.eigh(np.cov(fz.T))[1][:, -1]
    got = np.array([r.pc1 for r in scored.orderBy("id").collect()])
    assert abs(np.corrcoef(got, lead)[0, 1]) > 0.999999


def test_clusters_and_period_models(frame):
    rows = [(i, float(10 * (i % 3)), float(i % 3)) for i in range(60)]
    got = models.cluster_rows(frame(rows, "id int, a double, b double"), ["a", "b"], 3)
    assert got.select("a", "cluster").distinct().count() == 3
    long = [(f"m{i}", "xox", 1 + i % 2, float(i), 2.0 * i) for i in range(40)]
    scored = models.period_models(frame(long, "m string, setting string, times int, n double, y double"), ["m"], ["n"], "y", ["xox"], trees=2)
    assert scored.count() == 40 and scored.where("pred_xox_3 is not null").count() == 0
    assert scored.where("pred_xox_1 is not null").count() == 20
    empty = models.period_models(frame([], "m string, setting string, times int, n double, y double"), ["m"], ["n"], "y", ["xox"])
    assert empty.count() == 0 and "pred_xox_2" in empty.columns


def test_registered_importance_is_the_full_fit(monkeypatch):
    from inspect import signature
    from types import SimpleNamespace

    from claimweave.plans.catalog import load_all, modelling

    whole, calls = models.gbt_importance, []
    monkeypatch.setattr(modelling, "line_features", lambda t: None)
    monkeypatch.setattr(models, "gbt_importance", lambda *a, **k: calls.append(signature(whole).bind(*a, **k)))
    load_all()["f14_gbt_importance"].build(SimpleNamespace())
    calls[0].apply_defaults()
    assert [calls[0].arguments[x] for x in ("trees", "depth", "rate")] == [500, 5, 0.1]


def test_tree_fits_read_even_shares(spark, tmp_path, monkeypatch):
    """A file of one row group would be one task's work; all rows are trained on, equal ones and nulls too."""
    monkeypatch.setattr(models, "WHOLE", 1_000, raising=False)
    path = str(tmp_path / "rows")
    spark.range(40_000).selectExpr("id % 5000 as a", "if(id % 7 = 0, null, id % 3) as b", "double(id % 11) as y").coalesce(1).write.parquet(path)
    rows, seen = spark.read.parquet(path), []
    for kind in (models.GBTRegressor, models.RandomForestRegressor):
        fit = kind.fit

        def counted(self, df, fit=fit):
            seen.append([r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()])
            return fit(self, df)

        monkeypatch.setattr(kind, "fit", counted)
    models.gbt_importance(rows, ["a", "b"], "y", trees=1, depth=2)
    scored, _ = models.forest_score(rows.withColumn("y", F.expr("if(a < 100, null, y)")), ["a", "b"], "y", trees=2, depth=2)
    cores = spark.sparkContext.defaultParallelism
    assert [sum(s) for s in seen] == [40_000, 39_200]
    assert all(len(s) >= cores and max(s) <= 1.1 * sum(s) / cores for s in seen)
    assert scored.columns == ["a", "b", "y", "prediction"] and scored.count() == 40_000
    assert scored.exceptAll(scored.where("prediction is not null")).isEmpty()


def test_boosted_trees_read_a_file_a_task(spark, monkeypatch):
    """Small files, put together, would make a task's rows several times the share."""
    monkeypatch.setattr(models, "WHOLE", 1_000)
    monkeypatch.setattr(models, "SHARE", 1_000)
    fit, seen = models.GBTRegressor.fit, []
    name = "spark.sql.files.openCostInBytes"

    def counted(self, df):
        seen.extend(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
        return fit(self, df)

    monkeypatch.setattr(models.GBTRegressor, "fit", counted)
    usual = spark.conf.get(name)
    models.gbt_importance(spark.range(20_000).selectExpr("id % 100 as a", "double(id % 7) as y"), ["a"], "y", trees=1, depth=1)
    assert sum(seen) == 20_000 and max(seen) <= 1_000 and spark.conf.get(name) == usual


def test_spread_rows_keeps_small_tables_and_bounds_a_share(spark, monkeypatch):
    monkeypatch.setattr(models, "WHOLE", 100)
    small = spark.range(100)
    assert models.spread_rows(small) is small
    monkeypatch.setattr(models, "SHARE", 50)
    cores = spark.sparkContext.defaultParallelism
    # Files this small are read together, so their number is looked at, not the partitions.
    spread = models.spread_rows(spark.range(0, cores * 120, 1, 1))
    files = [r["count"] for r in spread.groupBy(F.input_file_name()).count().collect()]
    assert len(files) == cores * 3 and max(files) <= 50 and sum(files) == cores * 120
