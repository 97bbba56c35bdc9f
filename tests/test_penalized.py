"""Penalty paths against plain fits in NumPy."""

import math

import numpy as np
import pytest

from claimweave.operators import models, penalized


def plain_fit(x, y, w, o, lam, family, alpha, steps=4000):
    """Proximal gradient with backtracking on one data set: slow and simple."""
    n = w.sum()
    mean = (w[:, None] * x).sum(0) / n
    sd = np.sqrt((w[:, None] * (x - mean) ** 2).sum(0) / n)
    z = np.column_stack([np.ones(len(y)), (x - mean) / sd])
    beta = np.zeros(z.shape[1])

    def loss(b):
        eta = o + z @ b
        if family == "gaussian":
            return (w * (y - eta) ** 2).sum() / n / 2 + lam * (1 - alpha) / 2 * (b[1:] ** 2).sum()
        return (w * (np.exp(eta) - y * eta)).sum() / n + lam * (1 - alpha) / 2 * (b[1:] ** 2).sum()

    def slope(b):
        eta = o + z @ b
        mu = eta if family == "gaussian" else np.exp(eta)
        g = -(z.T @ (w * (y - mu))) / n
        g[1:] += lam * (1 - alpha) * b[1:]
        return g

    step = 1.0
    for _ in range(steps):
        g = slope(beta)
        while True:
            new = beta - step * g
            new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * alpha * lam, 0)
            d = new - beta
            if loss(new) <= loss(beta) + g @ d + d @ d / (2 * step) + 1e-15:
                break
            step /= 2
        beta, step = new, step * 1.5
        if np.abs(d).max() < 1e-12:
            break
    coefs = beta[1:] / sd
    return beta[0] - coefs @ mean, coefs


def deviance(family, x, y, w, o, intercept, coefs):
    eta = o + intercept + x @ coefs
    mu = eta if family == "gaussian" else np.exp(eta)
    return (w * penalized.unit_deviance(family, y, mu)).sum() / w.sum()


def sample(family, n=240, seed=4):
    g = np.random.default_rng(seed)
    x = np.column_stack([g.normal(size=n), 50 + 3 * g.normal(size=n), g.integers(0, 2, n), g.normal(size=n) * 0.1, np.full(n, 7.0)])
    x[:, 3] += x[:, 0] * 0.05
    w, o = g.integers(1, 4, n).astype(float), g.normal(size=n) * 0.3
    eta = o + 0.2 + 0.6 * x[:, 0] - 0.05 * (x[:, 1] - 50) + 0.4 * x[:, 2]
    y = eta + g.normal(size=n) * 0.5 if family == "gaussian" else g.poisson(np.exp(eta)).astype(float)
    return x, y, w, o, np.arange(n) % 3


NAMES = ["a", "b", "c", "d", "same"]
SCHEMA = "a double, b double, c double, d double, same double, y double, w double, o double, f int"


@pytest.fixture(params=penalized.FAMILIES)
def fitted(request, frame):
    family = request.param
    x, y, w, o, f = sample(family)
    df = frame([(*map(float, r), float(u), float(v), float(q), int(k)) for r, u, v, q, k in zip(x, y, w, o, f)], SCHEMA)
    alpha = 1.0 if family == "poisson" else 0.7
    path = penalized.fit_path(df, NAMES, "y", family, alpha, n_lambdas=6, ratio=0.01, weight="w", offset="o", fold="f")
    return family, alpha, path, df, (x, y, w, o, f)


def test_every_penalty_equals_a_plain_fit(fitted):
    family, alpha, path, _, (x, y, w, o, f) = fitted
    use = x[:, :4]
    assert path.lambdas == sorted(path.lambdas, reverse=True) and not path.coefficients[0].any()
    assert (path.coefficients[1] != 0).any() and not path.coefficients[:, 4].any()
    for lam in path.lambdas:
        intercept, coefs = plain_fit(use, y, w, o, lam, family, alpha)
        got, named = path.at(lam)
        assert math.isclose(got, intercept, abs_tol=2e-5)
        assert np.allclose([named[n] for n in NAMES[:4]], coefs, atol=2e-6)


def test_held_out_deviance_and_the_1se_rule(fitted):
    family, alpha, path, _, (x, y, w, o, f) = fitted
    use = x[:, :4]
    weights = np.array([w[f == k].sum() for k in range(3)])
    means, errors = [], []
    for lam in path.lambdas:
        raw = []
        for k in range(3):
            own = f != k
            raw.append(deviance(family, use[~own], y[~own], w[~own], o[~own], *plain_fit(use[own], y[own], w[own], o[own], lam, family, alpha)))
        mid = (weights * raw).sum() / weights.sum()
        means.append(mid)
        errors.append(math.sqrt((weights * (np.array(raw) - mid) ** 2).sum() / weights.sum() / 2))
    assert np.allclose(path.deviance, means, rtol=1e-5) and np.allclose(path.spread, errors, rtol=1e-4)
    best = int(np.argmin(means))
    assert path.lambda_min == path.lambdas[best]
    assert path.lambda_1se == max(l for l, d in zip(path.lambdas, means) if d <= means[best] + errors[best])


def test_a_round_is_one_scan_for_all_fits(fitted, monkeypatch):
    family, _, path, df, _ = fitted
    scans = []
    plain = penalized._scan
    monkeypatch.setattr(penalized, "_scan", lambda rows, fam, coefs, held: scans.append(len(coefs)) or plain(rows, fam, coefs, held))
    again = penalized.fit_path(df, NAMES, "y", family, n_lambdas=6, ratio=0.01, weight="w", offset="o", fold="f")
    assert len(scans) == again.rounds + 1 and again.rounds <= (1 if family == "gaussian" else 12)
    assert max(scans[1:]) <= 4 * 6


def test_predictions_and_tables(fitted, spark):
    family, _, path, df, (x, y, w, o, f) = fitted
    lam = path.lambdas[3]
    got = np.array([r["prediction"] for r in penalized.predicted(df, path, lam, "o").collect()])
    intercept, coefs = path.at(lam)
    eta = o + intercept + x @ np.array(list(coefs.values()))
    assert np.allclose(np.sort(got), np.sort(eta if family == "gaussian" else np.exp(eta)))
    assert path.table(spark).count() == 6 * 6
    picks = path.cv_table(spark).where("is_min or is_1se").collect()
    assert {r["lam"] for r in picks} == {path.lambda_min, path.lambda_1se}


def test_nulls_and_rows_without_weight(frame):
    rows = [(1.0, 2.0, 1.0), (None, 1.0, 1.0), (2.0, None, 1.0), (3.0, 4.0, None), (9.0, 99.0, 0.0), (2.0, 3.0, -1.0)]
    df = frame(rows, "a double, y double, w double")
    path = penalized.fit_path(df, ["a"], "y", lambdas=[0.0], weight="w")
    beta = np.polyfit([1.0, 0.0, 3.0], [2.0, 1.0, 4.0], 1)
    assert math.isclose(path.coefficients[0, 0], beta[0]) and math.isclose(path.intercepts[0], beta[1])
    for bad in (frame([], "a double, y double, w double"), df.where("y is null")):
        with pytest.raises(ValueError):
            penalized.fit_path(bad, ["a"], "y")
    with pytest.raises(ValueError):
        penalized.fit_path(frame([(1.0, 0.0)], "a double, y double"), ["a"], "y", "poisson")


def test_offset_of_the_formula_fit(frame):
    g = np.random.default_rng(2)
    rows = [(float(a), "st"[i % 2], float(b), float(3 * a + 2 * (i % 2) + b)) for i, (a, b) in enumerate(g.normal(size=(60, 2)))]
    model, scored = models.elastic_net(frame(rows, "a double, seg string, o double, y double"), "y ~ a + seg", lam=0.0, offset="o")
    assert max(abs(r["prediction"] - r["y"]) for r in scored.collect()) < 1e-3 and "left_of_offset" not in scored.columns
