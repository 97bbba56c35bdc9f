"""Elastic-net paths: squared error or Poisson with log link, weights, offset, cross-validation and the 1-SE rule.

All fits (one for each penalty and each held-out fold) advance together. A round is one scan: every task adds up, for
each fit, the weighted products of the columns and the gradient at the fit's present coefficients; the summed tables
are as large as the square of the number of columns, whatever the rows. On them each fit is solved by coordinate
descent, from where it stood. With squared error the first round is exact; a Poisson fit is scanned again until its
coefficients settle. Held-out deviances come out of the same scans.

Penalties act on columns scaled to unit weighted deviation of the fit's own training rows; the intercept is free.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import store_table

FAMILIES = ("gaussian", "poisson")
CELLS = 1 << 21  # numbers that a task's products of one slice of rows may take
HALVINGS = 20


@dataclass
class PenaltyPath:
    """Fits of all rows by penalty, largest first; with folds also the held-out deviance of each penalty."""

    family: str
    features: list[str]
    lambdas: list[float]
    intercepts: list[float]
    coefficients: np.ndarray  # a row for each penalty
    deviance: list[float] = field(default_factory=list)  # mean over folds, by their weight
    spread: list[float] = field(default_factory=list)  # standard error of that mean
    rounds: int = 0

    @property
    def lambda_min(self) -> float:
        return self.lambdas[int(np.argmin(self.deviance))]

    @property
    def lambda_1se(self) -> float:
        """The largest penalty whose deviance is within one standard error of the least."""
        best = int(np.argmin(self.deviance))
        limit = self.deviance[best] + self.spread[best]
        return next(l for l, d in zip(self.lambdas, self.deviance) if d <= limit)

    def at(self, lam: float) -> tuple[float, dict[str, float]]:
        k = self.lambdas.index(lam)
        return self.intercepts[k], dict(zip(self.features, self.coefficients[k].tolist()))

    def table(self, spark: SparkSession) -> DataFrame:
        """A row for each penalty and column: ``lam``, ``name``, ``coef``; the intercept under its name in brackets."""
        rows = []
        for lam, b, coefs in zip(self.lambdas, self.intercepts, self.coefficients.tolist()):
            rows += [(lam, "(intercept)", b), *((lam, n, c) for n, c in zip(self.features, coefs))]
        return spark.createDataFrame(rows, "lam double, name string, coef double")

    def cv_table(self, spark: SparkSession) -> DataFrame:
        """``lam``, ``deviance``, ``spread``, ``n_nonzero``, and whether it is the best or the 1-SE penalty."""
        kept = (self.coefficients != 0).sum(axis=1).tolist()
        rows = [(l, d, s, n, l == self.lambda_min, l == self.lambda_1se) for l, d, s, n in zip(self.lambdas, self.deviance, self.spread, kept)]
        return spark.createDataFrame(rows, "lam double, deviance double, spread double, n_nonzero int, is_min boolean, is_1se boolean")


def _number(name: str | None, default: float) -> Column:
    return F.coalesce(F.col(name).cast("double"), F.lit(default)) if name else F.lit(default)


def design(df: DataFrame, features: Sequence[str], label: str, weight: str | None, offset: str | None, fold: str | None) -> DataFrame:
    """``x`` (columns as an array, nulls as zero), ``y``, ``w``, ``o``, ``fold`` (-1 without folds) of rows with a label."""
    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features])
    held = F.coalesce(F.col(fold).cast("long"), F.lit(-1)) if fold else F.lit(-1).cast("long")
    rows = df.select(x.alias("x"), F.col(label).cast("double").alias("y"), _number(weight, 1.0).alias("w"), _number(offset, 0.0).alias("o"), held.alias("fold"))
    return rows.where(F.col("y").isNotNull() & (F.col("w") > 0))


def _pairs(p: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(p)


def unit_deviance(family: str, y: np.ndarray, mu: np.ndarray) -> np.ndarray:
    if family == "gaussian":
        return (y - mu) ** 2
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.where(y > 0, y * np.log(np.where(y > 0, y, 1.0) / mu), 0.0)
    return 2 * (ratio - (y - mu))


def _sums(batches: Iterator[pd.DataFrame], family: str, coefs: np.ndarray, held: np.ndarray):
    """A row for each fit: products of columns, gradient, and the deviances of training and held-out rows."""
    m, p = coefs.shape
    left, right = _pairs(p)
    total = np.zeros((m, len(left) + p + 2))
    step = max(1, CELLS // max(m, len(left)))
    for pdf in batches:
        for at in range(0, len(pdf), step):
            part = pdf.iloc[at : at + step]
            x = np.column_stack([np.ones(len(part)), np.stack(part["x"].to_list())])
            y, w, fold = part["y"].to_numpy()[:, None], part["w"].to_numpy()[:, None], part["fold"].to_numpy()[:, None]
            eta = part["o"].to_numpy()[:, None] + x @ coefs.T
            mu = eta if family == "gaussian" else np.exp(np.clip(eta, -300, 300))
            out = (fold == held[None, :]) & (held >= 0)[None, :]
            train = w * ~out
            curve = train if family == "gaussian" else train * mu
            loss = w * unit_deviance(family, y, mu)
            total[:, : len(left)] += curve.T @ (x[:, left] * x[:, right])
            total[:, len(left) : -2] += (train * (y - mu)).T @ x
            total[:, -2] += (loss * ~out).sum(axis=0)
            total[:, -1] += (loss * out).sum(axis=0)
    yield pd.DataFrame({"fit": np.arange(m), "sums": list(total)})


def _scan(rows: DataFrame, family: str, coefs: np.ndarray, held: np.ndarray) -> np.ndarray:
    """The sums of all rows: one table of numbers for each fit."""
    partial = rows.mapInPandas(lambda b: _sums(b, family, coefs, held), "fit int, sums array<double>")
    cells = partial.select("fit", F.posexplode("sums").alias("k", "v")).groupBy("fit", "k").agg(F.sum("v").alias("v"))
    found = cells.toPandas()
    m, p = coefs.shape
    out = np.zeros((m, len(_pairs(p)[0]) + p + 2))
    out[found["fit"].to_numpy(), found["k"].to_numpy()] = found["v"].to_numpy()
    return out


def descend(gram: np.ndarray, slope: np.ndarray, start: np.ndarray, lasso: np.ndarray, ridge: np.ndarray, tol: float, most: int = 10_000) -> np.ndarray:
    """Minimise ``d' gram d / 2 - slope' d + lasso |start + d| + ridge (start + d)^2 / 2`` for every fit side by side,
    coordinate by coordinate; returns ``start + d``. ``lasso``, ``ridge``: for each fit and column."""
    beta, left = start.copy(), slope.copy()
    diagonal = np.einsum("mjj->mj", gram)
    for _ in range(most):
        moved = 0.0
        for j in range(beta.shape[1]):
            curve = diagonal[:, j] + ridge[:, j]
            pull = left[:, j] + diagonal[:, j] * beta[:, j]
            with np.errstate(divide="ignore", invalid="ignore"):
                new = np.sign(pull) * np.maximum(np.abs(pull) - lasso[:, j], 0) / curve
            new = np.where(curve > 1e-12, new, 0.0)
            change = new - beta[:, j]
            if change.any():
                left -= change[:, None] * gram[:, :, j]
                beta[:, j] = new
                moved = max(moved, float(np.max(np.abs(change) * np.sqrt(np.maximum(diagonal[:, j], 0)))))
        if moved < tol:
            return beta
    raise RuntimeError(f"coordinate descent has not settled after {most} rounds")


def fit_path(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    family: str = "gaussian",
    alpha: float = 1.0,
    lambdas: Sequence[float] | None = None,
    n_lambdas: int = 100,
    ratio: float = 1e-4,
    weight: str | None = None,
    offset: str | None = None,
    fold: str | None = None,
    rounds: int = 100,
    tol: float = 1e-8,
) -> PenaltyPath:
    """Fit all penalties, on all rows and without each fold's rows, in one scan a round.

    Without ``lambdas`` they fall evenly on a log scale from the least that leaves no column to ``ratio`` of it.
    Rows without a label or of no weight are left out; a null column, weight or offset counts as 0, 1 and 0. Rows
    with a null fold are trained on by all fits. A Poisson fit that has not settled after ``rounds`` is an error.
    """
    if family not in FAMILIES or not 0 < alpha <= 1:
        raise ValueError("family is gaussian or poisson, alpha above 0 and at most 1")
    rows = store_table(design(df, features, label, weight, offset, fold), "design")
    p = len(features)
    base = F.exp("o") if family == "poisson" else F.lit(0.0)
    plain = F.sum("w"), F.sum(F.col("w") * F.col("y")), F.sum(F.col("w") * base), F.sum(F.col("w") * F.col("o"))
    first = [F.sum(F.col("w") * F.get("x", F.lit(j))) for j in range(p)]
    facts = rows.groupBy("fold").agg(F.array(*plain, *first).alias("s")).orderBy("fold").collect()
    if not facts:
        raise ValueError("no rows with a label")
    held = [-1, *(r["fold"] for r in facts if r["fold"] >= 0)]  # -1: the fit of all rows
    sums = {r["fold"]: np.array(r["s"]) for r in facts}
    whole = sum(sums.values())
    train = {g: whole - (sums[g] if g >= 0 else 0) for g in held}
    mean = {g: t[4:] / t[0] for g, t in train.items()}
    # Squared deviations from the mean of all rows, so that columns far from zero keep their digits.
    centre = mean[-1]
    shifted = F.array(*[F.get("x", F.lit(j)) - F.lit(float(c)) for j, c in enumerate(centre)])
    squares = rows.groupBy("fold").agg(F.array(*[F.sum(F.col("w") * F.get(shifted, F.lit(j)) ** 2) for j in range(p)]).alias("s")).collect()
    second = {r["fold"]: np.array(r["s"]) for r in squares}
    total = sum(second.values())
    scale = {g: np.sqrt(np.maximum((total - (second[g] if g >= 0 else 0)) / train[g][0] - (mean[g] - centre) ** 2, 0)) for g in held}
    rows = rows.withColumn("x", shifted)

    def null_fit(g: int) -> np.ndarray:
        t = train[g]
        if family == "gaussian":
            return np.array([(t[1] - t[3]) / t[0], *[0.0] * p])
        if t[1] <= 0:
            raise ValueError("a Poisson fit needs a positive label")
        return np.array([math.log(t[1] / t[2]), *[0.0] * p])

    size = np.array([train[g][0] for g in held])
    spread = np.stack([scale[g] for g in held])
    starts = np.stack([null_fit(g) for g in held])
    table = _scan(rows, family, starts, np.array(held))
    n_pairs = len(_pairs(p + 1)[0])
    if lambdas is None:
        with np.errstate(divide="ignore", invalid="ignore"):
            pull = np.where(spread[0] > 0, np.abs(table[0, n_pairs + 1 : -2]) / spread[0], 0.0) / (size[0] * alpha)
        top = float(pull.max(initial=0.0)) or 1.0
        lambdas = [top * ratio ** (k / max(1, n_lambdas - 1)) for k in range(n_lambdas)]
    lambdas = sorted(map(float, lambdas), reverse=True)
    k = len(lambdas)
    # One fit for each held-out fold and penalty; all of a fold share their first table.
    which = np.repeat(np.arange(len(held)), k)
    lam = np.tile(lambdas, len(held))
    coefs, last = starts[which], starts[which]
    free = np.zeros((len(which), 1))
    lasso = np.column_stack([free, (alpha * lam * size[which])[:, None] * spread[which]])
    ridge = np.column_stack([free, ((1 - alpha) * lam * size[which])[:, None] * spread[which] ** 2])
    # A column that does not vary in the training rows stays out.
    lasso[:, 1:][spread[which] <= 0] = np.inf
    folds = np.array(held)[which]
    open_fits = np.arange(len(which))
    left, right = _pairs(p + 1)
    table = table[which]
    loss = np.full(len(which), np.inf)
    halved = np.zeros(len(which), int)
    done_rounds = 0
    while True:
        done_rounds += 1
        penalty = np.where(coefs != 0, np.where(np.isfinite(lasso), lasso, 0) * np.abs(coefs) + ridge * coefs**2 / 2, 0)[open_fits].sum(axis=1)
        now = table[:, -2] / 2 + penalty
        worse = (now > loss[open_fits] * (1 + 1e-12) + 1e-12) & (halved[open_fits] < HALVINGS)
        stay = open_fits[worse]
        coefs[stay] = (coefs[stay] + last[stay]) / 2
        halved[stay] += 1
        go = open_fits[~worse]
        new = coefs[go]
        if len(go):
            part = table[~worse]
            gram = np.zeros((len(go), p + 1, p + 1))
            gram[:, left, right] = gram[:, right, left] = part[:, :n_pairs]
            new = descend(gram, part[:, n_pairs:-2], coefs[go], lasso[go], ridge[go], tol * 0.1 * math.sqrt(float(size.max())))
        loss[go], last[go], halved[go] = now[~worse], coefs[go], 0
        moved = np.abs(new - coefs[go]) * np.column_stack([np.ones(len(go)), spread[which[go]]])
        coefs[go] = new
        settled = moved.max(axis=1, initial=0.0) < tol
        if family == "gaussian":
            break
        open_fits = np.sort(np.concatenate([stay, go[~settled]]))
        if not len(open_fits):
            break
        if done_rounds >= rounds:
            raise RuntimeError(f"{len(open_fits)} fits have not settled after {rounds} rounds")
        table = _scan(rows, family, coefs[open_fits], folds[open_fits])
    shift = coefs[:k, 1:] @ centre
    path = PenaltyPath(family, list(features), lambdas, (coefs[:k, 0] - shift).tolist(), coefs[:k, 1:], rounds=done_rounds)
    if len(held) > 2:
        final = _scan(rows, family, coefs[k:], folds[k:])
        weights = np.array([sums[g][0] for g in held[1:]])
        raw = final[:, -1].reshape(-1, k) / weights[:, None]
        mid = (raw * weights[:, None]).sum(axis=0) / weights.sum()
        error = ((raw - mid) ** 2 * weights[:, None]).sum(axis=0) / weights.sum() / (len(weights) - 1)
        path.deviance, path.spread = mid.tolist(), np.sqrt(error).tolist()
    return path


def predicted(df: DataFrame, path: PenaltyPath, lam: float, offset: str | None = None, output: str = "prediction") -> DataFrame:
    """Rows with the fit's mean at penalty ``lam``; nulls as zero, as in training."""
    intercept, coefs = path.at(lam)
    eta = F.lit(float(intercept)) + _number(offset, 0.0)
    for name, c in coefs.items():
        if c:
            eta = eta + F.coalesce(F.col(name).cast("double"), F.lit(0.0)) * F.lit(float(c))
    return df.withColumn(output, F.exp(eta) if path.family == "poisson" else eta)
