"""Model training and scoring with Spark ML.

Training reads its rows many times, so the prepared rows are stored once (``cut_lineage``, ``store_table``) and
the steps that made them are not run again.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager, nullcontext
from functools import reduce

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.feature import PCA, RFormula, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import boosting, forest
from .features import STACKS, log_offset, rcs_terms, spline_knots, stacked_score
from .penalized import fit_path
from .reshape import one_hot
from ..session import cut_lineage, store_table


def assembled(df: DataFrame, features: Sequence[str], output: str = "features") -> DataFrame:
    """Feature vector from numeric columns, nulls as zero."""
    filled = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features]
    return df.withColumn(output, array_to_vector(F.array(*filled)))


def rate_calibration(
    members: DataFrame, target: str, segment: str = "bus_segment_cd",
    numeric: Sequence[str] = ("comm_rt", "lf_group", "aso_group"), partition: str = "train_subpartition",
    unknown: str = "U",
) -> DataFrame:
    """Least squares on the training rows of known segments; returns all those rows with their rate.

    Segments are a sparse vector by a joined index, so there may be many; those without training rows have no effect.
    """
    known = cut_lineage(members.where(F.col(segment) != unknown))
    coded = one_hot(known, segment, "_segments")
    ints = coded.withColumns({f"_n_{c}": F.coalesce(F.col(c).cast("int"), F.lit(0)) for c in numeric})
    rows = VectorAssembler(inputCols=[*[f"_n_{c}" for c in numeric], "_segments"], outputCol="features").transform(ints)
    model = LinearRegression(labelCol=target, predictionCol="rate_calibrated").fit(
        rows.where((F.col(partition) == "train") & F.col(target).isNotNull())
    )
    rated = model.transform(rows)
    return rated.drop("features", "_segments", *[f"_n_{c}" for c in numeric])


def calibrated_offset(groups: DataFrame, features: Sequence[str], target: str, weight: str, output: str = "offset") -> DataFrame:
    """Weighted least squares, clipped at zero, on the log scale."""
    rows = cut_lineage(assembled(groups, features))
    model = LinearRegression(labelCol=target, weightCol=weight, predictionCol="_cal").fit(rows.where(F.col(target).isNotNull()))
    return model.transform(rows).withColumn(output, log_offset("_cal")).drop("features", "_cal")


def period_models(
    rows: DataFrame, keys: Sequence[str], features: Sequence[str], target: str, settings: Sequence[str],
    periods: Sequence[int] = (1, 2, 3), trees: int = 20, depth: int = 3, seed: int = 0, at_once: int = 3,
) -> DataFrame:
    """One boosted-tree model per setting and period, applied where that setting has data.

    ``rows``: keys, setting, times, features, target. Returns keys with pred_<setting>_<period>. The rows are stored
    by setting and period, so a fit reads its own rows only; one count tells which fits have any, and ``at_once``
    fits are submitted side by side, as one alone leaves most of a cluster idle between its many small steps.
    """
    slim = assembled(rows.select(*keys, "setting", "times", *features, target), features).drop(*features)
    ready = store_table(slim, "periods", by=["setting", "times"])
    labelled = ready.where(F.col(target).isNotNull() & F.col("setting").isin(*settings) & F.col("times").isin(*periods))
    some = [(r["setting"], r["times"]) for r in labelled.groupBy("setting", "times").count().collect()]

    def fit(s: str, p: int) -> DataFrame:
        part = ready.where((F.col("setting") == s) & (F.col("times") == p))
        regressor = GBTRegressor(labelCol=target, maxIter=trees, maxDepth=depth, seed=seed, predictionCol="_pred")
        model = regressor.fit(part.where(F.col(target).isNotNull()))
        return model.transform(part).select(*keys, F.lit(f"pred_{s}_{p}").alias("_name"), "_pred")

    spark = rows.sparkSession
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        waiting = [pool.submit(inheritable_thread_target(spark)(fit), s, p) for s, p in sorted(some)]
        scored = [w.result() for w in waiting]
    names = [f"pred_{s}_{p}" for s in settings for p in periods]
    if not scored:
        return ready.select(*keys).distinct().withColumns({n: F.lit(None).cast("double") for n in names})
    stacked = reduce(DataFrame.unionByName, scored)
    return stacked.groupBy(*keys).agg(*[F.max(F.when(F.col("_name") == n, F.col("_pred"))).alias(n) for n in names])


# Sources each stacked model reads.
def fit_stacked(df: DataFrame, target: str, trees: int = 20, depth: int = 3, seed: int = 0) -> DataFrame:
    """Stacked model per source pattern over the period predictions, and the score of the row's pattern."""
    scored = cut_lineage(df)
    for name, sources in STACKS.items():
        columns = [f"pred_{s}_{i}" for s in sources for i in (1, 2, 3)]
        ready = assembled(scored, columns)
        model = GBTRegressor(labelCol=target, maxIter=trees, maxDepth=depth, seed=seed, predictionCol=f"pred_{name}").fit(
            ready.where(F.col(target).isNotNull())
        )
        scored = model.transform(ready).drop("features")
    return stacked_score(scored)


def elastic_net(
    df: DataFrame, formula: str, alpha: float = 1.0, lam: float = 0.1, weight: str | None = None, offset: str | None = None
) -> tuple[object, DataFrame]:
    """Elastic net by formula (dummies for text columns): fitted model and rows with predictions.

    With an ``offset`` the columns explain what it leaves of the response; predictions include it.
    """
    regression = LinearRegression(elasticNetParam=alpha, regParam=lam, predictionCol="prediction")
    if weight:
        regression = regression.setWeightCol(weight)
    if offset is None:
        model = Pipeline(stages=[RFormula(formula=formula), regression]).fit(df)
        return model, model.transform(df)
    response, _, terms = formula.partition("~")
    own = F.coalesce(F.col(offset).cast("double"), F.lit(0.0))
    ready = df.withColumn("left_of_offset", F.col(response.strip()) - own)
    model = Pipeline(stages=[RFormula(formula=f"left_of_offset ~{terms}"), regression]).fit(ready)
    return model, model.transform(ready).withColumn("prediction", F.col("prediction") + own).drop("left_of_offset")


def coefficient_table(spark: SparkSession, names: Sequence[str], values: Sequence[float], intercept: float | None = None) -> DataFrame:
    rows = [(n, float(v)) for n, v in zip(names, values)]
    if intercept is not None:
        rows.insert(0, ("(intercept)", float(intercept)))
    return spark.createDataFrame(rows, "name string, coef double")


def poisson_lasso(
    df: DataFrame, features: Sequence[str], label: str, lam: float, weight: str | None = None, rounds: int = 60,
    tol: float = 1e-8, offset: str | None = None,
) -> tuple[float, list[float]]:
    """L1-penalised Poisson regression with log link at one penalty: intercept and coefficients."""
    path = fit_path(df, features, label, "poisson", lambdas=[lam], weight=weight, offset=offset, rounds=rounds, tol=tol)
    return path.intercepts[0], path.coefficients[0].tolist()


def poisson_lasso_1se(
    df: DataFrame, features: Sequence[str], label: str, fold: str, folds: Sequence[int], lambdas: Sequence[float] | None = None,
    weight: str | None = None, rounds: int = 60, offset: str | None = None,
) -> dict[str, object]:
    """Largest penalty whose mean held-out deviance is within one standard error of the best, and its fit.

    Rows of other folds than ``folds`` train every fit.
    """
    held = df.withColumn("_fold", F.when(F.col(fold).isin(*folds), F.col(fold)))
    path = fit_path(held, features, label, "poisson", lambdas=lambdas, weight=weight, offset=offset, fold="_fold", rounds=rounds)
    intercept, coefs = path.at(path.lambda_1se)
    table = dict(zip(path.lambdas, zip(path.deviance, path.spread)))
    return {"lambda_min": path.lambda_min, "lambda_1se": path.lambda_1se, "intercept": intercept, "coefficients": coefs, "path": table}


def std_coefs(df: DataFrame, coefficients: Mapping[str, float]) -> DataFrame:
    """Coefficients times the sample standard deviation of their column, largest first."""
    one = df.agg(*[F.stddev_samp(c).alias(c) for c in coefficients])
    parts = [
        F.struct(F.lit(c).alias("name"), (F.col(c) * F.lit(float(v))).alias("std_coef")) for c, v in coefficients.items()
    ]
    return one.select(F.explode(F.array(*parts)).alias("r")).select("r.*").orderBy(F.col("std_coef").desc())


WHOLE = 250_000  # rows that stay in the partitions they are stored in
SHARE = 250_000  # most rows of a file beyond
OBJECTS = 1_000_000  # rows the trees of Spark ML hold


def spread_rows(stored: DataFrame) -> DataFrame:
    """Stored rows in files of even size, for a fit that reads all of them for each level of a tree.

    A file is cut by its row groups only, which leaves cores idle and lets a task grow with them. Every core gets as many
    files as the others, and no more than ``SHARE`` asks for: each partition costs a fit some work for each tree.
    """
    rows = stored.count()
    if rows <= WHOLE:
        return stored
    cores = stored.sparkSession.sparkContext.defaultParallelism
    return store_table(stored.repartition(cores * -(-rows // (cores * SHARE))), "spread")


@contextmanager
def files_apart(spark: SparkSession) -> Iterator[None]:
    """No task reads two files: small ones would be put together, and a task's rows be several times ``SHARE``."""
    name = "spark.sql.files.openCostInBytes"
    usual = spark.conf.get(name)
    spark.conf.set(name, spark.conf.get("spark.sql.files.maxPartitionBytes"))
    try:
        yield
    finally:
        spark.conf.set(name, usual)


def gbt_importance(
    df: DataFrame, features: Sequence[str], label: str, trees: int = 500, depth: int = 5, rate: float = 0.1,
    sampling: float = 0.5, min_leaf: int = 1, seed: int = 0,
) -> DataFrame:
    """Importance of each feature in a boosted-tree model, largest first.

    Up to ``OBJECTS`` rows the trees are Spark ML's; beyond, they grow by the sums of a level. Node ids are not cached: a row's
    way down a tree is a few comparisons, a cached copy of all ids for each level is not.
    """
    stored = store_table(df.where(F.col(label).isNotNull()).select(label, *features), "training")
    if stored.count() > OBJECTS:
        grown = boosting.grow(stored, features, label, trees, depth, rate, sampling, min_leaf, seed)
        shares = boosting.importances(grown, len(features))
    else:
        spread = spread_rows(stored)
        rows = assembled(spread, features).select(label, "features")
        regressor = GBTRegressor(
            labelCol=label, maxIter=trees, maxDepth=depth, stepSize=rate, subsamplingRate=sampling,
            minInstancesPerNode=min_leaf, seed=seed, checkpointInterval=10,
        )
        with nullcontext() if spread is stored else files_apart(df.sparkSession):
            model = regressor.fit(rows)
        shares = model.featureImportances.toArray()
    table = coefficient_table(df.sparkSession, features, shares)
    return table.withColumnRenamed("coef", "importance").orderBy(F.col("importance").desc(), "name")


def forest_score(
    df: DataFrame, features: Sequence[str], label: str, trees: int = 50, depth: int = 8, top: int = 100, seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Random forest: all rows with their prediction, and the most important features.

    Up to ``OBJECTS`` labelled rows are Spark ML's, which holds them as objects with a count for each tree; beyond, the
    trees grow by the sums of a level.
    """
    stored = store_table(df, "scored")
    training = stored.where(F.col(label).isNotNull()).select(*dict.fromkeys([label, *features]))
    if training.count() > OBJECTS:
        grown = forest.grow(training, features, label, trees, depth, seed)
        shares, scored = grown.importances(), stored.withColumn("prediction", grown.prediction(features))
    else:
        model = RandomForestRegressor(labelCol=label, numTrees=trees, maxDepth=depth, seed=seed).fit(assembled(spread_rows(training), features))
        shares, scored = model.featureImportances.toArray(), model.transform(assembled(stored, features)).drop("features")
    table = coefficient_table(df.sparkSession, features, shares)
    ranked = table.withColumnRenamed("coef", "importance").orderBy(F.col("importance").desc(), "name").limit(top)
    return scored, ranked


def area_scores(
    df: DataFrame, area: Sequence[str], features: Sequence[str], label: str, trees: int = 500, depth: int = 8, top: int = 100, seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Score table of areas by a random forest: one row per area with ``area_score``, and the ``top`` features.

    Rows are first brought to one per area by the means of columns and label; missing columns then take the mean of
    the areas, as rough imputation does. An area without a label is scored, not trained on.
    """
    means = [F.avg(F.col(c).cast("double")).alias(c) for c in [*features, label]]
    areas = cut_lineage(df.groupBy(*area).agg(F.count(F.lit(1)).alias("n_rows"), *means))
    usual = areas.agg(*[F.avg(c).alias(c) for c in features]).first()
    filled = areas.withColumns({c: F.coalesce(c, F.lit(usual[c] or 0.0)) for c in features})
    scored, ranked = forest_score(filled, features, label, trees, depth, top, seed)
    return scored.select(*area, "n_rows", F.col(label), F.col("prediction").alias("area_score")), ranked


def pca_scores(
    df: DataFrame, columns: Sequence[str], components: int = 4, rank: str | None = None
) -> tuple[DataFrame, list[float]]:
    """First component scores of the scaled columns (nulls as zero) and the variance shares.

    Rows without a rank are dropped first when ``rank`` names its column.
    """
    rows = df.where(F.col(rank).isNotNull()) if rank else df
    ready = assembled(rows, columns, "_raw")
    k = min(components, len(columns))
    model = Pipeline(
        stages=[
            StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True),
            PCA(k=k, inputCol="_scaled", outputCol="_pc"),
        ]
    ).fit(ready)
    scored = model.transform(ready).withColumn("_pc", vector_to_array("_pc"))
    named = scored.withColumns({f"pc{i + 1}": F.col("_pc")[i] for i in range(k)})
    return named.drop("_raw", "_scaled", "_pc"), list(model.stages[-1].explainedVariance.toArray())


def covariance(df: DataFrame, vector: str) -> tuple[np.ndarray, np.ndarray]:
    """Mean and sample covariance of a vector column: numbers for columns only, not for rows."""
    stats = df.select(Summarizer.metrics("mean", "std").summary(F.col(vector)).alias("s")).first().s
    std = stats.std.toArray()
    corr = np.nan_to_num(Correlation.corr(df, vector).first()[0].toArray())
    np.fill_diagonal(corr, 1.0)
    return stats.mean.toArray(), corr * np.outer(std, std)


def _first_component(cov: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Loadings of the first component on the scaled columns, and the variance shares."""
    sd = np.sqrt(np.maximum(np.diag(cov), 0.0))
    sd[sd == 0] = 1.0
    values, vectors = np.linalg.eigh(cov / np.outer(sd, sd))
    lead = vectors[:, -1]
    lead = lead * np.sign(lead[np.argmax(np.abs(lead))])
    shares = values[::-1] / values.sum()
    return lead / sd, shares


def spline_pca(
    df: DataFrame, key: str, columns: Sequence[str], rounds: int = 5, knots: int = 3
) -> tuple[DataFrame, list[float]]:
    """Replace each column by its spline fit to the first component, take components again, repeat.

    Every fit and every component is linear in the spline terms, so all rounds follow from the
    covariance of the terms: one pass over the rows gives it, one more gives the scores.
    """
    filled = df.select(key, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns])
    terms, groups = [], []
    for c in columns:
        own = [F.col(c), *rcs_terms(c, spline_knots(filled, c, knots))]
        groups.append(list(range(len(terms), len(terms) + len(own))))
        terms += own
    ready = cut_lineage(filled.withColumn("_terms", array_to_vector(F.array(*terms))))
    mean, cov = covariance(ready, "_terms")
    linear = [g[0] for g in groups]
    start, shares = _first_component(cov[np.ix_(linear, linear)])
    weight = np.zeros(len(terms))
    weight[linear] = start
    for _ in range(rounds):
        fits = np.zeros((len(columns), len(terms)))
        for j, g in enumerate(groups):
            fits[j, g] = np.linalg.pinv(cov[np.ix_(g, g)]) @ cov[g] @ weight
        lead, shares = _first_component(fits @ cov @ fits.T)
        weight = lead @ fits
    parts = vector_to_array("_terms")
    score = F.lit(float(-weight @ mean))
    for i, w in enumerate(weight):
        score = score + parts[i] * F.lit(float(w))
    return ready.withColumn("pc1", score).drop("_terms"), [float(v) for v in shares]


UNITS = 2.0**30  # to a standard deviation: differences below one are only rounding
GRAIN = 24  # doublings of a unit in the width of the finest cells, 1/64 of a standard deviation
WIDEST = 10  # step of cells of eight standard deviations, where the search begins


def clustering_features(df: DataFrame, columns: Sequence[str], most: int = 2000) -> tuple[DataFrame, DataFrame, int]:
    """Rows with their ``_cell``, and the features of at most ``most`` cells: ``n``, ``sums`` and ``squares`` of the
    scaled columns. The third value is 0 where each different row is a cell of its own, else 1 for cells of ``GRAIN``
    and 1 more for each doubling.

    Cells are the finest of which there are not too many, looked for from wide to fine, so that a task never holds more
    of them than one halving makes of ``most``. Different rows are many, but only counted by their hash.
    """
    held = store_table(df, "clustered")
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns}
    facts = held.agg(*[F.struct(F.avg(v).alias("m"), F.stddev_samp(v).alias("s")).alias(c) for c, v in filled.items()]).first()
    scaled = [(v - F.lit(facts[c].m or 0.0)) / F.lit(facts[c].s or 1.0) for c, v in filled.items()]

    def cell(step: int) -> Column:
        units = [F.rint(z * UNITS).cast("long") for z in scaled]
        return F.array(*[F.shiftright(u, GRAIN + step - 1) if step else u for u in units])

    def features(step: int) -> DataFrame:
        sums = [F.sum(z).alias(f"s{i}") for i, z in enumerate(scaled)]
        squares = [F.sum(z**2).alias(f"q{i}") for i, z in enumerate(scaled)]
        return store_table(held.groupBy(cell(step).alias("_cell")).agg(F.count(F.lit(1)).alias("n"), *sums, *squares), "cells")

    def too_many(step: int) -> bool:
        return held.select(F.xxhash64(cell(step)).alias("_hash")).distinct().limit(most + 1).count() > most

    step = 0 if held.limit(most + 1).count() <= most else WIDEST
    while step and not too_many(step - 1):
        step -= 1
    cells = features(step)
    while cells.count() > most:
        shift = 1 if step else GRAIN
        step += 1
        wider = cells.withColumn("_cell", F.transform("_cell", lambda c: F.shiftright(c, shift)))
        again = [F.sum(c).alias(c) for c in cells.columns if c != "_cell"]
        cells = store_table(wider.groupBy("_cell").agg(*again), "cells")
    parts = range(len(columns))
    table = cells.select("_cell", "n", F.array(*[f"s{i}" for i in parts]).alias("sums"), F.array(*[f"q{i}" for i in parts]).alias("squares"))
    return held.withColumn("_cell", cell(step)), table, step


def complete_linkage(points: np.ndarray, clusters: int) -> np.ndarray:
    """Cluster numbers by complete linkage: always the two clusters merge whose farthest points are nearest."""
    n = len(points)
    square = (points**2).sum(axis=1)
    far = np.maximum(square[:, None] + square[None, :] - 2 * points @ points.T, 0)
    np.fill_diagonal(far, np.inf)
    label = np.arange(n)
    alive = np.ones(n, bool)
    nearest, distance = far.argmin(axis=1), far.min(axis=1)
    for _ in range(max(0, n - clusters)):
        a = int(np.where(alive, distance, np.inf).argmin())
        b = int(nearest[a])
        a, b = min(a, b), max(a, b)
        far[a] = far[:, a] = np.maximum(far[a], far[b])
        far[a, a] = np.inf
        far[b] = far[:, b] = np.inf
        alive[b] = False
        label[label == b] = a
        # Only those whose nearest cluster was one of the two look again.
        for i in np.flatnonzero(alive & ((nearest == a) | (nearest == b) | (np.arange(n) == a))):
            nearest[i], distance[i] = far[i].argmin(), far[i].min()
    return np.unique(label, return_inverse=True)[1]


def cluster_rows(df: DataFrame, columns: Sequence[str], clusters: int = 10, most: int = 2000) -> DataFrame:
    """Cluster number of each row, by complete linkage on scaled columns (nulls as zero).

    Up to ``most`` different rows are linked as they are; of more, the centres of cells. Clusters are numbered by the
    order of their least centre.
    """
    placed, table, _ = clustering_features(df, columns, most)
    cells = table.select("_cell", F.transform("sums", lambda s: s / F.col("n")).alias("centre")).orderBy("centre").collect()
    if not cells:
        return placed.drop("_cell").withColumn("cluster", F.lit(None).cast("int"))
    found = complete_linkage(np.array([c.centre for c in cells]), clusters)
    first = {int(k): i for i, k in reversed(list(enumerate(found)))}
    number = {k: i for i, k in enumerate(sorted(first, key=first.get))}
    rows = [(c["_cell"], number[int(k)]) for c, k in zip(cells, found)]
    # Stored, the table has a known size and is sent to the rows, which then stay where they are.
    named = store_table(df.sparkSession.createDataFrame(rows, "_at array<long>, cluster int"), "clusters")
    return placed.join(named, F.col("_cell") == F.col("_at")).drop("_cell", "_at")
