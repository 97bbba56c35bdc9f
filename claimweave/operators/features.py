"""Feature building and scoring without model training."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .joins import attach
from .ordering import quantile_values, with_grand_totals, with_group_totals
from .windows import prediction_share
from ..functions import as_col, numbers
from ..session import store_table

SETTINGS_3 = ("ixx", "xox", "xxr")


def uniform_draw(keys: Sequence[Column | str], seed: int = 0) -> Column:
    """Number in [0, 1) fixed by the key and the seed: the same on every run and every executor."""
    text = F.concat_ws("|", *[as_col(k).cast("string") for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(2.0**32)


def assign_partition(
    df: DataFrame, keys: Sequence[str], train: float, valid: float, seed: int = 0, stored: DataFrame | None = None
) -> DataFrame:
    """train / valid / test and a ten-fold id per key; stored assignments win."""
    u = uniform_draw(keys, seed)
    name = F.when(u <= train, "train").when(u <= train + valid, "valid").otherwise("test")
    fold = F.floor(u * 10).cast("int") + 1
    drawn = df.withColumns({"partition_name": name, "fold": fold})
    if stored is None:
        return drawn
    kept = stored.select(*keys, F.col("partition_name").alias("_p"), F.col("fold").alias("_f"))
    held = attach(drawn, kept, list(keys), ["_p", "_f"])
    return held.withColumns(
        {"partition_name": F.coalesce("_p", "partition_name"), "fold": F.coalesce("_f", "fold")}
    ).drop("_p", "_f")


def surrogate_ids(keys: DataFrame, key: str, salt: str, stored: DataFrame | None = None, output: str = "surrogate_id") -> DataFrame:
    """Key table with ids: stored ones as they are, new keys with a salted hash."""
    once = keys.select(key).where(F.col(key).isNotNull()).distinct()
    fresh = once if stored is None else once.join(stored.select(key), key, "left_anti")
    named = fresh.withColumn(output, F.sha2(F.concat(F.lit(salt), F.col(key).cast("string")), 256))
    return named if stored is None else stored.select(key, output).unionByName(named)


def split_by_partition(df: DataFrame, column: str, values: Sequence[str] = ("train", "valid_paramopt", "valid_holdout")) -> dict[str, DataFrame]:
    return {v: df.where(F.col(column) == v) for v in values}


# Knot quantiles by number of knots.
KNOT_QUANTILES = {
    3: (0.05, 0.5, 0.95),
    4: (0.05, 0.35, 0.65, 0.95),
    5: (0.05, 0.275, 0.5, 0.725, 0.95),
    6: (0.05, 0.23, 0.41, 0.59, 0.77, 0.95),
    7: (0.025, 0.183333, 0.341667, 0.5, 0.658333, 0.816667, 0.975),
}


def spline_knots(df: DataFrame, column: str, knots: int = 5) -> list[float]:
    values = quantile_values(df, column, KNOT_QUANTILES[knots])
    return [0.0 if abs(v) < 1e-9 else v for v in values]


def rcs_terms(x: Column | str, knots: Sequence[float], norm: int = 2) -> list[Column]:
    """Non-linear terms of a restricted cubic spline: cubic between, linear beyond the outer knots."""
    c = as_col(x)
    first, last, before = knots[0], knots[-1], knots[-2]
    scale = {0: 1.0, 1: last - before, 2: (last - first) ** (2.0 / 3.0)}[norm]
    # Repeated knots give a zero scale; such a spline has no curvature to add.
    scale = scale or 1.0
    span = (last - before) or 1.0

    def cube(knot: float) -> Column:
        over = F.greatest((c - F.lit(knot)) / F.lit(scale), F.lit(0.0))
        return over * over * over

    terms = []
    for t in knots[:-2]:
        tail = (F.lit(before - t) * cube(last) - F.lit(last - t) * cube(before)) / F.lit(span)
        terms.append(F.when(c.isNotNull(), cube(t) + tail))
    return terms


def rcs_basis(df: DataFrame, column: str, knots: int = 5, norm: int = 2, at: Sequence[float] | None = None) -> DataFrame:
    places = list(at) if at is not None else spline_knots(df, column, knots)
    return df.withColumns({f"{column}_{i}": t for i, t in enumerate(rcs_terms(column, places, norm), start=1)})


def code_tfidf(rows: DataFrame, keys: Sequence[str], code: str) -> DataFrame:
    """TF-IDF weight of each code per key in long form: smooth idf, rows scaled to unit length.

    Counting replaces building code sentences, so a key with very many rows is summed on the
    map side and never gathered. The counts are far smaller than the rows and are read three
    times, so they are stored.
    """
    counted = rows.where(F.col(code).isNotNull()).groupBy(*keys, code).agg(F.count(F.lit(1)).alias("tf"))
    tf = store_table(counted, "code_counts")
    documents = tf.select(*keys).distinct().agg(F.count(F.lit(1)).alias("n"))
    df_counts = tf.groupBy(code).agg(F.count(F.lit(1)).alias("df")).withColumn("n", documents.scalar())
    idf = df_counts.select(code, (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))
    raw = attach(tf, idf, [code]).withColumn("raw", F.col("tf") * F.col("idf"))
    # A key has one row per code, so its rows are few.
    square = F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(*keys))
    return raw.select(*keys, code, (F.col("raw") / F.sqrt(square)).alias("tfidf"))


def code_tfidf_features(tfidf: DataFrame, keys: Sequence[str], code: str, vocabulary: Sequence[str], stem: str = "cpt") -> DataFrame:
    """One column per code of a fixed vocabulary, their sum and a has-any flag."""
    return tfidf.groupBy(*keys).agg(
        *[F.coalesce(F.max(F.when(F.col(code) == v, F.col("tfidf"))), F.lit(0.0)).alias(v) for v in vocabulary],
        F.coalesce(F.sum(F.when(F.col(code).isin(*vocabulary), F.col("tfidf"))), F.lit(0.0)).alias(f"sum_{stem}"),
        F.lit(1).alias(f"has_{stem}"),
    )


def linear_score(terms: Mapping[str, float], intercept: float = 0.0) -> Column:
    total = F.lit(float(intercept))
    for name, coef in terms.items():
        total = total + F.coalesce(F.col(name).cast("double"), F.lit(0.0)) * F.lit(float(coef))
    return total


def apply_linear_rate(
    df: DataFrame, terms: Mapping[str, float], segments: Mapping[str, float], segment: str, intercept: float, output: str = "rate_calibrated"
) -> DataFrame:
    """Stored linear rate: numeric terms and one addend per listed segment; the base segment adds nothing."""
    addend = F.lit(0.0)
    for level, coef in segments.items():
        addend = F.when(F.col(segment) == level, F.lit(float(coef))).otherwise(addend)
    return df.withColumn(output, linear_score(terms, intercept) + addend)


#: The stacked models by the sources they are made of; the last one stands for every other mix of sources.
STACKS = {"op_rx": ("xox", "xxr"), "op": ("xox",), "rx": ("xxr",), "med": ("ixx", "xox"), "ior": ("ixx", "xox", "xxr")}


def has_prediction(setting: str) -> Column:
    return F.coalesce(*[F.col(f"pred_{setting}_{i}") for i in (1, 2, 3)]).isNotNull()


def source_pattern() -> Column:
    """The stacked model whose sources are those with a prediction; the all-source model where there is none such."""
    present = F.concat_ws("+", *[F.when(has_prediction(s), s) for s in sorted(SETTINGS_3)])
    names = F.create_map(*[F.lit(x) for name, sources in STACKS.items() for x in ("+".join(sorted(sources)), name)])
    return F.coalesce(F.try_element_at(names, present), F.lit([*STACKS][-1]))


def stacked_score(df: DataFrame, output: str = "score") -> DataFrame:
    """The stacked prediction of the row's source pattern, from columns pred_<pattern>."""
    pattern = df.withColumn("pattern", source_pattern())
    chosen = F.lit(None).cast("double")
    for name in STACKS:
        chosen = F.when(F.col("pattern") == name, F.col(f"pred_{name}")).otherwise(chosen)
    return pattern.withColumn(output, chosen)


def log_offset(calibrated: Column | str) -> Column:
    return F.log(F.greatest(as_col(calibrated), F.lit(0.0)) + 0.001)


def group_features(groups: DataFrame, counts: Sequence[str], flags: Sequence[str], score: str = "score") -> DataFrame:
    """Shares of members, Box-Cox forms of the mean score, and products of the two."""
    members = F.col("total_members")
    shares = {f"{c.removesuffix('_count')}_pct": F.col(c) / members for c in counts}
    shares |= {c: F.col(c) / members for c in flags}
    s = F.col(score)
    held = groups.withColumns(
        {**shares, "bc_score": numbers.box_cox(s, -0.2), "log_score": numbers.box_cox(s, 0.0),
         "log_quoted_pfm_rel": F.log(F.col("quoted_pfm_rel") + 0.001)}
    )
    share = F.col(f"{score}_pct")
    return held.withColumns(
        {"score_ttl": share * s, "log_score_pct": F.col("log_score") * share, "bc_score_pct": F.col("bc_score") * share}
    )


def group_risk(df: DataFrame, pred: str = "pred", offset: str = "offset") -> DataFrame:
    """Predicted cost relative to the calibrated rate, and debits relative to the yearly cost."""
    rate = F.exp(F.col(offset))
    yearly = 12 * F.col("total_members") * F.col("pfm_calibrated")
    held = df.withColumn("pfm_calibrated", rate)
    return held.withColumns(
        {
            "risk_pfm": F.col(pred) / (F.lit(0.00001) + F.col("pfm_calibrated")),
            "rx_debit_rs": F.coalesce("rx_debits", F.lit(0.0)) / yearly,
            "med_debit_rs": F.coalesce("med_debits", F.lit(0.0)) / yearly,
        }
    )


def linear_contribution(df: DataFrame, coefficients: Mapping[str, float], by: Sequence[str] = ()) -> DataFrame:
    """coef * (x - mean) per feature; the mean is over all rows, or over the row's group."""
    means = {f"_m_{c}": F.avg(c) for c in coefficients}
    held = with_group_totals(df, by, means) if by else with_grand_totals(df, means)
    parts = {f"{c}_contrib": F.lit(float(v)) * (F.col(c) - F.col(f"_m_{c}")) for c, v in coefficients.items()}
    return held.withColumns(parts).drop(*means)


def allocate_contribution(
    totals: DataFrame, members: DataFrame, categories: DataFrame, group: Sequence[str], member: str, eps: float = 0.01
) -> DataFrame:
    """Spread a group's contribution per component over its members and their categories.

    ``totals``: group, component, contribution. ``members``: group, member, component, prediction.
    ``categories``: group, member, component, category, weight. A member's part follows its
    prediction, a category's part its weight; parts are summed over components.
    """
    keys = [*group, "component"]
    shared = prediction_share(members, keys, "prediction", "_share", eps)
    part = attach(shared, totals, keys, ["contribution"]).withColumn("_part", F.col("contribution") * F.col("_share"))
    weighted = with_group_totals(categories, [*keys, member], {"_all": F.sum("weight")})
    joined = weighted.join(part.select(*keys, member, "_part"), [*keys, member])
    impact = F.col("_part") * F.try_divide(F.col("weight"), F.col("_all"))
    return joined.groupBy(*group, member, "category").agg(F.sum(impact).alias("impact"))


MOST_ATTRIBUTES = 10_000


def formula_from_table(attributes: DataFrame, version: str) -> str:
    """Model formula from an attribute table: one response, numeric and categorical predictors.

    A formula names columns, so more than ``MOST_ATTRIBUTES`` rows are taken for a wrong table.
    """
    rows = attributes.where(F.col(version) == 1).select("Attribute", "Variable_Category", "IsChar").limit(MOST_ATTRIBUTES + 1).collect()
    if len(rows) > MOST_ATTRIBUTES:
        raise ValueError(f"more than {MOST_ATTRIBUTES} attributes")
    response = [r.Attribute for r in rows if r.Variable_Category == "Response"]
    if len(response) != 1:
        raise ValueError("the version needs exactly one response")
    predictors = sorted((r for r in rows if r.Variable_Category != "Response"), key=lambda r: (r.IsChar == 1, r.Attribute))
    return f"{response[0]} ~ " + " + ".join(r.Attribute for r in predictors)
