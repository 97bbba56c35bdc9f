"""Joins.

No side is broadcast by hint: Catalyst broadcasts a side whose measured size is under
``spark.sql.autoBroadcastJoinThreshold`` (AQE again at run time) and otherwise shuffles both
and splits skewed keys.

AQE splits a hot key only if both inputs of the join come straight from a shuffle. A side that
was just aggregated on the join keys would skip its shuffle, and the other side's hot key would
stay in one task. ``keyed_join`` therefore compares keys null-safely (with null keys removed from
the looked-up side, so the result is that of plain equality): the join keys then differ from the
aggregate's, the aggregated side, which is the smaller one, is shuffled again, and hot keys split.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import dates
from ..functions.codes import is_present


def keyed_join(left: DataFrame, right: DataFrame, on: Mapping[str, str], how: str = "inner", extra: Column | None = None) -> DataFrame:
    """Join on left key -> right key pairs; ``extra`` narrows the match, null keys never match."""
    match, present = extra, None
    for l, r in on.items():
        equal = F.col(l).eqNullSafe(F.col(r))
        match = equal if match is None else match & equal
        known = F.col(r).isNotNull()
        present = known if present is None else present & known
    return left.join(right.where(present), match, how)


def attach(
    left: DataFrame, right: DataFrame, on: Mapping[str, str] | Sequence[str], columns: Sequence[str] | None = None, how: str = "left"
) -> DataFrame:
    """Lookup join that keeps the left columns and adds the right non-key ones (or ``columns``)."""
    pairs = dict(on) if isinstance(on, Mapping) else {k: k for k in on}
    extra = list(columns) if columns is not None else [c for c in right.columns if c not in pairs.values()]
    names = {r: f"_r_{r}" for r in pairs.values()}
    side = right.select(*[F.col(r).alias(n) for r, n in names.items()], *extra)
    return keyed_join(left, side, {l: names[r] for l, r in pairs.items()}, how).drop(*names.values())


def dated_join(
    claims: DataFrame, coverage: DataFrame, keys: Sequence[str], dates_between: Sequence[str], lower: Column, upper: Column
) -> DataFrame:
    """Inner join on keys with every claim date in [lower, upper).

    The bounds come from the coverage row; they stay in the join condition, so rows outside are
    dropped inside the join and never materialised.
    """
    names = {k: f"_k_{k}" for k in keys}
    side = coverage.withColumnsRenamed(names).withColumns({"_from": lower, "_to": upper})
    inside = None
    for d in dates_between:
        one = (F.col(d) >= F.col("_from")) & (F.col(d) < F.col("_to"))
        inside = one if inside is None else inside & one
    return keyed_join(claims, side, names, extra=inside).drop(*names.values(), "_from", "_to")


def lookback_filter(claims: DataFrame, coverage: DataFrame, keys: Sequence[str], date_columns: Sequence[str], months: int = 24) -> DataFrame:
    uw = F.col("underwriting_date")
    return dated_join(claims, coverage, keys, date_columns, F.add_months(uw, -months), uw)


def plan_year_filter(claims: DataFrame, coverage: DataFrame, keys: Sequence[str], date_columns: Sequence[str], months: int = 12) -> DataFrame:
    eff = F.col("effective_date")
    return dated_join(claims, coverage, keys, date_columns, eff, F.add_months(eff, months))


def month_spine(groups: DataFrame, months: int = 26, first_interval: int = 3) -> DataFrame:
    """One row per group and month before the data-through date, with the month's bounds."""
    rows = groups.withColumn("month_from_uw", F.explode(F.sequence(F.lit(1), F.lit(months))))
    start = F.add_months(dates.first_of_month("data_thru"), 1 - F.col("month_from_uw"))
    return rows.withColumns(
        {
            "month_start": start,
            "month_end": F.last_day(start),
            "times": dates.times_bucket_from("month_from_uw", first_interval),
        }
    )


def month_range_join(claims: DataFrame, groups: DataFrame, day: str, months: int = 26, first_interval: int = 3) -> DataFrame:
    """Claims with their month before the data-through date.

    Equal to joining the month spine by date range, but the month is computed from the date, so
    one equi join on the group replaces a join with every month.
    """
    near = attach(claims, groups, ["group_id"], how="inner")
    index = dates.month_index("data_thru", day)
    return (
        near.withColumn("month_from_uw", index)
        .where(F.col("month_from_uw").between(1, months))
        .withColumn("times", dates.times_bucket_from("month_from_uw", first_interval))
    )


def with_periods(members: DataFrame, periods: Sequence[int] = (1, 2, 3)) -> DataFrame:
    return members.withColumn("times", F.explode(F.array(*[F.lit(p) for p in periods])))


def two_edition_category(codes: DataFrame, code: str, first: DataFrame, second: DataFrame, unknown: str) -> DataFrame:
    """Category from the first edition, else from the second, else ``unknown``."""
    a = first.select(F.col("diag_cd").alias("_a"), F.col("prefx_map_id").alias("_cat_a"))
    b = second.select(F.col("diag_cd").alias("_b"), F.col("prefx_map_id").alias("_cat_b"))
    first_found = keyed_join(codes, a, {code: "_a"}, "left")
    return (
        keyed_join(first_found, b, {code: "_b"}, "left")
        .withColumn("category", F.coalesce("_cat_a", "_cat_b", F.lit(unknown)))
        .drop("_a", "_b", "_cat_a", "_cat_b")
    )


def drug_by_ndc_or_procedure(lines: DataFrame, drugs: DataFrame, ndc: str, procedure: str, columns: Sequence[str]) -> DataFrame:
    """Drug attributes by drug code, each falling back to the procedure code's."""
    by_ndc = drugs.select(F.col("ndc_id").alias("_n"), *[F.col(c).alias(f"_n_{c}") for c in columns])
    by_proc = drugs.select(F.col("hcpcs").alias("_p"), *[F.col(c).alias(f"_p_{c}") for c in columns])
    joined = keyed_join(keyed_join(lines, by_ndc, {ndc: "_n"}, "left"), by_proc, {procedure: "_p"}, "left")
    helper = ["_n", "_p", *[f"_{s}_{c}" for s in "np" for c in columns]]
    return joined.withColumns({c: F.coalesce(f"_n_{c}", f"_p_{c}") for c in columns}).drop(*helper)


def _keyed_rules(rules: DataFrame) -> DataFrame:
    """Rules with the key of the codes they name; rules without any code drop out."""
    cpt, dx = F.col("cpt_signal"), F.col("dx_signal")
    named = rules.where(cpt.isNotNull() | dx.isNotNull())
    ways = cpt.isNotNull().cast("int") + 2 * dx.isNotNull().cast("int")
    return named.withColumns({"_cpt": F.coalesce(cpt, F.lit("")), "_dx": F.coalesce(dx, F.lit("")), "_ways": ways})


def _way(kind: int, procedure: Column, diagnosis: Column, carried: Column) -> Column:
    return F.struct(F.lit(kind).alias("w"), procedure.alias("p"), diagnosis.alias("d"), carried.alias("c"))


def _meet_rules(keyed: DataFrame, rules: DataFrame) -> DataFrame:
    """Claims with their way to match (``_way``) and the rules of that key, in one equi join."""
    each = keyed.select("*", F.col("_way.w").alias("_w"), F.col("_way.p").alias("_p"), F.col("_way.d").alias("_d"))
    matched = keyed_join(each, _keyed_rules(rules), {"_w": "_ways", "_p": "_cpt", "_d": "_dx"}).drop("_w", "_p", "_d", "_ways", "_cpt", "_dx")
    return matched.withColumns({c: F.coalesce(c, F.lit("")) for c in ("cpt_signal", "dx_signal")})


def signal_join(claims: DataFrame, rules: DataFrame, procedure: str, diagnosis: str) -> DataFrame:
    """Claims matched to rules by both codes, or by the only code a rule names.

    Each claim gets a key per way to match, up to three, and meets the rules in one equi join: claims are read once.
    """
    p, d, none = F.col(procedure), F.col(diagnosis), F.lit("")
    ways = F.array_compact(
        F.array(
            F.when(p.isNotNull(), _way(1, p, none, d)),
            F.when(d.isNotNull(), _way(2, none, d, d)),
            F.when(p.isNotNull() & d.isNotNull(), _way(3, p, d, d)),
        )
    )
    return _meet_rules(claims.withColumn("_way", F.explode(ways)), rules).drop("_way")


def signal_join_any(claims: DataFrame, rules: DataFrame, procedure: str, diagnoses: Sequence[str], output: str = "diag") -> DataFrame:
    """``signal_join`` for claims with several diagnosis columns, which become ``output``.

    A claim's keys form one array, exploded once: its procedure alone once, however many diagnoses it has, and each
    different diagnosis alone and with the procedure. ``output`` is the diagnosis that met the rule; where the rule
    names a procedure only, null if a diagnosis column is null, else the least diagnosis.
    """
    p, none = F.col(procedure), F.lit("")
    columns = [F.col(c) for c in diagnoses]
    listed = F.array_distinct(F.array_compact(F.array(*columns)))
    lacking = F.lit(False)
    for c in columns:
        lacking = lacking | c.isNull()
    least = F.when(~lacking, F.array_min(listed))
    alone = F.when(p.isNotNull(), F.array(_way(1, p, none, least))).otherwise(F.array())
    single = F.transform(listed, lambda d: _way(2, none, d, d))
    pairs = F.when(p.isNotNull(), F.transform(listed, lambda d: _way(3, p, d, d))).otherwise(F.array())
    rest = [c for c in claims.columns if c not in diagnoses]
    keyed = claims.select(*rest, F.explode(F.concat(alone, single, pairs)).alias("_way"))
    return _meet_rules(keyed, rules).withColumn("_way", F.col("_way.c")).withColumnRenamed("_way", output).select(
        *rest, output, *[c for c in rules.columns if c not in rest]
    )


def source_match(
    submissions: DataFrame,
    events: DataFrame,
    keys: Mapping[str, str],
    submitted: str,
    event_day: str,
    source: str,
    sources: Mapping[str, str],
    longest: int = 365 * 2 + 90,
    shortest: int = 90,
) -> DataFrame:
    """Per submission, a 0/1 flag for each source seen between ``longest`` and ``shortest`` days before it.

    The flags depend on the key and the day only. Both sides shrink to one row per key and day,
    and a range window over the days of a key looks back: a key has at most as many rows as
    there are days, and no submission is ever paired with its events.
    """
    names = {r: f"_k_{l}" for l, r in keys.items()}
    on = [f"_k_{l}" for l in keys]
    seen = events.select(
        *[F.col(r).alias(n) for r, n in names.items()],
        F.col(event_day).alias("_day"),
        *[F.when(F.col(source) == v, 1).otherwise(0).alias(n) for n, v in sources.items()],
        F.lit(0).alias("_asked"),
    )
    asked = submissions.select(
        *[F.col(l).alias(f"_k_{l}") for l in keys],
        F.col(submitted).alias("_day"),
        *[F.lit(0).alias(n) for n in sources],
        F.lit(1).alias("_asked"),
    )
    columns = [*sources, "_asked"]
    days = asked.unionByName(seen).where(F.col("_day").isNotNull()).groupBy(*on, "_day")
    daily = days.agg(*[F.max(c).alias(c) for c in columns])
    back = Window.partitionBy(*on).orderBy(F.unix_date("_day")).rangeBetween(-longest, -shortest)
    flags = daily.select(
        *on, "_day", "_asked", *[F.coalesce(F.max(n).over(back), F.lit(0)).alias(n) for n in sources]
    ).where(F.col("_asked") == 1)
    return attach(
        submissions, flags, {**{l: f"_k_{l}" for l in keys}, submitted: "_day"}, list(sources)
    ).na.fill(0, list(sources))


def new_keys_only(candidates: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    return candidates.select(*keys).distinct().join(known.select(*keys), list(keys), "left_anti")


def exclude_values(df: DataFrame, column: str, listed: DataFrame, listed_column: str) -> DataFrame:
    out = listed.select(F.col(listed_column).alias("_x"))
    return keyed_join(df, out, {column: "_x"}, "left_anti")


def eligible_claims(lines: DataFrame, eligible: DataFrame, claim: str = "claim_id", setting: str = "setting", procedure: str = "proc_cd") -> DataFrame:
    """Lines of claims that are inpatient, or outpatient with an eligible procedure."""
    listed = eligible.select(F.col("cpt").alias("_cpt")).where(is_present("_cpt"))
    outpatient = keyed_join(lines.where(F.col(setting) == "o"), listed, {procedure: "_cpt"}, "left_semi")
    ids = lines.where(F.col(setting) == "i").select(claim).unionByName(outpatient.select(claim)).distinct()
    return keyed_join(lines, ids.withColumnRenamed(claim, "_claim"), {claim: "_claim"}, "left_semi")


def full_outer_coalesce(left: DataFrame, right: DataFrame, keys: Sequence[str], shared: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Full outer join; each shared column is the first non-null of its pair."""
    joined = left.join(right, list(keys), "full_outer")
    pairs = [c for pair in shared.values() for c in pair]
    return joined.withColumns({n: F.coalesce(a, b) for n, (a, b) in shared.items()}).drop(*pairs)


def merge_features(base: DataFrame, sources: Mapping[str, DataFrame], keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Attach feature columns of several frames to ``base``, missing as zero.

    Sources are stacked and summed per key once, so the base is joined a single time however
    many sources there are.
    """
    stacked = None
    for frame in sources.values():
        part = frame.select(*keys, *[c for c in columns if c in frame.columns])
        stacked = part if stacked is None else stacked.unionByName(part, allowMissingColumns=True)
    summed = stacked.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in columns])
    return attach(base, summed, list(keys)).na.fill(0, list(columns))
