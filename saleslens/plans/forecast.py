"""Forecasts for many daily series at once.

The seasonal forecast, the folds, the metrics and the trend fit are relational:
one job serves all series (and all folds).  Boosted trees (``boosting``) learn one
shared model over the whole panel; targets are scaled by the level of their series
so that one model fits them all.
"""

from __future__ import annotations

from calendar import isleap
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import MONEY, as_col, clip, day_range, exact_sum, geometric_growth, ratio
from ..operators.joins import left_chain
from ..operators.windows import lag_value
from ..sources.files import materialize
from .boosting import TreeModel, fit_trees, fit_trees_by, predict_by
from .features import feature_table

# -- seasonal forecast --------------------------------------------------------


def year_normalized(df: DataFrame, keys: list[str], date: str, values: Mapping[str, str]) -> DataFrame:
    """Value over the mean day of its year and series (at most 366 rows per group)."""
    w = W.partitionBy(*keys, F.year(date))
    return df.withColumns({
        out: ratio(v, ratio(F.sum(F.col(v).cast(MONEY)).over(w), F.count(v).over(w))) for v, out in values.items()})


def seasonal_profile(df: DataFrame, keys: list[str], date: str, values: Mapping[str, str]) -> DataFrame:
    """Mean normalised value per (month, day) of the year."""
    norm = year_normalized(df, keys, date, values)
    return norm.groupBy(*keys, F.month(date).alias("month"), F.day(date).alias("day")).agg(
        *[F.avg(n).alias(n) for n in values.values()])


def level_and_growth(df: DataFrame, keys: list[str], date: str, values: Sequence[str], first_year: int, last_year: int) -> DataFrame:
    """Mean day of the last full year and the geometric yearly growth, per series."""
    n_days = 366 if isleap(last_year) else 365
    year = F.year(date)
    yearly = df.where(year.between(first_year, last_year)).groupBy(*keys, year.alias("_y")).agg(
        *[exact_sum(v).alias(v) for v in values])
    for v in values:
        yearly = lag_value(yearly, keys, "_y", v, f"_p_{v}")
    last = F.col("_y") == last_year
    return yearly.groupBy(*keys).agg(
        *[(F.max(F.when(last, F.col(v))) / n_days).alias(f"base_{v}") for v in values],
        *[geometric_growth(ratio(v, f"_p_{v}")).alias(f"growth_{v}") for v in values])


def seasonal_naive(
    dates: DataFrame, profile: DataFrame, levels: DataFrame, keys: list[str], date: str, values: Mapping[str, str],
    base_year: int, digits: int | None = 2,
) -> DataFrame:
    """Base level x growth^years ahead x seasonal factor; an unknown day has factor 1."""
    ahead = (F.year(date) - base_year).cast("double")
    joined = dates.withColumns({"month": F.month(date), "day": F.day(date)}).join(
        profile, [*keys, "month", "day"], "left")
    if keys:
        joined = joined.join(levels, keys)
    else:  # one series: its level is one row, read as a scalar
        joined = joined.withColumn("_l", levels.select(F.struct(*levels.columns)).scalar()).select("*", "_l.*").drop("_l")
    new = {}
    for v, norm in values.items():
        pred = F.col(f"base_{v}") * F.pow(F.col(f"growth_{v}"), ahead) * F.coalesce(norm, F.lit(1.0))
        new[f"{v}_pred"] = F.round(pred, digits) if digits is not None else pred
    return joined.withColumns(new).select(*dates.columns, *new)


def horizon(df: DataFrame, keys: list[str], date: str, first: Column, last: Column) -> DataFrame:
    """Every day from first to last for every series."""
    return df.select(*keys).distinct().select(*keys, F.explode(day_range(first, last)).alias(date))


# -- evaluation ---------------------------------------------------------------


def mape(actual: str, pred: str) -> Column:
    return F.avg(ratio(F.abs(F.col(actual) - F.col(pred)), actual)) * 100


def _numbered_days(days: DataFrame, keys: list[str], date: str) -> DataFrame:
    """Distinct days with their place in the series (``_i``, from 0) and the days of the series (``_total``)."""
    by_key = W.partitionBy(*keys)
    return days.withColumns({
        "_i": F.row_number().over(by_key.orderBy(date)) - 1, "_total": F.count(F.lit(1)).over(by_key)})


def expanding_folds(
    df: DataFrame, keys: list[str], date: str, n_splits: int = 5, val_days: int = 90, min_train_days: int = 365, gap_days: int = 0,
    holdout_days: int | None = None,
) -> DataFrame:
    """Rows tagged with (fold, role) of backward expanding windows.

    Fold 1 validates on the newest ``val_days`` distinct days, fold 2 on the
    ones before, and each trains on everything earlier.  Folds with a shorter
    training part are left out.  With ``holdout_days``, ``held`` marks the newest
    days of each training part.
    """
    days = df.select(*keys, date).distinct()
    ranked = _numbered_days(days, keys, date)
    fold = F.explode(F.array(*[F.lit(f) for f in range(1, n_splits + 1)]))
    val_start = F.col("_total") - F.col("fold") * val_days
    train_end = val_start - gap_days
    role = F.when(F.col("_i") < train_end, "train").when(
        (F.col("_i") >= val_start) & (F.col("_i") < val_start + val_days), "val")
    held = [] if holdout_days is None else [((F.col("_i") < train_end) & (F.col("_i") >= train_end - holdout_days)).alias("held")]
    tagged = (
        ranked.withColumn("fold", fold).where(train_end >= min_train_days)
        .withColumn("role", role).where(F.col("role").isNotNull()).select(*keys, date, "fold", "role", *held)
    )
    return df.join(tagged, [*keys, date])


def metrics(df: DataFrame, by: list[str], actual: str, pred: str) -> DataFrame:
    """MAE, RMSE and R2 per group."""
    err = F.col(actual) - F.col(pred)
    sst = F.var_pop(actual)
    mse = F.avg(err * err)
    return df.groupBy(*by).agg(
        F.avg(F.abs(err)).alias("mae"), F.sqrt(mse).alias("rmse"), (1 - F.try_divide(mse, sst)).alias("r2"))


def metric_summary(df: DataFrame, by: list[str]) -> DataFrame:
    """Mean and population deviation of the fold metrics."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_folds"),
        *[f(m).alias(f"{m}_{n}") for m in ("mae", "rmse", "r2") for n, f in (("mean", F.avg), ("std", F.stddev_pop))])


# -- trend: ridge on day index, its square and two yearly waves ---------------

TREND_TERMS = ["t", "t2", "s1", "c1", "s2", "c2"]
YEAR = 365
#: The day index enters in years, so that the system is well conditioned; its penalty is for the term in days.
TERM_UNITS = {"t": YEAR, "t2": YEAR**2, "s1": 1, "c1": 1, "s2": 1, "c2": 1}


def _trend_terms(index: Column) -> dict[str, Column]:
    t = index.cast("double") / YEAR
    wave = F.lit(2 * math.pi) * t
    return {"t": t, "t2": t * t, "s1": F.sin(wave), "c1": F.cos(wave), "s2": F.sin(2 * wave), "c2": F.cos(2 * wave)}


def _moments(target: str) -> dict[str, Column]:
    """Sums that are enough for the fit; sums of parts add up to the sums of the whole."""
    y = F.col(target).cast("double")
    sums = {"m_n": F.lit(1.0), "m_y": y}
    for i, a in enumerate(TREND_TERMS):
        sums |= {f"m_{a}": F.col(a), f"m_{a}_y": F.col(a) * y} | {f"m_{a}_{b}": F.col(a) * F.col(b) for b in TREND_TERMS[i:]}
    return {name: F.sum(v) for name, v in sums.items()}


def trend_moments(df: DataFrame, by: list[str], date: str, target: str) -> DataFrame:
    """The moments of known targets per group; rows carry the ``first_date`` of their series."""
    rows = df.where(F.col(target).isNotNull()).withColumns(_trend_terms(F.datediff(date, "first_date")))
    return rows.groupBy(*by, "first_date").agg(*[v.alias(n) for n, v in _moments(target).items()])


def ridge_steps(alpha: float) -> list[dict[str, str]]:
    """Column expressions, step by step, from moments to coefficients: an unrolled Cholesky solution.

    ``l_i_j`` is the factor of the centred system, ``z_i`` the forward and ``b_i``
    the back substitution, ``b_0`` the intercept, which is not penalised.
    """
    terms, k = TREND_TERMS, len(TREND_TERMS)

    def minus(pairs):
        return "".join(f" - {a} * {b}" for a, b in pairs)

    steps = []
    for j, a in enumerate(terms):
        penalty = f"{alpha / TERM_UNITS[a] ** 2:e}"
        pivot = f"m_{a}_{a} - m_{a} * m_{a} / m_n + {penalty}" + minus((f"l_{j}_{q}", f"l_{j}_{q}") for q in range(j))
        # A pivot is at least its penalty; rounding may not make it less.
        steps.append({f"l_{j}_{j}": f"sqrt(greatest({pivot}, {penalty}))"})
        steps.append({
            f"l_{i}_{j}": f"(m_{a}_{b} - m_{a} * m_{b} / m_n" + minus((f"l_{i}_{q}", f"l_{j}_{q}") for q in range(j)) + f") / l_{j}_{j}"
            for i, b in list(enumerate(terms))[j + 1:]})
    for i, a in enumerate(terms):
        steps.append({f"z_{i}": f"(m_{a}_y - m_{a} * m_y / m_n" + minus((f"l_{i}_{q}", f"z_{q}") for q in range(i)) + f") / l_{i}_{i}"})
    for i in reversed(range(k)):
        steps.append({f"b_{i + 1}": f"(z_{i}" + minus((f"l_{q}_{i}", f"b_{q + 1}") for q in range(i + 1, k)) + f") / l_{i}_{i}"})
    steps.append({"b_0": "m_y / m_n" + minus((f"b_{i + 1}", f"m_{a} / m_n") for i, a in enumerate(terms))})
    return [s for s in steps if s]


def solve_trend(moments: DataFrame, keys: list[str], alpha: float = 1.0) -> DataFrame:
    """(keys, first_date, coef, level): intercept and coefficients per key, and the size of its mean target."""
    out = moments
    for step in ridge_steps(alpha):
        out = out.withColumns({name: F.expr(e) for name, e in step.items()})
    coef = F.array(*[F.col(f"b_{i}") for i in range(len(TREND_TERMS) + 1)])
    return out.select(*keys, "first_date", coef.alias("coef"), F.abs(F.col("m_y") / F.col("m_n")).alias("level"))


def with_first_date(df: DataFrame, keys: list[str], date: str) -> DataFrame:
    return df.join(df.groupBy(*keys).agg(F.min(date).alias("first_date")), keys)


def fit_trend(df: DataFrame, keys: list[str], date: str, target: str, alpha: float = 1.0) -> DataFrame:
    """Ridge coefficients per key, from moments that are combined map-side; no series is gathered anywhere."""
    moments = trend_moments(with_first_date(df, keys, date), keys, date, target)
    return solve_trend(moments, keys, alpha).drop("level")


def fold_trends(
    df: DataFrame, keys: list[str], date: str, target: str, n_splits: int = 5, val_days: int = 90, min_train_days: int = 365,
    gap_days: int = 0, holdout_days: int = 0, alpha: float = 1.0,
) -> DataFrame:
    """(keys, fold, first_date, coef, level) of the training part of each of ``expanding_folds``, less its newest holdout days.

    One scan serves all folds: moments are summed per block of days, counted from
    the end, and a fold adds up the blocks from its end on.
    """
    width = math.gcd(val_days, gap_days, holdout_days)
    numbered = _numbered_days(df.select(*keys, date).distinct(), keys, date).withColumn(
        "_block", F.floor((F.col("_total") - 1 - F.col("_i")) / width).cast("int"))
    rows = with_first_date(df, keys, date).join(numbered, [*keys, date])
    blocks = trend_moments(rows, [*keys, "_total", "_block"], date, target)
    first = F.col("fold") * val_days + gap_days
    tagged = blocks.withColumn("fold", F.explode(F.array(*[F.lit(f) for f in range(1, n_splits + 1)]))).where(
        (F.col("_total") - first >= min_train_days) & (F.col("_block") * width >= first + holdout_days))
    sums = tagged.groupBy(*keys, "fold", "first_date").agg(*[F.sum(n).alias(n) for n in blocks.columns if n.startswith("m_")])
    return solve_trend(sums, [*keys, "fold"], alpha)


def predict_trend(df: DataFrame, coefs: DataFrame, keys: list[str], date: str, name: str = "trend") -> DataFrame:
    terms = _trend_terms(F.datediff(date, "first_date"))
    value = F.col("coef")[0]
    for i, c in enumerate(terms.values(), start=1):
        value = value + F.col("coef")[i] * c
    return df.join(coefs, keys).withColumn(name, value).drop("first_date", "coef")


def clip_residuals(df: DataFrame, keys: list[str], resid: str, lower: float = 0.01, upper: float = 0.99, where: Column | None = None) -> DataFrame:
    """Bound a residual by its own quantiles per series (one value per calendar day)."""
    source = F.when(where, F.col(resid)) if where is not None else F.col(resid)
    q = F.percentile(source, F.array(F.lit(lower), F.lit(upper))).over(W.partitionBy(*keys))
    return df.withColumn("_q", q).withColumn(f"{resid}_clipped", clip(resid, F.col("_q")[0], F.col("_q")[1])).drop("_q")


# -- boosted trees on what the trend leaves ----------------------------------


@dataclass
class HybridModel:
    """Trend per series plus shared trees on the scaled residual."""

    keys: list[str]
    date: str
    coefs: DataFrame
    levels: DataFrame
    trees: TreeModel

    def predict(self, df: DataFrame, name: str) -> DataFrame:
        base = predict_trend(df, self.coefs, self.keys, self.date).join(self.levels, self.keys)
        out = self.trees.predict(base, "_resid")
        return out.withColumn(name, F.col("trend") + F.col("_resid") * F.col("_level")).drop("_resid", "_level", "trend")


def fit_hybrid(
    df: DataFrame, keys: list[str], date: str, target: str, features: list[str], holdout_days: int = 30,
    alpha: float = 1.0, lower: float = 0.01, upper: float = 0.99, **tree_options,
) -> HybridModel:
    """Fit the trend, clip what it leaves, and boost trees on that.

    The newest ``holdout_days`` of each series are kept out of the trend, the
    quantiles and the trees, and tell the trees when to stop.
    """
    last = df.groupBy(*keys).agg(F.max(date).alias("_last"))
    rows = df.where(F.col(target).isNotNull()).join(last, keys).withColumn(
        "_hold", F.col(date) > F.date_sub("_last", holdout_days)).drop("_last")
    train = rows.where(~F.col("_hold"))
    coefs = materialize(fit_trend(train, keys, date, target, alpha), "trend")
    levels = materialize(train.groupBy(*keys).agg(F.abs(F.avg(target)).alias("_level")), "levels")
    resid = predict_trend(rows, coefs, keys, date).withColumn("_r", F.col(target) - F.col("trend"))
    resid = clip_residuals(resid, keys, "_r", lower, upper, where=~F.col("_hold")).join(levels, keys)
    label = ratio(F.when(F.col("_hold"), F.col("_r")).otherwise(F.col("_r_clipped")), "_level")
    trees = fit_trees(resid.withColumn("_y", label), features, "_y", is_eval=F.col("_hold"), **tree_options)
    return HybridModel(keys, date, coefs, levels, trees)


def fit_direct(df: DataFrame, keys: list[str], date: str, target: str, features: list[str], holdout_days: int = 30, log: bool = True, **tree_options) -> TreeModel:
    """Trees on log1p of the target, without a trend part."""
    last = df.groupBy(*keys).agg(F.max(date).alias("_last"))
    rows = df.join(last, keys).withColumns({
        "_y": F.log1p(target) if log else F.col(target), "_hold": F.col(date) > F.date_sub("_last", holdout_days)})
    return fit_trees(rows, features, "_y", is_eval=F.col("_hold"), **tree_options)


def cross_validate(
    df: DataFrame, keys: list[str], date: str, target: str, features: list[str], hybrid: bool, log: bool = False,
    bounds: tuple[float, float] | None = None, weight: str | None = None, holdout_days: int = 30, alpha: float = 1.0,
    lower: float = 0.01, upper: float = 0.99, folds: Mapping[str, int] | None = None, **tree_options,
) -> DataFrame:
    """Validation predictions of every fold, back on the original scale: keys, date, fold, actual, prediction.

    ``hybrid``: a trend per series and fold with trees on its clipped, scaled
    residual; else trees on the target, or its log1p.  The newest ``holdout_days``
    of each training part end the training of its trees, so a validation row has no
    say in any prediction.  Trends, residual bounds and levels of all series and folds
    come from relational jobs keyed by fold, and the trees of all folds grow in the
    same jobs and score in one pass.  Only the trees reach the driver.
    """
    folds = dict(folds or {})
    known = df.where(F.col(target).isNotNull()).select(*keys, date, target, *features, *([weight] if weight else []))
    tagged = materialize(expanding_folds(known, keys, date, holdout_days=holdout_days, **folds), "folds")
    fitted = (F.col("role") == "train") & ~F.col("held")
    if hybrid:
        trends = materialize(fold_trends(known.select(*keys, date, target), keys, date, target, holdout_days=holdout_days, alpha=alpha, **folds), "trends")
        rows = predict_trend(tagged, trends, [*keys, "fold"], date).withColumn("_r", F.col(target) - F.col("trend"))
        limits = rows.where(fitted).groupBy(*keys, "fold").agg(F.percentile("_r", F.array(F.lit(lower), F.lit(upper))).alias("_q"))
        rows = rows.join(limits, [*keys, "fold"])
        label = ratio(F.when(fitted, clip("_r", F.col("_q")[0], F.col("_q")[1])).otherwise(F.col("_r")), "level")
        rows = rows.withColumn("_y", label).drop("_r", "_q")
    else:
        rows = tagged.withColumn("_y", F.log1p(target) if log else as_col(target))
    ready = materialize(rows, "fold-rows")

    models = fit_trees_by(ready.where(F.col("role") == "train"), "fold", features, "_y", is_eval=F.col("held"), weight=weight, **tree_options)
    out = predict_by(ready.where(F.col("role") == "val"), "fold", models, "_p")
    pred = F.col("trend") + F.col("_p") * F.col("level") if hybrid else F.expm1("_p") if log else F.col("_p")
    return out.select(*keys, date, "fold", F.col(target).alias("actual"), (clip(pred, *bounds) if bounds else pred).alias("prediction"))


# -- from predictions to a submission -----------------------------------------


def postprocess(
    df: DataFrame, stats: DataFrame, keys: list[str], revenue: str = "revenue", ratio_col: str = "cogs_ratio",
    cap: float | None = None, p99_multiplier: float = 2.0,
) -> DataFrame:
    """Bound revenue at 0, an optional cap and a multiple of the train p99; bound the ratio; recompute cost."""
    joined = df.join(stats, keys) if keys else df.withColumn("revenue_p99", stats.select("revenue_p99").scalar())
    limit = F.col("revenue_p99") * p99_multiplier
    if cap is not None:
        limit = F.least(limit, F.lit(cap))
    return joined.withColumns({revenue: clip(revenue, 0.0, limit), ratio_col: clip(ratio_col, 0.0, 1.0)}).withColumn(
        "cogs", F.col(revenue) * F.col(ratio_col)).drop("revenue_p99")


def train_stats(df: DataFrame, keys: list[str], revenue: str = "revenue") -> DataFrame:
    """p99 and p05 of revenue and the mean ratio, per series of daily rows."""
    return df.groupBy(*keys).agg(
        F.percentile(revenue, F.lit(0.99)).alias("revenue_p99"), F.percentile(revenue, F.lit(0.05)).alias("revenue_p05"),
        F.avg(ratio("cogs", revenue)).alias("mean_cogs_ratio"))


def to_template(template: DataFrame, predictions: DataFrame, on: list[str], order: list[str]) -> DataFrame:
    """Predictions on a required key list, in its order."""
    return left_chain(template, [predictions], on).orderBy(*order)


def model_table(panel: DataFrame, promos: DataFrame, keys: list[str], date: str, until: Column) -> DataFrame:
    """The panel on a gap-free calendar up to ``until`` with all known-in-advance features."""
    grid = panel.groupBy(*keys).agg(F.min(date).alias("_lo")).select(
        *keys, F.explode(day_range(F.col("_lo"), until)).alias(date))
    wide = feature_table(grid.join(panel, [*keys, date], "left"), promos, keys, date)
    return wide.withColumn("cogs_ratio", ratio("cogs", "revenue"))


def submission(
    wide: DataFrame, keys: list[str], date: str, train_end: Column, features: list[str], cap: float | None = None, p99_multiplier: float = 2.0, **tree_options,
) -> DataFrame:
    """Hybrid forecast of revenue and cost ratio for all days after ``train_end``."""
    train, future = wide.where(F.col(date) <= train_end), wide.where(F.col(date) > train_end)
    revenue = fit_hybrid(train, keys, date, "revenue", features, **tree_options)
    share = fit_hybrid(train, keys, date, "cogs_ratio", features, **tree_options)
    inputs = future.select(*keys, date, *features)
    out = share.predict(revenue.predict(inputs, "revenue"), "cogs_ratio").select(*keys, date, "revenue", "cogs_ratio")
    done = postprocess(out, train_stats(train, keys).select(*keys, "revenue_p99"), keys, cap=cap, p99_multiplier=p99_multiplier)
    return to_template(future.select(*keys, date), done.select(*keys, date, "revenue", "cogs"), [*keys, date], [*keys, date])

