"""Forecasting on the category panel."""

from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from ..functions import day, ratio, round6
from ..plans import forecast as Fc
from ..plans.boosting import hashed_sample
from ..plans.features import known_features, period_weight
from ..sources.files import materialize
from .base import query
from .views_sql import dsum

KEYS = ["series_key"]
VALUES = {"revenue": "rev_norm", "cogs": "cogs_norm"}
# The round limit is far off: the holdout days end the training, after 50 rounds without gain.
TREES = {"rounds": 1000, "depth": 6, "patience": 50}
SPECIAL_FIRST, SPECIAL_LAST, SPECIAL_WEIGHT = "1998-04-06", "1999-12-31", 0.1


def norm_sql(v):
    return f"{v} / (CAST(sum(CAST({v} AS DECIMAL(18,4))) OVER w AS DOUBLE) / count({v}) OVER w)"


PROFILE_SQL = f"""
n AS (SELECT series_key, date, {norm_sql('revenue')} AS rev_norm, {norm_sql('cogs')} AS cogs_norm FROM panel_v WINDOW w AS (PARTITION BY series_key, year(date))),
prof AS (SELECT series_key, CAST(month(date) AS INT) AS month, CAST(day(date) AS INT) AS day, avg(rev_norm) AS rev_norm, avg(cogs_norm) AS cogs_norm FROM n GROUP BY 1, 2, 3)"""

LEVEL_SQL = f"""
yv AS (SELECT series_key, year(date) AS y, {dsum('revenue')} AS revenue, {dsum('cogs')} AS cogs FROM panel_v WHERE year(date) BETWEEN 1995 AND 2000 GROUP BY 1, 2),
yl AS (SELECT *, revenue / lag(revenue) OVER (PARTITION BY series_key ORDER BY y) AS sr, cogs / lag(cogs) OVER (PARTITION BY series_key ORDER BY y) AS sc FROM yv),
lv AS (SELECT series_key, max(revenue) FILTER (WHERE y = 2000) / 366 AS br, max(cogs) FILTER (WHERE y = 2000) / 366 AS bc, exp(avg(ln(sr))) AS gr, exp(avg(ln(sc))) AS gc FROM yl GROUP BY 1)"""


def pred_sql(source, digits=None):
    def one(b, g, n):
        e = f"{b} * power({g}, year(d.date) - 2000) * coalesce({n}, 1)"
        return f"round({e}, {digits})" if digits is not None else e

    return f"""SELECT d.*, {one('br', 'gr', 'rev_norm')} AS revenue_pred, {one('bc', 'gc', 'cogs_norm')} AS cogs_pred
FROM {source} d LEFT JOIN prof p ON d.series_key = p.series_key AND month(d.date) = p.month AND day(d.date) = p.day JOIN lv ON d.series_key = lv.series_key"""


FUTURE_SQL = """
fut AS (SELECT series_key, CAST(unnest(generate_series(DATE '2001-01-01', DATE '2002-07-01', INTERVAL 1 DAY)) AS DATE) AS date FROM (SELECT DISTINCT series_key FROM panel_v))"""


def level(t):
    return Fc.level_and_growth(t.stored("panel"), KEYS, "date", ["revenue", "cogs"], 1995, 2000)


def profile(t):
    return Fc.seasonal_profile(t.stored("panel"), KEYS, "date", VALUES)


def naive(t, dates, digits=2):
    return Fc.seasonal_naive(dates, profile(t), level(t), KEYS, "date", VALUES, 2000, digits)


def future(t):
    return Fc.horizon(t.stored("panel"), KEYS, "date", day("2001-01-01"), day("2002-07-01"))


@query("fc_seasonal_profile", f"WITH {PROFILE_SQL} SELECT series_key, month, day, round(rev_norm, 6) AS rev_norm, round(cogs_norm, 6) AS cogs_norm FROM prof")
def _(t):
    return profile(t).withColumns({n: round6(n) for n in VALUES.values()})


@query("fc_seasonal_naive", f"WITH {PROFILE_SQL}, {LEVEL_SQL}, {FUTURE_SQL} {pred_sql('fut', 2)}")
def _(t):
    return naive(t, future(t))


@query("fc_mape", f"""WITH {PROFILE_SQL}, {LEVEL_SQL}, h AS (SELECT series_key, date, revenue, cogs FROM panel_v WHERE year(date) IN (1999, 2000)), p2 AS ({pred_sql('h')})
SELECT series_key, round(avg(abs(revenue - revenue_pred) / nullif(revenue, 0)) * 100, 6) AS mape_revenue, round(avg(abs(cogs - cogs_pred) / nullif(cogs, 0)) * 100, 6) AS mape_cogs FROM p2 GROUP BY 1""")
def _(t):
    history = t.stored("panel").where(F.year("date").isin(1999, 2000))
    return naive(t, history, digits=None).groupBy("series_key").agg(
        round6(Fc.mape("revenue", "revenue_pred")).alias("mape_revenue"), round6(Fc.mape("cogs", "cogs_pred")).alias("mape_cogs"))


FOLDS_SQL = """
fi AS (SELECT series_key, date, dense_rank() OVER (PARTITION BY series_key ORDER BY date) - 1 AS i, count(*) OVER (PARTITION BY series_key) AS n FROM panel_v),
fo AS (SELECT series_key, date, CAST(f AS INT) AS fold, CASE WHEN i < n - f * 90 THEN 'train' WHEN i < n - f * 90 + 90 THEN 'val' END AS role FROM fi, range(1, 6) r(f) WHERE n - f * 90 >= 365)"""


@query("fc_expanding_folds", f"WITH {FOLDS_SQL} SELECT * FROM fo WHERE role IS NOT NULL")
def _(t):
    return Fc.expanding_folds(t.stored("panel").select("series_key", "date"), KEYS, "date")


def lagged_folds(t):
    """Validation rows with the value 364 days before, which is always a training day."""
    past = t.stored("panel").select("series_key", F.date_add("date", 364).alias("date"), F.col("revenue").alias("pred"))
    folds = Fc.expanding_folds(t.stored("panel").select("series_key", "date", "revenue"), KEYS, "date")
    return folds.where(F.col("role") == "val").join(past, ["series_key", "date"])


@query("fc_metrics", f"""WITH {FOLDS_SQL},
v AS (SELECT fo.series_key, fold, a.revenue AS y, b.revenue AS p FROM fo JOIN panel_v a ON fo.series_key = a.series_key AND fo.date = a.date JOIN panel_v b ON fo.series_key = b.series_key AND fo.date = b.date + INTERVAL 364 DAY WHERE role = 'val'),
m AS (SELECT series_key, fold, avg(abs(y - p)) AS mae, sqrt(avg((y - p) * (y - p))) AS rmse, 1 - avg((y - p) * (y - p)) / var_pop(y) AS r2 FROM v GROUP BY 1, 2)
SELECT series_key, count(*) AS n_folds, {', '.join(f'round({f}({m}), 3) AS {m}_{n}' for m in ('mae', 'rmse', 'r2') for n, f in (('mean', 'avg'), ('std', 'stddev_pop')))} FROM m GROUP BY 1""")
def _(t):
    per_fold = Fc.metrics(lagged_folds(t), ["series_key", "fold"], "revenue", "pred")
    out = Fc.metric_summary(per_fold, ["series_key"])
    return out.withColumns({c: F.round(c, 3) for c in out.columns if c not in ("series_key", "n_folds")})


@query("fc_residual_clip", f"""WITH {PROFILE_SQL}, {LEVEL_SQL}, h AS (SELECT series_key, date, revenue FROM panel_v WHERE date <= DATE '2000-12-31'), p2 AS ({pred_sql('h', 2)}),
r AS (SELECT series_key, date, revenue - revenue_pred AS resid FROM p2), q AS (SELECT series_key, quantile_cont(resid, 0.01) AS lo, quantile_cont(resid, 0.99) AS hi FROM r GROUP BY 1)
SELECT r.series_key, date, round(resid, 4) AS resid, round(least(greatest(resid, lo), hi), 4) AS resid_clipped FROM r JOIN q ON r.series_key = q.series_key""")
def _(t):
    history = t.stored("panel").where(F.col("date") <= day("2000-12-31")).select("series_key", "date", "revenue")
    resid = naive(t, history).select("series_key", "date", (F.col("revenue") - F.col("revenue_pred")).alias("resid"))
    return Fc.clip_residuals(resid, KEYS, "resid").withColumns({c: F.round(c, 4) for c in ("resid", "resid_clipped")})


@query("fc_postprocess", f"""WITH {PROFILE_SQL}, {LEVEL_SQL}, {FUTURE_SQL}, p2 AS ({pred_sql('fut', 2)}),
s AS (SELECT series_key, quantile_cont(revenue, 0.99) AS p99 FROM panel_v GROUP BY 1),
b AS (SELECT p2.series_key, date, least(greatest(revenue_pred * ((day(date) - 5) / 4), 0.0), p99 * CAST(2.0 AS DOUBLE)) AS revenue, least(greatest(cogs_pred / nullif(revenue_pred, 0) * (month(date) - 2) * 10, 0.0), 1.0) AS cogs_ratio FROM p2 JOIN s ON p2.series_key = s.series_key)
SELECT series_key, date, round(revenue, 6) AS revenue, round(cogs_ratio, 6) AS cogs_ratio, round(revenue * cogs_ratio, 4) AS cogs FROM b""")
def _(t):
    # Forecasts stretched by the day and month, so that rows lie on both sides of every bound at every size.
    preds = naive(t, future(t)).select(
        "series_key", "date", (F.col("revenue_pred") * ((F.day("date") - 5) / 4)).alias("revenue"),
        (ratio("cogs_pred", "revenue_pred") * (F.month("date") - 2) * 10).alias("cogs_ratio"))
    out = Fc.postprocess(preds, Fc.train_stats(t.stored("panel"), KEYS).select("series_key", "revenue_p99"), KEYS)
    return out.withColumns({"revenue": round6("revenue"), "cogs_ratio": round6("cogs_ratio"), "cogs": F.round("cogs", 4)})


# -- fitted models: the trend has SQL, models with trees are checked by the tests ------

TRAIN_END = "2000-12-31"


def features_of(t, wide):
    return known_features(wide, t.stored("promotions"), KEYS)


def model_rows(t):
    wide = Fc.model_table(t.stored("panel"), t.stored("promotions"), KEYS, "date", day("2001-08-01"))
    return materialize(wide, "model-table")


def trend_sql(target, alpha=1.0):
    """The moments of the training days and, step by step, the coefficients: the last step has b_0 to b_6."""
    unit = "t.date - t.first_date"
    terms = {"t": f"({unit}) / 365e0", "t2": f"(({unit}) / 365e0) * (({unit}) / 365e0)"}
    for n, (f, k) in {"s1": ("sin", 1), "c1": ("cos", 1), "s2": ("sin", 2), "c2": ("cos", 2)}.items():
        terms[n] = f"{f}({k} * (2 * pi() * (({unit}) / 365e0)))"
    names = list(terms)
    sums = ["sum(1e0) AS m_n", "sum(y) AS m_y"]
    for i, a in enumerate(names):
        sums += [f"sum({a}) AS m_{a}", f"sum({a} * y) AS m_{a}_y"] + [f"sum({a} * {b}) AS m_{a}_{b}" for b in names[i:]]
    steps = [", ".join(f"{e} AS {n}" for n, e in step.items()) for step in Fc.ridge_steps(alpha)]
    chain = ",\n".join(f"r{i + 1} AS (SELECT *, {step} FROM r{i})" for i, step in enumerate(steps))
    return f"""
started AS (SELECT series_key, date, revenue, cogs, min(date) FILTER (date <= DATE '{TRAIN_END}') OVER (PARTITION BY series_key) AS first_date FROM panel_v),
terms AS (SELECT series_key, date, {target} AS target, CAST({target} AS DOUBLE) AS y, {', '.join(f'{e} AS {n}' for n, e in terms.items())} FROM started t),
r0 AS (SELECT series_key, {', '.join(sums)} FROM terms WHERE date <= DATE '{TRAIN_END}' AND y IS NOT NULL GROUP BY series_key),
{chain},
trended AS (
  SELECT terms.*, b_0 + {' + '.join(f'b_{i + 1} * {n}' for i, n in enumerate(names))} AS trend
  FROM terms JOIN r{len(steps)} USING (series_key))"""


@query("fc_trend_ridge", f"WITH {trend_sql('revenue')}\nSELECT series_key, date, target AS revenue, round(trend, 1) AS trend FROM trended")
def _(t):
    coefs = Fc.fit_trend(t.stored("panel").where(F.col("date") <= day(TRAIN_END)), KEYS, "date", "revenue")
    out = Fc.predict_trend(t.stored("panel").select("series_key", "date", "revenue"), coefs, KEYS, "date")
    return out.withColumn("trend", F.round("trend", 1))


@query("fc_residual_gbt")
def _(t):
    wide = model_rows(t)
    train = wide.where((F.col("date") <= day(TRAIN_END)) & F.col("revenue").isNotNull())
    model = Fc.fit_hybrid(train, KEYS, "date", "revenue", features_of(t, wide), **TREES)
    rows = Fc.predict_trend(wide.where(F.col("revenue").isNotNull()), model.coefs, KEYS, "date").join(model.levels, KEYS)
    out = model.trees.predict(rows, "_r")
    return out.select("series_key", "date", (F.col("revenue") - F.col("trend")).alias("resid"), (F.col("_r") * F.col("_level")).alias("resid_pred"))


@query("fc_hybrid_predict")
def _(t):
    wide = model_rows(t)
    features = features_of(t, wide)
    model = Fc.fit_hybrid(wide.where(F.col("date") <= day(TRAIN_END)), KEYS, "date", "revenue", features, **TREES)
    return model.predict(wide.where(F.col("date") > day(TRAIN_END)), "prediction").select("series_key", "date", "revenue", "prediction")


@query("fc_direct_gbt")
def _(t):
    wide = model_rows(t)
    features = features_of(t, wide)
    model = Fc.fit_direct(wide.where(F.col("date") <= day(TRAIN_END)), KEYS, "date", "revenue", features, **TREES)
    out = model.predict(wide.where(F.col("date") > day(TRAIN_END)), "_log")
    return out.select("series_key", "date", "revenue", F.expm1("_log").alias("prediction"))


@query("fc_cv")
def _(t):
    """Metrics over the folds for revenue and cost ratio, each by direct trees and by the hybrid, weighted."""
    wide = model_rows(t)
    features = features_of(t, wide)
    weighted = period_weight(wide, "date", day(SPECIAL_FIRST), day(SPECIAL_LAST), SPECIAL_WEIGHT)

    def validated(case):
        (target, log, bounds), hybrid = case
        preds = Fc.cross_validate(weighted, KEYS, "date", target, features, hybrid, log, bounds, weight="sample_weight", **TREES)
        return Fc.metrics(preds, ["fold"], "actual", "prediction").withColumns({
            "target": F.lit(target), "model": F.lit("hybrid" if hybrid else "direct")})

    cases = list(product((("revenue", True, None), ("cogs_ratio", False, (0.0, 1.0))), (False, True)))
    with ThreadPoolExecutor(len(cases)) as pool:
        parts = list(pool.map(inheritable_thread_target(t.spark)(validated), cases))
    return Fc.metric_summary(reduce(DataFrame.unionByName, parts), ["target", "model"])


@query("fc_importance")
def _(t):
    """The ten features with the largest mean absolute contribution over 500 training rows."""
    wide = model_rows(t)
    features = features_of(t, wide)
    train = wide.where((F.col("date") <= day(TRAIN_END)) & F.col("revenue").isNotNull())
    model = Fc.fit_direct(train, KEYS, "date", "revenue", features, **TREES)
    return model.importance(hashed_sample(train, 500, [*KEYS, "date"]), 10)


@query("fc_submission")
def _(t):
    wide = model_rows(t)
    return Fc.submission(wide, KEYS, "date", day(TRAIN_END), features_of(t, wide), **TREES)
