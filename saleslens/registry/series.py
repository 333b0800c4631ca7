"""Window functions and time-series features."""

from pyspark.sql import functions as F

from ..functions import day, exact_sum, ratio, round6
from ..operators import windows as Wn
from ..operators.relational import share_within
from ..plans import features as X
from ..plans.daily import inventory_snapshots
from ..plans.market import monthly_sales
from .base import query
from .joins import HOLIDAY_SQL, LUNAR_SQL
from .views_sql import dmean, dsum

SERIES = ["series_key"]


def r6(names):
    return {n: round6(n) for n in names}


# -- window functions ---------------------------------------------------------

@query("win_lag", """
SELECT order_id, customer_id, order_date, lag(order_date) OVER (PARTITION BY customer_id ORDER BY order_date, order_id) AS prev_date FROM orders_v""")
def _(t):
    return Wn.previous_day(t.orders.select("order_id", "customer_id", "order_date"), "customer_id", "order_date", "order_id", "prev_date")


@query("win_diff_days", """
SELECT customer_id, order_date, CAST(date_diff('day', lag(order_date) OVER (PARTITION BY customer_id ORDER BY order_date), order_date) AS INT) AS gap_days
FROM (SELECT DISTINCT customer_id, order_date FROM orders_v)""")
def _(t):
    return Wn.day_gaps(t.orders, "customer_id", "order_date")


YEARLY_PANEL = f"(SELECT series_key, CAST(year(date) AS INT) AS year, {dsum('revenue')} AS revenue FROM panel_v GROUP BY 1, 2)"


def yearly_panel(t):
    return t.panel.groupBy("series_key", F.year("date").alias("year")).agg(exact_sum("revenue").alias("revenue"))


@query("win_pct_change", f"""
SELECT series_key, year, revenue, revenue / lag(revenue) OVER (PARTITION BY series_key ORDER BY year) - 1 AS yoy FROM {YEARLY_PANEL}""")
def _(t):
    return Wn.change_from_previous(yearly_panel(t), SERIES, "year", "revenue", rate="yoy")


@query("win_pp_diff", f"""
WITH s AS (SELECT year, series_key, revenue / sum(CAST(revenue AS DECIMAL(28,4))) OVER (PARTITION BY year) * 100 AS pct FROM {YEARLY_PANEL})
SELECT series_key, year, round(pct, 6) AS pct, round(pct - lag(pct) OVER (PARTITION BY series_key ORDER BY year), 6) AS pct_change FROM s""")
def _(t):
    shares = share_within(yearly_panel(t).withColumn("_d", F.col("revenue").cast("decimal(28,4)")), "_d", ["year"], "share")
    pcts = shares.select("series_key", "year", (F.col("share") * 100).alias("pct"))
    return Wn.change_from_previous(pcts, SERIES, "year", "pct", diff="pct_change").withColumns(r6(["pct", "pct_change"]))


@query("win_row_number", """
SELECT order_id, customer_id, row_number() OVER (PARTITION BY customer_id ORDER BY order_date, order_id) AS order_rank FROM orders_v""")
def _(t):
    return Wn.event_rank(t.orders.select("order_id", "customer_id", "order_date"), "customer_id", "order_date", "order_id", "order_rank").drop("order_date")


WIDTHS, STATS = [7, 14, 30, 90], ["mean", "std", "min", "max"]
SQL_STATS = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}
ROLLING_SQL = ", ".join(
    f"{SQL_STATS[s]}(v) OVER (PARTITION BY series_key ORDER BY date ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW) AS roll{w}_{s}" for w in WIDTHS for s in STATS)
ROLL_NAMES = [f"roll{w}_{s}" for w in WIDTHS for s in STATS]
ROUND_ROLL = ", ".join(f"round({n}, 6) AS {n}" for n in ROLL_NAMES)


@query("win_rolling_row", f"""
SELECT series_key, date, {ROUND_ROLL} FROM (SELECT series_key, date, {ROLLING_SQL} FROM (SELECT series_key, date, ln(1 + revenue) AS v FROM panel_v))""")
def _(t):
    logs = t.panel.select("series_key", "date", F.log1p("revenue").alias("v"))
    return Wn.rolling(logs, SERIES, "date", "v", WIDTHS, STATS).drop("v").withColumns(r6(ROLL_NAMES))


@query("win_ffill", """
WITH s AS (SELECT snapshot_date AS date, category, avg(stockout_days) AS avg_stockout_days FROM inventory_v GROUP BY 1, 2),
d AS (SELECT category, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM s GROUP BY 1)
SELECT d.category, d.date, s.avg_stockout_days FROM d ASOF LEFT JOIN s ON d.category = s.category AND d.date >= s.date""")
def _(t):
    snaps = inventory_snapshots(t.inventory, ["category"]).select("category", "date", "avg_stockout_days")
    return Wn.forward_fill(X.on_calendar(snaps, ["category"], "date"), ["category"], "date", ["avg_stockout_days"])


@query("win_group_transform", f"""
SELECT series_key, date, revenue / (CAST(sum(CAST(revenue AS DECIMAL(18,4))) OVER (PARTITION BY series_key, year(date)) AS DOUBLE) / count(*) OVER (PARTITION BY series_key, year(date))) AS rev_norm FROM panel_v""")
def _(t):
    from ..plans.forecast import year_normalized

    return year_normalized(t.panel, SERIES, "date", {"revenue": "rev_norm"}).select("series_key", "date", "rev_norm")


@query("win_neighbor_median", f"""
WITH y AS (SELECT CAST(year(date) AS INT) AS year, {dsum('revenue')} AS revenue FROM sales_v GROUP BY 1),
n AS (SELECT a.year, quantile_cont(b.revenue, 0.5) AS m, count(*) AS n FROM y a JOIN y b ON abs(a.year - b.year) BETWEEN 1 AND 2 GROUP BY 1)
SELECT y.year, y.revenue, round(m, 4) AS neighbor_median, n AS n_neighbors, coalesce(n >= 2 AND m <> 0 AND abs((y.revenue - m) / m) > 0.25, false) AS is_anomalous
FROM y LEFT JOIN n ON y.year = n.year""")
def _(t):
    yearly = t.revenue_by_day.groupBy(F.year("date").alias("year")).agg(exact_sum("revenue").alias("revenue"))
    return Wn.neighbor_median(yearly, "year", "revenue").withColumn("neighbor_median", F.round("neighbor_median", 4))


@query("win_global_share", f"""
WITH m AS (SELECT CAST(date_trunc('month', date) AS DATE) AS month, {dsum('revenue')} AS monthly_revenue FROM sales_v GROUP BY 1)
SELECT month, monthly_revenue / (SELECT {dsum('monthly_revenue')} FROM m) AS share, monthly_revenue / (SELECT {dmean('monthly_revenue')} FROM m) AS revenue_index,
       monthly_revenue / (SELECT max(monthly_revenue) FROM m) AS of_max FROM m""")
def _(t):
    monthly = monthly_sales(t.stored("revenue_by_day"))
    tot = monthly.agg(F.struct(exact_sum("monthly_revenue").alias("s"), F.max("monthly_revenue").alias("m"))).scalar()
    return monthly.withColumn("_t", tot).select(
        "month", ratio("monthly_revenue", "_t.s").alias("share"), "revenue_index", ratio("monthly_revenue", "_t.m").alias("of_max"))


# -- features -----------------------------------------------------------------

@query("feat_calendar", """
SELECT series_key, date, CAST(isodow(date) - 1 AS INT) AS day_of_week, CAST(day(date) AS INT) AS day_of_month, CAST(dayofyear(date) AS INT) AS day_of_year,
       CAST(week(date) AS INT) AS week_of_year, CAST(month(date) AS INT) AS month, CAST(quarter(date) AS INT) AS quarter, CAST(year(date) AS INT) AS year,
       CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END AS is_weekend, CASE WHEN day(date) = 1 THEN 1 ELSE 0 END AS is_month_start,
       CASE WHEN date = last_day(date) THEN 1 ELSE 0 END AS is_month_end,
       CASE WHEN day(date) = 1 AND month(date) % 3 = 1 THEN 1 ELSE 0 END AS is_quarter_start,
       CASE WHEN date = last_day(date) AND month(date) % 3 = 0 THEN 1 ELSE 0 END AS is_quarter_end FROM panel_v""")
def _(t):
    return X.calendar_features(t.panel.select("series_key", "date"))


CYCLE_SQL = [("month(date)", 12, "month"), ("(isodow(date) - 1)", 7, "dow"), ("dayofyear(date)", 365, "doy"), ("week(date)", 52, "woy")]


@query("feat_cyclical", "SELECT series_key, date, " + ", ".join(
    f"round({f}(2 * pi() * {c} / {p}), 6) + 0.0 AS {f}_{n}" for c, p, n in CYCLE_SQL for f in ("sin", "cos")) + " FROM panel_v")
def _(t):
    names = [f"{f}_{n}" for _, _, n in X.CYCLES for f in ("sin", "cos")]
    return X.rounded(X.cyclical_features(X.calendar_features(t.panel)), ["series_key", "date"], names)


TREND_SQL = """
WITH b AS (SELECT series_key, min(date) AS lo, max(date) AS hi FROM panel_v GROUP BY 1)"""


@query("feat_trend", TREND_SQL + """
SELECT p.series_key, p.date, CAST(date_diff('day', lo, p.date) AS INT) AS trend_index, power(date_diff('day', lo, p.date), 2) / power(date_diff('day', lo, hi), 2) AS trend_index_sq
FROM panel_v p JOIN b ON p.series_key = b.series_key""")
def _(t):
    return X.trend_features(t.panel, "date", SERIES).select("series_key", "date", "trend_index", "trend_index_sq")


@query("feat_holidays", HOLIDAY_SQL + f""", tet AS (SELECT unnest({LUNAR_SQL}) AS h)
SELECT date, CASE WHEN (SELECT min(abs(date_diff('day', date, h))) FROM tet) <= 7 THEN 1 ELSE 0 END AS is_tet,
       CASE WHEN month(date) = 4 AND day(date) = 30 THEN 1 ELSE 0 END AS is_30_4, CASE WHEN month(date) = 5 AND day(date) = 1 THEN 1 ELSE 0 END AS is_1_5,
       CASE WHEN month(date) = 9 AND day(date) = 2 THEN 1 ELSE 0 END AS is_2_9, CASE WHEN month(date) = 12 AND day(date) = 25 THEN 1 ELSE 0 END AS is_christmas,
       CAST(coalesce((SELECT min(date_diff('day', date, h)) FROM marks WHERE h >= date), 999) AS INT) AS days_to_next_holiday,
       CAST(coalesce((SELECT min(date_diff('day', h, date)) FROM marks WHERE h < date), 999) AS INT) AS days_from_last_holiday FROM days""")
def _(t):
    return X.holiday_features(t.orders.select(F.col("order_date").alias("date")).distinct())


@query("feat_fourier", TREND_SQL + " SELECT p.series_key, p.date, " + ", ".join(
    f"round({f}(2 * pi() * {k} * date_diff('day', lo, p.date) / {p}), 6) + 0.0 AS {f}_{p}_{k}" for p in (7, 30, 365) for k in (1, 2, 3) for f in ("sin", "cos")
) + " FROM panel_v p JOIN b ON p.series_key = b.series_key")
def _(t):
    names = [f"{f}_{p}_{k}" for p in (7, 30, 365) for k in (1, 2, 3) for f in ("sin", "cos")]
    return X.rounded(X.fourier_features(X.day_index(t.panel, "date", SERIES), "trend_index"), ["series_key", "date"], names)


# Panel on a gap-free calendar, as SQL.
GRID_SQL = """
WITH g AS (SELECT series_key, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM panel_v GROUP BY 1),
p AS (SELECT g.series_key, g.date, revenue, ln(1 + revenue) AS lg FROM g LEFT JOIN panel_v v ON g.series_key = v.series_key AND g.date = v.date)"""
LAGS = [365, 366, 367]


def filled(names):
    med = ", ".join(f"quantile_cont({n}, 0.5) AS m_{n}" for n in names)
    out = ", ".join(f"round(coalesce({n}, m_{n}), 6) AS {n}" for n in names)
    return f""", m AS (SELECT series_key, {med} FROM j WHERE date <= DATE '1999-12-31' GROUP BY 1)
SELECT j.series_key, j.date, {out} FROM j JOIN m ON j.series_key = m.series_key"""


@query("feat_hist_lag", GRID_SQL + ", j AS (SELECT p.series_key, p.date, " + ", ".join(f"p{n}.lg AS lag_{n}" for n in LAGS) + " FROM p " + " ".join(
    f"LEFT JOIN p p{n} ON p.series_key = p{n}.series_key AND p.date = p{n}.date + INTERVAL {n} DAY" for n in LAGS) + ")" + filled([f"lag_{n}" for n in LAGS]))
def _(t):
    grid = X.on_calendar(t.stored("panel").select("series_key", "date", "revenue"), SERIES, "date")
    out = X.history_lags(grid, SERIES, "date", "revenue", LAGS, day("1999-12-31"))
    return X.rounded(out, ["series_key", "date"], [f"lag_{n}" for n in LAGS])


@query("feat_hist_rolling", GRID_SQL + f""", r AS (SELECT series_key, CAST(date + INTERVAL 365 DAY AS DATE) AS date, {ROLLING_SQL.replace('(v)', '(lg)')} FROM p),
j AS (SELECT p.series_key, p.date, {", ".join(ROLL_NAMES)} FROM p LEFT JOIN r ON p.series_key = r.series_key AND p.date = r.date)""" + filled(ROLL_NAMES))
def _(t):
    grid = X.on_calendar(t.stored("panel").select("series_key", "date", "revenue"), SERIES, "date")
    out = X.history_rolling(grid, SERIES, "date", "revenue", WIDTHS, STATS, 365, day("1999-12-31"))
    return X.rounded(out, ["series_key", "date"], ROLL_NAMES)


EXTENDED_SQL = """
WITH e AS (SELECT * FROM promotions_v UNION ALL SELECT promo_id, replace(promo_name, CAST(year(start_date) AS VARCHAR), CAST(year(start_date) + 2 AS VARCHAR)), promo_type, discount_value,
  CAST(start_date + INTERVAL 2 YEAR AS DATE), CAST(end_date + INTERVAL 2 YEAR AS DATE), stackable_flag FROM promotions_v WHERE year(start_date) IN (1999, 2000))"""


@query("feat_promo_cycle", EXTENDED_SQL + "SELECT * FROM e")
def _(t):
    return X.extend_promotions(t.promotions, [1999, 2000])


@query("feat_promo_intensity", EXTENDED_SQL + """,
d AS (SELECT CAST(unnest(generate_series(min(order_date), CAST(max(order_date) + INTERVAL 365 DAY AS DATE), INTERVAL 1 DAY)) AS DATE) AS date FROM orders_v),
a AS (SELECT d.date, CAST(count(e.promo_id) AS INT) AS n_active_promos, coalesce(max(CASE WHEN promo_type = 'percentage' THEN discount_value END), 0.0) AS max_discount_pct,
      coalesce(max(stackable_flag), 0) AS has_stackable_promo FROM d LEFT JOIN e ON d.date BETWEEN e.start_date AND e.end_date GROUP BY 1)
SELECT *, n_active_promos * max_discount_pct AS pis_score FROM a""")
def _(t):
    ends = t.orders.agg(F.min("order_date").alias("lo"), F.date_add(F.max("order_date"), 365).alias("hi"))
    days = ends.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date"))
    return X.promotion_intensity(days, X.extend_promotions(t.stored("promotions"), [1999, 2000]))


@query("feat_promo_anticipation", """
WITH d AS (SELECT DISTINCT series_key, date FROM panel_v)
SELECT d.series_key, d.date, CAST(coalesce(min(date_diff('day', d.date, p.start_date)), 999) AS INT) AS days_to_next_major_promo,
       coalesce(arg_min(p.discount_value, (date_diff('day', d.date, p.start_date), p.promo_id)), 0.0) AS expected_discount_depth,
       CASE WHEN count(p.promo_id) > 0 THEN 1 ELSE 0 END AS is_within_promo_window
FROM d LEFT JOIN promotions_v p ON p.promo_type = 'percentage' AND p.discount_value >= 20 AND p.start_date > d.date AND date_diff('day', d.date, p.start_date) <= 14
GROUP BY 1, 2""")
def _(t):
    return X.nearest_major_promo(t.panel.select("series_key", "date"), t.promotions)


@query("feat_inventory_stress", f"""
WITH s AS (SELECT date, CAST(sum(sessions) AS DOUBLE) AS sessions FROM web_traffic_v GROUP BY 1),
f AS (SELECT snapshot_date, {dmean('fill_rate')} - 0.84 AS fill_rate FROM inventory_v GROUP BY 1),
d AS (SELECT date FROM sales_v),
j AS (SELECT d.date, sessions, fill_rate, ln(1 + CASE WHEN sessions IS NOT NULL THEN greatest(sessions, 1.0) END) - ln(CASE WHEN fill_rate IS NOT NULL THEN least(greatest(fill_rate, 0.01), 1.0) END) AS x,
      CASE WHEN fill_rate < 0.01 THEN 1 ELSE 0 END AS is_stockout_stress
      FROM d LEFT JOIN s ON d.date = s.date LEFT JOIN f ON last_day(d.date) = f.snapshot_date)
SELECT date, round(coalesce(x, (SELECT quantile_cont(x, 0.5) FROM j WHERE date <= DATE '2000-01-20')), 6) AS inventory_stress_index, is_stockout_stress,
       coalesce(sessions, 0.0) AS sessions, round(coalesce(fill_rate, 0.0), 6) AS fill_rate FROM j""")
def _(t):
    # The fill rate is lowered by a constant so that some months fall under the floor.
    sessions = t.web_traffic.groupBy("date").agg(F.sum("sessions").cast("double").alias("sessions"))
    fill = inventory_snapshots(t.inventory).select(F.col("date").alias("_month"), (F.col("avg_fill_rate") - 0.84).alias("fill_rate"))
    days = t.revenue_by_day.select("date")
    joined = days.join(sessions, "date", "left").withColumn("_month", F.last_day("date")).join(fill, "_month", "left").drop("_month")
    out = X.inventory_stress(joined, "date", "sessions", "fill_rate", day("2000-01-20"))
    return out.withColumns(r6(["inventory_stress_index", "fill_rate"])).select(
        "date", "inventory_stress_index", "is_stockout_stress", "sessions", "fill_rate")


@query("feat_traffic_lag", """
SELECT traffic_source, date, sessions, lag(sessions) OVER (PARTITION BY traffic_source ORDER BY date) AS sessions_lag1 FROM web_traffic_v""")
def _(t):
    return X.lag_one(t.web_traffic.select("traffic_source", "date", "sessions"), ["traffic_source"], "date", "sessions", "sessions_lag1")


@query("feat_inventory_lag", f"""
WITH s AS (SELECT category, snapshot_date AS date, {dmean('fill_rate')} AS avg_fill_rate FROM inventory_v GROUP BY 1, 2)
SELECT *, lag(avg_fill_rate) OVER (PARTITION BY category ORDER BY date) AS avg_fill_rate_lag1m FROM s""")
def _(t):
    snaps = inventory_snapshots(t.inventory, ["category"]).select("category", "date", "avg_fill_rate")
    return X.lag_one(snaps, ["category"], "date", "avg_fill_rate", "avg_fill_rate_lag1m")


@query("feat_sample_weight", """
SELECT series_key, date, CASE WHEN date BETWEEN DATE '1998-04-06' AND DATE '1999-12-31' THEN 1 ELSE 0 END AS is_special_period,
       CASE WHEN date BETWEEN DATE '1998-04-06' AND DATE '1999-12-31' THEN CAST(0.1 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END AS sample_weight FROM panel_v""")
def _(t):
    return X.period_weight(t.panel.select("series_key", "date"), "date", day("1998-04-06"), day("1999-12-31"), 0.1)
