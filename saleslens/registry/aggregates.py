"""Aggregations."""

from pyspark.sql import functions as F

from ..functions import exact_mean, exact_sum, geometric_growth, rate_where, ratio, round6
from ..operators.distinct import daily_bitmaps, distinct_counts
from ..operators import relational as R
from ..operators.order_stats import exact_quantiles
from ..operators.windows import lag_value
from ..plans import daily as D
from ..plans.customers import cohort_retention, retention_matrix
from .base import query
from .views_sql import dmean, dsum


@query("agg_items_per_order", f"""
SELECT order_id, CAST(sum(quantity) AS BIGINT) AS n_items, {dsum('unit_price * quantity - discount_amount')} AS gross_revenue,
       {dsum('discount_amount')} AS total_discount, count(DISTINCT product_id) AS n_unique_products FROM items_v GROUP BY 1""")
def _(t):
    return D.items_per_order(t.items)


@query("agg_orders_daily", f"""
WITH p AS (SELECT order_id, sum(quantity) AS n_items, {dsum('unit_price * quantity - discount_amount')} AS r,
           {dsum('discount_amount')} AS d, count(DISTINCT product_id) AS u FROM items_v GROUP BY 1)
SELECT order_date AS date, count(*) AS n_orders, CAST(coalesce(sum(n_items), 0) AS BIGINT) AS n_items_sold, coalesce({dsum('r')}, 0) AS gross_revenue,
       coalesce({dsum('d')}, 0) AS total_discount, count(DISTINCT customer_id) AS n_unique_customers, CAST(coalesce(sum(u), 0) AS BIGINT) AS n_unique_products,
       CAST(count(*) FILTER (WHERE order_status = 'cancelled') AS DOUBLE) / count(*) AS cancelled_rate, coalesce({dsum('r')}, 0) / count(*) AS avg_order_value
FROM orders_v LEFT JOIN p USING (order_id) GROUP BY 1""")
def _(t):
    return D.orders_daily(t.orders, t.items)


@query("agg_returns_daily", f"""
SELECT return_date AS date, CAST(sum(return_quantity) AS BIGINT) AS n_returns, {dsum('refund_amount')} AS total_refund FROM returns_v GROUP BY 1""")
def _(t):
    return D.returns_daily(t.returns)


@query("agg_reviews_daily", "SELECT review_date AS date, avg(rating) AS avg_rating, count(rating) AS n_reviews FROM reviews_v GROUP BY 1")
def _(t):
    return D.reviews_daily(t.reviews)


@query("agg_shipment_daily", """
SELECT ship_date AS date, avg(date_diff('day', ship_date, delivery_date)) AS avg_delivery_days FROM shipments_v GROUP BY 1""")
def _(t):
    return D.shipment_daily(t.shipments)


@query("agg_traffic_daily", """
SELECT date, CAST(sum(sessions) AS BIGINT) AS sessions, CAST(sum(unique_visitors) AS BIGINT) AS unique_visitors, CAST(sum(page_views) AS BIGINT) AS page_views,
       round(avg(bounce_rate), 6) AS bounce_rate, round(avg(avg_session_duration_sec), 6) AS avg_session_duration_sec FROM web_traffic_v GROUP BY 1""")
def _(t):
    return D.traffic_daily(t.web_traffic).withColumns({c: round6(c) for c in ("bounce_rate", "avg_session_duration_sec")})


@query("agg_inventory_snapshot", f"""
SELECT snapshot_date AS date, {dmean('fill_rate')} AS avg_fill_rate, avg(stockout_days) AS avg_stockout_days, avg(stockout_flag) AS pct_stockout_skus,
       round(avg(sell_through_rate), 6) AS avg_sell_through FROM inventory_v GROUP BY 1""")
def _(t):
    return D.inventory_snapshots(t.inventory).withColumn("avg_sell_through", round6("avg_sell_through"))


@query("agg_distinct_count", """
SELECT CAST(year(order_date) AS INT) AS year, count(DISTINCT customer_id) AS n_customers, count(DISTINCT o.order_id) AS n_orders, count(DISTINCT product_id) AS n_products
FROM orders_v o JOIN items_v i ON o.order_id = i.order_id GROUP BY 1""")
def _(t):
    # One scan; the query has no grain below the year, so its bitmaps are those of years.
    ids = {"n_customers": "customer_id", "n_orders": "order_id", "n_products": "product_id"}
    lines = t.lines.withColumn("year_start", F.trunc("order_date", "year"))
    return distinct_counts(daily_bitmaps(lines, "year_start", ids), list(ids), {"year": F.year("date")})


@query("agg_conditional", """
SELECT order_source, count(*) AS n, CAST(count(*) FILTER (WHERE order_status = 'cancelled') AS DOUBLE) / count(*) AS cancelled_share,
       count(*) FILTER (WHERE device_type = 'mobile') AS n_mobile FROM orders_v GROUP BY 1""")
def _(t):
    return t.orders.groupBy("order_source").agg(
        F.count(F.lit(1)).alias("n"), rate_where(F.col("order_status") == "cancelled").alias("cancelled_share"),
        F.count_if(F.col("device_type") == "mobile").alias("n_mobile"))


@query("agg_ratio_of_sums", f"""
SELECT p.category, {dsum('discount_amount')} / nullif({dsum('unit_price * quantity')}, 0) AS discount_rate FROM items_v i JOIN products_v p ON i.product_id = p.product_id GROUP BY 1""")
def _(t):
    lines = t.items.join(t.products.select("product_id", "category"), "product_id")
    return lines.groupBy("category").agg(
        ratio(exact_sum("discount_amount"), exact_sum(F.col("unit_price") * F.col("quantity"))).alias("discount_rate"))


@query("agg_quantile", """
SELECT order_status, round(quantile_cont(payment_value, 0.01), 6) AS p01, round(quantile_cont(payment_value, 0.05), 6) AS p05, round(quantile_cont(payment_value, 0.5), 6) AS median,
       round(quantile_cont(payment_value, 0.97), 6) AS p97, round(quantile_cont(payment_value, 0.99), 6) AS p99
FROM orders_v o JOIN payments_v p ON o.order_id = p.order_id GROUP BY 1""")
def _(t):
    paid = t.orders.select("order_id", "order_status").join(t.payments, "order_id")
    probs = {"p01": 0.01, "p05": 0.05, "median": 0.5, "p97": 0.97, "p99": 0.99}
    out = exact_quantiles(paid, ["order_status"], "payment_value", probs)
    return out.withColumns({c: round6(c) for c in probs})


@query("agg_descriptive", f"""
SELECT CAST(year(date) AS INT) AS year, {dmean('revenue')} AS mean_revenue, round(stddev_samp(revenue), 4) AS std_revenue, max(revenue) AS max_revenue FROM sales_v GROUP BY 1""")
def _(t):
    return t.sales.groupBy(F.year("date").alias("year")).agg(
        exact_mean("revenue").alias("mean_revenue"), F.round(F.stddev_samp("revenue"), 4).alias("std_revenue"), F.max("revenue").alias("max_revenue"))


@query("agg_mode", """
WITH c AS (SELECT promo_id, category, count(*) AS n FROM items_v i JOIN products_v p ON i.product_id = p.product_id WHERE promo_id IS NOT NULL GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY promo_id ORDER BY n DESC, category) AS rn FROM c)
SELECT promo_id, category AS main_category FROM r WHERE rn = 1""")
def _(t):
    lines = t.lines.where(F.col("promo_id").isNotNull()).join(t.products.select("product_id", "category"), "product_id")
    return R.mode_per_key(lines, "promo_id", "category", "main_category")


@query("agg_geometric_growth", f"""
WITH y AS (SELECT year(date) AS year, series_key, {dsum('revenue')} AS revenue FROM panel_v WHERE year(date) BETWEEN 1995 AND 2000 GROUP BY 1, 2),
g AS (SELECT series_key, revenue / lag(revenue) OVER (PARTITION BY series_key ORDER BY year) AS step FROM y)
SELECT series_key, round(exp(avg(ln(step))), 6) AS growth FROM g WHERE step IS NOT NULL GROUP BY 1""")
def _(t):
    yearly = t.panel.where(F.year("date").between(1995, 2000)).groupBy("series_key", F.year("date").alias("year")).agg(exact_sum("revenue").alias("revenue"))
    steps = lag_value(yearly, ["series_key"], "year", "revenue", "prev").withColumn("step", ratio("revenue", "prev"))
    return steps.where(F.col("step").isNotNull()).groupBy("series_key").agg(round6(geometric_growth("step")).alias("growth"))


@query("agg_linear_fit", """
WITH x AS (SELECT category, price, (price - cogs) / price AS margin FROM products_v),
f AS (SELECT category, count(*) AS n, regr_slope(cogs, price) AS slope, regr_intercept(cogs, price) AS intercept FROM products_v GROUP BY 1)
SELECT category, n, round(slope, 6) AS slope, round(intercept, 4) AS intercept FROM f WHERE n >= 4""")
def _(t):
    fits = t.products.groupBy("category").agg(
        F.count(F.lit(1)).alias("n"), F.regr_slope("cogs", "price").alias("slope"), F.regr_intercept("cogs", "price").alias("intercept"))
    return fits.where(F.col("n") >= 4).select("category", "n", round6("slope").alias("slope"), F.round("intercept", 4).alias("intercept"))


@query("agg_first_value", """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY product_id, quantity, promo_id) AS rn FROM items_v WHERE promo_id IS NOT NULL)
SELECT o.order_id, r.promo_id AS first_promo_id, bool_or(i.promo_id IS NOT NULL) AS has_promo
FROM items_v i JOIN (SELECT DISTINCT order_id FROM items_v) o ON i.order_id = o.order_id LEFT JOIN r ON r.order_id = o.order_id AND rn = 1 GROUP BY 1, 2""")
def _(t):
    seen = F.when(F.col("promo_id").isNotNull(), F.struct("product_id", "quantity", "promo_id"))
    return t.lines.groupBy("order_id").agg(
        F.min(seen).alias("_f"), F.bool_or(F.col("promo_id").isNotNull()).alias("has_promo"),
    ).select("order_id", F.col("_f.promo_id").alias("first_promo_id"), "has_promo")


@query("agg_boolean_any", """
SELECT customer_id, bool_or(order_status = 'cancelled') AS any_cancelled, bool_and(order_status = 'delivered') AS all_delivered FROM orders_v GROUP BY 1""")
def _(t):
    return t.orders.groupBy("customer_id").agg(
        F.bool_or(F.col("order_status") == "cancelled").alias("any_cancelled"), F.bool_and(F.col("order_status") == "delivered").alias("all_delivered"))


@query("agg_count_by_key", "SELECT payment_method, count(*) AS n FROM orders_v GROUP BY 1 ORDER BY n DESC, payment_method")
def _(t):
    return t.orders.groupBy("payment_method").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "payment_method")


@query("agg_histogram", """
WITH s AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
b AS (SELECT least(CAST(floor((o_totalprice - lo) * 20 / (hi - lo)) AS INT), 19) AS bin FROM orders, s)
SELECT CAST(k AS INT) AS bin, count(b.bin) AS n FROM range(20) r(k) LEFT JOIN b ON b.bin = k GROUP BY 1""")
def _(t):
    return R.equal_width_bins(t.payments, "payment_value", 20)


@query("agg_month_resample", """
WITH d AS (SELECT DISTINCT CAST(date_trunc('month', d) AS DATE) AS month FROM (SELECT unnest(generate_series(min(return_date), max(return_date), INTERVAL 1 DAY)) AS d FROM returns_v))
SELECT d.month, CAST(coalesce(sum(return_quantity), 0) AS BIGINT) AS n_returns FROM d LEFT JOIN returns_v r ON CAST(date_trunc('month', return_date) AS DATE) = d.month GROUP BY 1""")
def _(t):
    return D.month_totals(D.returns_daily(t.returns).select("date", "n_returns"), "date", ["n_returns"])


COHORT_SQL = """
WITH m AS (SELECT DISTINCT customer_id, CAST(date_trunc('month', order_date) AS DATE) AS om FROM orders_v WHERE order_status IN ('delivered', 'returned', 'shipped', 'paid')),
c AS (SELECT customer_id, min(om) AS cm FROM m GROUP BY 1),
a AS (SELECT cm AS cohort_month, CAST((year(om) - year(cm)) * 12 + month(om) - month(cm) AS INT) AS month_number, count(*) AS active_customers FROM m JOIN c USING (customer_id) GROUP BY 1, 2),
z AS (SELECT cohort_month, active_customers AS cohort_size FROM a WHERE month_number = 0),
long AS (SELECT a.cohort_month, month_number, active_customers, cohort_size, CAST(active_customers AS DOUBLE) / cohort_size * 100 AS retention_rate
         FROM a JOIN z ON a.cohort_month = z.cohort_month WHERE month_number <= 12)"""

MATRIX_SQL = ", ".join(f"max(retention_rate) FILTER (WHERE month_number = {m}) AS m_{m}" for m in range(1, 13))


def sold(t):
    return t.orders.where(F.col("order_status").isin("delivered", "returned", "shipped", "paid"))


@query("agg_pivot_matrix", COHORT_SQL + f"SELECT cohort_month, {MATRIX_SQL} FROM long WHERE month_number >= 1 GROUP BY 1")
def _(t):
    return retention_matrix(cohort_retention(sold(t)))
