"""Business questions on customers, revenue, margins, stock and returns."""

from pyspark.sql import functions as F

from ..functions import exact_mean, pct, rate_where, round6
from ..operators.relational import top_key
from ..operators.windows import rolling
from ..plans import customers as C
from ..plans import daily as D
from ..plans import market as M
from ..plans.campaigns import quarter_promo_share
from .aggregates import COHORT_SQL, sold
from .base import query
from .joins import TOP_SQL
from .views_sql import dmean, dsum


# -- single answers -----------------------------------------------------------

@query("an_inter_order_gap_median", """
WITH d AS (SELECT DISTINCT customer_id, order_date FROM orders_v WHERE order_status = 'delivered'),
g AS (SELECT date_diff('day', lag(order_date) OVER (PARTITION BY customer_id ORDER BY order_date), order_date) AS g FROM d)
SELECT quantile_cont(g, 0.5) AS median_gap_days FROM g WHERE g IS NOT NULL""")
def _(t):
    return C.inter_order_gap_median(t.orders.where(F.col("order_status") == "delivered"))


@query("an_segment_margin", """
SELECT segment, round(avg((price - cogs) / price), 6) AS margin, rank() OVER (ORDER BY round(avg((price - cogs) / price), 6) DESC, segment) = 1 AS is_best FROM products_v GROUP BY 1""")
def _(t):
    margins = M.segment_margin(t.products)
    best = margins.agg(F.min_by("segment", F.struct(-F.col("margin"), F.col("segment")))).scalar()
    return margins.withColumn("is_best", F.col("segment") == best)


@query("an_return_reason_top", """
SELECT return_reason, count(*) AS n FROM returns_v r JOIN products_v p ON r.product_id = p.product_id WHERE category = 'ECONOMY' GROUP BY 1 ORDER BY n DESC, return_reason LIMIT 1""")
def _(t):
    return top_key(M.return_reasons(t.returns, t.products, "ECONOMY"), "return_reason", "n")


@query("an_bounce_by_source", "SELECT traffic_source, round(avg(bounce_rate), 6) AS bounce_rate FROM web_traffic_v GROUP BY 1 ORDER BY 2, 1 LIMIT 1")
def _(t):
    rates = t.web_traffic.groupBy("traffic_source").agg(round6(F.avg("bounce_rate")).alias("bounce_rate"))
    return top_key(rates, "traffic_source", "bounce_rate", largest=False)


@query("an_promo_line_share", "SELECT CAST(count(promo_id) AS DOUBLE) / count(*) * 100 AS pct_lines_with_promo FROM items_v")
def _(t):
    return t.items.agg((rate_where(F.col("has_promo_id")) * 100.0).alias("pct_lines_with_promo"))


@query("an_orders_per_customer_by_age", """
SELECT age_group, count(o.order_id) AS n_orders, count(DISTINCT c.customer_id) AS n_customers, CAST(count(o.order_id) AS DOUBLE) / count(DISTINCT c.customer_id) AS orders_per_customer
FROM customers_v c LEFT JOIN orders_v o ON c.customer_id = o.customer_id WHERE age_group IS NOT NULL GROUP BY 1""")
def _(t):
    return C.orders_per_customer_by_age(t.customers, t.orders)


@query("an_revenue_by_region", f"""
SELECT region, {dsum('unit_price * quantity')} AS revenue FROM items_v i JOIN orders_v o ON i.order_id = o.order_id JOIN geography_v g ON o.zip = g.zip GROUP BY 1""")
def _(t):
    return M.revenue_by_region(t)


@query("an_cancelled_payment_top", "SELECT payment_method, count(*) AS n FROM orders_v WHERE order_status = 'cancelled' GROUP BY 1 ORDER BY n DESC, payment_method LIMIT 1")
def _(t):
    cancelled = t.orders.where(F.col("order_status") == "cancelled")
    return top_key(cancelled.groupBy("payment_method").agg(F.count(F.lit(1)).alias("n")), "payment_method", "n")


@query("an_return_rate_by_size", """
WITH a AS (SELECT size, count(*) AS returns_count FROM returns_v r JOIN products_v p ON r.product_id = p.product_id GROUP BY 1),
b AS (SELECT size, count(*) AS lines_count FROM items_v i JOIN products_v p ON i.product_id = p.product_id GROUP BY 1)
SELECT coalesce(a.size, b.size) AS size, CAST(returns_count AS BIGINT) AS returns_count, CAST(lines_count AS BIGINT) AS lines_count, CAST(returns_count AS DOUBLE) / lines_count AS return_rate
FROM a FULL JOIN b ON a.size = b.size""")
def _(t):
    return M.return_rate_by_size(t)


@query("an_installment_value", f"SELECT installments, {dmean('payment_value')} AS avg_value FROM payments_v GROUP BY 1")
def _(t):
    return t.payments.groupBy("installments").agg(exact_mean("payment_value").alias("avg_value"))


# -- revenue ------------------------------------------------------------------

@query("an_yearly_revenue_yoy", f"""
WITH y AS (SELECT CAST(year(date) AS INT) AS year, {dsum('revenue')} AS revenue FROM sales_v GROUP BY 1)
SELECT year, revenue, round((revenue / lag(revenue) OVER (ORDER BY year) - 1) * 100, 6) AS yoy_growth, revenue = (SELECT max(revenue) FROM y) AS is_peak FROM y""")
def _(t):
    return M.yearly_revenue(t.revenue_by_day)


@query("an_revenue_concentration", TOP_SQL + f""",
a AS (SELECT year, count(*) AS n_customers, {dsum('revenue')} AS total_revenue FROM r GROUP BY 1), b AS (SELECT year, count(*) AS n_top, {dsum('revenue')} AS top_revenue FROM top GROUP BY 1)
SELECT a.year, n_customers, total_revenue, coalesce(n_top, 0) AS n_top, top_revenue, top_revenue / nullif(total_revenue, 0) AS top_share FROM a LEFT JOIN b ON a.year = b.year""")
def _(t):
    return C.revenue_concentration(t)


@query("an_top_customer_churn", TOP_SQL + """,
k AS (SELECT DISTINCT year(order_date) - 1 AS year, customer_id FROM orders_v)
SELECT top.year, count(*) AS n_top, count(*) FILTER (WHERE k.customer_id IS NULL) AS n_lost, CAST(count(*) FILTER (WHERE k.customer_id IS NULL) AS DOUBLE) / count(*) AS churn_rate
FROM top LEFT JOIN k ON top.year = k.year AND top.customer_id = k.customer_id WHERE top.year IN (1997, 1998, 1999) GROUP BY 1""")
def _(t):
    return C.top_customer_churn(t, [1997, 1998, 1999])


MONTHLY_SQL = f"""
WITH m AS (SELECT CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month, {dsum('revenue')} AS monthly_revenue FROM sales_v GROUP BY 1, 2),
y AS (SELECT year, {dmean('monthly_revenue')} AS mean FROM m GROUP BY 1),
x AS (SELECT m.year, month, monthly_revenue / mean AS i FROM m JOIN y ON m.year = y.year)"""


@query("an_monthly_index", MONTHLY_SQL + "SELECT year, " + ", ".join(f"max(i) FILTER (WHERE month = {m}) AS m_{m}" for m in range(1, 13)) + """,
 (SELECT round(avg(i), 6) FROM x WHERE month IN (4, 5, 6)) AS peak_avg, (SELECT round(avg(i), 6) FROM x WHERE month IN (1, 2, 11, 12)) AS low_avg FROM x GROUP BY 1""")
def _(t):
    return M.monthly_matrix(M.monthly_index(t.stored("revenue_by_day")))


@query("an_region_share", f"""
WITH r AS (SELECT CAST(year(order_date) AS INT) AS year, region, coalesce({dsum('gross_revenue')}, 0) AS revenue
           FROM orders_v o LEFT JOIN geography_v g ON o.zip = g.zip LEFT JOIN order_money_v m ON o.order_id = m.order_id WHERE region IS NOT NULL GROUP BY 1, 2),
s AS (SELECT *, revenue / CAST(sum(CAST(revenue AS DECIMAL(28,4))) OVER (PARTITION BY year) AS DOUBLE) * 100 AS pct FROM r)
SELECT *, first_value(region) OVER (PARTITION BY year ORDER BY pct DESC, region) AS dominant_region, max(pct) OVER (PARTITION BY year) > 55 AS is_concentrated FROM s""")
def _(t):
    return M.region_share(t)


def yoy(c):
    return f"round(({c} / lag({c}) OVER (ORDER BY year) - 1) * 100, 6) AS {c}_yoy"


@query("an_yearly_kpis", f"""
WITH o AS (SELECT CAST(year(order_date) AS INT) AS year, count(DISTINCT customer_id) AS customers, count(DISTINCT order_id) AS orders_cnt FROM orders_v GROUP BY 1),
s AS (SELECT CAST(year(date) AS INT) AS year, {dsum('revenue')} AS revenue FROM sales_v GROUP BY 1),
k AS (SELECT o.year, customers, orders_cnt, revenue, CAST(orders_cnt AS DOUBLE) / customers AS opc, revenue / orders_cnt AS aov FROM o LEFT JOIN s ON o.year = s.year)
SELECT *, {yoy('customers')}, {yoy('opc')}, {yoy('aov')} FROM k""")
def _(t):
    return C.yearly_kpis(t)


@query("an_region_resilience", """
WITH r AS (SELECT year(order_date) AS year, region, CAST(count(DISTINCT order_id) AS DOUBLE) / count(DISTINCT customer_id) AS opc
           FROM orders_v o JOIN geography_v g ON o.zip = g.zip WHERE year(order_date) IN (1998, 1999, 2000) GROUP BY 1, 2),
w AS (SELECT region, max(opc) FILTER (WHERE year = 1998) AS opc_1998, max(opc) FILTER (WHERE year = 1999) AS opc_1999, max(opc) FILTER (WHERE year = 2000) AS opc_2000 FROM r GROUP BY 1)
SELECT *, round((opc_1999 - opc_1998) / opc_1998 * 100, 6) AS drop_1999, round((opc_2000 - opc_1998) / opc_1998 * 100, 6) AS drop_2000 FROM w""")
def _(t):
    return C.region_orders_per_customer(t, [1998, 1999, 2000])


@query("an_quarter_promo_share", """
WITH u AS (SELECT DISTINCT order_id FROM items_v WHERE promo_id IS NOT NULL OR discount_amount > 0),
q AS (SELECT CAST(year(order_date) AS INT) AS year, CASE WHEN month(order_date) IN (4, 5, 6) THEN 'Q2 Peak' WHEN month(order_date) IN (10, 11, 12) THEN 'Q4 Low' END AS season,
      o.order_id, u.order_id IS NOT NULL AS used FROM orders_v o LEFT JOIN u ON o.order_id = u.order_id)
SELECT year, season, count(DISTINCT order_id) AS total_orders, count(*) FILTER (WHERE used) AS promo_orders,
       round(CAST(count(*) FILTER (WHERE used) AS DOUBLE) / count(DISTINCT order_id) * 100, 1) AS penetration_pct FROM q WHERE season IS NOT NULL AND year IN (1998, 1999) GROUP BY 1, 2""")
def _(t):
    return quarter_promo_share(t, [1998, 1999])


# -- customers and channels ---------------------------------------------------

@query("an_channel_metrics", f"""
WITH d AS (SELECT o.order_id, o.customer_id, o.order_date, acquisition_channel AS ch, gross_revenue AS revenue, o.order_id IN (SELECT order_id FROM returns_v) AS returned
           FROM orders_v o LEFT JOIN customers_v c ON o.customer_id = c.customer_id LEFT JOIN order_money_v m ON o.order_id = m.order_id),
base AS (SELECT ch, count(DISTINCT customer_id) AS customers_count, {dsum('revenue')} AS total_revenue FROM d GROUP BY 1),
f AS (SELECT customer_id, min(order_date) AS fd FROM d GROUP BY 1),
e AS (SELECT ch, d.customer_id, count(DISTINCT order_id) AS n FROM d JOIN f ON d.customer_id = f.customer_id WHERE date_diff('day', fd, order_date) <= 180 GROUP BY 1, 2),
ret AS (SELECT ch, CAST(count(*) FILTER (WHERE n >= 2) AS DOUBLE) / count(*) * 100 AS retention_rate FROM e GROUP BY 1),
g AS (SELECT ch, date_diff('day', lag(order_date) OVER (PARTITION BY customer_id ORDER BY order_date, order_id), order_date) AS gap FROM d),
gp AS (SELECT ch, CAST(sum(gap) AS DOUBLE) / count(gap) AS avg_inter_order_gap FROM g GROUP BY 1),
rr AS (SELECT ch, CAST(count(*) FILTER (WHERE returned) AS DOUBLE) / count(*) * 100 AS return_rate FROM d GROUP BY 1)
SELECT base.ch AS acquisition_channel, customers_count, total_revenue, total_revenue / customers_count AS revenue_per_customer, retention_rate, avg_inter_order_gap, return_rate
FROM base JOIN ret ON base.ch = ret.ch JOIN gp ON base.ch = gp.ch JOIN rr ON base.ch = rr.ch""")
def _(t):
    return C.channel_metrics(t)


@query("an_cohort_retention", COHORT_SQL + "SELECT * FROM long")
def _(t):
    return C.cohort_retention(sold(t))


@query("an_cohort_year_median", COHORT_SQL + ", w AS (SELECT cohort_month, " + ", ".join(
    f"max(retention_rate) FILTER (WHERE month_number = {m}) AS m_{m}" for m in range(1, 13)) + " FROM long WHERE month_number >= 1 GROUP BY 1) SELECT CAST(year(cohort_month) AS INT) AS cohort_year, "
    + ", ".join(f"round(quantile_cont(m_{m}, 0.5), 6) AS m_{m}" for m in range(1, 13)) + " FROM w GROUP BY 1")
def _(t):
    return C.retention_by_year(C.retention_matrix(C.cohort_retention(sold(t))))


@query("an_new_vs_repeat", f"""
WITH o AS (SELECT o.order_id, CAST(year(order_date) AS INT) AS year, gross_revenue AS r, row_number() OVER (PARTITION BY customer_id ORDER BY order_date, o.order_id) = 1 AS is_new
           FROM orders_v o LEFT JOIN order_money_v m ON o.order_id = m.order_id),
y AS (SELECT year, coalesce({dsum('CASE WHEN is_new THEN r END')}, 0) AS new_revenue, coalesce({dsum('CASE WHEN NOT is_new THEN r END')}, 0) AS repeat_revenue,
      count(*) FILTER (WHERE is_new) AS new_orders, count(*) FILTER (WHERE NOT is_new) AS repeat_orders FROM o GROUP BY 1)
SELECT *, new_revenue / (new_revenue + repeat_revenue) * 100 AS pct_new, repeat_revenue / (new_revenue + repeat_revenue) * 100 AS pct_repeat FROM y""")
def _(t):
    return C.new_vs_repeat(t)


@query("an_channel_conversion", f"""
WITH o AS (SELECT order_date AS date, order_source AS traffic_source, count(*) AS n, {dsum('gross_revenue')} AS revenue FROM orders_v o LEFT JOIN order_money_v m ON o.order_id = m.order_id GROUP BY 1, 2),
y AS (SELECT CAST(year(w.date) AS INT) AS year, CAST(sum(sessions) AS BIGINT) AS sessions, CAST(coalesce(sum(n), 0) AS BIGINT) AS orders_count, coalesce({dsum('revenue')}, 0) AS revenue
      FROM web_traffic_v w LEFT JOIN o ON w.date = o.date AND w.traffic_source = o.traffic_source GROUP BY 1)
SELECT *, CAST(orders_count AS DOUBLE) / sessions * 100 AS conversion_rate, revenue / sessions AS revenue_per_session FROM y""")
def _(t):
    return C.channel_conversion(t)


DAILY_CR = """
WITH v AS (SELECT date, CAST(sum(sessions) AS BIGINT) AS total_sessions, CAST(sum(unique_visitors) AS BIGINT) AS total_visitors FROM web_traffic_v GROUP BY 1),
o AS (SELECT order_date AS date, count(DISTINCT order_id) AS n FROM orders_v GROUP BY 1),
d AS (SELECT v.*, coalesce(n, 0) AS actual_orders FROM v LEFT JOIN o ON v.date = o.date)"""


@query("an_daily_conversion", DAILY_CR + """
SELECT 'day' AS grain, date AS period, total_sessions, actual_orders, coalesce(CAST(actual_orders AS DOUBLE) / nullif(total_sessions, 0) * 100, 0) AS conversion_rate FROM d
UNION ALL SELECT 'month', CAST(date_trunc('month', date) AS DATE), CAST(sum(total_sessions) AS BIGINT), CAST(sum(actual_orders) AS BIGINT),
  coalesce(CAST(sum(actual_orders) AS DOUBLE) / nullif(sum(total_sessions), 0) * 100, 0) FROM d GROUP BY 2""")
def _(t):
    daily = D.conversion_daily(t.web_traffic, t.orders)
    monthly = D.month_totals(daily, "date", ["total_sessions", "actual_orders"]).withColumn(
        "conversion_rate", F.coalesce(pct("actual_orders", "total_sessions"), F.lit(0.0)))
    cols = ["total_sessions", "actual_orders", "conversion_rate"]
    return daily.select(F.lit("day").alias("grain"), F.col("date").alias("period"), *cols).unionByName(
        monthly.select(F.lit("month").alias("grain"), F.col("month").alias("period"), *cols))


@query("an_actual_vs_forecast_smooth", """
WITH s AS (SELECT series_key, date, ln(1 + revenue) AS v FROM panel_v WHERE date >= DATE '1999-01-01'),
f AS (SELECT a.series_key, a.date, a.v AS actual, b.v AS forecast FROM s a JOIN (SELECT series_key, CAST(date + INTERVAL 364 DAY AS DATE) AS date, ln(1 + revenue) AS v FROM panel_v) b ON a.series_key = b.series_key AND a.date = b.date)
SELECT series_key, date, round(avg(actual) OVER w, 6) AS actual14_mean, round(avg(forecast) OVER w, 6) AS forecast14_mean FROM f
WINDOW w AS (PARTITION BY series_key ORDER BY date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)""")
def _(t):
    logs = t.stored("panel").select("series_key", "date", F.log1p("revenue").alias("actual"))
    past = logs.select("series_key", F.date_add("date", 364).alias("date"), F.col("actual").alias("forecast"))
    both = logs.where(F.col("date") >= F.lit("1999-01-01").cast("date")).join(past, ["series_key", "date"])
    for c in ("actual", "forecast"):
        both = rolling(both, ["series_key"], "date", c, [14], ["mean"], prefix=c)
    return both.select("series_key", "date", *[round6(f"{c}14_mean").alias(f"{c}14_mean") for c in ("actual", "forecast")])


# -- margins ------------------------------------------------------------------

def margin_of(cond):
    return f"{dsum(f'CASE WHEN {cond} THEN gross_profit END')} / nullif({dsum(f'CASE WHEN {cond} THEN revenue_line END')}, 0) * 100"


@query("an_margin_erosion", f"""
WITH y AS (SELECT year, CAST(count(*) FILTER (WHERE has_promo) AS DOUBLE) / count(*) * 100 AS promo_penetration, {margin_of('has_promo')} AS margin_promo, {margin_of('NOT has_promo')} AS margin_no_promo
           FROM base_lines_v GROUP BY 1)
SELECT *, margin_no_promo - margin_promo AS margin_gap, round(margin_no_promo - margin_promo - (SELECT arg_min(margin_no_promo - margin_promo, year) FROM y WHERE promo_penetration > 0), 6) AS gap_change FROM y""")
def _(t):
    return M.margin_erosion(t)


RATIOS = f"""{dsum('gross_profit')} / {dsum('revenue_line')} AS margin_rate, {dsum('cogs_line')} / {dsum('revenue_line')} AS cogs_ratio, {dsum('discount_amount')} / {dsum('revenue_line')} AS discount_rate"""


@query("an_margin_drivers", f"""
SELECT year, {RATIOS}, {dsum('revenue_line')} / sum(quantity) AS avg_selling_price, {dsum('list_revenue')} / sum(quantity) AS avg_list_price FROM base_lines_v GROUP BY 1""")
def _(t):
    return M.margin_drivers(t)


@query("an_period_compare", f"SELECT CASE WHEN year <= 1998 THEN 'pre' ELSE 'post' END AS period, {RATIOS} FROM base_lines_v GROUP BY 1")
def _(t):
    return M.period_compare(t, 1998)


@query("an_segment_mix_shift", f"""
WITH m AS (SELECT year, segment, {dsum('revenue_line')} AS revenue FROM base_lines_v GROUP BY 1, 2)
SELECT *, revenue / CAST(sum(CAST(revenue AS DECIMAL(28,4))) OVER (PARTITION BY year) AS DOUBLE) AS share FROM m""")
def _(t):
    return M.segment_mix(t)


@query("an_segment_profile", f"""
SELECT segment, {dsum('revenue_line')} / sum(quantity) AS avg_price, {dsum('gross_profit')} / {dsum('revenue_line')} AS margin_rate, {dsum('revenue_line')} AS total_revenue FROM base_lines_v GROUP BY 1""")
def _(t):
    return M.segment_profile(t)


# -- stock --------------------------------------------------------------------

STOCK_SQL = f"""
WITH ms AS (SELECT CAST(date_trunc('month', date) AS DATE) AS month, {dsum('revenue')} AS monthly_revenue, count(*) AS n_days FROM sales_v GROUP BY 1),
mi AS (SELECT *, monthly_revenue / n_days AS avg_daily_revenue, monthly_revenue / (SELECT {dmean('monthly_revenue')} FROM ms) AS revenue_index FROM ms),
so AS (SELECT CAST(date_trunc('month', snapshot_date) AS DATE) AS month, category, avg(stockout_days) AS avg_stockout_days, count(DISTINCT product_id) AS n_products FROM inventory_v GROUP BY 1, 2),
lost AS (SELECT so.*, monthly_revenue, n_days, avg_daily_revenue, revenue_index, CAST(year(so.month) AS INT) AS year, CAST(month(so.month) AS INT) AS month_num,
         avg_stockout_days * (avg_daily_revenue / 4) AS est_lost_revenue FROM so LEFT JOIN mi ON so.month = mi.month)"""


@query("an_stockout_lost_revenue", STOCK_SQL + "SELECT month, category, avg_stockout_days, n_products, avg_daily_revenue, revenue_index, year, month_num, est_lost_revenue FROM lost")
def _(t):
    return M.stockout_lost_revenue(t).select(
        "month", "category", "avg_stockout_days", "n_products", "avg_daily_revenue", "revenue_index", "year", "month_num", "est_lost_revenue")


@query("an_buffer_stock", STOCK_SQL + """,
b AS (SELECT category, avg(CAST(units_sold AS DOUBLE) / day(last_day(snapshot_date))) AS u FROM inventory_v GROUP BY 1)
SELECT category, round(u, 6) AS avg_daily_units, round(u * 21, 6) AS buffer_units,
       CAST(round(round(u * 21, 6) * (SELECT avg(revenue_index) FROM lost WHERE month_num IN (3, 4, 5))) AS BIGINT) AS season_buffer_units FROM b""")
def _(t):
    return M.buffer_stock(t)


@query("an_worst_stockout_month", STOCK_SQL + """,
m AS (SELECT category, month_num, round(avg(avg_stockout_days), 6) AS days FROM lost WHERE year IN (1998, 1999, 2000) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY days DESC, month_num) AS rn FROM m)
SELECT category, month_num AS worst_month, days AS worst_days FROM r WHERE rn = 1""")
def _(t):
    return M.worst_stockout_month(M.stockout_lost_revenue(t), [1998, 1999, 2000])


# -- returns ------------------------------------------------------------------

PRODUCT_SQL = f"""
WITH sold AS (SELECT product_id, CAST(sum(quantity) AS BIGINT) AS units_sold, {dsum('unit_price * quantity')} AS gross_revenue FROM items_v
              WHERE order_id IN (SELECT order_id FROM orders_v WHERE order_status IN ('delivered', 'shipped', 'paid')) GROUP BY 1),
ret AS (SELECT product_id, CAST(sum(return_quantity) AS BIGINT) AS units_returned, {dsum('refund_amount')} AS total_refund FROM returns_v GROUP BY 1),
p0 AS (SELECT p.product_id, category, price, cogs, coalesce(units_sold, 0) AS units_sold, coalesce(gross_revenue, 0) AS gross_revenue, coalesce(units_returned, 0) AS units_returned, coalesce(total_refund, 0) AS total_refund
       FROM products_v p LEFT JOIN sold s ON p.product_id = s.product_id LEFT JOIN ret r ON p.product_id = r.product_id),
p1 AS (SELECT product_id, category, units_sold, gross_revenue, units_returned, total_refund, CAST(units_returned AS DOUBLE) / greatest(units_sold, 1) AS return_rate, (price - cogs) / greatest(price, 0.01) AS margin_rate,
       total_refund / greatest(gross_revenue, 0.01) AS return_cost_rate FROM p0 WHERE units_sold >= 10),
med AS (SELECT category, quantile_cont(margin_rate, 0.5) AS mm, quantile_cont(return_rate, 0.5) AS rm FROM p1 GROUP BY 1),
quad AS (SELECT p1.*, CASE WHEN margin_rate >= mm AND return_rate < rm THEN 'HM_LR' WHEN margin_rate >= mm THEN 'HM_HR' WHEN return_rate >= rm THEN 'LM_HR' ELSE 'LM_LR' END AS quadrant
         FROM p1 JOIN med ON p1.category = med.category)"""


@query("an_product_return_margin", PRODUCT_SQL + """
SELECT product_id, category, units_sold, gross_revenue, units_returned, total_refund, return_rate, margin_rate, return_cost_rate, margin_rate - return_cost_rate AS net_margin FROM p1""")
def _(t):
    return M.product_return_margin(t).drop("price", "cogs")


@query("an_quadrant", PRODUCT_SQL + f"""
SELECT category, quadrant, count(*) AS n, {dsum('gross_revenue')} AS total_rev, {dsum('total_refund')} AS total_refund, {dsum('total_refund')} / {dsum('gross_revenue')} * 100 AS refund_pct FROM quad GROUP BY 1, 2""")
def _(t):
    return M.quadrant_summary(M.quadrants(M.product_return_margin(t)))


@query("an_reason_mix", PRODUCT_SQL + """,
a AS (SELECT r.return_reason, p.category, q.quadrant FROM returns_v r LEFT JOIN products_v p ON r.product_id = p.product_id LEFT JOIN quad q ON r.product_id = q.product_id),
c AS (SELECT 'all' AS grain, 'all' AS cell, return_reason, count(*) AS n FROM a GROUP BY 3
  UNION ALL SELECT 'category', category, return_reason, count(*) FROM a WHERE category IS NOT NULL GROUP BY 2, 3
  UNION ALL SELECT 'quadrant', quadrant, return_reason, count(*) FROM a WHERE quadrant IS NOT NULL GROUP BY 2, 3
  UNION ALL SELECT 'both', concat(category, '|', quadrant), return_reason, count(*) FROM a WHERE category IS NOT NULL AND quadrant IS NOT NULL GROUP BY 2, 3)
SELECT grain, cell, return_reason, n, CAST(n AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY grain, cell) AS DOUBLE) * 100 AS pct FROM c""")
def _(t):
    return M.reason_mix(t)


@query("an_blame_summary", f"""
WITH b AS (SELECT CASE WHEN return_reason IN ('wrong_size', 'defective', 'late_delivery') THEN 'system' WHEN return_reason IN ('changed_mind', 'not_as_described') THEN 'customer' ELSE 'other' END AS blame,
           count(*) AS n, {dsum('refund_amount')} AS refund FROM returns_v GROUP BY 1)
SELECT *, CAST(n AS DOUBLE) / CAST(sum(n) OVER () AS DOUBLE) * 100 AS pct FROM b""")
def _(t):
    return M.blame_summary(t.returns)
