"""Join operators."""

from pyspark.sql import functions as F

from ..functions import exact_sum, ratio
from ..operators import joins as J
from ..operators.relational import complete_keys
from ..plans.customers import first_orders, period_retention, top_customers_lost
from ..plans.daily import base_table, returns_daily
from ..plans.features import nearest_major_promo, holiday_calendar
from ..plans.revenue import order_money
from .base import query
from .views_sql import dsum

DAYS = """(SELECT CAST(unnest(generate_series(min(order_date), max(order_date), INTERVAL 1 DAY)) AS DATE) AS date FROM orders_v)"""

# Base table: every daily aggregate on the skeleton, 30 future days at the end.
BASE_SQL = f"""
WITH days AS (SELECT CAST(unnest(generate_series(min(order_date), CAST(max(order_date) + INTERVAL 30 DAY AS DATE), INTERVAL 1 DAY)) AS DATE) AS date FROM orders_v),
per_order AS (SELECT order_id, sum(quantity) AS n_items, {dsum('unit_price * quantity - discount_amount')} AS gross_revenue,
                     {dsum('discount_amount')} AS total_discount, count(DISTINCT product_id) AS n_unique_products FROM items_v GROUP BY 1),
od AS (SELECT order_date AS date, count(*) AS n_orders, CAST(coalesce(sum(n_items), 0) AS BIGINT) AS n_items_sold, coalesce({dsum('gross_revenue')}, 0) AS gross_revenue,
              coalesce({dsum('total_discount')}, 0) AS total_discount, count(DISTINCT customer_id) AS n_unique_customers,
              CAST(coalesce(sum(n_unique_products), 0) AS BIGINT) AS n_unique_products,
              CAST(count(*) FILTER (WHERE order_status = 'cancelled') AS DOUBLE) / count(*) AS cancelled_rate
       FROM orders_v LEFT JOIN per_order USING (order_id) GROUP BY 1),
rd AS (SELECT return_date AS date, CAST(sum(return_quantity) AS BIGINT) AS n_returns, {dsum('refund_amount')} AS total_refund FROM returns_v GROUP BY 1),
vd AS (SELECT review_date AS date, avg(rating) AS avg_rating, count(*) AS n_reviews FROM reviews_v GROUP BY 1),
sd AS (SELECT ship_date AS date, avg(date_diff('day', ship_date, delivery_date)) AS avg_delivery_days FROM shipments_v GROUP BY 1),
td AS (SELECT date, CAST(sum(sessions) AS BIGINT) AS sessions FROM web_traffic_v GROUP BY 1),
inv AS (SELECT snapshot_date AS date, avg(stockout_days) AS avg_stockout_days, {dsum('fill_rate')} / count(*) AS avg_fill_rate FROM inventory_v GROUP BY 1),
invd AS (SELECT d.date, i.avg_stockout_days, i.avg_fill_rate FROM (SELECT CAST(unnest(generate_series(min(order_date), max(order_date), INTERVAL 1 DAY)) AS DATE) AS date FROM orders_v) d
         ASOF LEFT JOIN inv i ON d.date >= i.date)
SELECT days.date, revenue, cogs, cogs / nullif(revenue, 0) AS cogs_ratio, n_orders, n_items_sold, gross_revenue, total_discount, n_unique_customers, n_unique_products,
       cancelled_rate, gross_revenue / n_orders AS avg_order_value, n_returns, total_refund, avg_rating, n_reviews, avg_delivery_days, sessions,
       avg_stockout_days, avg_fill_rate
FROM days LEFT JOIN sales_v ON days.date = sales_v.date LEFT JOIN od ON days.date = od.date LEFT JOIN rd ON days.date = rd.date LEFT JOIN vd ON days.date = vd.date
LEFT JOIN sd ON days.date = sd.date LEFT JOIN td ON days.date = td.date LEFT JOIN invd ON days.date = invd.date"""


@query("join_skeleton_left_chain", BASE_SQL)
def _(t):
    return base_table(t, horizon_days=30).select(
        "date", "revenue", "cogs", "cogs_ratio", "n_orders", "n_items_sold", "gross_revenue", "total_discount", "n_unique_customers",
        "n_unique_products", "cancelled_rate", "avg_order_value", "n_returns", "total_refund", "avg_rating", "n_reviews",
        "avg_delivery_days", "sessions", "avg_stockout_days", "avg_fill_rate")


@query("join_inner_equi", f"""
SELECT order_date, category, CAST(sum(quantity) AS BIGINT) AS units, {dsum('unit_price * quantity')} AS revenue
FROM items_v i JOIN orders_v o ON i.order_id = o.order_id JOIN products_v p ON i.product_id = p.product_id GROUP BY 1, 2""")
def _(t):
    return t.lines.join(t.products.select("product_id", "category"), "product_id").groupBy("order_date", "category").agg(
        F.sum("quantity").alias("units"), exact_sum(F.col("unit_price") * F.col("quantity")).alias("revenue"))


@query("join_left_equi", """
SELECT o.order_id, order_date, gross_revenue, region FROM orders_v o LEFT JOIN order_money_v m ON o.order_id = m.order_id LEFT JOIN geography_v g ON o.zip = g.zip""")
def _(t):
    money = order_money(t.items).select("order_id", "gross_revenue")
    return t.orders_geo.select("order_id", "order_date", "zip").join(money, "order_id", "left").join(t.geography, "zip", "left").drop("zip")


@query("join_composite_key", """
SELECT w.date, w.traffic_source, w.sessions, coalesce(n, 0) AS orders_count
FROM web_traffic_v w LEFT JOIN (SELECT order_date AS date, order_source AS traffic_source, count(*) AS n FROM orders_v GROUP BY 1, 2) o
  ON w.date = o.date AND w.traffic_source = o.traffic_source""")
def _(t):
    made = t.orders.groupBy(F.col("order_date").alias("date"), F.col("order_source").alias("traffic_source")).agg(F.count(F.lit(1)).alias("n"))
    return t.web_traffic.select("date", "traffic_source", "sessions").join(made, ["date", "traffic_source"], "left").withColumn(
        "orders_count", F.coalesce("n", F.lit(0))).drop("n")


@query("join_semi_flag", """
SELECT order_id, order_status, order_id IN (SELECT order_id FROM returns_v) AS is_returned FROM orders_v""")
def _(t):
    return J.member_flag(t.orders.select("order_id", "order_status"), t.returns, "order_id", "is_returned")


@query("join_anti_orphans", """
SELECT order_id AS key, count(*) AS n FROM reviews_v WHERE order_id NOT IN (SELECT l_orderkey FROM lineitem) GROUP BY 1""")
def _(t):
    return J.orphan_counts(t.reviews, t.items, "order_id", "order_id")


TOP_SQL = f"""
WITH c AS (SELECT CAST(year(order_date) AS INT) AS year, customer_id, coalesce({dsum('unit_price * quantity')}, 0) AS revenue
           FROM orders_v o LEFT JOIN items_v i ON o.order_id = i.order_id GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY year ORDER BY revenue DESC, customer_id) AS rn, count(*) OVER (PARTITION BY year) AS n FROM c),
top AS (SELECT * FROM r WHERE rn <= floor(n * 0.1))"""


@query("join_anti_churn", TOP_SQL + """
SELECT customer_id FROM top WHERE year = 1998 AND customer_id NOT IN (SELECT customer_id FROM orders_v WHERE year(order_date) = 1999)""")
def _(t):
    return top_customers_lost(t, 1998)


@query("join_interval_contains", f"""
SELECT d.date, count(p.promo_id) AS n_active FROM {DAYS} d LEFT JOIN promotions_v p ON d.date BETWEEN p.start_date AND p.end_date GROUP BY 1""")
def _(t):
    days = J.calendar(t.orders.select(F.col("order_date").alias("date")), "date")
    active = J.expand_days(t.promotions, "start_date", "end_date").groupBy("date").agg(F.count("promo_id").alias("n_active"))
    return days.join(active, "date", "left").withColumn("n_active", F.coalesce("n_active", F.lit(0)))


@query("join_validity_window", """
SELECT i.order_id, i.product_id, i.promo_id, coalesce(order_date BETWEEN start_date AND end_date, false) AS is_valid
FROM items_v i JOIN orders_v o ON i.order_id = o.order_id LEFT JOIN promotions_v p ON i.promo_id = p.promo_id""")
def _(t):
    windows = t.stored("promotions").select("promo_id", "start_date", "end_date")
    valid = F.col("order_date").between(F.col("start_date"), F.col("end_date"))
    return t.lines.join(windows, "promo_id", "left").select(
        "order_id", "product_id", "promo_id", F.coalesce(valid, F.lit(False)).alias("is_valid"))


@query("join_asof_forward_nearest", f"""
SELECT d.date, CAST(coalesce(min(date_diff('day', d.date, p.start_date)), 999) AS INT) AS days_to_next_major_promo,
       coalesce(arg_min(p.discount_value, (date_diff('day', d.date, p.start_date), p.promo_id)), 0.0) AS expected_discount_depth,
       CASE WHEN count(p.promo_id) > 0 THEN 1 ELSE 0 END AS is_within_promo_window
FROM {DAYS} d LEFT JOIN promotions_v p ON p.promo_type = 'percentage' AND p.discount_value >= 20 AND p.start_date > d.date AND date_diff('day', d.date, p.start_date) <= 14
GROUP BY 1""")
def _(t):
    days = J.calendar(t.orders.select(F.col("order_date").alias("date")), "date")
    return nearest_major_promo(days, t.promotions)


# First day of the lunar new year, 1991 to 2003; the queries compute it.
LUNAR_SQL = "[" + ", ".join(f"DATE '{d}'" for d in [
    "1991-02-15", "1992-02-04", "1993-01-23", "1994-02-10", "1995-01-31", "1996-02-19", "1997-02-07", "1998-01-28", "1999-02-16",
    "2000-02-05", "2001-01-24", "2002-02-12", "2003-02-01"]) + "]"
HOLIDAY_SQL = f"""
WITH days AS (SELECT DISTINCT order_date AS date FROM orders_v),
years AS (SELECT unnest(range(min(year(date)) - 1, max(year(date)) + 2)) AS y FROM days),
marks AS (SELECT make_date(CAST(y AS INT), m, d) AS h FROM years, (VALUES (4, 30), (5, 1), (9, 2), (12, 25)) f(m, d)
          UNION SELECT unnest({LUNAR_SQL}))
"""


@query("join_asof_both", HOLIDAY_SQL + """
SELECT date, CAST(coalesce(min(date_diff('day', date, h)) FILTER (WHERE h >= date), 999) AS INT) AS days_to_next,
       CAST(coalesce(min(date_diff('day', h, date)) FILTER (WHERE h < date), 999) AS INT) AS days_from_last
FROM days, marks GROUP BY 1""")
def _(t):
    days = t.orders.select(F.col("order_date").alias("date")).distinct()
    return J.nearest_marks(days, holiday_calendar(days, "date"))


@query("join_date_shift_self", """
SELECT a.series_key, a.date, a.revenue, b.revenue AS revenue_365 FROM panel_v a LEFT JOIN panel_v b ON a.series_key = b.series_key AND a.date = b.date + INTERVAL 365 DAY""")
def _(t):
    return J.shifted_value(t.stored("panel").select("series_key", "date", "revenue"), "date", "revenue", 365, "revenue_365", ["series_key"])


@query("join_interval_per_key", """
WITH f AS (SELECT customer_id, min(order_date) AS first_date FROM live_orders_v GROUP BY 1),
h AS (SELECT f.customer_id, m, CAST(f.first_date + to_months(m) AS DATE) AS target FROM f, (VALUES (1), (3), (6)) v(m)),
e AS (SELECT * FROM h WHERE target <= (SELECT max(order_date) FROM live_orders_v)),
r AS (SELECT e.customer_id, m, bool_or(coalesce(abs(date_diff('day', target, order_date)) <= 15 AND order_date > first_date, false)) AS hit
      FROM e JOIN f USING (customer_id) LEFT JOIN live_orders_v o ON o.customer_id = e.customer_id GROUP BY 1, 2)
SELECT m AS month_number, count(*) AS n_eligible, count(*) FILTER (WHERE hit) AS n_retained, CAST(count(*) FILTER (WHERE hit) AS DOUBLE) / count(*) * 100 AS retention_rate
FROM r GROUP BY 1""")
def _(t):
    live = t.orders.where(F.col("order_status") != "cancelled")
    cohorts = first_orders(live).withColumn("is_promo", F.lit(True))
    return period_retention(live, cohorts, [1, 3, 6]).drop("is_promo")


@query("join_window_overlap", """
SELECT promo_id, EXISTS (SELECT 1 FROM promotions_v b WHERE NOT (CAST(a.end_date + INTERVAL 20 DAY AS DATE) < b.start_date OR CAST(a.start_date + INTERVAL 35 DAY AS DATE) > b.end_date)) AS is_busy
FROM promotions_v a""")
def _(t):
    moved = t.stored("promotions").select("promo_id", F.date_add("start_date", 35).alias("ws"), F.date_add("end_date", 20).alias("we"))
    return J.overlap_flag(moved, t.stored("promotions"), "promo_id", "ws", "we", "start_date", "end_date", "is_busy").select("promo_id", "is_busy")


@query("join_cross", f"""
SELECT d.date, p.promo_id, CAST(date_diff('day', d.date, p.start_date) AS INT) AS days_to FROM {DAYS} d CROSS JOIN promotions_v p
WHERE p.start_date > d.date AND date_diff('day', d.date, p.start_date) <= 14""")
def _(t):
    # The filter keeps 14 pairs per campaign, so only those are ever made.
    days = J.calendar(t.orders.select(F.col("order_date").alias("date")), "date")
    return J.next_start_within(days, t.promotions.select("promo_id", "start_date"), "start_date", 14).select("date", "promo_id", "days_to")


@query("join_full_outer_align", """
SELECT coalesce(a.date, b.date) AS date, n_orders, n_returns FROM (SELECT order_date AS date, count(*) AS n_orders FROM orders_v GROUP BY 1) a
FULL JOIN (SELECT return_date AS date, CAST(sum(return_quantity) AS BIGINT) AS n_returns FROM returns_v GROUP BY 1) b ON a.date = b.date""")
def _(t):
    a = t.orders.groupBy(F.col("order_date").alias("date")).agg(F.count(F.lit(1)).alias("n_orders"))
    return a.join(returns_daily(t.returns).select("date", "n_returns"), "date", "full")


@query("join_reindex", """
SELECT k.return_reason, coalesce(n, 0) AS n FROM (VALUES ('wrong_size'), ('defective'), ('late_delivery'), ('changed_mind'), ('not_as_described'), ('lost')) k(return_reason)
LEFT JOIN (SELECT return_reason, count(*) AS n FROM returns_v GROUP BY 1) r ON k.return_reason = r.return_reason""")
def _(t):
    counts = t.returns.groupBy("return_reason").agg(F.count(F.lit(1)).alias("n"))
    return complete_keys(counts, "return_reason", ["wrong_size", "defective", "late_delivery", "changed_mind", "not_as_described", "lost"], {"n": 0})


@query("join_template_order", f"""
SELECT d.date, revenue, cogs / nullif(revenue, 0) AS cogs_ratio FROM {DAYS} d LEFT JOIN sales_v s ON d.date = s.date ORDER BY d.date""")
def _(t):
    template = J.calendar(t.orders.select(F.col("order_date").alias("date")), "date")
    values = t.sales.select("date", "revenue", ratio("cogs", "revenue").alias("cogs_ratio"))
    return template.join(values, "date", "left").orderBy("date")
