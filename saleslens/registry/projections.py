"""Projections, predicates, dedup, sorts, limits, sets and scalar functions."""

from pyspark.sql import functions as F

from ..functions import (
    clip, date_flags, date_parts, day, days_from, days_in_month, iso_date, map_values, month_start,
    months_between_periods, ratio, round6, shift_days, shift_months, shift_years,
)
from ..operators import relational as R
from ..operators.order_stats import closest_to_median, sample_rows, top_fraction
from ..operators.joins import left_chain
from ..plans.features import calendar_features, cyclical_features
from ..plans.revenue import order_money
from .base import query
from .views_sql import dsum

LINE_KEY = ["order_id", "product_id", "quantity"]
RAW_LINE = "SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS INT) AS quantity"


@query("proj_line_revenue", """
SELECT order_id, product_id, quantity, unit_price * quantity AS gross_revenue,
       unit_price * quantity - discount_amount AS net_revenue FROM items_v""")
def _(t):
    return R.line_revenue(t.items).select(*LINE_KEY, "gross_revenue", "net_revenue")


@query("proj_cogs_ratio", "SELECT date, cogs / nullif(revenue, 0) AS cogs_ratio FROM sales_v")
def _(t):
    return t.sales.select("date", ratio("cogs", "revenue").alias("cogs_ratio"))


@query("proj_line_margin", """
SELECT order_id, i.product_id, quantity, unit_price * quantity AS revenue_line, p.cogs * quantity AS cogs_line, price * quantity AS list_revenue,
       unit_price * quantity - p.cogs * quantity - discount_amount AS gross_profit,
       round(CASE WHEN unit_price * quantity > 0 THEN (unit_price * quantity - p.cogs * quantity - discount_amount) / (unit_price * quantity) END, 6) AS margin_rate,
       round(CASE WHEN price * quantity > 0 THEN 1 - unit_price * quantity / (price * quantity) END, 6) AS discount_rate
FROM items_v i JOIN products_v p ON i.product_id = p.product_id""")
def _(t):
    lines = R.line_margin(t.items.join(t.products.select("product_id", "price", "cogs"), "product_id"))
    return lines.select(
        *LINE_KEY, "revenue_line", "cogs_line", "list_revenue", "gross_profit",
        round6("margin_rate").alias("margin_rate"), round6("discount_rate").alias("discount_rate"))


@query("proj_discount_rate_direct", """
SELECT order_id, product_id, quantity, unit_price * quantity - discount_amount AS actual_revenue,
       CASE WHEN unit_price * quantity > 0 THEN discount_amount / (unit_price * quantity) END AS discount_rate FROM items_v""")
def _(t):
    return R.direct_discount(t.items).select(*LINE_KEY, "actual_revenue", "discount_rate")


@query("filt_date_cutoff", """
SELECT order_id, order_date, customer_id FROM orders_v WHERE order_date BETWEEN DATE '1997-01-01' AND DATE '1999-12-31'""")
def _(t):
    return t.orders_between("1997-01-01", "1999-12-31").select("order_id", "order_date", "customer_id")


@query("filt_status_in", "SELECT order_id, order_status, payment_method FROM orders_v WHERE order_status IN ('delivered', 'shipped', 'paid')")
def _(t):
    return t.orders.where(F.col("order_status").isin("delivered", "shipped", "paid")).select("order_id", "order_status", "payment_method")


@query("filt_null_predicate", "SELECT customer_id, age_group FROM customers_v WHERE age_group IS NOT NULL")
def _(t):
    return t.customers.dropna(subset=["age_group"]).select("customer_id", "age_group")


@query("proj_drop_columns", "SELECT customer_id, acquisition_channel FROM customers_v")
def _(t):
    return R.drop_columns(t.customers, ["zip", "age_group", "not_there"])


PREFIXES = {"positions": ["day_", "week_", "month", "quarter"], "flags": ["is_"]}


@query("proj_select_by_prefix", """
SELECT date, CAST(isodow(date) - 1 AS INT) AS day_of_week, CAST(day(date) AS INT) AS day_of_month, CAST(dayofyear(date) AS INT) AS day_of_year,
       CAST(week(date) AS INT) AS week_of_year, CAST(month(date) AS INT) AS month, CAST(quarter(date) AS INT) AS quarter,
       CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END AS is_weekend, CASE WHEN day(date) = 1 THEN 1 ELSE 0 END AS is_month_start,
       CASE WHEN date = last_day(date) THEN 1 ELSE 0 END AS is_month_end,
       CASE WHEN day(date) = 1 AND month(date) IN (1, 4, 7, 10) THEN 1 ELSE 0 END AS is_quarter_start,
       CASE WHEN date = last_day(date) AND month(date) IN (3, 6, 9, 12) THEN 1 ELSE 0 END AS is_quarter_end
FROM sales_v""")
def _(t):
    wide = calendar_features(t.sales, "date")
    keep = R.columns_by_prefix(wide.columns, ["positions", "flags", "not_there"], PREFIXES)
    return wide.select("date", *keep)


@query("proj_fill_null", """
SELECT o.order_id, coalesce(gross_revenue, 0.0) AS gross_revenue, coalesce(net_revenue, 0.0) AS net_revenue
FROM orders_v o LEFT JOIN order_money_v m ON o.order_id = m.order_id""")
def _(t):
    joined = left_chain(t.orders.select("order_id"), [order_money(t.items)], "order_id")
    return R.fill_null(joined, {"gross_revenue": 0.0, "net_revenue": 0.0})


@query("proj_clip", """
SELECT c_custkey AS customer_id, CASE WHEN c_acctbal IS NOT NULL THEN least(greatest(c_acctbal, 0.0), 5000.0) END AS balance FROM customer""")
def _(t):
    return t.raw("customer").select(F.col("c_custkey").alias("customer_id"), clip("c_acctbal", 0.0, 5000.0).alias("balance"))


@query("proj_case_map", """
SELECT order_id, CASE WHEN month(order_date) IN (4, 5, 6) THEN 'Q2 Peak' WHEN month(order_date) IN (10, 11, 12) THEN 'Q4 Low' ELSE 'Other' END AS season,
       CASE order_status WHEN 'delivered' THEN 'done' WHEN 'shipped' THEN 'moving' ELSE 'void' END AS stage FROM orders_v""")
def _(t):
    month = F.month("order_date")
    out = R.case_label(t.orders, "season", [(month.isin(4, 5, 6), "Q2 Peak"), (month.isin(10, 11, 12), "Q4 Low")], "Other")
    return out.select("order_id", "season", map_values("order_status", {"delivered": "done", "shipped": "moving"}, "void").alias("stage"))


@query("dedup_subset", """
SELECT customer_id, order_date, min(order_id) AS order_id FROM orders_v GROUP BY 1, 2""")
def _(t):
    orders = t.orders.select("customer_id", "order_date", "order_id")
    return R.dedup_first(orders, ["customer_id", "order_date"], [F.col("order_id")])


@query("split_train_test", f"""
SELECT order_date AS date, CASE WHEN order_date <= DATE '1999-12-31' THEN 'train' ELSE 'test' END AS split,
       CASE WHEN order_date <= DATE '1999-12-31' THEN revenue END AS revenue,
       CAST(isodow(order_date) - 1 AS INT) AS day_of_week, CAST(month(order_date) AS INT) AS month,
       round(sin(2 * pi() * month(order_date) / 12), 6) + 0.0 AS sin_month
FROM (SELECT order_date, {dsum('unit_price * quantity')} AS revenue FROM orders_v o JOIN items_v i ON o.order_id = i.order_id GROUP BY 1)""")
def _(t):
    daily = t.sales.select("date", "revenue", F.lit(1).alias("n_orders"))
    wide = cyclical_features(calendar_features(daily, "date"))
    out = R.split_by_date(
        wide, "date", day("1999-12-31"), day("2000-01-01"), targets=["revenue"], observed=["year", "n_orders"],
        must_be_set=["day_of_week", "month", "sin_month", "cos_month", "is_weekend"])
    return out.select("date", "split", "revenue", "day_of_week", "month", round6("sin_month").alias("sin_month"))


# -- sorts and limits ---------------------------------------------------------

@query("sort_multi", "SELECT order_id, order_date, payment_method FROM orders_v ORDER BY payment_method, order_date DESC, order_id")
def _(t):
    return t.orders.select("order_id", "order_date", "payment_method").orderBy("payment_method", F.desc("order_date"), "order_id")


@query("topk_head", "SELECT date, revenue FROM sales_v ORDER BY revenue DESC, date LIMIT 10")
def _(t):
    return t.sales.select("date", "revenue").orderBy(F.desc("revenue"), "date").limit(10)


@query("topk_nsmallest", f"""
SELECT product_id, profit FROM (
  SELECT product_id, {dsum('gross_profit')} AS profit FROM base_lines_v GROUP BY 1) WHERE profit > 0 ORDER BY profit, product_id LIMIT 5""")
def _(t):
    from ..functions import exact_sum
    from ..plans.revenue import base_lines

    profit = base_lines(t).groupBy("product_id").agg(exact_sum("gross_profit").alias("profit"))
    return profit.where(F.col("profit") > 0).orderBy("profit", "product_id").limit(5)


@query("topk_argmax", f"""
SELECT * FROM (SELECT 'max' AS kind, payment_method, n FROM (SELECT payment_method, count(*) AS n FROM orders_v GROUP BY 1) ORDER BY n DESC, payment_method LIMIT 1)
UNION ALL
SELECT * FROM (SELECT 'min' AS kind, payment_method, n FROM (SELECT payment_method, count(*) AS n FROM orders_v GROUP BY 1) ORDER BY n, payment_method LIMIT 1)""")
def _(t):
    counts = t.orders.groupBy("payment_method").agg(F.count(F.lit(1)).alias("n"))
    low, high = F.struct(F.col("n"), F.col("payment_method")), F.struct(-F.col("n"), F.col("payment_method"))
    both = counts.agg(
        F.struct(F.lit("max").alias("kind"), F.min_by("payment_method", high).alias("payment_method"), F.max("n").alias("n")).alias("a"),
        F.struct(F.lit("min").alias("kind"), F.min_by("payment_method", low).alias("payment_method"), F.min("n").alias("n")).alias("b"))
    return both.select(F.explode(F.array("a", "b")).alias("r")).select("r.*")


@query("sample_n", """
SELECT order_id, order_date FROM orders_v ORDER BY md5(concat(CAST(order_id AS VARCHAR), '-42')), order_id LIMIT 500""")
def _(t):
    return sample_rows(t.orders.select("order_id", "order_date"), "order_id", 500, 42)


@query("topk_percent", f"""
WITH c AS (SELECT CAST(year(order_date) AS INT) AS year, customer_id, {dsum('unit_price * quantity')} AS revenue
           FROM orders_v o JOIN items_v i ON o.order_id = i.order_id GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY year ORDER BY revenue DESC, customer_id) AS rn, count(*) OVER (PARTITION BY year) AS n FROM c)
SELECT year, customer_id, revenue FROM r WHERE rn <= floor(n * 0.1)""")
def _(t):
    from ..plans.customers import customer_year_revenue

    return top_fraction(customer_year_revenue(t).where(F.col("revenue").isNotNull()), ["year"], "revenue", "customer_id", 0.1)


@query("topk_closest_to_median", f"""
WITH c AS (SELECT product_id, {dsum('unit_price * quantity')} AS revenue FROM items_v GROUP BY 1),
top AS (SELECT product_id FROM c ORDER BY revenue DESC, product_id LIMIT 3),
m AS (SELECT quantile_cont(revenue, 0.5) AS m FROM c)
SELECT product_id, revenue FROM c, m WHERE product_id NOT IN (SELECT product_id FROM top)
ORDER BY abs(revenue - m.m), product_id LIMIT 1""")
def _(t):
    from ..functions import exact_sum

    rev = t.items.groupBy("product_id").agg(exact_sum(F.col("unit_price") * F.col("quantity")).alias("revenue"))
    return closest_to_median(rev, "revenue", "product_id", skip=rev.orderBy(F.desc("revenue"), "product_id").limit(3))


# -- sets ---------------------------------------------------------------------

@query("set_union_all", """
SELECT order_id, order_date FROM orders_v UNION ALL
SELECT order_id, CAST(order_date + INTERVAL 2 YEAR AS DATE) FROM orders_v WHERE year(order_date) = 1999""")
def _(t):
    orders = t.orders.select("order_id", "order_date")
    moved = t.orders_between("1999-01-01", "1999-12-31").select("order_id", shift_years("order_date", 2).alias("order_date"))
    return orders.unionByName(moved)


@query("set_union_distinct", """
SELECT order_date AS date FROM orders_v UNION SELECT return_date FROM returns_v""")
def _(t):
    return R.union_distinct(t.orders.select(F.col("order_date").alias("date")), t.returns.select(F.col("return_date").alias("date")))


@query("set_difference", """
SELECT customer_id FROM orders_v WHERE year(order_date) = 1998 EXCEPT SELECT customer_id FROM orders_v WHERE year(order_date) = 1999""")
def _(t):
    return R.distinct_difference(
        t.orders_between("1998-01-01", "1998-12-31").select("customer_id"),
        t.orders_between("1999-01-01", "1999-12-31").select("customer_id"))


# -- scalar functions ---------------------------------------------------------

@query("fn_date_parts", """
SELECT order_id, CAST(isodow(order_date) - 1 AS INT) AS day_of_week, CAST(day(order_date) AS INT) AS day_of_month,
       CAST(dayofyear(order_date) AS INT) AS day_of_year, CAST(week(order_date) AS INT) AS week_of_year,
       CAST(month(order_date) AS INT) AS month, CAST(quarter(order_date) AS INT) AS quarter, CAST(year(order_date) AS INT) AS year FROM orders_v""")
def _(t):
    return t.orders.select("order_id", *[c.alias(n) for n, c in date_parts("order_date").items()])


@query("fn_date_flags", """
SELECT order_id, CASE WHEN isodow(order_date) >= 6 THEN 1 ELSE 0 END AS is_weekend, CASE WHEN day(order_date) = 1 THEN 1 ELSE 0 END AS is_month_start,
       CASE WHEN order_date = last_day(order_date) THEN 1 ELSE 0 END AS is_month_end,
       CASE WHEN day(order_date) = 1 AND month(order_date) IN (1, 4, 7, 10) THEN 1 ELSE 0 END AS is_quarter_start,
       CASE WHEN order_date = last_day(order_date) AND month(order_date) IN (3, 6, 9, 12) THEN 1 ELSE 0 END AS is_quarter_end FROM orders_v""")
def _(t):
    return t.orders.select("order_id", *[c.alias(n) for n, c in date_flags("order_date").items()])


@query("fn_date_arith", """
SELECT order_id, CAST(order_date + INTERVAL 14 DAY AS DATE) AS plus_14d, CAST(order_date + INTERVAL 6 MONTH AS DATE) AS plus_6m,
       CAST(order_date - INTERVAL 1 YEAR AS DATE) AS minus_1y, CAST(date_diff('day', DATE '1995-01-01', order_date) AS INT) AS day_index FROM orders_v""")
def _(t):
    return t.orders.select(
        "order_id", shift_days("order_date", 14).alias("plus_14d"), shift_months("order_date", 6).alias("plus_6m"),
        shift_years("order_date", -1).alias("minus_1y"), days_from(day("1995-01-01"), "order_date").alias("day_index"))


@query("fn_month_period", """
SELECT order_id, CAST(date_trunc('month', order_date) AS DATE) AS month, CAST((year(order_date) - 1995) * 12 + month(order_date) - 1 AS INT) AS month_index,
       CAST(day(last_day(order_date)) AS INT) AS days_in_month FROM orders_v""")
def _(t):
    return t.orders.select(
        "order_id", month_start("order_date").alias("month"),
        months_between_periods("order_date", day("1995-01-01")).alias("month_index"), days_in_month("order_date").alias("days_in_month"))


@query("fn_date_format", "SELECT o_orderkey AS order_id, strftime(o_orderdate, '%Y-%m-%d') AS date_text, CAST(o_orderdate AS DATE) AS date FROM orders")
def _(t):
    return t.raw("orders").select(
        F.col("o_orderkey").alias("order_id"), iso_date(F.to_date("o_orderdate")).alias("date_text"), F.to_date("o_orderdate").alias("date"))


@query("fn_string", """
SELECT p_partkey AS product_id, lower(p_type) AS type_lower, replace(p_brand, '#', ' ') AS brand_text, substring(p_name, 1, 4) AS name_head,
       starts_with(p_type, 'ECO') AS is_economy FROM part""")
def _(t):
    return t.raw("part").select(
        F.col("p_partkey").alias("product_id"), F.lower("p_type").alias("type_lower"),
        F.replace("p_brand", F.lit("#"), F.lit(" ")).alias("brand_text"), F.substring("p_name", 1, 4).alias("name_head"),
        F.startswith("p_type", F.lit("ECO")).alias("is_economy"))


@query("fn_math", """
SELECT o_orderkey AS order_id, round(sin(o_totalprice / 1000), 6) AS sin_v, round(cos(o_totalprice / 1000), 6) AS cos_v, round(ln(o_totalprice), 6) AS log_v,
       round(ln(1 + o_totalprice), 6) AS log1p_v, round(exp(o_totalprice / 1000000) - 1, 6) AS expm1_v, abs(o_totalprice - 200000) AS abs_v,
       round(sqrt(o_totalprice), 6) AS sqrt_v, round(power(o_totalprice / 100000, 2), 6) AS pow_v FROM orders""")
def _(t):
    v = F.col("o_totalprice")
    return t.raw("orders").select(
        F.col("o_orderkey").alias("order_id"), round6(F.sin(v / 1000)).alias("sin_v"), round6(F.cos(v / 1000)).alias("cos_v"),
        round6(F.ln(v)).alias("log_v"), round6(F.log1p(v)).alias("log1p_v"), round6(F.expm1(v / 1000000)).alias("expm1_v"),
        F.abs(v - 200000).alias("abs_v"), round6(F.sqrt(v)).alias("sqrt_v"), round6(F.pow(v / 100000, F.lit(2))).alias("pow_v"))


@query("fn_cast", """
SELECT o_orderkey AS order_id, TRY_CAST(substring(o_orderpriority, 1, 1) AS INT) AS priority_rank, TRY_CAST(o_orderstatus AS INT) AS not_a_number,
       CAST(o_orderkey AS DOUBLE) AS order_double FROM orders""")
def _(t):
    return t.raw("orders").select(
        F.col("o_orderkey").alias("order_id"), F.substring("o_orderpriority", 1, 1).try_cast("int").alias("priority_rank"),
        F.col("o_orderstatus").try_cast("int").alias("not_a_number"), F.col("o_orderkey").cast("double").alias("order_double"))
