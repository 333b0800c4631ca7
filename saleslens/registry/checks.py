"""Data quality checks."""

from pyspark.sql import functions as F

from ..functions import day, exact_mean, exact_sum
from ..operators import quality as Q
from ..operators.joins import calendar
from ..plans.daily import base_table
from .base import query
from .views_sql import dmean



def rec(table, column, check, bad, n, detail, level="WARNING"):
    """One report row as SQL; the expressions are evaluated inside the FROM the caller adds."""
    return f"""SELECT '{table}' AS "table", '{column}' AS "column", '{check}' AS check_name, CASE WHEN {bad} THEN '{level}' ELSE 'PASS' END AS status,
    CAST({n} AS BIGINT) AS n_violations, {detail} AS detail"""


ROW_COUNT = f"""
{rec('orders', '', 'row_count', 'count(*) <> 15000', 'abs(count(*) - 15000)', "concat('rows=', count(*), ' expected=15000')")} FROM orders
UNION ALL
{rec('order_items', '', 'row_count', 'count(*) <> 600000', 'abs(count(*) - 600000)', "concat('rows=', count(*), ' expected=600000')")} FROM lineitem"""


def row_counts(t):
    return [
        Q.TableChecks(t.raw("orders"), "orders").row_count(15_000).report(),
        Q.TableChecks(t.raw("lineitem"), "order_items").row_count(600_000).row_count(-1).report(),
    ]


@query("dq_row_count", ROW_COUNT)
def _(t):
    return Q.combine(row_counts(t))


NULL_RATE = " UNION ALL ".join(
    rec("customers", c, "null_check", f"count(*) FILTER (WHERE {c} IS NULL) > 0", f"count(*) FILTER (WHERE {c} IS NULL)",
        f"concat('nulls=', count(*) FILTER (WHERE {c} IS NULL), '/', count(*))") + " FROM customers_v"
    for c in ("customer_id", "zip", "age_group"))


def null_rates(t):
    return Q.TableChecks(t.customers, "customers").null_rate(nullable=["acquisition_channel"]).report()


@query("dq_null_rate", NULL_RATE)
def _(t):
    return null_rates(t)


def fk_sql(table, child, fk, parent, pk):
    return f"""
SELECT '{table}' AS "table", '{fk}' AS "column", 'fk_integrity_{fk}' AS check_name, CASE WHEN count(*) > 0 THEN 'ERROR' ELSE 'PASS' END AS status, count(*) AS n_violations,
       concat('examples=', coalesce((SELECT string_agg(k, ',' ORDER BY k0) FROM (SELECT DISTINCT {fk} AS k0, CAST({fk} AS VARCHAR) AS k FROM {child} WHERE {fk} IS NOT NULL AND {fk} NOT IN (SELECT {pk} FROM {parent}) ORDER BY k0 LIMIT 5)), '')) AS detail
FROM {child} WHERE {fk} IS NOT NULL AND {fk} NOT IN (SELECT {pk} FROM {parent})"""


FK = " UNION ALL ".join([
    fk_sql("orders->customers", "orders_v", "customer_id", "customers_v", "customer_id"),
    fk_sql("order_items->orders", "items_v", "order_id", "orders_v", "order_id"),
    fk_sql("order_items->products", "items_v", "product_id", "products_v", "product_id"),
    fk_sql("reviews->order_items", "reviews_v", "order_id", "items_v", "order_id"),
])


def foreign_keys(t):
    return [
        Q.foreign_key(t.orders, t.customers, "customer_id", "customer_id", "orders->customers"),
        Q.foreign_key(t.items, t.orders, "order_id", "order_id", "order_items->orders"),
        Q.foreign_key(t.items, t.products, "product_id", "product_id", "order_items->products"),
        Q.foreign_key(t.reviews, t.items, "order_id", "order_id", "reviews->order_items"),
    ]


@query("dq_fk_integrity", FK)
def _(t):
    return Q.combine(foreign_keys(t))


POSITIVE = " UNION ALL ".join(
    rec("sales", c, "positive_check", f"count(*) FILTER (WHERE {c} <= 0) > 0", f"count(*) FILTER (WHERE {c} <= 0)",
        f"concat('not_positive=', count(*) FILTER (WHERE {c} <= 0))", "ERROR") + " FROM sales_v" for c in ("revenue", "cogs")
) + " UNION ALL " + rec("customers", "c_acctbal", "positive_check", "count(*) FILTER (WHERE c_acctbal <= 0) > 0", "count(*) FILTER (WHERE c_acctbal <= 0)",
                        "concat('not_positive=', count(*) FILTER (WHERE c_acctbal <= 0))", "ERROR") + " FROM customer"


def positives(t):
    return [
        Q.TableChecks(t.sales, "sales").positive("revenue").positive("cogs").report(),
        Q.TableChecks(t.raw("customer"), "customers").positive("c_acctbal").report()]


@query("dq_positive", POSITIVE)
def _(t):
    return Q.combine(positives(t))


def date_sql(table, c, view, first, last):
    bad = f"NOT ({c} BETWEEN DATE '{first}' AND DATE '{last}')"
    shown = f"list_slice(list_sort(list(DISTINCT {c}) FILTER (WHERE {bad})), 1, 3)"
    return rec(
        table, c, "date_range", f"count(*) FILTER (WHERE {bad}) > 0", f"count(*) FILTER (WHERE {bad})",
        f"concat('min=', min({c}), ' max=', max({c}), ' examples=', array_to_string(list_transform({shown}, lambda d: CAST(d AS VARCHAR)), ','))",
        "ERROR") + f" FROM {view}"


# The second range is narrower than the returns, so that there are examples to show.
DATES = " UNION ALL ".join([
    date_sql("orders", "order_date", "orders_v", "1995-01-01", "2001-08-01"),
    date_sql("returns", "return_date", "returns_v", "1995-01-01", "2001-06-30")])


def date_ranges(t):
    return [
        Q.TableChecks(t.orders, "orders").date_range("order_date", day("1995-01-01"), day("2001-08-01")).report(),
        Q.TableChecks(t.returns, "returns").date_range("return_date", day("1995-01-01"), day("2001-06-30")).report()]


@query("dq_date_range", DATES)
def _(t):
    return Q.combine(date_ranges(t))


ORDER = rec(
    "products", "cogs/price", "cogs_lt_price", "count(*) FILTER (WHERE cogs >= price) > 0", "count(*) FILTER (WHERE cogs >= price)",
    "concat('violations=', count(*) FILTER (WHERE cogs >= price))", "ERROR") + " FROM products_v"


def column_orders(t):
    return Q.TableChecks(t.products, "products").column_order("cogs", "price").report()


@query("dq_column_order", ORDER)
def _(t):
    return column_orders(t)


CONSTANT = " UNION ALL ".join(
    rec("inventory", c, "constant_check", f"count(*) FILTER (WHERE {c} IS DISTINCT FROM 0) > 0",
        f"CASE WHEN count(*) FILTER (WHERE {c} IS DISTINCT FROM 0) > 0 THEN greatest(count(DISTINCT {c}) - 1, 0) ELSE 0 END",
        f"concat('values=', count(DISTINCT {c}))") + " FROM inventory_v" for c in ("reorder_flag", "stockout_flag"))


def constants_of(inventory):
    return Q.TableChecks(inventory, "inventory").constant("reorder_flag", 0).constant("stockout_flag", 0).report()


def constants(t):
    return constants_of(t.inventory)


@query("dq_constant", CONSTANT)
def _(t):
    return constants(t)


HIGH_NULL = " UNION ALL ".join(
    rec("order_items", c, "high_null_check", f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) / count(*) < 0.95", "0",
        f"concat('nulls=', count(*) FILTER (WHERE {c} IS NULL), '/', count(*))") + " FROM items_v" for c in ("promo_id", "promo_id_2"))


def high_nulls(t):
    return Q.TableChecks(t.lines, "order_items").high_null("promo_id").high_null("promo_id_2").report()


@query("dq_high_null", HIGH_NULL)
def _(t):
    return high_nulls(t)


PARTS = " UNION ALL ".join(f"SELECT * FROM ({x})" for x in (ROW_COUNT, NULL_RATE, FK, POSITIVE, DATES, ORDER, CONSTANT, HIGH_NULL))


def fused_report(t):
    """All checks above: one scan for the checks of each table, and one of the lines, orders and products for what is derived from their join."""
    audit = Q.FusedChecks(t.spark)
    audit.table(t.raw("orders").select("*", F.to_date("o_orderdate").alias("order_date")).withColumnsRenamed(
        {"o_orderkey": "order_id", "o_custkey": "customer_id"}), "orders").row_count(15_000).date_range(
        "order_date", day("1995-01-01"), day("2001-08-01")).foreign_key("customer_id", "orders->customers").key("order_id", "order_items->orders").done()
    lines = t.raw("lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"), F.to_date("l_shipdate").alias("return_date"),
        (F.col("l_returnflag") == "R").alias("returned"))
    audit.table(lines, "order_items").row_count(600_000).row_count(-1).foreign_key("order_id", "order_items->orders").foreign_key(
        "product_id", "order_items->products").key("order_id", "reviews->order_items").date_range(
        "return_date", day("1995-01-01"), day("2001-06-30"), table="returns", where=F.col("returned")).done()
    balance = t.raw("customer").select(F.col("c_custkey").alias("customer_id"), F.col("c_nationkey").alias("zip"), "c_acctbal", t.age_group.alias("age_group"))
    audit.table(balance, "customers").null_rate(["customer_id", "zip", "age_group"]).positive("c_acctbal").key("customer_id", "orders->customers").done()
    audit.table(t.products, "products").column_order("cogs", "price").key("product_id", "order_items->products").done()
    audit.table(t.reviews, "reviews").foreign_key("order_id", "reviews->order_items").done()
    sold = t.stored("sold_products")
    sales = sold.where("known").groupBy(F.col("order_date").alias("date")).agg(exact_sum("revenue").alias("revenue"), exact_sum("cogs").alias("cogs"))
    months = sold.groupBy(F.last_day("order_date").alias("snapshot_date"), "product_id").agg(F.sum("quantity").alias("units_sold"))
    promos = sold.agg(F.sum("n").alias("n"), F.sum("n_promo").alias("promo_id"), F.sum("n_promo_2").alias("promo_id_2"))
    return Q.combine([
        audit.report(), Q.TableChecks(sales, "sales").positive("revenue").positive("cogs").report(),
        constants_of(t.inventory_of(months)), Q.high_null_counts(promos, "order_items", "n", ["promo_id", "promo_id_2"])])


@query("dq_report", f"""
SELECT status, count(*) AS n_checks, CAST(sum(n_violations) AS BIGINT) AS n_violations FROM ({PARTS}) GROUP BY 1""")
def _(t):
    return Q.totals(fused_report(t))


@query("dq_base_table", """
WITH b AS (SELECT min(order_date) AS lo, max(order_date) AS hi FROM orders_v WHERE order_date <= DATE '1999-12-31')
SELECT date_diff('day', lo, hi) + 31 AS n_rows, date_diff('day', lo, hi) + 31 AS n_days, date_diff('day', lo, hi) + 31 AS n_distinct_days,
       lo AS first_date, CAST(hi + INTERVAL 30 DAY AS DATE) AS last_date, CAST(0 AS BIGINT) AS n_test_targets, true AS ok FROM b""")
def _(t):
    base = base_table(t, last_known="1999-12-31", horizon_days=30)
    return Q.base_table_summary(base, "date", "revenue", day("2000-01-01"))


@query("dq_forecast", """
WITH d AS (SELECT CAST(unnest(generate_series(min(order_date), max(order_date), INTERVAL 1 DAY)) AS DATE) AS date FROM orders_v),
f AS (SELECT d.date, revenue, cogs FROM d LEFT JOIN sales_v s ON d.date = s.date)
SELECT count(*) AS n_rows, count(*) FILTER (WHERE revenue IS NULL) + count(*) FILTER (WHERE cogs IS NULL) AS n_null,
       count(*) FILTER (WHERE revenue < 0) + count(*) FILTER (WHERE cogs < 0) AS n_negative, count(*) AS n_expected,
       count(*) FILTER (WHERE revenue IS NULL) + count(*) FILTER (WHERE cogs IS NULL) = 0 AS ok FROM f""")
def _(t):
    template = calendar(t.orders.select(F.col("order_date").alias("date")), "date")
    return Q.forecast_summary(template.join(t.sales, "date", "left"), template, ["revenue", "cogs"])


@query("dq_year_check", f"""
SELECT s.year, mean_revenue, coalesce(n_campaigns, 0) AS n_campaigns FROM (SELECT CAST(year(date) AS INT) AS year, {dmean('revenue')} AS mean_revenue FROM sales_v GROUP BY 1) s
LEFT JOIN (SELECT CAST(year(start_date) AS INT) AS year, count(*) AS n_campaigns FROM promotions_v GROUP BY 1) p ON s.year = p.year""")
def _(t):
    mean = t.sales.groupBy(F.year("date").alias("year")).agg(exact_mean("revenue").alias("mean_revenue"))
    campaigns = t.promotions.groupBy(F.year("start_date").alias("year")).agg(F.count(F.lit(1)).alias("n_campaigns"))
    return mean.join(campaigns, "year", "left").withColumn("n_campaigns", F.coalesce("n_campaigns", F.lit(0)))


