"""Sources, sinks and the date skeleton."""

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.joins import calendar
from ..sources import (
    load_promotions, normalize_columns, read_csv_with_quarantine, read_parquet, read_typed_csv, scratch_folder, write_csv,
    write_parquet, write_stats,
)
from ..sources.schemas import SCHEMAS
from ..functions import iso_date, ratio, round6
from .base import query

ORDER_COLS = "order_id, order_date, customer_id, zip, order_status, payment_method, device_type, order_source"


@query("src_csv_typed", f"SELECT {ORDER_COLS} FROM orders_v")
def _(t):
    orders = t.orders_geo.select(*[f.name for f in SCHEMAS["orders"]])
    path = write_csv(orders, scratch_folder(t.spark, "orders-csv"))
    return read_typed_csv(t.spark, path, SCHEMAS["orders"])


@query("src_csv_quarantine", """
SELECT count(*) AS n_lines, count(*) FILTER (order_id % 97 = 0 OR order_id % 89 = 0) AS n_quarantined, CAST(sum(order_id) FILTER (order_id % 97 <> 0 AND order_id % 89 <> 0) AS BIGINT) AS good_ids
FROM orders_v""")
def _(t):
    """Orders as CSV with some broken days and numbers; the broken lines are set aside."""
    broken = t.orders.select(
        F.when(F.col("order_id") % 89 == 0, F.concat(F.lit("no. "), "order_id")).otherwise(F.col("order_id").cast("string")).alias("order_id"),
        F.when(F.col("order_id") % 97 == 0, F.lit("soon")).otherwise(iso_date("order_date")).alias("order_date"), "customer_id")
    path = write_csv(broken, scratch_folder(t.spark, "broken-csv"))
    wanted = {f.name: f for f in SCHEMAS["orders"]}
    good, bad = read_csv_with_quarantine(
        t.spark, path, StructType([wanted[c] for c in ("order_id", "order_date", "customer_id")]), max_bad_share=0.05)
    n_bad = bad.agg(F.count(F.lit(1)).alias("n")).scalar()
    sums = good.agg(F.count(F.lit(1)).alias("n"), F.sum("order_id").alias("good_ids")).withColumn("n_quarantined", n_bad)
    return sums.select((F.col("n") + F.col("n_quarantined")).alias("n_lines"), "n_quarantined", "good_ids")


@query("src_normalize_columns", "SELECT c_custkey AS customer_key, c_name AS customer_name, c_nationkey AS zip FROM customer")
def _(t):
    raw = t.raw("customer").select(
        F.col("c_custkey").alias("Customer Key"), F.col("c_name").alias("Customer Name"), F.col("c_nationkey").alias("Nation Key"))
    return normalize_columns(raw, {"nation_key": "zip"})


@query("src_parquet", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey")
def _(t):
    return read_parquet(t.spark, f"{t.folder}/orders.parquet", ["o_orderkey", "o_custkey", "o_totalprice"], ["o_orderkey"])


@query("src_promotions", "SELECT * FROM promotions_v")
def _(t):
    upper = t.promotions.select(*[F.col(f.name).alias(f.name.upper()) for f in SCHEMAS["promotions"]])
    return load_promotions(t.spark, write_csv(upper, scratch_folder(t.spark, "promotions-csv")))


@query("sink_parquet", "SELECT product_id, category, segment, size, price, cogs FROM products_v")
def _(t):
    cols = ["product_id", "category", "segment", "size", "price", "cogs"]
    path = write_parquet(t.products.select(*cols), scratch_folder(t.spark, "products"), partition_by=["category"])
    return t.spark.read.parquet(path).select(*cols)


@query("sink_bucketed", """
SELECT order_date, count(*) AS n_lines, CAST(sum(quantity) AS BIGINT) AS units FROM orders_v o JOIN items_v i ON o.order_id = i.order_id GROUP BY 1""")
def _(t):
    """Lines and orders in buckets of the order key; their join reads both without a shuffle."""
    own = t.bucketed(scratch_folder(t.spark, "bucketed"), f"bucketed_{uuid.uuid4().hex}", buckets=8)
    return own.lines.groupBy("order_date").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("quantity").alias("units"))


@query("sink_csv", "SELECT date, revenue, cogs FROM sales_v")
def _(t):
    path = write_csv(t.sales, scratch_folder(t.spark, "sales-csv"))
    return read_typed_csv(t.spark, path, SCHEMAS["sales"])


@query("sink_stats", """
SELECT round(quantile_cont(revenue, 0.99), 6) AS revenue_p99, round(quantile_cont(revenue, 0.05), 6) AS revenue_p05,
       round(avg(cogs / revenue), 6) AS mean_cogs_ratio FROM sales_v""")
def _(t):
    # Daily rows: a group of at most one row per calendar day.
    stats = t.sales.agg(
        round6(F.percentile("revenue", F.lit(0.99))).alias("revenue_p99"),
        round6(F.percentile("revenue", F.lit(0.05))).alias("revenue_p05"),
        round6(F.avg(ratio("cogs", "revenue"))).alias("mean_cogs_ratio"))
    path = write_stats(stats, scratch_folder(t.spark, "stats"))
    return t.spark.read.schema("revenue_p99 DOUBLE, revenue_p05 DOUBLE, mean_cogs_ratio DOUBLE").json(path)


@query("gen_date_skeleton", """
SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS DATE) AS date FROM orders""")
def _(t):
    return calendar(t.orders.select(F.col("order_date").alias("date")), "date")


