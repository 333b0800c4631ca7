"""Order money and the enriched line table that most analyses start from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exact_sum
from ..operators.relational import line_margin, line_revenue
from ..sources import Tables

CANCELLED = "cancelled"


def order_money(items: DataFrame) -> DataFrame:
    """Gross and net revenue per order; lines are combined before any join."""
    return line_revenue(items).groupBy("order_id").agg(
        exact_sum("gross_revenue").alias("gross_revenue"), exact_sum("net_revenue").alias("net_revenue"))


def live_orders(orders: DataFrame) -> DataFrame:
    """Orders that were not cancelled."""
    return orders.where(F.col("order_status") != CANCELLED)


def base_lines(t: Tables) -> DataFrame:
    """Lines of live orders with product, year, margins and discount flags."""
    products = t.products.select("product_id", "cogs", "price", "category", "segment")
    lines = live_orders(t.lines).join(products, "product_id")
    return line_margin(lines).withColumn("year", F.year("order_date"))


def orders_with_revenue(t: Tables, orders: DataFrame | None = None) -> DataFrame:
    """Orders left-joined with their gross revenue; orders without lines stay, with NULL."""
    return (orders if orders is not None else t.orders).join(
        order_money(t.items).select("order_id", F.col("gross_revenue").alias("revenue")), "order_id", "left")
