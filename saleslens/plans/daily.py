"""Daily aggregates and the gap-free base table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exact_mean, exact_sum, pct, ratio
from ..operators.joins import calendar, left_chain
from ..operators.relational import line_revenue
from ..operators.windows import forward_fill
from ..sources import Tables
from ..sources.files import materialize


def items_per_order(items: DataFrame) -> DataFrame:
    """Sums and distinct products per order; dealt by order once, which serves both steps of the distinct count."""
    return line_revenue(items).repartition("order_id").groupBy("order_id").agg(
        F.sum("quantity").alias("n_items"),
        exact_sum("net_revenue").alias("gross_revenue"),
        exact_sum("discount_amount").alias("total_discount"),
        F.countDistinct("product_id").alias("n_unique_products"),
    )


def orders_daily(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Lines to orders, orders to days.  A day whose orders have no lines sums to 0."""

    def zero(c):
        return F.coalesce(c, F.lit(0))

    rich = orders.join(items_per_order(items), "order_id", "left")
    n = F.col("n_orders")
    return (
        rich.groupBy(F.col("order_date").alias("date"))
        .agg(
            F.count("order_id").alias("n_orders"),
            zero(F.sum("n_items")).alias("n_items_sold"),
            zero(exact_sum("gross_revenue")).alias("gross_revenue"),
            zero(exact_sum("total_discount")).alias("total_discount"),
            F.countDistinct("customer_id").alias("n_unique_customers"),
            zero(F.sum("n_unique_products")).alias("n_unique_products"),
            F.count_if(F.col("order_status") == "cancelled").alias("_cancelled"),
        )
        .withColumns({"cancelled_rate": ratio("_cancelled", n), "avg_order_value": ratio("gross_revenue", n)})
        .drop("_cancelled")
    )


def returns_daily(returns: DataFrame) -> DataFrame:
    return returns.groupBy(F.col("return_date").alias("date")).agg(
        F.sum("return_quantity").alias("n_returns"), exact_sum("refund_amount").alias("total_refund"))


def reviews_daily(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy(F.col("review_date").alias("date")).agg(
        F.avg("rating").alias("avg_rating"), F.count("rating").alias("n_reviews"))


def shipment_daily(shipments: DataFrame) -> DataFrame:
    return shipments.groupBy(F.col("ship_date").alias("date")).agg(
        F.avg(F.datediff("delivery_date", "ship_date")).alias("avg_delivery_days"))


def traffic_daily(traffic: DataFrame) -> DataFrame:
    return traffic.groupBy("date").agg(
        F.sum("sessions").alias("sessions"), F.sum("unique_visitors").alias("unique_visitors"),
        F.sum("page_views").alias("page_views"), F.avg("bounce_rate").alias("bounce_rate"),
        F.avg("avg_session_duration_sec").alias("avg_session_duration_sec"))


def inventory_snapshots(inventory: DataFrame, keys: list[str] | None = None) -> DataFrame:
    return inventory.groupBy(F.col("snapshot_date").alias("date"), *(keys or [])).agg(
        exact_mean("fill_rate").alias("avg_fill_rate"),
        F.avg("stockout_days").alias("avg_stockout_days"),
        F.avg(F.col("stockout_flag").cast("double")).alias("pct_stockout_skus"),
        F.avg("sell_through_rate").alias("avg_sell_through"),
    )


def product_days(t: Tables, last_known: str | None = None) -> DataFrame:
    """Lines joined with their order once, summed per order day and product.

    Sales, shipments and inventory of the base table all derive from it, so the
    large join of lines and orders is made once.
    """
    raw = t.raw("lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"), F.to_date("l_shipdate").alias("delivery_date"),
        F.col("l_quantity").cast("int").alias("quantity"), F.try_divide("l_extendedprice", "l_quantity").alias("unit_price"))
    orders = t.orders_between(last=last_known).select("order_id", "order_date")
    return raw.join(orders, "order_id").groupBy(F.col("order_date").alias("date"), "product_id").agg(
        exact_sum(F.col("unit_price") * F.col("quantity")).alias("revenue"), F.sum("quantity").alias("quantity"),
        F.sum(F.datediff("delivery_date", "order_date")).alias("delivery_days"), F.count("delivery_date").alias("n_shipped"))


INVENTORY_COLUMNS = ["avg_fill_rate", "avg_stockout_days", "pct_stockout_skus", "avg_sell_through"]


def inventory_daily(inventory: DataFrame, days: DataFrame) -> DataFrame:
    """Snapshots carried forward over the long calendar (one row per day)."""
    joined = days.join(inventory_snapshots(inventory), "date", "left")
    return forward_fill(joined, [], "date", INVENTORY_COLUMNS)


def base_table(t: Tables, last_known: str | None = None, horizon_days: int = 0) -> DataFrame:
    """One row per day: sales and the six other daily aggregates on the skeleton.

    ``horizon_days`` adds future days, on which every observed column is NULL.
    """
    orders = t.orders_between(last=last_known)
    lo_hi = orders.agg(F.min("order_date").alias("date"), F.max("order_date").alias("_hi"))
    ends = lo_hi.select(F.explode(F.array("date", F.date_add("_hi", horizon_days))).alias("date"))
    skeleton = calendar(ends, "date")
    known = calendar(orders.select(F.col("order_date").alias("date")), "date")

    sold = materialize(product_days(t, last_known), "product-days")
    costs = t.products.select("product_id", "cogs", "category", "segment")
    sales = sold.join(costs, "product_id").groupBy("date").agg(
        exact_sum("revenue").alias("revenue"), exact_sum(F.col("quantity") * F.col("cogs")).alias("cogs"))
    shipped = sold.groupBy("date").agg(ratio(F.sum("delivery_days"), F.sum("n_shipped")).alias("avg_delivery_days"))
    stock = t.inventory_of(sold.groupBy(F.last_day("date").alias("snapshot_date"), "product_id").agg(F.sum("quantity").alias("units_sold")))

    def cut(df: DataFrame, date: str) -> DataFrame:
        return df.where(F.col(date) <= F.lit(last_known).cast("date")) if last_known else df

    frames = [
        sales.withColumn("cogs_ratio", ratio("cogs", "revenue")),
        orders_daily(orders, t.items),
        returns_daily(cut(t.returns, "return_date")),
        reviews_daily(cut(t.reviews, "review_date")),
        shipped,
        traffic_daily(cut(t.web_traffic, "date")),
        inventory_daily(cut(stock, "snapshot_date"), known),
    ]
    return left_chain(skeleton, frames, "date")


def conversion_daily(traffic: DataFrame, orders: DataFrame) -> DataFrame:
    """Orders per session by day; days without orders count 0."""
    visits = traffic.groupBy("date").agg(
        F.sum("sessions").alias("total_sessions"), F.sum("unique_visitors").alias("total_visitors"))
    made = orders.groupBy(F.col("order_date").alias("date")).agg(F.countDistinct("order_id").alias("actual_orders"))
    joined = visits.join(made, "date", "left").withColumn("actual_orders", F.coalesce("actual_orders", F.lit(0)))
    return joined.withColumn("conversion_rate", F.coalesce(pct("actual_orders", "total_sessions"), F.lit(0.0)))


def month_totals(df: DataFrame, date: str, values: list[str]) -> DataFrame:
    """Daily rows to calendar months; months without rows are kept as 0."""
    monthly = df.groupBy(F.trunc(date, "month").alias("month")).agg(*[F.sum(v).alias(v) for v in values])
    bounds = monthly.agg(F.min("month").alias("_lo"), F.max("month").alias("_hi"))
    months = bounds.select(F.explode(F.sequence("_lo", "_hi", F.expr("interval 1 month"))).alias("month"))
    return months.join(monthly, "month", "left").withColumns({v: F.coalesce(v, F.lit(0)) for v in values})
