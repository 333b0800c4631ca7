"""The retail tables as lazy views over the star-schema parquet files.

Each property builds a fresh logical plan; nothing is read until an action.
``items`` needs no join, ``lines`` is the same rows with their order, so a job
takes the narrower one where the order is not needed.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exact_sum, map_values, shift_years
from .files import materialize, write_bucketed
from .schemas import STORED

# Labels of the derived columns.
ORDER_STATUS = {"F": "delivered", "O": "shipped", "P": "cancelled"}
DEVICES = {0: "mobile", 1: "desktop", 2: "tablet"}
ORDER_SOURCES = {0: "click", 1: "view", 2: "signup", 3: "purchase", 4: "error"}
SIZES = {0: "S", 1: "M", 2: "L", 3: "XL"}
RETURN_REASONS = {0: "wrong_size", 1: "defective", 2: "late_delivery", 3: "changed_mind", 4: "not_as_described"}

# Event timestamps are moved back so that traffic days meet order days.
TRAFFIC_YEARS_BACK = 24


class Tables:
    """Views over one data folder."""

    def __init__(self, spark: SparkSession, folder: str, tables: dict[str, str] | None = None):
        """``tables`` names tables of the catalog, bucketed ones say, that stand in for files of the folder."""
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._tables = dict(tables or {})
        self._stored: dict[str, DataFrame] = {}

    def stored(self, name: str) -> DataFrame:
        """A view written once to the shared folder, for jobs that read it several times.

        Meant for aggregates that are much smaller than the facts behind them
        (daily sales, the panel, the campaign list).
        """
        if name not in self._stored:
            self._stored[name] = materialize(getattr(self, name), name)
        return self._stored[name]

    def bucketed(self, path: str, prefix: str, buckets: int) -> Tables:
        """The same tables with lines and orders written in buckets of the order key, so that their join needs no shuffle."""
        keys = {"lineitem": "l_orderkey", "orders": "o_orderkey"}
        written = {n: write_bucketed(self.raw(n), f"{path}/{n}", f"{prefix}_{n}", key, buckets) for n, key in keys.items()}
        return Tables(self.spark, self.folder, written)

    def raw(self, name: str) -> DataFrame:
        if name in self._tables:
            return self.spark.table(self._tables[name])
        return self.spark.read.schema(STORED[name]).parquet(f"{self.folder}/{name}.parquet")

    # -- orders and lines -------------------------------------------------
    def _orders(self, raw: DataFrame) -> DataFrame:
        return raw.select(
            F.col("o_orderkey").alias("order_id"),
            F.to_date("o_orderdate").alias("order_date"),
            F.col("o_custkey").alias("customer_id"),
            map_values("o_orderstatus", ORDER_STATUS).alias("order_status"),
            F.col("o_orderpriority").alias("payment_method"),
            map_values(F.col("o_orderkey") % 3, DEVICES).alias("device_type"),
            map_values(F.col("o_orderkey") % 5, ORDER_SOURCES).alias("order_source"),
        )

    @property
    def orders(self) -> DataFrame:
        """Orders without the zip of the customer (no join)."""
        return self._orders(self.raw("orders"))

    def orders_between(self, first: str | None = None, last: str | None = None) -> DataFrame:
        """Orders of a day range, both ends included.

        The bounds are put on the stored timestamp, not on the derived date, so
        they reach the parquet reader and prune row groups.
        """
        raw = self.raw("orders")
        if first:
            raw = raw.where(F.col("o_orderdate") >= F.lit(_midnight(first)).cast("timestamp_ntz"))
        if last:
            raw = raw.where(F.col("o_orderdate") < F.lit(_midnight(last, 1)).cast("timestamp_ntz"))
        return self._orders(raw)

    @property
    def orders_geo(self) -> DataFrame:
        """Orders with the zip of their customer."""
        return self.with_zip(self.orders)

    def with_zip(self, orders: DataFrame) -> DataFrame:
        zips = self.raw("customer").select(F.col("c_custkey").alias("customer_id"), F.col("c_nationkey").alias("zip"))
        return orders.join(zips, "customer_id", "inner")

    def _item_columns(self) -> list:
        return [
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.try_divide("l_extendedprice", "l_quantity").alias("unit_price"),
            (F.col("l_extendedprice") * F.col("l_discount")).alias("discount_amount"),
            (F.col("l_discount") >= 0.06).alias("has_promo_id"),
            ((F.col("l_discount") >= 0.1) & (F.col("l_linenumber") == 7)).alias("has_promo_id_2"),
        ]

    @property
    def items(self) -> DataFrame:
        """Order lines with promotion flags but without promotion ids (no join)."""
        return self.raw("lineitem").select(*self._item_columns())

    @property
    def lines(self) -> DataFrame:
        """Order lines with promotion ids and the columns of their order."""
        promo = F.concat(
            F.lit("PR-"), F.year("order_date").cast("string"), F.lit("-"), F.quarter("order_date").cast("string"))
        return (
            self.items.join(self.orders, "order_id", "inner")
            .withColumn("promo_id", F.when(F.col("has_promo_id"), promo))
            .withColumn("promo_id_2", F.when(F.col("has_promo_id_2"), F.lit("PR-X")))
            .drop("has_promo_id", "has_promo_id_2")
        )

    # -- dimensions -------------------------------------------------------
    @property
    def products(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("segment"),
            map_values(F.col("p_size") % 4, SIZES).alias("size"),
            F.col("p_retailprice").alias("price"),
            (F.col("p_retailprice") * (50 + (F.col("p_size") % 10) * 4) / 100).alias("cogs"),
        )

    @property
    def age_group(self) -> Column:
        """The label of a stored customer."""
        balance = F.col("c_acctbal")
        return F.when(balance < 0, F.lit(None).cast("string")).when(balance < 3000, "18-24").when(balance < 6000, "25-34").otherwise("35+")

    @property
    def customers(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_nationkey").alias("zip"),
            F.col("c_mktsegment").alias("acquisition_channel"),
            self.age_group.alias("age_group"),
        )

    @property
    def geography(self) -> DataFrame:
        nation = self.raw("nation").select(F.col("n_nationkey").alias("zip"), F.col("n_regionkey").alias("r_regionkey"))
        return nation.join(self.raw("region"), "r_regionkey").select("zip", F.col("r_name").alias("region"))

    @property
    def promotions(self) -> DataFrame:
        """One campaign per order quarter; grows with the months of trade, not with the rows."""
        start = F.make_date(F.col("y"), F.col("q") * 3 - 2, F.lit(1))
        quarters = self.raw("orders").select(
            F.year("o_orderdate").alias("y"), F.quarter("o_orderdate").alias("q")).distinct()
        return quarters.select(
            F.concat(F.lit("PR-"), F.col("y").cast("string"), F.lit("-"), F.col("q").cast("string")).alias("promo_id"),
            F.concat(F.lit("Quarter Sale "), F.col("y").cast("string")).alias("promo_name"),
            F.when(F.col("q").isin(1, 3), "fixed").otherwise("percentage").alias("promo_type"),
            (F.col("q") * 10).cast("double").alias("discount_value"),
            F.date_add(start, 30).alias("start_date"),
            F.date_add(start, 59).alias("end_date"),
            F.when(F.col("q") == 4, 1).otherwise(0).alias("stackable_flag"),
        )

    # -- facts ------------------------------------------------------------
    @property
    def returns(self) -> DataFrame:
        return self.raw("lineitem").where(F.col("l_returnflag") == "R").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.to_date("l_shipdate").alias("return_date"),
            map_values(F.col("l_linenumber") % 5, RETURN_REASONS).alias("return_reason"),
            F.col("l_quantity").cast("int").alias("return_quantity"),
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("refund_amount"),
        )

    @property
    def shipments(self) -> DataFrame:
        ordered = self.raw("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.to_date("o_orderdate").alias("ship_date"))
        lines = self.raw("lineitem").select("l_orderkey", F.to_date("l_shipdate").alias("delivery_date"))
        return lines.join(ordered, "l_orderkey").select("ship_date", "delivery_date")

    def _event_day(self):
        return shift_years(F.to_date("ts"), -TRAFFIC_YEARS_BACK)

    @property
    def reviews(self) -> DataFrame:
        return self.raw("events").where(F.col("event_type") == "view").select(
            F.col("event_id").alias("order_id"),
            self._event_day().alias("review_date"),
            (1 + F.floor("value").cast("int") % 5).alias("rating"),
        )

    @property
    def payments(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("order_id"),
            (1 + F.col("o_orderkey") % 12).cast("int").alias("installments"),
            F.col("o_totalprice").alias("payment_value"),
        )

    @property
    def web_traffic(self) -> DataFrame:
        events = self.raw("events").select(
            self._event_day().alias("date"), F.col("event_type").alias("traffic_source"), "user_id", "value")
        n = F.count(F.lit(1))
        return events.groupBy("date", "traffic_source").agg(
            n.alias("sessions"),
            F.countDistinct("user_id").alias("unique_visitors"),
            (n * 2).alias("page_views"),
            F.try_divide(F.count_if(F.col("value") < 10).cast("double"), n).alias("bounce_rate"),
            F.try_divide(exact_sum("value"), n).alias("avg_session_duration_sec"),
        )

    # -- derived facts ----------------------------------------------------
    @property
    def sales(self) -> DataFrame:
        """Revenue and cost of goods per order day."""
        costs = self.products.select("product_id", "cogs")
        return (
            self.lines.join(costs, "product_id")
            .groupBy(F.col("order_date").alias("date"))
            .agg(
                exact_sum(F.col("unit_price") * F.col("quantity")).alias("revenue"),
                exact_sum(F.col("quantity") * F.col("cogs")).alias("cogs"),
            )
        )

    @property
    def revenue_by_day(self) -> DataFrame:
        """The revenue of ``sales`` without its join to the products.

        Every line has a product (a foreign key that ``dq_fk_integrity`` checks),
        so jobs that need no cost take this.
        """
        return self.lines.groupBy(F.col("order_date").alias("date")).agg(
            exact_sum(F.col("unit_price") * F.col("quantity")).alias("revenue"))

    @property
    def sold_products(self) -> DataFrame:
        """Per order day and product: lines, units, revenue, cost, and lines with a promotion; ``known`` if the product exists."""
        costs = self.products.select("product_id", F.col("cogs").alias("cost"), F.lit(True).alias("known"))
        return (
            self.lines.join(costs, "product_id", "left").groupBy("order_date", "product_id").agg(
                F.count(F.lit(1)).alias("n"), F.coalesce(F.max("known"), F.lit(False)).alias("known"), F.sum("quantity").alias("quantity"),
                exact_sum(F.col("unit_price") * F.col("quantity")).alias("revenue"), exact_sum(F.col("quantity") * F.col("cost")).alias("cogs"),
                F.count("promo_id").alias("n_promo"), F.count("promo_id_2").alias("n_promo_2")))

    @property
    def inventory(self) -> DataFrame:
        """Month-end snapshot per product."""
        sold = (
            self.lines.groupBy(F.last_day("order_date").alias("snapshot_date"), "product_id")
            .agg(F.sum("quantity").alias("units_sold"))
        )
        return self.inventory_of(sold)

    def inventory_of(self, sold: DataFrame) -> DataFrame:
        """Snapshot columns for units sold per month end and product."""
        stockout = ((F.col("product_id") + F.month("snapshot_date")) % 10).cast("int")
        return (
            sold.join(self.products.select("product_id", "category", "segment"), "product_id")
            .withColumn("stockout_days", stockout)
            .select(
                "snapshot_date", "product_id", "category", "segment", "units_sold", "stockout_days",
                ((100 - F.col("stockout_days") * 3).cast("double") / 100).alias("fill_rate"),
                F.when(F.col("stockout_days") > 5, 1).otherwise(0).alias("stockout_flag"),
                (F.col("units_sold").cast("double") / (F.col("units_sold") + 50)).alias("sell_through_rate"),
                F.lit(0).alias("reorder_flag"),
            )
        )

    @property
    def panel(self) -> DataFrame:
        """Daily revenue and cost per category: the series of the forecasts."""
        lines = self.raw("lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
        orders = self.raw("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.to_date("o_orderdate").alias("date"))
        costs = self.products.select(F.col("product_id").alias("l_partkey"), F.col("category").alias("series_key"), "cogs")
        return (
            lines.join(orders, "l_orderkey").join(costs, "l_partkey")
            .groupBy("series_key", "date")
            .agg(
                exact_sum("l_extendedprice").alias("revenue"),
                exact_sum(F.col("l_quantity") * F.col("cogs")).alias("cogs"),
            )
        )


def _midnight(text: str, plus_days: int = 0) -> str:
    return (dt.date.fromisoformat(text) + dt.timedelta(days=plus_days)).isoformat() + " 00:00:00"
