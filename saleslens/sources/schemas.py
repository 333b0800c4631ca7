"""Explicit schemas of the retail tables (no inference on read)."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType,
)

_TYPES = {
    "DATE": DateType(), "DOUBLE": DoubleType(), "INT": IntegerType(), "BIGINT": LongType(), "STRING": StringType(),
    "TIMESTAMP_NTZ": TimestampNTZType(),
}


def _schema(columns: str) -> StructType:
    pairs = [c.split() for c in columns.split(",")]
    return StructType([StructField(name, _TYPES[kind], True) for name, kind in pairs])


SCHEMAS: dict[str, StructType] = {
    "sales": _schema("date DATE, revenue DOUBLE, cogs DOUBLE"),
    "orders": _schema(
        "order_id BIGINT, order_date DATE, customer_id BIGINT, zip INT, order_status STRING, "
        "payment_method STRING, device_type STRING, order_source STRING"),
    "order_items": _schema(
        "order_id BIGINT, product_id BIGINT, quantity INT, unit_price DOUBLE, "
        "discount_amount DOUBLE, promo_id STRING, promo_id_2 STRING"),
    "products": _schema(
        "product_id BIGINT, product_name STRING, category STRING, segment STRING, size STRING, "
        "price DOUBLE, cogs DOUBLE"),
    "inventory": _schema(
        "snapshot_date DATE, product_id BIGINT, category STRING, segment STRING, units_sold BIGINT, "
        "stockout_days INT, fill_rate DOUBLE, stockout_flag INT, sell_through_rate DOUBLE, reorder_flag INT"),
    "returns": _schema(
        "order_id BIGINT, product_id BIGINT, return_date DATE, return_reason STRING, "
        "return_quantity INT, refund_amount DOUBLE"),
    "reviews": _schema("order_id BIGINT, review_date DATE, rating INT"),
    "shipments": _schema("ship_date DATE, delivery_date DATE"),
    "web_traffic": _schema(
        "date DATE, traffic_source STRING, sessions BIGINT, unique_visitors BIGINT, page_views BIGINT, "
        "bounce_rate DOUBLE, avg_session_duration_sec DOUBLE"),
    "customers": _schema(
        "customer_id BIGINT, zip INT, acquisition_channel STRING, age_group STRING"),
    "promotions": _schema(
        "promo_id STRING, promo_name STRING, promo_type STRING, discount_value DOUBLE, "
        "start_date DATE, end_date DATE, stackable_flag INT"),
    "geography": _schema("zip INT, region STRING"),
    "payments": _schema("order_id BIGINT, installments INT, payment_value DOUBLE"),
    "forecast": _schema("date DATE, revenue DOUBLE, cogs DOUBLE"),
}

# The stored star-schema files.  A given schema spares the footer scan that
# inference runs on every read.
STORED: dict[str, StructType] = {
    "region": _schema("r_regionkey INT, r_name STRING"),
    "nation": _schema("n_nationkey INT, n_name STRING, n_regionkey INT"),
    "customer": _schema("c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"),
    "part": _schema(
        "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE"),
    "orders": _schema(
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"),
    "lineitem": _schema(
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
        "l_shipdate TIMESTAMP_NTZ"),
    "events": _schema(
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"),
}
