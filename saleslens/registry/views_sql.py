"""The retail views as SQL, for the independent check in DuckDB."""

M = "DECIMAL(18,4)"


def dsum(x: str) -> str:
    """Exact money sum as double."""
    return f"CAST(sum(CAST({x} AS {M})) AS DOUBLE)"


def dmean(x: str) -> str:
    return f"(CAST(sum(CAST({x} AS {M})) AS DOUBLE) / nullif(count({x}), 0))"


VIEWS: dict[str, str] = {
    "orders_v": """
        SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date, o_custkey AS customer_id,
               c_nationkey AS zip,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' WHEN 'P' THEN 'cancelled' END AS order_status,
               o_orderpriority AS payment_method,
               CASE o_orderkey % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END AS device_type,
               CASE o_orderkey % 5 WHEN 0 THEN 'click' WHEN 1 THEN 'view' WHEN 2 THEN 'signup' WHEN 3 THEN 'purchase' ELSE 'error' END AS order_source
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "items_v": """
        SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS INT) AS quantity,
               l_extendedprice / l_quantity AS unit_price, l_extendedprice * l_discount AS discount_amount,
               CASE WHEN l_discount >= 0.06 THEN concat('PR-', CAST(year(o_orderdate) AS VARCHAR), '-', CAST(quarter(o_orderdate) AS VARCHAR)) END AS promo_id,
               CASE WHEN l_discount >= 0.1 AND l_linenumber = 7 THEN 'PR-X' END AS promo_id_2
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "products_v": """
        SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS segment,
               CASE p_size % 4 WHEN 0 THEN 'S' WHEN 1 THEN 'M' WHEN 2 THEN 'L' ELSE 'XL' END AS size,
               p_retailprice AS price, p_retailprice * (50 + (p_size % 10) * 4) / 100 AS cogs
        FROM part""",
    "customers_v": """
        SELECT c_custkey AS customer_id, c_nationkey AS zip, c_mktsegment AS acquisition_channel,
               CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 3000 THEN '18-24' WHEN c_acctbal < 6000 THEN '25-34' ELSE '35+' END AS age_group
        FROM customer""",
    "geography_v": "SELECT n_nationkey AS zip, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey",
    "returns_v": """
        SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_shipdate AS DATE) AS return_date,
               CASE l_linenumber % 5 WHEN 0 THEN 'wrong_size' WHEN 1 THEN 'defective' WHEN 2 THEN 'late_delivery'
                    WHEN 3 THEN 'changed_mind' ELSE 'not_as_described' END AS return_reason,
               CAST(l_quantity AS INT) AS return_quantity, l_extendedprice * (1 - l_discount) AS refund_amount
        FROM lineitem WHERE l_returnflag = 'R'""",
    "shipments_v": """
        SELECT CAST(o_orderdate AS DATE) AS ship_date, CAST(l_shipdate AS DATE) AS delivery_date
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "reviews_v": """
        SELECT event_id AS order_id, CAST(CAST(ts AS DATE) - INTERVAL '24' YEAR AS DATE) AS review_date,
               1 + CAST(floor(value) AS INT) % 5 AS rating
        FROM events WHERE event_type = 'view'""",
    "payments_v": """
        SELECT o_orderkey AS order_id, CAST(1 + o_orderkey % 12 AS INT) AS installments, o_totalprice AS payment_value
        FROM orders""",
    "promotions_v": """
        SELECT concat('PR-', CAST(y AS VARCHAR), '-', CAST(q AS VARCHAR)) AS promo_id,
               concat('Quarter Sale ', CAST(y AS VARCHAR)) AS promo_name,
               CASE WHEN q IN (1, 3) THEN 'fixed' ELSE 'percentage' END AS promo_type,
               CAST(q * 10 AS DOUBLE) AS discount_value,
               CAST(make_date(y, q * 3 - 2, 1) + INTERVAL 30 DAY AS DATE) AS start_date,
               CAST(make_date(y, q * 3 - 2, 1) + INTERVAL 59 DAY AS DATE) AS end_date,
               CASE WHEN q = 4 THEN 1 ELSE 0 END AS stackable_flag
        FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS y, CAST(quarter(o_orderdate) AS INT) AS q FROM orders)""",
    "web_traffic_v": f"""
        SELECT CAST(CAST(ts AS DATE) - INTERVAL '24' YEAR AS DATE) AS date, event_type AS traffic_source,
               count(*) AS sessions, count(DISTINCT user_id) AS unique_visitors, count(*) * 2 AS page_views,
               CAST(sum(CASE WHEN value < 10 THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS bounce_rate,
               {dsum('value')} / count(*) AS avg_session_duration_sec
        FROM events GROUP BY 1, 2""",
    "sales_v": f"""
        SELECT order_date AS date, {dsum('unit_price * quantity')} AS revenue, {dsum('quantity * p.cogs')} AS cogs
        FROM orders_v o JOIN items_v i ON o.order_id = i.order_id JOIN products_v p ON i.product_id = p.product_id
        GROUP BY 1""",
    "inventory_v": """
        SELECT snapshot_date, product_id, category, segment, units_sold,
               CAST((product_id + month(snapshot_date)) % 10 AS INT) AS stockout_days,
               CAST(100 - ((product_id + month(snapshot_date)) % 10) * 3 AS DOUBLE) / 100 AS fill_rate,
               CASE WHEN (product_id + month(snapshot_date)) % 10 > 5 THEN 1 ELSE 0 END AS stockout_flag,
               CAST(units_sold AS DOUBLE) / (units_sold + 50) AS sell_through_rate, 0 AS reorder_flag
        FROM (SELECT CAST(last_day(order_date) AS DATE) AS snapshot_date, i.product_id, category, segment,
                     CAST(sum(quantity) AS BIGINT) AS units_sold
              FROM orders_v o JOIN items_v i ON o.order_id = i.order_id JOIN products_v p ON i.product_id = p.product_id
              GROUP BY 1, 2, 3, 4)""",
    "panel_v": f"""
        SELECT p_type AS series_key, CAST(o_orderdate AS DATE) AS date, {dsum('l_extendedprice')} AS revenue,
               {dsum('l_quantity * (p_retailprice * (50 + (p_size % 10) * 4) / 100)')} AS cogs
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""",
    "order_money_v": f"""
        SELECT order_id, {dsum('unit_price * quantity')} AS gross_revenue,
               {dsum('unit_price * quantity - discount_amount')} AS net_revenue
        FROM items_v GROUP BY 1""",
    "base_lines_v": """
        SELECT i.*, o.order_date, o.customer_id, o.order_status, p.category, p.segment, p.price, p.cogs,
               CAST(year(o.order_date) AS INT) AS year,
               unit_price * quantity AS revenue_line, p.cogs * quantity AS cogs_line, price * quantity AS list_revenue,
               unit_price * quantity - p.cogs * quantity - discount_amount AS gross_profit,
               discount_amount > 0 AS has_promo
        FROM items_v i JOIN orders_v o ON i.order_id = o.order_id JOIN products_v p ON i.product_id = p.product_id
        WHERE order_status <> 'cancelled'""",
    "live_orders_v": "SELECT * FROM orders_v WHERE order_status <> 'cancelled'",
    "promo_days_v": """
        SELECT DISTINCT CAST(unnest(generate_series(start_date, end_date, INTERVAL 1 DAY)) AS DATE) AS date FROM promotions_v""",
}
