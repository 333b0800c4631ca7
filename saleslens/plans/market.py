"""Revenue, margin, region, stock and return analyses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import clip, days_in_month, exact_mean, exact_sum, month_start, pct, ratio, rate_where, sum_where
from ..operators.joins import left_chain
from ..operators.order_stats import exact_quantiles
from ..operators.relational import share_within
from ..operators.windows import change_from_previous
from ..sources import Tables
from ..sources.files import materialize
from .revenue import base_lines, order_money

# Who answers for a return reason.
SYSTEM_FAULT = ["wrong_size", "defective", "late_delivery"]
CUSTOMER_FAULT = ["changed_mind", "not_as_described"]
SOLD_STATUSES = ["delivered", "shipped", "paid"]


# -- single answers -----------------------------------------------------------

def segment_margin(products: DataFrame) -> DataFrame:
    margin = ratio(F.col("price") - F.col("cogs"), "price")
    return products.groupBy("segment").agg(F.round(F.avg(margin), 6).alias("margin"))


def return_reasons(returns: DataFrame, products: DataFrame, category: str) -> DataFrame:
    wanted = products.where(F.col("category") == category).select("product_id")
    return returns.join(wanted, "product_id").groupBy("return_reason").agg(F.count(F.lit(1)).alias("n"))


def revenue_by_region(t: Tables) -> DataFrame:
    money = order_money(t.items).select("order_id", "gross_revenue")
    return t.orders_geo.join(money, "order_id").join(t.geography, "zip").groupBy("region").agg(
        exact_sum("gross_revenue").alias("revenue"))


def return_rate_by_size(t: Tables) -> DataFrame:
    """Return rows per order line by size.  Both are counted per product before the join."""
    size = t.products.select("product_id", "size")

    def per_size(df: DataFrame, name: str) -> DataFrame:
        counted = df.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))
        return counted.join(size, "product_id").groupBy("size").agg(F.sum("n").alias(name))

    both = per_size(t.returns, "returns_count").join(per_size(t.items, "lines_count"), "size", "full")
    return both.withColumn("return_rate", ratio("returns_count", "lines_count"))


# -- yearly and monthly revenue -----------------------------------------------

def yearly_revenue(sales: DataFrame) -> DataFrame:
    """Revenue by year, change in percent, and the peak year."""
    yearly = sales.groupBy(F.year("date").alias("year")).agg(exact_sum("revenue").alias("revenue"))
    out = change_from_previous(yearly, [], "year", "revenue", rate="yoy_growth")
    peak = F.col("revenue") == F.max("revenue").over(W.partitionBy())
    return out.withColumns({"yoy_growth": F.round(F.col("yoy_growth") * 100, 6), "is_peak": peak})


def monthly_index(sales: DataFrame) -> DataFrame:
    """Month revenue over the mean month of its year."""
    monthly = sales.groupBy(F.year("date").alias("year"), F.month("date").alias("month")).agg(
        exact_sum("revenue").alias("monthly_revenue"))
    year = W.partitionBy("year")
    mean = ratio(F.sum(F.col("monthly_revenue").cast("decimal(28,4)")).over(year), F.count(F.lit(1)).over(year))
    return monthly.withColumn("monthly_index", ratio("monthly_revenue", mean))


def monthly_matrix(index: DataFrame, peak: Sequence[int] = (4, 5, 6), low: Sequence[int] = (1, 2, 11, 12)) -> DataFrame:
    """Year x month matrix with the averages of all peak and all low months."""
    wide = index.groupBy("year").pivot("month", list(range(1, 13))).agg(F.max("monthly_index"))
    wide = wide.withColumnsRenamed({str(m): f"m_{m}" for m in range(1, 13)})
    means = index.agg(F.struct(
        F.avg(F.when(F.col("month").isin(list(peak)), F.col("monthly_index"))).alias("p"),
        F.avg(F.when(F.col("month").isin(list(low)), F.col("monthly_index"))).alias("l"))).scalar()
    return wide.withColumn("_m", means).withColumns({
        "peak_avg": F.round("_m.p", 6), "low_avg": F.round("_m.l", 6)}).drop("_m")


def region_share(t: Tables, flag_above: float = 55.0) -> DataFrame:
    """Revenue share of each region by year, with the dominant region of the year."""
    money = order_money(t.items).select("order_id", "gross_revenue")
    per = (
        t.orders_geo.join(t.geography, "zip", "left").join(money, "order_id", "left")
        .where(F.col("region").isNotNull())
        .groupBy(F.year("order_date").alias("year"), "region")
        .agg(F.coalesce(exact_sum("gross_revenue"), F.lit(0.0)).alias("revenue"))
    )
    shares = per.withColumn("pct", pct("revenue", F.sum(F.col("revenue").cast("decimal(28,4)")).over(W.partitionBy("year"))))
    top = F.min_by("region", F.struct(-F.col("pct"), F.col("region"))).over(W.partitionBy("year"))
    return shares.withColumns({
        "dominant_region": top, "is_concentrated": F.max("pct").over(W.partitionBy("year")) > flag_above})


# -- margins ------------------------------------------------------------------

def margin_ratios() -> dict[str, Column]:
    """Ratios of sums over a group of enriched lines."""
    revenue = exact_sum("revenue_line")
    return {
        "margin_rate": ratio(exact_sum("gross_profit"), revenue),
        "cogs_ratio": ratio(exact_sum("cogs_line"), revenue),
        "discount_rate": ratio(exact_sum("discount_amount"), revenue),
    }


def margin_erosion(t: Tables) -> DataFrame:
    """Promotion penetration and margins with and without promotion, by year."""
    promo = F.col("has_promo")

    def margin(cond: Column) -> Column:
        return pct(sum_where("gross_profit", cond), sum_where("revenue_line", cond))

    yearly = base_lines(t).groupBy("year").agg(
        (rate_where(promo) * 100.0).alias("promo_penetration"),
        margin(promo).alias("margin_promo"), margin(~promo).alias("margin_no_promo"))
    yearly = yearly.withColumn("margin_gap", F.col("margin_no_promo") - F.col("margin_promo"))
    # First year with promotions, over one row per year.
    first = F.min_by("margin_gap", F.when(F.col("promo_penetration") > 0, F.col("year"))).over(W.partitionBy())
    return yearly.withColumn("gap_change", F.round(F.col("margin_gap") - first, 6))


def margin_drivers(t: Tables) -> DataFrame:
    units = F.sum("quantity")
    return base_lines(t).groupBy("year").agg(
        *[c.alias(n) for n, c in margin_ratios().items()],
        ratio(exact_sum("revenue_line"), units).alias("avg_selling_price"),
        ratio(exact_sum("list_revenue"), units).alias("avg_list_price"))


def period_compare(t: Tables, last_pre_year: int) -> DataFrame:
    period = F.when(F.col("year") <= last_pre_year, "pre").otherwise("post").alias("period")
    return base_lines(t).groupBy(period).agg(*[c.alias(n) for n, c in margin_ratios().items()])


def segment_mix(t: Tables) -> DataFrame:
    mix = base_lines(t).groupBy("year", "segment").agg(exact_sum("revenue_line").alias("revenue"))
    return share_within(mix.withColumn("_d", F.col("revenue").cast("decimal(28,4)")), "_d", ["year"], "share").drop("_d")


def segment_profile(t: Tables) -> DataFrame:
    return base_lines(t).groupBy("segment").agg(
        ratio(exact_sum("revenue_line"), F.sum("quantity")).alias("avg_price"),
        ratio(exact_sum("gross_profit"), exact_sum("revenue_line")).alias("margin_rate"),
        exact_sum("revenue_line").alias("total_revenue"))


# -- stock --------------------------------------------------------------------

def monthly_sales(sales: DataFrame) -> DataFrame:
    monthly = sales.groupBy(month_start("date").alias("month")).agg(
        exact_sum("revenue").alias("monthly_revenue"), F.count("revenue").alias("n_days"))
    mean = monthly.agg(exact_mean("monthly_revenue")).scalar()
    return monthly.withColumns({
        "avg_daily_revenue": ratio("monthly_revenue", "n_days"), "revenue_index": ratio("monthly_revenue", mean)})


def stockout_lost_revenue(t: Tables, split: int = 4) -> DataFrame:
    """Mean stockout days per month and category, priced at an equal split of daily revenue."""
    inv = t.inventory.groupBy(month_start("snapshot_date").alias("month"), "category").agg(
        F.avg("stockout_days").alias("avg_stockout_days"), F.countDistinct("product_id").alias("n_products"))
    joined = inv.join(monthly_sales(t.revenue_by_day), "month", "left")
    return joined.withColumns({
        "year": F.year("month"), "month_num": F.month("month"),
        "est_lost_revenue": F.col("avg_stockout_days") * (F.col("avg_daily_revenue") / split)})


def worst_stockout_month(lost: DataFrame, years: Sequence[int]) -> DataFrame:
    """Month number with the highest mean stockout days per category; ties go to the earlier month."""
    per = lost.where(F.col("year").isin(list(years))).groupBy("category", "month_num").agg(
        F.avg("avg_stockout_days").alias("days"))
    rounded = per.withColumn("days", F.round("days", 6))
    return rounded.groupBy("category").agg(
        F.min_by("month_num", F.struct(-F.col("days"), F.col("month_num"))).alias("worst_month"), F.max("days").alias("worst_days"))


def buffer_stock(t: Tables, season_months: Sequence[int] = (3, 4, 5), lead_days: int = 14, safety_days: int = 7) -> DataFrame:
    """Units to hold per category for lead and safety time, scaled by the season index."""
    daily = ratio("units_sold", days_in_month("snapshot_date"))
    per = t.inventory.groupBy("category").agg(F.avg(daily).alias("avg_daily_units"))
    season = stockout_lost_revenue(t).where(F.col("month_num").isin(list(season_months))).agg(F.avg("revenue_index")).scalar()
    units = F.col("avg_daily_units") * (lead_days + safety_days)
    return per.withColumn("buffer_units", units).withColumn("_season", season).select(
        "category", F.round("avg_daily_units", 6).alias("avg_daily_units"), F.round("buffer_units", 6).alias("buffer_units"),
        F.round(F.col("buffer_units") * F.col("_season"), 0).cast("bigint").alias("season_buffer_units"))


# -- returns ------------------------------------------------------------------

def product_return_margin(t: Tables, min_units: int = 10) -> DataFrame:
    """Return rate, margin, refund cost and net margin per product with enough sales."""
    sold_orders = t.orders.where(F.col("order_status").isin(SOLD_STATUSES)).select("order_id")
    sold = t.items.join(sold_orders, "order_id", "left_semi").groupBy("product_id").agg(
        F.sum("quantity").alias("units_sold"), exact_sum(F.col("unit_price") * F.col("quantity")).alias("gross_revenue"))
    returned = t.returns.groupBy("product_id").agg(
        F.sum("return_quantity").alias("units_returned"), exact_sum("refund_amount").alias("total_refund"))
    joined = left_chain(t.products.select("product_id", "category", "price", "cogs"), [sold, returned], "product_id").fillna(
        0, subset=["units_sold", "gross_revenue", "units_returned", "total_refund"])
    return (
        joined.withColumns({
            "return_rate": ratio("units_returned", clip("units_sold", lower=1)),
            "margin_rate": ratio(F.col("price") - F.col("cogs"), clip("price", lower=0.01)),
            "return_cost_rate": ratio("total_refund", clip("gross_revenue", lower=0.01)),
        })
        .withColumn("net_margin", F.col("margin_rate") - F.col("return_cost_rate"))
        .where(F.col("units_sold") >= min_units)
    )


def category_medians(products: DataFrame) -> DataFrame:
    """Exact medians of margin and return rate per category, from one pass over both metrics."""
    long = products.select("category", F.explode(F.array(
        F.struct(F.lit("margin").alias("k"), F.col("margin_rate").alias("v")),
        F.struct(F.lit("return").alias("k"), F.col("return_rate").alias("v")))).alias("m")).select("category", "m.k", "m.v")
    medians = exact_quantiles(long, ["category", "k"], "v", {"median": 0.5})
    return medians.groupBy("category").agg(
        F.max(F.when(F.col("k") == "margin", F.col("median"))).alias("margin_median"),
        F.max(F.when(F.col("k") == "return", F.col("median"))).alias("return_median"))


def quadrants(products: DataFrame) -> DataFrame:
    """High or low margin and return rate against the medians of the category."""
    products = materialize(products, "product-metrics")
    joined = products.join(category_medians(products), "category")
    high_m, high_r = F.col("margin_rate") >= F.col("margin_median"), F.col("return_rate") >= F.col("return_median")
    return joined.withColumn(
        "quadrant", F.when(high_m & ~high_r, "HM_LR").when(high_m & high_r, "HM_HR").when(high_r, "LM_HR").otherwise("LM_LR"))


def quadrant_summary(quads: DataFrame) -> DataFrame:
    return quads.groupBy("category", "quadrant").agg(
        F.count("product_id").alias("n"), exact_sum("gross_revenue").alias("total_rev"), exact_sum("total_refund").alias("total_refund"),
    ).withColumn("refund_pct", pct("total_refund", "total_rev"))


def reason_mix(t: Tables) -> DataFrame:
    """Return reasons overall, by category, by quadrant and by both, as a share of each cell.

    Rows are counted once at the finest grain; the four views come from those
    few counts.
    """
    quads = quadrants(product_return_margin(t)).select("product_id", "quadrant")
    per_product = t.returns.groupBy("product_id", "return_reason").agg(F.count(F.lit(1)).alias("n"))
    tagged = per_product.join(t.products.select("product_id", "category"), "product_id", "left").join(quads, "product_id", "left")
    fine = tagged.groupBy("category", "quadrant", "return_reason").agg(F.sum("n").alias("n"))
    cell = F.concat_ws("|", "category", "quadrant")
    both = F.when(F.col("category").isNotNull() & F.col("quadrant").isNotNull(), cell)
    views = F.array(*[
        F.struct(F.lit(grain).alias("grain"), value.alias("cell")) for grain, value in (
            ("all", F.lit("all")), ("category", F.col("category")), ("quadrant", F.col("quadrant")), ("both", both))])
    long = fine.withColumn("v", F.explode(views)).where(F.col("v.cell").isNotNull())
    counts = long.groupBy(F.col("v.grain").alias("grain"), F.col("v.cell").alias("cell"), "return_reason").agg(F.sum("n").alias("n"))
    return counts.withColumn("pct", pct("n", F.sum("n").over(W.partitionBy("grain", "cell"))))


def blame_summary(returns: DataFrame) -> DataFrame:
    """Returns and refunds by who answers for the reason."""
    blame = F.when(F.col("return_reason").isin(SYSTEM_FAULT), "system").when(
        F.col("return_reason").isin(CUSTOMER_FAULT), "customer").otherwise("other").alias("blame")
    out = returns.groupBy(blame).agg(F.count(F.lit(1)).alias("n"), exact_sum("refund_amount").alias("refund"))
    return out.withColumn("pct", pct("n", F.sum("n").over(W.partitionBy())))
