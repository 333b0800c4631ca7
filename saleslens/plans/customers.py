"""Customer analyses: cohorts, retention, concentration, channels.

Raw orders of one customer are never gathered in one task.  They are reduced to
customer days, to a first order, or to counts before anything is joined or
ordered per customer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exact_mean, exact_sum, months_between_periods, pct, rate_where, ratio
from ..operators.joins import days_in_any, member_flag, range_pairs
from ..operators.order_stats import exact_quantiles, top_fraction
from ..operators.relational import dedup_first
from ..operators.windows import change_from_previous, day_gaps, first_event
from ..sources import Tables
from ..sources.files import materialize
from .revenue import base_lines, live_orders, order_money, orders_with_revenue


def first_orders(orders: DataFrame) -> DataFrame:
    return first_event(orders, "customer_id", "order_date", "order_id")


def promo_order_ids(t: Tables, rule: str) -> DataFrame:
    """Orders that used a promotion: ``promo_id``, ``any_id``, ``discount`` or ``either``."""
    rules = {
        "promo_id": F.col("has_promo_id"),
        "any_id": F.col("has_promo_id") | F.col("has_promo_id_2"),
        "discount": F.col("discount_amount") > 0,
        "either": F.col("has_promo_id") | (F.col("discount_amount") > 0),
    }
    return t.items.where(rules[rule]).select("order_id").distinct()


def cohort_by_first_order(t: Tables, orders: DataFrame, rule: str = "any_id") -> DataFrame:
    """First orders with ``is_promo``: the first order used a promotion."""
    firsts = first_orders(orders)
    ids = promo_order_ids(t, rule).withColumnRenamed("order_id", "first_order_id")
    return member_flag(firsts, ids, "first_order_id", "is_promo")


def cohort_by_campaign_day(t: Tables, orders: DataFrame) -> DataFrame:
    """First orders with ``is_promo``: the first order day lies in a campaign."""
    days = days_in_any(t.stored("promotions"), "start_date", "end_date", "first_order_date")
    return member_flag(first_orders(orders), days, "first_order_date", "is_promo")


def inter_order_gap_median(orders: DataFrame) -> DataFrame:
    """Median days between active days of a customer.

    Gaps are whole days, so counting them per length bounds the median's input
    by the length of the calendar.
    """
    gaps = day_gaps(orders, "customer_id", "order_date").where(F.col("gap_days").isNotNull())
    counted = gaps.groupBy("gap_days").agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(F.percentile("gap_days", F.lit(0.5), F.col("n")).alias("median_gap_days"))


def orders_per_customer_by_age(customers: DataFrame, orders: DataFrame) -> DataFrame:
    per_customer = orders.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
    joined = customers.where(F.col("age_group").isNotNull()).join(per_customer, "customer_id", "left")
    return joined.groupBy("age_group").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_orders"), F.count("customer_id").alias("n_customers"),
    ).withColumn("orders_per_customer", ratio("n_orders", "n_customers"))


def customer_year_revenue(t: Tables, years: Sequence[int] | None = None) -> DataFrame:
    """Revenue per year and customer; NULL for customers whose orders have no lines.

    The span of the asked years prunes the order files.
    """
    orders = t.orders_between(f"{min(years)}-01-01", f"{max(years)}-12-31") if years else t.orders
    return orders_with_revenue(t, orders).groupBy(F.year("order_date").alias("year"), "customer_id").agg(
        exact_sum("revenue").alias("revenue"))


def revenue_concentration(t: Tables, fraction: float = 0.1) -> DataFrame:
    """Share of the top customers in the revenue of each year."""
    # Read twice: for the totals and for the thresholds.
    spend = materialize(customer_year_revenue(t).withColumn("revenue", F.coalesce("revenue", F.lit(0.0))), "spend")
    total = spend.groupBy("year").agg(F.count(F.lit(1)).alias("n_customers"), exact_sum("revenue").alias("total_revenue"))
    top = top_fraction(spend, ["year"], "revenue", "customer_id", fraction).groupBy("year").agg(
        F.count(F.lit(1)).alias("n_top"), exact_sum("revenue").alias("top_revenue"))
    return total.join(top, "year", "left").withColumns({
        "n_top": F.coalesce("n_top", F.lit(0)), "top_share": ratio("top_revenue", "total_revenue")})


def top_customers_lost(t: Tables, year: int, fraction: float = 0.1) -> DataFrame:
    """Top customers of a year without any order in the next year."""
    spend = customer_year_revenue(t, [year]).withColumn("revenue", F.coalesce("revenue", F.lit(0.0)))
    top = top_fraction(spend, ["year"], "revenue", "customer_id", fraction)
    later = t.orders_between(f"{year + 1}-01-01", f"{year + 1}-12-31").select("customer_id")
    return top.join(later, "customer_id", "left_anti").select("customer_id")


def top_customer_churn(t: Tables, years: Sequence[int], fraction: float = 0.1) -> DataFrame:
    """Per year: how many of its top customers did not order in the next year."""
    spend = customer_year_revenue(t, years).withColumn("revenue", F.coalesce("revenue", F.lit(0.0)))
    top = top_fraction(spend.where(F.col("year").isin(list(years))), ["year"], "revenue", "customer_id", fraction)
    later = t.orders.select((F.year("order_date") - 1).alias("year"), "customer_id").distinct().withColumn("kept", F.lit(1))
    joined = top.join(later, ["year", "customer_id"], "left")
    return joined.groupBy("year").agg(
        F.count(F.lit(1)).alias("n_top"), F.count_if(F.col("kept").isNull()).alias("n_lost"),
    ).withColumn("churn_rate", ratio("n_lost", "n_top"))


def yearly_kpis(t: Tables) -> DataFrame:
    """Customers, orders, orders per customer, order value and their yearly changes."""
    per_year = t.orders.groupBy(F.year("order_date").alias("year")).agg(
        F.countDistinct("customer_id").alias("customers"), F.count("order_id").alias("orders_cnt"))  # order_id is the key
    revenue = t.revenue_by_day.groupBy(F.year("date").alias("year")).agg(exact_sum("revenue").alias("revenue"))
    out = per_year.join(revenue, "year", "left").withColumns({
        "opc": ratio("orders_cnt", "customers"), "aov": ratio("revenue", "orders_cnt")})
    for c in ("customers", "opc", "aov"):
        out = change_from_previous(out, [], "year", c, rate=f"{c}_yoy")
        out = out.withColumn(f"{c}_yoy", F.round(F.col(f"{c}_yoy") * 100, 6))
    return out


def region_orders_per_customer(t: Tables, years: Sequence[int]) -> DataFrame:
    """Orders per customer by region and year, wide, with the drop from the first year."""
    geo = dedup_first(t.geography, ["zip"], [F.col("region")])
    span = t.orders_between(f"{min(years)}-01-01", f"{max(years)}-12-31")
    per = (
        t.with_zip(span).withColumn("year", F.year("order_date")).where(F.col("year").isin(list(years)))
        .join(geo, "zip", "left").where(F.col("region").isNotNull())
        .groupBy("year", "region")
        .agg(F.countDistinct("customer_id").alias("c"), F.count("order_id").alias("o"))
        .withColumn("opc", ratio("o", "c"))
    )
    wide = per.groupBy("region").pivot("year", list(years)).agg(F.max("opc"))
    wide = wide.withColumnsRenamed({str(y): f"opc_{y}" for y in years})
    first = F.col(f"opc_{years[0]}")
    return wide.withColumns({
        f"drop_{y}": F.round(ratio(F.col(f"opc_{y}") - first, first) * 100, 6) for y in years[1:]})


def channel_metrics(t: Tables, repeat_days: int = 180) -> DataFrame:
    """Per acquisition channel: customers, revenue, repeat rate, mean gap, return rate.

    The mean gap needs no ordering: the gaps of a customer sum to last minus
    first order date, and there is one gap less than orders.
    """
    channel = t.customers.select("customer_id", "acquisition_channel").where(F.col("acquisition_channel").isNotNull())
    returned = t.returns.select("order_id").distinct()
    orders = member_flag(orders_with_revenue(t), returned, "order_id", "is_returned")
    # Customer days first: the join with the first date never sees raw orders.
    days = orders.groupBy("customer_id", "order_date").agg(
        F.count(F.lit(1)).alias("n"), exact_sum("revenue").alias("revenue"), F.count_if("is_returned").alias("r"))
    first = days.groupBy("customer_id").agg(F.min("order_date").alias("first_date"))
    early = F.datediff("order_date", "first_date") <= repeat_days
    per_customer = days.join(first, "customer_id").groupBy("customer_id").agg(
        F.sum("n").alias("n_orders"),
        exact_sum("revenue").alias("revenue"),
        F.sum(F.when(early, F.col("n"))).alias("n_early"),
        F.datediff(F.max("order_date"), F.min("order_date")).alias("span_days"),
        F.sum("r").alias("n_returned"),
    )
    return (
        per_customer.join(channel, "customer_id").groupBy("acquisition_channel")
        .agg(
            F.count(F.lit(1)).alias("customers_count"),
            exact_sum("revenue").alias("total_revenue"),
            F.count_if(F.col("n_early") >= 2).alias("_repeat"),
            F.sum("span_days").alias("_span"),
            F.sum(F.col("n_orders") - 1).alias("_gaps"),
            F.sum("n_returned").alias("_returned"),
            F.sum("n_orders").alias("_orders"),
        )
        .select(
            "acquisition_channel", "customers_count", "total_revenue",
            ratio("total_revenue", "customers_count").alias("revenue_per_customer"),
            pct("_repeat", "customers_count").alias("retention_rate"),
            ratio("_span", "_gaps").alias("avg_inter_order_gap"),
            pct("_returned", "_orders").alias("return_rate"),
        )
    )


def cohort_retention(orders: DataFrame, max_months: int = 12) -> DataFrame:
    """Share of each first-month cohort active k months later, long form.

    Orders shrink to distinct customer months first, so a customer has at most
    one row per month of the calendar.
    """
    months = orders.select("customer_id", F.trunc("order_date", "month").alias("order_month")).distinct()
    cohort = months.groupBy("customer_id").agg(F.min("order_month").alias("cohort_month"))
    k = months_between_periods("order_month", "cohort_month")
    active = (
        months.join(cohort, "customer_id").withColumn("month_number", k)
        .where(F.col("month_number") <= max_months)
        .groupBy("cohort_month", "month_number").agg(F.count(F.lit(1)).alias("active_customers"))
    )
    size = active.where(F.col("month_number") == 0).select("cohort_month", F.col("active_customers").alias("cohort_size"))
    return active.join(size, "cohort_month").withColumn("retention_rate", pct("active_customers", "cohort_size"))


def retention_matrix(long: DataFrame, max_months: int = 12) -> DataFrame:
    """Cohorts as rows, M+1 .. M+k as columns; NULL where a cohort was not active."""
    wide = long.where(F.col("month_number") >= 1).groupBy("cohort_month").pivot(
        "month_number", list(range(1, max_months + 1))).agg(F.max("retention_rate"))
    return wide.withColumnsRenamed({str(m): f"m_{m}" for m in range(1, max_months + 1)})


def retention_by_year(matrix: DataFrame, max_months: int = 12) -> DataFrame:
    """Median over the (at most twelve) cohorts of a year."""
    return matrix.groupBy(F.year("cohort_month").alias("cohort_year")).agg(
        *[F.round(F.median(f"m_{m}"), 6).alias(f"m_{m}") for m in range(1, max_months + 1)])


def new_vs_repeat(t: Tables) -> DataFrame:
    """Revenue and orders of first and of repeat orders by year."""
    orders = orders_with_revenue(t)
    firsts = first_orders(t.orders).select(F.col("first_order_id").alias("order_id"))
    flagged = member_flag(orders, firsts, "order_id", "is_new").withColumn("year", F.year("order_date"))
    new = F.col("is_new")
    out = flagged.groupBy("year").agg(
        F.coalesce(exact_sum(F.when(new, F.col("revenue"))), F.lit(0.0)).alias("new_revenue"),
        F.coalesce(exact_sum(F.when(~new, F.col("revenue"))), F.lit(0.0)).alias("repeat_revenue"),
        F.count_if(new).alias("new_orders"), F.count_if(~new).alias("repeat_orders"))
    total = F.col("new_revenue") + F.col("repeat_revenue")
    return out.withColumns({"pct_new": pct("new_revenue", total), "pct_repeat": pct("repeat_revenue", total)})


def channel_conversion(t: Tables) -> DataFrame:
    """Sessions joined with orders of the same day and source; rates by year."""
    made = orders_with_revenue(t).groupBy(
        F.col("order_date").alias("date"), F.col("order_source").alias("traffic_source")).agg(
        F.count("order_id").alias("orders_count"), exact_sum("revenue").alias("revenue"))
    joined = t.web_traffic.select("date", "traffic_source", "sessions").join(made, ["date", "traffic_source"], "left")
    return joined.groupBy(F.year("date").alias("year")).agg(
        F.sum("sessions").alias("sessions"), F.coalesce(F.sum("orders_count"), F.lit(0)).alias("orders_count"),
        F.coalesce(exact_sum("revenue"), F.lit(0.0)).alias("revenue"),
    ).withColumns({"conversion_rate": pct("orders_count", "sessions"), "revenue_per_session": ratio("revenue", "sessions")})


def period_retention(
    orders: DataFrame, cohorts: DataFrame, months: Sequence[int], window_days: int = 15, month_days: int | None = None,
    min_customers: int = 10,
) -> DataFrame:
    """Share of customers with an order within +-window days of N months after the first.

    Only customers whose target date is not after the last order date count, and
    a cohort needs ``min_customers`` of them.  ``month_days`` switches from
    calendar months to fixed month lengths.
    """
    last_date = orders.agg(F.max("order_date")).scalar()
    first = F.col("first_order_date")

    def target(m: int) -> Column:
        return F.date_add(first, m * month_days) if month_days else F.add_months(first, m)

    # One pass over distinct customer days decides all months at once.
    days = orders.select("customer_id", "order_date").distinct()
    after = days.join(cohorts.select("customer_id", "first_order_date"), "customer_id").where(F.col("order_date") > first)
    hits = after.groupBy("customer_id").agg(*[
        F.bool_or(F.abs(F.datediff("order_date", target(m))) <= window_days).alias(f"_hit_{m}") for m in months])
    joined = cohorts.join(hits, "customer_id", "left").withColumn("_last", last_date)
    per_month = joined.withColumn("m", F.explode(F.array(*[
        F.struct(F.lit(m).alias("month_number"), (target(m) <= F.col("_last")).alias("eligible"),
                 F.coalesce(f"_hit_{m}", F.lit(False)).alias("hit")) for m in months])))
    counts = per_month.where(F.col("m.eligible")).groupBy(F.col("m.month_number").alias("month_number"), "is_promo").agg(
        F.count(F.lit(1)).alias("n_eligible"), F.count_if(F.col("m.hit")).alias("n_retained"))
    return counts.withColumn(
        "retention_rate", F.when(F.col("n_eligible") >= min_customers, pct("n_retained", "n_eligible")))


def retention_gap(long: DataFrame) -> DataFrame:
    """Organic minus promo retention per month, and whether the gap never narrows."""
    wide = long.groupBy("month_number").agg(
        F.max(F.when(F.col("is_promo"), F.col("retention_rate"))).alias("promo_rate"),
        F.max(F.when(~F.col("is_promo"), F.col("retention_rate"))).alias("organic_rate"))
    gaps = wide.withColumn("gap_pp", F.col("organic_rate") - F.col("promo_rate"))
    # At most one row per asked month: a sort in one task is bounded by the query text.
    with_step = change_from_previous(gaps.where(F.col("gap_pp").isNotNull()), [], "month_number", "gap_pp", diff="_step")
    widening = with_step.agg((F.coalesce(F.min("_step"), F.lit(0.0)) >= 0).alias("w")).scalar()
    return gaps.withColumn("is_widening", widening)


def net_value(t: Tables) -> DataFrame:
    """Profit of the live lines minus refunds, per customer; refunds count once per order."""
    refunds = t.returns.groupBy("order_id").agg(exact_sum("refund_amount").alias("refund"))
    per_order = base_lines(t).groupBy("order_id", "customer_id").agg(exact_sum("gross_profit").alias("profit"))
    adjusted = per_order.join(refunds, "order_id", "left").withColumn(
        "net", F.col("profit") - F.coalesce("refund", F.lit(0.0)))
    return adjusted.groupBy("customer_id").agg(exact_sum("net").alias("net_clv"))


def net_clv_by_cohort(t: Tables, cap: float = 0.97) -> DataFrame:
    """Median customer value per cohort, capped at a quantile of all customers."""
    cohorts = cohort_by_campaign_day(t, live_orders(t.orders)).select("customer_id", "is_promo")
    # One row per customer, read for the cap, the sizes and the medians.
    values = materialize(cohorts.join(net_value(t), "customer_id").where(F.col("net_clv").isNotNull()), "clv")
    # One row, read wherever a value is capped; written, the search for it is planned once.
    limit = materialize(exact_quantiles(values, [], "net_clv", {"q": cap}), "clv-cap").scalar()
    capped = values.withColumn("capped", F.least(F.col("net_clv"), limit))
    sizes = values.groupBy("is_promo").agg(F.count(F.lit(1)).alias("n_customers"))
    medians = exact_quantiles(capped, ["is_promo"], "capped", {"median_clv": 0.5})
    return sizes.join(medians, "is_promo")


def cohort_return_rate(t: Tables) -> DataFrame:
    """Returned orders per cohort; an order counts once however often it is returned."""
    live = live_orders(t.orders)
    cohorts = cohort_by_campaign_day(t, live).select("customer_id", "is_promo")
    orders = member_flag(live.select("order_id", "customer_id"), t.returns, "order_id", "is_returned")
    per_customer = orders.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_returned").alias("r"))
    return per_customer.join(cohorts, "customer_id").groupBy("is_promo").agg(
        F.sum("n").alias("n_orders"), F.sum("r").alias("n_returned")).withColumn("return_rate", pct("n_returned", "n_orders"))


def cohort_rating(t: Tables) -> DataFrame:
    """Mean rating per cohort, one review (the earliest, then the lowest) per order."""
    live = live_orders(t.orders)
    cohorts = cohort_by_campaign_day(t, live).select("customer_id", "is_promo")
    one_review = dedup_first(t.reviews, ["order_id"], [F.col("review_date"), F.col("rating")])
    rated = live.select("order_id", "customer_id").join(one_review.select("order_id", "rating"), "order_id")
    return rated.join(cohorts, "customer_id").groupBy("is_promo").agg(
        F.avg("rating").alias("avg_rating"), F.count(F.lit(1)).alias("n_rated"))


def discount_dependency(t: Tables) -> DataFrame:
    """How much of the repeat buying of each cohort used a discount."""
    live = live_orders(t.orders)
    cohorts = cohort_by_campaign_day(t, live).select("customer_id", "first_order_date", "is_promo")
    used = member_flag(live.select("customer_id", "order_id", "order_date"), promo_order_ids(t, "discount"), "order_id", "used")
    # Counts per customer day keep the join with the cohort small for any customer.
    per_day = used.groupBy("customer_id", "order_date").agg(F.count(F.lit(1)).alias("n"), F.count_if("used").alias("u"))
    per_customer = (
        per_day.join(cohorts, "customer_id").where(F.col("order_date") > F.col("first_order_date"))
        .groupBy("customer_id", "is_promo").agg(F.sum("n").alias("n"), F.sum("u").alias("u"))
        .withColumn("dep", pct("u", "n"))
    )
    return per_customer.groupBy("is_promo").agg(
        F.count(F.lit(1)).alias("n_customers"),
        F.round(F.avg("dep"), 6).alias("pct_promo_dependent"),
        (rate_where(F.col("u") == 0) * 100.0).alias("pct_never_promo"),
        (rate_where(F.col("u") == F.col("n")) * 100.0).alias("pct_always_promo"))


def cohort_yearly_value(t: Tables) -> DataFrame:
    """Orders and net revenue per customer by year and first-order cohort, with gaps."""
    live = live_orders(t.orders)
    cohorts = cohort_by_first_order(t, live, "any_id").select("customer_id", "is_promo")
    money = order_money(t.items).select("order_id", "net_revenue")
    per = (
        live.join(money, "order_id", "left").groupBy("customer_id", F.year("order_date").alias("year"))
        .agg(F.countDistinct("order_id").alias("n_orders"), F.coalesce(exact_sum("net_revenue"), F.lit(0.0)).alias("revenue"))
        .join(cohorts, "customer_id")
    )
    long = per.groupBy("year", "is_promo").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_orders").alias("o"), exact_sum("revenue").alias("r"))
    promo = F.col("is_promo")

    def of(side: Column, a: str) -> Column:
        return F.max(F.when(side, ratio(a, "n")))

    out = long.groupBy("year").agg(
        of(promo, "o").alias("promo_avg_orders"), of(~promo, "o").alias("organic_avg_orders"),
        of(promo, "r").alias("promo_avg_revenue"), of(~promo, "r").alias("organic_avg_revenue"),
        F.max(F.when(promo, F.col("n"))).alias("promo_customers"), F.max(F.when(~promo, F.col("n"))).alias("organic_customers"))
    gap = {
        f"{m}_gap_pct": F.when(
            F.col(f"promo_avg_{m}") > 0,
            pct(F.col(f"organic_avg_{m}") - F.col(f"promo_avg_{m}"), f"promo_avg_{m}")) for m in ("orders", "revenue")}
    return out.withColumns(gap)


def promo_stats(t: Tables, windows: Sequence[int] = (30, 60, 90), min_orders: int = 30) -> DataFrame:
    """Per campaign: discount rate, return rate, and share of buyers back within N days after it."""
    promos = t.stored("promotions").select("promo_id", "end_date")
    # One row per campaign and order carries everything that follows; written once.
    pairs = materialize(
        live_orders(t.lines).where(F.col("promo_id").isNotNull()).groupBy("promo_id", "order_id", "customer_id").agg(
            exact_sum("discount_amount").alias("discount"),
            exact_sum(F.col("unit_price") * F.col("quantity")).alias("listed")), "promo-orders")
    money = pairs.groupBy("promo_id").agg(exact_sum("discount").alias("discount"), exact_sum("listed").alias("listed"))
    returned = member_flag(pairs.select("promo_id", "order_id"), t.returns, "order_id", "is_returned")
    per_orders = returned.groupBy("promo_id").agg(
        F.count(F.lit(1)).alias("num_orders"), F.count_if("is_returned").alias("n_returned"))
    buyers = pairs.select("promo_id", "customer_id").distinct().join(promos, "promo_id")
    n_buyers = buyers.groupBy("promo_id").agg(F.count(F.lit(1)).alias("n_buyers"))
    reach = buyers.withColumns({"_from": F.date_add("end_date", 1), "_to": F.date_add("end_date", max(windows))})
    days = live_orders(t.orders).select("customer_id", "order_date").distinct()
    back = range_pairs(reach, days, ["customer_id"], "_from", "_to", "order_date")
    soonest = back.groupBy("promo_id", "customer_id").agg(F.min(F.datediff("order_date", "end_date")).alias("d"))
    repeats = soonest.groupBy("promo_id").agg(*[F.count_if(F.col("d") <= w).alias(f"_r{w}") for w in windows])
    return (
        money.where(F.col("listed") != 0).join(per_orders, "promo_id").where(F.col("num_orders") >= min_orders)
        .join(n_buyers, "promo_id", "left").join(repeats, "promo_id", "left")
        .select(
            "promo_id", pct("discount", "listed").alias("avg_discount_rate"), pct("n_returned", "num_orders").alias("return_rate"),
            *[pct(F.coalesce(f"_r{w}", F.lit(0)), "n_buyers").alias(f"repeat_{w}d") for w in windows], "num_orders")
    )


def mean_by(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Exact money mean per non-NULL key."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(exact_mean(value).alias(name))
