"""Campaign analyses: baselines, effects, selection, promotion depth.

A campaign window is expanded to its days and joined with the daily table on the
day.  Windows span a few months, so every median below has a bounded input; the
number of campaigns only adds groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import day_range, exact_sum, pct, ratio, rate_where
from ..operators.joins import days_in_any, member_flag, overlap_flag
from ..operators.relational import mode_per_key
from ..operators.windows import change_from_previous, neighbor_median
from ..sources import Tables
from ..sources.files import materialize
from .customers import promo_order_ids
from .revenue import base_lines, live_orders, order_money


def live_daily_revenue(t: Tables) -> DataFrame:
    """Gross revenue of live orders per day; days whose orders have no lines are 0."""
    return (
        live_orders(t.orders).join(order_money(t.items), "order_id", "left")
        .groupBy(F.col("order_date").alias("date"))
        .agg(F.coalesce(exact_sum("gross_revenue"), F.lit(0.0)).alias("value"))
    )


def daily_profit(t: Tables) -> DataFrame:
    return t.sales.select("date", (F.col("revenue") - F.col("cogs")).alias("value"))


def anomalous_years(daily: DataFrame, threshold: float = 0.25) -> DataFrame:
    """Years whose revenue is far from the median of the two years on each side."""
    yearly = daily.groupBy(F.year("date").alias("year")).agg(exact_sum("value").alias("revenue"))
    return neighbor_median(yearly, "year", "revenue", threshold=threshold)


def _signal_days(promos: DataFrame, signals: dict[str, tuple[Column, Column]]) -> DataFrame:
    """One row per campaign, signal and day of the signal's search range."""
    ranges = F.array(*[
        F.struct(F.lit(name).alias("signal"), day_range(lo, hi).alias("days")) for name, (lo, hi) in signals.items()])
    return (
        promos.select("promo_id", "start_date", "end_date", F.explode(ranges).alias("s"))
        .select("promo_id", "start_date", "end_date", F.col("s.signal").alias("signal"), F.explode("s.days").alias("date"))
    )


def _outside(start: Column, end: Column) -> Column:
    return ~F.col("date").between(start, end)


def weighted_baseline(
    daily: DataFrame, promos: DataFrame, weeks: int = 8, w_last_year: float = 0.6, w_near: float = 0.4, min_days: int = 5,
) -> DataFrame:
    """Expected daily value of each campaign.

    Mixes the median of the same days last year (campaign days included) with
    the median of the campaign-free days around it.  A signal with fewer than
    ``min_days`` days drops out; without any, the median of all campaign-free
    days is used.
    """
    start, end = F.col("start_date"), F.col("end_date")
    busy = days_in_any(promos, "start_date", "end_date")
    marked = member_flag(daily, busy, "date", "is_promo_day")
    days = _signal_days(promos, {
        "ly": (F.add_months(start, -12), F.add_months(end, -12)),
        "near": (F.date_sub(start, 7 * weeks), F.date_add(end, 7 * weeks)),
    })
    ly = F.when(F.col("signal") == "ly", F.col("value"))
    near = F.when((F.col("signal") == "near") & _outside(start, end) & ~F.col("is_promo_day"), F.col("value"))
    found = days.join(marked, "date").groupBy("promo_id").agg(
        F.median(ly).alias("ly_median"), F.count(ly).alias("n_ly"),
        F.median(near).alias("near_median"), F.count(near).alias("n_near"))
    free = marked.where(~F.col("is_promo_day")).agg(F.median("value")).scalar()
    ly_ok, near_ok = F.coalesce(F.col("n_ly") >= min_days, F.lit(False)), F.coalesce(F.col("n_near") >= min_days, F.lit(False))
    mixed = F.lit(w_last_year) * F.col("ly_median") + F.lit(w_near) * F.col("near_median")
    return promos.join(found, "promo_id", "left").withColumns({
        "baseline": F.when(ly_ok & near_ok, mixed).when(near_ok, F.col("near_median")).when(ly_ok, F.col("ly_median")).otherwise(free),
        "method": F.when(ly_ok & near_ok, "weighted").when(near_ok, "near only").when(ly_ok, "last year only").otherwise("global"),
        "n_ly": F.when(ly_ok, F.col("n_ly")).otherwise(F.lit(0)),
        "n_near": F.when(near_ok, F.col("n_near")).otherwise(F.lit(0)),
    }).drop("ly_median", "near_median")


def tiered_baseline(daily: DataFrame, promos: DataFrame, weeks: int = 8, min_days: int = 7, threshold: float = 0.25) -> DataFrame:
    """Expected daily value from the first tier with enough days.

    T1 same days last year, if free of campaigns and not in an anomalous year;
    T3 campaign-free normal days around; T4 the same, one year back added;
    T5 the median of all campaign-free normal days.
    """
    start, end = F.col("start_date"), F.col("end_date")
    ly_start, ly_end = F.add_months(start, -12), F.add_months(end, -12)
    odd = anomalous_years(daily, threshold).where("is_anomalous").select("year")
    busy = days_in_any(promos, "start_date", "end_date")
    marked = member_flag(daily, busy, "date", "is_promo_day").withColumn("year", F.year("date"))
    marked = member_flag(marked, odd, "year", "is_odd_year")
    clean = ~F.col("is_promo_day") & ~F.col("is_odd_year")
    reach = 7 * weeks
    days = _signal_days(promos, {
        "ly": (ly_start, ly_end),
        "near": (F.date_sub(start, reach), F.date_add(end, reach)),
        "near_ly": (F.date_sub(ly_start, reach), F.date_add(ly_end, reach)),
    })
    value = F.col("value")
    ly = F.when(F.col("signal") == "ly", value)
    near = F.when((F.col("signal") == "near") & clean & _outside(start, end), value)
    pool = F.when(
        F.col("signal").isin("near", "near_ly") & clean & _outside(start, end)
        & ((F.col("signal") == "near") | _outside(ly_start, ly_end)), value)
    found = days.join(marked, "date").groupBy("promo_id").agg(
        *[f(c).alias(f"{n}_{k}") for k, c in (("ly", ly), ("near", near), ("pool", pool)) for n, f in (("m", F.median), ("n", F.count))])
    last_year = promos.select("promo_id", ly_start.alias("ly_start"), ly_end.alias("ly_end"), F.year(ly_start).alias("year"))
    usable = overlap_flag(last_year, promos, "promo_id", "ly_start", "ly_end", "start_date", "end_date", "is_busy")
    usable = member_flag(usable, odd, "year", "is_odd").select("promo_id", (~F.col("is_busy") & ~F.col("is_odd")).alias("ly_ok"))
    free = marked.agg(F.coalesce(F.median(F.when(clean, value)), F.median("value"))).scalar()

    def enough(k: str) -> Column:
        return F.coalesce(F.col(f"n_{k}") >= min_days, F.lit(False))

    t1, t3, t4 = F.col("ly_ok") & enough("ly"), enough("near"), enough("pool")
    return promos.join(found, "promo_id", "left").join(usable, "promo_id").withColumns({
        "baseline": F.when(t1, F.col("m_ly")).when(t3, F.col("m_near")).when(t4, F.col("m_pool")).otherwise(free),
        "method": F.when(t1, "T1").when(t3, "T3").when(t4, "T4").otherwise("T5"),
    }).drop("ly_ok", *[f"{n}_{k}" for k in ("ly", "near", "pool") for n in "mn"])


def discount_spend(t: Tables) -> DataFrame:
    return t.lines.where(F.col("promo_id").isNotNull()).groupBy("promo_id").agg(
        exact_sum("discount_amount").alias("disc_spend"))


def campaign_effect(daily: DataFrame, with_baseline: DataFrame, spend: DataFrame, window_days: int = 14) -> DataFrame:
    """Value before, during and after each campaign against its baseline.

    The days charged with the baseline are the campaign days with data plus the
    full after window, also where that window has fewer days.
    """
    start, end = F.col("start_date"), F.col("end_date")
    days = with_baseline.select("promo_id", "start_date", "end_date").withColumn(
        "date", F.explode(day_range(F.date_sub(start, window_days), F.date_add(end, window_days))))
    phase = F.when(F.col("date") < start, "before").when(F.col("date") <= end, "during").otherwise("after")
    joined = days.join(daily, "date").withColumn("phase", phase)

    def part(p: str) -> Column:
        return F.when(F.col("phase") == p, F.col("value"))

    sums = joined.groupBy("promo_id").agg(
        *[F.coalesce(exact_sum(part(p)), F.lit(0.0)).alias(p) for p in ("before", "during", "after")],
        F.count(part("during")).alias("n_during"), F.count(part("after")).alias("n_after"))
    base = F.col("baseline")
    return (
        with_baseline.join(sums.where(F.col("n_during") > 0), "promo_id").join(spend, "promo_id", "left")
        .withColumns({
            "disc_spend": F.coalesce("disc_spend", F.lit(0.0)),
            "net_effect": F.col("during") + F.col("after") - base * (F.col("n_during") + window_days),
            "pull_fwd": F.when(base > 0, ratio(ratio("during", "n_during"), base)),
            "hangover": F.when(base > 0, ratio(ratio("after", "n_after"), base)),
        })
    )


def weighted_effects(t: Tables) -> DataFrame:
    daily, promos = materialize(daily_profit(t), "daily"), t.stored("promotions")
    return campaign_effect(daily, weighted_baseline(daily, promos), discount_spend(t))


def tiered_effects(t: Tables) -> DataFrame:
    daily, promos = materialize(live_daily_revenue(t), "daily"), t.stored("promotions")
    return campaign_effect(daily, tiered_baseline(daily, promos), discount_spend(t))


def campaign_summary(effects: DataFrame) -> DataFrame:
    """One row over all campaigns, with the number of campaigns per baseline method."""
    known = F.col("hangover").isNotNull()
    return effects.agg(
        F.count(F.lit(1)).alias("n_campaigns"),
        (rate_where(F.col("net_effect") < 0) * 100.0).alias("pct_negative"),
        pct(F.count_if(F.col("hangover") < 1), F.count_if(known)).alias("pct_hangover_below_1"),
        F.round(F.median("pull_fwd"), 6).alias("median_pull_fwd"),
        F.count_if(F.col("method") == "weighted").alias("n_weighted"),
        F.count_if(F.col("method") == "near only").alias("n_near_only"))


def campaign_pick(effects: DataFrame) -> DataFrame:
    """Largest spend, best, worst, and the one nearest the median of the rest.

    One row per campaign is all the single window holds.
    """
    everything = W.partitionBy()
    valid = F.col("net_effect").isNotNull() & F.col("hangover").isNotNull()
    net, pid = F.when(valid, F.col("net_effect")), F.col("promo_id")

    def first_by(key: Column) -> Column:
        return F.min_by(pid, F.struct(key, pid)).over(everything)

    picks = effects.withColumns({
        "_valid": valid,
        "_largest": first_by(-F.col("disc_spend")),
        "_best": F.min_by(F.when(valid, pid), F.when(valid, F.struct(-net, pid))).over(everything),
        "_worst": F.min_by(F.when(valid, pid), F.when(valid, F.struct(net, pid))).over(everything),
        "_median": F.median(net).over(everything),
    })
    free = F.col("_valid") & ~pid.isin(F.col("_largest"), F.col("_best"), F.col("_worst"))
    anchored = picks.withColumn("_mid", F.coalesce(
        F.min_by(F.when(free, pid), F.when(free, F.struct(F.abs(net - F.col("_median")), pid))).over(everything), F.col("_best")))
    labels = {"largest spend": "_largest", "best net effect": "_best", "worst net effect": "_worst", "median anchor": "_mid"}
    tagged = anchored.withColumn("label", F.explode(F.array(*[
        F.when(pid == F.col(c), F.lit(n)) for n, c in labels.items()])))
    return tagged.where(F.col("label").isNotNull()).select("label", "promo_id", "net_effect", "disc_spend")


def promo_depth(t: Tables) -> DataFrame:
    """Per campaign: mean discount and margin of its discounted lines, and their main category."""
    lines = base_lines(t).where(F.col("has_promo") & F.col("promo_id").isNotNull())
    # Sums per campaign, category and segment give the means and both modes.
    fine = materialize(lines.groupBy("promo_id", "category", "segment").agg(
        F.sum("discount_rate").alias("d"), F.count("discount_rate").alias("dn"),
        F.sum("margin_rate").alias("m"), F.count("margin_rate").alias("mn"),
        exact_sum("revenue_line").alias("revenue"), F.count(F.lit(1)).alias("n")), "promo-depth")
    stats = fine.groupBy("promo_id").agg(
        (ratio(F.sum("d"), F.sum("dn")) * 100).alias("avg_discount_rate"),
        (ratio(F.sum("m"), F.sum("mn")) * 100).alias("avg_margin_rate"), exact_sum("revenue").alias("total_revenue"))
    orders = lines.groupBy("promo_id").agg(F.countDistinct("order_id").alias("num_orders"))
    return (
        stats.join(orders, "promo_id")
        .join(mode_per_key(fine, "promo_id", "category", "category", weight="n"), "promo_id")
        .join(mode_per_key(fine, "promo_id", "segment", "segment", weight="n"), "promo_id")
        .dropna(subset=["avg_discount_rate", "avg_margin_rate"])
    )


def break_even(depth: DataFrame, min_points: int = 4) -> DataFrame:
    """Discount at which the fitted margin of a category reaches zero."""
    fits = depth.groupBy("category").agg(
        F.count(F.lit(1)).alias("n_promos"),
        F.regr_slope("avg_margin_rate", "avg_discount_rate").alias("slope"),
        F.regr_intercept("avg_margin_rate", "avg_discount_rate").alias("intercept"))
    ok = F.col("n_promos") >= min_points
    slope, intercept = F.when(ok, F.col("slope")), F.when(ok, F.col("intercept"))
    return fits.select(
        "category", "n_promos", slope.alias("slope"), intercept.alias("intercept"),
        F.when(slope < 0, F.round(ratio(-intercept, slope), 1)).alias("break_even"))


def discount_depth_margin(t: Tables, n_worst: int = 5) -> DataFrame:
    """Campaign depth and margin with the break-even of the category and a worst flag."""
    depth = materialize(promo_depth(t), "depth")  # one row per campaign, read three times
    worst = depth.where(F.col("avg_margin_rate") < 0).orderBy("avg_margin_rate", "promo_id").limit(n_worst)
    return member_flag(depth.join(break_even(depth), "category", "left"), worst, "promo_id", "is_worst")


def promo_penetration(t: Tables) -> DataFrame:
    """Orders with a promotion valid on their day, per year.

    The flag is reduced to one value per order before it meets all orders.
    """
    windows = t.stored("promotions").select("promo_id", "start_date", "end_date")
    valid = t.lines.where(F.col("promo_id").isNotNull()).join(windows, "promo_id").where(
        F.col("order_date").between(F.col("start_date"), F.col("end_date")))
    flagged = member_flag(t.orders.select("order_id", "order_date"), valid, "order_id", "has_promo")
    yearly = flagged.groupBy(F.year("order_date").alias("year")).agg(
        F.count("order_id").alias("total_orders"), F.count_if("has_promo").alias("promo_orders"))
    yearly = yearly.withColumn("promo_penetration_pct", F.round(pct("promo_orders", "total_orders"), 2))
    out = change_from_previous(yearly, [], "year", "promo_penetration_pct", diff="pct_change")
    return out.withColumn("pct_change", F.round("pct_change", 6))


def quarter_promo_share(t: Tables, years: list[int]) -> DataFrame:
    """Share of orders with a promotion or discount in the peak and the low quarter."""
    month = F.month("order_date")
    used = promo_order_ids(t, "either")
    orders = t.orders_between(f"{min(years)}-01-01", f"{max(years)}-12-31").select("order_id", F.year("order_date").alias("year"), F.when(
        month.isin(4, 5, 6), "Q2 Peak").when(month.isin(10, 11, 12), "Q4 Low").alias("season"))
    picked = orders.where(F.col("year").isin(years) & F.col("season").isNotNull())
    return member_flag(picked, used, "order_id", "used_promo").groupBy("year", "season").agg(
        F.countDistinct("order_id").alias("total_orders"), F.count_if("used_promo").alias("promo_orders"),
    ).withColumn("penetration_pct", F.round(pct("promo_orders", "total_orders"), 1))


def promo_vs_no_promo(t: Tables) -> DataFrame:
    """Revenue net of discount and refund, order value, penetration and frequency by year."""
    refunds = t.returns.groupBy("order_id").agg(exact_sum("refund_amount").alias("refund"))
    net = F.col("unit_price") * F.col("quantity") - F.coalesce("discount_amount", F.lit(0.0))
    # Lines shrink to one row per order before they meet the orders.
    money = t.items.groupBy("order_id").agg(exact_sum(net).alias("net"), F.bool_or("has_promo_id").alias("has_promo"))
    orders = live_orders(t.orders).select("order_id", "customer_id", F.year("order_date").alias("year"))
    per_order = (
        orders.join(money, "order_id").join(refunds, "order_id", "left")
        .withColumn("revenue", F.col("net") - F.coalesce("refund", F.lit(0.0)))
    )
    split = per_order.groupBy("year", "has_promo").agg(
        exact_sum("revenue").alias("revenue"), F.count(F.lit(1)).alias("num_orders")).withColumn("aov", ratio("revenue", "num_orders"))
    yearly = per_order.groupBy("year").agg(
        (rate_where(F.col("has_promo")) * 100.0).alias("promo_penetration"),
        ratio(F.count(F.lit(1)), F.countDistinct("customer_id")).alias("order_freq"))
    return split.join(yearly, "year")
