"""Small hand-made cases where pandas-style and SQL-style rules differ."""

import datetime as dt

from pyspark.sql import functions as F

from saleslens.functions import clip, date_flags, day, exact_mean, exact_sum, lunar_new_years, ratio, shift_months
from saleslens.operators import relational as R
from saleslens.operators import windows as Wn
from saleslens.operators.joins import nearest_marks, overlap_flag
from saleslens.plans import daily as D
from saleslens.plans import features as X
from saleslens.plans.customers import mean_by

D_ = dt.date


def one(df):
    return df.first()[0]


def test_null_group_key_is_dropped(spark):
    df = spark.createDataFrame([(None, 1.0), ("a", 3.0)], "k string, v double")
    assert [tuple(r) for r in mean_by(df, "k", "v", "m").collect()] == [("a", 3.0)]


def test_day_of_orders_without_lines_sums_to_zero(spark):
    orders = spark.createDataFrame(
        [(1, D_(2020, 1, 1), 7, "delivered")], "order_id bigint, order_date date, customer_id bigint, order_status string")
    items = spark.createDataFrame([], "order_id bigint, product_id bigint, quantity int, unit_price double, discount_amount double")
    row = D.orders_daily(orders, items).first()
    assert (row.gross_revenue, row.n_items_sold, row.avg_order_value) == (0.0, 0, 0.0)


def test_zero_divisor_is_null(spark):
    assert one(spark.range(1).select(ratio(F.lit(3.0), F.lit(0)))) is None


def test_conversion_without_sessions_is_zero(spark):
    traffic = spark.createDataFrame([(D_(2020, 1, 1), 0, 0)], "date date, sessions bigint, unique_visitors bigint")
    orders = spark.createDataFrame([(1, D_(2020, 1, 1))], "order_id bigint, order_date date")
    assert D.conversion_daily(traffic, orders).first().conversion_rate == 0.0


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (2.0,)], "v double")
    assert [r[0] for r in df.select(clip("v", 0.0, 1.0)).collect()] == [None, 0.0, 1.0]


def test_exact_sum_does_not_depend_on_order(spark):
    values = [(0.1,)] * 10 + [(1e9,)]
    a = spark.createDataFrame(values, "v double").repartition(5).agg(exact_sum("v"), exact_mean("v")).first()
    assert a[0] == 1000000001.0 and a[1] == 1000000001.0 / 11


def test_holiday_distances(spark):
    days = spark.createDataFrame([(D_(2021, 9, 2),), (D_(2021, 9, 3),)], "date date")
    rows = {r.date: r for r in X.holiday_features(days).collect()}
    assert rows[D_(2021, 9, 2)].is_2_9 == 1
    assert (rows[D_(2021, 9, 2)].days_to_next_holiday, rows[D_(2021, 9, 2)].days_from_last_holiday) == (0, 124)
    assert rows[D_(2021, 9, 3)].days_from_last_holiday == 1


def test_strict_holidays_miss_the_neighbour_years(spark):
    days = spark.createDataFrame([(D_(2021, 1, 1),)], "date date")
    assert X.holiday_features(days, strict=True).first().days_from_last_holiday == (D_(2021, 1, 1) - D_(2020, 1, 25)).days
    assert X.holiday_features(days).first().days_from_last_holiday == 7


# First day of the lunar new year, 2012 to 2024, and of years in which it is late, early or after a leap month.
LUNAR_NEW_YEAR = [
    "2012-01-23", "2013-02-10", "2014-01-31", "2015-02-19", "2016-02-08", "2017-01-28", "2018-02-16",
    "2019-02-05", "2020-01-25", "2021-02-12", "2022-02-01", "2023-01-22", "2024-02-10"]
LUNAR_ODD = ["1968-01-29", "1985-01-21", "2007-02-17", "2030-02-02", "2033-01-31", "2034-02-19", "2099-01-21"]


def test_lunar_new_years(spark):
    """All listed days, and a new year every 353 to 385 days, always from 20 January to 21 February."""
    years = spark.range(1900, 2101).selectExpr("CAST(id AS INT) AS y")
    got = {r.y: r.new_year for r in lunar_new_years(years, "y").collect()}
    for text in LUNAR_NEW_YEAR + LUNAR_ODD:
        d = dt.date.fromisoformat(text)
        assert got[d.year] == d, (text, got[d.year])
    gaps = {(got[y + 1] - got[y]).days for y in range(1900, 2100)}
    assert gaps <= {353, 354, 355, 383, 384, 385}
    assert all((1, 20) <= (d.month, d.day) <= (2, 21) for d in got.values())


def test_the_model_table_meets_the_lunar_new_year(spark):
    from saleslens.registry.forecasts import model_rows
    from saleslens.sources import Tables

    rows = model_rows(Tables(spark, "/root/testdata/sf0.001")).where("is_tet = 1").select("date").distinct().collect()
    near = {d + dt.timedelta(days=k) for d in (D_(1996, 2, 19), D_(1997, 2, 7), D_(1998, 1, 28), D_(2000, 2, 5)) for k in range(-7, 8)}
    assert near <= {r.date for r in rows}


def test_no_mark_in_reach_gives_the_sentinel(spark):
    days = spark.createDataFrame([(D_(2021, 1, 1),), (D_(2021, 1, 5),)], "date date")
    marks = spark.createDataFrame([(D_(2021, 1, 3),)], "date date")
    got = {r.date.day: (r.days_to_next, r.days_from_last) for r in nearest_marks(days, marks).collect()}
    assert got == {1: (2, 999), 5: (999, 2)}


PROMO = "promo_id string, promo_name string, promo_type string, discount_value double, start_date date, end_date date, stackable_flag int"


def test_promo_intensity_and_anticipation(spark):
    promos = spark.createDataFrame(
        [("p", "Sale 2020", "percentage", 30.0, D_(2020, 1, 10), D_(2020, 1, 12), 1),
         ("q", "Fix 2020", "fixed", 50.0, D_(2020, 1, 10), D_(2020, 1, 10), 0)], PROMO)
    days = spark.createDataFrame([(D_(2020, 1, 9),), (D_(2020, 1, 10),), (D_(2020, 3, 1),)], "date date")
    got = {r.date: r for r in X.nearest_major_promo(X.promotion_intensity(days, promos), promos).collect()}
    far, start, before = got[D_(2020, 3, 1)], got[D_(2020, 1, 10)], got[D_(2020, 1, 9)]
    assert (far.n_active_promos, far.max_discount_pct, far.pis_score, far.has_stackable_promo) == (0, 0.0, 0.0, 0)
    assert (start.n_active_promos, start.max_discount_pct, start.pis_score) == (2, 30.0, 60.0)
    assert (start.days_to_next_major_promo, start.is_within_promo_window) == (999, 0)
    assert (before.days_to_next_major_promo, before.expected_discount_depth, before.is_within_promo_window) == (1, 30.0, 1)


def test_promo_cycle_keeps_month_ends_and_renames(spark):
    promos = spark.createDataFrame([("p", "Sale 2020", "percentage", 30.0, D_(2020, 2, 29), D_(2020, 3, 1), 1)], PROMO)
    moved = X.extend_promotions(promos, [2020]).where("start_date > '2021-01-01'").first()
    assert (moved.promo_name, moved.start_date) == ("Sale 2022", D_(2022, 2, 28))
    assert one(spark.range(1).select(shift_months(day("2020-02-29"), 24))) == D_(2022, 2, 28)


def test_rolling_std_of_one_row_is_null(spark):
    df = spark.createDataFrame([("s", D_(2020, 1, 1), 5.0), ("s", D_(2020, 1, 2), 7.0)], "k string, date date, v double")
    rows = Wn.rolling(df, ["k"], "date", "v", [7], ["mean", "std"]).orderBy("date").collect()
    assert rows[0].roll7_std is None and rows[1].roll7_mean == 6.0


def test_mode_tie_goes_to_the_smaller_value(spark):
    df = spark.createDataFrame([("p", "b"), ("p", "a")], "k string, v string")
    assert R.mode_per_key(df, "k", "v", "m").first().m == "a"


def test_first_value_skips_null(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, "P1"), (2, 1, None)], "order_id int, line int, promo_id string")
    got = {r.order_id: r.promo_id for r in R.first_value_per_key(df, "order_id", "promo_id", ["line"]).collect()}
    assert got == {1: "P1", 2: None}


def test_dedup_keeps_one_whole_row(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, None)], "k string, o int, v string")
    got = sorted(tuple(r) for r in R.dedup_first(df, ["k"], [F.col("o")]).collect())
    assert got == [("a", 1, "y"), ("b", 5, None)]


def test_quarter_flags(spark):
    df = spark.createDataFrame([(D_(2024, 3, 31),), (D_(2024, 4, 1),), (D_(2024, 2, 29),)], "d date")
    got = df.select("d", *[c.alias(n) for n, c in date_flags("d").items()]).collect()
    by = {r.d: r for r in got}
    assert by[D_(2024, 3, 31)].is_quarter_end == 1 and by[D_(2024, 3, 31)].is_weekend == 1
    assert by[D_(2024, 4, 1)].is_quarter_start == 1 and by[D_(2024, 2, 29)].is_month_end == 1


def test_overlap_touching_ends_counts(spark):
    w = spark.createDataFrame([(1, D_(2020, 1, 1), D_(2020, 1, 5)), (2, D_(2020, 1, 7), D_(2020, 1, 8))], "id int, ws date, we date")
    i = spark.createDataFrame([(D_(2020, 1, 5), D_(2020, 1, 6))], "s date, e date")
    got = {r.id: r.busy for r in overlap_flag(w, i, "id", "ws", "we", "s", "e", "busy").collect()}
    assert got == {1: True, 2: False}


def test_split_raises_on_leak(spark):
    import pytest

    df = spark.createDataFrame([(D_(2020, 1, 1), 1.0, 1), (D_(2021, 1, 1), None, None)], "date date, y double, f int")
    with pytest.raises(ValueError, match="NULL in the test part"):
        R.split_by_date(df, "date", day("2020-12-31"), day("2021-01-01"), ["y"], [], ["f"])
    with pytest.raises(ValueError, match="neither part"):
        R.split_by_date(df, "date", day("2019-12-31"), day("2021-01-01"), ["y"], [], [])


def test_histogram_keeps_empty_bins(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (10.0,)], "v double")
    assert [r.n for r in R.equal_width_bins(df, "v", 5).orderBy("bin").collect()] == [2, 0, 0, 0, 1]


def test_inventory_stress_fills_with_train_median(spark):
    df = spark.createDataFrame(
        [(D_(2020, 1, 1), 10.0, 0.5), (D_(2020, 1, 2), 20.0, 0.5), (D_(2020, 1, 3), None, None)], "date date, s double, f double")
    rows = X.inventory_stress(df, "date", "s", "f", day("2020-01-02")).orderBy("date").collect()
    assert abs(rows[2].inventory_stress_index - (rows[0].inventory_stress_index + rows[1].inventory_stress_index) / 2) < 1e-12
    assert (rows[2].s, rows[2].f, rows[2].is_stockout_stress) == (0.0, 0.0, 0)
