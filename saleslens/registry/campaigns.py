"""Campaign and promotion-cohort questions."""

from pyspark.sql import functions as F

from ..functions import round6
from ..plans import campaigns as P
from ..plans import customers as C
from ..plans.revenue import live_orders
from ..sources.files import materialize
from .base import query
from .views_sql import dsum

DAILY_LIVE = f"""
daily AS (SELECT order_date AS date, coalesce({dsum('gross_revenue')}, 0) AS value FROM live_orders_v o LEFT JOIN order_money_v m ON o.order_id = m.order_id GROUP BY 1)"""

YEARS = f"""
yr AS (SELECT CAST(year(date) AS INT) AS year, {dsum('value')} AS revenue FROM daily GROUP BY 1),
nb AS (SELECT a.year, quantile_cont(b.revenue, 0.5) AS m, count(*) AS n FROM yr a JOIN yr b ON abs(a.year - b.year) BETWEEN 1 AND 2 GROUP BY 1),
odd AS (SELECT yr.year, yr.revenue, m, n, coalesce(n >= 2 AND m <> 0 AND abs((yr.revenue - m) / m) > 0.25, false) AS is_anomalous FROM yr LEFT JOIN nb ON yr.year = nb.year)"""

TIERED = f"""WITH {DAILY_LIVE}, {YEARS},
mk AS (SELECT d.*, date IN (SELECT date FROM promo_days_v) AS promo, year(date) IN (SELECT year FROM odd WHERE is_anomalous) AS o FROM daily d),
pr AS (SELECT *, CAST(start_date - INTERVAL 1 YEAR AS DATE) AS ls, CAST(end_date - INTERVAL 1 YEAR AS DATE) AS le FROM promotions_v),
ly AS (SELECT promo_id, quantile_cont(value, 0.5) AS m, count(value) AS n FROM pr JOIN mk ON date BETWEEN ls AND le GROUP BY 1),
near AS (SELECT promo_id, quantile_cont(value, 0.5) AS m, count(value) AS n FROM pr JOIN mk ON date BETWEEN start_date - INTERVAL 56 DAY AND end_date + INTERVAL 56 DAY
         AND NOT date BETWEEN start_date AND end_date AND NOT promo AND NOT o GROUP BY 1),
pool AS (SELECT promo_id, quantile_cont(value, 0.5) AS m, count(value) AS n FROM (
           SELECT promo_id, value FROM pr JOIN mk ON date BETWEEN start_date - INTERVAL 56 DAY AND end_date + INTERVAL 56 DAY AND NOT date BETWEEN start_date AND end_date AND NOT promo AND NOT o
           UNION ALL SELECT promo_id, value FROM pr JOIN mk ON date BETWEEN ls - INTERVAL 56 DAY AND le + INTERVAL 56 DAY AND NOT date BETWEEN start_date AND end_date AND NOT date BETWEEN ls AND le AND NOT promo AND NOT o) GROUP BY 1),
t1 AS (SELECT promo_id, NOT EXISTS (SELECT 1 FROM promotions_v b WHERE NOT (pr.le < b.start_date OR pr.ls > b.end_date)) AND year(ls) NOT IN (SELECT year FROM odd WHERE is_anomalous) AS ok FROM pr),
base AS (SELECT pr.promo_id, start_date, end_date,
  CASE WHEN t1.ok AND coalesce(ly.n, 0) >= 7 THEN 'T1' WHEN coalesce(near.n, 0) >= 7 THEN 'T3' WHEN coalesce(pool.n, 0) >= 7 THEN 'T4' ELSE 'T5' END AS method,
  CASE WHEN t1.ok AND coalesce(ly.n, 0) >= 7 THEN ly.m WHEN coalesce(near.n, 0) >= 7 THEN near.m WHEN coalesce(pool.n, 0) >= 7 THEN pool.m
       ELSE coalesce((SELECT quantile_cont(value, 0.5) FROM mk WHERE NOT promo AND NOT o), (SELECT quantile_cont(value, 0.5) FROM mk)) END AS baseline
  FROM pr JOIN t1 ON pr.promo_id = t1.promo_id LEFT JOIN ly ON pr.promo_id = ly.promo_id LEFT JOIN near ON pr.promo_id = near.promo_id LEFT JOIN pool ON pr.promo_id = pool.promo_id)"""

WEIGHTED = """WITH daily AS (SELECT date, revenue - cogs AS value FROM sales_v),
mk AS (SELECT d.*, date IN (SELECT date FROM promo_days_v) AS promo FROM daily d),
pr AS (SELECT *, CAST(start_date - INTERVAL 1 YEAR AS DATE) AS ls, CAST(end_date - INTERVAL 1 YEAR AS DATE) AS le FROM promotions_v),
ly AS (SELECT promo_id, quantile_cont(value, 0.5) AS m, count(value) AS n FROM pr JOIN mk ON date BETWEEN ls AND le GROUP BY 1),
near AS (SELECT promo_id, quantile_cont(value, 0.5) AS m, count(value) AS n FROM pr JOIN mk ON date BETWEEN start_date - INTERVAL 56 DAY AND end_date + INTERVAL 56 DAY
         AND NOT date BETWEEN start_date AND end_date AND NOT promo GROUP BY 1),
base AS (SELECT pr.promo_id, start_date, end_date,
  CASE WHEN coalesce(ly.n, 0) >= 5 AND coalesce(near.n, 0) >= 5 THEN 'weighted' WHEN coalesce(near.n, 0) >= 5 THEN 'near only' WHEN coalesce(ly.n, 0) >= 5 THEN 'last year only' ELSE 'global' END AS method,
  CASE WHEN coalesce(ly.n, 0) >= 5 AND coalesce(near.n, 0) >= 5 THEN CAST(0.6 AS DOUBLE) * ly.m + CAST(0.4 AS DOUBLE) * near.m WHEN coalesce(near.n, 0) >= 5 THEN near.m WHEN coalesce(ly.n, 0) >= 5 THEN ly.m
       ELSE (SELECT quantile_cont(value, 0.5) FROM mk WHERE NOT promo) END AS baseline,
  CASE WHEN coalesce(ly.n, 0) >= 5 THEN ly.n ELSE 0 END AS n_ly, CASE WHEN coalesce(near.n, 0) >= 5 THEN near.n ELSE 0 END AS n_near
  FROM pr LEFT JOIN ly ON pr.promo_id = ly.promo_id LEFT JOIN near ON pr.promo_id = near.promo_id)"""

EFFECT = f""",
ph AS (SELECT promo_id, value, CASE WHEN date < start_date THEN 'before' WHEN date <= end_date THEN 'during' ELSE 'after' END AS phase
       FROM base JOIN daily ON date BETWEEN start_date - INTERVAL 14 DAY AND end_date + INTERVAL 14 DAY),
sm AS (SELECT promo_id, coalesce({dsum("CASE WHEN phase = 'before' THEN value END")}, 0) AS before, coalesce({dsum("CASE WHEN phase = 'during' THEN value END")}, 0) AS during,
       coalesce({dsum("CASE WHEN phase = 'after' THEN value END")}, 0) AS after, count(*) FILTER (WHERE phase = 'during') AS n_during, count(*) FILTER (WHERE phase = 'after') AS n_after FROM ph GROUP BY 1),
sp AS (SELECT promo_id, {dsum('discount_amount')} AS disc_spend FROM items_v WHERE promo_id IS NOT NULL GROUP BY 1),
eff AS (SELECT base.*, before, during, after, n_during, n_after, coalesce(disc_spend, 0) AS disc_spend, during + after - baseline * (n_during + 14) AS net_effect,
        CASE WHEN baseline > 0 THEN during / n_during / baseline END AS pull_fwd, CASE WHEN baseline > 0 THEN after / nullif(n_after, 0) / baseline END AS hangover
        FROM base JOIN sm ON base.promo_id = sm.promo_id LEFT JOIN sp ON base.promo_id = sp.promo_id WHERE n_during > 0)"""


@query("an_anomalous_years", f"WITH {DAILY_LIVE}, {YEARS} SELECT year, revenue, round(m, 4) AS neighbor_median, n AS n_neighbors, is_anomalous FROM odd")
def _(t):
    return P.anomalous_years(P.live_daily_revenue(t)).withColumn("neighbor_median", F.round("neighbor_median", 4))


@query("an_campaign_tiered_baseline", TIERED + "SELECT promo_id, method, round(baseline, 6) AS baseline FROM base")
def _(t):
    out = P.tiered_baseline(materialize(P.live_daily_revenue(t), "daily"), t.stored("promotions"))
    return out.select("promo_id", "method", round6("baseline").alias("baseline"))


@query("an_campaign_weighted_baseline", WEIGHTED + "SELECT promo_id, method, round(baseline, 6) AS baseline, n_ly, n_near FROM base")
def _(t):
    out = P.weighted_baseline(materialize(P.daily_profit(t), "daily"), t.stored("promotions"))
    return out.select("promo_id", "method", round6("baseline").alias("baseline"), "n_ly", "n_near")


@query("an_campaign_effect", WEIGHTED + EFFECT + """
SELECT promo_id, method, before, during, after, n_during, n_after, disc_spend, round(net_effect, 4) AS net_effect, round(pull_fwd, 6) AS pull_fwd, round(hangover, 6) AS hangover FROM eff""")
def _(t):
    return P.weighted_effects(t).select(
        "promo_id", "method", "before", "during", "after", "n_during", "n_after", "disc_spend",
        F.round("net_effect", 4).alias("net_effect"), round6("pull_fwd").alias("pull_fwd"), round6("hangover").alias("hangover"))


@query("an_campaign_summary", WEIGHTED + EFFECT + """
SELECT count(*) AS n_campaigns, CAST(count(*) FILTER (WHERE net_effect < 0) AS DOUBLE) / count(*) * 100 AS pct_negative,
       CAST(count(*) FILTER (WHERE hangover < 1) AS DOUBLE) / count(hangover) * 100 AS pct_hangover_below_1, round(quantile_cont(pull_fwd, 0.5), 6) AS median_pull_fwd,
       count(*) FILTER (WHERE method = 'weighted') AS n_weighted, count(*) FILTER (WHERE method = 'near only') AS n_near_only FROM eff""")
def _(t):
    return P.campaign_summary(P.weighted_effects(t))


@query("an_campaign_pick", TIERED + EFFECT + """,
v AS (SELECT * FROM eff WHERE hangover IS NOT NULL),
a AS (SELECT promo_id FROM eff ORDER BY disc_spend DESC, promo_id LIMIT 1), b AS (SELECT promo_id FROM v ORDER BY net_effect DESC, promo_id LIMIT 1), c AS (SELECT promo_id FROM v ORDER BY net_effect, promo_id LIMIT 1),
d AS (SELECT promo_id FROM v WHERE promo_id NOT IN (SELECT * FROM a UNION SELECT * FROM b UNION SELECT * FROM c) ORDER BY abs(net_effect - (SELECT quantile_cont(net_effect, 0.5) FROM v)), promo_id LIMIT 1),
l AS (SELECT 'largest spend' AS label, promo_id FROM a UNION ALL SELECT 'best net effect', promo_id FROM b UNION ALL SELECT 'worst net effect', promo_id FROM c UNION ALL SELECT 'median anchor', promo_id FROM d)
SELECT label, l.promo_id, round(net_effect, 4) AS net_effect, disc_spend FROM l JOIN eff ON l.promo_id = eff.promo_id""")
def _(t):
    return P.campaign_pick(P.tiered_effects(t)).withColumn("net_effect", F.round("net_effect", 4))


@query("an_discount_depth_margin", f"""
WITH l AS (SELECT *, CASE WHEN list_revenue > 0 THEN 1 - revenue_line / list_revenue END AS dr, CASE WHEN revenue_line > 0 THEN gross_profit / revenue_line END AS mr
           FROM base_lines_v WHERE has_promo AND promo_id IS NOT NULL),
s AS (SELECT promo_id, avg(dr) * 100 AS avg_discount_rate, avg(mr) * 100 AS avg_margin_rate, {dsum('revenue_line')} AS total_revenue, count(DISTINCT order_id) AS num_orders FROM l GROUP BY 1),
c AS (SELECT promo_id, category, row_number() OVER (PARTITION BY promo_id ORDER BY count(*) DESC, category) AS rn FROM l GROUP BY 1, 2),
g AS (SELECT promo_id, segment, row_number() OVER (PARTITION BY promo_id ORDER BY count(*) DESC, segment) AS rn FROM l GROUP BY 1, 2),
d AS (SELECT s.*, c.category, g.segment FROM s JOIN c ON s.promo_id = c.promo_id AND c.rn = 1 JOIN g ON s.promo_id = g.promo_id AND g.rn = 1),
f AS (SELECT category, count(*) AS n_promos, CASE WHEN count(*) >= 4 THEN regr_slope(avg_margin_rate, avg_discount_rate) END AS slope, CASE WHEN count(*) >= 4 THEN regr_intercept(avg_margin_rate, avg_discount_rate) END AS intercept FROM d GROUP BY 1),
w AS (SELECT promo_id FROM d WHERE avg_margin_rate < 0 ORDER BY avg_margin_rate, promo_id LIMIT 5)
SELECT d.promo_id, round(avg_discount_rate, 6) AS avg_discount_rate, round(avg_margin_rate, 6) AS avg_margin_rate, total_revenue, num_orders, d.category, segment, n_promos, round(slope, 4) AS slope,
       round(intercept, 4) AS intercept, CASE WHEN slope < 0 THEN round(-intercept / slope, 1) END AS break_even, d.promo_id IN (SELECT promo_id FROM w) AS is_worst FROM d LEFT JOIN f ON d.category = f.category""")
def _(t):
    return P.discount_depth_margin(t).withColumns({
        "avg_discount_rate": round6("avg_discount_rate"), "avg_margin_rate": round6("avg_margin_rate"),
        "slope": F.round("slope", 4), "intercept": F.round("intercept", 4)})


@query("an_promo_penetration", """
WITH v AS (SELECT o.order_id, CAST(year(order_date) AS INT) AS year, bool_or(coalesce(order_date BETWEEN start_date AND end_date, false)) AS p
           FROM orders_v o LEFT JOIN items_v i ON o.order_id = i.order_id LEFT JOIN promotions_v r ON i.promo_id = r.promo_id GROUP BY 1, 2),
y AS (SELECT year, count(*) AS total_orders, count(*) FILTER (WHERE p) AS promo_orders, round(CAST(count(*) FILTER (WHERE p) AS DOUBLE) / count(*) * 100, 2) AS promo_penetration_pct FROM v GROUP BY 1)
SELECT *, round(promo_penetration_pct - lag(promo_penetration_pct) OVER (ORDER BY year), 6) AS pct_change FROM y""")
def _(t):
    return P.promo_penetration(t)


@query("an_promo_vs_no_promo_yearly", f"""
WITH rf AS (SELECT order_id, {dsum('refund_amount')} AS refund FROM returns_v GROUP BY 1),
o AS (SELECT i.order_id, customer_id, CAST(year(order_date) AS INT) AS year, {dsum('unit_price * quantity - discount_amount')} AS net, bool_or(promo_id IS NOT NULL) AS has_promo
      FROM items_v i JOIN live_orders_v o ON i.order_id = o.order_id GROUP BY 1, 2, 3),
l AS (SELECT o.*, net - coalesce(refund, 0) AS revenue FROM o LEFT JOIN rf ON o.order_id = rf.order_id),
s AS (SELECT year, has_promo, {dsum('revenue')} AS revenue, count(*) AS num_orders, {dsum('revenue')} / count(*) AS aov FROM l GROUP BY 1, 2),
y AS (SELECT year, CAST(count(*) FILTER (WHERE has_promo) AS DOUBLE) / count(*) * 100 AS promo_penetration, CAST(count(*) AS DOUBLE) / count(DISTINCT customer_id) AS order_freq FROM l GROUP BY 1)
SELECT s.*, promo_penetration, order_freq FROM s JOIN y ON s.year = y.year""")
def _(t):
    return P.promo_vs_no_promo(t)


@query("an_promo_stats", f"""
WITH b AS (SELECT promo_id, i.order_id, customer_id, discount_amount, unit_price * quantity AS listed FROM items_v i JOIN live_orders_v o ON i.order_id = o.order_id WHERE promo_id IS NOT NULL),
m AS (SELECT promo_id, {dsum('discount_amount')} / nullif({dsum('listed')}, 0) * 100 AS avg_discount_rate, count(DISTINCT order_id) AS num_orders,
      CAST(count(DISTINCT order_id) FILTER (WHERE order_id IN (SELECT order_id FROM returns_v)) AS DOUBLE) / count(DISTINCT order_id) * 100 AS return_rate FROM b GROUP BY 1),
c AS (SELECT DISTINCT b.promo_id, customer_id, end_date FROM b JOIN promotions_v p ON b.promo_id = p.promo_id),
r AS (SELECT c.promo_id, c.customer_id, min(CASE WHEN order_date > end_date THEN date_diff('day', end_date, order_date) END) AS d FROM c JOIN live_orders_v o ON c.customer_id = o.customer_id GROUP BY 1, 2),
q AS (SELECT promo_id, {', '.join(f'CAST(count(*) FILTER (WHERE d <= {w}) AS DOUBLE) / count(*) * 100 AS repeat_{w}d' for w in (30, 60, 90))} FROM r GROUP BY 1)
SELECT m.promo_id, avg_discount_rate, return_rate, repeat_30d, repeat_60d, repeat_90d, num_orders FROM m LEFT JOIN q ON m.promo_id = q.promo_id WHERE num_orders >= 30""")
def _(t):
    return C.promo_stats(t)


# -- promotion cohorts --------------------------------------------------------

FIRST_SQL = """
f AS (SELECT customer_id, arg_min(order_id, (order_date, order_id)) AS first_order_id, min(order_date) AS fd FROM live_orders_v GROUP BY 1),
bych AS (SELECT f.*, first_order_id IN (SELECT order_id FROM items_v WHERE promo_id IS NOT NULL OR promo_id_2 IS NOT NULL) AS is_promo FROM f),
byday AS (SELECT f.*, fd IN (SELECT date FROM promo_days_v) AS is_promo FROM f)"""


@query("an_promo_retention", f"""WITH {FIRST_SQL},
h AS (SELECT customer_id, is_promo, fd, m, CAST(fd + to_months(m) AS DATE) AS target FROM bych, (VALUES (1), (3), (6)) v(m)),
e AS (SELECT * FROM h WHERE target <= (SELECT max(order_date) FROM live_orders_v)),
r AS (SELECT e.customer_id, m, is_promo, bool_or(coalesce(abs(date_diff('day', target, order_date)) <= 15 AND order_date > fd, false)) AS hit FROM e LEFT JOIN live_orders_v o ON o.customer_id = e.customer_id GROUP BY 1, 2, 3),
c AS (SELECT m, is_promo, count(*) AS n, CASE WHEN count(*) >= 10 THEN CAST(count(*) FILTER (WHERE hit) AS DOUBLE) / count(*) * 100 END AS rate FROM r GROUP BY 1, 2),
w AS (SELECT m AS month_number, max(rate) FILTER (WHERE is_promo) AS promo_rate, max(rate) FILTER (WHERE NOT is_promo) AS organic_rate FROM c GROUP BY 1),
g AS (SELECT *, organic_rate - promo_rate AS gap_pp FROM w),
s AS (SELECT coalesce(min(d), 0) >= 0 AS wide FROM (SELECT gap_pp - lag(gap_pp) OVER (ORDER BY month_number) AS d FROM g WHERE gap_pp IS NOT NULL))
SELECT g.*, wide AS is_widening FROM g, s""")
def _(t):
    live = live_orders(t.orders)
    return C.retention_gap(C.period_retention(live, C.cohort_by_first_order(t, live), [1, 3, 6]))


@query("an_net_clv", f"""WITH {FIRST_SQL},
rf AS (SELECT order_id, {dsum('refund_amount')} AS refund FROM returns_v GROUP BY 1),
op AS (SELECT order_id, customer_id, {dsum('gross_profit')} AS p FROM base_lines_v GROUP BY 1, 2),
clv AS (SELECT customer_id, {dsum('p - coalesce(refund, 0)')} AS net_clv FROM op LEFT JOIN rf USING (order_id) GROUP BY 1),
v AS (SELECT is_promo, net_clv FROM byday JOIN clv ON byday.customer_id = clv.customer_id),
q AS (SELECT quantile_cont(net_clv, 0.97) AS q FROM v)
SELECT is_promo, count(*) AS n_customers, round(quantile_cont(least(net_clv, q), 0.5), 4) AS median_clv FROM v, q GROUP BY 1""")
def _(t):
    return C.net_clv_by_cohort(t).withColumn("median_clv", F.round("median_clv", 4))


@query("an_cohort_return_rate", f"""WITH {FIRST_SQL}
SELECT is_promo, count(*) AS n_orders, count(*) FILTER (WHERE order_id IN (SELECT order_id FROM returns_v)) AS n_returned,
       CAST(count(*) FILTER (WHERE order_id IN (SELECT order_id FROM returns_v)) AS DOUBLE) / count(*) * 100 AS return_rate
FROM live_orders_v o JOIN byday ON o.customer_id = byday.customer_id GROUP BY 1""")
def _(t):
    return C.cohort_return_rate(t)


@query("an_cohort_rating", f"""WITH {FIRST_SQL},
rv AS (SELECT order_id, arg_min(rating, (review_date, rating)) AS rating FROM reviews_v GROUP BY 1)
SELECT is_promo, avg(rating) AS avg_rating, count(*) AS n_rated FROM live_orders_v o JOIN rv ON o.order_id = rv.order_id JOIN byday ON o.customer_id = byday.customer_id GROUP BY 1""")
def _(t):
    return C.cohort_rating(t)


@query("an_discount_dependency", f"""WITH {FIRST_SQL},
u AS (SELECT o.customer_id, is_promo, o.order_id IN (SELECT order_id FROM items_v WHERE discount_amount > 0) AS used FROM live_orders_v o JOIN byday ON o.customer_id = byday.customer_id WHERE order_date > fd),
c AS (SELECT customer_id, is_promo, CAST(count(*) FILTER (WHERE used) AS DOUBLE) / count(*) * 100 AS dep FROM u GROUP BY 1, 2)
SELECT is_promo, count(*) AS n_customers, round(avg(dep), 6) AS pct_promo_dependent, CAST(count(*) FILTER (WHERE dep = 0) AS DOUBLE) / count(*) * 100 AS pct_never_promo,
       CAST(count(*) FILTER (WHERE dep = 100) AS DOUBLE) / count(*) * 100 AS pct_always_promo FROM c GROUP BY 1""")
def _(t):
    return C.discount_dependency(t)


@query("an_cohort_yearly_value", f"""WITH {FIRST_SQL},
c AS (SELECT o.customer_id, CAST(year(order_date) AS INT) AS year, is_promo, count(DISTINCT o.order_id) AS n, coalesce({dsum('net_revenue')}, 0) AS r
      FROM live_orders_v o LEFT JOIN order_money_v m ON o.order_id = m.order_id JOIN bych ON o.customer_id = bych.customer_id GROUP BY 1, 2, 3),
a AS (SELECT year, is_promo, CAST(sum(n) AS DOUBLE) / count(*) AS ao, {dsum('r')} / count(*) AS ar, count(*) AS k FROM c GROUP BY 1, 2),
w AS (SELECT year, max(ao) FILTER (WHERE is_promo) AS promo_avg_orders, max(ao) FILTER (WHERE NOT is_promo) AS organic_avg_orders, max(ar) FILTER (WHERE is_promo) AS promo_avg_revenue,
      max(ar) FILTER (WHERE NOT is_promo) AS organic_avg_revenue, max(k) FILTER (WHERE is_promo) AS promo_customers, max(k) FILTER (WHERE NOT is_promo) AS organic_customers FROM a GROUP BY 1)
SELECT *, CASE WHEN promo_avg_orders > 0 THEN (organic_avg_orders - promo_avg_orders) / promo_avg_orders * 100 END AS orders_gap_pct,
       CASE WHEN promo_avg_revenue > 0 THEN (organic_avg_revenue - promo_avg_revenue) / promo_avg_revenue * 100 END AS revenue_gap_pct FROM w""")
def _(t):
    return C.cohort_yearly_value(t)
