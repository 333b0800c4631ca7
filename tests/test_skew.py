"""Per-customer operators against brute force, with one customer holding most rows."""

import datetime as dt
import random
from collections import defaultdict

from saleslens.operators.joins import range_pairs
from saleslens.operators.windows import event_rank, previous_day
from saleslens.plans.customers import first_orders, inter_order_gap_median, period_retention

START = dt.date(2020, 1, 1)


def events(n=1500, days=120, seed=5):
    rnd = random.Random(seed)
    return [(i, 0 if rnd.random() < 0.5 else rnd.randrange(1, 40), START + dt.timedelta(days=rnd.randrange(days))) for i in range(n)]


def frame(spark, data):
    return spark.createDataFrame(data, "order_id bigint, customer_id bigint, order_date date")


def by_customer(data):
    out = defaultdict(list)
    for i, c, d in data:
        out[c].append((d, i))
    return {c: sorted(v) for c, v in out.items()}


def test_previous_day_and_rank(spark):
    data = events()
    want_prev, want_rank = {}, {}
    for seq in by_customer(data).values():
        for pos, (_, i) in enumerate(seq):
            want_prev[i] = seq[pos - 1][0] if pos else None
            want_rank[i] = pos + 1
    df = frame(spark, data)
    assert {r.order_id: r.p for r in previous_day(df, "customer_id", "order_date", "order_id", "p").collect()} == want_prev
    ranked = event_rank(df, "customer_id", "order_date", "order_id", "r", chunk=16)
    assert {r.order_id: r.r for r in ranked.collect()} == want_rank


def test_range_pairs(spark):
    rnd = random.Random(9)
    wins = [(w, rnd.randrange(0, 4), START + dt.timedelta(days=rnd.randrange(300))) for w in range(60)]
    wins = [(w, c, s, s + dt.timedelta(days=rnd.randrange(0, 95))) for w, c, s in wins]
    pts = [(p, rnd.randrange(0, 4), START + dt.timedelta(days=rnd.randrange(400))) for p in range(300)]
    got = range_pairs(
        spark.createDataFrame(wins, "w int, c int, s date, e date"), spark.createDataFrame(pts, "p int, c int, d date"),
        ["c"], "s", "e", "d", bucket_days=32)
    assert sorted((r.w, r.p) for r in got.collect()) == sorted((w, p) for w, c, s, e in wins for p, k, d in pts if k == c and s <= d <= e)


def test_first_orders_and_gap_median(spark):
    data = events(seed=6)
    seqs = by_customer(data)
    got = {r.customer_id: (r.first_order_date, r.first_order_id) for r in first_orders(frame(spark, data)).collect()}
    assert got == {c: s[0] for c, s in seqs.items()}
    gaps = []
    for s in seqs.values():
        uniq = sorted({d for d, _ in s})
        gaps += [(b - a).days for a, b in zip(uniq, uniq[1:])]
    gaps.sort()
    mid = len(gaps) // 2
    want = gaps[mid] if len(gaps) % 2 else (gaps[mid - 1] + gaps[mid]) / 2
    assert inter_order_gap_median(frame(spark, data)).first()[0] == want


def test_retention_by_fixed_month_length(spark):
    data = events(seed=8, days=200)
    from pyspark.sql import functions as F

    df = frame(spark, data)
    cohorts = first_orders(df).withColumn("is_promo", F.col("customer_id") % 2 == 0)
    got = {(r.month_number, r.is_promo): (r.n_eligible, r.n_retained, r.retention_rate)
           for r in period_retention(df, cohorts, [1, 3], window_days=5, month_days=30).collect()}
    last = max(d for _, _, d in data)
    for m in (1, 3):
        for even in (True, False):
            hit = n = 0
            for c, s in by_customer(data).items():
                target = s[0][0] + dt.timedelta(days=30 * m)
                if (c % 2 == 0) != even or target > last:
                    continue
                n += 1
                hit += any(abs((d - target).days) <= 5 and d > s[0][0] for d, _ in s)
            assert got[(m, even)] == (n, hit, hit / n * 100.0 if n >= 10 else None)
