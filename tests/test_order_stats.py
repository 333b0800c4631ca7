"""Exact order statistics against brute force, with ties and hot groups."""

import random

import numpy as np
import pytest

from saleslens.operators.order_stats import exact_quantiles, sample_rows, top_fraction


def rows(seed, hot=0.34, n=4000):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if rnd.random() < hot else f"k{rnd.randrange(20)}"
        value = rnd.choice([round(rnd.gauss(100, 30), 2), 50.0, 50.0, 75.25])
        out.append((key, i, value))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_quantiles_per_key(spark, seed):
    data = rows(seed)
    df = spark.createDataFrame(data + [("empty", -1, None)], "k string, id bigint, v double")
    probs = {"p01": 0.01, "p50": 0.5, "p97": 0.97, "p100": 1.0}
    got = {r.k: r for r in exact_quantiles(df, ["k"], "v", probs).collect()}
    assert "empty" not in got
    for key in {k for k, _, _ in data}:
        vals = np.array([v for k, _, v in data if k == key])
        for name, p in probs.items():
            assert got[key][name] == pytest.approx(np.quantile(vals, p), abs=1e-9)


def test_quantile_without_keys_and_of_one_row(spark):
    df = spark.createDataFrame([(3.5,)], "v double")
    assert exact_quantiles(df, [], "v", {"m": 0.5}).first().m == 3.5
    many = spark.createDataFrame([(float(i % 7),) for i in range(1000)], "v double")
    assert exact_quantiles(many, [], "v", {"m": 0.5}).first().m == np.median([i % 7 for i in range(1000)])


@pytest.mark.parametrize("fraction", [0.1, 0.5, 0.0001])
def test_top_fraction_splits_ties_by_id(spark, fraction):
    data = rows(3)
    df = spark.createDataFrame(data, "k string, id bigint, v double")
    want = set()
    for key in {k for k, _, _ in data}:
        group = sorted([(-v, i) for k, i, v in data if k == key])
        want |= {i for _, i in group[: int(len(group) * fraction)]}
    assert {r.id for r in top_fraction(df, ["k"], "v", "id", fraction).collect()} == want


def test_top_fraction_when_all_rows_are_equal(spark):
    df = spark.createDataFrame([("a", i, 1.0) for i in range(100)], "k string, id bigint, v double")
    assert sorted(r.id for r in top_fraction(df, ["k"], "v", "id", 0.1).collect()) == list(range(10))


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.range(1000)
    a = {r.id for r in sample_rows(df.repartition(2), "id", 50, 7).collect()}
    assert a == {r.id for r in sample_rows(df.repartition(13), "id", 50, 7).collect()} and len(a) == 50
