"""Distinct counts by bitmaps against countDistinct at every grain."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from saleslens.operators.distinct import daily_bitmaps, distinct_counts

START = dt.date(2019, 11, 20)


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(1)
    ids = [0, 1, 32767, 32768, 65535, -1, -32768, 2**40, None] + [rng.randrange(200_000) for _ in range(400)]
    data = [(START + dt.timedelta(days=rng.randrange(60)), rng.choice("xy"), rng.choice(ids), rng.randrange(50)) for _ in range(6000)]
    return spark.createDataFrame(data + [(None, "x", 5, 5)], "day date, part string, a long, b int").repartition(5)


GRAINS = {"day": lambda: F.col("date"), "month": lambda: F.trunc("date", "month"), "year": lambda: F.year("date")}


@pytest.mark.parametrize("grain", [None, *GRAINS])
def test_counts_are_exact(rows, grain):
    by = {grain: GRAINS[grain]()} if grain else {}
    got = distinct_counts(daily_bitmaps(rows, "day", {"a": "a", "b": F.col("b")}), ["a", "b"], by)
    plain = rows.withColumn("date", F.col("day"))
    want = plain.groupBy(*[c.alias(n) for n, c in by.items()]).agg(F.countDistinct("a").alias("a"), F.countDistinct("b").alias("b"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))


def test_further_keys(rows):
    bitmaps = daily_bitmaps(rows, "day", {"a": "a"}, by=["part"])
    got = {r.part: r.a for r in distinct_counts(bitmaps, ["a"], {"part": "part"}).collect()}
    assert got == {r.part: r.a for r in rows.groupBy("part").agg(F.countDistinct("a").alias("a")).collect()}
    assert max(len(r.bits) for r in bitmaps.collect()) == 4096


def test_bitmaps_are_those_of_the_library(rows):
    got = daily_bitmaps(rows, "day", {"a": "a", "b": "b"}, by=["part"])
    for kind in ("a", "b"):
        want = rows.where(f"{kind} is not null").groupBy(F.col("day").alias("date"), "part", F.bitmap_bucket_number(kind).alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(kind)).alias("bits"))
        own = got.where(F.col("kind") == kind).select(*want.columns)
        assert sorted(map(str, own.collect())) == sorted(map(str, want.collect()))


def test_rows_meet_in_hash_tables(rows):
    # A sort of all rows, and one of 4 KB bitmaps of days, were what a task's memory grew by.
    plan = daily_bitmaps(rows, "day", {"a": "a", "b": "b"})._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan and " Sort " not in plan


def test_the_query_builds_no_bitmaps_of_days(spark, monkeypatch):
    from saleslens.registry import QUERIES, aggregates

    built = []
    monkeypatch.setattr(aggregates, "daily_bitmaps", lambda *args: built.append(daily_bitmaps(*args)) or built[-1])
    QUERIES["agg_distinct_count"](spark, "/root/testdata/sf0.001")
    dates = {r.date for r in built[0].select("date").distinct().collect()}
    assert dates and all((d.month, d.day) == (1, 1) for d in dates)


def test_no_rows(rows):
    empty = daily_bitmaps(rows.limit(0), "day", {"a": "a"})
    assert [tuple(r) for r in distinct_counts(empty, ["a"]).collect()] == [(0,)]
    with pytest.raises(TypeError):
        daily_bitmaps(rows, "day", {"part": "part"})


def test_one_scan(spark):
    from saleslens.registry import QUERIES

    plan = QUERIES["agg_distinct_count"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2  # lines and orders
