"""Joins beyond the plain equi join.

Interval and nearest-date joins are rewritten to equi joins on the day: the
interval side is expanded to its days.  That side is a calendar or a campaign
list, so it grows with the length of the calendar, never with the facts.  No
join is forced to broadcast; the planner decides from measured sizes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import day_range


def left_chain(skeleton: DataFrame, frames: list[DataFrame], on: str | list[str]) -> DataFrame:
    """Skeleton left-joined with each frame in turn."""
    return reduce(lambda a, b: a.join(b, on, "left"), frames, skeleton)


def calendar(spark_df: DataFrame, date: str, keys: list[str] | None = None) -> DataFrame:
    """Every day from the first to the last date of a frame, per key if given."""
    bounds = spark_df.groupBy(*(keys or [])).agg(F.min(date).alias("_lo"), F.max(date).alias("_hi"))
    return bounds.select(*(keys or []), F.explode(day_range("_lo", "_hi")).alias(date))


def member_flag(df: DataFrame, ids: DataFrame, key: str, name: str) -> DataFrame:
    """True where the key occurs in ``ids``; NULL keys are not members."""
    marks = ids.select(key).where(F.col(key).isNotNull()).distinct().withColumn(name, F.lit(True))
    return df.join(marks, key, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def orphan_counts(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Foreign keys without a parent and how often each occurs.

    The child is counted per key before the join, so a hot key is one row.
    """
    keys = child.where(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(F.col(pk).alias("key")).where(F.col("key").isNotNull())
    return keys.join(known, "key", "left_anti")


def expand_days(intervals: DataFrame, start: Column | str, end: Column | str, day: str = "date") -> DataFrame:
    """One row per interval and day it covers, both ends included."""
    return intervals.withColumn(day, F.explode(day_range(start, end)))


def days_in_any(intervals: DataFrame, start: str, end: str, day: str = "date") -> DataFrame:
    """The distinct days covered by at least one interval."""
    return expand_days(intervals.select(start, end), start, end, day).select(day).distinct()


def nearest_marks(days: DataFrame, marks: DataFrame, date: str = "date", missing: int = 999) -> DataFrame:
    """Days to the next mark (0 on a mark) and from the last mark before the day.

    ``marks`` is a short list of dates.  Each gap between two marks is expanded
    to its days, which turns the search into an equi join.
    """
    # Two stand-ins, one before and one after all days and marks, close the open gaps.
    span = days.select(F.col(date).alias("d")).unionByName(marks.select(F.col(date).alias("d"))).agg(
        F.date_sub(F.min("d"), 1).alias("lo"), F.date_add(F.max("d"), 1).alias("hi"))
    edges = span.select(F.explode(F.array("lo", "hi")).alias("d"), F.lit(False).alias("real"))
    points = marks.select(F.col(date).alias("d")).distinct().withColumn("real", F.lit(True)).unionByName(edges)
    order = W.orderBy("d")
    gaps = (
        points.withColumns({"p": F.lag("d").over(order), "p_real": F.lag("real").over(order)})
        .where(F.col("p").isNotNull())
        .select(F.explode(day_range(F.date_add("p", 1), F.col("d"))).alias(date), "d", "real", "p", "p_real")
    )
    return days.join(gaps, date, "left").withColumns({
        "days_to_next": F.when(F.col("real"), F.datediff("d", date)).otherwise(F.lit(missing)).cast("int"),
        "days_from_last": F.when(F.col("p_real"), F.datediff(date, "p")).otherwise(F.lit(missing)).cast("int"),
    }).drop("d", "real", "p", "p_real")


def days_before_start(starts: DataFrame, start: str, lookahead: int, date: str = "date") -> DataFrame:
    """Each start with the ``lookahead`` days before it and the days left."""
    ahead = starts.withColumn(
        date, F.explode(day_range(F.date_sub(start, lookahead), F.date_sub(start, 1))))
    return ahead.withColumn("days_to", F.datediff(start, date))


def next_start_within(days: DataFrame, starts: DataFrame, start: str, lookahead: int, date: str = "date") -> DataFrame:
    """All pairs of a day and a start 1..lookahead days later, with the distance."""
    return days.join(days_before_start(starts, start, lookahead, date), date)


def shifted_value(df: DataFrame, date: str, value: str, days: int, name: str, keys: list[str] | None = None) -> DataFrame:
    """Value ``days`` days ago by date equality, not by row offset."""
    past = df.select(*(keys or []), F.date_add(date, days).alias(date), F.col(value).alias(name))
    return df.join(past, [*(keys or []), date], "left")


def overlap_flag(windows: DataFrame, intervals: DataFrame, key: str, w_start: str, w_end: str, start: str, end: str, name: str) -> DataFrame:
    """Whether each window shares at least one day with any interval."""
    busy = days_in_any(intervals, start, end, "_day")
    hit = expand_days(windows.select(key, w_start, w_end), w_start, w_end, "_day").join(busy, "_day", "left_semi")
    return member_flag(windows, hit, key, name)


def range_pairs(
    left: DataFrame, right: DataFrame, keys: list[str], start: str, end: str, point: str, bucket_days: int = 32,
) -> DataFrame:
    """Rows of ``right`` whose ``point`` date lies in ``[start, end]`` of a left row with equal keys.

    Both sides are cut into time buckets that join the equality, so the points
    of one hot key spread over many tasks and only near dates meet.
    """
    epoch = F.lit("1970-01-01").cast("date")

    def bucket(c: Column) -> Column:
        return F.floor(F.datediff(c, epoch) / bucket_days)

    cut = left.withColumn("_b", F.explode(F.sequence(bucket(F.col(start)), bucket(F.col(end)))))
    tagged = right.withColumn("_b", bucket(F.col(point)))
    return cut.join(tagged, [*keys, "_b"]).where(F.col(point).between(F.col(start), F.col(end))).drop("_b")
