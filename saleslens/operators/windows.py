"""Window operators.

Three kinds of window are used.  (1) Per series, ordered by day: a partition
holds at most one row per calendar day.  (2) Over one aggregated calendar: the
same bound, one partition.  (3) Per customer over raw events: a hot customer
would make one huge partition, so these first shrink the rows to customer days
or number them chunk by chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import ratio

# A chunk of ids is the largest group that one task ever sorts.
ID_CHUNK = 65_536


def series_window(keys: list[str], date: str):
    return W.partitionBy(*keys).orderBy(date)


def lag_value(df: DataFrame, keys: list[str], date: str, value: str, name: str, n: int = 1) -> DataFrame:
    """Value of the n-th row before, per series."""
    return df.withColumn(name, F.lag(value, n).over(series_window(keys, date)))


def change_from_previous(df: DataFrame, keys: list[str], order: str, value: str, rate: str | None = None, diff: str | None = None) -> DataFrame:
    """Relative and absolute change from the previous row of a short series."""
    prev = F.lag(value).over(series_window(keys, order))
    new = {}
    if rate:
        new[rate] = ratio(value, prev) - 1
    if diff:
        new[diff] = F.col(value) - prev
    return df.withColumns(new)


def rolling(df: DataFrame, keys: list[str], date: str, value: str, widths: list[int], stats: list[str], prefix: str = "roll") -> DataFrame:
    """Row-based rolling statistics ending at the current row; NULLs are skipped."""
    agg = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    return df.withColumns({
        f"{prefix}{w}_{s}": agg[s](value).over(series_window(keys, date).rowsBetween(-(w - 1), 0))
        for w in widths for s in stats
    })


def forward_fill(df: DataFrame, keys: list[str], date: str, values: list[str]) -> DataFrame:
    """Last known value up to the row, per series."""
    w = series_window(keys, date).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumns({v: F.last(v, ignorenulls=True).over(w) for v in values})


def previous_day(df: DataFrame, key: str, date: str, event_id: str, name: str) -> DataFrame:
    """Date of the previous event of the same key, ordered by (date, id).

    Days are ranked, not events: a key has at most one row per calendar day in
    the window.  Later events of one day have that day as their previous date.
    """
    days = df.groupBy(key, date).agg(F.min(event_id).alias("_first"))
    days = days.withColumn("_prev", F.lag(date).over(series_window([key], date)))
    return (
        df.join(days, [key, date])
        .withColumn(name, F.when(F.col(event_id) == F.col("_first"), F.col("_prev")).otherwise(F.col(date)))
        .drop("_first", "_prev")
    )


def day_gaps(df: DataFrame, key: str, date: str, name: str = "gap_days") -> DataFrame:
    """Days since the previous active day, one row per key and active day."""
    days = df.select(key, date).distinct()
    return days.withColumn(name, F.datediff(date, F.lag(date).over(series_window([key], date))))


def event_rank(df: DataFrame, key: str, date: str, event_id: str, name: str, chunk: int = ID_CHUNK) -> DataFrame:
    """1-based position of each event of a key by (date, id); ids are unique integers.

    Rows are numbered inside (key, day, id chunk), which never holds more than
    ``chunk`` rows.  Two running counts are added: of the earlier days of the key
    (at most one row per day) and of the earlier chunks of the day.  So no window
    holds all events of one key.
    """
    tagged = df.withColumn("_c", F.floor(F.col(event_id) / chunk))
    part = [key, date, "_c"]

    def before(keys: list[str], order: str) -> Column:
        return F.coalesce(F.sum("_n").over(W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))

    count = F.count(F.lit(1)).alias("_n")
    chunks = tagged.groupBy(*part).agg(count).select(*part, before([key, date], "_c").alias("_chunks"))
    days = df.groupBy(key, date).agg(count).select(key, date, before([key], date).alias("_days"))
    offsets = chunks.join(days, [key, date]).select(*part, (F.col("_days") + F.col("_chunks")).alias("_before"))
    inside = F.row_number().over(W.partitionBy(*part).orderBy(event_id))
    return (
        tagged.withColumn("_in", inside).join(offsets, part)
        .withColumn(name, (F.col("_before") + F.col("_in")).cast("bigint")).drop("_c", "_in", "_before")
    )


def first_event(df: DataFrame, key: str, date: str, event_id: str) -> DataFrame:
    """Date and id of the first event per key: a map-side combined minimum."""
    return (
        df.groupBy(key).agg(F.min(F.struct(date, event_id)).alias("_f"))
        .select(key, F.col("_f")[date].alias("first_order_date"), F.col("_f")[event_id].alias("first_order_id"))
    )


def neighbor_median(df: DataFrame, year: str, value: str, reach: int = 2, min_neighbors: int = 2, threshold: float = 0.25) -> DataFrame:
    """Median of the years around each year (without it) and a deviation flag.

    Works on one row per year.  Each year is offered to its neighbours by an
    explode of 2 * reach offsets, so the self join is an equi join.
    """
    offsets = [o for o in range(-reach, reach + 1) if o]
    offered = df.select(
        F.explode(F.array(*[F.col(year) + o for o in offsets])).alias(year), F.col(value).alias("_v"))
    around = offered.groupBy(year).agg(F.median("_v").alias("neighbor_median"), F.count("_v").alias("n_neighbors"))
    ref = F.col("neighbor_median")
    off = (F.col("n_neighbors") >= min_neighbors) & (ref != 0) & (F.abs(ratio(F.col(value) - ref, ref)) > threshold)
    return df.join(around, year, "left").withColumn("is_anomalous", F.coalesce(off, F.lit(False)))
