"""Exact order statistics that never sort a whole group in one task.

``percentile`` and ranked windows bring a group to one task.  That is right
where a group is bounded (days of a calendar), not for customers, products or
lines.  Here the rows are first counted per distinct value, cut into buckets of
about equal size, and only the buckets that hold a wanted rank are sorted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.files import materialize

BUCKETS = 128
_ALL = "_all"


def values_at_ranks(
    df: DataFrame, keys: list[str], value: str, ranks: Callable[[Column], Column], buckets: int = BUCKETS,
) -> DataFrame:
    """Values at given 1-based ascending ranks, per group.

    ``ranks`` maps the row count of a group to an array of ranks.  Returns
    (keys, n, rank, value, n_equal, n_upto): the rows of the group, those equal
    to the value and those up to it.  NULL values are not counted.  The result
    is exact: the approximate cuts only decide how rows are spread over tasks.
    """
    group = keys or [_ALL]
    base = df if keys else df.withColumn(_ALL, F.lit(0))
    counted = (
        base.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("_m"))
    )
    probs = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    # The cuts read the count as well, so that all branches share one exchange of
    # the counted rows and the input is scanned once.
    seen = F.when(F.col("_m") > 0, F.col(value))
    cuts = counted.groupBy(*group).agg(
        F.array_distinct(F.percentile_approx(seen, probs, F.lit(10 * buckets))).alias("_cuts"))
    tagged = _with_cuts(counted, cuts, keys).withColumn(
        "_b", _bucket_of(F.col(value), F.col("_cuts"), buckets)).drop("_cuts")
    sizes = tagged.groupBy(*group, "_b").agg(F.sum("_m").alias("_size"))
    upto = W.partitionBy(*group).orderBy("_b")
    wanted = (
        sizes.withColumns({
            "_before": F.sum("_size").over(upto) - F.col("_size"),
            "n": F.sum("_size").over(W.partitionBy(*group)),
        })
        .withColumn("_ranks", F.filter(
            F.array_distinct(ranks(F.col("n"))),
            lambda r: (r > F.col("_before")) & (r <= F.col("_before") + F.col("_size"))))
        .where(F.size("_ranks") > 0)
        .select(*group, "_b", "_before", "n", "_ranks")
    )
    reached = F.col("_before") + F.sum("_m").over(W.partitionBy(*group, "_b").orderBy(value))
    found = (
        tagged.join(wanted, [*group, "_b"])
        .withColumn("_upto", reached)
        .withColumn("rank", F.explode("_ranks"))
        .where((F.col("rank") <= F.col("_upto")) & (F.col("rank") > F.col("_upto") - F.col("_m")))
    )
    return found.select(
        *keys, "n", "rank", F.col(value).alias("value"), F.col("_m").alias("n_equal"), F.col("_upto").alias("n_upto"))


def _bucket_of(value: Column, cuts: Column, buckets: int) -> Column:
    """Number of ascending cuts below the value, by bisection.

    Plain comparisons stay inside generated code; a lambda over the array would
    be interpreted once per row and cut.
    """
    found = F.lit(0)
    step = 1 << (buckets - 1).bit_length() - 1
    while step:
        found = found + F.when(F.get(cuts, found + (step - 1)) < value, F.lit(step)).otherwise(F.lit(0))
        step //= 2
    return found


def _with_cuts(counted: DataFrame, cuts: DataFrame, keys: list[str]) -> DataFrame:
    if keys:
        return counted.join(cuts, keys)
    # One group: the cuts are one scalar, no join needed.
    return counted.withColumn("_cuts", cuts.select("_cuts").scalar())


def exact_quantiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Linear-interpolated quantiles per group, one column per name in ``probs``."""

    def position(p: float, n: Column) -> Column:
        return F.lit(float(p)) * (n - 1).cast("double")

    def ranks(n: Column) -> Column:
        pairs = [[F.floor(position(p, n)) + 1, F.ceil(position(p, n)) + 1] for p in probs.values()]
        return F.array(*[r for pair in pairs for r in pair])

    at = values_at_ranks(df, keys, value, ranks)
    picked = []
    for name, p in probs.items():
        pos = position(p, F.col("n"))
        low = F.max(F.when(F.col("rank") == F.floor(pos) + 1, F.col("value").cast("double")))
        high = F.max(F.when(F.col("rank") == F.ceil(pos) + 1, F.col("value").cast("double")))
        part = F.max(pos - F.floor(pos))
        picked.append((low + (high - low) * part).alias(name))
    return at.groupBy(*keys).agg(*picked)


def top_fraction(df: DataFrame, keys: list[str], value: str, row_id: str, fraction: float) -> DataFrame:
    """The top ``int(n * fraction)`` rows per group by (value desc, id asc).

    Instead of ranking, the exact threshold of each group is found and rows are
    filtered by it.  Among rows equal to the threshold the smallest ids are
    taken up to the quota, again by an exact threshold on the id.  Ids are
    unique integers within a group.

    The input is written once to the shared folder, because it is read several
    times; the thresholds (one row per group) are written too, which tells
    whether ties must be split at all.
    """
    rows = materialize(df.where(F.col(value).isNotNull()), "top-input")

    def take(n: Column) -> Column:
        return F.floor(n * F.lit(fraction)).cast("bigint")

    def kth(n: Column) -> Column:
        # Ascending rank of the last row inside the quota; none when the quota is 0.
        return F.when(take(n) > 0, F.array(n - take(n) + 1)).otherwise(F.expr("array()").cast("array<bigint>"))

    open_slots = take(F.col("n")) - (F.col("n") - F.col("n_upto"))
    cut = materialize(values_at_ranks(rows, keys, value, kth).select(
        *keys, F.col("value").alias("_cut"), open_slots.alias("_open"), F.col("n_equal").alias("_ties")), "top-cut")
    marked = rows.join(cut, keys)
    tied = F.col(value) == F.col("_cut")
    split = F.col("_open") < F.col("_ties")
    if cut.where(split).isEmpty():
        return marked.where(F.col(value) >= F.col("_cut")).select(*df.columns)
    last_id = values_at_ranks(
        marked.where(tied & split), [*keys, "_open"], row_id, lambda n: F.array(F.col("_open")),
    ).select(*keys, F.col("value").alias("_last"))
    inside = (F.col(value) > F.col("_cut")) | (tied & (~split | (F.col(row_id) <= F.col("_last"))))
    return marked.join(last_id, keys, "left").where(inside).select(*df.columns)


def sample_rows(df: DataFrame, row_id: str, n: int, seed: int) -> DataFrame:
    """A repeatable sample of n rows: the smallest hashes of (id, seed).

    The plan keeps n rows per task, and the choice does not depend on how the
    input is partitioned.
    """
    key = F.md5(F.concat(F.col(row_id).cast("string"), F.lit(f"-{seed}")))
    return df.withColumn("_h", key).orderBy("_h", row_id).limit(n).drop("_h")


def closest_to_median(df: DataFrame, value: str, key: str, skip: DataFrame | None = None) -> DataFrame:
    """The row whose value is nearest the median of all; listed keys are not eligible."""
    middle = exact_quantiles(df, [], value, {"m": 0.5}).scalar()
    rest = df.join(skip.select(key), key, "left_anti") if skip is not None else df
    return (
        rest.where(F.col(value).isNotNull()).withColumn("_d", F.abs(F.col(value) - middle))
        .orderBy("_d", key).limit(1).drop("_d")
    )
