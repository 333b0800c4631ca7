"""Projection, filter, dedup, split and set operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import ratio


def line_revenue(df: DataFrame) -> DataFrame:
    """Gross line value and the value net of the discount amount."""
    gross = F.col("unit_price") * F.col("quantity")
    return df.withColumns({"gross_revenue": gross, "net_revenue": gross - F.col("discount_amount")})


def line_margin(df: DataFrame) -> DataFrame:
    """Revenue, cost, profit and guarded rates of a line joined with its product."""
    revenue, cost, listed = F.col("revenue_line"), F.col("cogs_line"), F.col("list_revenue")
    return (
        df.withColumns({
            "revenue_line": F.col("unit_price") * F.col("quantity"),
            "cogs_line": F.col("cogs") * F.col("quantity"),
            "list_revenue": F.col("price") * F.col("quantity"),
        })
        .withColumn("gross_profit", revenue - cost - F.col("discount_amount"))
        .withColumns({
            "margin_rate": F.when(revenue > 0, ratio("gross_profit", revenue)),
            "discount_rate": F.when(listed > 0, 1 - ratio(revenue, listed)),
            "has_promo": F.col("discount_amount") > 0,
        })
    )


def direct_discount(df: DataFrame) -> DataFrame:
    """Discount share of the undiscounted line value."""
    listed = F.col("unit_price") * F.col("quantity")
    return df.withColumns({
        "list_revenue": listed,
        "actual_revenue": listed - F.col("discount_amount"),
        "discount_rate": F.when(listed > 0, ratio("discount_amount", listed)),
    })



def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop the listed columns that are present."""
    return df.drop(*[n for n in names if n in df.columns])


def columns_by_prefix(columns: Iterable[str], groups: Iterable[str], prefixes: Mapping[str, Iterable[str]]) -> list[str]:
    """Columns whose name starts with a prefix of one of the enabled groups, in order."""
    allowed = tuple(p for g in groups for p in prefixes.get(g, ()))
    return [c for c in columns if c.startswith(allowed)] if allowed else []


def fill_null(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def dedup_first(df: DataFrame, subset: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first by a full ordering, all its columns kept.

    A ``min`` over a struct instead of a ranked window: it combines map-side, so
    a hot key costs one row per task.  Columns of ``order`` go first in the
    struct, the rest break remaining ties.
    """
    rest = [c for c in df.columns if c not in subset]
    picked = df.groupBy(*subset).agg(
        F.min(F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], *rest)).alias("_row"))
    return picked.select(*subset, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)


def split_by_date(
    df: DataFrame, date: str, train_end: Column, test_start: Column, targets: list[str],
    observed: list[str], must_be_set: list[str],
) -> DataFrame:
    """Mark rows as train or test, blank the targets of test, and check the split.

    Observed columns (known only after the day) are dropped first.  One
    aggregate checks that no row falls outside both parts and that the listed
    features have no NULL in test; a violation raises.
    """
    kept = drop_columns(df, observed)
    part = F.when(F.col(date) <= train_end, "train").when(F.col(date) >= test_start, "test")
    marked = kept.withColumn("split", part)
    blanks = [F.count_if((F.col("split") == "test") & F.col(c).isNull()).alias(c) for c in must_be_set]
    checks = marked.agg(F.count_if(F.col("split").isNull()).alias("_lost"), *blanks).first().asDict()
    if checks["_lost"]:
        raise ValueError(f"{checks['_lost']} rows are in neither part")
    empty = {c: n for c, n in checks.items() if c != "_lost" and n}
    if empty:
        raise ValueError(f"features with NULL in the test part: {empty}")
    left = [c for c in observed if c in marked.columns]
    if left:
        raise ValueError(f"observed columns left: {left}")
    return marked.withColumns({c: F.when(F.col("split") == "train", F.col(c)) for c in targets})


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


def distinct_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of a that are not in b."""
    return a.subtract(b)


def first_value_per_key(df: DataFrame, key: str, value: str, order: list[str]) -> DataFrame:
    """First non-NULL value per key by a full ordering, NULL when there is none."""
    seen = F.when(F.col(value).isNotNull(), F.struct(*order, value))
    return df.groupBy(key).agg(F.min(seen).alias("_row")).select(key, F.col("_row")[value].alias(value))


def mode_per_key(df: DataFrame, key: str, value: str, name: str, weight: str | None = None) -> DataFrame:
    """Most frequent value per key, rows counted once or by a weight; ties go to the smaller value."""
    n = F.sum(weight) if weight else F.count(F.lit(1))
    counts = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(n.alias("_n"))
    return counts.groupBy(key).agg(F.min_by(F.col(value), F.struct(-F.col("_n"), F.col(value))).alias(name))


def top_key(df: DataFrame, key: str, value: str, largest: bool = True) -> DataFrame:
    """The one row with the largest (or smallest) value; ties go to the smaller key."""
    order = F.desc(value) if largest else F.asc(value)
    return df.where(F.col(value).isNotNull()).orderBy(order, F.asc(key)).limit(1)


def share_within(df: DataFrame, value: str, within: list[str], name: str) -> DataFrame:
    """Value as a share of the sum of its group.  For already aggregated rows."""
    total = F.sum(value).over(W.partitionBy(*within))
    return df.withColumn(name, ratio(value, total))



def equal_width_bins(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Row counts over equal-width bins of [min, max]; empty bins are kept.

    The range comes from a scalar subquery; the maximum belongs to the last bin.
    """
    span = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    v = F.col(value)
    pos = F.floor(F.try_divide((v - F.col("_s.lo")) * bins, F.col("_s.hi") - F.col("_s.lo")))
    found = (
        df.where(v.isNotNull()).withColumn("_s", span)
        .select(F.least(F.coalesce(pos, F.lit(0)), F.lit(bins - 1)).cast("int").alias("bin"))
        .groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    )
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(found, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def complete_keys(df: DataFrame, key: str, keys: list, fill: Mapping[str, object]) -> DataFrame:
    """Result completed to a fixed key list; missing numbers are filled."""
    wanted = df.sparkSession.createDataFrame([(k,) for k in keys], f"{key} {df.schema[key].dataType.simpleString()}")
    return fill_null(wanted.join(df, key, "left"), fill)


def case_label(df: DataFrame, name: str, cases: list[tuple[Column, str]], default: str) -> DataFrame:
    out = F.when(*[cases[0][0], F.lit(cases[0][1])])
    for cond, label in cases[1:]:
        out = out.when(cond, F.lit(label))
    return df.withColumn(name, out.otherwise(F.lit(default)))
