"""Number expressions whose results do not depend on row order or partitions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Money in the tables has at most four decimals.
MONEY = "decimal(18,4)"
_UNITS = 10_000
_LIMB = 1 << 20

__all__ = [
    "MONEY", "as_col", "exact_sum", "exact_mean", "ratio", "pct", "clip",
    "flag", "rate_where", "sum_where", "round6", "geometric_growth", "map_values",
]


def as_col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def exact_sum(x: Column | str) -> Column:
    """Sum of money as double; NULL when every input is NULL.

    Amounts become whole units of 1/10000 and are added as integers, so the same
    bits come out however tasks are split, retried or merged.  The integers are
    added in two limbs: each stays far from overflow for trillions of rows, and
    plain long additions cost much less than a decimal per row.
    """
    units = F.rint(as_col(x) * _UNITS).cast("bigint")
    high = F.sum(F.shiftright(units, 20)).cast("decimal(20,0)")
    low = F.sum(units.bitwiseAND(_LIMB - 1)).cast("decimal(20,0)")
    return (high * F.lit(_LIMB).cast("decimal(8,0)") + low).cast("double") / float(_UNITS)


def exact_mean(x: Column | str) -> Column:
    """Mean of money as double over the non-NULL inputs."""
    return F.try_divide(exact_sum(x), F.count(as_col(x)))


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b as double, NULL where b is zero or either side is NULL."""
    return F.try_divide(as_col(a).cast("double"), as_col(b).cast("double"))


def pct(a: Column | str, b: Column | str) -> Column:
    return ratio(a, b) * F.lit(100.0)



def clip(x: Column | str, lower: float | Column | None = None, upper: float | Column | None = None) -> Column:
    """Bound x, keeping NULL as NULL (``greatest``/``least`` alone skip NULLs)."""
    x = as_col(x)
    out = x
    if lower is not None:
        out = F.greatest(out, lower if isinstance(lower, Column) else F.lit(lower))
    if upper is not None:
        out = F.least(out, upper if isinstance(upper, Column) else F.lit(upper))
    return F.when(x.isNotNull(), out)


def flag(cond: Column) -> Column:
    """1 where the condition holds, else 0 (also for an unknown condition)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def rate_where(cond: Column) -> Column:
    """Share of rows that meet a condition, 0..1; an unknown condition counts as no."""
    return F.try_divide(F.count_if(cond).cast("double"), F.count(F.lit(1)).cast("double"))


def sum_where(x: Column | str, cond: Column) -> Column:
    """Exact money sum over the rows that meet a condition (NULL when there are none)."""
    return exact_sum(F.when(cond, as_col(x)))


def round6(x: Column | str) -> Column:
    return F.round(as_col(x), 6)


def geometric_growth(step: Column | str) -> Column:
    """Geometric mean of yearly growth factors."""
    return F.exp(F.avg(F.ln(as_col(step))))


def map_values(x: Column | str, mapping: dict, default=None) -> Column:
    """Replace values by a fixed mapping; other values become ``default``."""
    x = as_col(x)
    out = None
    for key, value in mapping.items():
        out = F.when(x == F.lit(key), F.lit(value)) if out is None else out.when(x == F.lit(key), F.lit(value))
    return out.otherwise(F.lit(default)) if default is not None else out
