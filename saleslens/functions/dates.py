"""Calendar expressions on DATE columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import as_col, flag

__all__ = [
    "day", "month_start", "months_between_periods", "days_in_month", "shift_days",
    "shift_months", "shift_years", "days_from", "date_parts", "date_flags", "day_range",
    "iso_date",
]


def day(text: str | dt.date) -> Column:
    """A DATE literal."""
    return F.lit(dt.date.fromisoformat(text) if isinstance(text, str) else text)


def month_start(d: Column | str) -> Column:
    return F.trunc(as_col(d), "month")


def months_between_periods(later: Column | str, earlier: Column | str) -> Column:
    """Whole calendar months between the months of two dates."""
    later, earlier = as_col(later), as_col(earlier)
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)


def days_in_month(d: Column | str) -> Column:
    return F.day(F.last_day(as_col(d)))


def shift_days(d: Column | str, n: int | Column) -> Column:
    return F.date_add(as_col(d), n)


def shift_months(d: Column | str, n: int | Column) -> Column:
    return F.add_months(as_col(d), n)


def shift_years(d: Column | str, n: int) -> Column:
    return F.add_months(as_col(d), 12 * n)


def days_from(start: Column | str, end: Column | str) -> Column:
    """Days from start to end, negative when end is earlier."""
    return F.datediff(as_col(end), as_col(start))


def iso_date(d: Column | str) -> Column:
    return F.date_format(as_col(d), "yyyy-MM-dd")


def day_range(start: Column | str, end: Column | str) -> Column:
    """Array of all days from start to end, NULL when end is before start."""
    start, end = as_col(start), as_col(end)
    return F.when(start <= end, F.sequence(start, end, F.expr("interval 1 day")))


def date_parts(d: Column | str) -> dict[str, Column]:
    """Weekday is 0 on Monday; the week number is the ISO week."""
    d = as_col(d)
    return {
        "day_of_week": F.weekday(d),
        "day_of_month": F.day(d),
        "day_of_year": F.dayofyear(d),
        "week_of_year": F.weekofyear(d),
        "month": F.month(d),
        "quarter": F.quarter(d),
        "year": F.year(d),
    }


def date_flags(d: Column | str) -> dict[str, Column]:
    d = as_col(d)
    quarter_start = F.trunc(d, "quarter")
    return {
        "is_weekend": flag(F.weekday(d) >= 5),
        "is_month_start": flag(d == F.trunc(d, "month")),
        "is_month_end": flag(d == F.last_day(d)),
        "is_quarter_start": flag(d == quarter_start),
        "is_quarter_end": flag(d == F.last_day(F.add_months(quarter_start, 2))),
    }
