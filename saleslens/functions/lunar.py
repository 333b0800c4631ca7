"""The lunar new year of any year, from the mean and periodic terms of new moon and sun.

Lunar months begin on the day of the new moon.  The eleventh month holds the winter
solstice, and the new year is the second new moon after it, or the third where one of
the two months between lacks a principal term of the sun (a leap month).  Days are those
of a fixed offset from universal time (Vietnam: 7 hours).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = ["lunar_new_years"]

RADIANS = math.pi / 180
MONTH = 29.530588853
# Julian dates of the first new moon of 1900 and of the epoch J2000, and the Julian day of 1970-01-01.
NEW_MOON_1900, J2000, UNIX_DAY = 2415021.076998695, 2451545.0, 2440588
# Amplitudes in days of the periodic terms of new moon, by multiples of the sun's anomaly, the moon's
# anomaly and the moon's argument of latitude (Meeus, Astronomical Formulae).
MOON_TERMS = [
    (0.0021, 2, 0, 0), (-0.4068, 0, 1, 0), (0.0161, 0, 2, 0), (-0.0004, 0, 3, 0), (0.0104, 0, 0, 2), (-0.0051, 1, 1, 0),
    (-0.0074, 1, -1, 0), (0.0004, 1, 0, 2), (-0.0004, -1, 0, 2), (-0.0006, 0, 1, 2), (0.0010, 0, -1, 2), (0.0005, 1, 2, 0)]


def _powers(t: str, *factors: float) -> Column:
    """A polynomial of a column, lowest power first."""
    value = F.lit(factors[-1])
    for f in reversed(factors[:-1]):
        value = value * F.col(t) + f
    return value


def _with_new_moon(df: DataFrame, k: str, hours: float) -> DataFrame:
    """``df`` with ``_day``: the Julian day on which new moon ``k`` (counted from 1900) falls."""
    out = df.withColumn("_t", F.col(k) / 1236.85)
    out = out.withColumns({
        "_sun": (_powers("_t", 359.2242, 0, -0.0000333, -0.00000347) + 29.10535608 * F.col(k)) * RADIANS,
        "_moon": (_powers("_t", 306.0253, 0, 0.0107306, 0.00001236) + 385.81691806 * F.col(k)) * RADIANS,
        "_node": (_powers("_t", 21.2964, 0, -0.0016528, -0.00000239) + 390.67050646 * F.col(k)) * RADIANS,
        "_mean": _powers("_t", 2415020.75933, 0, 0.0001178, -0.000000155) + 29.53058868 * F.col(k)
        + 0.00033 * F.sin(_powers("_t", 166.56, 132.87, -0.009173) * RADIANS)})
    terms = _powers("_t", 0.1734, -0.000393) * F.sin("_sun")
    for size, a, b, c in MOON_TERMS:
        terms = terms + size * F.sin(a * F.col("_sun") + b * F.col("_moon") + c * F.col("_node"))
    clock = _powers("_t", -0.000278, 0.000265, 0.000262)  # of dynamic against universal time, in days
    return out.withColumn("_day", F.floor(F.col("_mean") + terms - clock + 0.5 + hours / 24)).drop("_t", "_sun", "_moon", "_node", "_mean")


def _with_sign(df: DataFrame, hours: float) -> DataFrame:
    """``df`` with ``_sign``: the twelfth of the ecliptic, from 0, in which the sun stands when ``_day`` begins."""
    out = df.withColumn("_t", (F.col("_day") - 0.5 - hours / 24 - J2000) / 36525)
    out = out.withColumn("_sun", _powers("_t", 357.52910, 35999.05030, -0.0001559, -0.00000048) * RADIANS)
    center = (_powers("_t", 1.914600, -0.004817, -0.000014) * F.sin("_sun") + _powers("_t", 0.019993, -0.000101) * F.sin(2 * F.col("_sun"))
              + 0.000290 * F.sin(3 * F.col("_sun")))
    longitude = F.pmod(_powers("_t", 280.46645, 36000.76983, 0.0003032) + center, F.lit(360.0))
    return out.withColumn("_sign", F.floor(longitude / 30).cast("int")).drop("_t", "_sun")


def lunar_new_years(years: DataFrame, year: str = "year", hours: float = 7) -> DataFrame:
    """Distinct ``years`` with ``new_year``: the date of the lunar new year in each.

    Every year looks at the new moons around the end of the year before and around
    its own end, a dozen rows.
    """
    epoch = F.lit("1970-01-01").cast("date")
    ends = years.select(year, F.explode(F.array(F.col(year) - 1, F.col(year))).alias("_end")).withColumn(
        "_last", F.datediff(F.make_date("_end", F.lit(12), F.lit(31)), epoch) + UNIX_DAY)
    moons = ends.select("*", F.explode(F.sequence(F.lit(-2), F.lit(4))).alias("_i")).withColumn(
        "_k", F.col("_i") + F.floor((F.col("_last") - NEW_MOON_1900) / MONTH))
    moons = _with_sign(_with_new_moon(moons, "_k", hours), hours)
    # The eleventh month begins with the last new moon of the year before the solstice.
    before = (F.col("_day") <= F.col("_last")) & (F.col("_sign") < 9)
    opening = F.col("_end") < F.col(year)
    found = moons.groupBy(year).agg(
        F.max(F.when(before & opening, F.col("_day"))).alias("_eleventh"), F.max(F.when(before & ~opening, F.col("_day"))).alias("_next"),
        F.sort_array(F.collect_list(F.when(opening, F.struct("_day", "_sign")))).alias("_moons"))
    # The months after it; one that has no principal term begins and ends in the same sign.
    found = found.withColumn("_after", F.filter("_moons", lambda m: m["_day"] > F.col("_eleventh")))
    sign = [F.col("_after")[i]["_sign"] for i in range(3)]
    leap = (F.col("_next") - F.col("_eleventh") > 365) & ((sign[0] == sign[1]) | (sign[1] == sign[2]))
    at = F.when(leap, F.col("_after")[2]["_day"]).otherwise(F.col("_after")[1]["_day"])
    return found.select(year, F.date_add(epoch, (at - UNIX_DAY).cast("int")).alias("new_year"))
