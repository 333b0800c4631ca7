"""Exact distinct counts that roll up: bitmaps per day and range of ids.

An id is a bit in the bitmap of its range of 32,768 ids.  Rows first meet map-side
as words of 64 ids in hash tables of fixed width; only words are shuffled, and a
range's bitmap is put together where its words meet.  Bitmaps merge by OR, and a
merged bitmap's bits are the distinct ids, so counts by day, month, year or in total
come from one scan.  A range that a day does not touch has no bitmap.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import as_col

#: Words of 64 ids in a range of 32,768.
WORDS = 512


def daily_bitmaps(df: DataFrame, date: str, ids: Mapping[str, Column | str], by: Sequence[str] = ()) -> DataFrame:
    """(date, by, kind, bucket, bits) of whole-number ids; ``ids`` names each kind; NULL ids count nowhere.

    A bitmap has 4 KB, however few ids a day has in its range: where only longer
    periods are asked for, ``date`` should be their first day.
    """
    bad = [k for k, c in ids.items() if df.select(as_col(c)).dtypes[0][1] not in ("tinyint", "smallint", "int", "bigint")]
    if bad:
        raise TypeError(f"bitmaps need whole-number ids, not {bad}")
    each = df.select(F.col(date).alias("date"), *by, F.posexplode(F.array(*[as_col(c).cast("bigint") for c in ids.values()])).alias("_kind", "_id"))
    place = F.bitmap_bit_position("_id")
    # Bit b of a word is bit b % 8 of its byte b / 8, first byte first, as in the library's bitmaps.
    words = each.where("_id is not null").groupBy(
        "date", *by, "_kind", (F.bitmap_bucket_number("_id") * WORDS + F.shiftright(place, 6)).alias("_word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(63).bitwiseXOR(56).cast("int"))).alias("_bits"))
    own = F.sort_array(F.collect_list(F.struct(F.col("_word").bitwiseAND(WORDS - 1).cast("int").alias("at"), F.col("_bits").alias("bits"))))
    ranges = words.groupBy("date", *by, "_kind", F.shiftright("_word", 9).alias("bucket")).agg(own.alias("_own"))

    def digits(word: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get("_own", i - 1)["at"]).otherwise(-1)  # the words between have no bit
        return F.concat(F.call_function("repeat", F.lit("0"), (word["at"] - before - 1) * 16), F.lpad(F.hex(word["bits"]), 16, "0"))

    bits = F.unhex(F.rpad(F.array_join(F.transform("_own", digits), ""), WORDS * 16, "0"))
    return ranges.select("date", *by, F.get(F.array(*[F.lit(k) for k in ids]), F.col("_kind")).alias("kind"), "bucket", bits.alias("bits"))


def distinct_counts(bitmaps: DataFrame, kinds: Sequence[str], by: Mapping[str, Column | str] | None = None) -> DataFrame:
    """Distinct ids of each kind (a column each) per group of days; without ``by`` one row."""
    keys = [as_col(c).alias(n) for n, c in (by or {}).items()]
    ranges = bitmaps.groupBy(*keys, "kind", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    return ranges.groupBy(*(by or {})).agg(*[
        F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)).alias(k) for k in kinds])
