"""Helpers that several operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.files import materialize, scratch_folder  # noqa: F401

#: Width of ``hash_key``: keys are uniform in [0, 2**KEY_BITS).
KEY_BITS = 60


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hash_key(*parts: Column) -> Column:
    """A key that is uniform and repeatable: the first 60 bits of the MD5 of the parts as text."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, KEY_BITS // 4), 16, 10).cast("bigint")


def prefix_sums(df: DataFrame, order: list[str], sums: dict[str, Column]) -> DataFrame:
    """Running sums (inclusive) over all rows in the order of ``order``, which must be unique.

    The rows are range-partitioned and written; each range is summed by itself and
    shifted by the totals of the ranges before it.  Only those totals, one row per
    partition, meet in one task.  NULL sorts last.
    """
    nulls = [F.col(c).isNull().alias(f"_null_{c}") for c in order]
    keyed = df.select("*", *nulls, *[v.alias(f"_v_{k}") for k, v in sums.items()])
    keys = [k for c in order for k in (f"_null_{c}", c)]
    ranged = materialize(
        keyed.repartitionByRange(*keys).withColumn("_range", F.spark_partition_id()), "ranges")
    inside = W.partitionBy("_range").orderBy(*keys)
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    totals = ranged.groupBy("_range").agg(*[F.sum(f"_v_{k}").alias(f"_t_{k}") for k in sums])
    shifts = totals.select("_range", *[F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0)).alias(f"_s_{k}") for k in sums])
    return ranged.join(shifts, "_range").select(
        *df.columns, *[(F.sum(f"_v_{k}").over(inside) + F.col(f"_s_{k}")).alias(k) for k in sums])


#: Keys on more than one in HOT_SHARE of all rows are at most HOT_SHARE, and so may be broadcast.
HOT_SHARE = 4096


def left_join_hot(rows: DataFrame, table: DataFrame, key: str, n: str) -> DataFrame:
    """``rows`` with the columns of ``table``, which is written and has one row per key with its number ``n`` of rows.

    Keys with a large share of the rows are joined by broadcast, all others by a
    shuffle, so no key gathers its rows in one task.
    """
    total = table.agg(F.sum(n).alias("t")).scalar()
    hot = F.col(n) * HOT_SHARE > total
    new = [c for c in table.columns if c != key]
    often = rows.join(F.broadcast(table.where(hot).withColumn("_hot", F.lit(True))), key, "left")
    seldom = often.where("_hot is null").drop("_hot", *new).join(table.where(~hot), key, "left")
    return often.where("_hot").drop("_hot").unionByName(seldom)


class Scratch:
    """Written tables of one job, each deleted as soon as no later step reads it.

    What is still to be computed must not read a dropped table; lost executors then
    only repeat steps that read tables which are still there.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_folder(self.spark, name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (out, path)
        return out

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            _, path = self.paths.pop(id(table))
            at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)
