"""Readers and writers: typed CSV, parquet, promotions, statistics."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from ..functions import iso_date
from .schemas import SCHEMAS


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared one the cluster names in ``spark.checkpoint.dir``.

    Only where that setting is missing (tests on one machine) a local temporary
    folder is used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = tempfile.mkdtemp(prefix="saleslens-")
    # One folder per application, so that a finished run can be removed as a whole.
    return f"{base.rstrip('/')}/saleslens-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a result that several later steps read, and continue from the written table.

    The table lies in the shared folder, so lost executors cost no recomputation
    of what came before, and its size on disk guides the later joins.
    """
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def normalize_columns(df: DataFrame, renames: dict[str, str] | None = None) -> DataFrame:
    """Lower-case names, spaces to underscores, then rename as asked."""
    out = df.toDF(*[c.strip().lower().replace(" ", "_") for c in df.columns])
    return out.withColumnsRenamed(renames or {})


def read_typed_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header, typed by an explicit schema; malformed rows fail the read."""
    return (
        spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
        .option("dateFormat", "yyyy-MM-dd").csv(path)
    )


def read_csv_with_quarantine(
    spark: SparkSession, path: str, schema: StructType, max_bad_share: float = 0.01,
) -> tuple[DataFrame, DataFrame]:
    """(rows, quarantine) of CSV files with a header.

    A line with a bad number, a bad date or a wrong number of fields goes to the
    quarantine, (file, line), and does not stop the job; a share of such lines above
    ``max_bad_share`` does.  The files are parsed once, into a written table.
    """
    bad, file = "_bad_line", "_file"
    parsed = (
        spark.read.schema(StructType([*schema, StructField(bad, StringType(), True)]))
        .options(header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=bad, dateFormat="yyyy-MM-dd", columnPruning=False)
        .csv(path).select("*", F.col("_metadata.file_path").alias(file)))
    rows = materialize(parsed, "csv-rows")
    found = rows.agg(F.count(F.lit(1)).alias("n"), F.count(bad).alias("bad")).first()
    if found["bad"] > max_bad_share * found["n"]:
        worst = bad_lines_by_file(rows.where(F.col(bad).isNotNull()).select(F.col(file).alias("file"))).limit(3).collect()
        raise ValueError(f"{found['bad']} of {found['n']} lines are bad, most in {[(r['file'], r['n_lines']) for r in worst]}")
    quarantine = rows.where(F.col(bad).isNotNull()).select(F.col(file).alias("file"), F.col(bad).alias("line"))
    return rows.where(F.col(bad).isNull()).select(*schema.names), quarantine


def bad_lines_by_file(quarantine: DataFrame) -> DataFrame:
    """(file, n_lines) of a quarantine, most first."""
    return quarantine.groupBy("file").agg(F.count(F.lit(1)).alias("n_lines")).orderBy(F.desc("n_lines"), "file")


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None, sort_by: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    if columns:
        df = df.select(*columns)
    return df.orderBy(*sort_by) if sort_by else df


def load_promotions(spark: SparkSession, path: str) -> DataFrame:
    """Promotions CSV: any header case, numbers cast, dates parsed.

    All fields are read as text under the expected names, so a bad number fails
    in the cast instead of silently turning into NULL.
    """
    schema = SCHEMAS["promotions"]
    raw = StructType([StructField(f.name, StringType(), True) for f in schema])
    text = normalize_columns(
        spark.read.schema(raw).option("header", True).option("enforceSchema", True).csv(path))
    return text.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_bucketed(df: DataFrame, path: str, table: str, key: str, buckets: int) -> str:
    """A table of parquet files, one per bucket of ``key`` and sorted by it; two such tables join by the key without a shuffle."""
    df.repartition(buckets, key).write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return table


def register_bucketed(spark: SparkSession, path: str, table: str, schema: StructType, key: str, buckets: int) -> str:
    """Make files of ``write_bucketed`` known to a session whose catalog does not have them."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    location = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{location}'")
    return table


def write_csv(df: DataFrame, path: str) -> str:
    """CSV with header and ISO dates."""
    cols = [
        iso_date(f.name).alias(f.name) if isinstance(f.dataType, DateType) else F.col(f.name)
        for f in df.schema
    ]
    df.select(*cols).write.mode("overwrite").option("header", True).csv(path)
    return path


def write_stats(df: DataFrame, path: str) -> str:
    """One-row statistics as JSON next to a model or table."""
    df.write.mode("overwrite").json(path)
    return path
