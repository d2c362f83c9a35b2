"""Batch and stream readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adjudika.schemas import DETAIL_RECORDS, PAGES


def table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def table_jdbc(spark: SparkSession, url: str, name: str, key: str, low: int, high: int, parts: int,
               **options: str) -> DataFrame:
    """The same table contract over JDBC, read in ``parts`` ranges of a numeric key."""
    return spark.read.jdbc(url, name, column=key, lowerBound=low, upperBound=high, numPartitions=parts,
                           properties=options)


def archived_pages(spark: SparkSession, path: str) -> DataFrame:
    """Archived pages stored as a table: ``(page_id, url, html)``."""
    return table(spark, path, PAGES)


def page_files(spark: SparkSession, path: str, base_url: str) -> DataFrame:
    """Archived pages stored one file each; the file name is taken as the last part of the URL."""
    raw = spark.read.text(path, wholetext=True).withColumn("_file", F.col("_metadata.file_name"))
    return raw.select(
        F.xxhash64("_file").alias("page_id"),
        F.concat(F.lit(base_url.rstrip("/") + "/"), "_file").alias("url"),
        F.col("value").alias("html"),
    )


def jsonl_records(spark: SparkSession, path: str, schema: T.StructType = DETAIL_RECORDS) -> DataFrame:
    """JSON lines; blank and corrupt lines are skipped."""
    with_bad = T.StructType([*schema.fields, T.StructField("_bad", T.StringType(), True)])
    lines = (
        spark.read.schema(with_bad).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(path)
    )
    return lines.filter(F.col("_bad").isNull()).drop("_bad")


def stored_keys(stored: DataFrame, *keys: str) -> DataFrame:
    """Distinct non-empty keys of a stored table (a key-only scan)."""
    present = stored.select(*keys)
    for key in keys:
        present = present.filter(F.coalesce(F.col(key), F.lit("")) != "")
    return present.distinct()


def recent_runs(runs: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    """Run-log rows of the last ``hours``."""
    return runs.filter(F.col("date_execution") >= now - F.expr(f"INTERVAL {int(hours)} HOURS"))


def new_arrivals(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json",
                 max_files: int | None = None) -> DataFrame:
    """Stream over files that keep arriving in a folder."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)
