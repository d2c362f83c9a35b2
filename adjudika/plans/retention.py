"""Retention of run logs and archives, and the backfill calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def recent(df: DataFrame, column: str, now: Column, months: int) -> DataFrame:
    """Rows of the last ``months`` calendar months."""
    return df.filter(F.col(column) >= now - F.expr(f"INTERVAL {int(months)} MONTHS"))


def expired(df: DataFrame, column: str, now: Column, months: int) -> DataFrame:
    """Rows that ``recent`` leaves out, e.g. to drop or move their partitions."""
    return df.filter(F.col(column) < now - F.expr(f"INTERVAL {int(months)} MONTHS"))


def rotate(df: DataFrame, column: str, now: Column, months: int, kept_path: str, partition: str | None = None) -> None:
    """Write the retained rows as a new version; the folder that was read is left untouched."""
    writer = recent(df, column, now, months).write.mode("errorifexists")
    (writer.partitionBy(partition) if partition else writer).parquet(kept_path)


def year_calendar(spark: SparkSession, year: int, last: int | None = None) -> DataFrame:
    """Every day of a year, or of all years up to ``last``: the units of a backfill."""
    days = F.sequence(F.make_date(F.lit(year), F.lit(1), F.lit(1)), F.make_date(F.lit(last or year), F.lit(12), F.lit(31)))
    return spark.range(1).select(F.explode(days).alias("jour"))


def backfill_state(records: DataFrame, published: str, year: int, last: int | None = None) -> DataFrame:
    """Records per day of the year, or of all years up to ``last``, and which days are still missing."""
    day = F.col(published).cast("date")
    start, end = f"{year}-01-01", f"{last or year}-12-31"
    counts = records.filter((F.col(published) >= F.lit(start).cast("timestamp_ntz"))
                            & (day <= F.lit(end).cast("date"))).groupBy(day.alias("jour")).agg(
        F.count(F.lit(1)).alias("n"))
    calendar = year_calendar(records.sparkSession, year, last)
    return calendar.join(counts, "jour", "left").select(
        "jour", F.coalesce("n", F.lit(0)).alias("n"), F.col("n").isNull().alias("manquant"))
