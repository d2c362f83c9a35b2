"""Archive of raw pages, one copy per content, and dead letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudika.functions import archive_name
from adjudika.operators.projections import without_html
from adjudika.operators.relations import pages_without_rows
from adjudika.session import cut_lineage


#: The day within the name of an archived page.
PAGE_DAY = r"_(\d{8})_\d{6}_[0-9a-f]{8}\.html$"


def archive_copies(pages: DataFrame, stamp: Column, ref: str = "ref_consultation") -> DataFrame:
    """``(file_name, content_md5, archive_date, copies, html)``, one row per distinct page content.

    Equal pages are folded before the exchange, so a page that was saved a million times travels once per partition. ``pages`` may bring their
    ``content_md5``.
    """
    md5 = F.col("content_md5") if "content_md5" in pages.columns else F.md5("html")
    keyed = pages.select(md5.alias("content_md5"), F.col(ref).alias("_ref"), "html").filter(F.col("html").isNotNull())
    once = keyed.groupBy("content_md5").agg(
        F.min("_ref").alias("_ref"), F.any_value("html").alias("html"), F.count(F.lit(1)).alias("copies"))
    return once.select(
        archive_name(F.col("_ref"), stamp, F.col("html")).alias("file_name"), "content_md5",
        stamp.cast("date").alias("archive_date"), "copies", "html")


def write_archive(pages: DataFrame, path: str, stamp: Column, stored: DataFrame | None = None, index=None) -> None:
    """Add the contents that are not archived yet, in one folder per archive date; ``index`` (a key table) gets their names."""
    keyed = pages.filter(F.col("html").isNotNull())
    if stored is not None:  # before the pages travel
        md5 = F.col("content_md5") if "content_md5" in pages.columns else F.md5("html")
        keyed = keyed.withColumn("content_md5", md5).join(stored.select("content_md5"), "content_md5", "left_anti")
    if index is not None:
        # Names first, aside and without the pages: what is archived below must not change the question of what is new.
        names = cut_lineage(archive_copies(keyed, stamp).drop("html", "copies"), "archive-names")
        archive_copies(keyed, stamp).write.mode("append").partitionBy("archive_date").parquet(path)
        index.add(names)
        return
    archive_copies(keyed, stamp).write.mode("append").partitionBy("archive_date").parquet(path)


def archived_path(records: DataFrame, archive: DataFrame, root: str) -> DataFrame:
    """Swap a record's ``page_html`` for ``page_html_archivee``, the path of the archived copy of the same content.

    The archive (or its key table) is joined on the full hash: a page that is saved under several references, or again on a later day, has one
    copy, and every record names that one. A content that was archived twice by runs side by side is named by its first file.
    """
    files = archive.groupBy("content_md5").agg(F.min("file_name").alias("_file"))
    if "content_md5" not in records.columns:
        records = records.withColumn("content_md5", F.md5("page_html"))
    path = F.concat(F.lit(root.rstrip("/") + "/"), F.col("_file"))
    return without_html(records.join(files, "content_md5", "left").withColumn("page_html_archivee", path).drop("content_md5", "_file"))


def pages_at(paths: DataFrame, archive: DataFrame, column: str = "page_html_archivee") -> DataFrame:
    """``paths`` with the ``html`` that each path names; NULL where the archive has dropped it.

    The day stands in the name, so only the folders of the days asked for are read.
    """
    name = F.element_at(F.split(column, "/"), -1)
    wanted = paths.withColumn("_name", name)
    day = F.to_date(F.regexp_extract("_name", PAGE_DAY, 1), "yyyyMMdd")
    days = [r[0] for r in wanted.select(day.alias("d")).filter("d is not null").distinct().collect()]  # bounded by the calendar
    held = archive.filter(F.col("archive_date").isin(days)).groupBy(F.col("file_name").alias("_name")).agg(F.min("html").alias("html"))
    return wanted.join(held, "_name", "left").drop("_name")


def write_dead_letters(pages: DataFrame, rows: DataFrame, path: str) -> None:
    """Pages that gave no row, kept whole for inspection."""
    pages_without_rows(pages, rows).write.mode("append").parquet(path)
