"""Joins between tenders, their pages and their children.

All are equi-joins on one side that is unique per key. Nothing is hinted: the planner broadcasts a side only when its
measured size allows, and AQE splits the partition of a hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich(base: DataFrame, details: DataFrame, key: str) -> DataFrame:
    """Detail fields over the base row. A base row without a detail page survives; an absent detail keeps the base
    value. ``details`` is unique per key."""
    extra = [c for c in details.columns if c != key]
    renamed = details.select(key, *(F.col(c).alias(f"_d_{c}") for c in extra))
    joined = base.join(renamed, key, "left")
    out = {c: F.coalesce(F.col(f"_d_{c}"), F.col(c)) if c in base.columns else F.col(f"_d_{c}") for c in extra}
    return joined.withColumns(out).drop(*(f"_d_{c}" for c in extra))


def with_parent(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    return children.join(parents.select(key), key, "left_semi")


def orphans(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    return children.join(parents.select(key), key, "left_anti")


def cascade_delete(children: DataFrame, deleted: DataFrame, key: str) -> DataFrame:
    """Children that remain once the given parents are gone."""
    return children.join(deleted.select(key), key, "left_anti")


def pages_without_rows(pages: DataFrame, rows: DataFrame, key: str = "page_id") -> DataFrame:
    """Pages that gave no row at all."""
    return pages.join(rows.select(key).distinct(), key, "left_anti")


def missing_next_pages(next_links: DataFrame, pages: DataFrame) -> DataFrame:
    """Pagination targets that were never archived: ``(page_id, next_url)``."""
    known = pages.select(F.col("url").alias("next_url")).distinct()
    return next_links.filter(F.col("next_url").isNotNull()).join(known, "next_url", "left_anti").select(
        "page_id", "next_url")
