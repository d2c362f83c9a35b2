"""Deduplication by aggregation.

A window over a hot key would sort all its rows in one task. ``min_by`` keeps one candidate per key and input
partition before the exchange, so a key that holds a third of the table costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudika.functions import build_detail_url, drop_fragment, query_param
from adjudika.functions.urls import ORG_PARAM, REF_PARAM
from adjudika.operators.quality import DUPLICATE


def _content(df: DataFrame, exclude=()) -> Column:
    return F.xxhash64(*(c for c in df.columns if c not in exclude))


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in ``order``; remaining ties are broken by content, so the choice is repeatable."""
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*arrival(order), _content(df))).alias("_first")
    return df.groupBy(*keys).agg(first).select(*keys, "_first.*").select(*df.columns)


def arrival(order: list[str]) -> list[Column]:
    """Sort fields of an arrival order; an unknown time comes last."""
    return [c for name in order for c in (F.col(name).isNull(), F.col(name))]


def label_duplicates(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Label every row of a key but the first as a duplicate, however the rows of a key tie: exactly one stays.

    Ties of ``order`` are broken by content, and exact copies by their place in the table, so ``df`` has to be a stored table
    (``session.cut_lineage``). NULL keys are one key. The winners come from an aggregate, and the join back is on the row's place,
    which spreads a hot key over all partitions. That join is a sorted one whatever the winners seem to weigh: next to the columns of a packed
    file a place looks so small that one for every key would be broadcast through the driver.
    """
    placed = df.withColumn("_place", F.monotonically_increasing_id())
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate([*arrival(order), _content(df), F.col("_place")])])
    winners = placed.groupBy(*keys).agg(F.min(rank)[f"o{2 * len(order) + 1}"].alias("_place")).select("_place", F.lit(True).alias("_first"))
    joined = placed.join(winners.hint("merge"), "_place", "left")
    reason = F.when(F.col("_first").isNull(), F.lit(DUPLICATE))
    if "_reason" in df.columns:
        return joined.withColumn("_reason", F.coalesce("_reason", reason)).select(*df.columns)
    return joined.withColumn("_reason", reason).select(*df.columns, "_reason")


def new_keys(incoming: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Incoming rows whose key is not stored yet. ``incoming`` should be unique per key already."""
    return incoming.join(stored.select(key), key, "left_anti")


def dedup_links(links: DataFrame, page: str = "page_id", url: str = "url", position: str = "pos") -> DataFrame:
    """First link per page and URL without fragment, by position."""
    keyed = links.withColumn("_key", drop_fragment(F.col(url)))
    return first_per_key(keyed, [page, "_key"], [position]).drop("_key")


def canonical_links(links: DataFrame, url: str = "url") -> DataFrame:
    """Distinct detail pages over all result pages: ``(ref, org, url, n, dropped)``, ``n`` links each.

    Links that name reference and body are reduced to one canonical URL each. If there is at least one such link, the
    others are dropped and counted in ``dropped``; if there is none, every link is kept as it is.
    """
    parts = links.select(
        F.col(url), query_param(F.col(url), REF_PARAM).alias("ref"), query_param(F.col(url), ORG_PARAM).alias("org"))
    complete = F.col("ref").isNotNull() & F.col("org").isNotNull()
    # Links that lack a part keep their URL within the same exchange, so they are there if no link is complete, and nothing is read again.
    # ``ok`` is an aggregate so that the filter stays above it and both uses share that exchange.
    groups = parts.withColumn("_url", F.when(~complete, F.col(url))).groupBy("ref", "org", "_url").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(complete).alias("ok"))
    totals = groups.agg(F.bool_or("ok").alias("any_complete"), F.sum(F.when(~F.col("ok"), F.col("n"))).alias("incomplete"))
    any_complete = F.coalesce(totals.select("any_complete").scalar(), F.lit(False))
    dropped = F.when(any_complete, F.coalesce(totals.select("incomplete").scalar(), F.lit(0))).otherwise(0).cast("bigint")
    copies = F.explode(F.when(F.col("ok"), F.array(F.col("n"))).otherwise(F.transform(F.sequence(F.lit(1).cast("bigint"), "n"), lambda i: F.lit(1).cast("bigint"))))
    return groups.filter(F.col("ok") | ~any_complete).withColumn("n", copies).select(
        "ref", "org", F.coalesce("_url", build_detail_url(F.col("ref"), F.col("org"))).alias("url"), "n", dropped.alias("dropped"))


def new_records(records: DataFrame, stored_ids: DataFrame, order: list[str], id_column: str = "id") -> DataFrame:
    """First record per id that is not stored yet (within the run, then across runs)."""
    return new_keys(first_per_key(records, [id_column], order), stored_ids, id_column)
