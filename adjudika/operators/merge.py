"""Upsert of tenders by reference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_values(incoming: DataFrame, key: str, order: list[str], held: dict[str, int] | None = None) -> DataFrame:
    """One row per key: for each column the latest non-NULL value, plus ``_items``, the number of rows folded in.

    This is what applying the rows one after the other leaves behind, computed with partial aggregation, so the merge
    below joins two sides that are unique per key.

    ``held`` (see ``held_values``) tells how many values each column has. Columns that are never NULL all take theirs from the latest row, as one
    value with one rank; a column without a value takes none. Otherwise each column goes through the exchange with a rank of its own.
    """
    rest = [c for c in incoming.columns if c != key]
    # A column of its own, so that the content hash is worked out once per row and not once per aggregate.
    ranked = incoming.withColumn("_rank", F.struct(*order, F.xxhash64(*incoming.columns)))
    held = held or {}
    whole = [c for c in rest if c in held and held[c] == held["_rows"]]
    empty = [c for c in rest if c not in whole and held.get(c) == 0]
    folded = ranked.groupBy(key).agg(
        *([F.max_by(F.struct(*whole), "_rank").alias("_whole")] if whole else []),
        *(F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_rank"))).alias(c) for c in rest if c not in whole and c not in empty),
        F.count(F.lit(1)).alias("_items"),
    )
    return folded.select(key, *(
        F.col(f"_whole.{c}").alias(c) if c in whole else F.lit(None).cast(incoming.schema[c].dataType).alias(c) if c in empty else F.col(c)
        for c in rest), "_items")


def held_values(incoming: DataFrame) -> dict[str, int]:
    """How many rows there are (``_rows``) and how many values each column has: one scan, for ``last_values`` of a stored table."""
    return incoming.agg(F.count(F.lit(1)).alias("_rows"), *(F.count(c).alias(c) for c in incoming.columns)).first().asDict()


def upsert(stored: DataFrame, incoming: DataFrame, key: str, now: Column, touched: str = "date_derniere_maj",
           seq: int | None = None) -> DataFrame:
    """Stored table after the merge, with ``_action`` (insert / update / again / keep) and ``_items``.

    A non-NULL incoming value replaces the stored one, NULL keeps it, and an updated row gets ``now`` in ``touched``.
    ``incoming`` is unique per key (see ``last_values``). With ``seq``, the number of the run, rows are guarded by their own ``seq``: a row that a
    later run wrote only takes values where it has none and is kept otherwise; a row that this run wrote before (``again``) stays as it is.
    """
    if "_items" not in incoming.columns:
        incoming = incoming.withColumn("_items", F.lit(1).cast("bigint"))
    s, i = stored.withColumn("_s", F.lit(True)).alias("s"), incoming.withColumn("_i", F.lit(True)).alias("i")
    joined = s.join(i, F.col(f"s.{key}") == F.col(f"i.{key}"), "full_outer")
    action = F.when(F.col("_i").isNull(), "keep").when(F.col("_s").isNull(), "insert")
    if seq is not None:
        action = action.when(F.col("s.seq") > seq, "keep").when(F.col("s.seq") == seq, "again")
    joined = joined.withColumn("_action", action.otherwise("update"))
    taken = F.col("_action").isin("insert", "update")

    def merged(name: str) -> Column:
        old = F.col(f"s.{name}")
        if name == touched:
            return F.when(F.col("_action") == "update", now).otherwise(old)
        if name == "seq" and seq is not None:
            return F.when(taken, F.lit(seq).cast("bigint")).otherwise(old)
        if name not in incoming.columns:
            return old
        new = F.col(f"i.{name}")
        return F.coalesce(new, old) if seq is None else F.when(taken, F.coalesce(new, old)).otherwise(F.coalesce(old, new))

    return joined.select(*(merged(n).alias(n) for n in stored.columns), "_action", F.coalesce("_items", F.lit(0)).cast("bigint").alias("_items"))


def counted(touched: str = "date_derniere_maj") -> dict[str, Column]:
    """Aggregates of a merge's rows: references inserted and updated, rows kept. Those that the run wrote before it broke off count as well."""
    action, again = F.col("_action"), F.col("_action") == "again"
    return {
        "inserted": F.count_if((action == "insert") | (again & F.col(touched).isNull())),
        "updated": F.count_if((action == "update") | (again & F.col(touched).isNotNull())),
        "kept": F.count_if(action == "keep"),
    }


def merge_counts(merged: DataFrame) -> DataFrame:
    """Rows inserted and updated, counted per incoming row: a repeated new reference inserts once, then updates."""
    inserted = F.count_if(F.col("_action") == "insert")
    return merged.agg(
        inserted.alias("inserted"),
        (F.coalesce(F.sum("_items"), F.lit(0)) - inserted).alias("updated"),
        F.count_if(F.col("_action") == "keep").alias("kept"),
    )
