"""Extendible hashing: a directory over hash-prefix bits whose buckets split on another bit until each fits a byte limit.

All of it is column expressions. A row's address is 120 bits: 60 bits of an md5 over its key, then 60 bits of an md5 over its file and its
number within the file, which stay the same however a scan is split. A bucket is a prefix of addresses. Since bytes only fall when a prefix grows, the bucket of a row is the shortest prefix
whose rows fit the limit; a bucket that fits is never split. The second half is read only where rows of one key alone exceed the
limit, so a hot key or a row repeated without end spreads over several shards instead of one.

Each round looks at ``BITS`` further bits: one aggregation counts bytes per cell (map-side combined, so at most 2**BITS rows leave a
task) and a second one sums the cells over all prefixes. Only cells that are still too large enter the next round.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

from adjudika.session import cut_lineage

#: Address bits of a round.
BITS = 15
ADDRESS_BITS = 120
_HEX = 15  # hex digits of one half of an address
#: Work columns.
ADDRESS, BYTES, CELL, PLACE = "__shard_address", "__shard_bytes", "__shard_cell", "__shard_place"


def _half(value):
    """60 bits as text of 0 and 1."""
    number = F.conv(F.substring(F.md5(value.cast("binary")), 1, _HEX), 16, 2)
    return F.lpad(number, 4 * _HEX, "0")


def addressed(docs: DataFrame, key: list[str]) -> DataFrame:
    """``docs`` with ``ADDRESS``, 120 characters 0 or 1, and ``BYTES``, the UTF-8 bytes of the text.

    Null key values count as the empty text. A table that is not read from Parquet files is written to such files first, since its rows have no
    other place that is the same in every job.
    """
    try:
        stored = docs.withColumn(PLACE, _place(docs))
        stored.schema  # an input without files has no such columns
    except AnalysisException:
        docs = cut_lineage(docs, "shard-input")
        stored = docs.withColumn(PLACE, _place(docs))
    joined = F.concat_ws("\x1f", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key])
    return stored.withColumns({ADDRESS: F.concat(_half(joined), _half(F.col(PLACE))),
                               BYTES: F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")}).drop(PLACE)


def _place(docs: DataFrame):
    hidden = docs.metadataColumn("_metadata")
    return F.concat_ws("\x1f", hidden["file_path"], hidden["row_index"].cast("string"))


def _round(cells: DataFrame, done: int, limit: int) -> DataFrame:
    """The buckets of one round's cells, each as often as it has cells: cell, shard, shard_bytes, shard_rows."""
    lowest = done + 1 if done else 0
    lengths = F.sequence(F.lit(lowest), F.lit(done + BITS))
    prefixes = cells.select("cell", "bytes", "rows", F.explode(F.transform(lengths, lambda n: F.substring(F.col("cell"), F.lit(1), n))).alias("shard"))
    sums = prefixes.groupBy("shard").agg(F.sum("bytes").alias("shard_bytes"), F.sum("rows").alias("shard_rows"))
    # One row cannot be split: it is a bucket of its own, however long. Neither can rows of one whole address.
    fit = (F.col("shard_bytes") <= limit) | (F.col("shard_rows") == 1) | F.lit(done + BITS == ADDRESS_BITS) & (F.length("shard") == ADDRESS_BITS)
    joined = prefixes.select("cell", "shard").join(sums.filter(fit), "shard")
    return (joined.groupBy("cell").agg(F.min_by(F.struct("shard", "shard_bytes", "shard_rows"), F.length("shard")).alias("leaf"))
            .select("cell", "leaf.*"))


def directory(slim: DataFrame, limit: int) -> list[DataFrame]:
    """The directory of rows (ADDRESS, BYTES), one table per round: cell, shard, shard_bytes, shard_rows.

    Round k maps prefixes of ``(k + 1) * BITS`` bits to buckets; a prefix that it lacks is split by the next round.
    """
    found, open_rows, done = [], slim, 0
    while True:
        width = done + BITS
        cells = cut_lineage(open_rows.groupBy(F.substring(ADDRESS, 1, width).alias("cell"))
                            .agg(F.sum(BYTES).alias("bytes"), F.count("*").alias("rows")), "shard-cells")
        found.append(cut_lineage(_round(cells, done, limit), "shard-directory"))
        large = cells.filter((F.col("bytes") > limit) & (F.col("rows") > 1)).select("cell")
        if width == ADDRESS_BITS or large.isEmpty():
            return found
        # Cells over the limit are fewer than all bytes / limit.
        open_rows = open_rows.withColumn("cell", F.substring(ADDRESS, 1, width)).join(large, "cell", "left_semi").drop("cell")
        done = width


def assign(docs: DataFrame, limit: int, key: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` with its shard: shard (prefix of the address, ``''`` if all fits one), shard_bytes, shard_rows, n_bytes.

    ``key``: columns that choose the address, doc_id by default. A shard's texts have at most ``limit`` bytes; the only larger ones
    hold a single row that is longer itself. Rows with a null text count 0 bytes. Rows repeated with one key share shards while these
    fit. Columns of ``docs`` with the added names are replaced. An empty table has no shards. Very long texts are rows like others: only
    their lengths are summed. A row that has no bucket, since the files have changed between the jobs, raises an error; it is never left out.
    """
    rows = addressed(docs.drop("shard", "shard_bytes", "shard_rows", "n_bytes"), key or ["doc_id"])
    keep = [c for c in rows.columns if c not in (ADDRESS, BYTES)]
    made, left, found = None, rows, directory(rows.select(ADDRESS, BYTES), limit)
    for k, cells in enumerate(found):
        probe = left.withColumn(CELL, F.substring(ADDRESS, 1, (k + 1) * BITS))
        cells = cells.withColumnRenamed("cell", CELL)
        side = F.broadcast(cells) if k == 0 else cells  # the first round has at most 2**BITS cells
        last = k == len(found) - 1
        shard = F.coalesce("shard", F.raise_error(F.lit("a row has no shard: the table has changed since its directory was made"))) if last else F.col("shard")
        hit = probe.join(side, CELL, "left" if last else "inner").select(
            *keep, shard.alias("shard"), "shard_bytes", "shard_rows", F.col(BYTES).alias("n_bytes"))
        made = hit if made is None else made.unionByName(hit)
        if not last:
            known = cells.select(CELL)
            left = probe.join(F.broadcast(known) if k == 0 else known, CELL, "left_anti").drop(CELL)
    return made


def write_shards(docs: DataFrame, path: str, limit: int, key: list[str] | None = None) -> None:
    """Write ``docs`` as Parquet with one folder per shard; ``shard=b`` and the address prefix name it."""
    made = assign(docs, limit, key).withColumn("shard", F.concat(F.lit("b"), "shard"))
    made.repartition("shard").write.partitionBy("shard").parquet(path)
