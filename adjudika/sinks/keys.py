"""Slim tables of keys, laid out by a hash prefix of the key, so that a batch reads only the prefixes that it has itself.

A table holds one row per stored key. ``lookup`` asks a batch for its prefixes, at most ``prefixes`` numbers, and filters on
them: partition pruning leaves the other folders unread. It pays where a batch has fewer keys than there are prefixes, so a long history
wants many of them; a batch with every prefix reads all keys once, as a scan of the stored table would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adjudika.session import path_exists

PREFIXES = 64
PREFIX = "prefixe"


class KeyTable:
    def __init__(self, spark: SparkSession, path: str, key: str, schema: str, prefixes: int = PREFIXES):
        """``schema``: the key and what is kept beside it."""
        self.spark, self.path, self.key, self.prefixes = spark, path, key, prefixes
        self.schema = T.StructType.fromDDL(schema)

    def prefix(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.prefixes)).cast("int")

    def read(self) -> DataFrame | None:
        """All rows with their prefix; None where there is no table yet."""
        schema = T.StructType([*self.schema.fields, T.StructField(PREFIX, T.IntegerType())])
        return self.spark.read.schema(schema).parquet(self.path) if path_exists(self.spark, self.path) else None

    def touched(self, keys: DataFrame) -> list[int]:
        return [r[0] for r in keys.select(self.prefix().alias(PREFIX)).distinct().collect()]  # at most ``prefixes`` numbers

    def held(self) -> set[int]:
        """The prefixes that have a folder: a listing of names."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        names = [f.getPath().getName() for f in folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(folder)]
        return {int(n.split("=", 1)[1]) for n in names if n.startswith(f"{PREFIX}=")}

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The stored rows in the prefixes of ``keys``, which should be a stored table: it is read for the prefixes and again by a join.

        Where none of them is held, the planner knows that the result is empty: a join with it moves no row.
        """
        rows = self.read()
        if rows is None:
            return self.spark.createDataFrame([], self.schema)
        held = self.held()
        chosen = [p for p in self.touched(keys) if p in held] if held else []
        return rows.filter(F.col(PREFIX).isin(chosen) if chosen else F.lit(False)).drop(PREFIX)

    def _laid_out(self, rows: DataFrame):
        dealt = rows.select(*self.schema.fieldNames(), self.prefix().alias(PREFIX))
        return dealt.hint("rebalance", PREFIX).write.partitionBy(PREFIX)

    def add(self, rows: DataFrame) -> None:
        self._laid_out(rows).mode("append").parquet(self.path)

    def rebuild(self, rows: DataFrame) -> None:
        """Replace the whole table."""
        self._laid_out(rows).mode("overwrite").option("partitionOverwriteMode", "static").parquet(self.path)

    def fold(self, root: str) -> None:
        """Few files per prefix again, after many batches have added some; ``root`` is a folder for the rewritten rows."""
        rows = self.read()
        if rows is not None:
            rows.drop(PREFIX).write.parquet(root)  # aside first: a folder that is read is not replaced
            self.rebuild(self.spark.read.schema(self.schema).parquet(root))

    def remove(self, keys: DataFrame, aside) -> None:
        """Drop the rows of ``keys``; only their prefixes are rewritten. ``aside`` stores a table and reads it back."""
        rows = self.read()
        if rows is None:
            return
        touched = self.touched(keys)
        left = aside(rows.filter(F.col(PREFIX).isin(touched)).join(keys.select(self.key), self.key, "left_anti").select(*self.schema.fieldNames(), PREFIX))
        left.hint("rebalance", PREFIX).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PREFIX).parquet(self.path)
        held = {r[0] for r in left.select(PREFIX).distinct().collect()}
        for prefix in set(touched) - held:
            left.limit(0).drop(PREFIX).write.mode("overwrite").parquet(f"{self.path}/{PREFIX}={prefix}")
