"""Rows of an embedding table as integer matrices: what the vector operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Rows that a kernel handles at once.
ROWS = 8_192


def finite_rows(df: DataFrame, column: str) -> DataFrame:
    """The rows whose vector has no null and only finite components; an empty vector has none to fail."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return df.filter(F.col(column).isNotNull() & ~bad)


def matrix(column: pa.Array, scale: int, shift: int = 0) -> np.ndarray:
    """floor(scale * x) + shift of all components, as int64 rows; all vectors of the column have one length."""
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    whole = np.floor(flat * scale)
    if len(whole) and np.abs(whole).max() >= 2.0 ** 62:
        raise OverflowError("a vector's component leaves the range of the integer form")
    return whole.astype(np.int64).reshape(n, -1) + shift


def pieces(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def width_of(df: DataFrame, column: str) -> int | None:
    """The length that all vectors have; None for an empty table. Vectors of different lengths raise."""
    found = df.agg(F.min(F.size(column)).alias("least"), F.max(F.size(column)).alias("most")).first()
    if found.least != found.most:
        raise ValueError(f"vectors of {found.least} to {found.most} components in one table")
    return found.least


def summed(partials: DataFrame, places: str, kind: str) -> list:
    """The sums of the arrays ``places``, place by place: each task sends one array, and the driver gets one number a place."""
    parts = partials.select(F.posexplode(places).alias("at", "x"))
    return [r.x for r in parts.groupBy("at").agg(F.sum(F.col("x").cast(kind)).alias("x")).orderBy("at").collect()]
