"""Vector code compression: product quantisation in exact integers, whose distances are matrix products of limbs.

Components become integers, a vector is cut into equal parts, and each part is replaced by the index of the nearest entry of its part's
codebook. |x - c|^2 = |x|^2 - 2 x.c + |c|^2, and x.c is needed exactly: both sides are split into limbs of ``LIMB_BITS`` bits, each pair of
limbs is one float64 matrix product whose sums stay below 2**53, and the products are put together again in int64. The first least distance
wins.

Each round is one pass: a task assigns its rows and sends one array of sums and counts, integers again, so codebooks depend neither on the
partitions nor on the order of rows. Codebooks are small (entries x components), so they travel with the job.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from adjudika.llm.vectors import finite_rows, matrix, pieces, summed, width_of
from adjudika.session import cut_lineage

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Bits of a limb: products of two limbs, summed over up to 2**31 components, stay below 2**53.
LIMB_BITS = 11
#: Distinct labels whose error sums are broadcast at most; with more, both sides are shuffled by label.
BROADCAST_LABELS = 100_000


def limbs(x: np.ndarray, bits: int = LIMB_BITS) -> list[np.ndarray]:
    """float64 arrays d with x = sum(d[k] * 2**(bits * k)): all but the last in [0, 2**bits), the last one carries the sign."""
    made, rest = [], x
    while True:
        high = rest >> bits
        if not len(rest) or (-(1 << bits - 1) <= rest.min() and rest.max() < 1 << bits - 1):
            return [*made, rest.astype(np.float64)]
        made.append((rest - (high << bits)).astype(np.float64))
        rest = high


def exact_products(x: np.ndarray, c: np.ndarray, bits: int = LIMB_BITS) -> np.ndarray:
    """x @ c.T of int64 matrices, exactly, by float64 products of limbs."""
    if x.shape[-1] << 2 * bits > 1 << 53:
        raise ValueError("too many components for limbs of this size")
    total = np.zeros((len(x), len(c)), np.int64)
    right = limbs(c, bits)
    for i, a in enumerate(limbs(x, bits)):
        for j, b in enumerate(right):
            total += (a @ b.T).astype(np.int64) << (bits * (i + j))
    return total


def _check_range(most: int, width: int) -> None:
    """Distances are sums of ``width`` squares of differences, which have to fit 63 bits."""
    if width * (2 * most + 1) ** 2 >= 1 << 63:
        raise OverflowError("components are too large for exact distances in 64 bits")


def nearest(x: np.ndarray, codebooks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (rows, parts) and squared distances (rows, parts) for codebooks (parts, entries, part width)."""
    parts, _, size = codebooks.shape
    codes, errors = np.zeros((len(x), parts), np.int64), np.zeros((len(x), parts), np.int64)
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(codebooks).max(initial=0)))
    _check_range(most, parts * size)
    for p in range(parts):
        part, book = x[:, p * size:(p + 1) * size], codebooks[p]
        distance = (part * part).sum(1)[:, None] - 2 * exact_products(part, book) + (book * book).sum(1)[None]
        codes[:, p] = distance.argmin(1)  # the first of equals
        errors[:, p] = distance[np.arange(len(x)), codes[:, p]]
    return codes, errors


def _floor_divided(sums: list[int], counts: list[int], before: np.ndarray) -> np.ndarray:
    parts, entries, size = before.shape
    after = before.copy()
    for p in range(parts):
        for e in range(entries):
            if n := counts[p * entries + e]:
                at = (p * entries + e) * size
                after[p, e] = [s // n for s in sums[at:at + size]]
    return after


def first_codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, scale: int = SCALE) -> np.ndarray:
    """The parts of the vectors with the smallest vec_ids; repeated ids follow the order of their vectors, null ids come last."""
    rows = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).select("embedding").toArrow()["embedding"]
    x = matrix(rows.combine_chunks(), scale)
    return np.ascontiguousarray(x.reshape(len(x), parts, -1).transpose(1, 0, 2))


def round_of(vectors: DataFrame, codebooks: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The codebooks after one round: every part joins its nearest entry, entries become the floor of their parts' mean."""
    parts, entries, size = codebooks.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts * entries, size), np.int64)
        count = np.zeros(parts * entries, np.int64)
        passed = 0
        for batch in pieces(batches):
            x = matrix(batch.column("embedding"), scale)
            codes, _ = nearest(x, codebooks)
            spread = np.zeros((len(x), parts * entries))
            spread[np.arange(len(x))[:, None], codes + np.arange(parts) * entries] = 1.0
            count += spread.sum(0).astype(np.int64)
            for p in range(parts):
                chosen = spread[:, p * entries:(p + 1) * entries]
                # Sums of a batch by limbs too: a column of ones against limbs stays below 2**53.
                for k, limb in enumerate(limbs(x[:, p * size:(p + 1) * size])):
                    total[p * entries:(p + 1) * entries] += (chosen.T @ limb).astype(np.int64) << (LIMB_BITS * k)
            passed += len(x)
        if passed:
            yield pa.RecordBatch.from_arrays([pa.array([np.append(total.ravel(), count)], pa.list_(pa.int64()))], names=["sums"])

    # 38 digits: what all tasks together sum may leave 64 bits.
    every = [int(x) for x in summed(vectors.select("embedding").mapInArrow(sums, "sums array<bigint>"), "sums", "decimal(38,0)")]
    cut = parts * entries * size
    return _floor_divided(every[:cut], every[cut:], codebooks)


def digest(codebooks: np.ndarray) -> str:
    """sha256 of the decimal components by part, entry and position."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> np.ndarray:
    """Codebooks (parts, entries, part width) of finite vectors; no vector, no entry."""
    width = width_of(vectors, "embedding")
    if width is None:
        return np.zeros((parts, 0, 0), np.int64)
    if width % parts:
        raise ValueError(f"vectors of {width} components have no {parts} equal parts")
    codebooks = first_codebooks(vectors, parts, entries, scale)
    for _ in range(rounds):
        codebooks = round_of(vectors, codebooks, scale)
    return codebooks


def encode(vectors: DataFrame, codebooks: np.ndarray, scale: int = SCALE) -> DataFrame:
    """``vectors`` (finite, of the codebooks' width) with code (two hex digits a part) and error (squared distance, exact)."""
    vectors = vectors.drop("code", "error")

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            codes, errors = nearest(matrix(batch.column("embedding"), scale), codebooks)
            text = [row.tobytes().hex() for row in codes.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(text, pa.string()), pa.array(errors.sum(1))], names=[*batch.schema.names, "code", "error"])

    added = [T.StructField("code", T.StringType()), T.StructField("error", T.LongType())]
    return vectors.mapInArrow(coded, T.StructType([*vectors.schema.fields, *added]))


def decode(coded: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """``coded`` with approximation, the integer vector that its code stands for."""
    entries = codebooks.shape[1]
    if not entries:
        return coded.withColumn("approximation", F.array().cast("array<bigint>"))
    books = F.lit(codebooks.reshape(-1, codebooks.shape[2]).tolist())
    at = F.sequence(F.lit(0), F.lit(codebooks.shape[0] - 1))
    index = F.transform(at, lambda p: F.conv(F.substring("code", p * 2 + 1, F.lit(2)), 16, 10).cast("int") + p * entries + 1)
    return coded.withColumn("approximation", F.flatten(F.transform(index, lambda i: F.element_at(books, i))).cast("array<bigint>"))


def with_label_errors(coded: DataFrame, broadcast_labels: int = BROADCAST_LABELS) -> DataFrame:
    """``coded`` with label_error, the error summed over equal labels; null labels are one.

    Sums are made before they meet the rows, so a label that holds most rows is one sum. Up to ``broadcast_labels`` sums, counted, are
    broadcast; beyond it both sides are shuffled, where one side has one row a label and adaptive execution splits a crowded partition.
    """
    sums = cut_lineage(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors").withColumnRenamed("label", "_label")
    few = sums.limit(broadcast_labels + 1).count() <= broadcast_labels
    return coded.join(F.broadcast(sums) if few else sums, F.col("label").eqNullSafe(F.col("_label")), "left").drop("_label")


def digests(embeddings: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every row of ``embeddings`` (vec_id, embedding, label) with a finite vector.

    Rows whose vector is null, or holds a null or non-finite component, are dropped; an empty table gives an empty one. Equal vectors have
    equal codes; repeated vec_ids stay repeated rows; with fewer than 16 kept rows there are so many entries. Vectors of several lengths,
    of a length that 8 does not divide, or with components beyond exact 64-bit distances raise. ``embeddings`` has to be a stored table.
    """
    vectors = finite_rows(embeddings.select("vec_id", "embedding", "label"), "embedding")
    codebooks = fit(vectors)
    coded = cut_lineage(encode(vectors, codebooks).select("vec_id", "label", "code", "error"), "codes")
    return with_label_errors(coded).select("vec_id", "code", "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256"))


def sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The rows of ``digests`` in SQL, one common table expression a step."""
    steps = [
        """kept AS (SELECT vec_id, label, embedding, len(embedding) // %d AS size FROM embeddings WHERE embedding IS NOT NULL
  AND NOT list_contains(list_transform(embedding, lambda x: coalesce(NOT isfinite(x), true)), true))""" % parts,
        f"""x AS (SELECT vec_id, label, CAST(i // size AS INT) AS part, CAST(i % size AS INT) AS pos, CAST(floor({scale} * CAST(embedding[i + 1] AS DOUBLE)) AS BIGINT) AS v
  FROM (SELECT *, unnest(range(len(embedding))) AS i FROM kept))""",
        f"firsts AS (SELECT vec_id, CAST(row_number() OVER (ORDER BY vec_id) - 1 AS INT) AS entry FROM kept QUALIFY row_number() OVER (ORDER BY vec_id) <= {entries})",
        "b0 AS (SELECT part, entry, pos, v AS c FROM x JOIN firsts USING (vec_id))"]

    def assigned(k):
        return (f"d{k} AS (SELECT vec_id, part, entry, sum((v - c) * (v - c)) AS d FROM x JOIN b{k} USING (part, pos) GROUP BY ALL), "
                f"a{k} AS (SELECT vec_id, part, entry, d FROM d{k} QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY d, entry) = 1)")

    for k in range(rounds):
        steps += [assigned(k), f"""m{k} AS (SELECT part, entry, pos, sum(v) AS s, count(*) AS n FROM x JOIN a{k} USING (vec_id, part) GROUP BY ALL),
b{k + 1} AS (SELECT part, entry, pos, CAST(CASE WHEN n IS NULL THEN c ELSE (s - ((s % n) + n) % n) // n END AS BIGINT) AS c FROM b{k} LEFT JOIN m{k} USING (part, entry, pos))"""]
    steps += [assigned(rounds), f"""coded AS (SELECT vec_id, string_agg(lpad(lower(to_hex(entry)), 2, '0'), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id),
sha AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM b{rounds})"""]
    return "WITH " + ",\n".join(steps) + """
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded JOIN kept USING (vec_id), sha"""
