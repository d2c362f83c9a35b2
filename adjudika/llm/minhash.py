"""Near-duplicate documents: fast similarity sketches, banding, exact verification and connected components.

A sketch has ``BINS`` coordinates. In round r every shingle is hashed once, to a bin and a value r + fraction; a bin keeps its least
value. Rounds go on until every bin is filled; from round ``BINS`` on all shingles go to bin r - BINS, so each bin is filled for
certain. Two sketches agree in a coordinate with the sets' Jaccard similarity as probability, concentrated as for independent
hash functions, for about one hash per shingle.

Documents of equal shingle sets form a class, found by one hash aggregation, and only a class's smallest id goes on. ``BANDS`` bands of
``ROWS`` coordinates give buckets. A bucket proposes its members against its smallest member only; once these links are confirmed
and merged, documents outside a bucket's largest component are held against the rest of the bucket by one-bit signatures of a larger
sketch, and the pairs that may be similar are proposed too. So copies cost one pair each. Every link is confirmed on the full shingle
sets of both texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from adjudika.llm.textarrays import LOWER, SMALL_SLICE_BYTES, WHITE_SPACE, SpanHasher, bounds, mix, slices, text_bytes, windows, word_spans
from adjudika.session import cut_lineage

SHINGLE_WORDS = 5
#: A pair with similarity 0.75 misses all bands with a probability of (1 - 0.75 ** 4) ** 32 = 5e-6.
BANDS, ROWS = 32, 4
BINS = BANDS * ROWS
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 75

_EMPTY = np.uint64(2**64 - 1)


def shingle_sets(texts: pa.Array, width: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of all texts, text by text, and their text numbers."""
    data, offsets = text_bytes(texts)
    data = LOWER[data]
    starts, ends, owner = word_spans(data, offsets, WHITE_SPACE)
    hashes = SpanHasher(data)(starts, ends)
    made, first = windows(hashes, owner, width)
    of = owner[first]
    at = bounds(owner, len(texts))
    n = np.diff(at)
    short = np.flatnonzero((n > 0) & (n < width))
    if len(short):  # the whole sequence is the one shingle
        whole = np.zeros(len(short), np.uint64)
        for k in range(width - 1):
            more = n[short] > k
            whole[more] = whole[more] * np.uint64(0x9FB21C651E98DF25) + hashes[at[short[more]] + k]
        made, of = np.concatenate([made, mix(whole + n[short].astype(np.uint64))]), np.concatenate([of, short])
    return distinct(made, of)


def _by_owner(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted by owner and hash. The owner's 16 bits go before the hash's first 48 into one sort key."""
    order = np.argsort((owner.astype(np.uint64) << np.uint64(48)) | (hashes >> np.uint64(16)), kind="stable")
    return hashes[order], owner[order]


def distinct(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hashes, owner = _by_owner(hashes, owner)
    if not len(hashes):
        return hashes, owner
    new = np.append(True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1]))
    return hashes[new], owner[new]


def sketches(hashes: np.ndarray, owner: np.ndarray, n: int, bins: int = BINS) -> np.ndarray:
    """The n x bins sketches of the sets; an empty set's coordinates stay at the largest value. ``bins``: a power of two up to 2048."""
    out = np.full(n * bins, _EMPTY)
    shift, low = np.uint64(64 - (bins.bit_length() - 1)), np.uint64((1 << 52) - 1)
    for r in range(2 * bins):
        x = mix(hashes + np.uint64((r + 1) * 0xD1B54A32D192ED03 & (2**64 - 1)))
        at = owner * bins + ((x >> shift).astype(np.int64) if r < bins else r - bins)
        np.minimum.at(out, at, (np.uint64(r) << np.uint64(52)) | (x & low))
        live = (out.reshape(n, bins) == _EMPTY).any(1)[owner]
        if not live.all():
            hashes, owner = hashes[live], owner[live]
        if not len(hashes):
            break
    return out.reshape(n, bins)


_SKETCHED = "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>"


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, limit=SMALL_SLICE_BYTES):
        n = batch.num_rows
        hashes, owner = shingle_sets(batch.column("text"))
        sizes = np.bincount(owner, minlength=n).astype(np.int64)
        sums = []
        for seed in (0x243F6A8885A308D3, 0x13198A2E03707344):
            total = np.append(np.uint64(0), np.cumsum(mix(hashes ^ np.uint64(seed))))
            at = np.append(0, np.cumsum(sizes))
            sums.append((total[at[1:]] - total[at[:-1]]).view(np.int64))
        keys = _band_keys(hashes, owner, n)
        bands = pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * BANDS, BANDS, dtype=np.int32)), pa.array(keys.reshape(-1)))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes), pa.array(sums[0]), pa.array(sums[1]), bands],
                                         names=["doc_id", "n_shingles", "set_a", "set_b", "bands"])


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose full shingle sets are similar enough."""
    for batch in slices(batches, "text_a", SMALL_SLICE_BYTES):
        n, sets = batch.num_rows, []
        for side in ("text_a", "text_b"):
            parts = [shingle_sets(b.column(side)) + (b.num_rows,) for b in slices([batch], side, SMALL_SLICE_BYTES)]
            base = np.cumsum([0, *[p[2] for p in parts]])
            sets.append((np.concatenate([p[0] for p in parts]), np.concatenate([p[1] + at for p, at in zip(parts, base)])))
        hashes, owner = _by_owner(np.concatenate([s[0] for s in sets]), np.concatenate([s[1] for s in sets]))
        same = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
        shared = np.bincount(owner[1:][same], minlength=n)
        union = np.bincount(owner, minlength=n) - shared
        yield batch.select(["a", "b"]).filter(pa.array((union > 0) & (100 * shared >= PERCENT * union)))


#: Bits of a signature, and how many may differ: for similar pairs an eighth differs on average, this is 4.5 deviations more.
SIGNATURE_BITS, MOST_DIFFERENT = 2048, 323
_WORDS = SIGNATURE_BITS // 64
_SIGNED = "doc_id bigint, " + ", ".join(f"s{i} bigint" for i in range(_WORDS)) + ", " + ", ".join(f"b{i} bigint" for i in range(BANDS))


def _band_keys(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    sketch, keys = sketches(hashes, owner, n), np.zeros((n, BANDS), np.uint64)
    for k in range(ROWS):
        keys = mix(keys + sketch[:, k::ROWS] + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return keys.view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bit of each coordinate of a large sketch, as words, and the bands."""
    for batch in slices(batches, limit=SMALL_SLICE_BYTES, rows=256):
        n = batch.num_rows
        hashes, owner = shingle_sets(batch.column("text"))
        bits = (sketches(hashes, owner, n, SIGNATURE_BITS) & np.uint64(1)).astype(np.uint8)
        words = np.packbits(bits, axis=1).view(np.int64)
        keys = _band_keys(hashes, owner, n)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(np.ascontiguousarray(words[:, i])) for i in range(_WORDS)],
                                          *[pa.array(np.ascontiguousarray(keys[:, i])) for i in range(BANDS)]],
                                         names=["doc_id", *[f"s{i}" for i in range(_WORDS)], *[f"b{i}" for i in range(BANDS)]])


def _across(members: DataFrame, roots: DataFrame, texts: DataFrame, fits: str) -> DataFrame:
    """The pairs (a, b) that share a bucket, lie in different components and have signatures of similar sets.

    Only the documents outside a bucket's largest component are held against the bucket, and a pair comes from the first bucket it shares.
    """
    placed = members.join(roots, members["doc_id"] == roots["node"], "left").select(
        "bucket", "doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("root"))
    mixed = (placed.groupBy("bucket", "root").count().groupBy("bucket").agg(F.max_by("root", "count").alias("main"), F.count("*").alias("n_roots"))
             .filter("n_roots > 1").drop("n_roots"))
    apart = cut_lineage(placed.join(mixed, "bucket"), "apart")
    signed = cut_lineage(texts.join(apart.select("doc_id").distinct(), "doc_id", "left_semi").mapInArrow(_sign, _SIGNED), "signatures")

    def side(rows: DataFrame, name: str) -> DataFrame:
        joined = rows.join(signed, "doc_id")
        return joined.select("bucket", *[F.col(c).alias(f"{c}_{name}") for c in joined.columns if c != "bucket"])

    stray, other = side(apart.filter("root <> main"), "x"), side(apart, "y")
    differ = " + ".join(f"bit_count(s{i}_x ^ s{i}_y)" for i in range(_WORDS))
    shared = "CASE " + " ".join(f"WHEN b{i}_x = b{i}_y THEN b{i}_x" for i in range(BANDS)) + " END"
    sizes = fits.replace("n_a", "n_shingles_x").replace("n_b", "n_shingles_y")
    pairs = stray.join(other, "bucket").filter("root_x <> root_y AND (root_y = main_y OR doc_id_x < doc_id_y)").filter(sizes).filter(
        f"{differ} <= {MOST_DIFFERENT}").filter(f"{shared} = bucket")
    return pairs.select(F.least("doc_id_x", "doc_id_y").alias("a"), F.greatest("doc_id_x", "doc_id_y").alias("b")).distinct()


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) that are links, by their texts (doc_id, text)."""
    with_texts = (pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
                  .join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b"))
    return with_texts.select("a", "b", "text_a", "text_b").mapInArrow(_confirm, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """Connected components by alternating stars: node, root (its component's smallest node) for every node of an edge (a, b).

    Each pass links every node's larger neighbours to the smallest node around it, then its smaller ones; the passes end when nothing
    changes. They work on the edges' table alone and keep it no longer than it was.
    """
    def both(e):
        return e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select(F.col("b"), F.col("a")))

    def star(e, near):
        least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        return near.join(least, "u"), e

    now = cut_lineage(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        around = both(now)
        large = star(now, around)[0].filter(F.col("v") > F.col("u")).select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()
        down = large.select(F.col("b").alias("u"), F.col("a").alias("v"))
        joined = star(large, down)[0]
        small = joined.select(F.col("m").alias("a"), F.col("v").alias("b")).union(joined.select(F.col("m"), F.col("u")))
        now = cut_lineage(small.filter("a <> b").distinct(), "edges")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003), F.sum(F.xxhash64("b", "a") % 1_000_033)).first()
        if state == before:
            break
        before = state
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).union(now.select("a", "a").distinct())


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs`` (doc_id, text; other columns are ignored).

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case. The set of a document has its distinct five-word shingles, or its whole
    sequence if it has fewer words. A document without words, or with a null text, is linked with nothing and kept. Rows of one doc_id
    are one document with several texts. Rows with a null doc_id have no component and are kept. ``kept`` is
    ``doc_id = component_id``, so repeated rows of a kept doc_id are all kept.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    sketched = cut_lineage(rows.mapInArrow(_sketch, _SKETCHED), "sketches")
    named = sketched.filter("doc_id is not null and n_shingles > 0")
    same = ["n_shingles", "set_a", "set_b"]
    classes = cut_lineage(named.groupBy(*same).agg(F.min("doc_id").alias("rep")), "classes")

    chosen = named.join(classes, [*[named[c] == classes[c] for c in same], named["doc_id"] == classes["rep"]], "left_semi")
    placed = chosen.select("doc_id", "n_shingles", F.explode("bands").alias("bucket"))
    hubs = (placed.groupBy("bucket").agg(F.min("doc_id").alias("hub"), F.min_by("n_shingles", "doc_id").alias("hub_n"), F.max("doc_id").alias("last"))
            .filter("hub <> last").drop("last"))
    members = cut_lineage(placed.join(hubs, "bucket"), "buckets")

    fits = f"100 * least(n_a, n_b) >= {PERCENT} * greatest(n_a, n_b)"
    first = members.filter("doc_id <> hub").select(F.col("hub").alias("a"), F.col("doc_id").alias("b"), F.col("hub_n").alias("n_a"),
                                                    F.col("n_shingles").alias("n_b")).filter(fits).select("a", "b").distinct()
    first = cut_lineage(first, "pairs")
    texts = cut_lineage(rows.join(members.select("doc_id").distinct(), "doc_id", "left_semi"), "texts")
    links = cut_lineage(confirmed(first, texts), "links")
    roots = cut_lineage(components(links), "roots")

    across = cut_lineage(_across(members, roots, texts, fits).join(first, ["a", "b"], "left_anti"), "pairs")
    more = cut_lineage(confirmed(across, texts), "links")
    if not more.isEmpty():
        roots = components(links.union(more))

    labelled = classes.join(roots, classes["rep"] == roots["node"], "left").select(*same, F.coalesce("root", "rep").alias("root"))
    # Null-safe names only: rows without words or id meet no class.
    joined = sketched.join(labelled, same, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n_shingles") > 0, F.col("root")).otherwise(F.col("doc_id")))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"),
                         F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, with their columns: one document of each group, the one with the least id."""
    gone = near_duplicates(docs).filter(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"].cast("bigint") == gone["_gone"], "left_anti")

