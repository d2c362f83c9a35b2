"""Token-id output: documents as token ids in bit-plane or byte-plane blocks, in document order, and the way back.

A token table is a folder of Parquet files with one row per segment: some whole documents in a row, their token ids cut into
blocks of a fixed number of ids. A block is transposed into planes (plane k holds byte k, or bit k, of every id) and each
plane is compressed with zstandard. The other columns are the segment's index: part, segment, first token within the part,
document ids and token counts, ids per block and plane. A segment can be read on its own, so reading is as parallel as the files
allow, and Spark's commit protocol covers lost executors.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from adjudika.llm.textarrays import LOWER, SLICE_BYTES, WHITE_SPACE, gather, slices, strings, text_bytes, word_spans

#: Words whose ids a Python worker keeps; the cache starts anew beyond that.
KEPT_WORDS = 800_000
#: Ids of a block: the unit of the transposition.
BLOCK_IDS = 65_536
#: Ids after which a segment ends at the next document.
SEGMENT_IDS = 4 * BLOCK_IDS

SEGMENT = ("part int, segment int, first_token long, n_ids long, doc_ids array<bigint>, n_tokens array<bigint>, width int, bits boolean, "
           "planes array<binary>")


class WordIds:
    """The ids of words, each encoded once and kept."""

    def __init__(self, encode, fold: list[bytes] | None = None, most: int = KEPT_WORDS):
        """``most``: words kept. ``fold``: special tokens, if texts without them may be lower-cased and cut where ``parts`` does; None if not."""
        self.encode, self.fold, self.most = encode, fold, most
        self.clear()

    def clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.starts, self.lengths, self.flat = (np.zeros(0, np.int64) for _ in range(3))

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Start and length in ``flat`` of each word's ids."""
        if len(self.rows) + len(words) > self.most:
            self.clear()
        rows = self.rows
        new = [w for w in words if w not in rows]
        if new:
            ids, lengths = self.encode(new)
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.flat = np.concatenate([self.flat, ids])
            rows.update(zip(new, range(len(rows), len(rows) + len(new))))
        at = np.fromiter(map(rows.__getitem__, words), np.int64, len(words))
        return self.starts[at], self.lengths[at]


@lru_cache(maxsize=4)
def word_encoder(path: str) -> WordIds:
    """Words to ids with the tokenizer of a file. It must drop white space and never join across it."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)

    def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        made = tokenizer.encode(words, is_pretokenized=True, add_special_tokens=False)
        owner = np.array(made.word_ids, np.int64)
        return np.array(made.ids, np.int64), np.bincount(owner, minlength=len(words)).astype(np.int64)

    plan = json.loads(tokenizer.to_str())
    lowers = "Lowercase" in json.dumps(plan.get("normalizer"))
    classes = any(p.get("pattern") == {"Regex": CLASS_PATTERN} for p in (plan.get("pre_tokenizer") or {}).get("pretokenizers", []))
    return WordIds(encode, [t["content"].lower().encode() for t in plan["added_tokens"]] if lowers and classes else None)


#: Fixed value: a pattern of pre-tokens that never reach from a letter to a digit or sign, nor back, but over an apostrophe.
CLASS_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_KINDS = np.zeros(256, np.uint8)
_KINDS[0x21:0x7F] = 2
_KINDS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
_KINDS[0x27] = 0


def parts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words cut between an ASCII letter and an ASCII digit or sign other than the apostrophe."""
    kinds = _KINDS[data]
    cuts = np.flatnonzero((kinds[1:] + kinds[:-1] == 3)) + 1  # 1 beside 2
    first = np.sort(np.concatenate([starts, cuts]))
    word = np.searchsorted(starts, first, "right") - 1
    last = np.append(first[1:], len(data))[:len(first)]
    return first, np.minimum(last, ends[word]), owner[word]


def encode_texts(texts: pa.Array, kept: WordIds, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts and the number of each text's ids, the end id included."""
    data, offsets = text_bytes(texts)
    starts, ends, owner = word_spans(data, offsets, WHITE_SPACE)
    if kept.fold is not None:
        lower = LOWER[data]
        if not any(special in lower.tobytes() for special in kept.fold):
            data = lower
            starts, ends, owner = parts(data, starts, ends, owner)
    coded = strings(data, starts, ends).dictionary_encode()
    first, length = kept(coded.dictionary.to_pylist())
    index = coded.indices.to_numpy()
    first, length = first[index], length[index]
    flat = kept.flat
    if end_id is not None:  # one more "word" behind each text
        at = np.searchsorted(owner, np.arange(len(texts)), "right")
        flat = np.append(flat, end_id)
        first, length = np.insert(first, at, len(flat) - 1), np.insert(length, at, 1)
        owner = np.insert(owner, at, np.arange(len(texts)))
    return gather(flat, first, length), np.bincount(owner, length, len(texts)).astype(np.int64)


def to_planes(ids: np.ndarray, width: int, bits: bool, level: int = 3) -> list[bytes]:
    """The planes of each block in turn, compressed."""
    pack, planes = zstandard.ZstdCompressor(level=level), []
    for i in range(0, len(ids), BLOCK_IDS):
        block = np.ascontiguousarray(ids[i:i + BLOCK_IDS].astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].T)
        if bits:
            block = np.concatenate([np.packbits((row[None, :] >> np.arange(8, dtype=np.uint8)[:, None]) & 1, axis=1) for row in block])
        planes += [pack.compress(row.tobytes()) for row in block]
    return planes


def from_planes(planes: list[bytes], n_ids: int, width: int, bits: bool) -> np.ndarray:
    """The ids that ``to_planes`` got."""
    unpack, blocks, per = zstandard.ZstdDecompressor(), [], width * 8 if bits else width
    for k, i in enumerate(range(0, n_ids, BLOCK_IDS)):
        n = min(BLOCK_IDS, n_ids - i)
        rows = [np.frombuffer(unpack.decompress(p), np.uint8) for p in planes[k * per:(k + 1) * per]]
        if bits:
            rows = [np.bitwise_or.reduce([np.unpackbits(p, count=n) << np.uint8(b) for b, p in enumerate(rows[8 * w:8 * w + 8])])
                    for w in range(width)]
        block = np.zeros((n, 4), np.uint8)
        block[:, :width] = np.stack(rows, 1)
        blocks.append(block.reshape(-1).view("<u4"))
    return np.concatenate(blocks) if blocks else np.zeros(0, np.uint32)


def _packer(tokenizer_file: str, end_id: int, width: int, bits: bool):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, kept = TaskContext.get().partitionId(), word_encoder(tokenizer_file)
        segment, first, ids, docs, counts = 0, 0, [], [], []

        def flush():
            nonlocal segment, first
            flat = np.concatenate(ids)
            if len(flat) and int(flat.max()) >> (8 * width):
                raise ValueError(f"an id does not fit into {width} bytes")
            row = {"part": part, "segment": segment, "first_token": first, "n_ids": len(flat), "doc_ids": list(docs), "n_tokens": list(counts),
                   "width": width, "bits": bits, "planes": to_planes(flat, width, bits)}
            segment, first = segment + 1, first + len(flat)
            for x in (ids, docs, counts):
                x.clear()
            return pa.RecordBatch.from_pylist([row], schema=_SEGMENT_ARROW)

        for batch in slices(batches, limit=2 * SLICE_BYTES):
            flat, n = encode_texts(batch.column("text"), kept, end_id)
            doc_ids, at, i = batch.column("doc_id").to_pylist(), np.cumsum(n), 0
            while i < len(n):  # whole documents until the segment is full
                room = (at[i - 1] if i else 0) + SEGMENT_IDS - sum(counts)
                j = min(len(n), int(np.searchsorted(at, room, "left")) + 1)
                ids.append(flat[at[i - 1] if i else 0:at[j - 1]])
                docs += doc_ids[i:j]
                counts += n[i:j].tolist()
                if sum(counts) >= SEGMENT_IDS:
                    yield flush()
                i = j
        if docs:
            yield flush()

    return pack


_SEGMENT_ARROW = pa.schema([("part", pa.int32()), ("segment", pa.int32()), ("first_token", pa.int64()), ("n_ids", pa.int64()),
                            ("doc_ids", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64())), ("width", pa.int32()), ("bits", pa.bool_()),
                            ("planes", pa.list_(pa.binary()))])


def write_tokens(docs: DataFrame, path: str, tokenizer_file: str, end_id: int, width: int = 2, bits: bool = False) -> None:
    """Write the ids of ``docs`` (doc_id, text; other columns are ignored) as a token table, in ascending order of doc_id.

    A null or empty text has the end id alone. Null doc_ids come first; rows of one doc_id stand in the order of a hash of
    their text, and repeated rows are written as often as they occur. An empty input gives an empty table. ``width`` is the number
    of bytes of an id (2 for vocabularies up to 65 536); a larger id is an error. ``bits`` takes bit planes in place of byte planes.
    """
    ordered = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
               .repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie"))
    (ordered.mapInArrow(_packer(tokenizer_file, end_id, width, bits), SEGMENT)
     .write.option("compression", "uncompressed").parquet(path))


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            x = batch.slice(row, 1).to_pylist()[0]
            ids = from_planes(x["planes"], x["n_ids"], x["width"], x["bits"])
            ends = np.cumsum(x["n_tokens"], dtype=np.int64)
            starts = ends - x["n_tokens"]
            raw = memoryview(ids.tobytes())
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([x["part"]] * len(ends), pa.int32()), "doc_id": pa.array(x["doc_ids"], pa.int64()),
                "local_start": pa.array(starts + x["first_token"], pa.int64()), "n_tokens": pa.array(x["n_tokens"], pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist())], pa.int64()),
                "ids": pa.LargeListArray.from_arrays(pa.array(np.append(starts, ends[-1:])), pa.array(ids.astype(np.int32))).cast(pa.list_(pa.int32()))})


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The documents of a token table: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, ids."""
    table = spark.read.parquet(path)
    # One row per part, so this window is as long as the table has files.
    bases = (table.groupBy("part").agg(F.sum("n_ids").alias("n"))
             .select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base")))
    read = table.mapInArrow(_unpack, "part int, doc_id bigint, local_start bigint, n_tokens bigint, ids_crc32 bigint, ids array<int>")
    return read.join(bases, "part").select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32", "ids")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """``read_tokens`` without the ids themselves."""
    return read_tokens(spark, path).drop("ids")
