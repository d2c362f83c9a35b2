"""Benchmark decontamination as a prefix-filtered join between item windows and documents.

An item window is a run of ``width`` consecutive item words (a shorter item is one window). A document holds the window only if
it holds all of its words, so by the prefix filter one word suffices to find candidates: the window's rarest one, by its count in
the whole corpus. Each occurrence of that word gives one candidate place for every offset and length that windows with this rarest word
have, at most 55 for 10 words, however many windows share the word. Offset and length bound the place within the document (positional and
length bounds), then the hash of the whole candidate finds its window, and at last the words themselves decide.

Candidates are made in slices and long texts are read in segments, so a worker's memory depends neither on a text's length nor on how often
it repeats a word. The benchmark is cut into blocks bounded in windows and in bytes. Each block's index is broadcast; any further blocks are
matched by further passes of the same kernel, so no benchmark is too large.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from adjudika.llm.textarrays import (LOWER, NOT_ALNUM, SMALL_SLICE_BYTES, SpanHasher, bounds, gather, slices, text_bytes, word_spans)

WIDTH = 10
#: Windows of a block, and bytes of its words and item lists, at most (one window may exceed them); equal item lists count once.
BLOCK_WINDOWS, BLOCK_BYTES = 100_000, 32 << 20
#: A longer text is read in segments of about this many bytes.
SEGMENT_BYTES = 1 << 20
#: Candidate places that are held at once.
CANDIDATES = 1 << 16

_COUNTS = "word bigint, n bigint"
_WINDOWS = "item_id string, words array<string>"


def _chunks(texts: pa.Array, overlap: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """Bytes, offsets, number of the first text and number of its first word, of pieces of the texts.

    Texts come together, but one over ``SEGMENT_BYTES`` in segments, cut where a word ends; each begins with the last ``overlap`` words of the one
    before. A word without end is one segment.
    """
    data, offsets = text_bytes(texts)
    long = np.flatnonzero(np.diff(offsets) > SEGMENT_BYTES)
    first = 0
    for k in [*long.tolist(), len(offsets) - 1]:
        if k > first:
            yield data[offsets[first]:offsets[k]], offsets[first:k + 1] - offsets[first], first, 0
        first = k + 1
        if k == len(offsets) - 1:
            return
        at, end, word, size = int(offsets[k]), int(offsets[k + 1]), 0, SEGMENT_BYTES
        while at < end:
            stop = min(end, at + size)
            while stop < end:  # on to the end of the word
                apart = np.flatnonzero(NOT_ALNUM[LOWER[data[stop:min(end, stop + 4096)]]])
                if len(apart):
                    stop += int(apart[0])
                    break
                stop = min(end, stop + 4096)
            starts = word_spans(LOWER[data[at:stop]], np.array([0, stop - at]), NOT_ALNUM)[0]
            if stop < end and 0 < len(starts) <= overlap:  # a segment has to hold a window at least
                size *= 2
                continue
            yield data[at:stop], np.array([0, stop - at]), k, word
            kept = overlap if stop < end and len(starts) else 0
            word += len(starts) - kept
            at, size = at + int(starts[-kept]) if kept else stop, SEGMENT_BYTES


def _words(texts: pa.Array):
    """Lower-cased bytes, word spans, text numbers and word hashes."""
    return _words_of(*text_bytes(texts))


def _words_of(data: np.ndarray, offsets: np.ndarray):
    data = LOWER[data]
    starts, ends, owner = word_spans(data, offsets, NOT_ALNUM)
    return data, starts, ends, owner, SpanHasher(data)(starts, ends)


def word_texts(texts: pa.Array) -> list[list[str]]:
    """The words of each text as strings."""
    data, starts, ends, owner, _ = _words(texts)
    raw, at = data.tobytes(), bounds(owner, len(texts))
    words = [raw[a:b].decode() for a, b in zip(starts.tolist(), ends.tolist())]
    return [words[at[i]:at[i + 1]] for i in range(len(texts))]


def item_windows(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """Distinct windows with the sorted, distinct item_ids (as text) that have them: ``words``, ``items``.

    Items without words or with a null item_id have no window; copies of an item_id with other texts count as one item.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=SMALL_SLICE_BYTES):
            made = [(item, ws[i:i + width]) for item, ws in zip(batch.column("item_id").to_pylist(), word_texts(batch.column("text")))
                    if item is not None for i in range(max(1, len(ws) - width + 1)) if ws]
            yield pa.RecordBatch.from_pydict({"item_id": pa.array([m[0] for m in made], pa.string()),
                                              "words": pa.array([m[1] for m in made], pa.list_(pa.string()))})

    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").mapInArrow(cut, _WINDOWS)
    return rows.groupBy("words").agg(F.array_sort(F.collect_set("item_id")).alias("items"))


def _word_hash(words: list[str]) -> np.ndarray:
    data = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w.encode()) for w in words])
    return SpanHasher(data)(np.append(0, ends[:-1]), ends)


class _Filter:
    """Exact membership of 64-bit hashes in a fixed set, with a bit table in front that turns most others away."""

    def __init__(self, hashes: np.ndarray):
        self.sorted = np.unique(hashes)
        self.bits = np.zeros(1 << 22, bool)
        self.bits[self.sorted >> np.uint64(42)] = True

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indexes of the members and their rank in the sorted set."""
        if not len(self.sorted):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        near = np.flatnonzero(self.bits[hashes >> np.uint64(42)])
        rank = np.minimum(np.searchsorted(self.sorted, hashes[near]), len(self.sorted) - 1)
        same = self.sorted[rank] == hashes[near]
        return near[same], rank[same]


def corpus_counts(docs: DataFrame, words: np.ndarray) -> dict[int, int]:
    """How often each of the given words (hashes, one block's at most) occurs in all documents; absent words are left out."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = _Filter(shared.value), None
        total = np.zeros(len(known.sorted), np.int64)
        for batch in slices(batches, limit=SMALL_SLICE_BYTES):
            for data, offsets, _, _ in _chunks(batch.column("text")):
                _, rank = known.places(_words_of(data, offsets)[4])
                total += np.bincount(rank, minlength=len(total))
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"word": pa.array(known.sorted[held].view(np.int64)), "n": pa.array(total[held])})

    rows = docs.select("text").mapInArrow(count, _COUNTS).groupBy("word").agg(F.sum("n").alias("n"))
    return {r.word & (2**64 - 1): r.n for r in rows.collect()}  # at most one row per given word


class Index:
    """The windows of one block by their rarest word. ``rows``: words and number of the item list; ``sets``: the item lists."""

    def __init__(self, rows: list[tuple[list[str], int]], sets: list[list[str]], counts: dict[int, int]):
        self.sets = sets
        self.set_of = np.array([i for _, i in rows], np.int64)
        self.lengths = np.array([len(words) for words, _ in rows], np.int64)
        self.first = np.cumsum(self.lengths) - self.lengths
        every = [w.encode() for words, _ in rows for w in words]
        self.text = np.frombuffer(b"".join(every), np.uint8)
        self.ends = np.cumsum([len(w) for w in every], dtype=np.int64)
        self.starts = np.append(0, self.ends[:-1]).astype(np.int64) if every else np.zeros(0, np.int64)
        hashes = SpanHasher(self.text)(self.starts, self.ends) if every else np.zeros(0, np.uint64)
        rarity = np.array([counts.get(int(h), 0) for h in hashes], np.int64)
        # The prefix: the rarest word, of equally rare ones the one with the least hash, at its first place.
        offset = np.array([min(range(n), key=lambda k, a=a: (rarity[a + k], hashes[a + k], k)) for a, n in zip(self.first.tolist(), self.lengths.tolist())],
                          np.int64)
        # A window with a word that no document has can't occur.
        held = np.array([bool(rarity[a:a + n].min() > 0) for a, n in zip(self.first.tolist(), self.lengths.tolist())], bool)
        used = np.flatnonzero(held)
        # Windows by the hash of their words' hashes.
        whole = SpanHasher(hashes)(self.first[used], self.first[used] + self.lengths[used]) if len(used) else np.zeros(0, np.uint64)
        order = np.argsort(whole, kind="stable")
        self.whole, self.window = whole[order], used[order]
        # For each prefix word, the distinct offsets and lengths of its windows.
        prefix = hashes[self.first[used] + offset[used]] if len(used) else np.zeros(0, np.uint64)
        self.filter = _Filter(prefix)
        rank = np.searchsorted(self.filter.sorted, prefix)
        shapes = np.unique(np.stack([rank, offset[used], self.lengths[used]], 1), axis=0) if len(used) else np.zeros((0, 3), np.int64)
        self.shape_offset, self.shape_length = shapes[:, 1], shapes[:, 2]
        self.cuts = np.searchsorted(shapes[:, 0], np.arange(len(self.filter.sorted) + 1))

    def _same_words(self, data, starts, ends, begin: np.ndarray, window: np.ndarray) -> np.ndarray:
        """Whether the words from ``begin`` on are those of ``window``, byte by byte."""
        n = self.lengths[window]
        which = np.repeat(np.arange(len(begin)), n)
        theirs, ours = gather(np.arange(len(starts)), begin, n), gather(np.arange(len(self.starts)), self.first[window], n)
        size = self.ends[ours] - self.starts[ours]
        same = ends[theirs] - starts[theirs] == size
        bad = np.zeros(len(begin), bool)
        bad[which[~same]] = True
        which, theirs, ours, size = which[same], theirs[same], ours[same], size[same]
        differ = gather(data, starts[theirs], size) != gather(self.text, self.starts[ours], size)
        bad[which[np.repeat(np.arange(len(which)), size)[differ]]] = True
        return ~bad

    def match(self, texts: pa.Array):
        """For each text: its number of words, the maximal runs of hit words (starts, ends), and the item lists met."""
        n = len(texts)
        n_words = np.zeros(n, np.int64)
        found: dict[int, list] = {}
        longest = int(self.lengths.max()) if len(self.lengths) else 1
        for data, offsets, first, base in _chunks(texts, longest - 1):
            data, starts, ends, owner, hashes = _words_of(data, offsets)
            at = bounds(owner, len(offsets) - 1)
            n_words[first:first + len(at) - 1] = np.diff(at) + base
            place, rank = self.filter.places(hashes)
            if not len(place):
                continue
            hasher = SpanHasher(hashes)
            many = np.cumsum(np.diff(self.cuts)[rank])
            i = 0
            while i < len(place):
                j = max(i + 1, int(np.searchsorted(many, (many[i - 1] if i else 0) + CANDIDATES, "right")))
                for doc, begin, end, sets in self._hits(data, starts, ends, owner, at, hasher, place[i:j], rank[i:j]):
                    found.setdefault(first + doc, []).append((begin + base, end + base, sets))
                i = j
        return n_words, {d: (*_union(np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held])),
                             np.unique(np.concatenate([x[2] for x in held]))) for d, held in found.items()}

    def _hits(self, data, starts, ends, owner, at, hasher, place, rank):
        """Candidate places to hits: text number, disjoint runs of its hit words, item lists."""
        n = np.diff(self.cuts)[rank]
        shape = gather(np.arange(len(self.shape_offset)), self.cuts[rank], n)
        place = np.repeat(place, n)
        begin, length = place - self.shape_offset[shape], self.shape_length[shape]
        doc = owner[place]
        fits = (begin >= at[doc]) & (begin + length <= at[doc + 1])
        begin, length, doc = begin[fits], length[fits], doc[fits]
        whole = hasher(begin, begin + length)
        low, high = np.searchsorted(self.whole, whole), np.searchsorted(self.whole, whole, "right")
        n = high - low  # more than one only where hashes of windows collide
        begin, doc = np.repeat(begin, n), np.repeat(doc, n)
        window = self.window[gather(np.arange(len(self.window)), low, n)] if n.sum() else np.zeros(0, np.int64)
        if len(begin):
            same = self._same_words(data, starts, ends, begin, window)
            begin, doc, window = begin[same], doc[same], window[same]
        order = np.argsort(doc, kind="stable")
        begin, doc, window = begin[order] - at[doc[order]], doc[order], window[order]
        cuts = np.append(np.flatnonzero(np.append(True, np.diff(doc) > 0)), len(doc)) if len(doc) else [0]
        for a, b in zip(cuts[:-1], cuts[1:]):
            run = _union(begin[a:b], begin[a:b] + self.lengths[window[a:b]])
            yield int(doc[a]), *run, np.unique(self.set_of[window[a:b]])


def _union(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of the intervals as disjoint, ascending intervals; those that touch are one."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.append(True, starts[1:] > ends[:-1]) if len(starts) else np.zeros(0, bool)
    return starts[new], ends[np.append(new[1:], True)] if len(starts) else ends


def blocks(benchmark: DataFrame, docs: DataFrame, width: int = WIDTH) -> Iterator[Index]:
    """The benchmark's windows in blocks of ``BLOCK_WINDOWS``, with rarity counted over all documents."""
    held, sets, size = [], {}, 0

    def index():
        words = _word_hash(sorted({w for ws, _ in held for w in ws}))
        return Index(held, [list(s) for s in sets], corpus_counts(docs, words))

    # Each row passes the driver once; only the windows and distinct item lists of one block are held.
    for row in item_windows(benchmark, width).toLocalIterator():
        items = tuple(row["items"])
        size += sum(map(len, row.words)) + (0 if items in sets else sum(map(len, items)))
        held.append((list(row.words), sets.setdefault(items, len(sets))))
        if len(held) == BLOCK_WINDOWS or size >= BLOCK_BYTES:
            yield index()
            held, sets, size = [], {}, 0
    if held:
        yield index()


def _with_hits(docs: DataFrame, index: Index) -> DataFrame:
    """Adds one block's hits to the columns ``_n``, ``_starts``, ``_ends`` and ``_items``."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in slices(batches, limit=SMALL_SLICE_BYTES):
            n_words, found = index.match(batch.column("text"))
            made = {name: batch.column(name).to_pylist() for name in ("_starts", "_ends", "_items")}
            for d, (starts, ends, sets) in found.items():
                before = (np.array(made[name][d], np.int64) for name in ("_starts", "_ends"))
                both = _union(*(np.concatenate(x) for x in zip(before, (starts, ends))))
                made["_starts"][d], made["_ends"][d] = (x.tolist() for x in both)
                made["_items"][d] = sorted({*made["_items"][d], *(item for k in sets.tolist() for item in index.sets[k])})
            columns = {name: batch.column(name) for name in batch.schema.names} | {
                "_n": pa.array(n_words, pa.int64()), "_starts": pa.array(made["_starts"], pa.list_(pa.int64())),
                "_ends": pa.array(made["_ends"], pa.list_(pa.int64())), "_items": pa.array(made["_items"], pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return docs.mapInArrow(scan, docs.schema)


_WORK = ["_n", "_starts", "_ends", "_items"]


def _scanned(docs: DataFrame, benchmark: DataFrame, width: int) -> DataFrame:
    """``docs`` with the hits of all blocks in the columns ``_WORK``."""
    none = F.array().cast(T.ArrayType(T.LongType()))
    made = docs.drop(*_WORK).withColumns({"_n": F.lit(None).cast("bigint"), "_starts": none, "_ends": none,
                                          "_items": F.array().cast(T.ArrayType(T.StringType()))})
    some = False
    for index in blocks(benchmark, docs, width):
        made, some = _with_hits(made, index), True
    return made if some else _with_hits(made, Index([], [], {}))


def find_items(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """Every row of ``docs`` with what it shares with ``benchmark`` (item_id, text).

    Adds n_words, hit_starts and hit_ends (maximal runs of hit words, by word number), items (sorted ids as text), n_hit, n_items and
    contaminated. Columns of ``docs`` with these names are replaced. A null or empty text has no words; an empty benchmark hits
    nothing; repeated rows are judged alike; a word is hit once, however many windows cover it. A very long text is read in segments that
    overlap by one word less than a window has, so no window is lost.
    """
    docs = docs.drop("n_words", "hit_starts", "hit_ends", "items", "n_hit", "n_items", "contaminated")
    spans = F.zip_with("_ends", "_starts", lambda b, a: b - a)
    return _scanned(docs, benchmark, width).withColumns({
        "n_words": F.col("_n"), "hit_starts": F.col("_starts"), "hit_ends": F.col("_ends"), "items": F.col("_items"),
        "n_hit": F.aggregate(spans, F.lit(0).cast("bigint"), lambda a, x: a + x), "n_items": F.size("_items").cast("bigint"),
        "contaminated": F.size("_items") > 0}).drop(*_WORK)


def digests(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every document."""
    return find_items(docs.select("doc_id", "text"), benchmark, width).select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def clean(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """The documents without any benchmark window, with their columns."""
    return _scanned(docs, benchmark, width).filter(F.size("_items") == 0).drop(*_WORK)
