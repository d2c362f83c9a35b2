"""Removal of passages that an earlier document has: every byte covered by a 50-byte string that also starts in a smaller doc_id.

Equal strings have to meet in one task without moving all suffixes. Of the ``K``-byte strings in a 50-byte window, the one with the least hash
is the window's anchor; equal windows have equal anchors. Neighbouring windows with one anchor form a unit, about one per 15 bytes.

1. Units are dealt by their anchor's hash as packed hashes (anchor, whole unit). Where equal units meet, all but those of the smallest
   document are repeats; this is decided by the hashes alone, without a look at the bytes. Where different units share an anchor, one text of
   each is asked for. Of an anchor with many different units in one merge only a mark is sent, and all those units are asked for.
2. This step sees only different units that share an anchor. Each task sorts the suffixes of the texts it gets: a mergesort whose comparisons
   find the longest common extension of two suffixes by binary search on prefix polynomial hashes. Suffixes that agree in 50 bytes are
   compared byte by byte, then the smallest document wins.
   An anchor with many texts (a short line between ever differing neighbours) would fill one task: its windows are dealt once more, each by
   the hash of its own 50 bytes, so that only windows that are probably equal meet; equal ones of a batch are merged before that.
3. Documents meet the verdicts on their units, and the covered bytes are cut.

Before the first shuffle equal units of a batch are merged, so a passage in a third of all documents sends one record per batch. Verdicts
travel packed by document bucket and are streamed ahead of the bucket's texts, so no group of texts is held in memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from adjudika.llm.textarrays import SpanHasher, gather, mix, slices, text_bytes
from adjudika.session import cut_lineage

LENGTH = 50
#: Bytes of an anchor: long enough to be rare by chance in running text.
K = 20
_WINDOWS = LENGTH - K + 1
#: Text bytes whose units are found at once: a byte takes some arrays of 8 bytes, and large ones are slow.
SLICE_BYTES = 1 << 17
#: Text bytes of units that are compared at once, for the same reason; the texts of one anchor stay together.
COMPARE_BYTES = 1 << 18
#: Text bytes whose units are merged before they are sent.
MERGE_BYTES = 16 << 20
#: Different units of an anchor in one merge, beyond which they are not dealt by the anchor.
MANY = 128
#: Texts of an anchor in one task, beyond which their windows are dealt by their own bytes.
MOST = 4_096
#: Units whose windows are listed at once to deal them by their bytes, and pairs of windows whose bytes are compared at once.
_PART = 1 << 15
_ALL = np.uint32(0xFFFFFFFF)

_PACKED = "bucket int, blob binary"  # hashes travel with their low 40 bits, besides those that choose the bucket


class Units:
    """The units of some texts. ``anchor``, ``first`` and ``last`` window start are byte places in ``data``."""

    def __init__(self, texts: pa.Array):
        self.data, self.offsets = text_bytes(texts)
        self.hasher = SpanHasher(self.data, seed=5)
        n = len(self.data)
        if n < LENGTH:
            self.anchor = self.first = self.last = self.text = np.zeros(0, np.int64)
            self.key = self.span = self.id = np.zeros(0, np.uint64)
            return
        prefix = self.hasher.prefix
        hashes = prefix[K:] - prefix[:-K]
        hashes *= self.hasher.inverse[:n - K + 1]
        least, place = self._least(hashes)
        turn = np.ones(len(least) + 1, bool)  # a unit starts where the anchor changes, with its text, and its text's last windows end one
        turn[1:-1] = least[1:] != least[:-1]
        turn[self.offsets[self.offsets < len(least)]] = True
        past = self.offsets[1:] - LENGTH + 1
        turn[past[past > self.offsets[:-1]]] = True
        turn = np.flatnonzero(turn)
        first, after = turn[:-1], turn[1:]
        text = np.searchsorted(self.offsets, first, "right") - 1
        whole = np.flatnonzero(first + LENGTH <= self.offsets[text + 1])
        self.first, self.last, self.text = first[whole], after[whole] - 1, text[whole]
        self.anchor = (least[self.first] & place).astype(np.int64)
        self.key = mix(hashes[self.anchor])
        # Equal spans with the anchor at the same place are equal units.
        self.span = mix(self.hasher(self.first, self.last + LENGTH) + (self.anchor - self.first).astype(np.uint64))
        self.id = _unit_id(self.key, self.span)

    @staticmethod
    def _least(hashes: np.ndarray) -> tuple[np.ndarray, np.uint64]:
        """For each window the place of its anchor, the least hash (of 40 bits), of equal ones the first; and in which bits that place is."""
        low = np.uint64(0xFFFFFF)
        if len(hashes) < 1 << 24:
            least = hashes & ~low
            least |= np.arange(len(hashes), dtype=np.uint64)
            for step in (1, 2, 4, 8, _WINDOWS - 16):
                least = np.minimum(least[:-step], least[step:])
            return least, low
        short, least = hashes >> np.uint64(24), np.arange(len(hashes))
        for step in (1, 2, 4, 8, _WINDOWS - 16):
            a, b = least[:-step], least[step:]
            least = np.where(short[a] <= short[b], a, b)
        return least.astype(np.uint64), ~np.uint64(0)


def _unit_id(key: np.ndarray, span: np.ndarray) -> np.ndarray:
    """Names a unit within a document: 40 bits of its anchor's hash, 24 of its own."""
    return (key & np.uint64(0xFFFFFFFFFF)) << np.uint64(24) | (span >> np.uint64(16)) & np.uint64(0xFFFFFF)


def _planes(x: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of 64-bit numbers, plane by plane, which compresses well."""
    return x.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _from_planes(raw: np.ndarray, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = raw[:n * width].reshape(width, n).T
    return out.reshape(-1).view(np.uint64)


def _pack(kind: int, *columns: tuple[np.ndarray, int]) -> bytes:
    return bytes([kind]) + b"".join(_planes(np.ascontiguousarray(x), w) for x, w in columns)


def _unpack(blob: bytes, *widths: int) -> list[np.ndarray]:
    raw = np.frombuffer(blob, np.uint8, offset=1)
    n, out, at = len(raw) // sum(widths), [], 0
    for w in widths:
        out.append(_from_planes(raw[at:], n, w))
        at += n * w
    return out


# Kinds of blobs: units (key, span, doc) or their texts; verdicts (doc, id, mask); anchors with many units (key); windows (id, doc, within, bytes).
_UNIT, _KNOWN, _MANY, _WINDOW = 0, 1, 2, 3


def _runs(values: np.ndarray) -> list[tuple[int, int]]:
    """Start and end of the runs of equal values."""
    cuts = np.flatnonzero(np.append(len(values) > 0, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)
    return list(zip(cuts.tolist(), np.append(cuts[1:], len(values)).tolist()))


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (hashes >> np.uint64(40)) % np.uint64(buckets)


def _dealt(bucket: np.ndarray, buckets: int) -> np.ndarray:
    """The order by bucket, else as before; numbers of 16 bits are sorted by radix."""
    return np.argsort(bucket.astype(np.min_scalar_type(buckets)), kind="stable")


def _starts(values: np.ndarray) -> np.ndarray:
    """Where a run of equal values starts."""
    return np.append(len(values) > 0, values[1:] != values[:-1])[:len(values)]


def _grouped(key: np.ndarray, *then: np.ndarray) -> np.ndarray:
    """The order by key and then the others. Most keys are alone, so only the rest is sorted by all columns."""
    order = np.argsort(key)
    new = _starts(key[order])
    some = np.flatnonzero(~(new & np.append(new[1:], True)[:len(new)]))
    part = order[some]
    order[some] = part[np.lexsort((*(x[part] for x in then[::-1]), key[part]))]
    return order


def _marks(key: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes]]:
    """Tells the anchors' buckets that these anchors have many units."""
    key = np.unique(key)
    bucket = _bucket(key, buckets)
    order = _dealt(bucket, buckets)
    key, bucket = key[order], bucket[order]
    for a, b in _runs(bucket):
        yield int(bucket[a]), _pack(_MANY, (key[a:b], 5))


def _per_run(new: np.ndarray, counted: np.ndarray) -> np.ndarray:
    """How many rows of each row's run are counted; ``new`` tells where runs start."""
    run = np.cumsum(new) - 1
    return np.bincount(run, counted)[run] if len(run) else run


def _verdicts(doc: np.ndarray, ids: np.ndarray, mask: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes]]:
    """Verdicts packed by document bucket."""
    bucket = doc % buckets
    order = _dealt(bucket, buckets)
    doc, ids, mask, bucket = doc[order], ids[order], mask[order], bucket[order]
    cuts = np.flatnonzero(np.append(len(bucket) > 0, bucket[1:] != bucket[:-1])) if len(bucket) else []
    for a, b in zip(cuts, np.append(cuts[1:], len(bucket)) if len(bucket) else []):
        yield int(bucket[a]), _pack(_KNOWN, (doc[a:b].astype(np.int64).view(np.uint64), 8), (ids[a:b], 8), (mask[a:b].astype(np.uint64), 4))


def _batch(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["bucket", "blob"])


def _send(buckets: int, many: int = MANY):
    """Units of the texts, merged and packed by bucket; repeats within a merge are decided here, and all units of an anchor that has more than
    ``many`` different ones are asked for."""
    def flush(held: list[Units], doc: np.ndarray, turn: int) -> pa.RecordBatch:
        key, span, ids = (np.concatenate([getattr(u, name) for u in held]) for name in ("key", "span", "id"))
        order = _grouped(key, span, doc)
        new_key, by_doc = _starts(key[order]), doc[order]
        new = new_key | _starts(span[order])
        lead = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        again = order[~new & (by_doc > by_doc[lead]) & _starts(by_doc)]
        rows = []
        if len(again):  # any bucket will do: they only pass through
            rows.append((turn % buckets, _pack(_KNOWN, (doc[again].view(np.uint64), 8), (ids[again], 8), (np.full(len(again), _ALL, np.uint64), 4))))
        many_of = _per_run(new_key, new) > many
        if many_of.any():
            crowd = order[new & many_of]
            rows.append((turn % buckets, _pack(_KNOWN, (doc[crowd].view(np.uint64), 8), (ids[crowd], 8), (np.full(len(crowd), _ASK, np.uint64), 4))))
            rows += _marks(key[crowd], buckets)
        left = np.sort(order[new & ~many_of])  # as the texts stand, so that a document's numbers are side by side
        bucket = _bucket(key[left], buckets)
        order = _dealt(bucket, buckets)
        left, bucket = left[order], bucket[order]
        key, span, doc = key[left], span[left], doc[left]
        for a, b in _runs(bucket):
            rows.append((int(bucket[a]), _pack(_UNIT, (key[a:b], 5), (span[a:b], 5), (doc[a:b].view(np.uint64), 8))))
        return _batch(rows)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs, size, turn = [], [], 0, 0
        for batch in slices(batches, limit=SLICE_BYTES):
            units = Units(batch.column("text"))
            if not len(units.key):
                continue
            doc = np.asarray(batch.column("doc_id"), np.int64)[units.text]
            size, turn = size + len(units.data), turn + 1 + int(doc[0])
            units.data = units.hasher = None
            held.append(units)
            docs.append(doc)
            if size >= MERGE_BYTES:
                yield flush(held, np.concatenate(docs), turn)
                held, docs, size = [], [], 0
        if held:
            yield flush(held, np.concatenate(docs), turn)

    return send


_ASK = np.uint32(0)  # the verdict of a unit whose text is asked for


def _marked(key: np.ndarray, marked: list[np.ndarray]) -> np.ndarray:
    """Which anchors have a mark of many units."""
    return np.isin(key, np.concatenate(marked)) if marked else np.zeros(len(key), bool)


def _meet(buckets: int):
    """Verdicts on the units of one bucket: repeats, and those whose texts have to be compared."""
    def meet(table: pa.Table) -> pa.Table:
        rows, units, marked = [], [], []
        for blob in table["blob"].to_pylist():
            if blob[0] == _KNOWN:
                doc, ids, mask = _unpack(blob, 8, 8, 4)
                rows += _verdicts(doc.view(np.int64), ids, mask, buckets)
            elif blob[0] == _MANY:
                marked += _unpack(blob, 5)
            else:
                units.append(_unpack(blob, 5, 5, 8))
        if units:
            key, span, doc = (np.concatenate(x) for x in zip(*units))
            doc = doc.view(np.int64)
            order = _grouped(key, span, doc)
            key, span, doc = key[order], span[order], doc[order]
            new_key = _starts(key)
            new = new_key | _starts(span)
            lead = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
            repeat = doc > doc[lead]
            ask = new & ((_per_run(new_key, new) > 1) | _marked(key, marked))
            told = np.flatnonzero(repeat | ask)
            ids = key[told] << np.uint64(24) | (span[told] >> np.uint64(16))
            rows += _verdicts(doc[told], ids, np.where(repeat[told], _ALL, _ASK), buckets)
        return pa.Table.from_batches([_batch(rows)])

    return meet


class _Known:
    """The verdicts of one document bucket."""

    def __init__(self):
        self.parts, self.ready, self.told = [], None, {}

    def add(self, blob: bytes) -> None:
        self.parts.append(_unpack(blob, 8, 8, 4))

    def _sorted(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        if self.ready is None:
            columns = [np.concatenate(x) for x in zip(*self.parts)] if self.parts else [np.zeros(0, np.uint64)] * 3
            names = mix(columns[0]) + columns[1]
            order = np.argsort(names)
            names = names[order]
            first = np.flatnonzero(_starts(names))
            total = np.bitwise_or.reduceat(columns[2][order], first) if len(first) else columns[2]
            self.ready, self.parts = (names[first], columns[0][order[first]], columns[1][order[first]], total), []
        return self.ready

    def texts(self, doc: np.ndarray, asked: bool) -> np.ndarray:
        """Which documents have units that are asked for, or else units with repeats."""
        if asked not in self.told:
            _, docs, _, mask = self._sorted()
            self.told[asked] = np.unique(docs[(mask == _ASK) == asked])
        return np.isin(doc.view(np.uint64), self.told[asked])

    def masks(self, doc: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """-1 without a verdict, else the windows that are repeats as bits."""
        names, docs, units, mask = self._sorted()
        if not len(names):
            return np.full(len(ids), -1, np.int64)
        doc = doc.view(np.uint64)
        at = np.minimum(np.searchsorted(names, mix(doc) + ids), len(names) - 1)
        return np.where((docs[at] == doc) & (units[at] == ids), mask[at].astype(np.int64), -1)


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Known, pa.RecordBatch]]:
    """The texts of sorted rows (bucket, kind, ...), each piece with the verdicts that came ahead in its bucket."""
    known, bucket = _Known(), None
    for batch in batches:
        place = np.stack([batch.column("bucket").to_numpy(), batch.column("kind").to_numpy()])
        cuts = np.flatnonzero(np.append(True, (place[:, 1:] != place[:, :-1]).any(0))) if batch.num_rows else []
        for a, b in zip(cuts, np.append(cuts[1:], batch.num_rows) if batch.num_rows else []):
            if place[0, a] != bucket:
                known, bucket = _Known(), place[0, a]
            part = batch.slice(a, b - a)
            if place[1, a] == 0:
                for blob in part.column("blob").to_pylist():
                    known.add(blob)
            else:
                for piece in slices([part], limit=SLICE_BYTES):
                    yield known, piece


def _with_verdicts(rows: DataFrame, verdicts: DataFrame, buckets: int) -> DataFrame:
    """Texts and verdicts side by side in document buckets, verdicts first."""
    texts = rows.select(F.coalesce(F.pmod("doc_id", F.lit(buckets)), F.lit(0)).cast("int").alias("bucket"), F.lit(1).alias("kind"), "doc_id", "text",
                        F.lit(None).cast("binary").alias("blob"))
    known = verdicts.select("bucket", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("doc_id"), F.lit(None).cast("string").alias("text"), "blob")
    return texts.unionByName(known).repartition("bucket").sortWithinPartitions("bucket", "kind")


def _doc_ids(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The ids, 0 for null, and which are null."""
    column = batch.column("doc_id")
    return np.asarray(column.fill_null(0), np.int64), np.asarray(column.is_null())


def _judged(known: _Known, batch: pa.RecordBatch, asked: bool) -> tuple[Units, np.ndarray, np.ndarray, np.ndarray]:
    """The units of the texts that have units asked for, or else repeats; their documents and masks; and which rows of the batch these texts are."""
    doc, null = _doc_ids(batch)
    some = np.flatnonzero(known.texts(doc, asked) & ~null)
    units = Units(batch.column("text").take(pa.array(some)))
    doc = doc[some][units.text]
    return units, doc, known.masks(doc, units.id), some


def _ask(buckets: int, many: int = MANY):
    """The texts that were asked for, packed by their anchor's bucket; of an anchor with more than ``many`` texts in a batch a mark, and the windows
    by their own bytes."""
    def flush(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        key, ids, doc, anchor, size = (np.concatenate(x) for x in list(zip(*held))[:5])
        data = np.concatenate([h[5] for h in held])
        begin = np.cumsum(size) - size
        order = np.argsort(key)
        crowd = _per_run(_starts(key[order]), np.ones(len(key))) > many
        if crowd.any():
            some = order[crowd]
            yield _batch(list(_marks(key[some], buckets)))
            yield from _apart(data, begin, size, ids, doc, some, buckets)
        rows, bucket = [], _bucket(key, buckets)
        at = np.sort(order[~crowd])
        at = at[_dealt(bucket[at], buckets)]
        for a, b in _runs(bucket[at]):
            some = at[a:b]
            columns = _pack(_UNIT, (key[some], 5), (ids[some], 8), (doc[some].view(np.uint64), 8), (anchor[some].astype(np.uint64), 1), (size[some].astype(np.uint64), 1))
            rows.append((int(bucket[some[0]]), columns[:1] + len(some).to_bytes(4, "little") + columns[1:] + gather(data, begin[some], size[some]).tobytes()))
        if rows:
            yield _batch(rows)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seen = [], 0
        for known, batch in _streamed(batches):
            units, doc, mask, _ = _judged(known, batch, asked=True)
            at = np.flatnonzero(mask == _ASK)
            seen += len(units.data)
            if len(at):
                size = units.last[at] + LENGTH - units.first[at]
                held.append((units.key[at], units.id[at], doc[at], (units.anchor - units.first)[at], size, gather(units.data, units.first[at], size)))
            if held and seen >= MERGE_BYTES:
                yield from flush(held)
                held, seen = [], 0
        if held:
            yield from flush(held)

    return ask


class Suffixes:
    """Suffixes of a byte array, cut off at ``length``, compared by hashes of their prefixes."""

    def __init__(self, data: np.ndarray, length: int):
        hasher = SpanHasher(data, seed=7)
        self.data, self.length, self.prefix, self.inverse = data, length, hasher.prefix, hasher.inverse
        self.whole = (self.prefix[length:] - self.prefix[:-length]) * self.inverse[:max(len(data) - length + 1, 0)]

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether two suffixes have the same hash in their whole length."""
        return self.whole[a] == self.whole[b]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common extension of two suffixes, by binary search where they are not equal."""
        out = np.full(len(a), self.length)
        other = np.flatnonzero(~self.same(a, b))
        a, b, reach = a[other], b[other], np.zeros(len(other), np.int64)
        base_a, base_b, inv_a, inv_b = self.prefix[a], self.prefix[b], self.inverse[a], self.inverse[b]
        step = 1 << (self.length.bit_length() - 1)
        while step:
            longer = np.minimum(reach + step, self.length)
            same = (self.prefix[a + longer] - base_a) * inv_a == (self.prefix[b + longer] - base_b) * inv_b
            reach = np.where(same, longer, reach)
            step >>= 1
        out[other] = reach
        return out

    def compare(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 as suffix a is less than, equal to or greater than b."""
        reach = self.common(a, b)
        inside = np.minimum(reach, self.length - 1)
        x, y = self.data[a + inside].astype(np.int64), self.data[b + inside].astype(np.int64)
        return np.where(reach == self.length, 0, np.sign(x - y))

    def sort(self, starts: np.ndarray, group: np.ndarray) -> np.ndarray:
        """The order of the suffixes within each group, groups ascending: a bottom-up mergesort of all groups side by side."""
        order = np.argsort(group)
        first = np.flatnonzero(_starts(group[order]))
        size = np.diff(np.append(first, len(group)))
        taken = np.zeros(len(group), bool)
        run = 1
        while (live := np.flatnonzero(size > run)).size:
            first, size = first[live], size[live]
            pairs = (size + run - 1) // (2 * run)  # of neighbouring runs
            left = gather(np.arange(pairs.max()), np.zeros(len(pairs), np.int64), pairs) * (2 * run) + np.repeat(first, pairs)
            right = left + run
            end = np.minimum(right + run, np.repeat(first + size, pairs))
            mixed = np.flatnonzero(self.compare(starts[order[right - 1]], starts[order[right]]) > 0)  # the others are in order already
            left, right, end = left[mixed], right[mixed], end[mixed]
            if run == 1:
                order[left], order[right] = order[right], order[left]
            elif len(left):
                self._merge(starts, order, left, right, end, taken)
            run *= 2
        return order

    def _merge(self, starts: np.ndarray, order: np.ndarray, left: np.ndarray, right: np.ndarray, end: np.ndarray, taken: np.ndarray) -> None:
        """Merges sorted runs of ``order``: those from ``left`` with those from ``right`` to ``end``. The items of left runs look for their ranks,
        the others fill the places that are left. ``taken`` is false before and after."""
        run = int(right[0] - left[0])
        at = (left[:, None] + np.arange(run)).ravel()
        low, high = np.repeat(right, run), np.repeat(end, run)
        rank, item = low.copy(), starts[order[at]]
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) // 2
            before = self.compare(starts[order[middle]], item[open_]) < 0
            low[open_[before]] = middle[before] + 1
            high[open_[~before]] = middle[~before]
        to, places = at + (low - rank), np.arange(len(order))
        taken[to] = True
        whole = gather(places, left, end - left)
        moved, others = order[at], order[gather(places, right, end - right)]
        order[whole[~taken[whole]]] = others
        order[to] = moved
        taken[to] = False


def _windows_of(begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, unit and place within it of every window of the units' texts."""
    n = size - LENGTH + 1
    unit = np.repeat(np.arange(len(n)), n)
    within = np.arange(len(unit)) - np.repeat(np.cumsum(n) - n, n)
    return begin[unit] + within, unit, within


def _judge(data: np.ndarray, start: np.ndarray, group: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows' order by group and bytes; in that order whether each equals the one before it, and the least document of its equals."""
    suffixes = Suffixes(data, LENGTH)
    order = suffixes.sort(start, group)
    start, group, doc = start[order], group[order], doc[order]
    near = np.flatnonzero(group[1:] == group[:-1])
    near = near[suffixes.same(start[near], start[near + 1])]
    same, text = np.zeros(len(start), bool), np.lib.stride_tricks.sliding_window_view(data, LENGTH)
    for at in range(0, len(near), _PART):  # the bytes themselves
        x = near[at:at + _PART]
        same[x[(text[start[x]] == text[start[x + 1]]).all(1)] + 1] = True
    lead = np.flatnonzero(~same)
    return order, same, np.repeat(np.minimum.reduceat(doc, lead), np.diff(np.append(lead, len(start))))


def _masks(doc: np.ndarray, ids: np.ndarray, within: np.ndarray, buckets: int) -> list[tuple[int, bytes]]:
    """Verdicts on single windows, one for each unit."""
    if not len(doc):
        return []
    order = np.lexsort((ids, doc))
    doc, ids, bit = doc[order], ids[order], np.uint64(1) << within[order].astype(np.uint64)
    first = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (ids[1:] != ids[:-1])))
    return list(_verdicts(doc[first], ids[first], np.bitwise_or.reduceat(bit, first), buckets))


def _by_bytes(data: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The windows' hashes."""
    return SpanHasher(data, seed=5)(start, start + LENGTH)


def _apart(data: np.ndarray, begin: np.ndarray, size: np.ndarray, ids: np.ndarray, doc: np.ndarray, some: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """The windows of some units, dealt by their own bytes: of equal ones those of the least document, the others are repeats."""
    for at in range(0, len(some), _PART):
        part = some[at:at + _PART]
        text, width = gather(data, begin[part], size[part]), size[part]
        start, unit, within = _windows_of(np.cumsum(width) - width, width)
        owner, named = doc[part][unit], ids[part][unit]
        name = _by_bytes(text, start)
        order, same, least = _judge(text, start, name, owner)
        run = np.cumsum(~same)
        start, within, owner, named, name = (x[order] for x in (start, within, owner, named, name))
        hit = owner > least
        rows = _masks(owner[hit], named[hit], within[hit], buckets)
        # Rows of one doc_id may repeat a unit.
        left = np.flatnonzero(~hit)
        left = left[np.lexsort((within[left], named[left], run[left]))]
        new = np.append(True, (run[left][1:] != run[left][:-1]) | (named[left][1:] != named[left][:-1]) | (within[left][1:] != within[left][:-1]))
        left = left[new]
        bucket = _bucket(name[left], buckets)
        order = _dealt(bucket, buckets)
        left, bucket = left[order], bucket[order]
        for a, b in _runs(bucket):
            x = left[a:b]
            columns = _pack(_WINDOW, (named[x], 8), (owner[x].view(np.uint64), 8), (within[x].astype(np.uint64), 1))
            rows.append((int(bucket[a]), columns + gather(text, start[x], np.full(len(x), LENGTH)).tobytes()))
        yield _batch(rows)


def _together(key: np.ndarray, size: np.ndarray) -> list[slice]:
    """Pieces of units sorted by key, of about ``COMPARE_BYTES`` of text, without cutting a key."""
    first = np.flatnonzero(_starts(key))
    first = first[_starts((np.cumsum(size) - size)[first] // COMPARE_BYTES)]
    return [slice(a, b) for a, b in zip(first.tolist(), np.append(first[1:], len(key)).tolist())]


def _compare(buckets: int, most: int = MOST):
    """Verdicts on the units of one bucket whose texts were asked for: which of their windows a smaller document has. Marked anchors and those with
    more than ``most`` texts give their windows, dealt by their bytes; such windows and verdicts pass through."""
    def compare(table: pa.Table) -> pa.Table:
        parts, texts, rows, marked = [], [], [], []
        for at, blob in zip(table["bucket"].to_pylist(), table["blob"].to_pylist()):
            if blob[0] == _MANY:
                marked += _unpack(blob, 5)
            elif blob[0] != _UNIT:
                rows.append((at, blob))
            else:
                head = 5 + int.from_bytes(blob[1:5], "little") * 23
                parts.append(_unpack(blob[4:head], 5, 8, 8, 1, 1))
                texts.append(blob[head:])
        out = [_batch(rows)]
        if parts:
            key, ids, doc, anchor, size = (np.concatenate(x) for x in zip(*parts))
            doc, anchor, size = doc.view(np.int64), anchor.astype(np.int64), size.astype(np.int64)
            data = np.frombuffer(b"".join(texts), np.uint8)
            begin = np.cumsum(size) - size
            order = np.argsort(key)
            key, ids, doc, anchor, size, begin = (x[order] for x in (key, ids, doc, anchor, size, begin))
            crowd = (_per_run(_starts(key), np.ones(len(key))) > most) | _marked(key, marked)
            out += _apart(data, begin, size, ids, doc, np.flatnonzero(crowd), buckets)
            key, ids, doc, anchor, size, begin = (x[~crowd] for x in (key, ids, doc, anchor, size, begin))
            hits = []
            for part in _together(key, size):
                text, width, owner = gather(data, begin[part], size[part]), size[part], doc[part]
                start, unit, within = _windows_of(np.cumsum(width) - width, width)
                # Only windows with the same anchor at the same place can be equal.
                name = np.cumsum(_starts(key[part]))
                order, _, least = _judge(text, start, name[unit] * 64 + (anchor[part][unit] - within), owner[unit])
                unit, within = unit[order], within[order]
                hit = owner[unit] > least
                unit = unit[hit]
                hits.append((owner[unit], ids[part][unit], within[hit]))
            if hits:
                out.append(_batch(_masks(*(np.concatenate(x) for x in zip(*hits)), buckets)))
        return pa.Table.from_batches(out)

    return compare


def _settle(buckets: int):
    """Verdicts on windows that were dealt by their bytes."""
    def settle(table: pa.Table) -> pa.Table:
        parts, texts = [], []
        for blob in table["blob"].to_pylist():
            head = len(blob) - (len(blob) - 1) // (17 + LENGTH) * LENGTH
            parts.append(_unpack(blob[:head], 8, 8, 1))
            texts.append(blob[head:])
        ids, doc, within = (np.concatenate(x) for x in zip(*parts))
        doc, data = doc.view(np.int64), np.frombuffer(b"".join(texts), np.uint8)
        start = np.arange(len(ids)) * LENGTH
        order, _, least = _judge(data, start, _by_bytes(data, start), doc)
        hit = order[doc[order] > least]
        return pa.Table.from_batches([_batch(_masks(doc[hit], ids[hit], within[hit], buckets))])

    return settle


def removed_spans(units: Units, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of the maximal runs of covered bytes. ``mask``: each unit's windows that are repeats, as bits."""
    some = np.flatnonzero(mask)
    at, unit, within = _windows_of(units.first[some], units.last[some] + LENGTH - units.first[some])
    hit = np.flatnonzero((mask[some][unit] >> within) & 1)
    at, text = at[hit], units.text[some][unit[hit]]  # ascending, as the units are
    if not len(at):
        return at, at, text
    new = np.append(True, (at[1:] > at[:-1] + LENGTH) | (text[1:] != text[:-1]))
    first = np.flatnonzero(new)
    return at[first], at[np.append(first[1:], len(at)) - 1] + LENGTH, text[first]


_SPANS = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, span_starts array<bigint>, span_ends array<bigint>, kept binary"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for known, batch in _streamed(batches):
        units, _, mask, some = _judged(known, batch, asked=False)
        start, end, text = removed_spans(units, np.maximum(mask, 0))
        data, offsets = text_bytes(batch.column("text"))
        shift = (offsets[some] - units.offsets[:-1])[text]
        start, end, text = start + shift, end + shift, some[text]
        at = np.searchsorted(text, np.arange(batch.num_rows + 1))
        inside = np.zeros(len(data) + 1, np.int8)
        inside[start] += 1
        inside[end] -= 1
        kept = data[np.cumsum(inside[:-1], dtype=np.int8) == 0].tobytes() if len(start) else data.tobytes()
        removed = np.append(0, np.cumsum(end - start))[at]  # in all texts before
        bounds, view = offsets - removed, memoryview(kept)
        sha256 = [hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        lists = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(x - offsets[text], pa.int64())) for x in (start, end)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(np.diff(removed)), pa.array(np.diff(at).astype(np.int64)), pa.array(sha256, pa.string()),
             *lists, pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(kept)])],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "span_starts", "span_ends", "kept"])


def _prime(n: int) -> int:
    while any(n % k == 0 for k in range(2, int(n ** 0.5) + 1)):
        n += 1
    return n


def remove_repeats(docs: DataFrame, many: int = MANY, most: int = MOST) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, span_starts, span_ends and kept (the remaining bytes) of every row of ``docs``.

    Texts are UTF-8 bytes, null is empty; other columns are ignored. Strings are judged on the input: what is removed elsewhere still counts.
    Rows of one doc_id do not remove from each other. Rows with a null doc_id lose nothing and remove nothing. Texts below 50 bytes stay.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    # Buckets of hashes and of documents; a prime deals regular ids evenly.
    buckets = _prime(2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    named = rows.filter("doc_id is not null")
    met = named.mapInArrow(_send(buckets, many), _PACKED).groupBy("bucket").applyInArrow(_meet(buckets), _PACKED)
    verdicts = cut_lineage(met, "verdicts")
    asked = _with_verdicts(named, verdicts, buckets).mapInArrow(_ask(buckets, many), _PACKED)
    compared = cut_lineage(asked.groupBy("bucket").applyInArrow(_compare(buckets, most), _PACKED), "verdicts")
    window = F.substring("blob", 1, 1) == F.lit(bytes([_WINDOW]))
    settled = compared.filter(window).groupBy("bucket").applyInArrow(_settle(buckets), _PACKED)
    return _with_verdicts(rows, verdicts.unionByName(compared.filter(~window)).unionByName(settled), buckets).mapInArrow(_cut, _SPANS)


def digests(docs: DataFrame) -> DataFrame:
    """``remove_repeats`` without the spans and bytes themselves."""
    return remove_repeats(docs).drop("span_starts", "span_ends", "kept")
