"""SentencePiece encoding as a max-plus scan, and decoding.

The pieces of a model file and their scores are a unigram model: a text's encoding is the sequence of pieces with the largest sum of
scores. Spaces become U+2581, one is put before the text, and a character without a piece becomes its UTF-8 byte pieces.

A text of up to ``CHUNK`` characters is encoded in one go. A longer one is split into chunks. A chunk's boundary state is the number of
characters by which the piece across the boundary reaches into it. Each chunk yields the matrix of best scores from every entry state to
every exit state; matrices are combined by the associative max-plus product (a prefix scan by doubling), which gives each chunk its
entry and exit state, and then every chunk is traced back on its own, in any task.

Within a chunk no piece crosses certain places (before a space that follows another character, if in all pieces spaces only lead), so
the runs between them are encoded once per distinct run and kept. Of equally good segmentations, the one with the longer last piece wins,
and across a chunk boundary the one with the smaller overhang.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from adjudika.llm.textarrays import SMALL_SLICE_BYTES, SpanHasher, gather, slices, strings, text_bytes
from adjudika.llm.tokens import WordIds
from adjudika.session import cut_lineage

CHUNK = 16_384
SPACE = "▁"
#: Runs whose pieces a Python worker keeps.
KEPT_RUNS = 300_000
#: Distinct runs up to this length are segmented together; longer ones one by one.
SHORT_RUN = 48
_WIDTHS = ((1, 8), (9, 14), (15, SHORT_RUN))
_LOW = float("-inf")


class Model:
    """Pieces and scores of a model file."""

    def __init__(self, path: str):
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        n = m.get_piece_size()
        texts = [m.id_to_piece(i) for i in range(n)]
        normal = [i for i in range(n) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))]
        self.score = np.array([m.get_score(i) for i in range(n)])
        self.unknown = float(self.score[normal].min()) - 10.0
        self.bytes = np.array([m.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int64)
        self.by_text = {texts[i]: i for i in normal}
        self.longest = max(map(len, self.by_text))
        self.space_leads = all(SPACE not in t.lstrip(SPACE) for t in self.by_text)
        self.newline_alone = all(t == "\n" or "\n" not in t for t in self.by_text)
        codes, ends = _codes("".join(self.by_text)), np.cumsum([len(t) for t in self.by_text])
        hashes = SpanHasher(codes, seed=3)(np.append(0, ends[:-1]), ends)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], np.array(normal, np.int64)[order]
        self.near = np.zeros(1 << 20, bool)  # turns most strings that are no piece away
        self.near[self.hashes >> np.uint64(44)] = True
        shown = [bytes([int(t[3:5], 16)]) if m.is_byte(i) else b"" if m.is_control(i) else t.replace(SPACE, " ").encode() for i, t in enumerate(texts)]
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        self.shown_length = np.array([len(s) for s in shown], np.int64)
        self.shown_start = np.cumsum(self.shown_length) - self.shown_length
        self.kept = WordIds(lambda units: segment(self, units), most=KEPT_RUNS)

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Piece ids by hash, -1 for none."""
        out = np.full(len(hashes), -1, np.int64)
        near = np.flatnonzero(self.near[hashes >> np.uint64(44)])
        at = np.minimum(np.searchsorted(self.hashes, hashes[near]), len(self.hashes) - 1)
        out[near] = np.where(self.hashes[at] == hashes[near], self.ids[at], -1)
        return out

    def expand(self, ids: np.ndarray, codes: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number per owner, with -1 (an unknown character, of the given code) as its byte pieces."""
        unknown = np.flatnonzero(ids < 0)
        if not len(unknown):
            return ids, np.bincount(owner, minlength=n).astype(np.int64)
        raw = [chr(c).encode("utf-8", "replace") for c in codes[unknown].tolist()]
        width = np.ones(len(ids), np.int64)
        width[unknown] = [len(r) for r in raw]
        out, ends = np.repeat(ids, width), np.cumsum(width)
        out[np.repeat(ids < 0, width)] = self.bytes[np.frombuffer(b"".join(raw), np.uint8)]
        return out, np.diff(np.append(0, ends)[np.searchsorted(owner, np.arange(n + 1))])


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


@lru_cache(maxsize=4)
def load(path: str) -> Model:
    return Model(path)


def segment(model: Model, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The best pieces of each unit, found on its own: all ids, and the number of each unit's ids."""
    text = "".join(units).replace(" ", SPACE)
    codes = _codes(text)
    lengths = np.array([len(u) for u in units], np.int64)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    chosen = np.full(len(codes), -2, np.int64)  # the piece that begins here, -1: an unknown character, -2: none begins
    for u in np.flatnonzero(lengths > SHORT_RUN):
        a, b = int(starts[u]), int(ends[u])
        for s, i in path(model, text[a:b], {0: 0.0}, b - a, b - a)[1]:
            chosen[a + s] = i
    hasher = SpanHasher(codes, seed=3)
    for low, high in _WIDTHS:
        order = np.flatnonzero((lengths >= low) & (lengths <= high))
        order = order[np.argsort(-lengths[order], kind="stable")]
        if len(order):
            _segment_short(model, hasher, starts[order], lengths[order], chosen)
    at = np.flatnonzero(chosen > -2)
    return model.expand(chosen[at], codes[at], np.searchsorted(ends, at, "right"), len(units))


def _segment_short(model: Model, hasher: SpanHasher, starts: np.ndarray, lengths: np.ndarray, chosen: np.ndarray) -> None:
    """Viterbi over all units at once, by the place within the unit; units come longest first."""
    most = int(lengths[0])
    grid = np.zeros((most, len(starts)), np.int64)  # place x unit: index into codes
    live = [int(np.searchsorted(-lengths, -p, "right")) for p in range(most + 1)]  # units of at least p characters
    longest = min(model.longest, most)
    for p in range(most):
        grid[p] = starts + p
    found = np.full((longest + 1, most, len(starts)), -1, np.int32)
    for size in range(1, longest + 1):
        for p in range(most - size + 1):
            k = live[p + size]
            found[size, p, :k] = model.lookup(hasher(grid[p, :k], grid[p, :k] + size))
    best = np.full((most + 1, len(starts)), _LOW)
    back = np.zeros((most + 1, len(starts)), np.int64)
    best[0] = 0
    for e in range(1, most + 1):
        k = live[e]
        for size in range(min(e, longest), 0, -1):
            ids = found[size, e - size, :k]
            score = np.where(ids >= 0, model.score[ids], model.unknown if size == 1 else _LOW)
            total = best[e - size, :k] + score
            better = total > best[e, :k]
            best[e, :k][better] = total[better]
            back[e, :k][better] = size
    unit, at = np.arange(len(starts)), lengths.copy()
    while len(unit):
        size = back[at, unit]
        at = at - size
        chosen[starts[unit] + at] = found[size, at, unit]
        more = at > 0
        unit, at = unit[more], at[more]


def forward(model: Model, text: str, entry: dict[int, float], limit: int, stop: int) -> tuple[list[float], list[tuple[int, int]]]:
    """Best scores at 0 .. stop from scored entry places, by pieces that begin before ``limit``; and each place's last piece (start, id)."""
    best, back = [_LOW] * (stop + 1), [(-1, -2)] * (stop + 1)
    for p, score in entry.items():
        if p <= stop:
            best[p] = score
    by_text, score, longest = model.by_text, model.score, model.longest
    for s in range(min(limit, stop)):
        base = best[s]
        if base == _LOW:
            continue
        for e in range(s + 1, min(s + longest, stop) + 1):
            i = by_text.get(text[s:e], -1)
            if i >= 0:
                total = base + score[i]
            elif e == s + 1:
                total = base + model.unknown
            else:
                continue
            if total > best[e]:
                best[e], back[e] = total, (s, i)
    return best, back


def path(model: Model, text: str, entry: dict[int, float], limit: int, stop: int) -> tuple[float, list[tuple[int, int]]]:
    """The best way from an entry to ``stop``: score and pieces (start, id)."""
    best, back = forward(model, text, entry, limit, stop)
    out, at = [], stop
    while back[at][0] >= 0:
        out.append(back[at])
        at = back[at][0]
    return best[stop], out[::-1]


def cuts(model: Model, text: str, n: int) -> tuple[int, int] | None:
    """The first and the last place in 1 .. n - 1 that no piece crosses (``text`` with U+2581 for spaces), if there is any."""
    if not model.space_leads:
        return None
    first = next((i for i in range(1, n) if text[i] == SPACE and text[i - 1] != SPACE), None)
    if first is None:
        return None
    return first, next(i for i in range(n - 1, 0, -1) if text[i] == SPACE and text[i - 1] != SPACE)


def transfer(model: Model, text: str, n: int, middle: float | None = None) -> np.ndarray:
    """The chunk's max-plus matrix, entry state x exit state. ``text``: n characters of the chunk and what follows, spaces as U+2581.

    ``middle`` is the score from the first to the last place that no piece crosses, found here if not given. Every way through the chunk has it, so
    any other number in its place moves all entries alike and leaves the best states as they are.
    """
    size = model.longest
    out = np.full((size, size), _LOW)
    inner = cuts(model, text, n)
    stop = min(n + size - 1, len(text))
    if inner is None:
        for i in range(min(size, n + 1)):
            reach = forward(model, text, {i: 0.0}, n, stop)[0][n:]
            out[i, :len(reach)] = reach
        return out
    first, last = inner
    if middle is None:
        middle = path(model, text[first:last], {0: 0.0}, last - first, last - first)[0]
    tail = forward(model, text[last:], {0: 0.0}, n - last, stop - last)[0][n - last:]
    for i in range(min(size, first + 1)):
        head = forward(model, text[:first], {i: 0.0}, first, first)[0][first]
        out[i, :len(tail)] = head + middle + np.array(tail)
    return out


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The max-plus product of (stacks of) matrices."""
    return np.max(a[..., :, :, None] + b[..., None, :, :], axis=-2)


def states(matrices: np.ndarray) -> list[tuple[int, int]]:
    """Entry and exit state of each chunk of a text on its best path, which enters the first and leaves the last in state 0."""
    prefix, step = matrices.copy(), 1
    while step < len(prefix):  # prefix products by doubling
        prefix[step:] = product(prefix[:-step], prefix[step:])
        step *= 2
    out, leave = [], 0
    for k in range(len(matrices) - 1, -1, -1):
        before = prefix[k - 1][0] if k else np.where(np.arange(matrices.shape[1]) == 0, 0.0, _LOW)
        enter = int(np.argmax(before + matrices[k][:, leave]))
        out.append((enter, leave))
        leave = enter
    return out[::-1]


def _encode_units(model: Model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts whose first character is a space, and their numbers."""
    data, offsets = text_bytes(texts)
    space = data == 0x20
    cut = np.zeros(len(data), bool)
    inner = offsets[:-1][offsets[:-1] < offsets[1:]]
    if model.space_leads:
        cut[1:] = space[1:] & ~space[:-1]
        if model.newline_alone:
            line = data == 0x0A
            cut |= line
            cut[1:] |= line[:-1]
    cut[inner] = True
    starts = np.flatnonzero(cut)
    ends = np.append(starts[1:], len(data)) if len(starts) else starts
    owner = np.searchsorted(offsets, starts, "right") - 1
    coded = strings(data, starts, ends).dictionary_encode()
    first, length = model.kept(coded.dictionary.to_pylist())
    index = coded.indices.to_numpy()
    first, length = first[index], length[index]
    return gather(model.kept.flat, first, length), np.bincount(owner, length, len(texts)).astype(np.int64)


def encode_texts(model: Model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of whole texts and their numbers; a null or empty text has none."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    led = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string())))
    return _encode_units(model, led)


def decode_ids(model: Model, ids: np.ndarray, n: np.ndarray) -> list[bytes]:
    """The UTF-8 bytes of each run of ids, without the space put before the text."""
    length = model.shown_length[ids]
    raw = gather(model.shown, model.shown_start[ids], length).tobytes()
    ends = np.append(0, np.cumsum(length))[np.append(0, np.cumsum(n))]
    return [raw[a + 1:b] if raw[a:a + 1] == b" " else raw[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def _lists(ids: np.ndarray, n: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)).astype(np.int32)), pa.array(ids.astype(np.int32)))


_CHUNKS = "uid bigint, chunk int, n int, text string, matrix binary"


def _split(path: str, chunk: int):
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for batch in slices(batches, limit=SMALL_SLICE_BYTES):
            for uid, text in zip(batch.column("uid").to_pylist(), batch.column("text").to_pylist()):
                text = SPACE + text.replace(" ", SPACE)
                at = [*range(0, len(text) - chunk // 2, chunk), len(text)]  # the last chunk takes a short rest
                pieces = [text[a:b + model.longest - 1] for a, b in zip(at, at[1:])]
                sizes = [b - a for a, b in zip(at, at[1:])]
                for k, (piece, n) in enumerate(zip(pieces, sizes)):
                    made = transfer(model, piece, n, 0.0)
                    yield pa.RecordBatch.from_pydict({"uid": pa.array([uid], pa.int64()), "chunk": pa.array([k], pa.int32()), "n": pa.array([n], pa.int32()),
                                                      "text": pa.array([piece]), "matrix": pa.array([made.tobytes()])})

    return split


def _scores(model: Model) -> np.ndarray:
    """Scores by id, where the first byte of a character carries the score of an unknown one and the others none."""
    score = model.score.copy()
    first = np.array([b < 0x80 or b >= 0xC0 for b in range(256)])
    score[model.bytes[first]], score[model.bytes[~first]] = model.unknown, 0.0
    return score


def _scan(table: pa.Table) -> pa.Table:
    """Entry and exit states of the chunks of one text."""
    table = table.sort_by("chunk")
    raw = np.frombuffer(b"".join(table["matrix"].to_pylist()), np.float64)
    size = int(round((len(raw) // len(table)) ** 0.5))
    found = states(raw.reshape(len(table), size, size))
    return pa.table({"uid": table["uid"], "chunk": table["chunk"], "enter": pa.array([f[0] for f in found], pa.int32()),
                     "leave": pa.array([f[1] for f in found], pa.int32())})


def _trace(path_: str):
    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path_)
        for batch in slices(batches, limit=SMALL_SLICE_BYTES):
            out, counts = [], []
            rows = batch.to_pylist()
            inner = [cuts(model, r["text"], r["n"]) for r in rows]
            middles = pa.array([r["text"][c[0]:c[1]].replace(SPACE, " ") if c else "" for r, c in zip(rows, inner)], pa.large_string())
            ids, n = _encode_units(model, middles)
            at = np.append(0, np.cumsum(n))
            for k, (row, c) in enumerate(zip(rows, inner)):
                stop = row["n"] + row["leave"]
                if c:
                    parts = [_ids_of(model, row["text"], row["enter"], c[0], c[0]), ids[at[k]:at[k + 1]], _ids_of(model, row["text"], c[1], row["n"], stop)]
                else:
                    parts = [_ids_of(model, row["text"], row["enter"], row["n"], stop)]
                whole = np.concatenate(parts)
                out.append(whole)
                counts.append(len(whole))
            yield pa.RecordBatch.from_arrays([batch.column("uid"), batch.column("chunk"), _lists(np.concatenate(out), np.array(counts))],
                                             names=["uid", "chunk", "ids"])

    return trace


def _ids_of(model: Model, text: str, start: int, limit: int, stop: int) -> np.ndarray:
    """The ids of text[start:stop], by pieces that begin before ``limit``."""
    pieces = path(model, text[start:stop], {0: 0.0}, limit - start, stop - start)[1]
    ids = np.array([i for _, i in pieces], np.int64)
    codes = _codes(text)[[start + s for s, _ in pieces]] if pieces else np.zeros(0, np.uint32)
    return model.expand(ids, codes, np.zeros(len(ids), np.int64), 1)[0]


def _short(docs: DataFrame, model_file: str, chunk: int, schema: str, made) -> DataFrame:
    """Texts of up to ``chunk`` characters, encoded in one go: the columns that ``made`` gives for (batch, ids, number of ids)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(model_file)
        for batch in slices(batches, limit=SMALL_SLICE_BYTES):
            yield pa.RecordBatch.from_pydict(made(model, batch, *encode_texts(model, batch.column("text"))))

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.filter(F.coalesce(F.length("text"), F.lit(0)) <= chunk).mapInArrow(run, schema)


def _long(docs: DataFrame, model_file: str, chunk: int) -> DataFrame:
    """doc_id, ids and n_chunks of longer texts, by chunks."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    # A row's place is its name while its chunks are apart.
    long = rows.filter(F.length("text") > chunk).withColumn("uid", F.monotonically_increasing_id())
    chunks = cut_lineage(long.select("uid", "doc_id", "text").mapInArrow(_named(_split(model_file, chunk)), "doc_id bigint, " + _CHUNKS), "chunks")
    found = chunks.select("uid", "chunk", "matrix").groupBy("uid").applyInArrow(_scan, "uid bigint, chunk int, enter int, leave int")
    traced = (chunks.select("uid", "chunk", "n", "text").join(found, ["uid", "chunk"])
              .mapInArrow(_trace(model_file), "uid bigint, chunk int, ids array<int>"))
    joined = traced.groupBy("uid").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "ids"))), lambda x: x["ids"])).alias("ids"),
                                       F.count("*").cast("int").alias("n_chunks"))
    names = chunks.filter("chunk = 0").select("uid", "doc_id")
    return joined.join(names, "uid").select("doc_id", "ids", "n_chunks")


def encode(docs: DataFrame, model_file: str, chunk: int = CHUNK) -> DataFrame:
    """doc_id, ids and n_chunks of every row of ``docs`` (doc_id, text; other columns are ignored).

    A null or empty text has no ids and no chunk. Repeated rows are encoded as often as they occur. An empty table gives no rows.
    """
    short = _short(docs, model_file, chunk, "doc_id bigint, ids array<int>, n_chunks int", lambda model, batch, ids, n: {
        "doc_id": batch.column("doc_id"), "ids": _lists(ids, n), "n_chunks": pa.array((n > 0).astype(np.int32))})
    return short.unionByName(_long(docs, model_file, chunk))


def _named(split):
    """Gives each chunk the doc_id of its text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = dict(zip(batch.column("uid").to_pylist(), batch.column("doc_id").to_pylist()))
            for made in split([batch]):
                yield pa.RecordBatch.from_arrays([pa.array([ids[u] for u in made.column("uid").to_pylist()], pa.int64()), *made.columns],
                                                 names=["doc_id", *made.schema.names])

    return run


def _each(rows: DataFrame, model_file: str, schema: str, made) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(model_file)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                lists = part.column("ids")
                n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                yield pa.RecordBatch.from_pydict(made(part, ids, n, decode_ids(model, ids, n)))

    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, model_file: str) -> DataFrame:
    """doc_id and text of encoded rows (doc_id, ids). Null ids are no ids. Bytes that are no UTF-8 become replacement characters."""
    return _each(encoded.select("doc_id", "ids"), model_file, "doc_id bigint, text string", lambda part, ids, n, raw: {
        "doc_id": part.column("doc_id"), "text": pa.array([r.decode("utf-8", "replace") for r in raw], pa.string())})


def _digest(doc_ids: pa.Array, n_chunks: pa.Array, ids: np.ndarray, n: np.ndarray, raw: list[bytes]) -> dict[str, pa.Array]:
    ends = (4 * np.cumsum(n)).tolist()
    flat = memoryview(ids.astype("<u4").tobytes())
    return {"doc_id": doc_ids, "n_chunks": n_chunks, "n_pieces": pa.array(n, pa.int64()),
            "ids_crc32": pa.array([zlib.crc32(flat[a:b]) for a, b in zip([0, *ends], ends)], pa.int64()),
            "decoded_sha256": pa.array([hashlib.sha256(r).hexdigest() for r in raw], pa.string())}


def digests(docs: DataFrame, model_file: str, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_chunks, n_pieces, ids_crc32 (of the ids as little-endian 32-bit numbers) and decoded_sha256 of every document: its ids and the
    text that they decode to."""
    schema = "doc_id bigint, n_chunks int, n_pieces bigint, ids_crc32 bigint, decoded_sha256 string"
    short = _short(docs, model_file, chunk, schema, lambda model, batch, ids, n: _digest(
        batch.column("doc_id"), pa.array((n > 0).astype(np.int32)), ids, n, decode_ids(model, ids, n)))
    return short.unionByName(_each(_long(docs, model_file, chunk), model_file, schema, lambda part, ids, n, raw: _digest(
        part.column("doc_id"), part.column("n_chunks"), ids, n, raw)))
