import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from adjudika.llm import substrings
from adjudika.llm.queries import QUERIES


def brute_force(rows):
    rows = [(i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, b in rows:
        if i is not None:
            for p in range(len(b) - 49):
                first[b[p:p + 50]] = min(i, first.get(b[p:p + 50], i))
    out = []
    for i, b in rows:
        covered = bytearray(len(b))
        for p in range(len(b) - 49):
            if i is not None and first[b[p:p + 50]] < i:
                covered[p:p + 50] = b"\1" * 50
        spans = sum(1 for k, c in enumerate(covered) if c and (k == 0 or not covered[k - 1]))
        kept = bytes(x for x, c in zip(b, covered) if not c)
        out.append((-99 if i is None else i, len(b), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def result(df):
    return sorted((-99 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def passages(rng, n):
    words = ["the", "of", "été", "x"] + ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    return " ".join(rng.choice(words) for _ in range(n))


def test_against_brute_force(spark, docs_of):
    rng = random.Random(1)
    common = [passages(rng, k) for k in (4, 9, 12, 15, 40, 80)] + ["ab" * 60, "a" * 130, "é" * 40]
    rows = []
    for i in range(150):
        parts = [rng.choice(common) if rng.random() < 0.5 else passages(rng, rng.randint(0, 30)) for _ in range(rng.randint(0, 6))]
        text = rng.choice(["", " ", "\n"]).join(parts)
        if text and rng.random() < 0.5:
            k = rng.randrange(len(text))
            text = text[:k] + "#" + text[k + 1:]
        rows.append((rng.randrange(10**6) - 1000, text))
    rows += [(rows[5][0], rows[5][1]), (rows[6][0], rows[7][1]), (None, rows[8][1]), (None, None), (77, None), (78, ""), (79, "z" * 49), (80, "z" * 49),
             (81, "z" * 50), (82, "z" * 51), (83, rows[9][1]), (84, rows[9][1])]
    rng.shuffle(rows)
    assert result(substrings.digests(docs_of(rows))) == brute_force(rows)


def test_one_text_in_all_documents(spark, docs_of):
    rng = random.Random(2)
    line = passages(rng, 30)
    rows = [(i, passages(rng, 20) + line + str(i % 7) + passages(rng, 5)) for i in range(300)] + [(1000 + i, line) for i in range(100)]
    assert result(substrings.digests(docs_of(rows, 6))) == brute_force(rows)


def lines_between(rng, n, line="Licensed for use by all the readers here."):
    """Documents around one line with ever differing neighbours; some neighbours are shared."""
    ends = [passages(rng, 6) for _ in range(12)]
    part = lambda: rng.choice(ends) if rng.random() < 0.3 else passages(rng, 8)
    return [(i, part() + line + part()) for i in rng.sample(range(10 * n), n)]


@pytest.mark.parametrize("many,most", [(2, 4096), (40, 4), (40, 4096), (10**6, 10**6)])
def test_one_line_between_differing_neighbours(spark, docs_of, many, most):
    rows = lines_between(random.Random(3), 400)
    rows += [(rows[1][0], rows[0][1]), (rows[2][0], rows[2][1]), (None, rows[3][1])]
    assert result(substrings.remove_repeats(docs_of(rows, 5), many, most)) == brute_force(rows)


def test_no_anchor_fills_a_task():
    rows = [(i, f"{i:09d}/{i * 7919:015d}" + "Licensed for use by all the readers here." + f"{i * 104729:015d}/{i:09d}") for i in range(3000)]
    docs = pa.RecordBatch.from_pydict({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows]})
    sent = [blob for out in substrings._send(7)([docs]) for blob in out["blob"].to_pylist()]
    keys = np.concatenate([substrings._unpack(blob, 5, 5, 8)[0] for blob in sent if blob[0] == substrings._UNIT])
    assert np.unique(keys, return_counts=True)[1].max() <= 128
    units = substrings.Units(docs["text"])
    blob = substrings._pack(1, (units.text.astype(np.uint64), 8), (units.id, 8), (np.zeros(len(units.id), np.uint64), 4))
    asked = pa.RecordBatch.from_arrays(
        [pa.array([0] * 3001), pa.array([0] + [1] * 3000), pa.array([None] + [r[0] for r in rows]), pa.array([None] + [r[1] for r in rows]),
         pa.array([blob] + [None] * 3000, pa.binary())], names=["bucket", "kind", "doc_id", "text", "blob"])
    dealt = [blob for out in substrings._ask(7)([asked]) for blob in out["blob"].to_pylist()]
    assert {blob[0] for blob in dealt} >= {substrings._MANY, substrings._WINDOW}
    texts = [blob for blob in dealt if blob[0] == substrings._UNIT]
    keys = [substrings._unpack(blob[4:5 + int.from_bytes(blob[1:5], "little") * 23], 5, 8, 8, 1, 1)[0] for blob in texts]
    assert not keys or np.unique(np.concatenate(keys), return_counts=True)[1].max() <= 128


def test_empty_table_and_spans(spark, docs_of):
    docs = docs_of([(1, "q" * 60), (2, "r" + "q" * 55 + "s")])
    assert substrings.digests(docs.limit(0)).count() == 0
    got = {r.doc_id: r for r in substrings.remove_repeats(docs).collect()}
    assert (got[2].span_starts, got[2].span_ends, bytes(got[2].kept)) == ([1], [56], b"rs") and got[1].n_removed == 0


@pytest.mark.parametrize("seed", range(4))
def test_suffix_sort(seed):
    rng = np.random.default_rng(seed)
    data = rng.integers(97, 99, 500, dtype=np.uint8)
    starts = rng.permutation(450)[:300]
    group = rng.integers(0, 7, 300)
    order = substrings.Suffixes(data, 50).sort(starts, group)
    raw = data.tobytes()
    key = lambda k: (group[k], raw[starts[k]:starts[k] + 50])
    assert [key(k) for k in order] == sorted(key(k) for k in range(300))


def test_query_on_the_small_table(spark):
    path = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    assert result(QUERIES["op9_suffix_dedup"](spark, path)) == brute_force(rows)


def test_units_do_not_depend_on_neighbours():
    rng = random.Random(6)
    texts = ["", "x" * 49, "y" * 50, passages(rng, 40), "", "z" * 10, passages(rng, 200), "ab" * 60, "q" * 49, None, "é" * 26, passages(rng, 12), ""]
    together, alone = substrings.Units(pa.array(texts, pa.string())), []
    for i, text in enumerate(texts):
        u, at = substrings.Units(pa.array([text], pa.string())), together.offsets[i]
        alone += [(i, *x) for x in zip((u.first + at).tolist(), (u.last + at).tolist(), (u.anchor + at).tolist(), u.id.tolist())]
    assert list(zip(together.text.tolist(), together.first.tolist(), together.last.tolist(), together.anchor.tolist(), together.id.tolist())) == alone
    windows = [p for _, first, last, *_ in alone for p in range(first, last + 1)]
    lengths = [len((t or "").encode()) for t in texts]
    assert windows == [a + p for a, n in zip(together.offsets.tolist(), lengths) for p in range(n - 49)]


def test_texts_are_hashed_in_small_pieces_and_only_where_needed(monkeypatch):
    seen, units = [], substrings.Units

    def spied(texts):
        seen.append([len(t) for t in texts.to_pylist()])
        return units(texts)

    rng = random.Random(7)
    rows = [(i, f"{i:04d}" + "".join(rng.choice("abcdefgh ") for _ in range(1400))) for i in range(1000)]
    rows[900] = (900, rows[10][1])
    docs = pa.RecordBatch.from_pydict({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows]})
    monkeypatch.setattr(substrings, "Units", spied)
    sent = [row for out in substrings._send(1)([docs]) for row in out.to_pylist()]
    assert sum(map(len, seen)) == 1000 and max(map(sum, seen)) <= 1 << 17
    met = substrings._meet(1)(pa.table({"bucket": [0] * len(sent), "blob": [r["blob"] for r in sent]}))["blob"].to_pylist()
    streamed = pa.RecordBatch.from_arrays(
        [pa.array([0] * (len(met) + 1000)), pa.array([0] * len(met) + [1] * 1000), pa.array([None] * len(met) + [r[0] for r in rows]),
         pa.array([None] * len(met) + [r[1] for r in rows]), pa.array(met + [None] * 1000, pa.binary())], names=["bucket", "kind", "doc_id", "text", "blob"])
    seen.clear()
    assert not [out for out in substrings._ask(1)([streamed])] and not sum(map(len, seen))
    cut = pa.Table.from_batches(substrings._cut([streamed])).to_pylist()
    assert sum(map(len, seen)) == 1 and [(r["doc_id"], r["n_removed"]) for r in cut if r["n_removed"]] == [(900, 1404)]
    assert [bytes(r["kept"]).decode() for r in cut] == [t if i != 900 else "" for i, t in rows]


@pytest.mark.parametrize("seed", range(3))
def test_comparison_in_small_pieces(monkeypatch, seed):
    rng = random.Random(10 + seed)
    rows = lines_between(rng, 150) + [(5000 + i, t + passages(rng, 3)) for i, (_, t) in enumerate(lines_between(rng, 150, "Printed in two colours on paper made of rags."))]
    docs = pa.RecordBatch.from_pydict({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows]})
    verdicts = []
    for size in (1, 2000, 1 << 18):
        monkeypatch.setattr(substrings, "COMPARE_BYTES", size)
        u = substrings.Units(docs["text"])
        data = np.concatenate([u.data[a:b + 50] for a, b in zip(u.first, u.last)])
        doc = np.asarray(docs["doc_id"], np.int64)[u.text]
        head = substrings._pack(substrings._UNIT, (u.key, 5), (u.id, 8), (doc.view(np.uint64), 8), ((u.anchor - u.first).astype(np.uint64), 1),
                                ((u.last + 50 - u.first).astype(np.uint64), 1))
        blob = head[:1] + len(doc).to_bytes(4, "little") + head[1:] + data.tobytes()
        out = substrings._compare(1)(pa.table({"bucket": pa.array([0], pa.int32()), "blob": pa.array([blob], pa.binary())}))
        told = [x for b in out["blob"].to_pylist() for x in zip(*(c.tolist() for c in substrings._unpack(b, 8, 8, 4)))]
        verdicts.append(sorted(told))
    assert verdicts[0] and verdicts[0] == verdicts[1] == verdicts[2]
