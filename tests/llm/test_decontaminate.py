import hashlib
import random
import re
import tracemalloc

import pyarrow as pa

from adjudika.llm import decontaminate
from adjudika.llm.queries import QUERIES


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute_force(docs, items):
    held = {}
    for item, text in items:
        ws = words_of(text)
        for i in range(max(1, len(ws) - 9)):
            if ws and item is not None:
                held.setdefault(tuple(ws[i:i + 10]), set()).add(str(item))
    out = []
    for i, text in docs:
        ws, hit, found = words_of(text), set(), set()
        for n in {len(w) for w in held}:
            for k in range(len(ws) - n + 1):
                if (w := tuple(ws[k:k + n])) in held:
                    hit |= set(range(k, k + n))
                    found |= held[w]
        out.append((i if i is not None else -1, len(ws), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def result(df):
    return sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect())


def fixture():
    rng = random.Random(3)
    vocabulary = ["the", "of", "a"] * 4 + [f"w{i}" for i in range(60)] + ["é", "Straße", "x1"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 30)))) for i in range(40)]
    items += [(40, None), (41, "!!!"), (42, "short item"), (43, "a"), (None, "ignored item text"), (7, items[9][1]), (44, items[9][1]), (45, "the the the the the the the the the the the")]
    docs = []
    for i in range(120):
        text = " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 80)))
        for _ in range(rng.randint(0, 3)):
            ws = words_of(rng.choice(items)[1])
            k = rng.randint(0, max(0, len(ws) - 10))
            text += rng.choice([" ", "... ", "\n"]) + rng.choice([" ", "--", " (", ".\n"]).join(ws[k:k + rng.randint(8, 14)]).upper()
        docs.append((i, text))
    return docs + [(500, None), (501, ""), (None, items[0][1]), (3, docs[3][1]), (3, docs[3][1]), (502, "y" * 20000 + " " + items[1][1])], items


def tables(spark, docs_of, docs, items):
    return docs_of(docs), spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, doc_id string")


def test_against_brute_force(spark, docs_of):
    docs, items = fixture()
    assert result(decontaminate.digests(*tables(spark, docs_of, docs, items))) == brute_force(docs, items)


def test_many_blocks_give_the_same(spark, docs_of, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", 150)
    docs, items = fixture()
    assert result(decontaminate.digests(*tables(spark, docs_of, docs, items))) == brute_force(docs, items)


def test_segments_and_slices_lose_nothing(spark, docs_of, monkeypatch):
    docs, items = fixture()
    docs = [(i, t) for i, t in docs if t is None or len(t) < 1000][:60]
    long = " ".join(t for _, t in docs if t)
    docs += [(900, long), (901, "x" * 3000 + " " + long), (902, "the " * 300), (903, "..." * 400)]
    texts = pa.array([t for _, t in docs])
    rows = sorted({tuple(ws[k:k + 10]) for _, t in items for ws in [words_of(t)] for k in range(max(1, len(ws) - 9)) if ws})
    counts = {int(h): sum(words_of(t).count(w) for _, t in docs) for w in {w for r in rows for w in r} for h in decontaminate._word_hash([w])}
    index = decontaminate.Index([(list(r), k) for k, r in enumerate(rows)], [[str(k)] for k in range(len(rows))], counts)

    def matched():
        n, found = index.match(texts)
        return n.tolist(), {d: (a.tolist(), b.tolist(), c.tolist()) for d, (a, b, c) in found.items()}

    whole = matched()
    assert whole[0] == [len(words_of(t)) for _, t in docs] and whole[1]
    for segment, slice_ in ((64, 1 << 18), (300, 3), (1 << 20, 50)):
        monkeypatch.setattr(decontaminate, "SEGMENT_BYTES", segment)
        monkeypatch.setattr(decontaminate, "CANDIDATES", slice_)
        assert matched() == whole
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 4_000)
    assert result(decontaminate.digests(*tables(spark, docs_of, docs, items))) == brute_force(docs, items)


def test_memory_does_not_follow_repeated_words_or_long_texts():
    # 2 500 windows with one rarest word, and a text that repeats it; a text of one word of 30 MB in all.
    rows = [(["rare", *(f"w{k}x{j}" for j in range(9))], 0) for k in range(2_500)] + [(["same"] * 10, 1)]
    counts = {int(h): 5 for ws, _ in rows for h in decontaminate._word_hash(ws)}
    counts[int(decontaminate._word_hash(["rare"])[0])] = 1
    index = decontaminate.Index(rows, [["1"], ["2"]], counts)
    for text, hits in (("rare " * 28_000, 0), ("same " * 6_000_000, 6_000_000)):
        texts = pa.array([text])
        tracemalloc.start()
        n, found = index.match(texts)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 250 << 20, peak
        assert n.tolist() == [len(text) // 5] and sum(int((b - a).sum()) for a, b, _ in found.values()) == hits


def test_an_item_list_shared_by_all_windows_is_held_once(spark, docs_of):
    preamble = " ".join(f"p{k}" for k in range(60))
    items = [(i, f"{preamble} own{i}") for i in range(300)]
    docs = [(1, preamble), (2, "nothing here"), (3, preamble + " own7")]
    d, b = tables(spark, docs_of, docs, items)
    made = list(decontaminate.blocks(b, d))
    assert len(made) == 1 and len(made[0].sets) == 301
    assert result(decontaminate.digests(d, b)) == brute_force(docs, items)


def test_clean_and_empty_tables(spark, docs_of):
    docs, items = fixture()
    d, b = tables(spark, docs_of, docs, items)
    cleaned = decontaminate.clean(d, b)
    assert cleaned.columns == d.columns
    want = sorted(x[0] for x in brute_force(docs, items) if not x[5])
    assert sorted(r.doc_id if r.doc_id is not None else -1 for r in cleaned.collect()) == want
    assert decontaminate.digests(d.limit(0), b).count() == 0
    assert not any(r.contaminated for r in decontaminate.digests(d, b.limit(0)).collect())


def test_query_on_the_small_table(spark):
    path = "/root/testdata/sf0.01"
    read = lambda name, key: [(r[key], r.text) for r in spark.read.parquet(f"{path}/{name}.parquet").collect()]
    got = result(QUERIES["op7_benchmark_decontamination"](spark, path))
    assert got == brute_force(read("documents", "doc_id"), read("benchmark", "item_id")) and any(r[5] for r in got)
