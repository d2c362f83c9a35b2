import random
import re

import numpy as np
import pyarrow as pa
import pytest

from adjudika.llm import minhash
from adjudika.llm.queries import QUERIES


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_force(rows):
    """Per row: doc_id, set size, component; links from all pairs that share a shingle."""
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = {}
    for k, (i, s) in enumerate(sets):
        if i is not None:
            for x in s:
                holders.setdefault(x, []).append(k)
    for a, b in {(a, b) for held in holders.values() for a in held for b in held if a < b}:
        (i, s), (j, t) = sets[a], sets[b]
        if 100 * len(s & t) >= 75 * len(s | t):
            x, y = find(i), find(j)
            root[max(x, y)] = min(x, y)
    return sorted(((i is not None, i or 0, len(s), -1 if i is None else find(i), True if i is None else find(i) == i) for i, s in sets))


def result(df):
    return sorted((r.doc_id is not None, r.doc_id or 0, r.n_shingles, -1 if r.component_id is None else r.component_id, r.kept) for r in df.collect())


def test_against_all_pairs(spark, docs_of):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(4000)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(5, 120))] for _ in range(40)]
    rows, i = [], 0
    for words in base:
        for _ in range(rng.randint(1, 6)):
            copy = list(words)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((i, " \t\n".join(copy).upper() if rng.random() < 0.3 else "  ".join(copy)))
            i += 1
    drift = [rng.choice(vocabulary) for _ in range(200)]  # a chain: only neighbours are linked
    for k in range(30):
        drift[6 * k] = f"new{k}"
        rows.append((i + 7 * (k * 11 % 30), " ".join(drift)))
    rows += [(9000, None), (9001, ""), (9002, "  \n"), (9003, "one two"), (9004, "ONE two"), (9005, "two one"), (None, rows[0][1]), (None, None),
             (3, rows[3][1]), (3, rows[3][1]), (9006, "é É é É"), (9007, "É é é é"), (9008, "x" * 3000), (9009, "X" * 3000)]
    rng.shuffle(rows)
    assert result(minhash.near_duplicates(docs_of(rows))) == brute_force(rows)


def test_one_large_group_and_a_common_line(spark, docs_of):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(words[:k] + [f"e{i}"] + words[k:])) for i in range(300) for k in [rng.randrange(60)]]
    rows += [(1000 + i, "all rights are reserved by the authors " + " ".join(f"v{rng.randrange(10**6)}" for _ in range(40))) for i in range(300)]
    assert result(minhash.near_duplicates(docs_of(rows))) == brute_force(rows)


def test_empty_table_and_columns(spark, docs_of):
    docs = docs_of([(1, "a b c d e f"), (2, "A b c d e f"), (3, None)])
    assert minhash.near_duplicates(docs.limit(0)).count() == 0
    kept = minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]


@pytest.mark.parametrize("n", [1, 3, 40, 2000])
def test_sketches_fill_and_estimate(n):
    rng = np.random.default_rng(n)
    a = rng.integers(0, 2**64, n, dtype=np.uint64)
    b = np.concatenate([a[:n - n // 4], rng.integers(0, 2**64, n // 4, dtype=np.uint64)])
    made = minhash.sketches(np.concatenate([a, b]), np.repeat([0, 1], n), 3, 1024)
    assert (made[:2] != 2**64 - 1).all() and (made[2] == 2**64 - 1).all()
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((made[0] == made[1]).mean() - true) < 0.07


def test_components_of_paths_and_cycles(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 103), (103, 101), (101, 102), (102, 100), (7, 7)]
    got = {r.node: r.root for r in minhash.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 104)}}


def test_query_on_the_small_table(spark):
    path = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    assert result(QUERIES["op4_minhash_near_dedup"](spark, path)) == brute_force(rows)


def test_short_texts_are_one_shingle():
    hashes, owner = minhash.shingle_sets(pa.array(["a b", "a  B", "a b c d e", None, "a a a a a a a"]))
    assert owner.tolist() == [0, 1, 2, 4] and hashes[0] == hashes[1] != hashes[2]
