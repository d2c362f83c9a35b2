import random
import zlib

import numpy as np
import pyarrow as pa

from adjudika.llm import quality_model as M
from adjudika.llm.queries import QUERIES


def test_features_of_small_texts():
    texts = pa.array(["The the cat", "", None, "A!! B!! C!!", "The the cat", " \n "])
    found, owner = M.features(texts)
    per = [found[owner == i].tolist() for i in range(6)]
    assert per[0] == per[4] and per[1] == per[2] == per[5] == [] and per[3] and all(len(p) == len(set(p)) for p in per)
    # two words, "the" once in small letters: 2 words + 2 pairs; shapes Aa, aR, a and their runs
    assert sum(f < 1 << M.WORD_BITS for f in per[0]) == 4
    assert max(found) < M.DIMENSIONS


def test_descent_separates_and_calibrates():
    rng = np.random.default_rng(0)
    rows = [np.unique(np.concatenate([rng.integers(0, 500, 20), [1000 + g]])) for g in [0, 1] * 300]
    good = np.array([False, True] * 300)
    model = M.fit(rows, good, 0.5)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    margin = model.margins(np.concatenate(rows), owner, len(rows))
    assert ((margin * model.slope + model.shift > 0) == good).mean() > 0.98
    one = M.fit(rows, np.ones(600, bool), 0.9)
    assert np.allclose(one.scores(pa.array(["a b", None])), 0.9)


def test_hinge_dual_reaches_the_best_value():
    """Against plain projected gradient steps on the same dual."""
    rng = np.random.default_rng(3)
    rows = [np.unique(rng.integers(0, 12, 5)) for _ in range(40)]
    values = [rng.normal(size=len(r)) for r in rows]
    sign, cost = rng.choice([-1.0, 1.0], 40), np.full(40, 0.7)
    x = np.zeros((40, 13))
    for i, (r, v) in enumerate(zip(rows, values)):
        x[i, r] = v
        x[i, 12] = 1.0
    gram = (x * sign[:, None]) @ (x * sign[:, None]).T
    dual = np.zeros(40)
    for _ in range(20_000):
        dual = np.clip(dual - (gram @ dual - 1) / np.linalg.norm(gram, 2), 0, cost)
    epochs, M.EPOCHS = M.EPOCHS, 400
    try:
        weight, bias = M.descend(rows, values, sign, cost)
    finally:
        M.EPOCHS = epochs
    best = (sign * cost) @ x * 0 + (sign * dual) @ x
    primal = lambda w: 0.5 * w @ w + (cost * np.maximum(0, 1 - sign * (x @ w))).sum()
    assert primal(np.append(weight[:12], bias)) <= primal(best) * 1.02 + 1e-6


def held_out(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 4 == 2


def test_rows_and_cases(spark, docs_of):
    rng = random.Random(1)
    plain = lambda: " ".join(rng.choice(["the", "cat", "sat", "on", "a", "mat."]) for _ in range(60))
    junk = lambda: " ".join(rng.choice(["BUY", "NOW", "X"]) + "!!" for _ in range(60))
    rows = [(i, junk() if i % 3 == 0 else plain()) for i in range(240)] + [(1000, None), (1001, ""), (None, plain()), (5, plain()), (5, plain())]
    docs = docs_of(rows)
    labels = spark.createDataFrame([(i, 0 if i % 3 == 0 else 1, 0) for i in range(240)] + [(None, 1, 0), (1, None, 0), (9999, 0, 1)],
                                   "doc_id bigint, quality int, toxic int")
    got = M.judge(docs, labels).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
        if r.doc_id is not None and r.doc_id < 240 and r.doc_id != 5:
            assert r.predicted == (r.doc_id % 3 != 0)
    assert len({r.score for r in got if r.doc_id in (1000, 1001)}) == 1
    kept = M.accept(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if r.predicted}
    assert M.judge(docs.limit(0), labels).count() == 0
    assert {r.score for r in M.judge(docs, labels.limit(0)).collect()} == {0.5}


def test_held_out_accuracy(spark):
    path = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{path}/labels.parquet").collect()}
    got = [(r.predicted, labels[r.doc_id]) for r in QUERIES["op5_quality_classifier"](spark, path).collect() if r.held_out and r.doc_id in labels]
    bad, good = [p for p, q in got if q == 0], [p for p, q in got if q == 1]
    assert len(bad) > 100 and bad.count(0) > 0.95 * len(bad) and good.count(1) > 0.99 * len(good)
