"""Toxicity: gradients by finite differences, windows scored one by one, long texts, edge rows and held-out accuracy."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from adjudika.llm import toxicity as X

SF_DIR = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def fitted():
    """A small model that knows one bad stem in many inflections."""
    rng = np.random.default_rng(0)
    words = ["".join(rng.choice(list("abcdeghilmnoprst"), rng.integers(2, 9))) for _ in range(400)]
    texts, bad = [], []
    for k in range(260):
        text = [words[i] for i in rng.integers(0, 400, rng.integers(10, 200))]
        if k % 3 == 0:
            for at in rng.integers(0, len(text), 1 + len(text) // 40):
                text[at] = "zuvq" + words[rng.integers(0, 400)][:4]
        texts.append(" ".join(text))
        bad.append(k % 3 == 0)
    codes = [np.frombuffer(c, np.uint8).reshape(-1, X.WINDOW, X.TOKEN_BYTES) for c in X.sampled_windows(pa.array(texts))]
    return X.fit(codes, np.array(bad), 0.3, epochs=8), texts, np.array(bad)


def test_gradients():
    rng = np.random.default_rng(0)
    weights = {k: v.astype(np.float64) for k, v in X.new_weights(1).items()}
    codes = np.full((10, X.TOKEN_BYTES), X.PAD)
    for i in range(10):
        codes[i, :rng.integers(1, 9)] = rng.integers(97, 123)
    buckets, index = rng.integers(0, 1 << X.WORD_BITS, 10), rng.integers(0, 10, (4, X.WINDOW))
    index[2, 20:] = 10  # padding
    target, cost, dropped = np.array([1, 0, 1, 0], bool), np.array([1.0, 2, 1, 1]), (np.arange(10) % 2 * 2.0)[:, None]

    def loss():
        return X.loss_and_gradients(weights, codes, buckets, index, target, cost, dropped)

    _, grads = loss()
    for name, weight in weights.items():
        flat = weight.ravel()
        for p in np.argsort(-np.abs(grads[name].ravel()))[:3]:
            old = flat[p]
            flat[p] = old + 1e-2
            above = loss()[0]
            flat[p] = old - 1e-2
            below = loss()[0]
            flat[p] = old
            assert abs((above - below) / 2e-2 - grads[name].ravel()[p]) < 1e-5 + 1e-3 * abs(grads[name].ravel()[p]), name


def plain_margin(weights, words):
    """One window, step by step, by the equations of the unit."""
    sig = lambda x: 1 / (1 + np.exp(-x))

    def both(inputs, u):
        out = []
        for d, seq in ((0, inputs[0]), (1, inputs[1][::-1])):
            h, held, size = np.zeros(u.shape[1]), [], u.shape[1]
            for x in seq:
                g = h @ u[d]
                r, z = sig(x[:size] + g[:size]), sig(x[size:2 * size] + g[size:2 * size])
                n = np.tanh(x[2 * size:] + r * g[2 * size:])
                h = (1 - z) * n + z * h
                held.append(h)
            out.append(held if d == 0 else held[::-1])
        return np.concatenate(out, 1)

    def pooled(h, w, v):
        a = np.exp(np.tanh(h @ w) @ v)
        return (a[:, None] * h).sum(0) / a.sum()

    vectors = []
    for word in words:
        chars = np.frombuffer(word, np.uint8)
        h = both(weights["char_in"][:, chars], weights["char_u"])
        bucket = int(X.hashed(X.token_matrix(chars, np.array([0]), np.array([len(chars)])))[0] >> np.uint64(64 - X.WORD_BITS))
        vectors.append(np.concatenate([pooled(h, weights["char_w"], weights["char_v"]), weights["embed"][bucket]]))
    inputs = np.array(vectors) @ weights["word_in"] + weights["word_b"]
    h = both(inputs, weights["word_u"])
    return float(pooled(h, weights["word_w"], weights["word_v"]) @ weights["out_w"] + weights["out_b"][0])


def test_scores_equal_windows_one_by_one(fitted):
    model, texts, _ = fitted
    texts = [texts[0], texts[1], "Wörter ÄÖÜ " + "x" * 100 + " 12a!b", texts[4] + " " + texts[3], "one"]
    margin, count, first, last = model.worst(pa.array(texts))
    for k, text in enumerate(texts):
        low = text.encode().lower().replace("Ä".encode(), "ä".encode()).replace("Ö".encode(), "ö".encode()).replace("Ü".encode(), "ü".encode())
        words, at = [], 0
        while at < len(low):  # runs of digits, letters and bytes beyond ASCII, in pieces of 16
            end = at
            while end < len(low) and (low[end] >= 0x80 or chr(low[end]).isalnum()):
                end += 1
            words += [(i, low[i:min(i + 16, end)]) for i in range(at, end, 16)]
            at = end + 1
        begins = [0]
        while begins[-1] + X.WINDOW < len(words):
            begins.append(begins[-1] + X.STRIDE)
        each = [plain_margin(model.weights, [w for _, w in words[b:b + X.WINDOW]]) for b in begins]
        assert count[k] == len(each) and abs(margin[k] - max(each)) < 1e-3
        ends = [words[min(b + X.WINDOW, len(words)) - 1] for b in begins]
        assert (first[k], last[k]) in [(words[b][0], e[0] + len(e[1])) for b, e, m in zip(begins, ends, each) if m > max(each) - 1e-3]


def test_learns_a_stem_from_labels_of_texts(fitted):
    model, texts, bad = fitted
    rng = np.random.default_rng(9)
    score = model.score(model.worst(pa.array(texts))[0])
    assert ((score >= 0.5) == bad).mean() > 0.97
    clean = texts[1].split()
    new = [" ".join(clean[:5] + ["zuvq" + "".join(rng.choice(list("aeiou"), 4))] + clean[5:9]) for _ in range(20)]
    assert (model.score(model.worst(pa.array(new))[0]) > 0.5).mean() > 0.9


def test_long_texts_are_read_to_the_end(fitted):
    model, texts, _ = fitted
    filler = " ".join(texts[k] for k in range(1, 60) if k % 3)
    long = (filler + " ") * (3 * X.SEGMENT_BYTES // len(filler)) + "zuvqab zuvqcd zuvqef " + filler[:300]
    margin, count, first, last = model.worst(pa.array([long, filler]))
    assert first[0] <= long.encode().index(b"zuvqab") < last[0] and margin[0] > margin[1]
    assert count[0] > 3 * X.SEGMENT_BYTES // (10 * X.WINDOW)
    solid = model.worst(pa.array(["q" * (2 * X.SEGMENT_BYTES + 7), None, "", " .,"]))
    assert solid[1][0] > 0 and solid[1][1:].tolist() == [0, 0, 0] and solid[2][1:].tolist() == [-1, -1, -1]


def test_segments_cover_every_byte():
    rng = np.random.default_rng(1)
    data = rng.choice(np.frombuffer(b"ab ", np.uint8), 5_000)
    offsets = np.array([0, 0, 10, 4_000, 5_000])
    a, b, k = X.segments(data, offsets, 100, 20)
    assert (b - a <= 100).all()
    for t in range(4):
        seen = np.zeros(5_001, bool)
        for x, y in zip(a[k == t], b[k == t]):
            seen[x:y] = True
        assert (np.flatnonzero(seen) == np.arange(offsets[t], offsets[t + 1])).all()


def test_edge_rows(spark, docs_of):
    labels = spark.createDataFrame([(None, 1), (1, None), (2, 1), (2, 0), (3, 0), (6, 0), (99, 1)], "doc_id bigint, toxic int")
    docs = docs_of([(1, "a b"), (2, "bad bad words"), (2, "bad again"), (3, "fine words"), (None, "x"), (5, None), (6, ""), (7, "  ")])
    got = X.judge(docs.withColumnRenamed("ids", "score"), labels, 5).collect()
    assert len(got) == 8 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert all(r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5 == 0) for r in got)
    empty = docs.limit(0)
    assert X.judge(empty, labels).collect() == []
    assert {r.score for r in X.judge(docs, labels.limit(0)).collect()} == {0.5}
    scored = X.with_scores(docs, X.train(docs, labels, 5))
    assert scored.columns == [*docs.columns, *X.ADDED] and {r.start for r in scored.collect()} == {2}


def test_held_out_rows_are_not_learnt(spark, docs_of):
    docs = docs_of([(i, f"word{i} other") for i in range(40)])
    held = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5 == 0]
    labels = spark.createDataFrame([(i, int(i in held)) for i in range(40)], "doc_id bigint, toxic int")
    model = X.train(docs, labels)
    assert model.constant  # all toxic labels were held out


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    rows = X.judge(docs.join(labels.select("doc_id"), "doc_id", "left_semi"), labels).filter("held_out").join(labels, "doc_id").collect()
    toxic = np.array([r.toxic == 1 for r in rows])
    score = np.array([r.score for r in rows])
    rank = np.empty(len(score))
    rank[np.argsort(score)] = np.arange(len(score))
    area = (rank[toxic].mean() - (toxic.sum() - 1) / 2) / (~toxic).sum()
    print("area", area, "recall", (score[toxic] >= 0.5).mean(), "clean", (score[~toxic] < 0.5).mean())
    assert area > 0.9 and (score[~toxic] < 0.5).mean() > 0.98
