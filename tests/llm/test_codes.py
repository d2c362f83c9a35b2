"""Vector codes: limbs against Python integers, the whole operator against a plain k-means over exact integers."""

import hashlib
import math

import numpy as np
import pytest

from adjudika.llm import codes

SCHEMA = "vec_id bigint, embedding array<float>, label int, code int, part string"


def plain(rows):
    """The contract read word by word, in Python integers."""
    kept = [(i, [math.floor(4096 * x) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    size = len(kept[0][1]) // 8
    cut = lambda v, p: v[p * size:(p + 1) * size]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:16]
    books = [[cut(r[1], p) for r in first] for p in range(8)]

    def assign(v, p):
        d = [sum((a - b) ** 2 for a, b in zip(cut(v, p), c)) for c in books[p]]
        return d.index(min(d)), min(d)

    for _ in range(6):
        for p in range(8):
            held = [[] for _ in books[p]]
            for _, v, _ in kept:
                held[assign(v, p)[0]].append(cut(v, p))
            books[p] = [[sum(c) // len(h) for c in zip(*h)] if h else old for h, old in zip(held, books[p])]
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    out, sums = [], {}
    for i, v, label in kept:
        found = [assign(v, p) for p in range(8)]
        out.append([i, "".join(f"{e:02x}" for e, _ in found), sum(d for _, d in found), label])
        sums[label] = sums.get(label, 0) + out[-1][2]
    return sorted([(i, c, e, sums[label], sha) for i, c, e, label in out], key=repr)


def run(spark, rows, parts=3, schema=SCHEMA):
    table = spark.createDataFrame([(i, v, label, 7, "x") for i, v, label in rows], schema).repartition(parts)
    got = codes.digests(table)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted([tuple(r) for r in got.collect()], key=repr)


def test_limbs_are_exact():
    rng = np.random.default_rng(3)
    for most in (1, 1 << 10, 1 << 11, 1 << 27, 1 << 29):
        x, c = rng.integers(-most, most + 1, (50, 8)), rng.integers(-most, most + 1, (16, 8))
        x[0], c[0] = -most, most
        made = codes.limbs(x)
        assert all(0 <= m.min() and m.max() < 1 << codes.LIMB_BITS for m in made[:-1])
        assert (sum(m.astype(np.int64) << (codes.LIMB_BITS * k) for k, m in enumerate(made)) == x).all()
        want = [[sum(int(a) * int(b) for a, b in zip(r, e)) for e in c] for r in x]
        assert codes.exact_products(x, c).tolist() == want


def test_distances_leave_53_bits_and_ties_go_first():
    book = np.zeros((1, 3, 2), np.int64)
    book[0] = [[1 << 29, 0], [1 << 29, 0], [1 << 29, 1]]
    code, error = codes.nearest(np.array([[-(1 << 29), 1], [1 << 29, 0]]), book)
    assert code.tolist() == [[2], [0]] and error.tolist() == [[1 << 60], [0]]
    with pytest.raises(OverflowError):
        codes.nearest(np.array([[1 << 31, 0]]), book)


def test_equals_plain(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(0, 0.3, 16)], [None, 1, 2][i % 3]) for i in rng.permutation(120)]
    rows += [rows[0]] * 40  # repeated rows
    rows += [(500, None, 1), (501, [None] * 16, 1), (502, [float("nan")] * 16, 2), (503, [float("-inf")] + [0.0] * 15, 2), (None, rows[3][1], 5)]
    assert run(spark, rows) == plain(rows)
    assert run(spark, rows, 7) == plain(rows)


def test_large_components(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(0, 2e4, 8)], i % 2) for i in range(60)]
    assert run(spark, rows, schema=SCHEMA.replace("float", "double")) == plain(rows)


def test_few_equal_and_no_rows(spark):
    rows = [(i, [0.5] * 8, None) for i in range(5)]
    assert run(spark, rows) == plain(rows)
    assert run(spark, []) == []
    assert run(spark, [(1, None, 1)]) == []


def test_many_labels_take_the_shuffled_way(spark):
    rows = [(i, "00", 10 + i, None if i < 3 else i % 4) for i in range(40)]
    coded = spark.createDataFrame(rows, "vec_id bigint, code string, error bigint, label int")
    few, many = (sorted(map(tuple, codes.with_label_errors(coded, n).collect()), key=repr) for n in (100, 2))
    assert few == many and len(few) == 40 and all(r[4] is not None for r in few)


def test_decode(spark):
    rows = [(i, [float((i * 7 + k) % 5) for k in range(16)], 0) for i in range(30)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    books = codes.fit(vectors)
    for r in codes.decode(codes.encode(vectors, books), books).collect():
        whole = [math.floor(4096 * x) for x in r.embedding]
        assert sum((a - b) ** 2 for a, b in zip(whole, r.approximation)) == r.error


def test_mixed_lengths_raise(spark):
    with pytest.raises(ValueError):
        run(spark, [(1, [0.0] * 8, 0), (2, [0.0] * 16, 0)])
    with pytest.raises(ValueError):
        run(spark, [(1, [0.0] * 9, 0)])
