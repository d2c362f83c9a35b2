import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from adjudika.llm import pieces
from adjudika.llm.queries import QUERIES

FILE = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["Hello,  world!\n\n  it's 1234", "", None, " ", "   a", "a　b \U0001f600\x00z", "été naïve Straße", "▁▁odd ▁", "x" * 200, "the of and " * 300,
         "\nA!! B!!\n", "word.Word" * 60]


@pytest.fixture(scope="module")
def model():
    return pieces.load(FILE)


@pytest.fixture(scope="module")
def library():
    """The same pieces in the library's unigram mode."""
    proto = pytest.importorskip("sentencepiece.sentencepiece_model_pb2").ModelProto()
    proto.ParseFromString(open(FILE, "rb").read())
    proto.trainer_spec.model_type = 1
    return sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())


def total(model, ids):
    return float(pieces._scores(model)[ids].sum())


def whole(model, text):
    """One plain Viterbi over the whole text."""
    if not text:
        return []
    led = pieces.SPACE + text.replace(" ", pieces.SPACE)
    return pieces._ids_of(model, led, 0, len(led), len(led)).tolist()


def random_text(rng, n):
    return "".join(rng.choice("  aeinorst\nthe.,é☃") for _ in range(n))


def test_equals_plain_viterbi_and_library(model, library):
    rng = random.Random(2)
    texts = [t for t in TEXTS if t] + [random_text(rng, rng.randint(1, 200)) for _ in range(150)]
    ids, n = pieces.encode_texts(model, pa.array(texts))
    at = np.append(0, np.cumsum(n))
    for i, t in enumerate(texts):
        got = ids[at[i]:at[i + 1]].tolist()
        assert got == whole(model, t), t
        if len(t) < 100:  # the library adds up in single precision
            assert total(model, got) == pytest.approx(total(model, library.encode(t)), rel=1e-6)
    raw = pieces.decode_ids(model, ids, n)
    assert [r.decode() for r in raw] == [t.replace(pieces.SPACE, " ") for t in texts]


@pytest.mark.parametrize("spaces", [True, False])
def test_chunks_give_the_best_score(model, spaces):
    rng = random.Random(3)
    for _ in range(25):
        text = random_text(rng, rng.randint(60, 400))
        text = pieces.SPACE + (text.replace(" ", pieces.SPACE) if spaces else text.replace(" ", ""))
        at = [*range(0, len(text) - 20, 40), len(text)]
        parts = [(text[a:b + model.longest - 1], b - a) for a, b in zip(at, at[1:])]
        matrices = np.stack([pieces.transfer(model, p, n) for p, n in parts])
        found = pieces.states(matrices)
        assert found[0][0] == 0 and found[-1][1] == 0 and all(a[1] == b[0] for a, b in zip(found, found[1:]))
        ids = np.concatenate([pieces._ids_of(model, p, i, n, n + j) for (p, n), (i, j) in zip(parts, found)])
        assert total(model, ids) == total(model, whole(model, text.replace(pieces.SPACE, " ")[1:]))
        # The product is associative.
        left = matrices[0]
        for m in matrices[1:]:
            left = pieces.product(left, m)
        right = matrices[-1]
        for m in matrices[-2::-1]:
            right = pieces.product(m, right)
        assert np.array_equal(left, right) and left[0, 0] == total(model, ids)


@pytest.mark.parametrize("chunk", [64, 16_384])
def test_round_trip(spark, docs_of, model, chunk):
    rng = random.Random(4)
    rows = list(enumerate(TEXTS)) + [(20, random_text(rng, 900)), (20, random_text(rng, 500)), (20, random_text(rng, 30)), (None, "no id " * 40), (3, TEXTS[9]), (3, TEXTS[9])]
    docs = docs_of(rows)
    encoded = pieces.encode(docs, FILE, chunk).cache()
    key = lambda pairs: sorted((i is not None, i or 0, t) for i, t in pairs)
    assert key((r.doc_id, r.text) for r in pieces.decode(encoded, FILE).collect()) == key((i, (t or "").replace(pieces.SPACE, " ")) for i, t in rows)
    got = key((r.doc_id, total(model, r.ids)) for r in encoded.collect())
    assert got == key((i, total(model, whole(model, t))) for i, t in rows)
    assert max(r.n_chunks for r in encoded.collect()) == (1 if chunk > 5000 else len(TEXTS[9]) // 64 + (len(TEXTS[9]) % 64 >= 32))
    encoded.unpersist()
    assert pieces.encode(docs.limit(0), FILE).count() == 0


def test_query_on_the_small_table(spark, model):
    path = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    got = QUERIES["op2_sentencepiece"](spark, path).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
        if r.n_chunks == 1:
            ids = whole(model, texts[r.doc_id])
            assert (r.n_pieces, r.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_chunks_are_encoded_once(model, monkeypatch):
    """The matrices need the edges of a chunk alone; what lies between is encoded when the chunk is traced."""
    rng = random.Random(5)
    texts = [random_text(rng, n) for n in (70, 200, 431, 1000)] + ["x" * 300, "the of and " * 60]
    whole_states = []
    for text in texts:
        led = pieces.SPACE + text.replace(" ", pieces.SPACE)
        at = [*range(0, len(led) - 32, 64), len(led)]
        whole_states.append(pieces.states(np.stack([pieces.transfer(model, led[a:b + model.longest - 1], b - a) for a, b in zip(at, at[1:])])))

    def never(*_):
        raise AssertionError("encoded while it is split")

    monkeypatch.setattr(pieces, "_encode_units", never)
    monkeypatch.setattr(pieces, "path", never)
    batch = pa.RecordBatch.from_pydict({"uid": pa.array(range(len(texts)), pa.int64()), "text": texts})
    made = [[] for _ in texts]
    for part in pieces._split(FILE, 64)(iter([batch])):
        made[part["uid"][0].as_py()].append(np.frombuffer(part["matrix"][0].as_py(), np.float64).reshape(model.longest, -1))
    assert [pieces.states(np.stack(m)) for m in made] == whole_states
