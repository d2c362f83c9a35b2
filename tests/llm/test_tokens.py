import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from adjudika.llm import tokens

FILE = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(FILE)
TEXTS = ["Hello,  World!\n\tit's   1234 café Été", "", None, "   ", "　wide space   end", "<|endoftext|> a<|startoftext|>b",
         "\U0001f600‍ zero\x00byte \x1c\x1d", "word " * 30000, "x" * 5000]


def expected(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids + [1]


@pytest.mark.parametrize("bits", [False, True])
def test_table_equals_whole_text_encoding(spark, docs_of, tmp_path, bits):
    rows = [(7 * i % 23, t) for i, t in enumerate(TEXTS * 2)] + [(None, "no id"), (3, "same id"), (3, "same id"), (3, "other text")]
    path = str(tmp_path / "t")
    tokens.write_tokens(docs_of(rows), path, FILE, 1, bits=bits)
    got = tokens.read_tokens(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted([i for i, _ in rows], key=lambda i: (i is not None, i))
    want = sorted((i is not None, i or 0, expected(t)) for i, t in rows)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.ids) for r in got) == want
    start = 0
    for r in got:
        assert (r.start, r.n_tokens) == (start, len(r.ids))
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        start += r.n_tokens


def test_empty_table(spark, docs_of, tmp_path):
    path = str(tmp_path / "t")
    tokens.write_tokens(docs_of([(1, "a")]).limit(0), path, FILE, 1)
    assert tokens.read_tokens(spark, path).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_words_give_the_ids_of_whole_texts(texts):
    import pyarrow as pa

    ids, n = tokens.encode_texts(pa.array(texts, pa.string()), tokens.word_encoder(FILE), 1)
    assert ids.tolist() == [i for t in texts for i in expected(t)]
    assert n.tolist() == [len(expected(t)) for t in texts]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 2**24 - 1), max_size=300), st.booleans())
def test_planes_round_trip(ids, bits):
    assert tokens.from_planes(tokens.to_planes(np.array(ids, np.int64), 3, bits), len(ids), 3, bits).tolist() == ids
