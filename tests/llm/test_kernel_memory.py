"""The pipeline's kernels hold a bounded part of a batch at once, however large Spark's batch is."""

import random
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from adjudika.llm import minhash, pieces, quality_model, textarrays
from adjudika.llm.textarrays import slices

MOST = 60 << 20


@pytest.fixture(scope="module")
def batch():
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(3_000)]
    texts = [" ".join(rng.choices(words, k=600)) for _ in range(512)]
    return pa.RecordBatch.from_pydict({"doc_id": pa.array(range(512), pa.int64()), "text": texts})


def peak(run) -> int:
    textarrays._POWERS.clear()
    tracemalloc.start()
    try:
        run()
        most = tracemalloc.get_traced_memory()[1]
        return most
    finally:
        tracemalloc.stop()


def test_sketches(batch):
    assert batch.column("text").nbytes > 3 << 19
    assert peak(lambda: [None for _ in minhash._sketch(iter([batch]))]) < MOST


def test_quality_scores(batch, spark):
    model = quality_model.Model(*(np.zeros(quality_model.DIMENSIONS) for _ in range(2)), 0.0, 1.0, 0.0)
    made = {}

    class Docs:  # takes with_scores' kernel out of its plan
        sparkSession, schema = spark, spark.createDataFrame([], "doc_id bigint, text string").schema

        def drop(self, _):
            return self

        def mapInArrow(self, kernel, _):
            made["kernel"] = kernel

    quality_model.with_scores(Docs(), model)
    assert peak(lambda: [None for _ in made["kernel"](iter([batch]))]) < MOST


def test_powers_follow_the_texts():
    textarrays._POWERS.clear()
    textarrays.SpanHasher(np.zeros(1_000, np.uint8))
    assert sum(a.nbytes + b.nbytes for a, b in textarrays._POWERS.values()) <= 32 << 10
    textarrays._POWERS.clear()


@pytest.mark.parametrize("limit", [1, 40_000, 1 << 19, textarrays.SLICE_BYTES])
def test_slices_change_no_result(batch, limit):
    model = pieces.load(public_tokenizers.path("piece_bpe_32k.model"))
    few = batch.slice(0, 40)
    whole_ids, whole_n = pieces.encode_texts(model, few.column("text"))
    parts = [pieces.encode_texts(model, s.column("text")) for s in slices([few], limit=limit)]
    assert np.array_equal(np.concatenate([p[0] for p in parts]), whole_ids) and np.array_equal(np.concatenate([p[1] for p in parts]), whole_n)
