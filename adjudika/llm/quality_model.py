"""Quality classifier: a linear hinge-loss model on n-gram indicators that are scaled by class log-count ratios.

N-grams are taken over two readings of a text: its words in lower case, and the shapes of its words (runs of capitals, small letters,
digits and each other character, with a mark on a word that equals the one before). A shape n-gram has three indicators:
the text has it, has it at 1/32 of its words, at 1/4 of them. Indicators are hashed to ``DIMENSIONS`` columns.

The model is fitted on a bounded sample of labelled rows: log-count ratios r of the two classes, then dual coordinate descent on the scaled
vectors r * x, then a logistic calibration on rows that the descent did not see. Scoring is one pass over all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from adjudika.llm.textarrays import LOWER, SMALL_SLICE_BYTES, WHITE_SPACE, SpanHasher, bounds, mix, slices, text_bytes, windows, word_spans

WORD_BITS, SHAPE_BITS = 16, 16
#: Shares of a text's words at which a shape n-gram sets one more indicator.
LEVELS = (32, 4)
DIMENSIONS = (1 << WORD_BITS) + (1 + len(LEVELS) << SHAPE_BITS)
#: Labelled rows of each class that the model is fitted on at most, chosen by a hash of their id.
SAMPLE_ROWS = 3_000
SMOOTHING, COST, EPOCHS = 1.0, 1.0, 12
THRESHOLD = 0.7


def _byte_classes() -> np.ndarray:
    """Capitals 2, small letters and all bytes beyond ASCII 1, digits 3, others themselves."""
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B], table[0x61:0x7B], table[0x80:], table[0x30:0x3A] = 2, 1, 1, 3
    return table


_CLASSES = _byte_classes()


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct indicators of all texts, text by text, and their text numbers; a text without words has none."""
    n = len(texts)
    data, offsets = text_bytes(texts)
    starts, ends, owner = word_spans(data, offsets, WHITE_SPACE)
    words = SpanHasher(LOWER[data])(starts, ends)
    n_words = np.diff(bounds(owner, n))

    kinds = _CLASSES[data]
    turn = np.ones(len(kinds), bool)
    turn[1:] = kinds[1:] != kinds[:-1]
    turn[starts] = True
    turn &= ~WHITE_SPACE[data]
    place = np.append(0, np.cumsum(turn))
    shapes = SpanHasher(kinds[turn], seed=2)(place[starts], place[ends])
    again = np.zeros(len(words), np.uint64)
    again[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
    shapes = mix(shapes + again)

    made = []
    for width in (1, 2):
        grams, first = windows(words, owner, width)
        made.append((owner[first].astype(np.uint64) << np.uint64(32)) | (grams >> np.uint64(64 - WORD_BITS)))
    found = np.unique(np.concatenate(made))
    grams = [windows(shapes + np.uint64(width), owner, width) for width in (1, 2, 3)]
    keys = np.concatenate([(owner[first].astype(np.uint64) << np.uint64(32)) | (h >> np.uint64(64 - SHAPE_BITS)) for h, first in grams])
    keys, times = np.unique(keys, return_counts=True)
    size = n_words[(keys >> np.uint64(32)).astype(np.int64)]
    base = np.uint64(1 << WORD_BITS)
    parts = [found, keys + base]
    for k, share in enumerate(LEVELS, 1):
        parts.append(keys[times * share >= size] + base + np.uint64(k << SHAPE_BITS))
    every = np.sort(np.concatenate(parts))
    return (every & np.uint64(0xFFFFFFFF)).astype(np.int64), (every >> np.uint64(32)).astype(np.int64)


@dataclass
class Model:
    """``score = 1 / (1 + exp(-(slope * margin + shift)))``, where the margin is the weighted sum over the length of the scaled vector."""
    ratio: np.ndarray
    weight: np.ndarray
    bias: float
    slope: float
    shift: float

    def margins(self, found: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        scaled = self.ratio[found]
        length = np.sqrt(np.bincount(owner, scaled * scaled, n))
        return np.bincount(owner, scaled * self.weight[found], n) / np.maximum(length, 1e-12) + self.bias

    def scores(self, texts: pa.Array) -> np.ndarray:
        found, owner = features(texts)
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(found, owner, len(texts)) + self.shift, -40, 40)))


def log_count_ratio(rows: list[np.ndarray], good: np.ndarray) -> np.ndarray:
    """log of the two classes' smoothed, normalised indicator counts."""
    counts = []
    for side in (True, False):
        taken = [r for r, g in zip(rows, good) if g == side]
        total = SMOOTHING + np.bincount(np.concatenate(taken) if taken else np.zeros(0, np.int64), minlength=DIMENSIONS)
        counts.append(total / (len(taken) + SMOOTHING))
    return np.log(counts[0] / counts[1])


def _scaled(rows: list[np.ndarray], ratio: np.ndarray) -> list[np.ndarray]:
    """Each row's scaled vector at length 1; all are views of one array."""
    n = np.array([len(r) for r in rows])
    flat = ratio[np.concatenate(rows)]
    length = np.sqrt(np.bincount(np.repeat(np.arange(len(rows)), n), flat * flat, len(rows)))
    flat /= np.repeat(np.maximum(length, 1e-12), n)
    ends = np.cumsum(n)
    return [flat[b - k:b] for b, k in zip(ends.tolist(), n.tolist())]


def descend(rows: list[np.ndarray], values: list[np.ndarray], sign: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss: one dual variable at a time goes to its best value in [0, cost]."""
    weight, bias = np.zeros(DIMENSIONS), 0.0
    dual = np.zeros(len(rows))
    square = np.array([float(v @ v) + 1.0 for v in values])
    rng = np.random.default_rng(0)
    for _ in range(EPOCHS):
        most = 0.0
        for i in rng.permutation(len(rows)):
            slack = sign[i] * (weight[rows[i]] @ values[i] + bias) - 1.0
            new = min(max(dual[i] - slack / square[i], 0.0), cost[i])
            if step := (new - dual[i]) * sign[i]:
                weight[rows[i]] += step * values[i]
                bias += step
                most = max(most, abs(step))
            dual[i] = new
        if most < 1e-3:
            break
    return weight, bias


def calibrate(margin: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve by Newton steps; each class weighs the same, and a little ridge keeps them finite."""
    target = np.where(good, 1 - 1 / (good.sum() + 2), 1 / ((~good).sum() + 2))
    weight = np.where(good, 0.5 / max(1, good.sum()), 0.5 / max(1, (~good).sum())) * len(good)
    x, beta = np.stack([margin, np.ones(len(margin))], 1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -40, 40)))
        gradient = x.T @ (weight * (p - target)) + 1e-3 * beta
        hessian = (x * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def fit(rows: list[np.ndarray], good: np.ndarray, prior: float) -> Model:
    """A model from indicator rows. Every fifth row calibrates only. ``prior``: the share of good rows among all labelled ones.

    With one class only, the score is the prior everywhere.
    """
    if good.all() or not good.any():
        zero = np.zeros(DIMENSIONS)
        return Model(zero, zero, 0.0, 0.0, float(np.log(prior / (1 - prior))))
    held = np.arange(len(rows)) % 5 == 4
    held &= len(rows) >= 50
    train = [r for r, h in zip(rows, held) if not h]
    ratio = log_count_ratio(train, good[~held])
    values = _scaled(train, ratio)
    sign = np.where(good[~held], 1.0, -1.0)
    cost = np.where(good[~held], 1 / max(1, good[~held].sum()), 1 / max(1, (~good[~held]).sum())) * COST * len(train) / 2
    weight, bias = descend(train, values, sign, cost)
    model = Model(ratio, weight, bias, 1.0, 0.0)
    used = held if held.any() else ~held
    chosen = [r for r, u in zip(rows, used) if u]
    owner = np.repeat(np.arange(len(chosen)), [len(r) for r in chosen])
    margin = model.margins(np.concatenate(chosen), owner, len(chosen))
    model.slope, shift = calibrate(margin, good[used])
    model.shift = shift + float(np.log(prior / (1 - prior)))
    return model


def _held_out(column):
    """True on the rows whose labels are never learnt."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on at most ``sample_rows`` rows of each class of ``labels`` (doc_id, quality), chosen by a hash of doc_id among those not held out.

    Null ids and labels are no labels; an id with two labels has the lower one. Labels without a document are not used. No labels: every
    score is 0.5.
    """
    known = (labels.filter("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
             .agg((F.min("quality") > 0).alias("good")).filter(~_held_out(F.col("doc_id"))))
    seen = {r.good: r["count"] for r in known.groupBy("good").count().collect()}
    prior = (seen.get(True, 0) + 1) / (sum(seen.values()) + 2)
    chosen = [known.filter(side).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows) for side in (F.col("good"), ~F.col("good"))]
    ids = chosen[0].union(chosen[1]).collect()  # at most twice sample_rows
    if not ids:
        return fit([], np.zeros(0, bool), 0.5)
    picked = docs.sparkSession.createDataFrame(ids, "_id bigint, good boolean")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=SMALL_SLICE_BYTES):
            found, owner = features(batch.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(bounds(owner, batch.num_rows).astype(np.int32)), pa.array(found.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("good"), lists], names=["_id", "good", "found"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("_id"), "text").join(F.broadcast(picked), "_id").select("_id", "good", "text")
    sample = rows.mapInArrow(read, "_id bigint, good boolean, found array<int>").toArrow().sort_by("_id")
    order = np.argsort(mix(sample["_id"].to_numpy().view(np.uint64)), kind="stable").tolist()
    # Views of one array: the driver keeps no small pieces of memory behind.
    found = sample["found"].combine_chunks()
    flat = found.flatten().to_numpy()
    ends = np.append(0, np.cumsum(found.value_lengths().to_numpy(zero_copy_only=False))).tolist()
    model = fit([flat[ends[i]:ends[i + 1]] for i in order], sample["good"].to_numpy()[order].astype(bool), prior)
    del sample, found, flat
    pa.default_memory_pool().release_unused()
    return model


def with_scores(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with the score as column ``name``: higher is likelier good. Null and empty texts get the model's base score."""
    docs = docs.drop(name)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches, limit=SMALL_SLICE_BYTES):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.scores(batch.column("text")))], names=[*batch.schema.names, name])

    return docs.mapInArrow(score, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def judge(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted (score >= 0.7) of every row of ``docs``."""
    slim = docs.select("doc_id", "text")
    return with_scores(slim, train(slim, labels, sample_rows)).select(
        "doc_id", _held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def accept(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` with a score of at least 0.7, with their columns."""
    return with_scores(docs, train(docs, labels, sample_rows), "_score").filter(F.col("_score") >= THRESHOLD).drop("_score")
