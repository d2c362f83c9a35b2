"""Toxicity: a bidirectional gated recurrent network with attention pooling over character and word inputs, in numpy.

A token is a word in lower case, or 16 bytes of a longer one. Its input joins two readings: the states of a small bidirectional network over
its bytes, pooled by attention, and an embedding of the whole word by hash. A second bidirectional network runs over windows of ``WINDOW``
tokens, one every ``STRIDE`` tokens, so that windows overlap; its states are pooled by attention into one margin per window. All windows of
the whole text are scored; a document's margin is that of its worst window, and a logistic curve makes it a score.

Training knows labels of documents only: in each step the worst window of every document of the batch is found and learnt (multiple
instances). Rows of the sample that no step saw set the logistic curve.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from adjudika.llm.textarrays import LOWER, NOT_ALNUM, SpanHasher, bounds, mix, runs, slices, text_bytes

#: Tokens of a window and between the starts of two windows; bytes of a token.
WINDOW, STRIDE, TOKEN_BYTES = 48, 32, 16
#: States of one direction over bytes and over words; width of a word's embedding and of both attentions.
CHAR_STATES, WORD_STATES, EMBEDDING, ATTENTION = 8, 12, 8, 8
WORD_BITS = 13
#: Labelled rows of each class that the model is fitted on at most, and windows of one of them, both chosen by hashes.
SAMPLE_ROWS, SAMPLE_WINDOWS = 2_000, 32
#: Passes over the sample at least, and steps: a small sample is passed more often.
EPOCHS, STEPS, BATCH, RATE = 6, 500, 32, 0.01
#: In the first half of the epochs, so many windows of a document are drawn; later ones learn its worst.
FIRST_WINDOWS = 4
#: Share of word embeddings that a training step leaves out.
DROPPED = 0.5
THRESHOLD = 0.5
#: A longer text is read in overlapping segments of this many bytes.
SEGMENT_BYTES, OVERLAP_BYTES = 1 << 20, 1 << 10
#: Windows, and tokens, that run through a network at once.
LANES = 1_024
#: Slots of a worker's table of token inputs it has met.
KNOWN_BITS = 17

PAD = 255
_KEEP = 40.0  # an update gate so far open keeps the state as it is: padding


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x = np.tanh(x * np.float32(0.5))
    x *= np.float32(0.5)
    x += np.float32(0.5)
    return x


def lowered(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with A-Z and the capitals of Latin-1 in lower case."""
    out = LOWER[data]
    accent = np.flatnonzero((data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)) + 1
    out[accent] += 0x20
    return out


def segments(data: np.ndarray, offsets: np.ndarray, size: int = SEGMENT_BYTES, overlap: int = OVERLAP_BYTES):
    """Start, end and text number of pieces of at most ``size`` bytes; they begin after a separator if one is within the overlap."""
    made = []
    for k, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        start = a
        while b - start > size:
            end = start + size
            made.append((start, end, k))
            apart = np.flatnonzero(NOT_ALNUM[data[end - overlap:end]])
            start = end - overlap + (int(apart[0]) + 1 if len(apart) else 0)
        made.append((start, b, k))
    return tuple(np.array(x, np.int64) for x in zip(*made)) if made else (np.zeros(0, np.int64),) * 3


def tokens(data: np.ndarray, offsets: np.ndarray):
    """Start, end and text number of all tokens of lowered bytes."""
    starts, ends, owner = runs(~NOT_ALNUM[data], offsets)
    pieces = -(-(ends - starts) // TOKEN_BYTES)
    if len(pieces) and pieces.max() > 1:
        within = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts = np.repeat(starts, pieces) + within * TOKEN_BYTES
        ends = np.minimum(starts + TOKEN_BYTES, np.repeat(ends, pieces))
        owner = np.repeat(owner, pieces)
    return starts, ends, owner


def window_starts(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First token (within its text) and text number of every window; the last window of a text reaches its end."""
    n = np.where(counts > 0, 1 + np.maximum(0, -(-(counts - WINDOW) // STRIDE)), 0)
    owner = np.repeat(np.arange(len(counts)), n)
    return (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * STRIDE, owner


def token_matrix(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The tokens' bytes as rows of ``TOKEN_BYTES`` codes; ``PAD``, which is no byte of UTF-8, fills up."""
    at = starts[:, None] + np.arange(TOKEN_BYTES)
    inside = at < ends[:, None]
    codes = data[np.minimum(at, len(data) - 1)]
    codes[~inside] = PAD
    return codes


# Networks. Both directions run side by side: arrays are (step, direction, lane, ...), and direction 1 reads its steps backwards.

def run_gates(x: np.ndarray, u: np.ndarray, keep: bool = False):
    """States (steps + 1, 2, lanes, H) of gated units for inputs (steps, 2, lanes, 3H); with ``keep``, what the way back needs too."""
    steps, _, lanes, width = x.shape
    size = width // 3
    states = np.zeros((steps + 1, 2, lanes, size), np.float32)
    kept = []
    for t in range(steps):
        before = states[t]
        g = before @ u
        rz = _sigmoid(x[t, ..., :2 * size] + g[..., :2 * size])
        r, z = rz[..., :size], rz[..., size:]
        n = np.tanh(x[t, ..., 2 * size:] + r * g[..., 2 * size:])
        np.add(n, z * (before - n), out=states[t + 1])
        if keep:
            kept.append((r, z, n, g[..., 2 * size:]))
    return states, kept


def gates_back(states: np.ndarray, kept, u: np.ndarray, grads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the inputs and of ``u`` for gradients (steps, 2, lanes, H) of the states."""
    steps, _, lanes, size = grads.shape
    dx = np.zeros((steps, 2, lanes, 3 * size), np.float32)
    du, dh = np.zeros_like(u), np.zeros((2, lanes, size), np.float32)
    for t in range(steps - 1, -1, -1):
        r, z, n, gn = kept[t]
        before = states[t]
        dh = dh + grads[t]
        dn = dh * (1 - z) * (1 - n * n)
        dz = dh * (before - n) * z * (1 - z)
        dr = dn * gn * r * (1 - r)
        dx[t] = np.concatenate([dr, dz, dn], -1)
        dg = np.concatenate([dr, dz, dn * r], -1)
        du += before.transpose(0, 2, 1) @ dg
        dh = dh * z + dg @ u.transpose(0, 2, 1)
    return dx, du


def both_ways(states: np.ndarray) -> np.ndarray:
    """(steps, lanes, 2H): the states of both directions at the same place."""
    return np.concatenate([states[1:, 0], states[:0:-1, 1]], -1)


def ways_back(grads: np.ndarray) -> np.ndarray:
    size = grads.shape[-1] // 2
    return np.stack([grads[..., :size], grads[::-1, :, size:]], 1)


def attend(h: np.ndarray, mask: np.ndarray, w: np.ndarray, v: np.ndarray):
    """Attention pooling over the steps: pooled (lanes, 2H), weights, and the inner layer."""
    inner = np.tanh(h @ w)
    logit = np.where(mask, inner @ v, np.float32(-1e9))
    logit -= logit.max(0)
    weight = np.exp(logit)
    weight /= weight.sum(0)
    return np.einsum("tb,tbh->bh", weight, h), weight, inner


def attend_back(h, weight, inner, pooled, w, v, grad):
    """Gradients of h, w and v for the gradient of the pooled states."""
    dh = weight[..., None] * grad[None]
    dlogit = weight * ((h * grad[None]).sum(-1) - (pooled * grad).sum(-1)[None])
    da = dlogit[..., None] * v * (1 - inner * inner)
    dh += da @ w.T
    return dh, np.einsum("tbh,tba->ha", h, da), np.einsum("tb,tba->a", dlogit, inner)


def new_weights(seed: int = 0) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    c, h, e, a = CHAR_STATES, WORD_STATES, EMBEDDING, ATTENTION

    def made(*shape, scale):
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    return {
        "char_in": made(2, PAD, 3 * c, scale=0.5), "char_u": made(2, c, 3 * c, scale=c ** -0.5),
        "char_w": made(2 * c, a, scale=(2 * c) ** -0.5), "char_v": made(a, scale=a ** -0.5),
        "embed": made(1 << WORD_BITS, e, scale=0.05),
        "word_in": made(2, 2 * c + e, 3 * h, scale=(2 * c + e) ** -0.5), "word_b": np.zeros((2, 1, 3 * h), np.float32),
        "word_u": made(2, h, 3 * h, scale=h ** -0.5), "word_w": made(2 * h, a, scale=(2 * h) ** -0.5), "word_v": made(a, scale=a ** -0.5),
        "out_w": made(2 * h, scale=(2 * h) ** -0.5), "out_b": np.zeros(1, np.float32),
    }


def _padded_table(rows: np.ndarray, size: int) -> np.ndarray:
    """(2, n + 1, 3H): one more row that keeps the state."""
    pad = np.zeros((2, 1, 3 * size), np.float32)
    pad[..., size:2 * size] = _KEEP
    return np.concatenate([rows, pad], 1)


def _gathered(table: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Inputs (steps, 2, lanes, 3H) for indices (lanes, steps)."""
    return np.stack([table[0][index.T], table[1][index.T[::-1]]], 1)


def char_vectors(weights, codes: np.ndarray) -> np.ndarray:
    """Pooled byte states (tokens, 2C) of token rows."""
    table = _padded_table(weights["char_in"], CHAR_STATES)
    out = np.zeros((len(codes), 2 * CHAR_STATES), np.float32)
    length = (codes != PAD).sum(1)
    order = np.argsort(length, kind="stable")
    for i in range(0, len(order), 4 * LANES):
        at = order[i:i + 4 * LANES]
        part = codes[at, :max(1, int(length[at[-1]]))]
        states, _ = run_gates(_gathered(table, part), weights["char_u"])
        out[at], _, _ = attend(both_ways(states), part.T != PAD, weights["char_w"], weights["char_v"])
    return out


def word_inputs(weights, vectors: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """The table of word inputs (2, tokens + 1, 3H) with the row that pads."""
    joined = np.concatenate([vectors, weights["embed"][buckets]], 1)
    return _padded_table(joined @ weights["word_in"] + weights["word_b"], WORD_STATES)


def margins(weights, table: np.ndarray, index: np.ndarray) -> np.ndarray:
    """One margin per window; ``index`` (windows, WINDOW) names rows of ``table``, the last of which pads."""
    out = np.zeros(len(index), np.float32)
    pad = table.shape[1] - 1
    for i in range(0, len(index), LANES):
        part = index[i:i + LANES]
        states, _ = run_gates(_gathered(table, part), weights["word_u"])
        pooled, _, _ = attend(both_ways(states), part.T != pad, weights["word_w"], weights["word_v"])
        out[i:i + LANES] = pooled @ weights["out_w"] + weights["out_b"]
    return out


def loss_and_gradients(weights, codes: np.ndarray, buckets: np.ndarray, index: np.ndarray, target: np.ndarray, cost: np.ndarray, dropped=1.0):
    """Weighted mean logistic loss of windows over token rows, and the gradients of all weights.

    ``dropped``: factors of the word embeddings of the tokens, 0 where training leaves one out so that the bytes have to do.
    """
    w, pad = weights, len(codes)
    char_table = _padded_table(w["char_in"], CHAR_STATES)
    cs, ck = run_gates(_gathered(char_table, codes), w["char_u"], True)
    ch, cmask = both_ways(cs), codes.T != PAD
    vectors, cweight, cinner = attend(ch, cmask, w["char_w"], w["char_v"])
    joined = np.concatenate([vectors, w["embed"][buckets] * dropped], 1)
    table = _padded_table(joined @ w["word_in"] + w["word_b"], WORD_STATES)
    ws, wk = run_gates(_gathered(table, index), w["word_u"], True)
    wh = both_ways(ws)
    pooled, wweight, winner = attend(wh, index.T != pad, w["word_w"], w["word_v"])
    margin = pooled @ w["out_w"] + w["out_b"]
    p = 1 / (1 + np.exp(-np.clip(margin, -40, 40)))
    loss = float((cost * np.logaddexp(0, np.where(target, -margin, margin))).sum() / cost.sum())

    dm = (cost * (p - target) / cost.sum()).astype(np.float32)
    grads = {"out_w": pooled.T @ dm, "out_b": dm.sum(keepdims=True)}
    dh, grads["word_w"], grads["word_v"] = attend_back(wh, wweight, winner, pooled, w["word_w"], w["word_v"], dm[:, None] * w["out_w"])
    dx, grads["word_u"] = gates_back(ws, wk, w["word_u"], ways_back(dh))
    dtable = np.zeros_like(table)
    np.add.at(dtable[0], index.T.ravel(), dx[:, 0].reshape(-1, dx.shape[-1]))
    np.add.at(dtable[1], index.T[::-1].ravel(), dx[:, 1].reshape(-1, dx.shape[-1]))
    dtable = dtable[:, :-1]
    grads["word_in"] = joined.T @ dtable
    grads["word_b"] = dtable.sum(1, keepdims=True)
    djoined = (dtable @ w["word_in"].transpose(0, 2, 1)).sum(0)
    grads["embed"] = np.zeros_like(w["embed"])
    np.add.at(grads["embed"], buckets, djoined[:, 2 * CHAR_STATES:] * dropped)
    dh, grads["char_w"], grads["char_v"] = attend_back(ch, cweight, cinner, vectors, w["char_w"], w["char_v"], djoined[:, :2 * CHAR_STATES])
    dx, grads["char_u"] = gates_back(cs, ck, w["char_u"], ways_back(dh))
    dtable = np.zeros_like(char_table)
    np.add.at(dtable[0], codes.T.ravel(), dx[:, 0].reshape(-1, dx.shape[-1]))
    np.add.at(dtable[1], codes.T[::-1].ravel(), dx[:, 1].reshape(-1, dx.shape[-1]))
    grads["char_in"] = dtable[:, :-1]
    return loss, grads


def distinct_tokens(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place of every distinct token row, and the number of its distinct token for each row."""
    flat = np.ascontiguousarray(codes)
    _, first, inverse = np.unique(flat.view(np.dtype((np.void, flat.dtype.itemsize * flat.shape[1]))).ravel(), return_index=True, return_inverse=True)
    return first, inverse


def hashed(codes: np.ndarray) -> np.ndarray:
    """64-bit hashes of token rows: the same as those of their spans."""
    inside = codes != PAD
    length = inside.sum(1)
    ends = np.cumsum(length)
    return SpanHasher(codes[inside])(ends - length, ends)


@dataclass
class Model:
    """``score = 1 / (1 + exp(-(slope * margin + shift)))``; ``blank``: the margin of a text without words."""
    weights: dict[str, np.ndarray]
    slope: float = 1.0
    shift: float = 0.0
    blank: float = 0.0
    constant: bool = False  # the labels had one class: the score is the same everywhere
    _known: tuple | None = field(default=None, repr=False)

    def _inputs(self, hashes: np.ndarray, data, starts, ends) -> np.ndarray:
        """Byte vectors of distinct tokens, those met before from a table of bounded size."""
        if self._known is None:
            size = 1 << KNOWN_BITS
            self._known = (np.zeros(size, np.uint64), np.zeros((size, 2 * CHAR_STATES), np.float32))
        keys, vectors = self._known
        slot = (hashes & np.uint64((1 << KNOWN_BITS) - 1)).astype(np.int64)
        out = vectors[slot]
        new = np.flatnonzero(keys[slot] != hashes)
        for i in range(0, len(new), 16 * LANES):
            at = new[i:i + 16 * LANES]
            out[at] = char_vectors(self.weights, token_matrix(data, starts[at], ends[at]))
        keys[slot[new]], vectors[slot[new]] = hashes[new], out[new]
        return out

    def worst(self, texts: pa.Array):
        """Margin, windows, and first and end byte of the worst window of every text."""
        data, offsets = text_bytes(texts)
        n = len(texts)
        best, count = np.full(n, -np.inf), np.zeros(n, np.int64)
        first, last = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        if self.constant or not len(data):
            return best, count, first, last
        begin, end, text = segments(data, offsets)
        size, own = np.cumsum(end - begin), begin - offsets[text]
        i = 0
        while i < len(begin):
            j = max(i + 1, int(np.searchsorted(size, (size[i - 1] if i else 0) + 2 * SEGMENT_BYTES, "right")))
            self._segments(data, begin[i:j], end[i:j], own[i:j], text[i:j], best, count, first, last)
            i = j
        return best, count, first, last

    def _segments(self, data, begin, end, own, text, best, count, first, last) -> None:
        """Scores segments that start at byte ``own`` of their text."""
        length = end - begin
        offsets = np.append(0, np.cumsum(length))
        low = lowered(np.concatenate([data[a:b] for a, b in zip(begin.tolist(), end.tolist())]))
        starts, ends, owner = tokens(low, offsets)
        if not len(starts):
            return
        hashes, at, number = np.unique(SpanHasher(low)(starts, ends), return_index=True, return_inverse=True)
        vectors = self._inputs(hashes, low, starts[at], ends[at])
        table = word_inputs(self.weights, vectors, (hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64))
        base = bounds(owner, len(begin))
        place, whose = window_starts(np.diff(base))
        token = base[whose] + place
        stop = np.minimum(token + WINDOW, base[whose + 1])
        padded = np.append(number, len(hashes))
        for i in range(0, len(token), 16 * LANES):  # the index of all windows at once would be larger than the text
            some = slice(i, i + 16 * LANES)
            index = token[some, None] + np.arange(WINDOW)
            index = padded[np.where(index < stop[some, None], index, len(number))]
            margin = margins(self.weights, table, index)
            seg = whose[some]
            order = np.lexsort((-token[some], margin, seg))  # a segment's worst window comes last, the first one of equals
            tail = order[np.flatnonzero(np.append(np.diff(seg[order]) > 0, True))]
            for k, s in zip(tail.tolist(), seg[tail].tolist()):
                t = text[s]
                if margin[k] > best[t]:
                    best[t] = margin[k]
                    shift = own[s] - offsets[s]
                    first[t], last[t] = starts[token[i + k]] + shift, ends[stop[i + k] - 1] + shift
        np.add.at(count, text[whose], 1)

    def score(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * np.where(np.isfinite(margin), margin, self.blank) + self.shift, -40, 40)))


def calibrate(margin: np.ndarray, target: np.ndarray, prior: float) -> tuple[float, float]:
    """Slope and shift of a logistic curve over balanced classes, by Newton steps that are halved until they help; then the curve is moved to
    the share ``prior`` of the class."""
    goal = np.where(target, 1 - 1 / (target.sum() + 2), 1 / ((~target).sum() + 2))
    weight = np.where(target, 0.5 / max(1, target.sum()), 0.5 / max(1, (~target).sum())) * len(target)
    middle, width = margin.mean(), max(float(margin.std()), 1e-6)
    x, beta = np.stack([(margin - middle) / width, np.ones(len(margin))], 1), np.zeros(2)

    def loss(b):
        z = x @ b
        return float((weight * (np.logaddexp(0, z) - goal * z)).sum()) + 5e-4 * float(b @ b)

    now = loss(beta)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -40, 40)))
        gradient = x.T @ (weight * (p - goal)) + 1e-3 * beta
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        while np.abs(step).max() > 1e-8 and loss(beta - step) > now:
            step /= 2
        if np.abs(step).max() <= 1e-8:
            break
        beta = beta - step
        now = loss(beta)
    slope = max(0.0, beta[0]) / width
    return float(slope), float(beta[1] - slope * middle + np.log(prior / (1 - prior)))


def fit(rows: list[np.ndarray], toxic: np.ndarray, prior: float, epochs: int = EPOCHS, seed: int = 0) -> Model:
    """A model from sampled rows: for each, its windows as token codes (windows, WINDOW, TOKEN_BYTES). Every fifth row calibrates only.

    ``prior``: the share of toxic rows among all labelled ones; with one class only, the score is that share everywhere.
    """
    weights = new_weights(seed)
    if not len(rows) or toxic.all() or not toxic.any():
        return Model(weights, 0.0, float(np.log(prior / (1 - prior))), constant=True)
    n_windows = np.array([len(r) for r in rows])
    base = np.append(0, np.cumsum(n_windows))
    codes = np.concatenate(rows).reshape(-1, TOKEN_BYTES)
    first, number = distinct_tokens(codes)
    codes = codes[first]
    blank = int(np.flatnonzero((codes == PAD).all(1))[0]) if (codes == PAD).all(1).any() else -1
    buckets = (hashed(codes) >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    index = number.reshape(-1, WINDOW)

    def local(windows: np.ndarray):
        """The distinct tokens of some windows, and the windows over these; the blank token becomes the row that pads."""
        used, inverse = np.unique(index[windows], return_inverse=True)
        inverse = inverse.reshape(len(windows), WINDOW)
        real = used != blank
        renamed = np.where(real, np.cumsum(real) - 1, real.sum())
        return used[real], renamed[inverse]

    def scored(windows: np.ndarray) -> np.ndarray:
        used, at = local(windows)
        return margins(weights, word_inputs(weights, char_vectors(weights, codes[used]), buckets[used]), at)

    held = np.arange(len(rows)) % 5 == 4
    held &= len(rows) >= 50
    train = np.flatnonzero(~held)
    share = toxic[train].mean()
    cost = np.where(toxic, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9))
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in weights.items()}
    rng, step = np.random.default_rng(seed), 0
    batches = -(-len(train) // BATCH)
    epochs = max(epochs, min(40, -(-STEPS // batches)))
    total = epochs * batches
    for epoch in range(epochs):
        order = rng.permutation(train)
        for i in range(0, len(order), BATCH):
            docs = order[i:i + BATCH]
            if epoch < epochs // 2:
                docs = np.repeat(docs, FIRST_WINDOWS)
                chosen = base[docs] + rng.integers(0, n_windows[docs])
            else:
                windows = np.concatenate([np.arange(base[d], base[d + 1]) for d in docs])
                margin, ends = scored(windows), np.cumsum(n_windows[docs])
                chosen = np.array([windows[e - k:e][np.argmax(margin[e - k:e])] for e, k in zip(ends.tolist(), n_windows[docs].tolist())])
            used, at = local(chosen)
            dropped = np.where(rng.random((len(used), 1)) < DROPPED, 0, 1 / (1 - DROPPED)).astype(np.float32)
            _, grads = loss_and_gradients(weights, codes[used], buckets[used], at, toxic[docs], cost[docs], dropped)
            step += 1
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            rate = RATE * min(1.0, 2 * (1 - step / (total + 1))) * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
            for k, g in grads.items():
                g = g * min(1.0, 1.0 / (norm + 1e-12))
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                weights[k] -= (rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
    chosen = np.flatnonzero(held if held.any() and toxic[held].any() and not toxic[held].all() else ~held)
    margin = np.array([scored(np.arange(base[d], base[d + 1])).max() for d in chosen], np.float64)
    slope, shift = calibrate(margin, toxic[chosen], prior)
    return Model(weights, slope, shift, float(np.median(margin[~toxic[chosen]])))


def _held_out(column):
    """True on the rows whose labels are never learnt."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def sampled_windows(texts: pa.Array, most: int = SAMPLE_WINDOWS) -> list[bytes | None]:
    """For each text, the codes of at most ``most`` of its windows, chosen by a hash of their number; None for a text without words."""
    out = []
    for k in range(len(texts)):
        data, offsets = text_bytes(texts.slice(k, 1))
        chosen, passed = np.zeros((0, WINDOW, TOKEN_BYTES), np.uint8), 0
        ranks = np.zeros(0, np.uint64)
        for a, b, _ in zip(*segments(data, offsets)):
            low = lowered(data[a:b])
            starts, ends, _ = tokens(low, np.array([0, b - a]))
            place, _ = window_starts(np.array([len(starts)]))
            rank = mix(passed + np.arange(len(place), dtype=np.uint64))
            passed += len(place)
            some = np.sort(np.argsort(rank, kind="stable")[:most])
            if not len(some):
                continue
            at = place[some, None] + np.arange(WINDOW)
            inside = at < len(starts)
            at = np.minimum(at, len(starts) - 1).ravel()
            codes = token_matrix(low, starts[at], ends[at])
            codes[~inside.ravel()] = PAD
            chosen, ranks = np.concatenate([chosen, codes.reshape(-1, WINDOW, TOKEN_BYTES)]), np.concatenate([ranks, rank[some]])
            least = np.sort(np.argsort(ranks, kind="stable")[:most])
            chosen, ranks = chosen[least], ranks[least]
        out.append(chosen.tobytes() if len(chosen) else None)
    return out


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, epochs: int = EPOCHS) -> Model:
    """Fit on at most ``sample_rows`` rows of each class of ``labels`` (doc_id, toxic), chosen by a hash of doc_id among those not held out.

    Null ids and labels are no labels; an id with two labels counts as toxic. Labels without a document, or whose text has no word, are not
    used; of several documents with one id, one is. No labels: every score is 0.5.
    """
    known = (labels.filter("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
             .agg((F.max("toxic") > 0).alias("toxic")).filter(~_held_out(F.col("doc_id"))))
    seen = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    prior = (seen.get(True, 0) + 1) / (sum(seen.values()) + 2)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    ids = []
    for side in (True, False):
        # About twice the rows that are wanted leave the tasks, however many labels there are.
        below = min(1 << 30, int((1 << 30) * 2 * (sample_rows + 50) / max(1, seen.get(side, 0))))
        ids += known.filter((F.col("toxic") == side) & (place < below)).orderBy(place, "doc_id").limit(sample_rows).collect()
    if not ids:
        return fit([], np.zeros(0, bool), prior)
    picked = docs.sparkSession.createDataFrame(ids, "_id bigint, toxic boolean")  # at most twice sample_rows

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows=64):
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("toxic"), pa.array(sampled_windows(batch.column("text")), pa.binary())],
                                             names=["_id", "toxic", "codes"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("_id"), "text").join(F.broadcast(picked), "_id").select("_id", "toxic", "text")
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        if not sum(part.num_rows for part in parts):
            model = fit([], np.zeros(0, bool), prior)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])
            return
        sample = pa.Table.from_batches(parts)
        order = np.lexsort([sample["_id"].to_numpy(), mix(sample["_id"].to_numpy().view(np.uint64))])
        held = [np.frombuffer(sample["codes"][i].as_buffer(), np.uint8).reshape(-1, WINDOW, TOKEN_BYTES) for i in order.tolist()]
        model = fit(held, sample["toxic"].to_numpy()[order].astype(bool), prior, epochs)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    # The sample has at most twice sample_rows rows of at most SAMPLE_WINDOWS windows, and one task learns from it.
    sample = (rows.mapInArrow(read, "_id bigint, toxic boolean, codes binary").filter("codes is not null")
              .groupBy("_id", "toxic").agg(F.min("codes").alias("codes")))
    return pickle.loads(sample.repartition(1).mapInArrow(learn, "model binary").first().model)


ADDED = ["score", "n_windows", "worst_start", "worst_end"]


def with_scores(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with score (0 to 1), n_windows, worst_start and worst_end (bytes of the worst window, -1 without words).

    Every window of the whole text is scored. Null texts, empty ones and those without a word have no window and the score of an ordinary
    clean text. Columns of ``docs`` with the added names are replaced. An empty table gives an empty one.
    """
    docs = docs.drop(*ADDED)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches):
            margin, count, first, last = model.worst(batch.column("text"))
            made = [pa.array(model.score(margin)), pa.array(count), pa.array(first), pa.array(last)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, *ADDED])

    added = [T.StructField(ADDED[0], T.DoubleType()), *(T.StructField(c, T.LongType()) for c in ADDED[1:])]
    return docs.mapInArrow(score, T.StructType([*docs.schema.fields, *added]))


def judge(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted (score >= 0.5) of every row of ``docs``, with the worst window's place."""
    slim = docs.select("doc_id", "text")
    scored = with_scores(slim, train(slim, labels, sample_rows))
    return scored.select("doc_id", _held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
                         *ADDED[1:])
