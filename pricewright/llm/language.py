"""Language identification by a byte convolutional network.

Filters of several widths run over the embedded bytes of a window, each is max-pooled over the
window, and a softmax over the pooled values gives the language. The network is trained in numpy on a
bounded sample of labelled texts; every window of every whole text is then classified in batches, and
a document's probabilities are the mean over its windows, weighted by their bytes.

Sample bound: about ``PER_LANGUAGE`` texts of each language, chosen by a hash of key and text, each
giving at most ``CROPS`` crops of a window. It is the only bound; prediction reads all bytes.

Edge cases: a text that is null or has no letter is ``und`` with score 0; with nothing to learn from,
every text is; texts with a null label are not learned from; equal texts get equal predictions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewright.llm import common

UNDETERMINED = "und"
PER_LANGUAGE = 1500
CROPS = 3
WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
EMBEDDING = 8
PAD = 256
#: Positions convolved at a time, so that the block stays in the processor's cache.
BLOCK_WINDOWS = 32


@dataclass
class Model:
    """``steps[j]`` maps the byte at offset j to its share in every filter, all widths side by side."""

    languages: list[str]
    steps: np.ndarray  # (widest, 257, filters)
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def pooled(self, windows: np.ndarray) -> np.ndarray:
        """Max-pooled activations of padded windows (n, WINDOW + widest - 1)."""
        spans = windows.shape[1] - len(self.steps) + 1
        pooled = np.empty((len(windows), self.steps.shape[2]), np.float32)
        for low in range(0, len(windows), BLOCK_WINDOWS):
            block = windows[low : low + BLOCK_WINDOWS]
            total = self.steps[0].take(block[:, :spans], axis=0)
            for j in range(1, len(self.steps)):
                total += self.steps[j].take(block[:, j : j + spans], axis=0)
            pooled[low : low + BLOCK_WINDOWS] = total.max(axis=1)
        return np.maximum(pooled + self.bias, 0)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        return _softmax(self.pooled(windows) @ self.out + self.out_bias)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def windows_of(data: bytes) -> np.ndarray:
    """All windows of a text; the last one is padded. An empty text has none."""
    count = -(-len(data) // WINDOW)
    out = np.full((count, WINDOW + max(WIDTHS) - 1), PAD, np.int16)
    if count:
        flat = np.full(count * WINDOW, PAD, np.int16)
        flat[: len(data)] = np.frombuffer(data, np.uint8)
        out[:, :WINDOW] = flat.reshape(count, WINDOW)
    return out


def crops_of(text: str, draw: np.random.Generator) -> list[bytes]:
    """Up to ``CROPS`` pieces of a text, of various lengths, so that short texts are learned too."""
    data = text.encode("utf-8")
    out = []
    for n in range(min(CROPS, 1 + len(data) // WINDOW)):
        size = WINDOW if n else int(draw.integers(24, WINDOW + 1))
        at = int(draw.integers(0, max(1, len(data) - size + 1)))
        out.append(data[at : at + size])
    return out


def train(
    texts: list[str], labels: list[str], seed: int = 7, epochs: int = 6, least_steps: int = 600
) -> Model:
    """Adam on the cross-entropy, for more epochs where there are few crops. The gradient of a pooled
    filter reaches its best position only."""
    draw = np.random.default_rng(seed)
    languages = sorted(set(labels))
    number = {name: n for n, name in enumerate(languages)}
    crops = [(c, number[y]) for t, y in zip(texts, labels, strict=True) for c in crops_of(t, draw)]
    x = np.concatenate([windows_of(c)[:1] for c, _ in crops if c])
    y = np.array([k for c, k in crops if c])
    widest, columns = max(WIDTHS), FILTERS * len(WIDTHS)
    emb = draw.normal(0, 0.5, (PAD + 1, EMBEDDING)).astype(np.float32)
    emb[PAD] = 0
    inside = np.concatenate([np.arange(widest)[:, None] < w for w in WIDTHS for _ in range(FILTERS)], 1)
    weights = draw.normal(0, 0.35, (widest, EMBEDDING, columns)).astype(np.float32)
    weights *= inside[:, None, :]
    bias = np.zeros(columns, np.float32)
    out = draw.normal(0, 0.2, (columns, len(languages))).astype(np.float32)
    out_bias = np.zeros(len(languages), np.float32)
    params = [emb, weights, bias, out, out_bias]
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    counts = np.bincount(y, minlength=len(languages))
    share = (len(y) / (len(languages) * counts)).astype(np.float32)
    step = 0
    for _ in range(max(epochs, -(-least_steps * 64 // len(x)))):
        order = draw.permutation(len(x))
        for low in range(0, len(x), 64):
            rows = order[low : low + 64]
            batch, spans = x[rows], x.shape[1] - widest + 1
            total = np.zeros((len(rows), spans, columns), np.float32)
            for j in range(widest):
                total += (emb @ weights[j]).take(batch[:, j : j + spans], axis=0)
            best = total.argmax(axis=1)
            peak = np.take_along_axis(total, best[:, None, :], 1)[:, 0] + bias
            hidden = np.maximum(peak, 0)
            p = _softmax(hidden @ out + out_bias)
            p[np.arange(len(rows)), y[rows]] -= 1
            p *= (share[y[rows]] / len(rows))[:, None]
            g_hidden = (p @ out.T) * (peak > 0)
            g_emb, g_weights = np.zeros_like(emb), np.zeros_like(weights)
            for j in range(widest):
                seen = np.take_along_axis(batch, best + j, 1)
                at = emb[seen]
                g_weights[j] = np.einsum("bfe,bf->ef", at, g_hidden)
                back = np.einsum("bf,ef->bfe", g_hidden, weights[j])
                np.add.at(g_emb, seen.ravel(), back.reshape(-1, EMBEDDING))
            g_weights *= inside[:, None, :]
            g_emb[PAD] = 0
            grads = [g_emb, g_weights, g_hidden.sum(0), hidden.T @ p, p.sum(0)]
            step += 1
            for v, g, m, s in zip(params, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                v -= 0.005 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return Model(languages, np.stack([emb @ w for w in weights]), bias, out, out_bias)


def fit(
    labelled: DataFrame, key: str, text: str, lang: str, per_language: int = PER_LANGUAGE
) -> Model | None:
    """Train on a bounded sample, about ``per_language`` rows of each label, that a hash chooses.

    One count for each label comes to the driver, as the model has an output for each anyway.
    """
    known = labelled.select(
        F.col(key).cast("string").alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")
    ).where(F.col("lang").isNotNull() & has_letter(F.col("text")))
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return None
    rates = F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, per_language / n)])
    order = F.xxhash64(F.lit("order"), "key", "text")
    # A text gives its crops from one stretch around a hashed place.
    stretch = 4 * WINDOW
    place = F.pmod(order, F.greatest(F.length("text") - stretch, F.lit(1))) + 1
    chosen = (
        known.where(common.hash_share(F.col("key"), F.col("text"), seed="language") < rates[F.col("lang")])
        .select("lang", F.substring("text", place.cast("int"), F.lit(stretch)).alias("part"), order.alias("order"))
        .orderBy("order", "lang", "part")
        .limit(2 * per_language * len(counts))
    )
    found = chosen.collect()
    if not found:
        return None
    return train([r["part"] for r in found], [r["lang"] for r in found])


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def predict(text: Column, model: Model | None) -> Column:
    """Struct of ``lang`` and ``score`` for every whole text."""
    if model is None:
        return F.struct(F.lit(UNDETERMINED).alias("lang"), F.lit(0.0).alias("score"))

    @F.arrow_udf("lang string, score double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield _scored(texts.to_pylist(), model)

    nothing = F.struct(F.lit(UNDETERMINED).alias("lang"), F.lit(0.0).alias("score"))
    return F.when(has_letter(text), scored(text)).otherwise(nothing)


#: Windows classified at a time, counted over the documents of a batch.
CHUNK_WINDOWS = 8192


def _scored(texts: list[str | None], model: Model) -> pa.Array:
    mean = np.zeros((len(texts), len(model.languages)))
    sizes = np.zeros(len(texts))
    held: list[tuple[int, np.ndarray]] = []
    waiting = 0

    def classify() -> None:
        windows = np.concatenate([w for _, w in held])
        owner = np.repeat([n for n, _ in held], [len(w) for _, w in held])
        weight = (windows != PAD).sum(axis=1)
        np.add.at(mean, owner, model.probabilities(windows) * weight[:, None])
        np.add.at(sizes, owner, weight)

    for n, text in enumerate(texts):
        windows = windows_of((text or "").encode("utf-8"))
        for low in range(0, len(windows), CHUNK_WINDOWS):
            held.append((n, windows[low : low + CHUNK_WINDOWS]))
            waiting += len(held[-1][1])
            if waiting >= CHUNK_WINDOWS:
                classify()
                held.clear()
                waiting = 0
    if held:
        classify()
    mean /= np.maximum(sizes, 1)[:, None]
    best = mean.argmax(axis=1)
    names = [model.languages[k] for k in best]
    return pa.StructArray.from_arrays(
        [pa.array(names), pa.array(np.clip(mean[np.arange(len(texts)), best], 0, 1))],
        ["lang", "score"],
    )
