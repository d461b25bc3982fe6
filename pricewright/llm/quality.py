"""Quality scores: random-indexing word vectors pooled per document, and a small calibrated network.

1. Every word slot has a fixed random index vector, sparse and ternary. Going over all documents, the
   context vector of a word gathers the index vectors of its neighbours. Words are hashed to ``SLOTS``
   slots, so the table has a fixed size: tasks add up their part, and a grouped sum adds up the tasks.
2. A document is the mean and the deviation of its words' context vectors.
3. A two-layer network is trained in numpy on a bounded sample of labelled documents, about
   ``SAMPLE`` of them, chosen by a hash; a part of it that it isn't trained on sets the temperature.

Only the sample's labels are bounded; word statistics and scores cover all documents and whole texts.

Edge cases: a null text counts as empty; texts without words have the score of an average document;
with no labels, or one kind only, every score is the share of label 1 (0.5 without any); null labels
are not learned from; of several labels of a document each is learned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewright.llm import common

SLOTS = 1 << 13
DIMENSIONS = 24
NONZERO = 4
REACH = 2
SAMPLE = 6000
HIDDEN = 24
CACHE_WORDS = 100_000
#: Words of a stretch that is worked on at once.
STRETCH = 1 << 17
COLUMNS = [f"d{n}" for n in range(DIMENSIONS)]


class _Slots(dict):
    """Slot of a word, remembered for a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = crc32(word) % SLOTS
        return value


def index_vectors(seed: int = 3) -> np.ndarray:
    """Ternary index vectors of all slots, and a row of zeros for no word."""
    draw = np.random.default_rng(seed)
    out = np.zeros((SLOTS + 1, DIMENSIONS), np.int16)
    for slot in range(SLOTS):
        at = draw.choice(DIMENSIONS, NONZERO, replace=False)
        out[slot, at] = draw.choice([-1, 1], NONZERO)
    return out


def _slots_of(text: str | None, slots: dict[bytes, int]) -> np.ndarray:
    words = (text or "").encode("utf-8").split()
    return np.fromiter(map(slots.__getitem__, words), np.int32, len(words))


def _gather(total: np.ndarray, ids: np.ndarray, index: np.ndarray) -> None:
    """Add to each slot's row the index vectors of the words around its occurrences."""
    padded = np.concatenate([np.full(REACH, SLOTS), ids, np.full(REACH, SLOTS)])
    for low in range(0, len(ids), STRETCH):
        part = ids[low : low + STRETCH]
        near = np.zeros((len(part), DIMENSIONS), np.int16)
        for off in (*range(-REACH, 0), *range(1, REACH + 1)):
            start = REACH + low + off
            near += index[padded[start : start + len(part)]]
        order = np.argsort(part, kind="stable")
        slots, first = np.unique(part[order], return_index=True)
        kept = slots < SLOTS
        sums = np.add.reduceat(near[order].astype(np.int64), first, axis=0)
        total[slots[kept]] += sums[kept]


def word_vectors(df: DataFrame, text: str) -> np.ndarray:
    """Context vectors of all slots, centred and of length 1; ``SLOTS`` rows come to the driver."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, slots = index_vectors(), _Slots()
        total = np.zeros((SLOTS, DIMENSIONS), np.int64)
        gap = np.full(REACH, SLOTS, np.int32)
        for batch in batches:
            held, size = [], 0
            for one in batch.column(0).to_pylist():
                ids = _slots_of(one, slots)
                held += [ids, gap]
                size += len(ids)
                if size >= STRETCH:
                    _gather(total, np.concatenate(held), index)
                    held, size = [], 0
            if held:
                _gather(total, np.concatenate(held), index)
        used = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), *[pa.array(total[used, n]) for n in range(DIMENSIONS)]],
            ["slot", *COLUMNS],
        )

    schema = "slot int, " + ", ".join(f"{c} bigint" for c in COLUMNS)
    parts = df.select(F.col(text)).mapInArrow(gather, schema)
    sums = parts.groupBy("slot").agg(*[F.sum(c).alias(c) for c in COLUMNS]).collect()
    out = np.zeros((SLOTS + 1, DIMENSIONS))
    for row in sums:
        out[row[0]] = row[1:]
    used = out.any(axis=1)
    lengths = np.linalg.norm(out, axis=1, keepdims=True)
    out = np.divide(out, lengths, out=np.zeros_like(out), where=lengths > 0)
    if used.any():
        out[used] -= out[used].mean(axis=0)
    lengths = np.linalg.norm(out, axis=1, keepdims=True)
    return np.divide(out, lengths, out=np.zeros_like(out), where=lengths > 0).astype(np.float32)


def pooled(text: str | None, vectors: np.ndarray, slots: dict[bytes, int]) -> np.ndarray:
    """Mean and standard deviation of the vectors of a text's words."""
    ids = _slots_of(text, slots)
    if not len(ids):
        return np.zeros(2 * DIMENSIONS, np.float32)
    used, times = np.unique(ids, return_counts=True)
    share = (times / len(ids)).astype(np.float32)
    rows = vectors[used]
    mean = share @ rows
    spread = np.sqrt(np.maximum(share @ (rows * rows) - mean * mean, 0))
    return np.concatenate([mean, spread])


@dataclass
class Network:
    centre: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh(((x - self.centre) / self.scale) @ self.first + self.first_bias)
        return hidden @ self.second + self.second_bias

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def train(x: np.ndarray, y: np.ndarray, seed: int = 5, epochs: int = 60) -> Network:
    """Adam with weight decay on four fifths; the temperature with the least loss on the rest."""
    draw = np.random.default_rng(seed)
    order = draw.permutation(len(x))
    apart = order[: len(x) // 5]
    fit = order[len(x) // 5 :]
    centre, scale = x[fit].mean(0), x[fit].std(0) + 1e-6
    inputs = x.shape[1]
    first = draw.normal(0, inputs**-0.5, (inputs, HIDDEN))
    second = draw.normal(0, HIDDEN**-0.5, HIDDEN)
    share = np.clip(y[fit].mean(), 1e-3, 1 - 1e-3)
    params = [first, np.zeros(HIDDEN), second, np.array([np.log(share / (1 - share))])]
    m, s = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    z, step = (x - centre) / scale, 0
    for _ in range(epochs):
        for low in range(0, len(fit), 128):
            rows = draw.choice(fit, min(128, len(fit)), replace=False) if low else fit[:128]
            hidden = np.tanh(z[rows] @ params[0] + params[1])
            p = 1 / (1 + np.exp(-np.clip(hidden @ params[2] + params[3], -40, 40)))
            error = (p - y[rows]) / len(rows)
            back = error[:, None] * params[2] * (1 - hidden * hidden)
            grads = [z[rows].T @ back + 1e-4 * params[0], back.sum(0), hidden.T @ error + 1e-4 * params[2], error.sum(keepdims=True)]
            step += 1
            for v, g, a, b in zip(params, grads, m, s, strict=True):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                v -= 0.003 * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    network = Network(centre, scale, params[0], params[1], params[2], float(params[3][0]), 1.0)
    if len(apart):
        logits = network.logits(x[apart])

        def loss(t: float) -> float:
            return float(np.mean(np.logaddexp(0, logits / t) - y[apart] * logits / t))

        network.temperature = min(np.geomspace(0.25, 8, 41), key=loss)
    return network


def features(text: Column, vectors: np.ndarray) -> Column:
    @F.arrow_udf("array<float>")
    def made(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        slots = _Slots()
        for texts in batches:
            rows = [pooled(t, vectors, slots) for t in texts.to_pylist()]
            flat = np.concatenate(rows) if rows else np.zeros(0, np.float32)
            ends = np.arange(len(rows) + 1, dtype=np.int32) * (2 * DIMENSIONS)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

    return made(text)


def fit(
    docs: DataFrame, labels: DataFrame, vectors: np.ndarray, key: str, text: str, label: str, sample: int = SAMPLE
) -> Network | float:
    """A network, or the share of label 1 where there is nothing to tell apart.

    About ``sample`` labelled rows are chosen by a hash of the id and label; only they meet the texts.
    """
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("double").alias("label")).where(
        F.col("key").isNotNull() & F.col("label").isin(0.0, 1.0)
    )
    count = known.count()
    if not count:
        return 0.5
    order = F.xxhash64(F.lit("order"), "key", "label")
    chosen = (
        known.where(common.hash_share(F.col("key"), seed="quality") < sample / count)
        .withColumn("order", order).orderBy("order", "key").limit(2 * sample)
    )
    # At most 2 * sample rows of three numbers: a side of proven size.
    made = (
        docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
        .join(F.broadcast(chosen), "key")
        .select("order", "label", features(F.col("text"), vectors).alias("x"))
        .orderBy("order", "label", "x").limit(4 * sample)
    )
    rows = made.collect()
    y = np.array([r["label"] for r in rows])
    if not len(rows) or y.min() == y.max():
        return float(y.mean()) if len(rows) else 0.5
    return train(np.array([r["x"] for r in rows], np.float64), y)


def score(text: Column, vectors: np.ndarray, network: Network | float) -> Column:
    """Probability of label 1 for every whole text."""
    if isinstance(network, float):
        return F.lit(network)

    @F.arrow_udf("double")
    def made(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        slots = _Slots()
        for texts in batches:
            rows = [pooled(t, vectors, slots) for t in texts.to_pylist()]
            x = np.array(rows).reshape(len(rows), 2 * DIMENSIONS)
            yield pa.array(network.scores(x.astype(np.float64)), pa.float64())

    return made(text)
