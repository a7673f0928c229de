"""Quality classifier: a byte-level convolutional network in numpy.

Filters of six bytes slide over the whole UTF-8 text. Their responses are max-pooled over chunks of 512 bytes that
overlap by half, and the chunks are combined into the greatest, mean and least response of each filter, from which one
logistic unit makes a probability. A filter's least pooled response shows a stretch that lacks what ordinary text has,
as repetition does; its greatest shows a stretch of what it lacks.

The network is fitted in the driver to a bounded sample of labelled rows (``PER_LABEL`` of either label, of at most
``MOST_CHARS`` characters) with as many of either, and its output is moved to the share of label 1 among all
labelled rows. Scoring runs over all documents and their whole texts, a bounded number of bytes at a time.

A null or empty text is one chunk of padding and has a score like any other. Without any labelled row, or with one
label only, every score is the smoothed share of label 1. Repeated rows are scored alike.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcstrata.llm.labelled import held_out, labelled_sample

WIDTH, FILTERS, STEP = 6, 16, 256  # a chunk is two steps long
PAD = 256
PER_LABEL, MOST_CHARS = 1500, 20_000
EPOCHS, BATCH, RATE = 10, 48, 0.01
THRESHOLD = 0.3
ROWS_AT_ONCE = 64  # steps, so that responses stay in the cache


def steps_of(text: str | None) -> np.ndarray:
    """Symbols of a text by step, each row with the bytes that its last position looks ahead to."""
    raw = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    n = max(1, -(-len(raw) // STEP))
    padded = np.full(n * STEP + WIDTH - 1, PAD, np.int16)
    padded[: len(raw)] = raw
    return np.lib.stride_tricks.sliding_window_view(padded, STEP + WIDTH - 1)[::STEP]


def _responses(table: np.ndarray, steps: np.ndarray) -> np.ndarray:
    out = np.take(table[0], steps[:, :STEP], axis=0)
    for j in range(1, WIDTH):
        out += np.take(table[j], steps[:, j : j + STEP], axis=0)
    return out


@dataclass
class Network:
    table: np.ndarray  # (WIDTH, 257, FILTERS): what a symbol at an offset adds to a filter's response
    bias: np.ndarray
    head: np.ndarray  # (3 * FILTERS,)
    offset: float

    def pooled(self, steps: np.ndarray) -> np.ndarray:
        """The greatest response within each step."""
        parts = [steps[at : at + ROWS_AT_ONCE] for at in range(0, len(steps), ROWS_AT_ONCE)]
        return np.concatenate([_responses(self.table, p).max(axis=1) for p in parts])

    def score(self, texts: list[str | None]) -> np.ndarray:
        steps = [steps_of(x) for x in texts]
        ends = np.cumsum([len(s) for s in steps])
        pooled = self.pooled(np.concatenate(steps))
        found = [_combined(np.maximum(_chunks(p) + self.bias, 0)) for p in np.split(pooled, ends[:-1])]
        return 1 / (1 + np.exp(-np.clip(np.array(found) @ self.head + self.offset, -30, 30)))


def _chunks(pooled: np.ndarray) -> np.ndarray:
    return np.maximum(pooled[:-1], pooled[1:]) if len(pooled) > 1 else pooled


def _combined(chunks: np.ndarray) -> np.ndarray:
    return np.concatenate([chunks.max(axis=0), chunks.mean(axis=0), chunks.min(axis=0)])


class _Adam:
    def __init__(self, *weights: np.ndarray):
        self.state = [(w, np.zeros_like(w), np.zeros_like(w)) for w in weights]
        self.t = 0

    def step(self, *gradients: np.ndarray) -> None:
        self.t += 1
        rate = RATE * math.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for (w, m, v), g in zip(self.state, gradients, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= rate * m / (np.sqrt(v) + 1e-8)


def train(texts: tuple[list[str], list[str]], seed: int = 11) -> Network:
    """Fit to texts of label 0 and 1; a response's gradient goes to the position that was pooled."""
    random = np.random.default_rng(seed)
    table = random.normal(0, 0.3, (WIDTH, 257, FILTERS)).astype(np.float32)
    table[:, PAD] = 0
    bias, head = np.zeros(FILTERS, np.float32), random.normal(0, 0.1, 3 * FILTERS).astype(np.float32)
    offset = np.zeros(1, np.float32)
    steps = [steps_of(x) for some in texts for x in some]
    label = np.repeat([0.0, 1.0], [len(some) for some in texts])
    weight = np.repeat([0.5 / len(some) for some in texts], [len(some) for some in texts]) * len(steps)
    adam = _Adam(table, bias, head, offset)
    every = np.arange(FILTERS)
    for epoch in range(EPOCHS):
        order = random.permutation(len(steps))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            batch = np.concatenate([steps[i] for i in some])
            best = np.empty((len(batch), FILTERS), np.int64)
            pooled = np.empty((len(batch), FILTERS), np.float32)
            for a in range(0, len(batch), ROWS_AT_ONCE):
                r = _responses(table, batch[a : a + ROWS_AT_ONCE])
                best[a : a + ROWS_AT_ONCE] = r.argmax(axis=1)
                pooled[a : a + ROWS_AT_ONCE] = r.max(axis=1)
            g_pooled = np.zeros_like(pooled)
            g_bias, g_head, g_offset, first = np.zeros_like(bias), np.zeros_like(head), 0.0, 0
            for i in some:
                n = len(steps[i])
                own = pooled[first : first + n]
                chunks = np.maximum(_chunks(own) + bias, 0)
                features = _combined(chunks)
                p = 1 / (1 + math.exp(-float(np.clip(features @ head + offset[0], -30, 30))))
                error = (p - label[i]) * weight[i] / len(some)
                g_head += error * features
                g_offset += error
                g_max, g_mean, g_min = np.split(error * head, 3)
                g = np.tile(g_mean / len(chunks), (len(chunks), 1))
                g[chunks.argmax(axis=0), every] += g_max
                g[chunks.argmin(axis=0), every] += g_min
                g *= chunks > 0
                g_bias += g.sum(axis=0)
                if n == 1:
                    g_pooled[first] += g[0]
                else:
                    left = own[:-1] >= own[1:]
                    g_pooled[first : first + n - 1] += g * left
                    g_pooled[first + 1 : first + n] += g * ~left
                first += n
            row, unit = np.nonzero(g_pooled)
            g_table = np.zeros_like(table)
            for j in range(WIDTH):
                cell = batch[row, best[row, unit] + j].astype(np.int64) * FILTERS + unit
                sums = np.bincount(cell, g_pooled[row, unit], 257 * FILTERS)
                g_table[j] = sums.reshape(257, FILTERS)
            g_table[:, PAD] = 0
            adam.step(g_table, g_bias, g_head + 1e-4 * head, np.array([g_offset], np.float32))
    return Network(table, bias, head, float(offset[0]))


def fit(docs: DataFrame, labels: DataFrame, modulus: int = 5, remainder: int = 0) -> Network | float:
    """The network, or a constant where there are not both labels to learn from."""
    sample = labelled_sample(docs, labels, "quality", modulus, remainder, PER_LABEL, MOST_CHARS)
    if not all(sample.texts):
        return sample.share
    network = train(sample.texts)
    network.offset += math.log(sample.share / (1 - sample.share))
    return network


def _portions(texts: list[str | None], limit: int = 1 << 20):
    """Index ranges of about ``limit`` characters."""
    first, size = 0, 0
    for k, x in enumerate(texts):
        size += len(x or "") + STEP
        if size >= limit:
            yield first, k + 1
            first, size = k + 1, 0
    if first < len(texts):
        yield first, len(texts)


def score(docs: DataFrame, model: Network | float, modulus: int = 5, remainder: int = 0, text: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every row."""

    def run(batches):
        for batch in batches:
            texts = batch.column(2).to_pylist()
            if isinstance(model, float):
                scores = np.full(len(texts), model)
            else:
                scores = np.concatenate([model.score(texts[a:b]) for a, b in _portions(texts)] or [np.empty(0)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(scores.astype(np.float64)),
                    pa.array((scores >= THRESHOLD).astype(np.int32)),
                ],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        held_out(modulus, remainder).alias("held_out"),
        F.col(text).cast("string").alias("text"),
    ).mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))
