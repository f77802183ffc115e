"""Quality classifier: a byte-level convolutional network over overlapping chunks."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import id_and_text, labelled_sample, per_batch, utf8

CHUNK, STRIDE = 512, 448
FILTERS, WIDTH = 16, 4
SAMPLE_ROWS = 2000
_PAD = 256
_CHUNKS_AT_ONCE = 128
_NEVER = np.float32(-1e9)


def chunked(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Chunks that together cover every text, each with its text's number.

    A chunk has 512 places for a filter, the next one begins 64 before its end.
    An empty text has one empty chunk.
    """
    counts = np.array([max(1, -(-(len(text) - CHUNK) // STRIDE) + 1) for text in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), counts)
    chunks = np.full((len(owner), CHUNK + WIDTH - 1), _PAD, np.int32)
    row = 0
    for text, count in zip(texts, counts.tolist(), strict=True):
        data = np.frombuffer(text, np.uint8)
        for at in range(0, count * STRIDE, STRIDE):
            piece = data[at : at + CHUNK + WIDTH - 1]
            chunks[row, : len(piece)] = piece
            row += 1
    return chunks, owner


@dataclass
class Network:
    """``filters[j, byte, f]``: what a byte at place ``j`` adds to filter ``f``."""

    filters: np.ndarray
    bias: np.ndarray
    weights: np.ndarray
    offset: float

    @classmethod
    def fresh(cls, seed: int = 0) -> Network:
        rng = np.random.default_rng(seed)
        filters = rng.normal(0, 0.3, (WIDTH, _PAD + 1, FILTERS)).astype(np.float32)
        weights = rng.normal(0, 0.3, 2 * FILTERS).astype(np.float32)
        return cls(filters, np.zeros(FILTERS, np.float32), weights, 0.0)

    def tables(self) -> list[np.ndarray]:
        """Two filter places at a time, by pairs of bytes. No place starts behind the end of a text."""
        filters = self.filters.copy()
        filters[:, _PAD] = 0
        filters[0, _PAD] = _NEVER
        return [
            (filters[j][:, None] + filters[j + 1][None]).reshape(-1, FILTERS) for j in range(0, WIDTH, 2)
        ]

    def pooled(self, chunks: np.ndarray, tables: list[np.ndarray], places: bool = False):
        """The largest response of each filter in each chunk, and where it was."""
        most = np.empty((len(chunks), FILTERS), np.float32)
        where = np.empty((len(chunks), FILTERS), np.int64) if places else None
        for start in range(0, len(chunks), _CHUNKS_AT_ONCE):
            part = chunks[start : start + _CHUNKS_AT_ONCE]
            pairs = part[:, :-1] * (_PAD + 1) + part[:, 1:]
            response = tables[0][pairs[:, :CHUNK]]
            for j, table in enumerate(tables[1:], 1):
                response += table[pairs[:, 2 * j : 2 * j + CHUNK]]
            if places:
                at = response.argmax(axis=1)
                where[start : start + len(part)] = at
                most[start : start + len(part)] = np.take_along_axis(response, at[:, None], 1)[:, 0]
            else:
                most[start : start + len(part)] = response.max(axis=1)
        return most, where

    def features(self, most: np.ndarray, owner: np.ndarray):
        """Per text the largest and the mean rectified response over its chunks."""
        lit = np.maximum(most + self.bias, 0)
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        counts = np.diff(np.r_[starts, len(owner)])
        top = np.maximum.reduceat(lit, starts)
        mean = np.add.reduceat(lit, starts) / counts[:, None]
        return lit, top, mean, counts

    @cached_property
    def trained(self) -> list[np.ndarray]:
        """The tables of a network that learns no more; each worker builds them once, with the network it got."""
        return self.tables()

    def __getstate__(self) -> dict:
        return {name: value for name, value in self.__dict__.items() if name != "trained"}

    def score(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        chunks, owner = chunked(texts)
        most, _ = self.pooled(chunks, self.trained)
        _, top, mean, _ = self.features(most, owner)
        return _sigmoid(np.hstack((top, mean)).astype(np.float64) @ self.weights.astype(np.float64) + self.offset)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(
    texts: list[bytes], labels: list[int], *, epochs: int = 12, batch: int = 64, rate: float = 0.01, seed: int = 0
) -> Network:
    """Fit by stochastic gradients (Adam); with one class only, the score is its share."""
    network = Network.fresh(seed)
    known = np.array(labels, np.float64)
    share = (known.sum() + 1) / (len(known) + 2)
    network.offset = float(np.log(share / (1 - share)))
    if len(set(labels)) < 2:
        network.weights[:] = 0
        return network
    values = [network.filters, network.bias, network.weights, np.array([network.offset])]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    rng, step = np.random.default_rng(seed), 0
    cut = [chunked([text])[0] for text in texts]
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for start in range(0, len(order), batch):
            picked = order[start : start + batch]
            step += 1
            network.offset = float(values[3][0])
            gradients = _gradients(network, [cut[k] for k in picked], known[picked])
            for value, grad, m, v in zip(values, gradients, first, second, strict=True):
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                value -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    network.offset = float(values[3][0])
    return network


def _gradients(network: Network, cut: list[np.ndarray], labels: np.ndarray):
    chunks = np.concatenate(cut)
    owner = np.repeat(np.arange(len(cut)), [len(c) for c in cut])
    most, where = network.pooled(chunks, network.tables(), places=True)
    lit, top, mean, counts = network.features(most, owner)
    found = np.hstack((top, mean))
    error = ((_sigmoid(found @ network.weights + network.offset) - labels) / len(labels)).astype(np.float32)
    to_top, to_mean = error[:, None] * network.weights[:FILTERS], error[:, None] * network.weights[FILTERS:]
    ties = np.add.reduceat((lit == top[owner]).astype(np.float32), np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]))
    back = (lit == top[owner]) * (to_top / ties)[owner] + (to_mean / counts[:, None])[owner]
    back *= lit > 0
    filters = np.zeros_like(network.filters)
    number = np.broadcast_to(np.arange(FILTERS), where.shape)
    for j in range(WIDTH):
        letters = np.take_along_axis(chunks, where + j, 1)
        flat = np.bincount((letters * FILTERS + number).ravel(), back.ravel(), (_PAD + 1) * FILTERS)
        filters[j] = flat.reshape(_PAD + 1, FILTERS)
    filters[:, _PAD] = 0
    return filters, back.sum(axis=0), (error @ found).astype(np.float32), np.array([error.sum()])


def learn(docs: DataFrame, labels: DataFrame, *, rows: int = SAMPLE_ROWS, text_column: str = "text", **options) -> Network:
    """Train on at most ``rows`` whole labelled texts, none of them held out.

    The number of rows bounds what comes to the driver. Labels, language and
    source are never inputs. Rows with a null label or id are not learned from.
    """
    picked = labelled_sample(docs, labels, "quality", rows, text_column).collect()
    found = sorted(((row["text"] or "").encode(), row["label"]) for row in picked)
    return train([text for text, _ in found], [label for _, label in found], **options)


def score(
    docs: DataFrame, network: Network, *, threshold: float = 0.3, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, score, predicted`` of every whole text; no shuffle.

    A null text scores as an empty one; a null id stays null; rows that repeat
    an id are scored each; other columns are ignored.
    """
    frame = id_and_text(docs, id_column, text_column)
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        scores = shared.value.score(utf8(part.column(1)))
        return pa.RecordBatch.from_arrays([part.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    found = frame.mapInArrow(per_batch(work, 64), "doc_id long, score double")
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, network: Network, *, threshold: float = 0.3, text_column: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, that the network predicts to be good."""
    shared = docs.sparkSession.sparkContext.broadcast(network)
    at = docs.columns.index(text_column)

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        scores = shared.value.score(utf8(part.column(at)))
        return part.filter(pa.array(scores >= threshold))

    return docs.mapInArrow(per_batch(work, 64), docs.schema)
