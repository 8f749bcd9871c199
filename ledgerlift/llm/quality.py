"""Document quality by a byte-level convolutional network in numpy.

A document's UTF-8 bytes are cut into overlapping chunks that cover all of it. Each filter sees `width` bytes at a time,
one-hot, so its response is a sum of table entries; the largest response in a chunk is kept, and a document is described
by the maximum and the mean of these over its chunks. A logistic unit turns that into one probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import carried_id
from ledgerlift.llm.labelled import held_out, labelled_sample

CHUNK, OVERLAP, WIDTH, STRIDE, FILTERS = 512, 64, 6, 2, 16
AT_ONCE = 1024  # chunks whose responses are held together, so that a very long document needs no more memory
SAMPLE_ROWS, EPOCHS, BATCH = 3000, 10, 48
THRESHOLD = 0.3


@dataclass
class ByteNet:
    """table: (width, 256, filters) responses; out: weights of max-pooled, then mean-pooled filters; bias."""

    table: np.ndarray
    filter_bias: np.ndarray
    out: np.ndarray
    bias: float
    prior: float

    def chunks(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each filter's largest response in each chunk, and where: (chunks, filters) both. Data of a document, bytes."""
        width = self.table.shape[0]
        if len(data) < width:
            data = np.pad(data, (0, width - len(data)))
        last = len(data) - width
        places = -(-last // STRIDE) + 1  # the last one is at the very end, so that its bytes are seen too
        step, span = (CHUNK - OVERLAP) // STRIDE, CHUNK // STRIDE
        starts = np.arange(0, max(1, places - OVERLAP // STRIDE), step)
        filters = np.arange(self.table.shape[2])
        top = np.empty((len(starts), len(filters)), np.float32)
        at = np.empty((len(starts), len(filters)), np.int64)
        for first in range(0, len(starts), AT_ONCE):
            group = starts[first : first + AT_ONCE]
            seen = np.minimum(np.arange(group[0], min(group[-1] + span, places)) * STRIDE, last)
            response = self.table[0][data[seen]]
            for k in range(1, width):
                response += self.table[k][data[seen + k]]
            for c, start in enumerate(group - group[0], first):
                part = response[start : start + span]
                where = part.argmax(0)
                top[c], at[c] = part[where, filters], seen[start + where]
        return top, at

    def forward(self, data: np.ndarray) -> tuple[float, np.ndarray, tuple]:
        top, at = self.chunks(data)
        hidden = np.maximum(top + self.filter_bias, 0)
        best = hidden.argmax(0)
        pooled = np.concatenate([hidden[best, np.arange(hidden.shape[1])], hidden.mean(0)])
        logit = float(pooled @ self.out + self.bias)
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30))), pooled, (hidden, at, best)

    def score(self, text: str | None) -> float:
        """The probability of label 1; an empty text has that of the training labels."""
        if not text:
            return self.prior
        return float(self.forward(_bytes(text))[0])


def _bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8", "replace"), np.uint8)


def add_gradient(net: ByteNet, data: np.ndarray, y: int, weight: float, grads: list[np.ndarray]) -> None:
    """Add the gradient of `weight` times the log loss of one document to that of (table, filter_bias, out, bias)."""
    width, _, filters = net.table.shape
    p, pooled, (hidden, at, best) = net.forward(data)
    slope = (p - y) * weight
    grads[2] += slope * pooled
    grads[3] += slope
    towards = np.broadcast_to(slope * net.out[filters:] / len(hidden), hidden.shape).copy()
    towards[best, np.arange(filters)] += slope * net.out[:filters]
    towards *= hidden > 0
    grads[1] += towards.sum(0)
    f = np.broadcast_to(np.arange(filters), at.shape)
    padded = data if len(data) >= width else np.pad(data, (0, width - len(data)))
    for k in range(width):
        np.add.at(grads[0][k], (padded[at + k], f), towards)


def fit(texts: list[str], labels: list[int], epochs: int = EPOCHS, seed: int = 7) -> ByteNet:
    """Adam on the log loss; classes weigh the same in total. Gradients pass only through the responses that were largest."""
    rng = np.random.default_rng(seed)
    prior = float(np.mean(labels)) if labels else 0.5
    net = ByteNet(rng.normal(0, 0.25, (WIDTH, 256, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32), rng.normal(0, 0.3, 2 * FILTERS).astype(np.float32), 0.0, prior)
    pairs = [(_bytes(t), y) for t, y in zip(texts, labels, strict=True) if t]
    if len({y for _, y in pairs}) < 2:
        net.out[:] = 0
        net.bias = float(np.log((prior + 1e-3) / (1 - prior + 1e-3)))
        return net
    share = np.mean([y for _, y in pairs])
    weight = {1: 0.5 / share, 0: 0.5 / (1 - share)}
    params = [net.table, net.filter_bias, net.out, np.zeros(1, np.float32)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for epoch in range(epochs):
        rate = 0.01 * (1 - epoch / epochs) + 0.001
        order = rng.permutation(len(pairs))
        for begin in range(0, len(order), BATCH):
            grads = [np.zeros_like(p) for p in params]
            batch = order[begin : begin + BATCH]
            for i in batch:
                data, y = pairs[i]
                net.bias = float(params[3][0])
                add_gradient(net, data, y, weight[y] / len(batch), grads)
            step += 1
            for p_, g, m, v in zip(params, grads, first, second, strict=True):
                g += 1e-5 * p_
                m *= 0.9
                m += 0.1 * g
                v *= 0.999
                v += 0.001 * g * g
                p_ -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    net.bias = float(params[3][0])
    return net


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS, sample_chars: int | None = None) -> ByteNet:
    """A network fitted on at most `sample_rows` labelled texts that are not held out, each whole. Where `sample_chars` is
    given, longer texts than that give windows from all of the text instead."""
    return fit(*labelled_sample(docs, labels, label, sample_rows, sample_chars))


def score_quality(docs: DataFrame, net: ByteNet, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of `docs`; predicted is 1 if score >= 0.3.

    Whole texts are scored. Null and empty texts score the share of label 1 among the training labels; repeated rows are
    scored alike; an empty table gives an empty result; other columns are not looked at. Narrow: no shuffle.
    """
    doc_id, kind = carried_id(docs, id_col)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": [shared.value.score(t) for t in batch["text"]]})

    scored = docs.select(doc_id.alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(score, f"doc_id {kind}, score double")
    scored = scored.withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, net: ByteNet, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """`docs`, all columns, without rows that score below `threshold`. Null and empty texts score the training share."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.score(t) for t in texts], dtype="float64")

    return docs.where(score(F.col(text_col)) >= threshold)
