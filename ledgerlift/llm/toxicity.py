"""Toxicity by cumulative-link ordinal regression on sparse text features.

P(grade <= k) = sigmoid(threshold_k - w.x): one weight vector for all grades, ordered thresholds, and the expected grade
as the severity. Features are words that the labelled sample ties to toxicity, by log count. Labels only say toxic or
not; how toxic a toxic text is is taken from a model that has not seen it: each half of the sample is scored by a model of
the other half, and the terciles of those scores are the grades 1 to 3.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import carried_id
from ledgerlift.llm.labelled import held_out, labelled_sample

SAMPLE_ROWS = 6000
LEAST_DOCS, LEAST_Z, MOST_FEATURES = 4, 4.5, 2048
THRESHOLD, GRADES = 0.15, 4
WORD = re.compile(r"[^\W\d_]+")
STEMS = (4, 5, 6)  # a word counts as itself and as its beginnings of these lengths, written with a trailing "-"


def features_of(word: str) -> list[str]:
    return [word, *(word[:n] + "-" for n in STEMS if len(word) > n)]


def counted(text: str, heads: frozenset[str], wanted: dict[str, float] | dict[str, int]) -> Counter:
    """Counts of the wanted features; `heads` are their first four characters, which most words fail at once."""
    close = [w for w in WORD.findall(text.lower()) if w[:4] in heads]
    return Counter(f for w in close for f in features_of(w) if f in wanted)


def heads_of(features: list[str] | dict[str, float]) -> frozenset[str]:
    return frozenset(f.rstrip("-")[:4] for f in features)


@dataclass
class OrdinalModel:
    weights: dict[str, float]
    thresholds: np.ndarray  # ascending; one fewer than grades

    def __post_init__(self) -> None:
        self.heads = heads_of(self.weights)

    def signal(self, text: str | None) -> float:
        if not text or not self.weights:
            return 0.0
        found = counted(text, self.heads, self.weights)
        return sum(self.weights[w] * np.log1p(n) for w, n in found.items())

    def above(self, signal: np.ndarray) -> np.ndarray:
        """P(grade > k) for each k: (rows, thresholds)."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - np.asarray(signal, float)[:, None], -30, 30)))


def select_words(texts: list[str], toxic: list[int]) -> list[str]:
    """Words that stand in at least LEAST_DOCS texts and far more often in toxic ones than chance has it. Words of clean texts are no
    evidence: they tell what a text is about."""
    seen, bad = Counter(), Counter()
    for text, y in zip(texts, toxic, strict=True):
        words = {f for w in set(WORD.findall(text.lower())) for f in features_of(w)}
        seen.update(words)
        if y:
            bad.update(words)
    share = sum(toxic) / max(1, len(toxic))
    scored = []
    for word, n in seen.items():
        if n >= LEAST_DOCS:
            z = (bad[word] - n * share) / np.sqrt(max(n * share * (1 - share), 1e-9))
            if z >= LEAST_Z:
                scored.append((-z, word))
    return [word for _, word in sorted(scored)[:MOST_FEATURES]]


def log_likelihood(w: np.ndarray, low: float, gaps: np.ndarray, x: np.ndarray, y: np.ndarray, penalty: float) -> tuple[float, np.ndarray]:
    """The mean log likelihood of grades y, less penalty / 2 * |w|^2, and its gradient by (w, low, gaps).

    Thresholds are low, low + exp(gaps[0]), ...: gaps between them are exponentials, so that they stay ordered.
    """
    steps = np.exp(gaps)
    theta = low + np.concatenate([[0.0], np.cumsum(steps)])
    n, k = len(y), len(theta)
    p = 1 / (1 + np.exp(-np.clip(theta[None, :] - (x @ w)[:, None], -30, 30)))  # P(grade <= k)
    upper = np.concatenate([p, np.ones((n, 1))], 1)[np.arange(n), y]
    lower = np.concatenate([np.zeros((n, 1)), p], 1)[np.arange(n), y]
    dense = np.maximum(upper - lower, 1e-12)
    d_upper, d_lower = upper * (1 - upper) / dense, lower * (1 - lower) / dense
    g_theta = np.array([(d_upper * (y == j)).sum() - (d_lower * (y == j + 1)).sum() for j in range(k)]) / n
    g_gaps = np.array([g_theta[j + 1 :].sum() for j in range(k - 1)]) * steps
    g_w = -(x.T @ (d_upper - d_lower)) / n - penalty * w
    return float(np.log(dense).mean() - penalty / 2 * (w @ w)), np.concatenate([g_w, [g_theta.sum()], g_gaps])


def ascend(x: np.ndarray, y: np.ndarray, grades: int, rounds: int, penalty: float) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) that the likelihood is largest at, by Adam."""
    at = np.concatenate([np.zeros(x.shape[1]), [2.0], np.full(grades - 2, 0.5)])
    m, v = np.zeros(len(at)), np.zeros(len(at))
    split = x.shape[1]
    for step in range(1, rounds + 1):
        grad = log_likelihood(at[:split], at[split], at[split + 1 :], x, y, penalty)[1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        at = at + 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return at[:split], at[split] + np.concatenate([[0.0], np.cumsum(np.exp(at[split + 1 :]))])


def graded(x: np.ndarray, toxic: np.ndarray, rounds: int, penalty: float) -> np.ndarray:
    """0 for clean rows; for toxic ones 1 to GRADES - 1 by the share of toxic rows that a model of the other half ranks lower."""
    score, half = np.zeros(len(toxic)), np.arange(len(toxic)) % 2
    for side in (0, 1):
        rest = half != side
        if 0 < toxic[rest].sum() < rest.sum():
            score[~rest] = x[~rest] @ ascend(x[rest], toxic[rest], 2, rounds, penalty)[0]
    bad = np.flatnonzero(toxic)
    rank = score[bad].argsort(kind="stable").argsort(kind="stable")
    y = np.zeros(len(toxic), np.int64)
    y[bad] = 1 + rank * (GRADES - 1) // len(bad)
    return y


def fit(texts: list[str], toxic: list[int], rounds: int = 400, penalty: float = 1e-3) -> OrdinalModel:
    """The ordinal model of a sample; without both labels or any feature, one that only knows the share of toxic texts."""
    words = select_words(texts, toxic) if 0 < sum(toxic) < len(toxic) else []
    if not words:
        share = min(max(np.mean(toxic) if toxic else 0.1, 1e-3), 1 - 1e-3)
        return OrdinalModel({}, np.log((1 - share) / share) + np.arange(GRADES - 1.0))
    place, heads = {w: i for i, w in enumerate(words)}, heads_of(words)
    x = np.zeros((len(texts), len(words)))
    for i, text in enumerate(texts):
        for word, n in counted(text, heads, place).items():
            x[i, place[word]] = np.log1p(n)
    w, thresholds = ascend(x, graded(x, np.array(toxic), rounds // 2, penalty), GRADES, rounds, penalty)
    return OrdinalModel({word: float(w[i]) for word, i in place.items()}, thresholds)


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample_rows: int = SAMPLE_ROWS, sample_chars: int | None = None) -> OrdinalModel:
    """A model fitted on at most `sample_rows` labelled texts that are not held out, each whole. Where `sample_chars` is
    given, longer texts than that give windows from all of the text instead."""
    return fit(*labelled_sample(docs, labels, label, sample_rows, sample_chars))


def score_toxicity(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, severity, grade, p_toxic, toxic) for each row of `docs`.

    severity is the expected grade (0 to 3), toxic whether P(grade >= 1) >= threshold, and grade 0 if not, else the most
    likely one above 0. Whole texts are scored; null and empty texts have no features and score as clean. Repeated rows are scored alike; an
    empty table gives an empty result; other columns are not looked at. Narrow: no shuffle.
    """
    doc_id, kind = carried_id(docs, id_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for batch in batches:
            above = model.above(np.array([model.signal(t) for t in batch["text"]], dtype=float))
            each = np.concatenate([1 - above[:, :1], above[:, :-1] - above[:, 1:], above[:, -1:]], 1)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "severity": above.sum(1), "grade": np.where(above[:, 0] >= threshold, 1 + each[:, 1:].argmax(1), 0).astype("int32"), "p_toxic": above[:, 0]})

    scored = docs.select(doc_id.alias("doc_id"), F.col(text_col).alias("text"))
    scored = scored.mapInPandas(score, f"doc_id {kind}, severity double, grade int, p_toxic double")
    scored = scored.withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "severity", "grade", "p_toxic", (F.col("p_toxic") >= threshold).alias("toxic"))
