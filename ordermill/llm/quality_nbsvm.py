"""Operator 3: quality classifier, naive Bayes support vectors (NB-SVM).

A text becomes the set of its 1- to 3-grams over word *shapes*: letters of one
case collapse to ``a`` or ``A``, digits to ``0``, longer runs of one mark to
three of it, and a word equal to the word before it becomes ``=``. Spark deals
these indicators from the labelled sample. Each indicator is scaled by its class
log-count ratio, each row brought to unit length, and a linear L2-regularised
hinge-loss model is fitted by dual coordinate descent. A logistic curve fitted
to the margins (Platt) turns them into scores from 0 to 1. Words are split at
``[\\x20\\x09-\\x0D]``.

The fit reads at most ``max_rows`` labelled documents (a bounded task); every
text is scored as a whole, where it lies, with a model of 2^18 weights that
every task gets.

Defined cases: null or empty texts have the single indicator "empty"; without
labelled rows of both classes every score is the share of label 1 (0.5 without
any); documents with null or repeated ids are scored row by row; an empty table
gives an empty result; other columns pass through, columns of the added
names are replaced.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import CACHE_WORDS
from .labelled import labelled_sample

BITS = 18
#: Bytes of a word, or letters of a shape, above which it is not cached.
LONG_WORD = 4096
RUN = re.compile(r"(.)\1\1+")
LETTER_RUN = re.compile(r"([aA0])\1+")


class Shapes(dict):
    """word -> shape, with a bounded cache of words of at most LONG_WORD bytes."""

    def __missing__(self, word: bytes) -> str:
        shape = "".join(
            ("A" if c.isupper() else "a") if c.isalpha() else "0" if c.isdigit() else c
            for c in word.decode("utf-8", "replace")
        )
        shape = RUN.sub(r"\1\1\1", LETTER_RUN.sub(r"\1", shape))
        if len(word) <= LONG_WORD:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = shape
        return shape


class Indicators:
    """Text -> sorted distinct ids of its shape n-grams."""

    def __init__(self):
        self.shapes = Shapes()
        self.ids: dict[tuple, int] = {}

    def _id(self, gram) -> int:
        got = self.ids.get(gram)
        if got is None:
            got = xxhash.xxh64_intdigest("\x00".join(gram)) >> (64 - BITS)
            if all(len(shape) <= LONG_WORD for shape in gram):
                if len(self.ids) >= CACHE_WORDS:
                    self.ids.clear()
                self.ids[gram] = got
        return got

    def of(self, text: str | None) -> np.ndarray:
        found = text.encode("utf-8", "replace").split() if text else []
        if not found:
            return np.array([self._id(("empty", ""))], np.int32)
        shape = self.shapes
        marks = [shape[w] for w in found]
        for i in [i for i in range(1, len(found)) if found[i] == found[i - 1]]:
            marks[i] = "="
        grams = set(zip(marks)) | set(zip(marks, marks[1:])) | set(zip(marks, marks[1:], marks[2:]))
        return np.unique(np.fromiter(map(self._id, grams), np.int32, len(grams)))


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    """log of each indicator's share among label 1 against its share among label 0."""
    counts = [
        np.bincount(
            np.concatenate([rows[i] for i in np.flatnonzero(labels == c)] or [np.empty(0, np.int32)]),
            minlength=1 << BITS,
        )
        + smooth
        for c in (0, 1)
    ]
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    ratio[(counts[0] == smooth) & (counts[1] == smooth)] = 0  # unseen
    return ratio


def scaled(row: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    values = ratio[row]
    norm = float(np.sqrt((values**2).sum()))
    return values / norm if norm > 0 else values


def dual_coordinate_descent(
    rows: list[np.ndarray], values: list[np.ndarray], sign: np.ndarray, cost: np.ndarray, epochs: int, seed: int = 7
) -> tuple[np.ndarray, float]:
    """Weights and bias of the L1-loss linear SVM: min |w|^2 / 2 + sum cost_i max(0, 1 - y_i w.x_i)."""
    weights, bias = np.zeros(1 << BITS), 0.0
    alpha = np.zeros(len(rows))
    diagonal = np.array([float((v**2).sum()) + 1 for v in values])  # the bias is a feature of value 1
    order, random = np.arange(len(rows)), np.random.default_rng(seed)
    for _ in range(epochs):
        random.shuffle(order)
        largest = 0.0
        for i in order:
            row, value = rows[i], values[i]
            gradient = sign[i] * (float(weights[row] @ value) + bias) - 1
            now = min(max(alpha[i] - gradient / diagonal[i], 0.0), cost[i])
            step = now - alpha[i]
            if step:
                alpha[i] = now
                weights[row] += step * sign[i] * value
                bias += step * sign[i]
                largest = max(largest, abs(step))
        if largest < 1e-4:
            break
    return weights, bias


def platt(margin: np.ndarray, labels: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """a, b of score = 1 / (1 + exp(-(a * margin + b))), by Newton steps with smoothed targets."""
    ones, zeros = labels.sum(), len(labels) - labels.sum()
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((p - target) * margin).sum(), (p - target).sum()])
        h = np.array([[(w * margin**2).sum() + 1e-6, (w * margin).sum()], [(w * margin).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        norm = float(np.abs(step).max())
        a, b = a - float(step[0]) / max(1, norm), b - float(step[1]) / max(1, norm)
        if norm < 1e-8:
            break
    return a, b


class QualityModel:
    """Weights over scaled indicators, and the curve from margins to scores."""

    def __init__(self, rows: list[np.ndarray], labels: np.ndarray, cost: float = 1.0, epochs: int = 40):
        self.share = float(labels.mean()) if len(labels) else 0.5
        self.weights = None
        if len(set(labels.tolist())) < 2:
            return
        self.ratio = log_count_ratios(rows, labels).astype(np.float32)
        values = [scaled(r, self.ratio) for r in rows]
        sign = np.where(labels == 1, 1.0, -1.0)
        per_class = {c: len(labels) / (2 * (labels == c).sum()) for c in (0, 1)}
        costs = cost * np.array([per_class[c] for c in labels.tolist()])
        weights, self.bias = dual_coordinate_descent(rows, values, sign, costs, epochs)
        self.weights = weights.astype(np.float32)
        self.curve = platt(np.array([self.margin(r) for r in rows]), labels)

    def margin(self, row: np.ndarray) -> float:
        return float(self.weights[row] @ scaled(row, self.ratio)) + self.bias

    def score(self, row: np.ndarray) -> float:
        if self.weights is None:
            return self.share
        a, b = self.curve
        return float(1 / (1 + np.exp(-np.clip(a * self.margin(row) + b, -30, 30))))


def fit_quality(
    docs: DataFrame, labels: DataFrame, label: str = "quality", learn: Column | None = None, max_rows: int = 20_000
) -> QualityModel:
    """Fit on at most ``max_rows`` labelled rows that meet ``learn`` (a column over doc_id)."""
    sample = labelled_sample(docs, labels, label, F.lit(True) if learn is None else learn, max_rows)

    def indicators(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = Indicators()
        for frame in frames:
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"],
                    "label": frame["label"],
                    "ids": [made.of(t).tobytes() for t in frame["text"]],
                }
            )

    def fitted(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("doc_id", kind="stable")
        ids = [np.frombuffer(x, np.int32) for x in frame["ids"]]
        return pd.DataFrame({"model": [pickle.dumps(vars(QualityModel(ids, frame["label"].to_numpy(np.int64))))]})

    rows = sample.mapInPandas(indicators, "doc_id long, label int, ids binary")
    # The sample is bounded by max_rows, so one task can hold it; the driver gets the weights only.
    found = rows.withColumn("one", F.lit(0)).groupBy("one").applyInPandas(fitted, "model binary").first()
    model = QualityModel([], np.empty(0, np.int64))
    if found:
        vars(model).update(pickle.loads(bytes(found.model)))
    return model


def score_quality(
    docs: DataFrame, model: QualityModel, threshold: float = 0.3, names: tuple[str, str] = ("score", "predicted")
) -> DataFrame:
    """``docs`` with the columns ``names``: score (double) and predicted (int)."""
    score, predicted = names
    docs = docs.drop(score, predicted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Indicators()
        for batch in batches:
            scores = [model.score(made.of(t.as_py())) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, score]
            )

    schema = StructType([*docs.schema.fields, StructField(score, DoubleType())])
    return docs.mapInArrow(run, schema).withColumn(
        predicted, F.when(F.col(score) >= threshold, 1).otherwise(0).cast("int")
    )
