"""Operator 4: toxicity classifier with counterfactual regularisation.

A text becomes the set of its words' features: the word itself and its inner
letter n-grams (3 to 5, with word ends marked), A-Z lower-cased, ASCII
punctuation removed. Words of any length give all their n-grams; one of more
than LONG_WORD characters is named by its hash as a whole word. From a bounded labelled sample Spark counts each feature's
documents per class; all features of significant association, and the identity
terms, form the vocabulary. A logistic model over it
is fitted by accelerated gradient descent with a second penalty: in each
labelled sentence that holds identity terms, these are swapped for each other
term of their group, and the squared difference of the two sentences' scores (logits)
is charged. A mention of a group by itself thus hardly moves a score, however
unevenly the labels mention it.

Fitting reads at most ``max_rows`` labelled documents; every text is scored
whole, where it lies, with the model's weights, one per feature of the sample's vocabulary, that every task gets.

Defined cases: null or empty texts score the model's bias; without labelled rows
of both classes every score is the share of label 1 (0 without any); null and
repeated ids are scored row by row; an empty table gives an empty result; other
columns pass through, columns of the added names are replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import staged
from .labelled import labelled_sample
from .string_tiling import plain_words

#: Groups of interchangeable identity terms; a term is swapped within its group.
IDENTITY_GROUPS: tuple[tuple[str, ...], ...] = (
    ("women", "men", "girls", "boys", "transgender", "nonbinary"),
    ("woman", "man", "girl", "boy"),
    ("gay", "lesbian", "bisexual", "straight", "heterosexual", "homosexual", "queer"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "sikh", "atheist", "catholic", "protestant"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "sikhs", "atheists", "catholics", "protestants"),
    ("black", "white", "asian", "african", "american", "european", "hispanic", "latino", "arab", "indian"),
    ("immigrants", "refugees", "foreigners", "natives", "citizens"),
    ("old", "young", "elderly", "teenage"),
    ("blind", "deaf", "disabled", "paralyzed"),
)
#: Cached words of a worker: with their positions in the vocabulary (mostly none), and with all their features.
CACHED_WORDS, CACHED_GRAMS = 200_000, 10_000
#: Characters above which a word is named by a hash and not cached.
LONG_WORD = 256
#: Documents counted at once, and features after which counts are sent on.
COUNTED_ROWS, COUNTED_FEATURES = 500, 500_000
#: Features of the labelled documents that a step of the fit works on at a time.
BLOCK_FEATURES = 1 << 18
SENTENCE = re.compile(r"[.!?\n]+")


def whole_word(marked: str) -> str:
    """The feature of a marked word itself; plain words have no #, so a hash is never taken for a word."""
    return marked if len(marked) <= LONG_WORD + 2 else f"<#{blake2b(marked.encode('utf-8', 'replace'), digest_size=16).hexdigest()}>"


def word_features(word: bytes) -> set[str]:
    """A word, and its letter 3- to 5-grams, with the ends marked."""
    marked = "<" + word.decode("utf-8", "replace") + ">"
    grams = {marked[i : i + n] for n in (3, 4, 5) for i in range(len(marked) - n + 1)}
    grams.add(whole_word(marked))
    return grams


class WordGrams(dict):
    """word -> its features, with a bounded cache of words that are not long."""

    def __missing__(self, word: bytes) -> tuple[str, ...] | set[str]:
        if len(word) > LONG_WORD:
            return word_features(word)
        if len(self) >= CACHED_GRAMS:
            self.clear()
        self[word] = found = tuple(word_features(word))
        return found

    def of(self, words: list[bytes]) -> set[str]:
        return set().union(*map(self.__getitem__, set(words)))


class WordFeatures(dict):
    """word -> positions of its features in the vocabulary, with a bounded cache of words that are not long."""

    def __init__(self, vocabulary: dict[str, int]):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, word: bytes) -> tuple | set[int]:
        known = self.vocabulary
        marked = "<" + word.decode("utf-8", "replace") + ">"
        size = len(marked)
        if len(word) > LONG_WORD:
            hits = {known[gram] for n in (3, 4, 5) for i in range(size - n + 1) if (gram := marked[i : i + n]) in known}
            whole = whole_word(marked)
            return hits | {known[whole]} if whole in known else hits
        if len(self) >= CACHED_WORDS:
            self.clear()
        out = [known[marked]] if marked in known else []
        for n in (3, 4, 5):
            for i in range(size - n + 1):
                gram = marked[i : i + n]
                if gram in known:
                    out.append(known[gram])
        self[word] = found = tuple(out)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        """Sorted distinct positions of a list of words."""
        got: set[int] = set()
        for word in set(words):
            some = self[word]
            if some:
                got.update(some)
        return np.array(sorted(got), np.int64)


class Swaps:
    """Identity terms and their replacements."""

    def __init__(self, groups):
        self.next = {}
        for group in groups:
            for at, term in enumerate(group):
                self.next[term.encode()] = [t.encode() for t in group[at + 1 :] + group[:at]]

    def counterfactuals(self, text: str) -> Iterator[tuple[list[bytes], list[bytes]]]:
        """(words, swapped words) of every sentence with identity terms; each term takes every other of its group
        (terms of smaller groups go round again until the largest group is through)."""
        for sentence in SENTENCE.split(text):
            words = plain_words(sentence)
            for shift in range(max((len(self.next[w]) for w in words if w in self.next), default=0)):
                yield words, [
                    self.next[w][shift % len(self.next[w])] if w in self.next and self.next[w] else w for w in words
                ]


class ToxicityModel:
    """Vocabulary (feature -> position), weights and bias."""

    def __init__(self, vocabulary: dict[str, int], weights: np.ndarray, bias: float):
        self.vocabulary, self.weights, self.bias = vocabulary, weights, bias

    def score(self, positions: np.ndarray) -> float:
        logit = float(self.weights[positions].sum()) + self.bias if len(positions) else self.bias
        return float(1 / (1 + np.exp(-np.clip(logit, -30, 30))))


class Ragged:
    """Rows of feature positions, 4 bytes each, read in blocks of about BLOCK_FEATURES: temporaries stay that small."""

    def __init__(self, rows: Iterable[np.ndarray]):
        rows = list(rows)
        self.ends = np.cumsum([0, *map(len, rows)])
        self.flat = np.concatenate([np.empty(0, np.int32), *rows], dtype=np.int32)
        self.n = len(rows)

    def blocks(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """first row, row behind the last, the features of these rows, and of each the row it is in, from the first."""
        first = 0
        while first < self.n:
            most = int(np.searchsorted(self.ends, self.ends[first] + BLOCK_FEATURES, "right")) - 1
            end = min(self.n, max(first + 1, most))
            sizes = np.diff(self.ends[first : end + 1])
            yield first, end, self.flat[self.ends[first] : self.ends[end]], np.repeat(np.arange(end - first), sizes)
            first = end

    def row_sums(self, of_feature: np.ndarray) -> np.ndarray:
        out = np.zeros(self.n)
        for first, end, feature, owner in self.blocks():
            out[first:end] = np.bincount(owner, of_feature[feature], end - first)
        return out

    def feature_sums(self, of_row: np.ndarray, size: int) -> np.ndarray:
        # Each block's sums go on from those before, so the order of additions does not depend on the blocks.
        out, places = np.zeros(size), np.arange(size)
        for first, end, feature, owner in self.blocks():
            out = np.bincount(np.r_[places, feature], np.r_[out, of_row[first:end][owner]], size)
        return out


def fit_counterfactual(
    rows: list[np.ndarray],
    labels: np.ndarray,
    pairs: list[tuple[np.ndarray, np.ndarray]],
    size: int,
    penalty: float = 5.0,
    ridge: float = 2e-4,
    steps: int = 400,
) -> tuple[np.ndarray, float]:
    """Weights and bias of least mean log-loss + ridge |w|^2 / 2 + penalty * mean squared counterfactual change.

    ``pairs`` are the features of sentences and of their swapped forms; those
    that both have may be left out. Both classes weigh the same.
    """
    held = Ragged(rows)
    here, there = Ragged(np.setdiff1d(a, b, True) for a, b in pairs), Ragged(np.setdiff1d(b, a, True) for a, b in pairs)
    weight = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum()))
    w, bias = np.zeros(size), 0.0
    first, second, bias_first, bias_second = np.zeros(size), np.zeros(size), 0.0, 0.0
    for step in range(1, steps + 1):
        logits = held.row_sums(w) + bias
        slope = weight * (1 / (1 + np.exp(-np.clip(logits, -30, 30))) - labels)
        gradient = held.feature_sums(slope, size) + ridge * w
        if here.n:
            change = here.row_sums(w) - there.row_sums(w)
            change *= 2 * penalty / here.n
            gradient += here.feature_sums(change, size) - there.feature_sums(change, size)
        bias_gradient = float(slope.sum())
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        bias_first = 0.9 * bias_first + 0.1 * bias_gradient
        bias_second = 0.999 * bias_second + 0.001 * bias_gradient**2
        size_of_step = 0.05 * (1 - 0.999**step) ** 0.5 / (1 - 0.9**step) * min(1.0, 2 * (1 - step / (steps + 1)))
        w -= size_of_step * first / (np.sqrt(second) + 1e-8)
        bias -= size_of_step * bias_first / (bias_second**0.5 + 1e-8)
    return w, bias


def _counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents of each class that hold a feature; counts are sent on after COUNTED_ROWS of them, or sooner if
    they hold COUNTED_FEATURES."""
    made = WordGrams()

    def sent(held: tuple[Counter, Counter]) -> pd.DataFrame:
        features = list(held[0].keys() | held[1].keys())
        return pd.DataFrame(
            {"feature": features, "n0": [held[0][f] for f in features], "n1": [held[1][f] for f in features]}
        )

    for frame in frames:
        for low in range(0, len(frame), COUNTED_ROWS):
            part = frame.iloc[low : low + COUNTED_ROWS]
            held: tuple[Counter, Counter] = (Counter(), Counter())
            for kind, text in zip(part["label"], part["text"], strict=True):
                held[kind].update(made.of(plain_words(text)))
                if len(held[0]) + len(held[1]) >= COUNTED_FEATURES:
                    yield sent(held)
                    held = (Counter(), Counter())
            yield sent(held)


def vocabulary_of(sample: DataFrame, least_z: float, swaps: Swaps) -> dict[str, int]:
    """All features of three documents or more whose shares in the two classes differ by ``least_z`` standard errors
    or more, and the identity terms themselves. They are features of the bounded sample."""
    totals = sample.agg(F.sum(1 - F.col("label")), F.sum("label")).first()
    zeros, ones = max(1, totals[0] or 0), max(1, totals[1] or 0)
    counts = (
        sample.select("text", "label")
        .mapInPandas(_counted, "feature string, n0 long, n1 long")
        .groupBy("feature")
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    )
    share = (F.col("n0") + F.col("n1") + 1) / F.lit(zeros + ones + 2)
    error = F.sqrt(share * (1 - share) * F.lit(1 / zeros + 1 / ones))
    z = F.abs(F.col("n1") / F.lit(ones) - F.col("n0") / F.lit(zeros)) / error
    chosen = (
        counts.withColumn("z", z)
        .filter((F.col("z") >= least_z) & (F.col("n0") + F.col("n1") >= 3))
        .select("feature")
        .orderBy("feature")
        .toArrow()
    )
    features = dict.fromkeys(chosen.column("feature").to_pylist())
    for term in swaps.next:
        features[f"<{term.decode()}>"] = None
    return {f: at for at, f in enumerate(features)}


def _fitted(size: int, penalty: float):
    """Weights and bias from the features of all labelled documents (label 0 or 1) and of sentence pairs (label -1:
    those that only the sentence has, and only its swapped form)."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_id", "label", "ids", "swapped"], kind="stable")
        kinds = frame["label"].to_numpy(np.int64)
        known = kinds[kinds >= 0]
        rows = lambda column, some: [np.frombuffer(x, np.int32) for x in frame[column].array[some]]
        if len(set(known.tolist())) < 2:
            weights, bias = np.zeros(size), 30.0 * (2 * float(known.mean()) - 1)
        else:
            pairs = list(zip(rows("ids", kinds < 0), rows("swapped", kinds < 0), strict=True))
            weights, bias = fit_counterfactual(rows("ids", kinds >= 0), known, pairs, size, penalty)
        return pd.DataFrame({"weights": [weights.tobytes()], "bias": [float(bias)]})

    return run


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    learn: Column | None = None,
    max_rows: int = 20_000,
    least_z: float = 4.0,
    penalty: float = 5.0,
    groups=IDENTITY_GROUPS,
) -> ToxicityModel:
    """Fit on at most ``max_rows`` labelled rows that meet ``learn`` (a column over doc_id)."""
    sample = staged(labelled_sample(docs, labels, label, F.lit(True) if learn is None else learn, max_rows), "toxic-sample")
    swaps = Swaps(groups)
    vocabulary = vocabulary_of(sample, least_z, swaps)

    def features(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = WordFeatures(vocabulary)
        packed = lambda positions: positions.astype(np.int32).tobytes()
        for frame in frames:
            out = []
            for doc_id, kind, text in zip(frame["doc_id"], frame["label"], frame["text"], strict=True):
                out.append((doc_id, kind, packed(made.of(plain_words(text))), b""))
                for words, swapped in swaps.counterfactuals(text):
                    a, b = made.of(words), made.of(swapped)
                    out.append((doc_id, -1, packed(np.setdiff1d(a, b, True)), packed(np.setdiff1d(b, a, True))))
            yield pd.DataFrame(out, columns=["doc_id", "label", "ids", "swapped"])

    rows = sample.select("doc_id", "label", "text").mapInPandas(
        features, "doc_id long, label int, ids binary, swapped binary"
    )
    # The sample is bounded by max_rows, so one task can hold it; the driver gets the weights only.
    fitted = rows.withColumn("one", F.lit(0)).groupBy("one").applyInPandas(_fitted(len(vocabulary), penalty), "weights binary, bias double").first()
    if fitted is None:
        return ToxicityModel(vocabulary, np.zeros(len(vocabulary)), -30.0)
    return ToxicityModel(vocabulary, np.frombuffer(bytes(fitted.weights), np.float64), fitted.bias)


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, threshold: float = 0.7, names: tuple[str, str] = ("score", "predicted")
) -> DataFrame:
    """``docs`` with the columns ``names``: score (double) and predicted (int)."""
    score, predicted = names
    docs = docs.drop(score, predicted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = WordFeatures(model.vocabulary)
        for batch in batches:
            scores = [model.score(made.of(plain_words(t.as_py()))) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, score]
            )

    schema = StructType([*docs.schema.fields, StructField(score, DoubleType())])
    return docs.mapInArrow(run, schema).withColumn(
        predicted, F.when(F.col(score) >= threshold, 1).otherwise(0).cast("int")
    )
