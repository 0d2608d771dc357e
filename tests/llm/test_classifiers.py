"""Operators 3 and 4: held-out accuracy, plain-Python statistics and defined cases."""

from __future__ import annotations

import os
import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordermill.llm import toxicity
from ordermill.llm.quality_nbsvm import Indicators, dual_coordinate_descent, fit_quality, log_count_ratios, score_quality
from ordermill.llm.queries import op3_quality_nbsvm, op4_counterfactual_toxicity
from ordermill.llm.toxicity import (
    Swaps,
    WordFeatures,
    WordGrams,
    fit_counterfactual,
    fit_toxicity,
    score_toxicity,
    word_features,
)

SF_DIR = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, score string, predicted int, label int"
LABELS = "doc_id long, quality int, toxic int"


def accuracy(spark, query, label, sf_dir=SF_DIR):
    out = query(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = out.join(labels, "doc_id").filter("held_out").select("predicted", F.col(label).alias("y")).collect()
    hit = [r for r in rows if r.y == 1]
    rest = [r for r in rows if r.y == 0]
    assert out.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    return sum(r.predicted for r in hit) / len(hit), sum(r.predicted for r in rest) / len(rest)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")
def test_held_out_accuracy(spark):
    right, wrong = accuracy(spark, op3_quality_nbsvm, "quality")
    assert right >= 0.97 and wrong <= 0.1
    right, wrong = accuracy(spark, op4_counterfactual_toxicity, "toxic", "/root/testdata/sf0.1")
    assert right >= 0.9 and wrong <= 0.01


def small(spark):
    rnd = random.Random(1)
    docs, labels = [], []
    for i in range(300):
        bad = i % 3 == 0
        words = [rnd.choice("one two three four five six".split()) + str(rnd.randrange(9)) for _ in range(12)]
        if bad:
            words = [w.upper() + "!!" for w in words] + ["moron"]
        docs.append((i, " ".join(words), "s", 1, 2))
        labels.append((i, 0 if bad else 1, int(bad)))
    docs += [(None, "no id", "s", 1, 2), (900, None, "s", 1, 2), (901, "", "s", 1, 2), (902, "x " * 200_000, "s", 1, 2)]
    labels += [(900, None, None), (5, 0, 1), (None, 1, 1), (7777, 1, 1)]
    return spark.createDataFrame(docs + docs[:2], DOCS), spark.createDataFrame(labels, LABELS)


def test_defined_cases(spark):
    docs, labels = small(spark)
    empty_docs, empty_labels = docs.limit(0), labels.limit(0)
    for fit, score, at in ((fit_quality, score_quality, 0.3), (fit_toxicity, score_toxicity, 0.7)):
        out = score(docs, fit(docs, labels), at)
        assert out.columns == ["doc_id", "text", "label", "score", "predicted"]
        rows = out.collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
        assert all(r.predicted == int(r.score >= at) for r in rows)
        by_text = {}
        for r in rows:
            assert by_text.setdefault(r.text or "", r.score) == r.score
        known = {r.doc_id: r for r in rows}
        wanted = (lambda i: i % 3 != 0) if fit is fit_quality else (lambda i: i % 3 == 0)
        assert all(known[i].predicted == int(wanted(i)) for i in range(300))
        assert score(empty_docs, fit(docs, labels), at).collect() == []
        assert len({r.score for r in score(docs, fit(docs, empty_labels), at).collect()}) == 1
        assert len({r.score for r in score(docs, fit(empty_docs, labels), at).collect()}) == 1


def test_rows_outside_the_learning_part_do_not_matter(spark):
    docs, labels = small(spark)
    learn = F.col("doc_id") % 2 == 0
    flipped = labels.withColumns(
        {c: F.when(F.col("doc_id") % 2 == 1, 1 - F.col(c)).otherwise(F.col(c)) for c in ("quality", "toxic")}
    )
    for fit, score in ((fit_quality, score_quality), (fit_toxicity, score_toxicity)):
        a = score(docs, fit(docs, labels, learn=learn)).select("doc_id", "score").collect()
        b = score(docs, fit(docs, flipped, learn=learn)).select("doc_id", "score").collect()
        assert sorted(map(str, a)) == sorted(map(str, b))


def test_log_count_ratios_and_hinge_fit():
    made = Indicators()
    assert len(made.of("Der Der der")) == len(set(made.of("Der Der der")))
    assert set(made.of("ab, ab,")) != set(made.of("ab, cd,"))
    rows = [np.array([1, 2], np.int32), np.array([2, 3], np.int32), np.array([3], np.int32)]
    labels = np.array([1, 1, 0])
    ratio = log_count_ratios(rows, labels)
    size = len(ratio)
    assert abs(ratio[2] - (np.log(3 / (size + 4)) - np.log(1 / (size + 1)))) < 1e-9
    rng = np.random.default_rng(0)
    truth = rng.normal(size=20)
    rows = [np.sort(rng.choice(20, 6, False)).astype(np.int32) for _ in range(200)]
    sign = np.array([1.0 if truth[r].sum() > 0 else -1.0 for r in rows])
    values = [np.ones(6)] * 200
    weights, bias = dual_coordinate_descent(rows, values, sign, np.full(200, 5.0), 400)

    def objective(w, b):
        loss = sum(max(0.0, 1 - s * (w[r].sum() + b)) for r, s in zip(rows, sign, strict=True))
        return (w**2).sum() / 2 + b**2 / 2 + 5 * loss

    best = objective(weights, bias)
    for _ in range(200):
        w = weights.copy()
        w[:20] += rng.normal(size=20) * 0.02
        assert objective(w, bias + rng.normal() * 0.02) >= best - 1e-3


def test_counterfactual_penalty_levels_identity_terms(spark):
    rnd = random.Random(3)
    docs, labels = [], []
    for i in range(600):
        words = [f"w{rnd.randrange(200)}" for _ in range(10)]
        toxic = i % 4 == 0
        if toxic and rnd.random() < 0.7:
            words.append("idiot")
        if rnd.random() < (0.7 if toxic else 0.05):
            words.append("muslim")
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic and rnd.random() < 0.95)))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame(labels, LABELS)
    probe = spark.createDataFrame(
        [(1, "w1 w2 muslim w3"), (2, "w1 w2 christian w3"), (3, "w1 w2 idiot w3")], "doc_id long, text string"
    )

    def scores(penalty):
        model = fit_toxicity(docs, labels, penalty=penalty)
        return {r.doc_id: r.score for r in score_toxicity(probe, model).collect()}

    plain, fair = scores(0.0), scores(5.0)
    assert plain[1] - plain[2] > 0.1
    assert abs(fair[1] - fair[2]) < 0.5 * (plain[1] - plain[2])
    assert fair[1] < plain[1] and fair[3] > 0.7 > fair[1]


def test_swaps():
    swaps = Swaps((("women", "men", "girls"),))
    found = list(swaps.counterfactuals("The women left. Nobody came!\nMen and women."))
    assert (b"the women left".split(), b"the men left".split()) in found
    assert (b"men and women".split(), b"girls and men".split()) in found
    assert all(b"nobody" not in a for a, _ in found)
    assert fit_counterfactual([], np.empty(0), [], 0)[0].size == 0


def test_long_words_count_whole(spark):
    docs, labels = small(spark)
    model = fit_toxicity(docs, labels)
    filler = ",".join(["one1", "two2"] * 100)
    probe = spark.createDataFrame([(1, filler), (2, filler + ",moron" * 3), (3, "\u3000" * 300 + "moron")], "doc_id long, text string")
    score = {r.doc_id: r.score for r in score_toxicity(probe, model).collect()}
    assert score[2] > score[1] and score[3] > score[1]
    word = ("ab" * 150 + "xyz").encode()
    assert {"xyz", "yz>"} <= word_features(word)
    assert word_features(word) != word_features(("ab" * 150 + "ab" + "xyz").encode())
    known = {f: i for i, f in enumerate(sorted(word_features(word)))}
    assert WordFeatures(known).of([word]).tolist() == list(range(len(known)))
    assert WordGrams().of([word]) == word_features(word)


def test_shapes_of_long_words_are_whole():
    made = Indicators()
    long = "ab,12-" * 1000
    assert set(made.of(long + "x")) != set(made.of(long + "(X)"))
    assert Indicators().shapes[(long + "!!!!!").encode()] == "a,0-" * 1000 + "!!!"
    assert not made.shapes and not any(len(s) > 4096 for gram in made.ids for s in gram)


def test_fit_holds_features_in_small_numbers(monkeypatch):
    rnd = np.random.default_rng(3)
    rows = [np.sort(rnd.choice(6000, 5000, False)) for _ in range(400)]
    labels = np.arange(400) % 2
    pairs = [(rows[i], rows[i + 1]) for i in range(20)]
    tracemalloc.start()
    weights, bias = fit_counterfactual(rows, labels, pairs, 6000, steps=3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 12 * 400 * 5000
    monkeypatch.setattr(toxicity, "BLOCK_FEATURES", 3)  # a row a block
    other, other_bias = fit_counterfactual(rows, labels, pairs, 6000, steps=3)
    assert np.array_equal(weights, other) and bias == other_bias
