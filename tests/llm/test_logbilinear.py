"""Log-bilinear scoring: counts and base scores against plain Python, normalisation, gradients, held-out gain."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordermill.llm import logbilinear as lb
from ordermill.llm.labelled import id_crc
from ordermill.llm.queries import op11_log_bilinear

SF = "/root/testdata/sf0.01"


def tokens(text):
    return (text or "").encode().lower().split()


def held(doc):
    return zlib.crc32(b"" if doc is None else str(doc).encode()) % 10 == 0


def brute_base(rows):
    count, ends = Counter(), 0
    for doc, text in rows:
        if not held(doc):
            count.update(tokens(text))
            ends += 1
    n, v = sum(count.values()) + ends, len(count) + (ends > 0)
    out = []
    for doc, text in rows:
        each = [count[w] for w in tokens(text)] + [ends]
        base = sum(math.log10((c + 0.1) / (n + 0.1 * (v + 1))) for c in each)
        out.append((doc, held(doc), len(each), sum(c > 0 for c in each), n, base))
    return sorted(out, key=str), count, ends


def rows_of(spark, sf=SF):
    return [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


def compare(got, rows):
    want, _, _ = brute_base(rows)
    found = sorted((tuple(r)[:6] for r in got), key=str)
    assert [f[:5] for f in found] == [w[:5] for w in want]
    assert np.allclose([f[5] for f in found], [w[5] for w in want], rtol=1e-12)


@pytest.fixture(scope="module")
def scored(spark):
    return op11_log_bilinear(spark, SF).collect()


def test_query_counts_and_base(spark, scored):
    compare(scored, rows_of(spark))


def test_model_beats_the_base_on_held_out_texts(scored):
    out = [r for r in scored if r.held_out]
    gain = (sum(r.score for r in out) - sum(r.base_score for r in out)) / sum(r.n_tokens for r in out)
    assert gain > 0.04, gain
    assert all(math.isfinite(r.score) and r.score < 0 for r in scored)


def test_edge_rows(spark):
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "A a B"), (4, "A a B"), (None, "a null id"), ((1 << 62) + 1, "b é É b"),
        (6, "x" * 300_000 + " y"), (7, "w1 w2 " * 3000), (10, "unseen words here"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = lb.score_documents(docs.selectExpr("*", "1 as learn", "2 as block", "'n' as n_tokens"), id_crc() % 10 != 0)
    assert got.columns == [
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score",
    ]
    compare(got.collect(), rows)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert lb.score_documents(none, F.lit(True)).count() == 0
    untrained = lb.score_documents(docs, F.lit(False)).collect()
    assert {r.train_tokens for r in untrained} == {0} and {r.n_known for r in untrained} == {0}
    end_only = [r for r in untrained if r.n_tokens == 1]
    assert len(end_only) == 3 and np.allclose([r.score for r in end_only], -math.log10(lb.WORDS + lb.CLASSES + 1))


def test_probabilities_sum_to_one(spark):
    """Over all words, one unseen word per class, and the end, after any context."""
    rows = [(i, t) for i, t in rows_of(spark, "/root/testdata/sf0.001") if i < 60]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counts, units = lb.encoded(docs, id_crc() % 10 != 0, 2)
    model = lb.train(units, counts, 2)
    _, count, ends = brute_base(rows)
    head = {w: i for i, (w, _) in enumerate(sorted(count.items(), key=lambda x: (-x[1], x[0]))[: lb.WORDS])}
    unit = np.array([head.get(w, lb.WORDS + lb.ending_class(w)) for w in count])
    number = np.array(list(count.values()))
    assert counts.tokens == number.sum() + ends and counts.distinct == len(count) + 1
    unseen = np.arange(lb.WORDS, lb.WORDS + lb.CLASSES)
    all_units = np.r_[unit, unseen, lb.WORDS + lb.CLASSES]
    inner = counts.inner(np.r_[number, np.zeros(lb.CLASSES), ends], all_units)
    start = lb.WORDS + lb.CLASSES + 1
    unused = np.arange(len(head), lb.WORDS)
    for first, second in ((start, start), (0, start), (3, 700)):
        full = lambda v, like: np.full(len(like), v)
        of_words = lb.Scorer(model).log_probabilities(all_units, full(first, all_units), full(second, all_units)) + inner * lb.LOG10
        spare = lb.Scorer(model).log_probabilities(unused, full(first, unused), full(second, unused))
        assert np.isclose(np.exp(of_words).sum() + np.exp(spare).sum(), 1, atol=1e-5)


def test_gradients_of_the_loss(monkeypatch):
    """Every parameter moves against the numeric gradient of the noise-contrastive loss."""
    monkeypatch.setattr(lb, "NOISE", 5)
    random = np.random.default_rng(0)
    counts = random.integers(1, 50, 12)
    model = lb.Model.unigram(counts, 4)
    model.w[:] = random.normal(0, 0.5, model.w.shape)
    share = counts / counts.sum()
    unit, first, second = (random.integers(0, 12, 30) for _ in range(3))
    steps = {}

    class Recorded(lb.Trainer):
        def _step(self, part, rows, gradient):
            steps[part] = (np.array(rows), gradient)

    trainer = Recorded(model, share, 9)
    trainer.batch(unit, first, second)
    noise = np.searchsorted(np.cumsum(share), np.random.default_rng(9).random(5) * np.cumsum(share)[-1])

    def loss(m):
        q = m.c[0] * m.r[first] + m.c[1] * m.r[second]
        log_noise = np.log(share * 5)
        true = (q * m.w[unit]).sum(1) + m.b[unit] - log_noise[unit]
        false = q @ m.w[noise].T + m.b[noise] - log_noise[noise]
        return (np.log1p(np.exp(-true)).sum() + np.log1p(np.exp(false)).sum()) / len(unit)

    for part in range(4):
        rows, gradient = steps[part]
        for k in range(min(6, len(rows))):
            wide = lb.Model(*[p.astype(np.float64) for p in model.parts()])
            target = wide.parts()[part]
            cell = (rows[k],) if target.ndim == 1 else (rows[k], 1)
            sides = []
            for move in (1e-5, -2e-5):
                target[cell] += move
                sides.append(loss(wide))
            assert np.isclose((sides[0] - sides[1]) / 2e-5, gradient[k] if target.ndim == 1 else gradient[k][1], atol=1e-4)


def test_normaliser_is_the_sum_over_all_units():
    random = np.random.default_rng(2)
    model = lb.Model.unigram(random.integers(1, 9, 20), 3)
    model.w[:] = random.normal(0, 1, model.w.shape)
    unit, first, second = random.integers(0, 20, 50), random.integers(0, 21, 50), random.integers(0, 21, 50)
    scores = (model.c[0] * model.r[first] + model.c[1] * model.r[second]) @ model.w.T + model.b
    want = scores - np.log(np.exp(scores.astype(float)).sum(1, keepdims=True))
    scorer = lb.Scorer(model)
    for _ in range(2):  # the second time from the table
        assert np.allclose(scorer.log_probabilities(unit, first, second), want[np.arange(50), unit], atol=1e-5)


def test_contexts_stop_at_the_start_of_a_text():
    end = 9
    first, second = lb.contexts(np.array([1, 2, 3, end, 4, end, end]), end)
    assert first.tolist() == [10, 1, 2, 3, 10, 4, 10]
    assert second.tolist() == [10, 10, 1, 2, 10, 10, 10]


def test_pieces_of_long_texts():
    text = b"ab cd\tef  gh " * 50
    cut = list(lb._pieces(text, 10))
    assert len(cut) > 10 and b" ".join(cut).split() == text.split()
