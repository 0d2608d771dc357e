"""Importance resampling against zlib and plain Python."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from ordermill.llm.importance import SPAN, crc32_spans, ranked, resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=700), st.lists(st.tuples(st.integers(0, 700), st.integers(0, 700)), max_size=20))
def test_crc_of_spans(data, cuts):
    spans = [(min(a, b, len(data)), min(max(a, b), len(data))) for a, b in cuts]
    raw = np.frombuffer(data, np.uint8)
    got = crc32_spans(raw, *(np.array([s[i] for s in spans], np.int64) for i in (0, 1)))
    assert got.tolist() == [zlib.crc32(data[a:b]) for a, b in spans]


def test_crc_of_long_spans():
    data = np.random.default_rng(1).integers(0, 256, 1_500_000).astype(np.uint8)
    for n in (0, 1, SPAN - 1, SPAN, SPAN + 1, 2 * SPAN, 1_500_000):
        assert crc32_spans(data, np.array([0]), np.array([n]))[0] == zlib.crc32(data[:n].tobytes())


def features(text, order):
    found = WORD.findall((text or "").translate(LOWER))
    return [" ".join(found[i : i + k]) for k in range(1, order + 1) for i in range(len(found) - k + 1)], len(found)


def brute(docs, target, order, buckets, percent, least, seed=2024):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, text in docs for f in features(text, order)[0])
    t = Counter(bucket(f) for text in target for f in features(text, order)[0])
    S, T = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log(((t[b] + 1) * (S + buckets)) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)
    ]
    rows = []
    for doc, text in docs:
        found, n = features(text, order)
        weight = sum(gain[bucket(f)] for f in found)
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        rows.append([doc, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), n])
    can = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = {id(r): i + 1 for i, r in enumerate(can[: percent * len(can) // 100])}
    return sorted((tuple(r[:4]) + (rank.get(id(r)),) for r in rows), key=str)


def _docs():
    rng = np.random.default_rng(5)
    names = ["alpha", "Beta", "gamma-ray", "délta", "x1", "漢字", "the", "of"]
    rows = [(i, " ".join(rng.choice(names, rng.integers(0, 60)))) for i in range(120)]
    same = "one text of copies that holds a few more words than it would need to take part in this draw here"
    rows += [(1000 + i, same) for i in range(80)]
    return rows + [(2000, None), (2001, ""), (2002, "  -- "), (None, same + " more"), (2**62 + 1, "z" * 5000 + " é" * 30)]


def test_resampling_equals_brute_force(spark):
    docs, target = _docs(), ["alpha beta the of", "délta 漢字 漢字", None]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    frame = frame.selectExpr("*", "'x' as score", "1 as part", "2 as rank")
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    for order, buckets in ((1, 10_000), (3, 50)):
        got = resample(frame, goal, order, buckets, percent=25, min_words=10)
        assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
        assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, target, order, buckets, 25, 10)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert resample(none, some).count() == 0
    assert resample(some, none, min_words=1, percent=100).first()["rank"] == 1


def test_ranks_over_ranges_with_ties(spark):
    rows = [(i % 7, i, i % 3 > 0) for i in range(500)]
    df = spark.createDataFrame(rows, "score long, doc_id long, fit boolean").repartition(5)
    from pyspark.sql import functions as F

    got = {r.doc_id: r["rank"] for r in ranked(df, "fit", [F.desc("score"), F.asc("doc_id")], 100).collect()}
    want = sorted((r for r in rows if r[2]), key=lambda r: (-r[0], r[1]))[:100]
    assert {d: r for d, r in got.items() if r} == {r[1]: i + 1 for i, r in enumerate(want)}
    assert len(got) == 500
