"""Operator 8 against a table of all windows."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from ordermill.llm import repeat_removal
from ordermill.llm.repeat_removal import merged, remove_repeats, sliding_minimum

SCHEMA = "doc_id long, text string, n_bytes string, tkey int, spans string"


def brute(rows, least=200):
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(d[i : i + least] for d in data for i in range(len(d) - least + 1))
    out = []
    for (doc, _), d in zip(rows, data, strict=True):
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - least + 1):
            if seen[d[i : i + least]] > 1:
                gone[i : i + least] = True
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((str(doc), len(d), int(gone.sum()), spans, bytes(np.frombuffer(d, np.uint8)[~gone])))
    return sorted(out)


def got(spark, rows):
    df = spark.createDataFrame([(d, t, "n", 1, "s") for d, t in rows], SCHEMA)
    out = remove_repeats(df)
    assert out.columns[:4] == ["doc_id", "text", "tkey", "spans"]
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out.collect())


def corpus(seed):
    rnd = random.Random(seed)
    text = lambda n: "".join(rnd.choice("abcdé \n") for _ in range(n))
    shared = [text(n) for n in (199, 200, 201, 230, 400, 900)]
    rows = []
    for i in range(60):
        parts = [text(rnd.randrange(300))]
        for _ in range(rnd.randrange(3)):
            whole = rnd.choice(shared)
            a = rnd.randrange(max(1, len(whole) - 190))
            parts += [whole[a:] if rnd.random() < 0.5 else whole, text(rnd.randrange(300))]
        rows.append((i, "".join(parts)))
    near = text(2500)
    for i in range(40):
        at = rnd.randrange(2500)
        rows.append((100 + i, near[:at] + "X" + near[at + 1 :]))
    rows += [rows[3], (rows[4][0], "other " + text(250)), (None, rows[5][1]), (None, None), (200, ""), (201, "é" * 99)]
    rows += [(202, "a" * 700), (203, "ab" * 500 + "c" + "ab" * 150), (204, shared[1]), (205, shared[0] + "x")]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_windows(spark, seed):
    rows = corpus(seed)
    assert got(spark, rows) == brute(rows)


def test_segments_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(repeat_removal, "SEGMENT", 700)
    rows = corpus(3)
    assert got(spark, rows) == brute(rows)


def test_no_repeats_and_empty_table(spark):
    assert got(spark, []) == []
    rows = [(1, "short"), (2, "".join(chr(97 + i % 26) + str(i) for i in range(300)))]
    assert got(spark, rows) == brute(rows)


def test_helpers():
    values = np.random.default_rng(1).integers(0, 50, 100)
    for width in (1, 2, 5, 64, 100):
        assert sliding_minimum(values, width).tolist() == [min(values[i : i + width]) for i in range(101 - width)]
    assert merged(np.array([[5, 9], [1, 3], [3, 4], [7, 12]])).tolist() == [[1, 4], [5, 12]]
