"""Operator 5 against a search over all open bins."""

from __future__ import annotations

import random
from collections import defaultdict

from pyspark.sql import functions as F

from ordermill.llm import packing
from ordermill.llm.packing import best_fit, pack_documents

SCHEMA = "doc_id long, text string, source string, words int, bin_id string"


def plain_best_fit(items, capacity):
    bins, out = [], []
    for words, source, cluster in items:
        fits = [
            (capacity - b["used"], n)
            for n, b in enumerate(bins)
            if b["used"] + words <= capacity and not b["sources"] & source and not b["clusters"] & cluster
        ]
        n = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append({"used": 0, "sources": 0, "clusters": 0})
        out.append((n, bins[n]["used"]))
        bins[n]["used"] += words
        bins[n]["sources"] |= source
        bins[n]["clusters"] |= cluster
    return out


def test_successor_search_finds_the_tightest_bin():
    rnd = random.Random(1)
    for _ in range(20):
        items = [
            (rnd.randrange(1, 100), 1 << rnd.choice([0, 0, 0, 1, 2, 3, 9]), rnd.choice([0, 1 << rnd.randrange(80)]))
            for _ in range(200)
        ]
        assert best_fit(items, 100) == plain_best_fit(items, 100)


def corpus():
    rnd = random.Random(2)
    rows = [
        (i, " ".join(["w"] * rnd.randrange(0, 70)) + f" {i}", "hot" if i % 3 == 0 else f"s{i % 7}", 1, "b")
        for i in range(300)
    ]
    rows += [(400, None, "s1", 1, "b"), (401, " \n", None, 1, "b"), (402, "x " * 1000, "s2", 1, "b")]
    rows += [(500 + i, "same text", None, 1, "b") for i in range(20)]
    return rows + [(600, "alike", "s3", 1, "b")] * 5 + [(None, "no id", "s4", 1, "b")] * 3


def check(rows, out, capacity):
    bins = defaultdict(list)
    by_doc = {r[0]: r for r in rows}
    for r in out:
        if r.bin_id is not None:
            bins[r.bin_id].append(r)
    for held in bins.values():
        end = 0
        for r in sorted(held, key=lambda r: r.bin_offset):
            assert r.bin_offset == end and r.words > 0
            end += r.words
        assert end <= capacity
        sources = [by_doc[r.doc_id][2] for r in held if by_doc[r.doc_id][2]]
        texts = [by_doc[r.doc_id][1] for r in held]
        assert len(sources) == len(set(sources)) and len(texts) == len(set(texts))
    placed = defaultdict(int)
    for r in out:
        placed[r.doc_id] += r.words
    wanted = defaultdict(int)
    for doc, text, *_ in rows:
        wanted[doc] += len((text or "").split())
    assert placed == wanted


def test_bins_hold_no_conflicts_and_all_words(spark, monkeypatch):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA)
    out = pack_documents(df, capacity=100).collect()
    check(rows, out, 100)
    assert sum(r.bin_id is None for r in out) == 2
    monkeypatch.setattr(packing, "SHARD_ROWS", 50)
    again = pack_documents(df, capacity=100).collect()
    check(rows, again, 100)
    assert len({r.bin_id >> 32 for r in again if r.bin_id is not None}) > 3
    assert sorted(map(str, again)) == sorted(map(str, pack_documents(df, capacity=100).collect()))


def test_one_shard_equals_plain_packing(spark):
    rows = [(i, "w " * (i * 37 % 90 + 1) + str(i), f"s{i % 5}", 1, "b") for i in range(200)]
    out = pack_documents(spark.createDataFrame(rows, SCHEMA), capacity=100).collect()
    order = sorted(rows, key=lambda r: (-len(r[1].split()), r[0]))
    want = plain_best_fit([(len(t.split()), 1 << int(s[1]), 1 << i) for i, t, s, *_ in order], 100)
    assert {r.doc_id: (r.bin_id, r.bin_offset) for r in out} == {r[0]: w for r, w in zip(order, want, strict=True)}


def test_empty_table_and_given_columns(spark):
    assert pack_documents(spark.createDataFrame([], SCHEMA)).collect() == []
    df = spark.createDataFrame([(1, "a", "x", 5, "b"), (2, "b", "y", 5, "b")], SCHEMA)
    out = pack_documents(df, 10, words=F.col("words"), cluster=F.lit(7)).collect()
    assert len({r.bin_id for r in out}) == 2
