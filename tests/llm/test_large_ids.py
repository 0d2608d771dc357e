"""Ids beyond 2^53 beside null and repeated ids stay exact in every operator that carries them."""

from __future__ import annotations

import corpus_pipeline
from ordermill.llm.jaccard_join import near_duplicates
from ordermill.llm.packing import pack_documents
from ordermill.llm.string_tiling import benchmark_matches, decontaminate

BIG = 9007199254740993
ITEM = "one passage of a benchmark that is long enough to be found again"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows():
    texts = {
        BIG: "first text of its own with quite a few words in it",
        BIG + 2: "second text of its own with other words and more of them",
        (1 << 63) - 1: "third text, an exact copy of which has a null id beside it",
        -(1 << 63): f"before {ITEM} after",
        None: "third text, an exact copy of which has a null id beside it",
    }
    out = [(i, t, "en", f"s{n}", len(t)) for n, (i, t) in enumerate(texts.items())]
    return out + [(BIG, "another text under an id that is used twice here", "en", "s9", 48)]


def frame(spark):
    return spark.createDataFrame(rows(), SCHEMA).coalesce(1)


def test_near_duplicates(spark):
    got = near_duplicates(frame(spark)).select("doc_id", "component_id").collect()
    want = [(r[0], r[0]) for r in rows() if r[0] is not None] + [(None, (1 << 63) - 1)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_packing(spark):
    got = pack_documents(frame(spark), capacity=64)
    assert sorted((str(r.doc_id), r.words) for r in got.collect()) == sorted((str(r[0]), len(r[1].split())) for r in rows())


def test_packing_keeps_clusters_apart_that_differ_in_low_bits(spark):
    from pyspark.sql import functions as F

    big = [(1, "a", "x", BIG), (2, "b", "y", BIG + 1), (3, "c", "z", None)]
    docs = spark.createDataFrame(big, "doc_id long, text string, source string, c long").coalesce(1)
    assert len({r.bin_id for r in pack_documents(docs, 10, cluster=F.col("c")).collect()}) == 1


def test_benchmark(spark):
    items = spark.createDataFrame([(BIG + 4, ITEM), (None, "an item without an id that no document holds at all")], "item_id long, text string")
    found = [(r.doc_id, r.item_id) for r in benchmark_matches(frame(spark), items).collect()]
    assert found == [(-(1 << 63), BIG + 4)]
    twice = frame(spark).unionByName(frame(spark).selectExpr("null as doc_id", "text", "lang", "source", "n_chars")).coalesce(1)
    found = [(r.doc_id, r.item_id) for r in benchmark_matches(twice, items).collect()]
    assert sorted(found, key=str) == sorted([(-(1 << 63), BIG + 4), (None, BIG + 4)], key=str)
    left = decontaminate(frame(spark), items).collect()
    assert sorted(map(tuple, left), key=str) == sorted((r for r in rows() if r[0] != -(1 << 63)), key=str)


def test_jaccard_stage_keeps_distinct_documents(spark):
    out = corpus_pipeline.one_of_near_duplicates(spark, frame(spark), "")
    assert sorted(map(tuple, out.collect()), key=str) == sorted((r for r in rows() if r[0] is not None), key=str)


def test_whole_pipeline(spark, scratch):
    frame(spark).write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{scratch}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    got = corpus_pipeline.run(spark, scratch).collect()
    want = [r[0] for r in rows() if r[0] is not None and ITEM not in r[1]]
    assert sorted(r.doc_id for r in got) == sorted(want)


def test_names_that_differ_in_case_pass_the_line_stage(spark):
    line = "a line of more than twenty characters"
    rows_ = [(i, f"{line}\nown {i}", i + 5, 1, "z") for i in range(4)]
    docs = spark.createDataFrame(rows_, "doc_id long, text string, N_Lines long, N_CHARS int, Row_Key string")
    out = corpus_pipeline.drop_common_lines(spark, docs, "")
    assert out.columns == docs.columns and out.schema["N_CHARS"].dataType.simpleString() == "int"
    want = [(i, f"{line}\nown {i}" if i == 3 else f"own {i}", i + 5) for i in range(4)]
    got = sorted(out.collect())
    assert [tuple(r)[:3] for r in got] == want and all(r[3] == len(r[1]) for r in got)
