"""The pipeline's stages against plain Python, one by one and in a row."""

from __future__ import annotations

import random

import pyarrow as pa

import corpus_pipeline
from corpus_pipeline import BIN_WORDS, STAGES
from ordermill.llm.toxicity import fit_toxicity, score_toxicity
from ordermill.session import BATCH_BYTES, BATCH_SIZE, bound_batches

from .test_jaccard_join import shingles
from .test_line_dedup import brute as lines_kept
from .test_packing import check as check_bins
from .test_string_tiling import brute as contaminated

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns named like those that operators add.
CLASHES = "score string, predicted int, n_lines string, row_key string, kept_id int, copy string, words string"
LABELS = "doc_id long, quality int, toxic int"


def corpus():
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(4))
    items = [(i, " ".join(word() for _ in range(20))) for i in range(5)]
    bases = [[word() for _ in range(60)] for _ in range(8)]
    rows, labels = [], []
    for i in range(240):
        words = list(rnd.choice(bases)) if i % 4 == 0 else [word() for _ in range(rnd.randrange(8, 60))]
        if i % 4 == 0 and rnd.random() < 0.7:
            words[rnd.randrange(60)] = word()
        if i % 10 == 1:
            words.append(rnd.choice(["idiot", "moron"]))
            labels.append((i, 1, 1))
        elif i % 2:
            labels.append((i, 1, 0))
        if i % 17 == 2:
            words += rnd.choice(items)[1].split()
        text = " ".join(words)
        if i % 6 == 3:
            text = "a common line of many documents\n" + text + "\nanother COMMON line of documents"
        rows.append((i, text, "en", f"s{i % 5}", len(text)))
    rows += [rows[8], rows[8], (500, None, None, None, None), (501, "", "en", None, 0), (None, "no id at all", "en", "x", 12)]
    rows += [(502, rows[12][1], "de", "s1", 1), (503, "w " * 5000, "en", "s2", 10_000)]
    return rows, labels, items


def one_of_each(rows):
    sets = [shingles(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    kept = []
    for members in groups.values():
        best = min(members, key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
        kept.append(rows[best])
    return kept


def test_stages_in_a_row(spark, scratch):
    rows, labels, items = corpus()
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{scratch}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    docs = spark.read.parquet(f"{scratch}/documents.parquet")
    columns = docs.columns
    as_rows = lambda df: sorted(map(tuple, df.collect()), key=str)

    model = fit_toxicity(docs, spark.read.parquet(f"{scratch}/labels.parquet"))
    scores = {r.text: r.score for r in score_toxicity(docs, model).collect()}
    assert all((scores[t] >= 0.7) == bool({"idiot", "moron"} & set((t or "").split())) for _, t, *_ in rows)
    want = [r for r in rows if scores[r[1]] < 0.7]
    for n, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, scratch)
        if n == 1:
            kept = lines_kept([(d, t) for d, t, *_ in want])
            assert sorted(((str(r.doc_id), r.text) for r in docs.collect()), key=str) == sorted(
                ((d, k) for d, k, *_ in kept), key=str
            )
            want = [tuple(r) for r in docs.collect()]
            assert all(r[4] == (None if r[1] is None else len(r[1])) for r in want)
        elif n == 2:
            want = one_of_each(want)
        elif n == 3:
            hit = {d for d, *_ in contaminated([(r[0], r[1]) for r in want], items)}
            want = [r for r in want if str(r[0]) not in hit]
            assert hit
        if n < 4:
            assert docs.columns == columns
            assert as_rows(docs) == sorted(want, key=str)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    check_bins([(d, t, s, 1, "b") for d, t, _, s, _ in want], docs.collect(), BIN_WORDS)
    whole = corpus_pipeline.run(spark, scratch)
    assert sorted(map(str, whole.collect())) == sorted(map(str, docs.collect()))
    assert [n for n, _ in STAGES][0] == "toxicity" and len(STAGES) == 5


def test_empty_tables(spark, scratch):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame([], LABELS).write.parquet(f"{scratch}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    assert corpus_pipeline.run(spark, scratch).collect() == []


def test_clashing_columns_pass_through(spark, scratch):
    rows, labels, items = corpus()
    extra = ("s", 1, "n", "r", 2, "c", "w")
    spark.createDataFrame([(*r, *extra) for r in rows], f"{SCHEMA}, {CLASHES}").write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{scratch}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    docs = spark.read.parquet(f"{scratch}/documents.parquet")
    columns = docs.columns
    for _, stage in STAGES[:4]:
        docs = spark.createDataFrame(stage(spark, docs, scratch).collect(), docs.schema)
        assert docs.columns == columns and docs.count() > 50
        assert {tuple(r)[5:] for r in docs.collect()} == {extra}
    assert STAGES[4][1](spark, docs, scratch).count() > 50


def test_documents_without_words_stay_row_by_row(spark):
    bare = [(None, "", "en", "a", 0), (None, "", "de", "b", 0), (None, None, "en", "a", None), (7, " \n", "en", "a", 2), (7, " \n", "fr", "a", 2), (7, "", "en", "a", 0)]
    worded = [(1, "one text", "en", "a", 8), (2, "one text", "en", "a", 8)]
    docs = spark.createDataFrame(bare + worded + worded[:1], SCHEMA)
    out = corpus_pipeline.one_of_near_duplicates(spark, docs, "").collect()
    assert sorted(map(tuple, out), key=str) == sorted(bare + worded[:1], key=str)


def test_texts_reach_python_in_bounded_batches(spark, scratch):
    spark.createDataFrame([(1, 1, 1), (2, 1, 0)], LABELS).write.parquet(f"{scratch}/labels.parquet")
    spark.createDataFrame([(1, "no such words in any text")], "item_id long, text string").write.parquet(
        f"{scratch}/benchmark.parquet"
    )
    docs = spark.range(0, 2000, 1, 1).selectExpr("id as doc_id", "repeat(concat('w', id, ' '), 2000) as text", "'a' as source")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"size": [batch.nbytes]})

    before = spark.conf.get(BATCH_SIZE, None)
    try:
        for name, stage in STAGES:
            if name == "line_dedup":  # has no Python
                continue
            spark.conf.unset(BATCH_SIZE)
            stage(spark, docs.limit(3), scratch)
            got = [r.size for r in docs.mapInArrow(sizes, "size long").collect()]
            assert sum(got) > 3 * BATCH_BYTES and max(got) < 1.1 * BATCH_BYTES, name
        spark.conf.set(BATCH_SIZE, "1000000")
        bound_batches(spark)
        assert spark.conf.get(BATCH_SIZE) == "1000000"
    finally:
        spark.conf.unset(BATCH_SIZE) if before is None else spark.conf.set(BATCH_SIZE, before)
