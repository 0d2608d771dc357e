"""Operator 7 against plain Python."""

from __future__ import annotations

import random

from ordermill.llm.line_dedup import RunIndex, dedup_lines

SCHEMA = "doc_id long, text string, n_lines string, r1 int, gone string"
SPACE = " \t\n\x0b\f\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def brute(rows):
    held = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                held.setdefault(key(line), set()).add(-(1 << 63) if doc is None else doc)
    out = []
    for doc, text in rows:
        me = -(1 << 63) if doc is None else doc
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(held.get(key(x), ())) < 3 or max(held[key(x)]) == me]
        out.append((str(doc), "\n".join(kept) if text is not None else None, len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def got(spark, rows, **kw):
    df = spark.createDataFrame([(d, t, "z", 1, "g") for d, t in rows], SCHEMA)
    out = dedup_lines(df, **kw)
    assert out.columns == ["doc_id", "text", "r1", "gone", "n_lines", "n_dropped"]
    return sorted(((str(r.doc_id), r.text, r.n_lines, r.n_dropped) for r in out.collect()), key=str)


def corpus():
    rnd = random.Random(3)
    pool = [f"line number {i} of a pool É {'x' * i}" for i in range(25)] + ["short", "", "  ", "é" * 20, "É" * 20]
    rows = []
    for i in range(120):
        lines = [rnd.choice(pool) if rnd.random() < 0.6 else f"own line {i} {j} {rnd.random()}" for j in range(rnd.randrange(9))]
        lines = [x.upper() if rnd.random() < 0.2 else rnd.choice(SPACE.replace("\n", " ")) + x for x in lines]
        rows.append((i * 2, "\n".join(lines)))
    rows += [rows[3], rows[3], (rows[4][0], "line number 3 of a pool É xxx\nelse"), (None, rows[5][1]), (None, None)]
    rows += [(900, None), (901, ""), (902, "\n"), (903, "\n".join(["a very common long line"] * 3000))]
    rows += [(910 + i, "a very common long line") for i in range(4)]
    return rows


def test_equals_plain_python(spark):
    rows = corpus()
    assert got(spark, rows) == brute(rows)


def test_batches_do_not_change_the_result(spark):
    rows = corpus()
    assert got(spark, rows, batches=1) == got(spark, rows, batches=5, fanout=3) == brute(rows)


def test_empty_table(spark):
    assert got(spark, []) == []


def test_runs_are_levelled_and_disjoint(spark):
    index = RunIndex(spark, fanout=2, buckets=4)
    for batch in range(5):
        rows = spark.range(batch * 10, batch * 10 + 15).selectExpr("id h1", "id h2", "1L docs", "id last")
        index.add(index.unseen(rows))
    assert [len(level) for level in index.levels] == [1, 0, 1]
    held = sorted(r.h1 for r in index.rows().collect())
    assert held == list(range(55))
    index.drop()
