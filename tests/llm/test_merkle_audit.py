"""Operator 1 against a record-by-record comparison."""

from __future__ import annotations

import random
from collections import defaultdict

from ordermill.llm.merkle_audit import audit, build_tree

SCHEMA = "file string, offset long, payload string, node string, hash int"


def brute(a, b):
    def held(rows):
        out = defaultdict(list)
        for file, offset, payload, *_ in rows:
            out[file or "", -1 if offset is None else offset].append(payload or "")
        return {k: sorted(v) for k, v in out.items()}

    x, y = held(a), held(b)
    return sorted(
        (*k, "missing" if k not in y else "extra" if k not in x else "corrupt") for k in x.keys() | y.keys() if x.get(k) != y.get(k)
    )


def got(spark, a, b, **kw):
    df = [spark.createDataFrame(rows, SCHEMA) for rows in (a, b)]
    return sorted((r.file, r.offset, r.status) for r in audit(*df, **kw).collect())


def archive(seed=1, files=4):
    rnd = random.Random(seed)
    rows = []
    for f in range(files):
        offset = 0
        for i in range(60):
            payload = f"record {f} {i} " + "é" * rnd.randrange(200)
            rows.append((f"f{f}", offset, payload, "n", 1))
            offset += len(payload.encode())
    return rows


def test_equals_comparison_of_all_records(spark):
    rnd = random.Random(2)
    a = archive()
    b = []
    for row in a:
        dice = rnd.random()
        if row[0] == "f1" or dice > 0.1:
            b.append(row)
        elif dice > 0.05:
            b.append((row[0], row[1], row[2] + "!", "n", 1))
    b += [("f9", 0, "new file", "n", 1), ("f2", 10_000_000, "far away", "n", 1), a[70], (None, None, None, "n", 1)]
    want = brute(a, b)
    assert len(want) > 10
    assert got(spark, a, b, range_bytes=256, fanout=3) == want
    assert got(spark, b, a, range_bytes=512, fanout=2) == brute(b, a)


def test_sound_replica_and_empty_tables(spark):
    a = archive()
    assert got(spark, a, list(reversed(a)), range_bytes=256, fanout=4) == []
    assert got(spark, [], []) == []
    assert got(spark, [], a[:3]) == brute([], a[:3])
    assert got(spark, a[:3], []) == brute(a[:3], [])


def test_repeated_records_count(spark):
    a = [("f", 0, "x", "n", 1), ("f", 0, "y", "n", 1), (None, 5, "", "n", 1)]
    assert got(spark, a, [a[1], a[0], (None, 5, None, "n", 1)]) == []
    assert got(spark, a, a + [a[0]]) == [("f", 0, "corrupt")]


def test_tree_has_one_root_per_file(spark):
    tree = build_tree(spark.createDataFrame(archive(), SCHEMA), 256, 4)
    sizes = [level.groupBy("file").count().agg({"count": "max"}).first()[0] for level in tree.levels]
    assert sizes[-1] == 1 and all(x > y for x, y in zip(sizes, sizes[1:]))
