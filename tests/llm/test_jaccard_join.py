"""Operator 2 against all pairs compared in plain Python."""

from __future__ import annotations

import random

import pytest

from ordermill.llm.jaccard_join import near_duplicates

SCHEMA = "doc_id long, text string, n long, key string"


def shingles(text):
    found = (text or "").encode().lower().split()
    if not found:
        return frozenset()
    k = min(5, len(found))
    return frozenset(tuple(found[i : i + k]) for i in range(len(found) - k + 1))


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted(
        (str(doc), len(sets[i]), str(least.get(find(i)) if sets[i] else doc)) for i, (doc, _) in enumerate(rows)
    )


def got(spark, rows):
    df = spark.createDataFrame([(d, t, 7, "x") for d, t in rows], SCHEMA)
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in near_duplicates(df).collect())


def corpus(seed, bases=12, copies=9, size=60):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdef") for _ in range(3))
    common = [word() for _ in range(30)]
    out = []
    for _ in range(bases):
        base = common[: rnd.randrange(30)] + [word() for _ in range(rnd.randrange(5, size))]
        for _ in range(copies):
            new = list(base)
            for _ in range(rnd.randrange(4)):
                new[rnd.randrange(len(new))] = word()
            out.append(" ".join(new))
    rnd.shuffle(out)
    return [(i * 3 + 1, t) for i, t in enumerate(out)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_pairs(spark, seed):
    rows = corpus(seed)
    assert got(spark, rows) == brute(rows)


def test_group_of_near_copies_and_edge_cases(spark):
    rnd = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        new = list(base)
        new[rnd.randrange(120)] = f"x{i}"
        rows.append((1000 - i, " ".join(new)))
    rows += [(5, None), (6, ""), (7, " \n\t"), (8, "One two"), (9, "one  TWO\n"), (9, "one two"), (None, "one two")]
    rows += [(None, "alone here"), (10, "É a b c d e"), (11, "é a b c d e"), (12, "long " * 50_000)]
    assert got(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert got(spark, []) == []
