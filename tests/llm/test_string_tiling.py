"""Operator 10 against greedy string tiling by comparing all places."""

from __future__ import annotations

import random

import numpy as np

from ordermill.llm import string_tiling
from ordermill.llm.common import gram_hashes
from ordermill.llm.string_tiling import benchmark_matches, decontaminate, plain_words

DOCS = "doc_id long, text string, item_id string, coverage int"


def tiles(item, doc, least):
    marked_i, marked_d, out = [False] * len(item), [False] * len(doc), []
    while True:
        top, found = 0, []
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while (
                    i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n]
                    and not marked_i[i + n] and not marked_d[j + n]
                ):
                    n += 1
                if n > top:
                    top, found = n, []
                if n == top:
                    found.append((i, j))
        if top < least:
            return out
        for i, j in found:
            if not any(marked_i[i : i + top]) and not any(marked_d[j : j + top]):
                marked_i[i : i + top] = [True] * top
                marked_d[j : j + top] = [True] * top
                out.append((i, j, top))


def brute(docs, items, least=5, percent=60):
    out = []
    for doc, text in docs:
        for item, wanted in items:
            words = plain_words(wanted)
            if words:
                found = tiles(words, plain_words(text), min(least, len(words)))
                covered = sum(n for *_, n in found)
                if covered * 100 >= percent * len(words):
                    out.append((str(doc), str(item), len(words), covered, sorted(found)))
    return sorted(out)


def got(spark, docs, items):
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], DOCS)
    b = spark.createDataFrame(items, "item_id long, text string")
    rows = benchmark_matches(d, b).collect()
    kept = sorted((str(r.doc_id), r.text, r.item_id) for r in decontaminate(d, b).collect())
    hit = {(r.doc_id) for r in rows}
    assert kept == sorted((str(i), t, "x") for i, t in docs if i not in hit)
    return sorted(
        (str(r.doc_id), str(r.item_id), r.item_words, r.covered_words, sorted((t[0], t[1], t[2]) for t in r.tiles))
        for r in rows
    )


def corpus():
    rnd = random.Random(8)
    word = lambda: rnd.choice("alpha beta gamma delta eps zeta eta theta iota kappa lam mu".split())
    items = [(i, " ".join(word() for _ in range(rnd.randrange(8, 40)))) for i in range(12)]
    items += [(50, "One two three!"), (51, ""), (52, None), (53, items[0][1])]
    docs = []
    for i in range(40):
        text = [word() for _ in range(rnd.randrange(30))]
        for _ in range(rnd.randrange(3)):
            w = (rnd.choice(items)[1] or "").split()
            cut = rnd.randrange(len(w) + 1)
            pieces = [w[cut:], w[:cut]] if rnd.random() < 0.5 else [w[: cut + 5]]
            for piece in pieces:
                text += piece + [word() for _ in range(rnd.randrange(4))]
        docs.append((i, " ".join(text).title() + "."))
    docs += [(100, None), (101, ""), (102, "so one, two three go"), (103, "alpha " * 200), (104, items[1][1] * 2)]
    return docs, items


def test_equals_all_places(spark, monkeypatch):
    docs, items = corpus()
    want = brute(docs, items)
    assert len(want) > 20 and any(len(t) > 1 for *_, t in want)
    assert got(spark, docs, items) == want
    # A bitmap so small that it lets most strangers through changes nothing.
    monkeypatch.setattr(string_tiling, "BITMAP_BITS", (4, 4))
    assert got(spark, docs, items) == want


def test_bitmap_holds_every_seed(spark):
    rng = np.random.default_rng(3)
    seeds = np.r_[rng.integers(-(1 << 63), 1 << 63, 3000), [0, -1, 1, (1 << 63) - 1, -(1 << 63)]].astype(np.int64)
    bitmap, bits = string_tiling.seed_bitmap(spark.createDataFrame([(int(s),) for s in seeds], "seed long"))
    place = seeds.view(np.uint64) >> np.uint64(64 - bits)
    want = np.zeros(1 << bits, np.uint8)
    want[place] = 1
    assert bits == 22 and (np.unpackbits(bitmap, bitorder="little") == want).all()


def test_phrase_of_all_items_and_documents(spark):
    """A phrase that everything shares pairs nobody by itself; whole items are still found, also repeated words."""
    phrase = "which of the following is the best answer to"
    items = [(i, f"{phrase} " + " ".join(f"i{i}w{j}" for j in range(12))) for i in range(30)]
    items += [(90, "la " * 40), (91, phrase)]
    docs = [(i, f"{phrase} " + " ".join(f"d{i}w{j}" for j in range(20))) for i in range(60)]
    docs += [(100 + i, f"so {items[i][1]} yes") for i in range(30)] + [(200, "la " * 30), (201, "la " * 20)]
    assert got(spark, docs, items) == brute(docs, items)


def test_reordered_passage_is_found(spark):
    words = [f"w{i}" for i in range(30)]
    mixed = words[20:] + ["x"] + words[:10] + ["y"] + words[10:20]
    found = got(spark, [(1, " ".join(mixed)), (2, " ".join(reversed(words)))], [(9, " ".join(words))])
    assert [(f[0], f[3], len(f[4])) for f in found] == [("1", 30, 3)]


def test_empty_tables(spark):
    assert got(spark, [], [(1, "a b c d e f")]) == []
    assert got(spark, [(1, "a b c d e f")], []) == []


def test_running_hashes_tell_word_order():
    rng = np.random.default_rng(5)
    words = rng.integers(0, 1 << 63, 40).astype(np.uint64)
    for n in (1, 5, 6, 9, 40):
        hashes = gram_hashes(np.r_[words, words], n)
        assert len(hashes) == 81 - n
        assert (hashes[: 41 - n] == hashes[40 : 81 - n]).all() and len(set(hashes[:40].tolist())) == min(40, 81 - n)
    swapped = words[:6].copy()
    swapped[[0, 5]] = swapped[[5, 0]]
    assert gram_hashes(words[:6], 6) != gram_hashes(swapped, 6)
