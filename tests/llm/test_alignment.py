"""Cross-tokenizer alignment against plain Python over whole-text encodings of both libraries."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ordermill.llm import alignment as al
from ordermill.llm.queries import TOKENIZERS, op13_tokenizer_alignment

SIGN = "▁"
FILES = [al.read_file(path) for path in TOKENIZERS]


@pytest.fixture(scope="module")
def plain():
    """text -> (A ids and bytes, B ids and bytes), whole texts by the libraries' own encoders."""
    left = Tokenizer.from_str(FILES[0].decode())
    left.encode_special_tokens = True
    right = sentencepiece.SentencePieceProcessor(model_proto=FILES[1])
    alphabet = al.byte_alphabet()

    def both(text):
        a = left.encode(" " + text, add_special_tokens=False)
        b = right.encode(text)
        bytes_a = [bytes(alphabet[c] for c in left.id_to_token(i)) for i in a.ids]
        bytes_b = [
            bytes([int(right.id_to_piece(i)[3:5], 16)])
            if right.is_byte(i)
            else right.id_to_piece(i).replace(SIGN, " ").encode()
            for i in b
        ]
        return (a.ids, bytes_a), (b, bytes_b)

    return both


def _ends(tokens):
    return np.cumsum([len(t) for t in tokens]).tolist()


def _aligned(text, both):
    """Groups of a text and its end links, or nothing."""
    if not text:
        return None
    (ids_a, bytes_a), (ids_b, bytes_b) = both(text)
    raw = b" " + text.encode()
    if b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
        return None
    ends_a, ends_b = _ends(bytes_a), _ends(bytes_b)
    common = sorted(set(ends_a) & set(ends_b))
    groups, i, j = [], 0, 0
    for end in common:
        p, q = ends_a.index(end) + 1, ends_b.index(end) + 1
        groups.append((ids_a[i:p], ids_b[j:q]))
        i, j = p, q
    return groups


def brute(rows, both):
    found = [(doc, _aligned(text, both)) for doc, text in rows]
    count = Counter((g[0][-1], g[1][-1]) for _, groups in found for g in groups or ())
    best = Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    out = []
    for doc, groups in found:
        links = [(g[0][-1], g[1][-1]) for g in groups or ()]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups or ())
        out.append(
            (
                doc, sum(len(a) for a, _ in groups or ()), sum(len(b) for _, b in groups or ()), len(links), len(links),
                sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links),
                hashlib.sha256(text.encode()).hexdigest() if groups else "",
            )
        )
    return sorted(out, key=str)


TEXTS = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "a  b", "x\n  y \n\n z", "tab\t\ttab", "it's <s> </s> <unk> <|endoftext|> <0x41>",
    "déjà vu, naïve — 漢字と仮名", "emoji 🙂🙂‍↔️ é", "\x00\x01 ctl", f"sign {SIGN} of {SIGN}space", "aaaaaaaaaaaaaaaaaaaaaaa",
    "12345 67.89 1e-5", "same text of many words again and again", "same text of many words again and again",
    " line  no-break　wide", "word " * 40, ("long words of a long text, " * 50).strip(), "Ünïcode " * 9,
    "漢字" * 200, "a\u0085b \u0085 c", "end.  ", "\x1c x \x1f\x1fy",
]


def test_figures_equal_brute_force(spark, plain):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "a null id"), ((1 << 62) + 1, "a large id"), (5, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = al.align_documents(docs.selectExpr("*", "1 as block", "2 as pairs", "doc_id as n_a"), *FILES)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, plain)


def test_pieces_and_small_caches_change_nothing(plain, monkeypatch):
    import pyarrow as pa

    texts = [t for t in TEXTS if t] + [" ".join(t for t in TEXTS if t)]
    table = pa.table({"doc_id": list(range(len(texts))), "text": texts})
    a, b = al.ByteLevel(FILES[0]), al.Pieces(FILES[1])
    whole = al._block_row(0, table, a, b, al.GroupText(a, b))
    monkeypatch.setattr(al, "PIECE_BYTES", 16)
    monkeypatch.setattr(al.pieces, "__defaults__", (16,))
    monkeypatch.setattr(al, "CACHE_ENTRIES", 3)
    monkeypatch.setattr(al, "STEP", 7)
    cut = al._block_row(0, table, a, b, al.GroupText(a, b))
    assert max(map(len, al.pieces(texts[-1], 16))) < len(texts[-1])
    for name, value in whole.items():
        assert np.array_equal(np.asarray(value), np.asarray(cut[name])), name


def test_link_counts(spark, plain):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {kind: Counter() for kind in al.LINK_KINDS}
    for text in TEXTS:
        groups = _aligned(text, plain)
        if groups is None:
            continue
        (ids_a, bytes_a), (ids_b, bytes_b) = plain(text)
        ends_a, ends_b = _ends(bytes_a), _ends(bytes_b)
        for i, (x, e) in enumerate(zip(ids_a, ends_a)):
            for j, (y, f) in enumerate(zip(ids_b, ends_b)):
                if max(e - len(bytes_a[i]), f - len(bytes_b[j])) < min(e, f):
                    want["overlap"][x, y] += 1
                if e == f:
                    want["end"][x, y] += 1
        for left, right in groups:
            want["group"].update((x, y) for x in left for y in right)
    for kind in al.LINK_KINDS:
        got = {(r.a_id, r.b_id): r.n_links for r in al.link_counts(docs, *FILES, kind).collect()}
        assert got == want[kind], kind


def test_row_products_equal_dense_products():
    rng = np.random.default_rng(3)
    left, right = (rng.random((9, 7)) < 0.4).astype(int), (rng.random((7, 8)) < 0.4).astype(int)

    def rows(dense):
        starts = np.r_[0, np.cumsum(dense.sum(1))]
        return al.Rows(starts, np.nonzero(dense)[1], dense.shape[1])

    for step in (1, 5, 1000):
        out = np.zeros((9, 8), int)
        for i, j, n in al.row_products(rows(left), rows(right), step):
            out[i, j] += n
        assert (out == left @ right).all()
    back = rows(left).transposed()
    dense = np.zeros((7, 9), int)
    dense[np.repeat(np.arange(7), np.diff(back.starts)), back.cols] = 1
    assert (dense == left.T).all()


def test_empty_table(spark):
    assert al.align_documents(spark.createDataFrame([], "doc_id long, text string"), *FILES).count() == 0


def test_query_over_the_documents(spark, plain):
    got = op13_tokenizer_alignment(spark, "/root/testdata/sf0.001")
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, plain)
