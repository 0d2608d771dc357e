"""Cross-tokenizer alignment with token-byte incidence matrices.

Two tokenizers cut the same bytes. The incidence matrix of a tokenizer has a row
per token occurrence and a column per byte; row i holds the bytes that token i
covers. Matrices are compressed sparse rows built by hand (``Rows``), and
``row_products`` multiplies them row by row after Gustavson: each entry (i, k) of
the left matrix contributes row k of the right one to row i of the product.

* A x B-transposed counts the bytes two tokens share: the *overlap* links. Those
  whose tokens end at one byte are the *end* links; such bytes cut both token
  rows into groups.
* Group incidence (token x group) multiplied with the other side's transpose
  gives the *group* links: all pairs of a group.

``align_documents`` returns figures per document, ``link_counts`` the id pairs of
any kind of link with their number in the corpus.

Work is done per block of documents (``blocks``). A long text is worked on in
pieces cut before a single space between two other characters: both tokenizers
begin a token there. Pair counts are summed over blocks in Spark; each block then
meets only its own distinct pairs.

Defined cases: a null or empty text, or one that a tokenizer does not give back
byte for byte, has no tokens: zeros, and '' for the groups. Repeated rows and
repeated or null doc_ids give a row each. Strings of special tokens are plain
text. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from array import array
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .blocks import (
    arrow_schema, block_numbers, doc_texts, from_planes, gather, looked_up, one_row, planes, segment_sums,
    spans, text_blocks,
)
from .common import staged

#: How a byte-level vocabulary cuts text before merging (fixed value of the format).
BYTE_LEVEL_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
#: The piece vocabulary's sign for a space (fixed value of the format).
PIECE_SPACE = "▁"
#: Entries and bytes a worker's piece cache may hold before it starts anew.
CACHE_ENTRIES, CACHE_BYTES = 1 << 17, 8 << 20
#: Text that is worked on, and products that are expanded, at a time.
PIECE_BYTES, STEP = 1 << 18, 1 << 18
LINK_KINDS = ("overlap", "end", "group")


# ---- matrices ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Rows:
    """Compressed sparse rows: the columns of row i are cols[starts[i] : starts[i + 1]]."""

    starts: np.ndarray
    cols: np.ndarray
    width: int

    @classmethod
    def of_ends(cls, ends: np.ndarray) -> Rows:
        """Token x byte incidence of tokens that follow each other and end at ``ends``."""
        size = int(ends[-1]) if len(ends) else 0
        return cls(np.r_[0, ends], np.arange(size), size)

    @classmethod
    def of_labels(cls, labels: np.ndarray, width: int) -> Rows:
        """One entry a row, in column labels[row]."""
        return cls(np.arange(len(labels) + 1), labels, width)

    @property
    def height(self) -> int:
        return len(self.starts) - 1

    def transposed(self) -> Rows:
        rows = np.repeat(np.arange(self.height), np.diff(self.starts))
        if np.any(self.cols[1:] < self.cols[:-1]):
            rows = rows[np.argsort(self.cols, kind="stable")]
        return Rows(np.r_[0, np.cumsum(np.bincount(self.cols, minlength=self.width))], rows, self.height)


def row_products(left: Rows, right: Rows, step: int = STEP) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, column, value) of left x right, for consecutive rows of ``left`` at a time; about ``step`` products
    are expanded at once (a single row may have more)."""
    sizes = np.diff(right.starts)
    work = np.r_[0, np.cumsum(sizes[left.cols])][left.starts]
    first = 0
    while first < left.height:
        last = max(first + 1, int(np.searchsorted(work, work[first] + step, "right")) - 1)
        entries = left.cols[left.starts[first] : left.starts[last]]
        rows = np.repeat(np.arange(first, last), np.diff(left.starts[first : last + 1]))
        spread = sizes[entries]
        pairs = np.repeat(rows, spread) * right.width + right.cols[spans(right.starts[entries], spread)]
        if len(pairs):
            if np.any(pairs[1:] < pairs[:-1]):
                pairs = np.sort(pairs)
            new = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]])
            kept = pairs[new]
            yield kept // right.width, kept % right.width, np.diff(np.r_[new, len(pairs)])
        first = last


# ---- tokenizers -------------------------------------------------------------------------------


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable Latin-1 stands for itself, the other bytes, in
    order, for the characters from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    other = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(other)}}


class Vocabulary:
    """Bytes of each token id as one flat table, and texts to ids.

    A text with a space before it is encoded run by run: a run is a space and what follows up to the next place
    where tokens always begin anew (``runs``). Each distinct run is encoded once, in a cache of bounded size.
    """

    def __init__(self, tokens: dict[int, bytes]):
        size = max(tokens, default=-1) + 1
        self.lengths = np.array([len(tokens.get(i, b"")) for i in range(size)], np.int64)
        self.flat = np.frombuffer(b"".join(tokens.get(i, b"") for i in range(size)), np.uint8)
        self.starts = np.r_[0, np.cumsum(self.lengths)]
        self._renew()

    def _renew(self) -> None:
        self.places: defaultdict[str, int] = defaultdict(itertools.count().__next__)
        self.ids, self.bounds, self.held = array("i"), array("q", [0]), 0

    def runs(self, text: str) -> list[str]:
        """The runs of space + text, each without its first space."""
        raise NotImplementedError

    def encode_runs(self, runs: list[str]) -> list[list[int]]:
        """Ids of space + run for each run."""
        raise NotImplementedError

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with a space before it, and the number of each text's ids."""
        if len(self.places) > CACHE_ENTRIES or self.held > CACHE_BYTES:
            self._renew()
        known = len(self.places)
        rows = [list(map(self.places.__getitem__, self.runs(t))) for t in texts]
        if len(self.places) > known:
            new = list(itertools.islice(self.places, known, None))
            self.held += sum(map(len, new))
            for ids in self.encode_runs(new):
                self.ids.extend(ids)
                self.bounds.append(len(self.ids))
            self.run_ids, self.run_starts = np.array(self.ids), np.array(self.bounds)
        run = np.fromiter(itertools.chain.from_iterable(rows), np.int64)
        of_text = np.repeat(np.arange(len(texts)), [len(r) for r in rows])
        sizes = segment_sums(self.run_starts[run + 1] - self.run_starts[run], of_text, len(texts))
        return gather(self.run_ids, self.run_starts, run).astype(np.int64), sizes


class ByteLevel(Vocabulary):
    """A byte-level BPE vocabulary (JSON). Ids follow the order of merges, so they are the ranks. A token begins
    at each space between two characters that are no white space; a text with more than one white space character
    together, or any at its ends, is one run."""

    def __init__(self, spec: bytes):
        import tiktoken

        parsed = json.loads(spec)
        special = {t["content"] for t in parsed.get("added_tokens", [])}
        alphabet = byte_alphabet()
        ranks = {
            bytes(alphabet[c] for c in token): i for token, i in parsed["model"]["vocab"].items() if token not in special
        }
        self.encoding = tiktoken.Encoding(
            "byte-level", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        super().__init__({i: token for token, i in ranks.items()})

    def runs(self, text: str) -> list[str]:
        single = len(" ".join(text.split())) == len(text)
        return text.split(" ") if single else [text]

    def encode_runs(self, runs: list[str]) -> list[list[int]]:
        return [self.encoding.encode_ordinary(" " + run) for run in runs]


class Pieces(Vocabulary):
    """A piece vocabulary with byte fallback whose pieces hold spaces only in front, which ``__init__`` checks: a
    token begins at the first space after any other character."""

    SEVERAL = re.compile(" +[^ ]+| +$")

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        tokens = {}
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            if re.search(f"[^{PIECE_SPACE}]{PIECE_SPACE}", piece):
                raise ValueError(f"piece {i} holds a space after other characters")
            if self.model.is_byte(i):
                tokens[i] = bytes([int(piece[3:5], 16)])
            else:
                tokens[i] = piece.replace(PIECE_SPACE, " ").encode()
        super().__init__(tokens)

    def runs(self, text: str) -> list[str]:
        parts = text.split(" ")
        return [run[1:] for run in self.SEVERAL.findall(" " + text)] if "" in parts else parts

    def encode_runs(self, runs: list[str]) -> list[list[int]]:
        # The model puts the space before a text itself, but not before an empty one.
        alone = [self.model.piece_to_id(PIECE_SPACE)]
        return [ids if run else alone for run, ids in zip(runs, self.model.encode(runs, num_threads=1))]


def pieces(text: str, most: int = PIECE_BYTES) -> Iterator[str]:
    """Space + text in pieces of about ``most`` characters, each without its first space. A piece ends before a
    space that stands between two characters that are no white space."""
    cut = re.compile(r"(?<=\S) (?=\S)")
    first = 0
    while len(text) - first > most:
        found = cut.search(text, first + most)
        if not found:
            break
        yield text[first : found.start()]
        first = found.end()
    yield text[first:]


# ---- one batch of pieces ----------------------------------------------------------------------


@dataclass
class Aligned:
    """Tokens of the texts of a batch that both vocabularies give back byte for byte."""

    whole: np.ndarray
    #: Per side: token ids, text of each token, global byte end of each token.
    a: tuple[np.ndarray, np.ndarray, np.ndarray]
    b: tuple[np.ndarray, np.ndarray, np.ndarray]

    def overlaps(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        yield from row_products(Rows.of_ends(self.a[2]), Rows.of_ends(self.b[2]).transposed())

    def ends(self) -> tuple[np.ndarray, np.ndarray]:
        """Token pairs (A, B) that end together, from the overlap links."""
        both = [(i[e], j[e]) for i, j, _ in self.overlaps() if (e := self.a[2][i] == self.b[2][j]) is not None]
        return tuple(np.concatenate([p[s] for p in both]) if both else np.empty(0, np.int64) for s in (0, 1))

    def groups(self, side: tuple, last: np.ndarray) -> np.ndarray:
        """Group of each token of a side; ``last`` are the tokens that end a group."""
        closed = np.zeros(len(side[0]), np.int64)
        closed[last] = 1
        return np.cumsum(closed) - closed

    def group_links(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        i, j = self.ends()
        left, right = self.groups(self.a, i), self.groups(self.b, j)
        yield from row_products(Rows.of_labels(left, len(i)), Rows.of_labels(right, len(j)).transposed())


def _kept(ids: np.ndarray, owner: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keep = whole[owner]
    return ids[keep], owner[keep]


def align(texts: list[str], a: ByteLevel, b: Pieces) -> Aligned:
    """Tokens of ``texts`` (each with a space before it) by both vocabularies."""
    n = len(texts)
    raw = [b" " + t.encode() for t in texts]
    want = np.array([len(r) for r in raw], np.int64)
    (ids_a, sizes_a), (ids_b, sizes_b) = a.encode(texts), b.encode(texts)
    own_a, own_b = np.repeat(np.arange(n), sizes_a), np.repeat(np.arange(n), sizes_b)
    whole = (segment_sums(a.lengths[ids_a], own_a, n) == want) & (segment_sums(b.lengths[ids_b], own_b, n) == want)
    owner = np.repeat(np.arange(n), want * whole)
    given = np.frombuffer(b"".join(r for r, w in zip(raw, whole) if w), np.uint8)
    ids_a, own_a = _kept(ids_a, own_a, whole)
    ids_b, own_b = _kept(ids_b, own_b, whole)
    differ = (gather(a.flat, a.starts, ids_a) != given) | (gather(b.flat, b.starts, ids_b) != given)
    if differ.any():
        whole = whole & (segment_sums(differ, owner, n) == 0)
        ids_a, own_a = _kept(ids_a, own_a, whole)
        ids_b, own_b = _kept(ids_b, own_b, whole)
    return Aligned(
        whole,
        (ids_a, own_a, np.cumsum(a.lengths[ids_a])),
        (ids_b, own_b, np.cumsum(b.lengths[ids_b])),
    )


class GroupText:
    """Groups of a batch written as ``a1,a2|b1;a3|b2,b3;``, from one table of id + separator texts."""

    def __init__(self, a: Vocabulary, b: Vocabulary):
        self.sizes = (len(a.lengths), len(b.lengths))
        cells = [f"{i}{end}".encode() for n, ends in zip(self.sizes, (",|", ",;")) for end in ends for i in range(n)]
        self.flat = np.frombuffer(b"".join(cells), np.uint8)
        self.starts = np.r_[0, np.cumsum([len(c) for c in cells])]

    def of(self, found: Aligned, i: np.ndarray, j: np.ndarray) -> list[bytes]:
        """One text per text of the batch, each group with its ``;``."""
        n_a, n_b = self.sizes
        group_a, group_b = found.groups(found.a, i), found.groups(found.b, j)
        code_a = found.a[0] + 0
        code_a[i] += n_a
        code_b = found.b[0] + 2 * n_a
        code_b[j] += n_b
        # Tokens of A stand before those of B in their group: j[g] + 1 B tokens lie in groups up to g, i[g] + 1 A tokens.
        before_b, up_to_a = np.r_[0, j + 1], i + 1
        order = np.empty(len(code_a) + len(code_b), np.int64)
        owner = np.empty(len(order), np.int64)
        place_a, place_b = np.arange(len(code_a)) + before_b[group_a], np.arange(len(code_b)) + up_to_a[group_b]
        order[place_a], order[place_b] = code_a, code_b
        owner[place_a], owner[place_b] = found.a[1], found.b[1]
        text = gather(self.flat, self.starts, order)
        sizes = segment_sums(self.starts[order + 1] - self.starts[order], owner, len(found.whole))
        ends = np.cumsum(sizes)
        return [text[e - s : e].tobytes() for s, e in zip(sizes.tolist(), ends.tolist())]


def _batches(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Pieces of texts that are not empty, with their text's place, about PIECE_BYTES at a time."""
    owners, held, total = [], [], 0
    for place, text in enumerate(texts):
        for piece in pieces(text) if text else ():
            owners.append(place)
            held.append(piece)
            total += len(piece)
            if total >= PIECE_BYTES:
                yield owners, held
                owners, held, total = [], [], 0
    if held:
        yield owners, held


# ---- over the corpus --------------------------------------------------------------------------

BLOCK_SCHEMA = (
    "block long, pairs array<long>, pair_links array<long>, doc_id array<long>, n_a array<long>, n_b array<long>,"
    " n_links array<long>, groups array<string>, doc_pairs array<int>, places binary, times binary"
)
RESULT_SCHEMA = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)
#: Bytes of a place among a block's pairs, and of how often a document holds one.
PLACE, TIMES = 4, 4


def _block_row(block: int, table: pa.Table, a: ByteLevel, b: Pieces, writer: GroupText) -> dict:
    """One block of documents as a row of BLOCK_SCHEMA."""
    texts = table.column("text").to_pylist()
    n = len(texts)
    whole = np.array([bool(t) for t in texts], bool)
    counts = {side: np.zeros(n, np.int64) for side in "ab"}
    digests: dict = {}
    pair_of, doc_of = [], []
    for owners, held in _batches(texts):
        found = align(held, a, b)
        place = np.array(owners)
        whole[place[~found.whole]] = False
        i, j = found.ends()
        for side, tokens in (("a", found.a), ("b", found.b)):
            counts[side] += np.bincount(place[tokens[1]], minlength=n)
        pair_of.append(found.a[0][i] << 32 | found.b[0][j])
        doc_of.append(place[found.a[1][i]])
        for p, text in zip(owners, writer.of(found, i, j)):
            if p in digests:
                digests[p].update(b";")
            else:
                digests[p] = hashlib.sha256()
            digests[p].update(text[:-1])
    pair, doc = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (pair_of, doc_of))
    kept = whole[doc]
    pair, doc = pair[kept], doc[kept]
    distinct, place = np.unique(pair, return_inverse=True)
    cells, times = np.unique(doc * max(1, len(distinct)) + place, return_counts=True)
    cell_doc, cell_place = np.divmod(cells, max(1, len(distinct)))
    return {
        "block": block,
        "pairs": distinct,
        "pair_links": np.bincount(place, minlength=len(distinct)),
        "doc_id": table.column("doc_id").to_pylist(),
        "n_a": counts["a"] * whole,
        "n_b": counts["b"] * whole,
        "n_links": np.bincount(doc, minlength=n),
        "groups": [digests[p].hexdigest() if w else "" for p, w in enumerate(whole.tolist())],
        "doc_pairs": np.bincount(cell_doc, minlength=n),
        "places": planes(cell_place, PLACE),
        "times": planes(times, TIMES),
    }


def _finish(block: pa.Table, found: pa.Table) -> pa.Table:
    """Figures of a block's documents, once the corpus-wide counts of its pairs are there."""
    schema = arrow_schema(RESULT_SCHEMA)
    if not block.num_rows:
        return schema.empty_table()
    row = {name: block.column(name)[0] for name in block.column_names if name != "block"}
    array = {name: np.asarray(row[name].values) for name in ("n_a", "n_b", "n_links", "doc_pairs")}
    place = found.column("place").to_numpy()
    links, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    links[place], best[place] = found.column("links").to_numpy(), found.column("best").to_numpy()
    cell, times = from_planes(row["places"].as_py(), PLACE), from_planes(row["times"].as_py(), TIMES)
    doc = np.repeat(np.arange(len(array["n_a"])), array["doc_pairs"])
    n = len(array["n_a"])
    return pa.table(
        {
            "doc_id": row["doc_id"].values,
            "n_a": array["n_a"],
            "n_b": array["n_b"],
            "n_groups": array["n_links"],
            "n_links": array["n_links"],
            "n_best": segment_sums(times * best[cell], doc, n),
            "count_sum": segment_sums(times * links[cell], doc, n),
            "groups_sha256": row["groups"].values,
        },
        schema=schema,
    )


def read_file(path: str) -> bytes:
    """A vocabulary file, read on the driver; its bytes travel with the tasks."""
    with open(path, "rb") as file:
        return file.read()


def align_documents(docs: DataFrame, byte_level: bytes, piece_model: bytes) -> DataFrame:
    """Per document doc_id, n_a, n_b, n_groups, n_links (pairs of tokens that end together), n_best (links whose
    id pair is the most frequent of its B id in the corpus), count_sum (corpus-wide counts of the links' id
    pairs) and groups_sha256."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = ByteLevel(byte_level), Pieces(piece_model)
        writer, schema = GroupText(a, b), arrow_schema(BLOCK_SCHEMA)
        for number, table in zip(block_numbers(), text_blocks(batches)):
            yield one_row(_block_row(number, table, a, b, writer), schema)

    held = staged(doc_texts(docs).mapInArrow(blocks, BLOCK_SCHEMA), "aligned-blocks")
    counts = (
        held.select(F.explode(F.arrays_zip("pairs", "pair_links")).alias("p"))
        .groupBy(F.col("p.pairs").alias("pair"))
        .agg(F.sum("p.pair_links").alias("links"))
    )
    of_b = Window.partitionBy(F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)))
    best = (F.col("links") == F.max("links").over(of_b)).cast("long").alias("best")
    table = staged(counts.select("pair", "links", best), "pair-counts")
    return looked_up(held.drop("pair_links"), "pairs", table, "pair", _finish, RESULT_SCHEMA)


def link_counts(docs: DataFrame, byte_level: bytes, piece_model: bytes, kind: str = "end") -> DataFrame:
    """a_id, b_id, n_links: how often the corpus links the id pair; ``kind`` is 'overlap' (the tokens share
    bytes), 'end' (they end at one byte) or 'group' (no common end lies between them)."""
    if kind not in LINK_KINDS:
        raise ValueError(f"kind is one of {LINK_KINDS}")

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = ByteLevel(byte_level), Pieces(piece_model)
        for table in text_blocks(batches):
            texts = table.column("text").to_pylist()
            lost = {p for owners, held in _batches(texts) for p, w in zip(owners, align(held, a, b).whole) if not w}
            for _, held in _batches(["" if p in lost else t for p, t in enumerate(texts)]):
                found = align(held, a, b)
                if kind == "end":
                    parts = [found.ends()]
                else:
                    parts = [p[:2] for p in (found.overlaps() if kind == "overlap" else found.group_links())]
                for i, j in parts:
                    pairs, times = np.unique(found.a[0][i] << 32 | found.b[0][j], return_counts=True)
                    yield pa.RecordBatch.from_pydict({"pair": pairs, "n": times})

    pair = F.col("pair")
    summed = doc_texts(docs).mapInArrow(links, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n_links"))
    return summed.select(
        F.shiftright(pair, 32).alias("a_id"), pair.bitwiseAND(F.lit((1 << 32) - 1)).alias("b_id"), "n_links"
    )
