"""Language-model scoring with a log-bilinear model trained by noise-contrastive estimation.

**Counts.** A token's count over the training texts, their sum N and the number
V of distinct ones come from all training texts, in Spark; the base score uses
them directly. No word is left out, however rare.

**Model.** The neural part predicts *units*: the most frequent words are units of
their own, every other word belongs to the unit of its ending (``classes``
units, by the CRC-32 of its last three bytes), and the end of a text is a unit.
From the two units before, q = c1 * r[u1] + c2 * r[u2] (vectors, elementwise), and
unit u gets the score q . w[u] + b[u]. Inside its unit a word has the smoothed
share of its own count: P(word | context) = P(unit | context) * P(word | unit).
These sum to one over all words and one unseen word per ending. ``UNITS`` and
``DIMENSIONS`` are the model's size, like the number of weights of a classifier.

**Training.** Noise-contrastive estimation in numpy: a batch of positions shares
``NOISE`` units drawn from the unit counts, and a logistic loss parts the true
unit from them, so no normaliser is needed while learning. Biases start at the
log shares, that is, at the unigram model. Each task trains on the blocks it
holds, in one pass over all its training tokens; the tasks' models are averaged
by tokens, in ``rounds`` rounds, each over its own part of the blocks.

**Scoring.** For contexts that a task has not met yet, batched matrix products
give the scores of all units, so the normaliser is exact; it is kept in a table of
the model's size. Log-probabilities are natural inside and base 10 outside.

**At scale.** Texts become rows of blocks (``blocks``); a block's distinct words
meet the counts once. Later passes read unit numbers only. What is collected is
bounded by the model's size: unit counts, and one averaged model per reducer.

Defined cases: a null or empty text is the end token alone. Without training
texts all counts are zero and the model is uniform. Repeated rows and repeated
or null doc_ids give a row each; a null doc_id counts as empty text in the
crc32. Other columns are ignored. An empty table gives an empty result. Tied
counts are ordered by the word's bytes.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import PIECE_BYTES, arrow_schema, block_numbers, from_planes, looked_up, one_row, planes, segment_sums
from .blocks import text_blocks
from .common import staged

#: Units that are words of their own, units of endings (one more is the end), and length of a unit's vector.
WORDS, CLASSES, DIMENSIONS = 511, 512, 16
#: Positions of a batch, noise units of a batch, step size.
BATCH, NOISE, RATE = 1024, 32, 0.2
#: Contexts whose unit scores are worked out at a time; positions a task trains on, or scores, at a time.
CONTEXTS, POSITIONS = 512, 1 << 18
#: Reducers of the tasks' models.
REDUCERS = 16
#: Text bytes of a block: larger ones repeat fewer words.
WORD_BLOCK = 8 << 20
#: Bytes at a word's end that name its class.
ENDING = 3
SMOOTH = 0.1
LOG10 = float(np.log(10.0))


@dataclass
class Model:
    """c (2 x d), r (units + 1 x d; the last is the start of a text), w (units x d), b (units)."""

    c: np.ndarray
    r: np.ndarray
    w: np.ndarray
    b: np.ndarray

    @classmethod
    def unigram(cls, counts: np.ndarray, d: int, seed: int = 1) -> Model:
        """Random small vectors, biases of the smoothed unit shares."""
        random, units = np.random.default_rng(seed), len(counts)
        share = (counts + SMOOTH) / (counts + SMOOTH).sum()
        r = random.normal(0, 0.3, (units + 1, d)).astype(np.float32)
        c = np.ones((2, d), np.float32)
        return cls(c, r, np.zeros((units, d), np.float32), np.log(share).astype(np.float32))

    def parts(self) -> list[np.ndarray]:
        return [self.c, self.r, self.w, self.b]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def like(self, flat: np.ndarray) -> Model:
        out, at = [], 0
        for p in self.parts():
            out.append(flat[at : at + p.size].reshape(p.shape).astype(np.float32))
            at += p.size
        return Model(*out)

    def predicted(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        return self.c[0] * self.r[first] + self.c[1] * self.r[second]

    def log_normaliser(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """log of the sum over all units of exp(score), per context."""
        out = np.empty(len(first), np.float64)
        for at in range(0, len(first), CONTEXTS):
            part = slice(at, at + CONTEXTS)
            scores = self.predicted(first[part], second[part]) @ self.w.T
            scores += self.b
            top = scores.max(1, keepdims=True)
            scores -= top
            out[part] = top[:, 0] + np.log(np.exp(scores, out=scores).sum(1))
        return out


class Scorer:
    """Exact log-probabilities; the normaliser of each context is worked out once and kept in a table of the
    model's own size (contexts are pairs of units)."""

    def __init__(self, model: Model):
        self.model, self.side = model, len(model.r)
        self.known = np.full(self.side**2, np.nan)

    def log_probabilities(self, unit: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Natural log-probability of each unit after its two units before (``first`` is the nearer one)."""
        model, context = self.model, first.astype(np.int64) * self.side + second
        z = self.known[context]
        unknown = np.unique(context[np.isnan(z)])
        if len(unknown):
            self.known[unknown] = model.log_normaliser(unknown // self.side, unknown % self.side)
            z = self.known[context]
        out = np.empty(len(unit), np.float64)
        for at in range(0, len(unit), 1 << 14):
            part = slice(at, at + (1 << 14))
            q = model.predicted(first[part], second[part])
            out[part] = np.einsum("ij,ij->i", q, model.w[unit[part]]) + model.b[unit[part]]
        return out - z


def contexts(units: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The unit before each position and the one before that; ``end`` + 1 stands for the start of a text."""
    start = end + 1
    first = np.r_[start, units[:-1]]
    first[first == end] = start
    second = np.r_[start, first[:-1]]
    second[first == start] = start
    return first, second


class Trainer:
    """Adagrad on the noise-contrastive loss of one task's batches."""

    def __init__(self, model: Model, noise_share: np.ndarray, seed: int):
        self.model = Model(*[p.copy() for p in model.parts()])
        self.seen = [np.full(p.shape if p.ndim == 1 else p.shape[:1], 1e-2, np.float32) for p in model.parts()]
        self.log_noise = np.log(noise_share).astype(np.float32) + np.float32(np.log(NOISE))
        self.upto = np.cumsum(noise_share)
        self.random = np.random.default_rng(seed)
        self.tokens = 0

    def _step(self, part: int, rows, gradient: np.ndarray) -> None:
        """Adagrad with one step size a row."""
        target, seen = self.model.parts()[part], self.seen[part]
        square = gradient**2 if gradient.ndim == 1 else (gradient**2).mean(1)
        seen[rows] += square
        scale = RATE / np.sqrt(seen[rows])
        target[rows] -= gradient * (scale if gradient.ndim == 1 else scale[:, None])

    @staticmethod
    def _summed(rows: np.ndarray, gradient: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct rows and the sum of the gradients of each."""
        order = np.argsort(rows, kind="stable")
        ordered = rows[order]
        first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
        return ordered[first], np.add.reduceat(gradient[order], first, axis=0)

    def batch(self, unit: np.ndarray, first: np.ndarray, second: np.ndarray) -> None:
        m = self.model
        noise = np.searchsorted(self.upto, self.random.random(NOISE) * self.upto[-1]).clip(max=len(self.upto) - 1)
        r1, r2 = m.r[first], m.r[second]
        q = m.c[0] * r1 + m.c[1] * r2
        w_true, w_noise = m.w[unit], m.w[noise]
        true = np.einsum("ij,ij->i", q, w_true) + m.b[unit] - self.log_noise[unit]
        false = q @ w_noise.T + (m.b[noise] - self.log_noise[noise])
        # Loss: -log s(true) - sum log s(-false), averaged over the batch.
        size = np.float32(1 / len(unit))
        g_true = -size / (1 + np.exp(np.clip(true, -30, 30)))
        g_false = size / (1 + np.exp(-np.clip(false, -30, 30)))
        g_q = g_true[:, None] * w_true + g_false @ w_noise
        # The bias goes along as one more column.
        q_one = np.hstack([q, np.ones((len(q), 1), np.float32)])
        rows, g_wb = self._summed(np.r_[unit, noise], np.vstack([g_true[:, None] * q_one, g_false.T @ q_one]))
        rows_r, g_r = self._summed(np.r_[first, second], np.vstack([g_q * m.c[0], g_q * m.c[1]]))
        g_c = np.stack([(g_q * r1).sum(0), (g_q * r2).sum(0)])
        self._step(0, np.arange(2), g_c)
        self._step(1, rows_r, g_r)
        self._step(2, rows, g_wb[:, :-1])
        self._step(3, rows, g_wb[:, -1])
        self.tokens += len(unit)

    def pass_over(self, unit: np.ndarray, first: np.ndarray, second: np.ndarray) -> None:
        order = self.random.permutation(len(unit))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            self.batch(unit[some], first[some], second[some])


# ---- texts to units -----------------------------------------------------------------------------

WORDS_SCHEMA = (
    "block long, words array<binary>, learned array<long>, classes binary, doc_id array<long>, held_out array<boolean>,"
    " n_words array<long>, places binary, n_learned long"
)
UNITS_SCHEMA = (
    "part int, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, inner double, units binary"
)
SCORE_SCHEMA = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def ending_class(word: bytes) -> int:
    return zlib.crc32(word[-ENDING:]) % CLASSES


#: ``ending_class`` of the binary column ``word``.
ENDING_CLASS = f"cast(crc32(substr(word, greatest(octet_length(word) - {ENDING - 1}, 1), {ENDING})) % {CLASSES} as int)"


def _pieces(text: bytes, most: int = PIECE_BYTES) -> Iterator[bytes]:
    """A text cut at white space into pieces of about ``most`` bytes."""
    first = 0
    while len(text) - first > most:
        found = _SPACE.search(text, first + most)
        if not found:
            break
        yield text[first : found.start()]
        first = found.end()
    yield text[first:]


def _block_row(block: int, table: pa.Table) -> dict:
    """A block's documents as places in the list of its distinct words, the most frequent first."""
    found: defaultdict[bytes, int] = defaultdict(itertools.count().__next__)
    rows, sizes = [], []
    for text in table.column("text").to_pylist():
        size = 0
        for piece in _pieces(text.encode().lower()):
            some = np.fromiter(map(found.__getitem__, piece.split()), np.int64)
            rows.append(some)
            size += len(some)
        sizes.append(size)
    places = np.concatenate(rows) if rows else np.empty(0, np.int64)
    learn = np.asarray(table.column("learn")).astype(bool)
    order = np.argsort(-np.bincount(places, minlength=len(found)), kind="stable")
    rank = np.empty(len(found), np.int64)
    rank[order] = np.arange(len(found))
    places = rank[places]
    listed = list(found)
    words = [listed[i] for i in order.tolist()]
    return {
        "block": block,
        "words": words,
        "learned": np.bincount(places[np.repeat(learn, sizes)], minlength=len(words)),
        "classes": planes(np.array([ending_class(w) for w in words], np.int64), 2),
        "doc_id": table.column("doc_id").to_pylist(),
        "held_out": ~learn,
        "n_words": sizes,
        "places": planes(places, 4),
        "n_learned": int(learn.sum()),
    }


@dataclass
class Counts:
    """What scoring needs beside a word's own count."""

    tokens: int
    distinct: int
    #: Training tokens and distinct words of each class, and training tokens of each unit.
    class_tokens: np.ndarray
    class_words: np.ndarray
    units: np.ndarray

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + SMOOTH) / (self.tokens + SMOOTH * (self.distinct + 1)))

    def inner(self, count: np.ndarray, unit: np.ndarray) -> np.ndarray:
        """log10 of a word's share of its unit: 0 for units that are words."""
        out, of = np.zeros(len(unit)), unit - WORDS
        some = np.flatnonzero((of >= 0) & (of < CLASSES))
        of = of[some]
        out[some] = np.log10((count[some] + SMOOTH) / (self.class_tokens[of] + SMOOTH * (self.class_words[of] + 1)))
        return out


def _encoder(counts: Counts, rounds: int):
    schema, end = arrow_schema(UNITS_SCHEMA), WORDS + CLASSES
    end_count = np.array([counts.units[end]])

    def finish(block: pa.Table, found: pa.Table) -> pa.Table:
        """A block's documents as units, with what does not depend on the model summed."""
        if not block.num_rows:
            return schema.empty_table()
        row = {name: block.column(name)[0] for name in block.column_names}
        unit = WORDS + from_planes(row["classes"].as_py(), 2)
        count = np.zeros(len(unit), np.int64)
        place = found.column("place").to_numpy()
        count[place] = found.column("n").to_numpy()
        head = found.column("unit").to_numpy()
        unit[place[head >= 0]] = head[head >= 0]
        size = np.asarray(row["n_words"].values)
        n = len(size)
        places, doc = from_planes(row["places"].as_py(), 4), np.repeat(np.arange(n), size)
        base = np.bincount(doc, counts.base(count)[places], n) + counts.base(end_count)[0]
        all_units = np.full(len(places) + n, end, np.int64)
        all_units[np.arange(len(places)) + doc] = unit[places]
        stop = np.cumsum(size + 1)
        return pa.table(
            {
                "part": np.full(n, (row["block"].as_py() ^ row["block"].as_py() >> 32) % rounds, np.int32),
                "doc_id": row["doc_id"].values,
                "held_out": row["held_out"].values,
                "n_tokens": size + 1,
                "n_known": segment_sums((count > 0)[places], doc, n) + int(end_count[0] > 0),
                "base_score": base,
                "inner": np.bincount(doc, counts.inner(count, unit)[places], n),
                "units": [planes(all_units[e - s : e], 2) for s, e in zip((size + 1).tolist(), stop.tolist())],
            },
            schema=schema,
        )

    return finish


def _unit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Documents in tables of about POSITIONS positions, with all their units in one array."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        ends = np.cumsum(np.asarray(batch.column("n_tokens")))
        first = 0
        while first < batch.num_rows:
            goal = (ends[first - 1] if first else 0) + POSITIONS
            last = max(first + 1, int(np.searchsorted(ends, goal, "right")))
            held.append(batch.slice(first, last - first))
            if sum(int(np.asarray(b.column("n_tokens")).sum()) for b in held) >= POSITIONS // 2:
                yield _joined(held)
                held = []
            first = last
    if held:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> tuple[pa.Table, np.ndarray]:
    table = pa.Table.from_batches(held)
    return table, np.concatenate([from_planes(u, 2) for u in table.column("units").to_pylist()])


def corpus_counts(blocks: DataFrame) -> tuple[Counts, DataFrame]:
    """Sums over the training texts, and a table (word, n, unit) of all their words; unit is -1 for words that
    are not units of their own."""
    cells = blocks.select(F.explode(F.arrays_zip("words", "learned")).alias("c"))
    counted = (
        cells.filter("c.learned > 0").groupBy(F.col("c.words").alias("word")).agg(F.sum("c.learned").alias("n"))
    )
    counted = staged(counted, "token-counts")
    spark = blocks.sparkSession
    # At most WORDS rows.
    head = counted.orderBy(F.desc("n"), "word").limit(WORDS).collect()
    own = spark.createDataFrame([(bytes(r.word), i) for i, r in enumerate(head)], "word binary, unit int")
    table = counted.join(F.broadcast(own), "word", "left").withColumn("unit", F.coalesce("unit", F.lit(-1)))
    texts = blocks.agg(F.sum("n_learned").alias("n")).first().n or 0
    # At most CLASSES + 1 rows.
    of_class = F.when(F.col("unit") < 0, F.expr(ENDING_CLASS)).otherwise(-1).alias("class")
    sums = table.groupBy(of_class).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect()
    class_tokens, class_words = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for r in sums:
        if r["class"] >= 0:
            class_tokens[r["class"]], class_words[r["class"]] = r.n, r.words
    words = np.zeros(WORDS, np.int64)
    words[: len(head)] = [r.n for r in head]
    counts = Counts(
        sum(r.n for r in sums) + texts,
        sum(r.words for r in sums) + int(texts > 0),
        class_tokens,
        class_words,
        np.r_[words, class_tokens, texts],
    )
    return counts, table


def encoded(docs: DataFrame, learn: Column, rounds: int) -> tuple[Counts, DataFrame]:
    """Counts, and one row of UNITS_SCHEMA per document."""
    schema = arrow_schema(WORDS_SCHEMA)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, table in zip(block_numbers(), text_blocks(batches, WORD_BLOCK)):
            yield one_row(_block_row(number, table), schema)

    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).withColumn("learn", F.coalesce(learn, F.lit(False)))
    held = staged(texts.mapInArrow(blocks, WORDS_SCHEMA), "word-blocks")
    counts, table = corpus_counts(held)
    units = looked_up(held.drop("learned", "n_learned"), "words", table, "word", _encoder(counts, rounds), UNITS_SCHEMA)
    return counts, staged(units, "unit-documents")


# ---- training and scoring -----------------------------------------------------------------------


def _averaged(spark, partials: DataFrame) -> tuple[np.ndarray, int] | None:
    """Token-weighted mean of the tasks' models: summed by REDUCERS tasks, then on the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, tokens = None, 0
        for batch in batches:
            for n, model in zip(batch.column("tokens").to_pylist(), batch.column("model").to_pylist()):
                one = np.frombuffer(model, np.float64)
                total, tokens = (one if total is None else total + one), tokens + n
        if tokens:
            yield pa.RecordBatch.from_pydict({"tokens": [tokens], "model": [total.tobytes()]})

    rows = partials.repartition(REDUCERS, "task").drop("task").mapInArrow(add, "tokens long, model binary").collect()
    tokens = sum(r.tokens for r in rows)
    if not tokens:
        return None
    rows = sorted(rows, key=lambda r: bytes(r.model))
    return sum(np.frombuffer(r.model, np.float64) for r in rows) / tokens, tokens


def train(units: DataFrame, counts: Counts, rounds: int) -> Model:
    """The model after one pass over the training texts: ``rounds`` rounds of averaged local training."""
    end = WORDS + CLASSES
    model = Model.unigram(counts.units, DIMENSIONS)
    noise = (counts.units + SMOOTH) / (counts.units + SMOOTH).sum()
    for number in range(rounds):

        def learn(batches: Iterator[pa.RecordBatch], model: Model = model) -> Iterator[pa.RecordBatch]:
            trainer = None
            for table, row in _unit_batches(batches):
                if trainer is None:
                    trainer = Trainer(model, noise, zlib.crc32(row.tobytes()))
                trainer.pass_over(row, *contexts(row, end))
            if trainer is not None:
                whole = (trainer.model.flat().astype(np.float64) * trainer.tokens).tobytes()
                task = zlib.crc32(whole) & 0x7FFFFFFF
                yield pa.RecordBatch.from_pydict(
                    {"task": pa.array([task], pa.int32()), "tokens": [trainer.tokens], "model": [whole]}
                )

        part = units.filter(~F.col("held_out") & (F.col("part") == number)).select("n_tokens", "units")
        found = _averaged(units.sparkSession, part.mapInArrow(learn, "task int, tokens long, model binary"))
        if found:
            model = model.like(found[0])
    return model


def score(units: DataFrame, counts: Counts, model: Model) -> DataFrame:
    schema, end = arrow_schema(SCORE_SCHEMA), WORDS + CLASSES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for table, row in _unit_batches(batches):
            size = np.asarray(table.column("n_tokens"))
            natural = scorer.log_probabilities(row, *contexts(row, end))
            of_doc = np.bincount(np.repeat(np.arange(len(size)), size), natural, len(size))
            out = table.append_column("train_tokens", pa.array(np.full(len(size), counts.tokens)))
            out = out.append_column("score", pa.array(of_doc / LOG10 + np.asarray(table.column("inner"))))
            yield from out.select(schema.names).cast(schema).to_batches()

    kept = units.drop("part")
    return kept.mapInArrow(run, SCORE_SCHEMA)


def score_documents(docs: DataFrame, learn: Column, rounds: int = 3) -> DataFrame:
    """Per document doc_id, held_out (not ``learn``, a condition on doc_id), n_tokens, n_known, train_tokens,
    base_score (unigrams) and score: log10 probabilities of the whole text and its end."""
    counts, units = encoded(docs, learn, rounds)
    return score(units, counts, train(units, counts, rounds))
