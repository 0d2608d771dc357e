"""Operator 8: repeated-substring removal by content-anchor fingerprints, in place of prefix doubling.

A byte goes when a string of ``least`` (200) bytes that covers it starts anywhere
else as well, in the same document or another. No rank pairs are formed and no
offset doubles: sorting every byte position once a round would shuffle over a
hundred times the input by computation. Instead positions are sampled by content
and compared by names of fixed strings around them ("rank" below is such a name);
those with a unique name drop out:

0. *Anchors.* Of the ``gram``-byte strings inside a window of ``least`` bytes, the
   one of least hash (leftmost of ties) is the window's anchor. Equal windows
   have equal anchors at equal places, and about one position in 85 is an
   anchor. Windows with the same anchor form a run of consecutive starts.
1. *Round one* sorts anchors by the rank (Karp-Rabin name) of their ``gram`` bytes;
   windows of anchors with a unique rank are unique.
2. *Round two* sorts the pairs (anchor's rank, rank of the run's whole context).
   Contexts found twice are repeated as a whole. If all contexts of an anchor's
   rank are equal it is settled. Of the others, the pairs (anchor's rank, rank of
   a *core*) decide: windows whose anchors lie at similar distances share a core of
   some 158 bytes, and only those whose core two contexts hold stay open.
3. *Round three* ranks every open window, and those of one representative of each
   repeated context, by all ``least`` bytes.

In each round names are dealt by range, packed as bytes; what repeats inside a
chunk is settled there and sent on once, so a string that a third of all
documents hold does not fill a task. Whole texts that occur twice are settled
by their count. Ranks are 64-bit names over random byte values, texts are
identified by 64 bits.

Defined cases: a null text is empty; documents shorter than ``least`` keep
everything; repeated rows remove each other wholly, as the definition says;
null ids are returned as null; long texts are ranked in segments; an empty table
gives an empty result; other columns pass through, columns that clash with the
added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from .common import chunked, fresh_names, mix, signed, staged

#: Bytes of an anchor; window starts ranked at once; bytes of text a chunk gathers; rows of a dealt range.
GRAM = 32
SEGMENT, CHUNK_BYTES, RANGE_ROWS = 1 << 18, 3 << 20, 600_000
#: Ranges of the distance from a window's start to its anchor; each has a core that all its windows share.
CORES = 4
COVERED, OPEN, SAMPLE = 0, 1, 2

BASE = 0x5851F42D4C957F2D
VALUES = np.random.default_rng(20).integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)


class Names:
    """64-bit names of substrings, equal wherever the substring stands."""

    def __init__(self, longest: int):
        base, inverse = np.uint64(BASE), np.uint64(pow(BASE, -1, 1 << 64))
        self.powers = np.cumprod(np.r_[np.uint64(1), np.full(longest, base)], dtype=np.uint64)
        self.inverses = np.cumprod(np.r_[np.uint64(1), np.full(longest, inverse)], dtype=np.uint64)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        return np.r_[np.uint64(0), np.cumsum(VALUES[data] * self.powers[: len(data)], dtype=np.uint64)]

    def of(self, prefix: np.ndarray, starts: np.ndarray, size) -> np.ndarray:
        return mix((prefix[starts + size] - prefix[starts]) * self.inverses[starts])


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    have, size = values, 1
    while size * 2 <= width:
        have = np.minimum(have[: len(have) - size], have[size:])
        size *= 2
    rest = width - size
    return np.minimum(have[: len(have) - rest], have[rest:]) if rest else have


def core_bounds(least: int) -> list[tuple[int, int]]:
    """Least and greatest distance from window start to anchor of each core."""
    width = -(-(least - GRAM + 1) // CORES)
    return [(low, min(low + width, least - GRAM + 1) - 1) for low in range(0, least - GRAM + 1, width)]


def runs_of(data: np.ndarray, names: Names, least: int) -> tuple[np.ndarray, ...]:
    """Of every run of a text: anchor's name, context's name, first window start, windows, distance of the first
    start to the anchor, and 32-bit names of the cores (0 where no window of the run has it)."""
    parts = []
    for low in range(0, max(0, len(data) - least + 1), SEGMENT):
        piece = data[low : low + SEGMENT + least - 1]
        prefix = names.prefix(piece)
        places = np.arange(len(piece) - GRAM + 1)
        gram = names.of(prefix, places, GRAM)
        # The place in the low bits makes the leftmost of equal names the least.
        ranked = (gram & np.uint64(0xFFFFFFFFFF000000)) | places.astype(np.uint64)
        anchor = (sliding_minimum(ranked, least - GRAM + 1) & np.uint64(0xFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        count = np.diff(np.r_[first, len(anchor)])
        at = anchor[first]
        context = names.of(prefix, first, count + least - 1)
        context = mix(context + (at - first).astype(np.uint64) * np.uint64(1 << 20) + count.astype(np.uint64))
        cores = np.zeros((len(first), CORES), np.uint32)
        for n, (near, far) in enumerate(core_bounds(least)):
            held = np.flatnonzero((at - first >= near) & (at - (first + count - 1) <= far))
            name = names.of(prefix, at[held] - near, least - far + near)
            cores[held, n] = (name >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
        parts.append((gram[at], context, first + low, count, at - first, cores))
    if not parts:
        none = np.empty(0, np.int64)
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none, np.zeros((0, CORES), np.uint32)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)


def _pack_spans(owner: np.ndarray, start: np.ndarray, end: np.ndarray) -> pd.DataFrame:
    """(tkey, spans): one row per text, spans as pairs of 32-bit numbers."""
    order = np.lexsort((start, owner))
    owner, start, end = owner[order], start[order], end[order]
    edge = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.empty(0, np.int64)
    pairs = np.stack([start, end], 1).astype(np.int32)
    return pd.DataFrame(
        {
            "tkey": signed(owner[edge]),
            "spans": [p.tobytes() for p in np.split(pairs, edge[1:])] if len(owner) else [],
        }
    )


def _by_part(part: np.ndarray, columns: dict[str, np.ndarray]) -> pd.DataFrame:
    order = np.argsort(part, kind="stable")
    part = part[order]
    edge = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else np.empty(0, np.int64)
    out = {"part": part[edge].astype(np.int32)}
    for name, values in columns.items():
        out[name] = [v.tobytes() for v in np.split(values[order], edge[1:])] if len(part) else []
    return pd.DataFrame(out)


def _part_of(name: np.ndarray, ranges: int) -> np.ndarray:
    """Range of a name. Anchors are the least names of their windows, so names are mixed anew."""
    name = mix(name)
    return ((name >> np.uint64(40)) * np.uint64(ranges) >> np.uint64(24)).astype(np.int32)


RUNS = "part int, gram binary, context binary, owner binary, first binary, count binary, ahead binary, cores binary, seen binary"


def _deal_runs(least: int, ranges: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = Names(SEGMENT + 2 * least)
        own = ranges + (TaskContext.get().partitionId() * 31) % ranges
        for number, rows in enumerate(chunked(frames, lambda r: len(r[1] or "") + 64, CHUNK_BYTES)):
            copies: dict[int, int] = {}
            parts = []
            for key, text in rows:
                copies[key] = copies.get(key, 0) + 1
                if copies[key] == 1:
                    gram, *rest = runs_of(_bytes(text), names, least)
                    parts.append((gram, np.full(len(gram), key, np.int64).view(np.uint64), *rest))
            if not sum(len(p[0]) for p in parts):
                continue
            gram, owner, context, first, count, ahead, cores = (np.concatenate(x) for x in zip(*parts, strict=True))
            times = np.repeat([min(2, copies[k]) for k in copies], [len(p[0]) for p in parts])
            order = np.lexsort((context, gram))
            gram, context, owner, first, count, ahead, cores, times = (
                x[order] for x in (gram, context, owner, first, count, ahead, cores, times)
            )
            edge = np.flatnonzero(np.r_[True, (gram[1:] != gram[:-1]) | (context[1:] != context[:-1])])
            seen = np.minimum(np.add.reduceat(times, edge), 2)
            size = np.diff(np.r_[edge, len(gram)])
            # Contexts met twice here are settled; one goes on to meet the other chunks.
            known = np.repeat(seen, size) > 1
            part = np.r_[_part_of(gram[edge], ranges), np.full(known.sum(), own, np.int32)]
            pick = np.r_[edge, np.flatnonzero(known)]
            yield _by_part(
                part,
                {
                    "gram": gram[pick],
                    "context": context[pick],
                    "owner": owner[pick],
                    "first": first[pick].astype(np.uint32),
                    "count": count[pick].astype(np.uint16),
                    "ahead": ahead[pick].astype(np.uint16),
                    "cores": cores[pick],
                    "seen": np.r_[seen, np.full(known.sum(), 2)].astype(np.uint8),
                },
            )

    return run


SETTLED = "tkey long, kind int, spans binary"


def _settle_runs(least: int, ranges: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        join = lambda c, t: np.frombuffer(b"".join(frame[c]), t)
        gram, context, owner = join("gram", np.uint64), join("context", np.uint64), join("owner", np.uint64)
        first, count = join("first", np.uint32).astype(np.int64), join("count", np.uint16).astype(np.int64)
        seen = join("seen", np.uint8)
        if int(frame["part"].iloc[0]) >= ranges:
            return _pack_spans(owner, first, first + count - 1 + least).assign(kind=COVERED)[["tkey", "kind", "spans"]]
        ahead = join("ahead", np.uint16).astype(np.int64)
        cores = join("cores", np.uint32).reshape(-1, CORES)
        order = np.lexsort((context, gram))
        gram, context, owner, first, count, seen, ahead, cores = (
            x[order] for x in (gram, context, owner, first, count, seen, ahead, cores)
        )
        of_gram = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]])
        of_context = np.flatnonzero(np.r_[True, (gram[1:] != gram[:-1]) | (context[1:] != context[:-1])])
        spread = lambda v, edge: np.repeat(v, np.diff(np.r_[edge, len(gram)]))
        total = spread(np.add.reduceat(seen.astype(np.int64), of_context), of_context)
        lead = np.zeros(len(gram), bool)
        lead[of_context] = True
        contexts = spread(np.add.reduceat(lead.astype(np.int64), of_gram), of_gram)
        covered = (total > 1) & (seen < 2)
        sampled = (total > 1) & (contexts > 1) & lead
        uncertain = (total == 1) & (contexts > 1)
        out = [_pack_spans(owner[covered], first[covered], (first + count - 1 + least)[covered]).assign(kind=COVERED)]
        # Windows stay open where two contexts of the anchor's rank hold their core.
        left = np.flatnonzero(uncertain | sampled)
        for n, (near, far) in enumerate(core_bounds(least)):
            held = left[cores[left, n] > 0]
            order = np.lexsort((cores[held, n], gram[held]))
            held = held[order]
            new = np.r_[True, (gram[held[1:]] != gram[held[:-1]]) | (cores[held[1:], n] != cores[held[:-1], n])]
            edge = np.flatnonzero(new[: len(held)])
            held = held[np.repeat(np.diff(np.r_[edge, len(held)]) > 1, np.diff(np.r_[edge, len(held)]))]
            start = np.maximum(first[held], first[held] + ahead[held] - far)
            end = np.minimum(first[held] + count[held], first[held] + ahead[held] - near + 1)
            for kind in (OPEN, SAMPLE):
                mine = uncertain[held] if kind == OPEN else sampled[held]
                out.append(_pack_spans(owner[held[mine]], start[mine], end[mine]).assign(kind=kind))
        return pd.concat(out)[["tkey", "kind", "spans"]]

    return run


WINDOWS = "part int, name binary, owner binary, start binary, kind binary"


def _deal_windows(least: int, ranges: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = Names(SEGMENT + 2 * least)
        own = ranges + (TaskContext.get().partitionId() * 31) % ranges

        def windows(key, text, runs):
            data = _bytes(text)
            for kind, packed in runs:
                spans = np.frombuffer(packed, np.int32).reshape(-1, 2)
                if not len(spans):
                    continue
                starts = np.concatenate([np.arange(a, b, dtype=np.int64) for a, b in spans])
                for low in range(0, len(data), SEGMENT):
                    mine = starts[(starts >= low) & (starts < low + SEGMENT)]
                    if len(mine):
                        prefix = names.prefix(data[low : low + SEGMENT + least - 1])
                        yield (
                            names.of(prefix, mine - low, least),
                            np.full(len(mine), key, np.int64).view(np.uint64),
                            mine,
                            np.full(len(mine), kind, np.uint8),
                        )

        for rows in chunked(frames, lambda r: len(r[1] or "") + 64, CHUNK_BYTES // 2):
            parts, met = [], set()
            for key, text, runs in rows:
                if key not in met:
                    met.add(key)
                    parts += windows(key, text, [(r["kind"], r["spans"]) for r in runs])
            if not parts:
                continue
            name, owner, start, kind = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.lexsort((kind, name))  # open ones first
            name, owner, start, kind = name[order], owner[order], start[order], kind[order]
            edge = np.flatnonzero(np.r_[True, name[1:] != name[:-1]])
            size = np.diff(np.r_[edge, len(name)])
            repeated = size > 1
            known = np.repeat(repeated, size) & (kind == OPEN)
            lead_kind = np.where(repeated, SAMPLE, kind[edge]).astype(np.uint8)
            pick = np.r_[edge, np.flatnonzero(known)]
            yield _by_part(
                np.r_[_part_of(name[edge], ranges), np.full(known.sum(), own, np.int32)],
                {
                    "name": name[pick],
                    "owner": owner[pick],
                    "start": start[pick].astype(np.uint32),
                    "kind": np.r_[lead_kind, np.full(known.sum(), OPEN)].astype(np.uint8),
                },
            )

    return run


def _settle_windows(least: int, ranges: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        join = lambda c, t: np.frombuffer(b"".join(frame[c]), t)
        name, owner = join("name", np.uint64), join("owner", np.uint64)
        start, kind = join("start", np.uint32).astype(np.int64), join("kind", np.uint8)
        if int(frame["part"].iloc[0]) >= ranges:
            covered = np.ones(len(name), bool)
        else:
            order = np.argsort(name, kind="stable")
            name, owner, start, kind = name[order], owner[order], start[order], kind[order]
            edge = np.flatnonzero(np.r_[True, name[1:] != name[:-1]])
            size = np.diff(np.r_[edge, len(name)])
            covered = np.repeat((size > 1) | (np.maximum.reduceat(kind, edge) == SAMPLE), size) & (kind == OPEN)
        return _pack_spans(owner[covered], start[covered], start[covered] + least)

    return run


def merged(spans: np.ndarray) -> np.ndarray:
    """Maximal spans of (start, end) pairs; touching ones are one."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.flatnonzero(np.r_[True, spans[1:, 0] > reach[:-1]])
    return np.stack([spans[new, 0], reach[np.r_[new[1:] - 1, len(spans) - 1]]], 1)


def repeated_spans(texts: DataFrame, least: int) -> DataFrame:
    """(tkey, spans): packed spans, by text key, of all repeated strings of ``texts`` (tkey, text)."""
    copies = staged(
        texts.groupBy("tkey").agg(F.count(F.lit(1)).alias("copies"), F.max(F.octet_length("text")).alias("size")),
        "text-copies",
    )
    total = copies.agg(F.sum(F.col("copies") * F.col("size"))).first()[0] or 0
    ranges = max(16, -(-total // (RANGE_ROWS * 80)))
    settled = staged(
        texts.mapInPandas(_deal_runs(least, ranges), RUNS)
        .repartition(ranges, "part")
        .groupBy("part")
        .applyInPandas(_settle_runs(least, ranges), SETTLED),
        "runs",
    )
    left = settled.filter(F.col("kind") != COVERED).groupBy("tkey").agg(F.collect_list(F.struct("kind", "spans")).alias("runs"))
    windows = (
        texts.join(left, "tkey")
        .select("tkey", "text", "runs")
        .mapInPandas(_deal_windows(least, ranges), WINDOWS)
        .repartition(ranges, "part")
        .groupBy("part")
        .applyInPandas(_settle_windows(least, ranges), "tkey long, spans binary")
    )
    whole = copies.filter((F.col("copies") > 1) & (F.col("size") >= least)).select(
        "tkey", F.col("size").cast("int").alias("size")
    )

    def as_span(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            size = frame["size"].to_numpy(np.int64)
            yield _pack_spans(frame["tkey"].to_numpy(np.int64).view(np.uint64), np.zeros_like(size), size)

    once = copies.filter("copies = 1").select("tkey")
    # Texts that occur twice are gone as a whole; their single strings need no row.
    single = settled.filter(F.col("kind") == COVERED).select("tkey", "spans").unionByName(windows).join(
        once, "tkey", "left_semi"
    )
    return single.unionByName(whole.mapInPandas(as_span, "tkey long, spans binary"))


ADDED = ["n_bytes", "n_removed", "n_spans", "removed", "kept"]


def remove_repeats(docs: DataFrame, least: int = 200) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans (long), removed (array of start, end) and kept (binary,
    the remaining bytes of ``text``)."""
    if least < GRAM:
        raise ValueError(f"least must be {GRAM} or more")
    docs = docs.drop(*ADDED)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    names = fresh_names(docs, ["tkey", "spans"])
    texts = docs.select(F.xxhash64(text).alias("tkey"), text.alias("text"))
    spans = repeated_spans(texts, least).groupBy("tkey").agg(F.collect_list("spans").alias(names["spans"]))
    rows = docs.withColumn(names["tkey"], F.xxhash64(text)).join(
        spans.withColumnRenamed("tkey", names["tkey"]), names["tkey"], "left"
    ).drop(names["tkey"])
    span = StructType([StructField("start", LongType()), StructField("end", LongType())])
    types = [LongType(), LongType(), LongType(), ArrayType(span), BinaryType()]
    schema = StructType([*docs.schema.fields, *(StructField(n, t) for n, t in zip(ADDED, types, strict=True))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in ADDED]
            for text, packed in zip(batch.column("text"), batch.column(names["spans"]), strict=True):
                data = (text.as_py() or "").encode("utf-8", "replace")
                pairs = merged(np.frombuffer(b"".join(packed.as_py() or ()), np.int32).reshape(-1, 2))
                kept, at = [], 0
                for start, end in pairs.tolist():
                    kept.append(data[at:start])
                    at = end
                kept.append(data[at:])
                rest = b"".join(kept)
                for column, value in zip(
                    out,
                    (
                        len(data), len(data) - len(rest), len(pairs),
                        [{"start": a, "end": b} for a, b in pairs.tolist()], rest,
                    ),
                    strict=True,
                ):
                    column.append(value)
            span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            arrow = [pa.int64(), pa.int64(), pa.int64(), span_type, pa.binary()]
            keep = [c for c in batch.schema.names if c != names["spans"]]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), *(pa.array(v, t) for v, t in zip(out, arrow, strict=True))],
                names=[*keep, *ADDED],
            )

    return rows.mapInArrow(run, schema)
