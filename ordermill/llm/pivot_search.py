"""Operator 9: exact top-k inner products by pivot-table elimination.

Inner products become distances: with one more coordinate sqrt(M - |x|^2), M
the largest squared norm, all candidates have the same norm and
d(q, x)^2 = |q|^2 + M - 2 q.x, so the best product is the nearest candidate.
A table holds each vector's distances to ``n_pivots`` pivots. By the triangle
inequality max over pivots of |d(q, p) - d(x, p)| is a lower bound of d(q, x);
a query evaluates candidates in the order of that bound and stops as soon as
the next bound excludes every product that could enter its k best. Bounds are
relaxed by more than their rounding error and products are computed in
integers, so the result is exact.

Candidates and queries are dealt by hash into blocks of bounded size; every
pair of a candidate and a query block is one group of a cogrouped job, and a
query's best k of all blocks are merged by a window. Nothing passes through the
driver but counts, M and the pivots (``n_pivots`` rows).

Defined cases: a vector that is null, empty or holds a null or non-finite
component takes no part; a null id takes no part; equal rows (id and vector)
count once; rows that share an id with a query are its own and no candidates; a
query meets the candidates of its own dimension; with fewer than k candidates
all are returned; an empty table gives an empty result; ties go to the smaller
id. Scaled components are bigints: a vector with one of 2^63 or more takes no part.
Products that may not fit 64 bits in their dimension are computed in integers of
any size; a block's best score that does not fit its bigint column fails.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

#: Rows of a candidate and of a query block on average, and candidates evaluated between two looks at the bound.
BLOCK_CANDIDATES, BLOCK_QUERIES, STEP = 8192, 2048, 128

#: Scaled components are below this; sums of products below half of it fit 64 bits, whatever the rounding of their bound.
LARGEST = float(1 << 63)

BEST = "query_id long, vec_id long, score long, evaluated long"


def scaled_vectors(rows: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """(vec_id, v): distinct usable vectors as floor(scale * x) integers."""
    x = F.col(vector_column).cast("array<double>")
    whole = F.transform(x, lambda c: F.floor(c * F.lit(float(scale))))
    usable = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(LARGEST / scale)))
    return (
        rows.filter(F.col(id_column).isNotNull() & (F.size(x) > 0))
        .filter(usable)
        .select(F.col(id_column).cast("long").alias("vec_id"), whole.alias("v"))
        .distinct()
    )


def distances(points: np.ndarray, extra: np.ndarray, pivots: np.ndarray, pivot_extra: np.ndarray) -> np.ndarray:
    """Distances of every point to every pivot, with the extra coordinate."""
    square = (
        (points**2).sum(1)[:, None] + extra[:, None] ** 2 + (pivots**2).sum(1) + pivot_extra**2
        - 2 * (points @ pivots.T + extra[:, None] * pivot_extra)
    )
    return np.sqrt(np.maximum(square, 0))


def exact_products(vectors: np.ndarray, largest: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products of int64 rows, of magnitudes ``largest`` (doubles): Python integers if any may not fit 64 bits."""
    scores = vectors @ query
    wide = np.flatnonzero(largest * np.abs(query.astype(np.float64)).max() * len(query) >= LARGEST / 2)
    if len(wide):
        exact = query.tolist()
        scores = scores.astype(object)
        for at in wide:
            scores[at] = sum(c * q for c, q in zip(vectors[at].tolist(), exact, strict=True))
    return scores


def best_of_block(
    ids: np.ndarray, vectors: np.ndarray, table: np.ndarray, query_id: int, query: np.ndarray, to_pivots: np.ndarray,
    most: float, k: int, largest: np.ndarray | None = None,
) -> tuple[list[tuple[int, int]], int]:
    """The k best (score, id) of one block for one query, and how many candidates were evaluated."""
    largest = np.abs(vectors.astype(np.float64)).max(1) if largest is None else largest
    bound = np.abs(table - to_pivots).max(1)
    order = np.argsort(bound, kind="stable")
    square = float((query.astype(np.float64) ** 2).sum()) + most
    slack = 1e-3 + 1e-6 * square
    ceiling = (square - np.maximum(bound[order] - 1e-6 * math.sqrt(square), 0) ** 2) / 2 + slack
    best_scores, best_ids, done = np.empty(0, np.int64), np.empty(0, np.int64), 0
    while done < len(order):
        if len(best_ids) == k and ceiling[done] < best_scores[-1]:
            break
        chosen = order[done : done + STEP]
        done += len(chosen)
        chosen = chosen[ids[chosen] != query_id]
        scores = np.r_[best_scores, exact_products(vectors[chosen], largest[chosen], query)]
        owners = np.r_[best_ids, ids[chosen]]
        if scores.dtype == object:
            top = np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], owners[i]))[:k], np.int64)
        else:
            top = np.lexsort((owners, -scores))[:k]
        best_scores, best_ids = scores[top], owners[top]
    return list(zip(best_scores.tolist(), best_ids.tolist(), strict=True)), done


def _search(pivots: dict[int, np.ndarray], most: float, k: int):
    def run(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        for size in [] if candidates.empty or queries.empty else sorted({len(v) for v in queries["query"]}):
            here = candidates[candidates["v"].map(len) == size]
            if here.empty:
                continue
            vectors = np.array(here["v"].tolist(), np.int64)
            ids = here["vec_id"].to_numpy(np.int64)
            points = vectors.astype(np.float64)
            largest = np.abs(points).max(1)
            extra = np.sqrt(np.maximum(most - (points**2).sum(1), 0))
            centre = pivots[size].astype(np.float64)
            centre_extra = np.sqrt(np.maximum(most - (centre**2).sum(1), 0))
            table = distances(points, extra, centre, centre_extra)
            asked = queries[queries["query"].map(len) == size]
            q = np.array(asked["query"].tolist(), np.int64)
            to_pivots = distances(q.astype(np.float64), np.zeros(len(q)), centre, centre_extra)
            for n, query_id in enumerate(asked["query_id"].to_numpy(np.int64)):
                best, seen = best_of_block(ids, vectors, table, query_id, q[n], to_pivots[n], most, k, largest)
                if any(not -(1 << 63) <= s < 1 << 63 for s, _ in best):
                    raise OverflowError(f"a best score of query {query_id} does not fit a bigint")
                out += [(query_id, i, s, seen) for s, i in best]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score", "evaluated"]).astype("int64")

    return run


def top_inner_products(
    rows: DataFrame,
    is_query,
    k: int = 10,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: int = 1024,
    n_pivots: int = 32,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of every row that meets ``is_query`` (a
    column over vec_id), against all rows."""
    vectors = staged(scaled_vectors(rows, id_column, vector_column, scale), "vectors")
    square = F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    by_size = vectors.groupBy(F.size("v").alias("size")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.max(square).alias("most"),
        F.max(F.array_max(F.transform("v", F.abs))).alias("largest"),
    )
    facts = by_size.agg(F.sum("rows"), F.max("most"), F.max("largest")).first()
    count, most = facts[0] or 0, facts[1] or 0.0
    if (facts[2] or 0) < 1 << 31:  # half as many bytes to deal
        vectors = vectors.select("vec_id", F.col("v").cast("array<int>").alias("v"))
    # Pivots: per dimension the n_pivots rows of least hash; as many values as there are dimensions.
    least = Window.partitionBy(F.size("v")).orderBy(F.xxhash64("vec_id", "v"), "vec_id")
    chosen = vectors.withColumn("place", F.row_number().over(least)).filter(F.col("place") <= n_pivots).collect()
    pivots: dict[int, list] = {}
    for r in chosen:
        pivots.setdefault(len(r.v), []).append(r.v)
    tables = {size: np.array(v, np.int64) for size, v in pivots.items()}
    asked = vectors.filter(is_query)
    parts = max(1, -(-count // BLOCK_CANDIDATES))
    query_parts = max(1, -(-asked.count() // BLOCK_QUERIES))
    spread = F.pmod(F.xxhash64("vec_id", "v"), F.lit(parts))
    candidates = vectors.withColumn("part", spread).withColumn(
        "query_part", F.explode(F.sequence(F.lit(0), F.lit(query_parts - 1)))
    )
    queries = asked.select(
        F.col("vec_id").alias("query_id"),
        F.col("v").alias("query"),
        F.pmod(F.xxhash64("vec_id", "v"), F.lit(query_parts)).cast("int").alias("query_part"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"),
    )
    best = (
        candidates.groupBy("part", "query_part")
        .cogroup(queries.groupBy("part", "query_part"))
        .applyInPandas(_search(tables, most, k), BEST)
    )
    # A query id with several vectors takes, of each candidate, its highest score.
    best = best.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
