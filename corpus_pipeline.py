"""Corpus pipeline: five operators of ``ordermill.llm``, each over all that the one before kept.

    toxicity -> line dedup -> n-gram Jaccard join -> benchmark decontamination -> best-fit packing

Each stage is a function (spark, docs, sf_dir) -> DataFrame. All but the last
return the columns of ``documents``; the last returns where each document lies.
Stages are written as Parquet to the shared work folder and read again; ``run``
removes what is no longer read. Texts go to Python in batches bounded in bytes.

Defined cases, beyond those of the operators: documents without words are
near duplicates of nothing and stay, row by row; of equal rows with words one
stays; the near duplicate that stays is the one of least doc_id (a null one last); n_chars, if
there is such a column, follows the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm.common import fresh_names, noted, staged, table
from ordermill.llm.jaccard_join import near_duplicates
from ordermill.llm.line_dedup import dedup_lines
from ordermill.llm.packing import count_words, pack_documents
from ordermill.llm.string_tiling import decontaminate
from ordermill.llm.toxicity import fit_toxicity, score_toxicity
from ordermill.session import bound_batches, remove_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Score from which a document counts as toxic; words of a bin.
TOXIC, BIN_WORDS = 0.7, 2048


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the counterfactual classifier, learned from all labels, does not call toxic."""
    bound_batches(spark)
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    names = fresh_names(docs, ["score", "predicted"])
    scored = score_toxicity(docs, model, TOXIC, (names["score"], names["predicted"]))
    return scored.filter(F.col(names["predicted"]) == 0).select(*docs.columns)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that three or more of them hold (the largest doc_id keeps them)."""
    # Names match without case, as in Spark.
    added = ("n_lines", "n_dropped")
    own = {c: f"{c}__own" for c in docs.columns if c.lower() in added}
    kept = dedup_lines(docs.withColumnsRenamed(own)).drop(*added)
    kept = kept.withColumnsRenamed({v: k for k, v in own.items()}).select(*docs.columns)
    for size in [f for f in docs.schema.fields if f.name.lower() == "n_chars"]:
        kept = kept.withColumn(size.name, F.char_length("text").cast(size.dataType))
    return kept


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the least doc_id."""
    bound_batches(spark)
    found = near_duplicates(docs)
    least = (
        found.filter("class_key is not null")
        .groupBy("component_key")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("first"))
    )
    names = fresh_names(docs, ["row_key", "kept_id"])
    chosen = staged(
        least.select(F.col("first.doc_id").alias(names["kept_id"]), F.col("first.row_key").alias(names["row_key"])),
        "kept-documents",
    )
    key = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    has_words = count_words(F.coalesce(F.col("text").cast("string"), F.lit(""))) > 0
    rows = docs.filter(has_words).withColumn(names["row_key"], key)
    same = rows["doc_id"].cast("long").eqNullSafe(chosen[names["kept_id"]]) & (
        rows[names["row_key"]] == chosen[names["row_key"]]
    )
    kept = rows.join(chosen, same, "left_semi").dropDuplicates(["doc_id", names["row_key"]]).select(*docs.columns)
    return kept.unionByName(docs.filter(~has_words))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover no benchmark item."""
    bound_batches(spark)
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, copy, piece, words, bin_id, bin_offset of every document that is left."""
    bound_batches(spark)
    return pack_documents(docs, capacity=BIN_WORDS)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_common_lines),
    ("ngram_jaccard_join", one_of_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack),
]

#: The classifier's scores and the packing are not expressible in SQL; tests compare with plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; what a stage has written is removed once the next one's rows are there."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        with noted() as written:
            docs = staged(stage(spark, docs, sf_dir), name)
        *between, last = written
        for path in [*before, *between]:
            remove_path(spark, path)
        before = [last]
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
