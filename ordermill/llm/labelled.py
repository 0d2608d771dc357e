"""Bounded samples of labelled documents, for the two classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_crc(id_column: str = "doc_id") -> Column:
    """crc32 of a document's id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, max_rows: int) -> DataFrame:
    """(doc_id, text, label) of at most ``max_rows`` labelled documents that meet ``learn`` (over doc_id).

    The rows of least hash of doc_id are taken. Labels that are null or
    contradict each other are not used; of documents with one id, one is used.
    The picked labels are bounded by ``max_rows`` and therefore broadcast, so no
    text is shuffled but the sample's.
    """
    picked = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .filter(learn & F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .filter("label = other")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
        .select("doc_id", "label")
    )
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return rows.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
