"""Folds and bounded labelled samples for the trained operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """True for the fold that training never reads (false for a null doc_id)."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(False))


def labels_of(labels: DataFrame, column: str) -> DataFrame:
    """(doc_id, label) of the training folds; a doc_id with both labels, a null
    label or a null doc_id gives none."""
    one = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("label")) \
        .where("label IS NOT NULL AND doc_id IS NOT NULL").where(~held_out(F.col("doc_id")))
    return one.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("top")) \
        .where("label = top").select("doc_id", "label")


def sample(rows: DataFrame, size: int) -> DataFrame:
    """At most `size` rows (doc_id, ...), those with the least hash of doc_id."""
    return rows.orderBy(F.xxhash64(F.col("doc_id"), F.lit(11)), "doc_id").limit(size)
