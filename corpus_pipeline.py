"""The corpus pipeline: documents through operators of quire.llm, one after another.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next one's docs. All stages but the last return
the columns of documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import decontaminate, packing, pu_quality, repeats, simhash
from quire.llm.common import stage, with_uid

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    model = pu_quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return pu_quality.score(docs, model, COLUMNS).where("predicted = 1").select(*COLUMNS)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: one with the smallest doc_id."""
    rows = with_uid(docs, COLUMNS)
    first = simhash.near_duplicates(rows, uid="uid").where("first").select("uid")
    return rows.join(first, "uid", "left_semi").select(*COLUMNS)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their repeated passages; n_chars follows the text."""
    left = repeats.remove_repeats(docs, ["doc_id", "lang", "source"])
    return left.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    rows = with_uid(docs, COLUMNS)
    found = decontaminate.contaminated(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return rows.join(found.select("uid").distinct(), "uid", "left_anti").select(*COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of the documents that are left."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

ORACLE_SQL = None  # classifiers, fingerprints and tokenizers have no SQL form; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{name}")
    return docs
