"""From raw documents to training sequences: filters, near duplicates, leaks, secrets, packing.

Each stage reads all that the one before it kept; its result is written and read again, which cuts the
lineage. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.llm import decontamination, secret_scan, toxicity
from sluicegate.llm.common import Scratch
from sluicegate.llm.ngram_join import near_duplicates
from sluicegate.llm.packing import pack
from sluicegate.queries.registry import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose whole text is not predicted to be toxic."""
    return toxicity.clean_rows(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Rows that share an id are copies by name; the first by its columns stays. Empty texts link with
    nothing and stay, and so do documents without an id.
    """
    scratch = Scratch(spark)
    groups = scratch.table(near_duplicates(docs), "groups")
    kept = _without(docs, groups.where("component_id <> doc_id"))
    counts = groups.where("doc_id IS NOT NULL").groupBy("doc_id").count()
    repeated = scratch.table(counts.where("count > 1").select("doc_id"), "repeated")
    if repeated.isEmpty():
        return kept
    same = kept.join(repeated, "doc_id", "left_semi").select(docs.columns)
    first = same.groupBy("doc_id").agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
    return _without(kept, repeated).unionByName(first)


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents whose id is not listed; a document without an id stays."""
    return docs.join(ids.select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, whole or in pieces."""
    return decontamination.clean_rows(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by ``[secret]``; ``n_chars`` follows the text."""
    length = F.when(F.col("text").isNotNull(), F.length("text")).otherwise(F.col("n_chars"))
    return secret_scan.redact(docs).withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens with every token of every document."""
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_leaks),
    ("secret_scans", redact),
    ("packing", pack_sequences),
]

# Learned models, near duplicates and a tokenizer's vocabulary are beyond SQL; tests replay each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again on shared storage."""
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = scratch.table(stage(spark, docs, sf_dir), name)
        if number:
            scratch.drop(STAGES[number - 1][0])
    return docs
