"""Registered queries of the operators, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.llm.collocations import COLLOCATION_SQL, collocations
from sluicegate.llm.decontamination import find_contamination
from sluicegate.llm.language import identify
from sluicegate.llm.minhash_forest import forest_duplicates
from sluicegate.llm.neighbours import nearest
from sluicegate.llm.ngram_join import near_duplicates
from sluicegate.llm.packing import pack
from sluicegate.llm.pages import main_text
from sluicegate.llm.secret_scan import digest, scan_secrets
from sluicegate.llm.sharding import QUERY_BYTES, SHARD_SQL, shard
from sluicegate.llm.token_counts import count_tokens
from sluicegate.llm.toxicity import score_toxicity
from sluicegate.llm.whitening import by_component, whiten
from sluicegate.queries.registry import Query, table

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(function: Query) -> Query:
    """Register a function under its own name."""
    QUERIES[function.__name__] = function
    return function


@query
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of near duplicates of every document: five words, similarity 0.8."""
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return digest(scan_secrets(table(spark, sf_dir, "documents")))


@query
def op3_greedy_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the benchmark items of which it holds half or more."""
    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op4_template_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return main_text(table(spark, sf_dir, "pages"))


@query
def op5_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from ``labels``."""
    scored = score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", F.size("passages").alias("n_passages"))


@query
def op6_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document in sequences of 2048 tokens."""
    return pack(table(spark, sf_dir, "documents"))


@query
def op7_extendible_hash_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document, at most 256 KiB of text each."""
    return shard(table(spark, sf_dir, "documents"), QUERY_BYTES)


ORACLE_SQL["op7_extendible_hash_shards"] = SHARD_SQL


@query
def op8_hyperdimensional_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    return identify(table(spark, sf_dir, "documents"))


@query
def op9_heap_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return count_tokens(table(spark, sf_dir, "documents"))


@query
def op10_multiprobe_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth vector."""
    return nearest(table(spark, sf_dir, "embeddings"))


@query
def op11_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of near duplicates of every document: four words, similarity 0.8."""
    return forest_duplicates(table(spark, sf_dir, "documents"))


@query
def op12_qd_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the 32 directions of most variance, whitened."""
    return by_component(whiten(table(spark, sf_dir, "embeddings")))


@query
def op13_debruijn_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 strongest phrases of each language."""
    return collocations(table(spark, sf_dir, "documents"))


ORACLE_SQL["op13_debruijn_collocations"] = COLLOCATION_SQL
