"""A corpus pipeline of five stages; each is written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cantor.llm import jaccard, linededup, mixing, packing, quality
from cantor.llm.common import Scratch
from cantor.llm.queries import MAX_TOKENS, tokenizer_path

#: Near copies of the pipeline: word n-grams of this length, and this Jaccard similarity in percent.
NEAR_WORDS, NEAR_PERCENT = 5, 80

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; of the others the failing lines."""
    return quality.reject_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on many sites go; texts that are copies of each other on many sites are left to the next stage."""
    return linededup.remove_boilerplate(docs, near=(NEAR_PERCENT, NEAR_WORDS)).select(docs.columns)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return jaccard.keep_one_of_each(docs, percent=NEAR_PERCENT, words=NEAR_WORDS)


def mixing_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled by calibrated probabilities."""
    return mixing.mix(docs).filter("kept").select(docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in packed sequences."""
    return packing.pack_documents(docs, tokenizer_path(), MAX_TOKENS, end_id=1)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("mixing_to_targets", mixing_to_targets),
    ("best_fit_packing", best_fit_packing),
]

#: Tokens, hashes that sample and component names are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
