"""Corpus pipeline: five operators in a row over ``documents``, each stage written and reread.

Quality rules drop documents, the Jaccard join keeps one of each group of near duplicates,
substring deduplication cuts repeated passages out of the texts, mixing takes each source's
words up to its target, and packing turns what is left into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.llm import jaccard, mixing, packing, quality_rules, substring
from turnstile.llm.common import stored, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and their group's adaptive limits."""
    return quality_rules.filter_documents(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the document with the smallest doc_id."""
    return jaccard.one_per_group(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document holds; documents left without words go."""
    return substring.deduplicated(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's words as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece with its place in a sequence."""
    return packing.op6_minimum_bin_slack(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("substring_dedup", substring_stage),
    ("mix_to_weights", mixing_stage),
    ("best_fit_packing", packing_stage),
]

#: not expressible: minimum bin slack and the tokenizer have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
