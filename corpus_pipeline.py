"""Corpus pipeline: stages over ``documents``, each written as Parquet and read again as the next one's documents.

Quality rules drop what they reject, exact and near duplicates leave one document of each group, mixing repeats or leaves
out documents to meet its sources' targets, and packing places what is left in sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerproof.llm import exact_dedup, jaccard_join, mixing, packing, quality_rules
from ledgerproof.llm.base import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return packing.pack(packing.token_pieces(docs)).select(*columns)


STAGES = [("quality_rules", quality), ("exact_dedup", exact), ("ngram_jaccard", near), ("mix_sources", mix), ("pack_sequences", pack)]
ORACLE_SQL = None  # rates and best-fit packing have no SQL; tests compare with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
