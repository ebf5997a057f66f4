"""What the corpus operators share: tables in the shared folder, and SQL text for words."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerproof.session import scratch_path

#: The six ASCII white-space characters, x20 and x09 to x0D; every other character belongs to a word.
SPACE = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def python_workers(df: DataFrame) -> DataFrame:
    """Let this session's Python workers import the package where it lies; clusters that ship it lose nothing."""
    env, root = df.sparkSession.sparkContext.environment, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return df


def words(text: Column) -> Column:
    """Words of a text in order; null and blank texts have none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def without(text: Column, characters: str) -> Column:
    """The text with every one of the characters deleted."""
    return F.translate(text, characters, "")


def in_fold(doc_id: Column) -> Column:
    """Whether a document's label may be learned from: crc32 of its id as text is no multiple of five."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 != 0
