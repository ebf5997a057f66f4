"""Filing archives: an outer ZIP whose entries are ZIPs of CSV files.

ZIP is not splittable, so one inner archive (one filing) is the unit of work: entry names are listed
once, spread over the cluster, and each task opens only its own entries. CSV text streams out in
batches; no file is held whole. The outer archive must lie where every executor can read it.
"""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

RAW_SCHEMA = "source_archive string, source_filename string, source_row_index long, record map<string,string>"
BATCH_ROWS = 5000


def list_filings(path: str) -> list[str]:
    """Names of the inner archives; reads the directory of the outer one only."""
    with zipfile.ZipFile(path) as outer:
        return [n for n in outer.namelist() if n.lower().endswith(".zip")]


def _records(inner: zipfile.ZipFile, member: str) -> Iterator[tuple[int, dict[str, str]]]:
    with inner.open(member) as raw:
        for number, row in enumerate(csv.DictReader(io.TextIOWrapper(raw, "utf-8-sig", newline="")), start=1):
            yield number, {k: v for k, v in row.items() if k is not None and v != ""}


def read_archive(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """Records of all CSV members whose name ends with ``suffix``, as a map per record.

    Empty fields are left out of the map, so they read as null.
    """
    names = list_filings(path)
    ending = suffix.lower()

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with zipfile.ZipFile(path) as outer:
            for batch in batches:
                for name in batch["name"]:
                    with outer.open(name) as entry, zipfile.ZipFile(entry) as inner:
                        for member in inner.namelist():
                            if not member.lower().endswith(ending):
                                continue
                            rows = []
                            for number, record in _records(inner, member):
                                rows.append((name, member, number, record))
                                if len(rows) == BATCH_ROWS:
                                    yield pd.DataFrame(rows, columns=["source_archive", "source_filename", "source_row_index", "record"])
                                    rows = []
                            if rows:
                                yield pd.DataFrame(rows, columns=["source_archive", "source_filename", "source_row_index", "record"])

    entries = spark.createDataFrame([(n,) for n in names], "name string").repartition(max(1, len(names)))
    return entries.mapInPandas(read, RAW_SCHEMA)


def columns_of(raw: DataFrame, names: list[str]) -> DataFrame:
    """Turn named map entries into columns."""
    picked = [F.try_element_at("record", F.lit(n)).alias(n) for n in names]
    return raw.select(*picked, F.col("source_archive").alias("source_filing"), "source_filename", "source_row_index")


def discover_entities(identities: DataFrame, state: str) -> DataFrame:
    """Companies with an identity row in the state, each once with its first filing."""
    here = identities.filter(F.upper(F.trim("state")) == state.upper())
    order = F.struct("source_filing", "company_name")
    first = F.min_by(F.struct("company_name", "state", "source_filing"), order).alias("first")
    return here.groupBy("cid").agg(first).select("cid", "first.company_name", "first.state", "first.source_filing")
