"""Company registry with validity intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ledgerproof.context import Settings
from ledgerproof.sources.tables import normalize

CSV_SCHEMA = "CID string, Organization_Name string, effective_start_date string, effective_end_date string"


def import_registry(spark: SparkSession, path: str) -> DataFrame:
    """Registry CSV; a blank end date is an open one."""
    rows = spark.read.schema(CSV_SCHEMA).option("header", True).csv(path)
    return normalize(rows, "registry").select("cid", "legal_name", "effective_start", "effective_end")


def close_versions(df: DataFrame, key: str = "cid", start: str = "effective_start") -> DataFrame:
    """Derive each version's end from the start of the next one of the same company."""
    following = F.lead(start).over(Window.partitionBy(key).orderBy(start))
    return df.withColumn("effective_end", following)


def with_lookup(settings: Settings, name: str, values: DataFrame, as_table: bool = True) -> Settings:
    """Add a reference list given as a table with a column ``value``.

    The caller says which form it takes; results are the same. A table is joined. As a list, all values come to the
    driver and are tested inside the row scan, which suits the short lists of a few hundred names.
    """
    distinct = values.select(F.upper(F.trim("value")).alias("value")).dropna().distinct()
    if not as_table:
        listed = sorted(r.value for r in distinct.collect())
        return Settings(**{**vars(settings), "lookups": {**settings.lookups, name: listed}})
    return Settings(**{**vars(settings), "lookup_tables": {**settings.lookup_tables, name: distinct}})
