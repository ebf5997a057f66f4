"""The lake: ``<root>/<cid>/<period>/<tier>/<table>.parquet`` files, or partitioned folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerproof.context import FILING_KEYS, FilingContext, Settings
from ledgerproof.functions.periods import canonical_period
from ledgerproof.schemas import TABLES
from ledgerproof.sources.tables import normalize, read_optional

_LAYOUT = r"/([^/]+)/([0-9]{4}-?Q[1-4])/([^/]+)/([^/]+)\.parquet(/[^/]*)?$"


def path_part(path: Column, part: int) -> Column:
    """1 company, 2 period, 3 tier, 4 table of a lake path; ``Unknown`` when it has another shape."""
    text = F.regexp_extract(path, _LAYOUT, part)
    return F.when(text != "", text).otherwise("Unknown")


def _located(df: DataFrame, path: Column) -> DataFrame:
    return df.withColumns({
        "cid": path_part(path, 1), "period": canonical_period(path_part(path, 2)), "tier": path_part(path, 3),
    })


def lake_files(spark: SparkSession, root: str, table: str = "*") -> DataFrame:
    """One row per file: place in the lake and size in MB. Reads no file content."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"{table}.parquet").load(root).select("path", "length")
    )
    placed = _located(files, F.col("path")).withColumn("table", path_part(F.col("path"), 4))
    return placed.select("cid", "period", "tier", "table", F.round(F.col("length") / 1048576, 2).alias("size_mb"), "path")


def read_files(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All files of one table anywhere below the root, with cid, period and tier from the path. Lists and reads everything."""
    rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", f"{table}.parquet").parquet(root)
    return _located(rows, F.col("_metadata.file_path"))


PLACE = ["cid", "period", "tier"]


def write_lake(df: DataFrame, root: str, table: str) -> None:
    """One table of the lake as ``<root>/<table>/cid=/period=/tier=``; a large filing is several files."""
    df.hint("rebalance", *PLACE).write.mode("overwrite").partitionBy(*PLACE).parquet(f"{root}/{table}")


def read_lake(spark: SparkSession, root: str, table: str, wanted: DataFrame | None = None, tier: str | None = None) -> DataFrame:
    """One table of the lake, with cid, period and tier as columns; only partitions that are asked for are read.

    ``wanted`` has (cid, period) of the filings to read. It meets the table in a semi join on the partition columns, from
    which Spark takes the list of partitions before it opens a file.
    """
    rows = spark.read.parquet(f"{root}/{table}")
    if tier is not None:
        rows = rows.where(F.col("tier") == tier)
    if wanted is None:
        return rows
    # The comparison holds for every text; Spark prunes by a join only if the other side is filtered.
    filings = wanted.select(*[F.col(k).alias(f"_{k}") for k in FILING_KEYS]).where("_cid >= '' AND _period >= ''")
    return rows.join(filings, (F.col("cid") == F.col("_cid")) & (F.col("period") == F.col("_period")), "left_semi")


def write_partitioned(df: DataFrame, path: str, keys: list[str] = FILING_KEYS) -> None:
    """Partitioned write. The rebalance hint lets adaptive execution cut a large partition into
    several tasks and merge small ones, so a hot filing is not written by one task."""
    df.hint("rebalance", *keys).write.mode("overwrite").partitionBy(*keys).parquet(path)


def upsert_partitions(df: DataFrame, path: str, keys: list[str], tasks: int | None = None) -> None:
    """Replace the partitions that occur in ``df`` and leave all others.

    ``tasks`` is for many partitions of a few rows each: by their size, rebalancing would have one task write all the files.
    """
    placed = df.hint("rebalance", *keys) if tasks is None else df.repartition(tasks, *keys)
    placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def write_draft(df: DataFrame, path: str, user_id: str, session_id: str) -> None:
    """Draft of one editing session, below its user and session folder."""
    draft = df.withColumns({"user_id": F.lit(user_id), "session_id": F.lit(session_id)})
    draft.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("user_id", "session_id").parquet(path)


def load_context(spark: SparkSession, root: str, settings: Settings, cid: str | None = None, period: str | None = None) -> FilingContext:
    """Context over a partitioned lake root with one folder per table. Company and period filters
    prune partitions. A table that is not there is empty."""
    tables = {}
    for table, schema in TABLES.items():
        frame = read_optional(spark, f"{root}/{table}", schema)
        if cid is not None and "cid" in frame.columns:
            frame = frame.filter(F.col("cid") == cid)
        if period is not None and "period" in frame.columns:
            frame = frame.filter(F.col("period") == period)
        tables[table] = normalize(frame, table)
    return FilingContext(spark, tables, settings)


def convert_csv(spark: SparkSession, source: str, target: str) -> None:
    """CSV with header to Parquet, all columns as text; typing follows in ``normalize``."""
    spark.read.option("header", True).csv(source).write.mode("overwrite").parquet(target)


def write_report(lines: DataFrame, path: str, order: str = "line_no") -> None:
    """Ordered text lines as one file. Meant for reports, whose size is bounded by the catalogue."""
    lines.orderBy(order).select("line").coalesce(1).write.mode("overwrite").text(path)
