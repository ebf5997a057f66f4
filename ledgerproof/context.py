"""The tables of one validation run and the settings it uses."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerproof import constants as K, schemas
from ledgerproof.functions.periods import period_end, period_start
from ledgerproof.session import shuffles_released

FILING_KEYS = ["cid", "period"]


@dataclass(frozen=True)
class Settings:
    """Run date, reference lists and lookup tables too long to be lists."""

    run_date: dt.date
    lookups: dict[str, list[str]] = field(default_factory=dict)
    lookup_tables: dict[str, DataFrame] = field(default_factory=dict)
    max_contracts: int = K.MAX_CONTRACTS
    max_products: int = K.MAX_PRODUCTS
    max_products_per_contract: int = K.MAX_PRODUCTS_PER_CONTRACT

    def values(self, name: str) -> list[str]:
        return self.lookups.get(name, [])


@dataclass(frozen=True)
class FilingContext:
    """Normalized tables of any number of filings, keyed by (cid, period).

    ``slices`` may name, for a table whose making shuffles much, frames that together are the table. They are stored one after
    another, so the disk holds the shuffles of one. ``scratch`` has the paths of tables that only the others' views read; when
    all tables are stored they can go.
    """

    spark: SparkSession
    tables: dict[str, DataFrame]
    settings: Settings
    slices: dict[str, list[DataFrame]] = field(default_factory=dict)
    scratch: tuple[str, ...] = ()

    @property
    def n_slices(self) -> int:
        return max((len(own) for own in self.slices.values()), default=1)

    def table(self, name: str) -> DataFrame:
        if name == "filings":
            return self.filings
        if name not in self.tables:
            return self.spark.createDataFrame([], schemas.TABLES[name])
        return self.tables[name]

    def has(self, name: str) -> bool:
        return name in self.tables

    @cached_property
    def filings(self) -> DataFrame:
        """One header per filing; a filing without identity rows is kept with null header fields.

        Every branch is reduced to one row per filing on the map side before the shuffle. ``stored`` keeps the result as
        a table, so that the rules that need headers do not read four tables each.
        """
        if self.has("filings"):
            return self.tables["filings"]
        ident = self.table("ident")
        header = ident.groupBy(*FILING_KEYS).agg(
            F.min_by("filing_type", F.struct(F.coalesce("filer_unique_id", F.lit("")), "filing_type")).alias("filing_type"),
            F.min("submitter_name").alias("submitter_name"),
        )
        keys = [
            self.table(name).select(*FILING_KEYS).distinct()
            for name in ("contracts", "transactions", "index")
            if self.has(name)
        ]
        blank_header = [
            k.select(*FILING_KEYS, F.lit(None).cast("string").alias("filing_type"),
                     F.lit(None).cast("string").alias("submitter_name"))
            for k in keys
        ]
        merged = header
        for other in blank_header:
            merged = merged.unionByName(other)
        return (
            merged.groupBy(*FILING_KEYS)
            .agg(F.max("filing_type").alias("filing_type"), F.max("submitter_name").alias("submitter_name"))
            .withColumn("period_start", period_start(F.col("period")))
            .withColumn("period_end", period_end(F.col("period")))
        )

    def stored(self, path: str, names: list[str] | None = None, columns: dict[str, list[str]] | None = None, headers: bool = True) -> FilingContext:
        """Write the tables (or the named ones) once as Parquet and read them back, so that all rules
        scan plain files instead of repeating the plan that made the table.

        The table on shared storage also survives the loss of executors, unlike a cache. ``columns`` names the columns of a
        table that will be read, if not all; headers of filings are stored unless nothing will read them.
        """
        tables = dict(self.tables)
        for name in names or list(self.tables):
            for i, frame in enumerate(self.slices.get(name, [self.tables[name]])):
                if columns is not None and name in columns:
                    frame = frame.select(*columns[name])
                with shuffles_released(self.spark):
                    frame.write.mode("append" if i else "overwrite").option("compression", "zstd").parquet(f"{path}/{name}")
            tables[name] = self.spark.read.parquet(f"{path}/{name}")
        if not headers:
            return FilingContext(self.spark, tables, self.settings)
        held = FilingContext(self.spark, {n: t for n, t in tables.items() if n != "filings"}, self.settings)
        with shuffles_released(self.spark):
            held.filings.write.mode("overwrite").parquet(f"{path}/filings")
        return FilingContext(self.spark, {**held.tables, "filings": self.spark.read.parquet(f"{path}/filings")}, self.settings)

    def register_views(self, prefix: str = "") -> None:
        """Make the tables available to SQL."""
        for name, frame in self.tables.items():
            frame.createOrReplaceTempView(f"{prefix}{name}")
