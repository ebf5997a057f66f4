"""The driver tables as Spark views and as a filing context."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.views import BASE, FILING_TABLES, FULL, LOOKUPS, RUN_DATE, SIZE_LIMITS, with_clause
from ledgerproof.context import FilingContext, Settings
from ledgerproof.session import configure, scratch_path, shuffles_released

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def register(spark: SparkSession, sf_dir: str) -> None:
    configure(spark)
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        spark.read.parquet(path).createOrReplaceTempView(name)


def base(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    register(spark, sf_dir)
    return [spark.sql(f"{with_clause(BASE, [n])} SELECT * FROM {n}") for n in names]


# The view of transactions reads sales twice, the second time for the rows that occur twice. Spark would join the tables for
# each reading; here one reading unfolds those rows. Same rows, as the comparison with the SQL tells.
TWO_READINGS = "(SELECT * FROM fsales UNION ALL SELECT * FROM fsales WHERE l_quantity = 50) twice"
ONE_READING = "fsales LATERAL VIEW explode(IF(l_quantity = 50, array(1, 2), array(1))) copies AS copy"
# So with the identity rows of sellers that have two.
SELLERS_TWICE = FULL["fid"][FULL["fid"].index("\n        UNION ALL SELECT DISTINCT s_nationkey"):]
SELLERS_ONCE = ") v LATERAL VIEW explode(IF(s_acctbal > 8000, array(1, 2), array(1))) copies AS copy"
SPARK_FULL = {name: text.replace(TWO_READINGS, ONE_READING).replace(SELLERS_TWICE, SELLERS_ONCE) for name, text in FULL.items()}


def full(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"{with_clause(SPARK_FULL, [name])} SELECT * FROM {name}")


# For queries that read sales in several tables: joined once, stored, and read by the views of transactions, contracts and
# sellers. Orders meet customers before lines, so lines move twice. A view may ask for fewer partners than another, so lines
# without a part or customer are kept and marked.
SALES = """
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, CAST(o_orderdate AS DATE) AS o_orderdate, c_nationkey, c_name, c_mktsegment,
         l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, CAST(l_shipdate AS DATE) AS l_shipdate,
         p_type, p_size, p_brand, p_retailprice, p_partkey IS NOT NULL AND c_custkey IS NOT NULL AS complete, {slice_of_customer} AS slice
  FROM (SELECT * FROM lineitem LEFT JOIN part ON l_partkey = p_partkey WHERE {slice_of_line} = {i}) l
       JOIN (SELECT * FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE {slice_of_order} = {i}) o ON l_orderkey = o_orderkey"""
SALE_LINES = """FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
       JOIN customer ON o_custkey = c_custkey"""
SELLER_LINES = "FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey"
ON_SALES = {**SPARK_FULL,
            "fsales": SPARK_FULL["fsales"].replace("o_totalprice, ", "").replace(SALE_LINES, "FROM {sales} WHERE complete"),
            "fseller": SPARK_FULL["fseller"].replace(SELLER_LINES, "FROM {sales} JOIN supplier ON l_suppkey = s_suppkey")}
# Bytes of lines that are joined at a time.
SLICE = 1 << 30


def _slice(key: str, n: int) -> str:
    """Not the hash that shuffles deal by, so that a slice still fills all partitions."""
    return f"pmod(xxhash64(CAST({key} AS BIGINT)), {n})"


def sales(spark: SparkSession, sf_dir: str, path: str, slice_bytes: int = SLICE) -> tuple[DataFrame, int]:
    """The sales stored at ``path``, and the number of slices: of orders while they are joined, of customers (``slice``) as they lie.

    The shuffles of one slice are on the disk at a time.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(os.path.join(sf_dir, "lineitem.parquet"))
    n = max(1, -(-(files.agg(F.sum("length")).head()[0] or 0) // slice_bytes))
    for i in range(n):
        part = spark.sql(SALES.format(i=i, slice_of_customer=_slice("o_custkey", n), slice_of_line=_slice("l_orderkey", n), slice_of_order=_slice("o_orderkey", n)))
        with shuffles_released(spark):
            part.write.mode("append").partitionBy("slice").option("compression", "zstd").parquet(path)
    return spark.read.schema(part.schema).parquet(path), n


def sold_context(spark: SparkSession, sf_dir: str, names: list[str], slice_bytes: int = SLICE) -> FilingContext:
    """``context`` with the named tables over stored sales; contracts, which gather all lines of a customer, in slices."""
    ctx = context(spark, sf_dir)
    path = scratch_path(spark, "sales")
    sold, n = sales(spark, sf_dir, path, slice_bytes)

    def on(view: str, rows: DataFrame) -> DataFrame:
        return spark.sql(f"{with_clause(ON_SALES, [view])} SELECT * FROM {view}", sales=rows)

    tables = {t: on(FILING_TABLES[t], sold) for t in {"transactions", "contracts"} & set(names)}
    if {"ident", "registry"} & set(names):
        # Sellers are told by quarter, so the first day of it stands for all.
        by_quarter = scratch_path(spark, "sellers")
        sellers = sold.select("l_suppkey", F.trunc("o_orderdate", "quarter").alias("o_orderdate")).distinct()
        with shuffles_released(spark):
            sellers.write.parquet(by_quarter)
        sellers = spark.read.schema(sellers.schema).parquet(by_quarter)
        tables |= {t: on(FILING_TABLES[t], sellers) for t in {"ident", "registry"} & set(names)}
    slices = {"contracts": [on("fct", sold.where(F.col("slice") == i)) for i in range(n)]} if "contracts" in names else {}
    return FilingContext(spark, {**ctx.tables, **tables}, ctx.settings, slices, (path,))


def settings() -> Settings:
    limits = dict(zip(("max_contracts", "max_products", "max_products_per_contract"), SIZE_LIMITS))
    return Settings(run_date=dt.date.fromisoformat(RUN_DATE), lookups=LOOKUPS, **limits)


def context(spark: SparkSession, sf_dir: str) -> FilingContext:
    """All filings as one context."""
    register(spark, sf_dir)
    return FilingContext(spark, {t: full(spark, v) for t, v in FILING_TABLES.items()}, settings())
