"""Validate again only the filings that changed.

A filing's fingerprint is the count, the sum and the xor of its rows' hashes, so it does not depend on the order or the place
of rows and merges on the map side. It covers the filing's header and all that the rules read: every row of their tables, with
the columns that they name (all tables and columns if a rule does not tell), and transactions, which the results count. Tables
that are not kept by filing (registries) and the version text count for every filing. Filings whose fingerprint is new are
validated and their partitions of the results replaced; the others are neither scanned by a rule nor rewritten.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerproof.context import FILING_KEYS, FilingContext
from ledgerproof.plans.engine import columns_read, validate
from ledgerproof.plans.rules import Group, words_read
from ledgerproof.schemas import TABLES
from ledgerproof.session import scratch_path
from ledgerproof.sources.lake import upsert_partitions
from ledgerproof.sources.tables import read_optional

FINGERPRINT = ["n_rows", "hash_sum", "hash_xor"]
STATE = "cid string, period string, n_rows long, hash_sum decimal(38,0), hash_xor long, version long"
# Every filing's results are a file, of as many rows as there are rules; so many files are written by one task.
FILINGS_PER_TASK = 50
RESULTS = "rule_id string, error_count long, total_count long, violation_rate double, engine_failure string, cid string, period string"


def _by_filing(ctx: FilingContext) -> list[str]:
    return [t for t in TABLES if ctx.has(t) and set(FILING_KEYS) <= set(ctx.table(t).columns)]


def _hashes(df: DataFrame, table: str) -> tuple[str, str]:
    names = sorted(df.columns)
    columns = ", ".join(f"`{c}`" for c in names)
    # Nulls are skipped by the hash, so which columns are null is hashed with them, a bit for each.
    bits = [f"IF(`{c}` IS NULL, {1 << i % 62}L, 0L)" for i, c in enumerate(names)]
    nulls = ", ".join(" | ".join(bits[i:i + 62]) for i in range(0, len(bits), 62))
    return f"xxhash64('{table}', {columns}, {nulls})", f"xxhash64({nulls}, {columns}, '{table}')"


def _sum(name: str) -> Column:
    """Exact sum of a column of longs. Decimals are slow to add row by row, so three runs of its bits are summed as longs (room
    for 4 * 10^12 rows) and put together at the end."""
    low = (1 << 21) - 1
    bits = [(F.shiftright(name, 42), 1 << 42), (F.shiftright(name, 21).bitwiseAND(low), 1 << 21), (F.col(name).bitwiseAND(low), 1)]
    return reduce(Column.__add__, [F.sum(b).cast("decimal(19,0)") * F.lit(place).cast("decimal(13,0)") for b, place in bits]).cast("decimal(38,0)")


def fingerprints(ctx: FilingContext, groups: list[Group], version: str = "") -> DataFrame:
    """(cid, period, n_rows, hash_sum, hash_xor, version) of every filing, as far as the groups read it."""
    words = words_read(groups)
    own = _by_filing(ctx)
    frames = {"filings": ctx.filings}
    for t in own:
        if words is None:
            frames[t] = ctx.table(t)
        elif t in words or t == "transactions":
            frames[t] = ctx.table(t).select(*columns_read(ctx, words, t))
    parts = []
    for t, df in frames.items():
        a, b = _hashes(df, t)
        parts.append(df.selectExpr(*FILING_KEYS, f"{a} AS a", f"{b} AS b"))
    common = [ctx.table(t).selectExpr(f"{_hashes(ctx.table(t), t)[0]} AS a")
              for t in sorted(set(ctx.tables) - set(own) - {"filings"}) if words is None or t in words]
    rows = reduce(DataFrame.unionByName, parts)
    found = rows.groupBy(*FILING_KEYS).agg(F.count(F.lit(1)).alias("n_rows"), _sum("a").alias("hash_sum"), F.bit_xor("b").alias("hash_xor"))
    # One number for what all filings share.
    shared = reduce(DataFrame.unionByName, common).agg(_sum("a").alias("s"), F.count("a").alias("n")) if common else None
    row = shared.head() if shared is not None else None
    return found.withColumn("version", F.xxhash64(F.lit(version), F.lit(str(row and row.s)), F.lit(str(row and row.n))))


def only(ctx: FilingContext, filings: DataFrame) -> FilingContext:
    """The context cut down to some filings; lakes kept by filing read only their partitions."""
    wanted = filings.select(*[F.col(k).alias(f"_{k}") for k in FILING_KEYS])
    on = F.expr(" AND ".join(f"{k} <=> _{k}" for k in FILING_KEYS))
    kept = {t: df.join(wanted, on, "left_semi") if t in _by_filing(ctx) or t == "filings" else df for t, df in ctx.tables.items()}
    return FilingContext(ctx.spark, kept, ctx.settings)


def refresh(ctx: FilingContext, groups: list[Group], path: str, version: str = "") -> int:
    """Bring the results below ``path`` up to date; returns how many filings were validated.

    ``version`` names the rules and settings: with another version every filing is validated. The state is written last, so
    a run that breaks off is done again.
    """
    spark = ctx.spark
    now_path, changed_path = scratch_path(spark, "fingerprints"), scratch_path(spark, "changed")
    fingerprints(ctx, groups, version).write.parquet(now_path)
    now = spark.read.schema(STATE).parquet(now_path)
    before = read_optional(spark, f"{path}/state", spark.createDataFrame([], STATE).schema)
    same = F.expr(" AND ".join(f"n.{c} <=> b.{c}" for c in [*FILING_KEYS, *FINGERPRINT, "version"]))
    now.alias("n").join(before.alias("b"), same, "left_anti").select(*FILING_KEYS).write.parquet(changed_path)
    changed = spark.read.schema("cid string, period string").parquet(changed_path)
    n = changed.count()
    if n:
        # Every filing has a row for every rule, so each changed partition is replaced as a whole.
        stats = validate(ctx if n == now.count() else only(ctx, changed), groups).stats
        upsert_partitions(stats.select("rule_id", "error_count", "total_count", "violation_rate", "engine_failure", *FILING_KEYS), f"{path}/results", FILING_KEYS, -(-n // FILINGS_PER_TASK))
    now.write.mode("overwrite").parquet(f"{path}/state")
    return n


def current(ctx: FilingContext, path: str) -> DataFrame:
    """Results of the filings there are; those of filings that are gone stay on disk but are not returned."""
    results = read_optional(ctx.spark, f"{path}/results", ctx.spark.createDataFrame([], RESULTS).schema)
    state = ctx.spark.read.schema(STATE).parquet(f"{path}/state").select(*[F.col(k).alias(f"_{k}") for k in FILING_KEYS])
    return results.join(state, F.expr(" AND ".join(f"{k} <=> _{k}" for k in FILING_KEYS)), "left_semi")
