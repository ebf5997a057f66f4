"""Briefs, evidence, matrix and audit report: all frames of at most (rules x filings) rows."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ledgerproof import constants as K
from ledgerproof.context import FILING_KEYS
from ledgerproof.operators.groups import first_per_group
from ledgerproof.operators.joins import without_partner
from ledgerproof.operators.results import matrix, needs_brief, outcome_text, samples

RESULT_SCHEMA = "cid string, code string, name string, result string"


def alerts(rule_stats: DataFrame) -> DataFrame:
    """Rules whose rate or count calls for a brief."""
    return rule_stats.filter(needs_brief(F.col("error_count"), F.col("total_count")))


def briefs(violations: DataFrame, rule_stats: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Per fired rule: counts, rate and up to five sample records."""
    fired = rule_stats.filter("error_count > 0")
    described = fired.join(catalogue.select("rule_id", "severity", "description"), "rule_id", "left")
    return described.join(samples(violations), "rule_id", "left").select(
        "rule_id", "severity", "description", "error_count", "total_count", "violation_rate", "sample_records"
    )


def mismatch_evidence(transactions: DataFrame, contracts: DataFrame, agreement: tuple[str, str], product: str) -> DataFrame:
    """Transactions without a contract for (agreement, product), one row for each product the agreement authorizes."""
    left_key, right_key = agreement
    terms = contracts.select(F.col(right_key).alias(left_key), product).distinct()
    failed = without_partner(transactions, terms, [left_key, product])
    joined = failed.join(terms.withColumnRenamed(product, "authorized_product"), left_key, "left")
    return joined.withColumn("authorized_product", F.coalesce("authorized_product", F.lit(K.NO_AGREEMENT)))


def outcomes(stats: DataFrame, catalogue: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Outcome text per company and rule, in catalogue order. Per filing with ``keys=FILING_KEYS``."""
    keys = keys or ["cid"]
    total = stats.groupBy(*keys, "rule_id").agg(
        F.sum("error_count").alias("error_count"), F.max("engine_failure").alias("engine_failure")
    )
    named = total.join(catalogue.select("rule_id", "seq", "description"), "rule_id")
    return named.select(
        *keys, "seq", F.col("rule_id").alias("code"), F.col("description").alias("name"),
        outcome_text(F.col("error_count"), F.col("engine_failure")).alias("result"),
    ).orderBy(*keys, "seq")


def result_matrix(results: DataFrame, codes: list[str]) -> DataFrame:
    return matrix(results.select("cid", "code", "result"), "cid", "code", codes, "result")


def rolled_up(violations: DataFrame) -> DataFrame:
    """One violation per (rule, filing); the first record in order gives message and severity."""
    return first_per_group(violations, ["rule_id", *FILING_KEYS], ["record_id", "message", "severity"], ["record_id", "message", "severity"])


def report_lines(rule_stats: DataFrame, catalogue: DataFrame, title: str) -> DataFrame:
    """Audit report as numbered text lines: title, summary line, one row per fired rule."""
    spark = rule_stats.sparkSession
    fired = rule_stats.filter("error_count > 0").join(
        catalogue.select("rule_id", "seq", "severity", "description"), "rule_id", "left"
    )
    total = fired.agg(F.coalesce(F.sum("error_count"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("rules"))
    summary_text = F.when(F.col("rules") == 0, F.lit("No violations detected. The filing is compliant.")).otherwise(
        F.format_string("%d violations detected by %d rules.", F.col("total"), F.col("rules"))
    )
    head = spark.range(1).select(F.lit(0).cast("long").alias("line_no"), F.lit(f"# {title}").alias("line"))
    body = fired.select(
        # Largest count first, then catalogue order; line numbers only need to sort that way.
        (F.lit(10**15) - F.col("error_count") * 1000 + F.col("seq")).cast("long").alias("line_no"),
        F.concat(F.lit("| "), "rule_id", F.lit(" | "), F.coalesce("severity", F.lit("N/A")), F.lit(" | "),
                 F.format_number("error_count", 0), F.lit(" | "), F.coalesce("description", F.lit("N/A")),
                 F.lit(" |")).alias("line"),
    )
    return head.unionByName(total.select(F.lit(1).cast("long").alias("line_no"), summary_text.alias("line"))).unionByName(body)


def timed(source: DataFrame, query: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run a query once and report the rows it scanned, seconds and rows per second as a one-row frame."""
    scanned = Observation("scanned")
    began = time.perf_counter()
    query(source.observe(scanned, F.count(F.lit(1)).alias("n"))).write.format("noop").mode("overwrite").save()
    seconds, rows = time.perf_counter() - began, scanned.get["n"]
    return source.sparkSession.range(1).select(
        F.lit(rows).cast("long").alias("rows_scanned"), F.lit(round(seconds, 4)).alias("seconds"),
        F.lit(int(rows / seconds) if seconds > 0 else 0).cast("long").alias("rows_per_second"),
    )
