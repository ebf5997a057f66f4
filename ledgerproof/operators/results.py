"""Operators over violations and per-rule counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerproof import constants as K
from ledgerproof.operators.joins import left_join_null_safe


def first_n_per_group(df: DataFrame, group: list[str], order: list[str], n: int) -> DataFrame:
    """Deterministic sample. Spark keeps at most n rows per group in each task before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    """Counts per key, largest first, ties in key order."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), *keys)


def rate(errors: Column, total: Column) -> Column:
    return F.when(total > 0, errors / total).otherwise(F.lit(0.0))


def outcome_text(count: Column, failure: Column) -> Column:
    return (
        F.when(failure.isNotNull(), F.concat(F.lit("Failed Execution: "), failure))
        .when(count > 0, F.concat(F.lit("Failed ("), count.cast("string"), F.lit(" violations)")))
        .otherwise(F.lit("Passed"))
    )


def outcome_count(text: Column) -> Column:
    """Count out of an outcome text; any other text is returned as it is."""
    digits = F.regexp_extract(text, r"Failed \((\d+) violations\)", 1)
    return (
        F.when(text == "Passed", F.lit("0"))
        .when(text.startswith("Failed (") & (digits != ""), digits)
        .otherwise(text)
    )


def category(rule_id: Column, severity: Column) -> Column:
    structural = F.lit(False)
    for prefix in K.STRUCTURAL_PREFIXES:
        structural = structural | rule_id.startswith(prefix)
    return (
        F.when(severity == "Critical", "CONSISTENCY")
        .when(severity == "Warning", "BOUNDS")
        .when(structural, "STRUCTURAL")
        .otherwise("MANDATORY")
    )


def stage(category_name: Column) -> Column:
    pairs = [F.lit(v) for item in K.STAGE_OF_CATEGORY.items() for v in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), category_name), F.lit(K.DEFAULT_STAGE))


def needs_brief(count: Column, total: Column) -> Column:
    return (rate(count, total) >= K.BRIEF_RATE) | (count > K.BRIEF_COUNT)


def matrix(df: DataFrame, row: str, column: str, values: list[str], cell: str) -> DataFrame:
    """One row per company and one text column per rule, ``N/A`` where there is no result.

    The column list is given, so this is one job with a stable schema. The input has one cell per
    (row, column).
    """
    wide = df.groupBy(row).pivot(column, values).agg(F.max(cell))
    # Rule ids hold dots, so column names are quoted.
    return wide.select(row, *[F.coalesce(F.col(f"`{v}`"), F.lit("N/A")).alias(v) for v in values])


def acceptance(violations: DataFrame, filings: DataFrame) -> DataFrame:
    """Any violation of severity Error rejects the filing."""
    bad = violations.groupBy("cid", "period").agg(F.bool_or(F.col("severity") == "Error").alias("rejected"))
    joined = left_join_null_safe(filings.select("cid", "period"), bad, ["cid", "period"])
    status = F.when(F.coalesce("rejected", F.lit(False)), "rejected").otherwise("accepted")
    return joined.select("cid", "period", status.alias("status"))


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """New rows replace all old rows of the same key."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def samples(violations: DataFrame, n: int = K.BRIEF_SAMPLES) -> DataFrame:
    """Up to n messages per rule, in record order, as one array of bounded length."""
    order = ["record_id", "cid", "period", "message"]
    picked = first_n_per_group(violations, ["rule_id"], order, n)
    item = F.struct("record_id", "cid", "period", "message")
    return picked.groupBy("rule_id").agg(F.sort_array(F.collect_list(item)).alias("sample_records"))


def first_keys(violations: DataFrame, n: int = 10) -> DataFrame:
    """The first n offending record ids per rule, as one text."""
    ids = violations.filter(F.col("record_id").isNotNull()).select("rule_id", "record_id").distinct()
    picked = first_n_per_group(ids, ["rule_id"], ["record_id"], n)
    listed = F.array_join(F.sort_array(F.collect_list("record_id")), ", ")
    return picked.groupBy("rule_id").agg(listed.alias("record_ids"))


def summary(stats: DataFrame) -> DataFrame:
    """Total of violations and number of rules that fired."""
    return stats.agg(
        F.coalesce(F.sum("error_count"), F.lit(0)).alias("total"),
        F.count_if(F.col("error_count") > 0).alias("rules_fired"),
    )
