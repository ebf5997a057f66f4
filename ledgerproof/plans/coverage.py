"""Which of the wanted companies are registered, and what the lake holds of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerproof.operators.joins import match_names


def company_coverage(names: list[str], index: DataFrame, transactions: DataFrame, contracts: DataFrame) -> DataFrame:
    """One row per wanted name, matched company and period found, with one of three outcomes.

    ``index`` has (cid, legal_name); the two pillars have (cid, period) and any number of rows.
    """
    spark = index.sparkSession
    wanted = spark.createDataFrame([(n,) for n in names], "search_name string")
    matched = match_names(index, names, "legal_name").groupBy("search_name", "cid").agg(F.min("legal_name").alias("matched_name"))
    counts = transactions.groupBy("cid", "period").agg(F.count(F.lit(1)).alias("tx_records"))
    terms = contracts.groupBy("cid", "period").agg(F.count(F.lit(1)).alias("ct_records"))
    held = counts.join(terms, ["cid", "period"], "left")
    found = matched.join(held, "cid").select(
        "search_name", "matched_name", "cid", "period", "tx_records",
        F.coalesce("ct_records", F.lit(0)).alias("ct_records"), F.lit("Found in Lake").alias("status"),
    )
    in_lake = found.select("search_name").distinct()
    first = matched.groupBy("search_name").agg(F.min_by(F.struct("matched_name", "cid"), F.struct("cid", "matched_name")).alias("m"))
    nothing = F.lit(None).cast("long")
    rest = (
        wanted.join(in_lake, "search_name", "left_anti").join(first, "search_name", "left")
        .select(
            "search_name", "m.matched_name", "m.cid", F.lit(None).cast("string").alias("period"),
            nothing.alias("tx_records"), nothing.alias("ct_records"),
            F.when(F.col("m").isNull(), "Not in Index").otherwise("Found in Index, not in Lake").alias("status"),
        )
    )
    return found.unionByName(rest)
