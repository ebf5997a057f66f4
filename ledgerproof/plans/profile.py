"""Schema profile of a set of tables: columns, types, key candidates, joinable columns."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerproof.session import scratch_path

AGREEMENT_KEYS = ("contract_service_agreement", "contract_service_agreement_id")
# Columns on which transactions and contracts also have to agree, where both have them.
OPTIONAL_KEYS = ["product_name", "rate_units", "class_name", "term_name"]


def type_name(data_type: T.DataType) -> str:
    """INT64, DOUBLE, BOOLEAN, and STRING for anything else."""
    if isinstance(data_type, (T.LongType, T.IntegerType)):
        return "INT64"
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return "DOUBLE"
    return "BOOLEAN" if isinstance(data_type, T.BooleanType) else "STRING"


def key_column(names: list[str]) -> str | None:
    """First column that looks like a unique identifier."""
    return next((n for n in names if n.endswith("_unique_id")), None)


def schema_profile(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """One row per column. Reads schemas only."""
    rows = []
    for table, df in tables.items():
        key = key_column(df.columns)
        for position, f in enumerate(df.schema.fields):
            sharing = sorted(t for t, other in tables.items() if t != table and f.name in other.columns)
            rows.append((table, position, f.name, type_name(f.dataType), f.name == key, ", ".join(sharing)))
    return spark.createDataFrame(
        rows, "table_name string, position int, column_name string, data_type string, is_key_candidate boolean, shared_with string"
    )


def column_values(tables: dict[str, DataFrame]) -> DataFrame:
    """(at, kind, value): the values of every column that are not null, from one scan per table; ``at`` numbers the columns
    of all tables in order. Text and numbers are kept apart; whole numbers of any type compare as one text."""
    text = {"STRING": "CAST(`{0}` AS STRING)", "INT64": "CAST(CAST(`{0}` AS BIGINT) AS STRING)", "BOOLEAN": "CAST(CAST(`{0}` AS INT) AS STRING)",
            "DOUBLE": "IF(`{0}` = floor(`{0}`) AND abs(`{0}`) < 9e18D, CAST(CAST(`{0}` AS BIGINT) AS STRING), CAST(CAST(`{0}` AS DOUBLE) AS STRING))"}
    parts, first = [], 0
    for df in tables.values():
        entries = []
        for at, f in enumerate(df.schema.fields, first):
            kind = type_name(f.dataType)
            entries.append(f"named_struct('at', {at}, 'kind', '{'STRING' if kind == 'STRING' else 'NUMBER'}', 'value', {text[kind].format(f.name)})")
        first += len(entries)
        parts.append(df.selectExpr(f"explode(array({', '.join(entries)})) AS e").select("e.*"))
    return reduce(DataFrame.unionByName, parts).where("value IS NOT NULL")


def joinable_columns(tables: dict[str, DataFrame], least: float = 0.9) -> DataFrame:
    """Pairs of columns of different tables where (nearly) all values of the left one occur in the right one.

    (left_table, left_column, right_table, right_column, n_left, n_right, containment), all exact. A value is shuffled once
    per column that holds it and task; then it is one row with the list of its columns, and equal lists are counted. Pairs
    are formed from those lists, of which there are no more than sets of columns that share a value, never from rows.
    """
    names = [(t, c) for t, df in tables.items() for c in df.columns]
    held = column_values(tables).distinct().groupBy("kind", "value").agg(F.sort_array(F.collect_list("at")).alias("columns"))
    # Read three times below, so stored: a few rows.
    lists, spark, path = held.groupBy("columns").agg(F.count(F.lit(1)).alias("n")), held.sparkSession, scratch_path(held.sparkSession, "columns")
    lists.write.parquet(path)
    lists = spark.read.schema(lists.schema).parquet(path)
    both = lists.select(F.explode("columns").alias("a"), "columns", "n").select("a", F.explode("columns").alias("b"), "n").groupBy("a", "b").agg(F.sum("n").alias("n_both"))
    sizes = both.where("a = b").select(F.col("a").alias("at"), F.col("n_both").alias("n"))
    table, column = (F.array(*[F.lit(n[i]) for n in names]) for i in (0, 1))
    left = sizes.select(F.col("at").alias("a"), F.col("n").alias("n_left"))
    right = sizes.select(F.col("at").alias("b"), F.col("n").alias("n_right"))
    pairs = both.join(left, "a").join(right, "b").select(
        *[F.get(of, F.col(at)).alias(f"{side}_{what}") for side, at in (("left", "a"), ("right", "b")) for what, of in (("table", table), ("column", column))],
        "n_left", "n_right", "n_both")
    # The limit is compared as a decimal, before the share is rounded.
    enough = (F.col("left_table") != F.col("right_table")) & (F.col("n_both") >= F.lit(Decimal(str(least))) * F.col("n_left"))
    return pairs.where(enough).select("left_table", "left_column", "right_table", "right_column", "n_left", "n_right", F.round(F.col("n_both") / F.col("n_left"), 6).alias("containment"))


def key_uniqueness(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Tests each key candidate: rows, distinct values, nulls, and whether it is a key.

    Values are counted per key first, so the shuffle carries partial counts and no value set grows.
    """
    parts = []
    for table, (df, column) in tables.items():
        per_value = df.groupBy(F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("n"))
        parts.append(
            per_value.agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("v").alias("n_distinct"),
                F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("n_null"),
            ).select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "n_rows", "n_distinct", "n_null",
                     ((F.col("n_rows") == F.col("n_distinct")) & (F.col("n_null") == 0)).alias("is_unique"))
        )
    return reduce(DataFrame.unionByName, parts)
