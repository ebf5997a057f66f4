"""Join operators. Sides are never broadcast by hand here: Spark does so only when the
measured size is below ``spark.sql.autoBroadcastJoinThreshold``, and adaptive execution splits
hot keys of the shuffled form."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerproof.session import scratch_path


def without_partner(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``left`` with no row of ``right`` on the keys; a null key has no partner."""
    return left.join(right.select(*keys).distinct(), keys, "left_anti")


def with_partner(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.join(right.select(*keys).distinct(), keys, "left_semi")


def partner_optional(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of ``left``, with the columns of ``right`` or nulls."""
    return left.join(right, keys, "left")


def shared_keys(left: DataFrame, right: DataFrame, base: list[str], optional: list[str]) -> list[str]:
    """Base keys plus those optional keys that both sides have."""
    both = set(left.columns) & set(right.columns)
    return base + [c for c in optional if c in both]


def adaptive_join(left: DataFrame, right: DataFrame, base: list[str], optional: list[str], how: str = "inner") -> DataFrame:
    """Join on as many of the agreed keys as both schemas offer."""
    return left.join(right, shared_keys(left, right, base, optional), how)


def edge_table(left: DataFrame, right: DataFrame, keys: list[str], src: str, dst: str) -> DataFrame:
    """(src, dst) pairs of rows that agree on the keys; both sides are reduced to distinct first."""
    a = left.select(*keys, src).distinct()
    b = right.select(*keys, dst).distinct()
    return a.join(b, keys).select(src, dst)


def not_in_edge(left: DataFrame, edges: DataFrame, src: str) -> DataFrame:
    return left.join(edges.select(src).distinct(), [src], "left_anti")


def known_group_unknown_member(left: DataFrame, right: DataFrame, group: list[str], member: list[str]) -> DataFrame:
    """Rows whose group occurs on the right but whose (group, member) does not."""
    return without_partner(with_partner(left, right, group), right, group + member)


def within_hops(edges: DataFrame, roots: DataFrame, hops: int = 3) -> DataFrame:
    """Nodes reachable from the roots in at most ``hops`` steps, each once, with the least number of steps: (root, node, hops).

    ``edges`` has (src, dst); ``roots`` has (root). Every step goes on only from nodes reached for the first time (an anti
    join with those seen), so cycles and many paths to one node cost nothing more, and a root does not reach itself. Levels
    are written to the shared folder; a step that reaches nothing new is the last.
    """
    spark = edges.sparkSession
    steps = edges.select("src", "dst").distinct()
    seen = roots.select("root", F.col("root").alias("node"), F.lit(0).alias("hops")).distinct()
    frontier = seen
    for depth in range(1, hops + 1):
        ahead = frontier.join(steps, F.col("node") == F.col("src")).select("root", F.col("dst").alias("node")).distinct()
        path = scratch_path(spark, "hops")
        ahead.join(seen, ["root", "node"], "left_anti").withColumn("hops", F.lit(depth)).write.parquet(path)
        frontier = spark.read.schema(seen.schema).parquet(path)
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier)
    return seen.where("hops > 0")


GRAM = 3


def _grams(text: Column, size: int) -> Column:
    """Distinct runs of ``size`` characters of a text; none if it is shorter."""
    last = F.char_length(text) - size + 1
    starts = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, F.lit(size))))


def match_names(index: DataFrame, names: list[str] | DataFrame, column: str) -> DataFrame:
    """(index row, search_name) for every wanted name contained in the column, ignoring case.

    Each name is looked up by the rarest of its runs of three characters (shorter names by themselves): values of the column
    that hold this run are candidates and are compared in full. Work grows with the names, the distinct values and the
    candidates, not with names times rows. A blank name is contained in every value; a null one, or a null value, in none.
    """
    spark = index.sparkSession
    wanted = names if isinstance(names, DataFrame) else spark.createDataFrame([(n,) for n in names], "search_name string")
    low = F.lower("search_name")
    wanted = wanted.select("search_name", low.alias("_low")).dropna().distinct()
    values = index.select(F.lower(F.col(column)).alias("_value")).dropna().distinct()
    sizes = F.explode(F.array(*[F.lit(n) for n in range(GRAM + 1)])).alias("_size")
    size = F.least(F.char_length("_low"), F.lit(GRAM))
    own = wanted.select("search_name", "_low", size.alias("_size")).select("*", F.explode(F.when(F.col("_size") > 0, _by_size("_low")).otherwise(F.array(F.lit("")))).alias("_gram"))
    asked = wanted.select(size.alias("_size")).distinct()
    held = values.select("_value", sizes).join(asked, "_size", "left_semi").select("_value", "_size", F.explode(F.when(F.col("_size") > 0, _by_size("_value")).otherwise(F.array(F.lit("")))).alias("_gram"))
    often = held.join(own.select("_gram").distinct(), "_gram", "left_semi").groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    rarest = own.join(often, "_gram").groupBy("search_name", "_low").agg(F.min_by("_gram", F.struct("_n", "_gram")).alias("_gram"))
    found = held.select("_value", "_gram").join(rarest, "_gram").where(F.contains("_value", "_low")).select("_value", "search_name")
    return index.join(found, F.lower(F.col(column)) == F.col("_value")).drop("_value")


def _by_size(name: str) -> Column:
    text, size = F.col(name), F.col("_size")
    return F.when(size == 1, _grams(text, 1)).when(size == 2, _grams(text, 2)).otherwise(_grams(text, GRAM))


def with_flag(left: DataFrame, right: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """Left rows with a boolean that tells whether the keys occur on the right."""
    marks = right.select(*keys).distinct().withColumn(flag, F.lit(True))
    return left.join(marks, keys, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def left_join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on equal keys, where null equals null; the keys appear once."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = F.expr(" AND ".join(f"{k} <=> _right_{k}" for k in keys))
    return left.join(renamed, on, "left").drop(*[f"_right_{k}" for k in keys])
