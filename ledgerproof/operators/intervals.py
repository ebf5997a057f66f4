"""Joins on validity intervals ``start <= point < end`` (an open end is null)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def effective_at(point: Column, start: str, end: str) -> Column:
    return (F.col(start) <= point) & (F.col(end).isNull() | (point < F.col(end)))


def overlaps(first: Column, last: Column, start: str, end: str) -> Column:
    """Valid for some day of [first, last]."""
    return (F.col(start) <= last) & (F.col(end).isNull() | (F.col(end) > first))


def interval_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    point: str,
    start: str,
    end: str,
    how: str = "inner",
) -> DataFrame:
    """Join each left row to the right versions of its key that are valid at its date.

    Both sides also carry a year bucket and are joined on (key, bucket), so a key with many rows
    spreads over its years and a row meets only the versions of its own year. The years are those
    the left side has (two numbers, read first); a version is listed for the ones it reaches.
    """
    years = left.agg(F.min(F.year(point)).alias("first"), F.max(F.year(point)).alias("last")).first()
    rows = left.withColumn("_bucket", F.year(point))
    first = F.greatest(F.year(start), F.lit(years["first"]))
    last = F.least(F.coalesce(F.year(end), F.lit(years["last"])), F.lit(years["last"]))
    valid = (F.col(end).isNull() | (F.col(start) < F.col(end))) & (first <= last)
    versions = right.filter(valid).withColumn("_bucket", F.explode(F.sequence(first, last)))
    version_key, version_bucket = versions[key], versions["_bucket"]
    on = (rows[key] == version_key) & (rows["_bucket"] == version_bucket) & effective_at(F.col(point), start, end)
    joined = rows.join(versions, on, how)
    return joined.drop(rows["_bucket"]) if how in ("left_semi", "left_anti") else joined.drop(
        version_key
    ).drop("_bucket")


def covered(spans: DataFrame, versions: DataFrame, keys: list[str], name: str = "covered") -> DataFrame:
    """Spans (keys, first, last and whatever else) with a flag: is some version of the key valid on a day of the span?

    ``versions`` has the keys, start and end. One ordered pass: versions and spans of a key are merged by date, versions by
    start and spans by last day, and the latest end so far is carried along; a span is covered if that end lies after its
    first day. An open end is later than all. A key's line of dates is cut into years, each a piece of work of its own that
    begins with the latest end of the years before it (one row per key and year), so a key with a third of all rows is many
    tasks. A null key, first or last day is not covered.
    """
    ever = F.lit("9999-12-31").cast("date")
    rest = [c for c in spans.columns if c not in keys]
    asked = spans.select(*keys, F.col("last").alias("_day"), F.lit(1).alias("_side"), F.lit(None).cast("date").alias("_end"), F.struct(*rest).alias("_row"))
    valid = versions.dropna(subset=[*keys, "start"])
    told = valid.select(*keys, F.col("start").alias("_day"), F.lit(0).alias("_side"), F.coalesce("end", ever).alias("_end"))
    merged = asked.unionByName(told, allowMissingColumns=True).withColumn("_year", F.year("_day"))
    # What each year begins with: the same pass over one row per key and year.
    before = Window.partitionBy(*keys).orderBy("_from").rangeBetween(Window.unboundedPreceding, -1)
    by_year = merged.groupBy(*keys, F.col("_year").alias("_from")).agg(F.max("_end").alias("_reach"))
    carried = by_year.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_from", F.max("_reach").over(before).alias("_carried"))
    so_far = Window.partitionBy(*keys, "_year").orderBy("_day", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    passed = merged.withColumn("_reach", F.max("_end").over(so_far)).where("_side = 1")
    on = F.expr(" AND ".join([f"{k} <=> _k{i}" for i, k in enumerate(keys)] + ["_year <=> _from"]))
    reach = F.greatest("_reach", "_carried")
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    flag = F.coalesce(known & F.col("_row.last").isNotNull() & (reach > F.col("_row.first")), F.lit(False))
    return passed.join(carried, on, "left").select(*keys, "_row.*", flag.alias(name))
