"""Mixing sources to target weights by entropy balancing.

A document d of source s gets a rate r (how often it is taken on average). Among all rates between 0 and 3 whose tokens
meet the source's target, sum(r * size) = target, the entropy-balanced ones are the least informative: an exponential
tilt r = min(3, exp(lambda_s * size / mean size of s)). lambda solves a convex dual, one equation per source, by Newton
steps kept inside a bracket. Documents of one source and size share a rate, so the steps run over (source, size) counts
and each step is one aggregation. Rates become copies by systematic rounding: documents of a source, dealt into pieces
of about ``piece_rows``, are ordered by size and the running sum of the fractional rates decides who gets one copy more.
Neighbours have nearly equal sizes, so a piece misses its tokens by less than its largest document; at last single documents
that fit into a source's gap get a copy more or less.

All sums are taken over whole numbers, so reruns agree whatever order rows arrive in. Hot sources are counts in the
steps and pieces in the rounding.

Nulls: a null text has size 0 and a null source is a source of its own, ordered last. Documents of size 0 are never
taken more than once and change nothing. Repeated rows are documents of their own. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerproof.llm.base import stored, table, words

NAME = "op8_mix_sources"
WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
UNIT = 1_000_000  # rates are whole millionths
STEPS = 60
PIECE_ROWS = 20_000
FITS = 3
SQL = None


def _exact(value: Column) -> Column:
    return value.cast("decimal(38,0)")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """Per source: source_size, documents, target. One row per source goes through the two ordered windows."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents"))
    per = per.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1)
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")))
    # Water filling: in order of cap / weight, the first sources are capped while the level reaches their cap.
    per = per.withColumn("cap_level", most * F.col("source_size") / F.col("weight"))
    order = Window.orderBy("cap_level", "place")
    whole, after, before = Window.partitionBy(), order.rowsBetween(0, Window.unboundedFollowing), order.rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumns({"total": F.sum("source_size").over(whole), "open": F.sum("weight").over(after), "full": F.coalesce(F.sum(most * F.col("source_size")).over(before), F.lit(0))})
    per = per.withColumn("level", (F.col("total") - F.col("full")) / F.col("open"))
    first_open = F.min(F.when(F.col("level") <= F.col("cap_level"), F.struct("cap_level", "place", "level"))).over(whole)
    per = per.withColumn("level", first_open["level"])
    target = F.least(F.lit(float(most)) * F.col("source_size"), F.col("level") * F.col("weight"))
    return per.select("source", "source_size", "documents", F.coalesce(target, most * F.col("source_size").cast("double")).alias("target"))


def _tilt(most: int) -> Column:
    """The rate in units; what lies beyond the bounds of exp is cut by the cap anyway."""
    return F.least(F.lit(most * UNIT), F.round(F.exp(F.least(F.col("lam") * F.col("z"), F.lit(5.0))) * UNIT).cast("long"))


def balance(counts: DataFrame, targets: DataFrame, most: int = MOST_COPIES, steps: int = STEPS) -> DataFrame:
    """lambda per source from counts (source, size, n); Newton steps inside a bracket, stored after each step."""
    data = stored(counts.where("size > 0").join(targets, counts["source"].eqNullSafe(targets["source"])).select(
        counts["source"], "size", "n", "target", (F.col("size") * F.col("documents") / F.col("source_size")).alias("z")), "mix-counts")
    # At the upper end even the smallest document has the most copies; a target of that much starts and stays there.
    state = stored(targets.where("source_size > 0").select(
        "source", "target", F.lit(-1000.0).alias("low"), (F.col("source_size") * 1.2).alias("high"),
        F.when(F.col("target") >= most * F.col("source_size"), F.col("source_size") * 1.2).otherwise(F.log(F.col("target") / F.col("source_size"))).alias("lam"),
        (F.col("target") >= most * F.col("source_size")).alias("done")), "mix-state")
    for _ in range(steps):
        if state.where("not done").isEmpty():
            break
        rate = _tilt(most)
        moved = data.drop("target").join(state.where("not done"), data["source"].eqNullSafe(state["source"])).select(state["source"], "size", "n", "z", "lam").withColumn("rate", rate)
        sums = moved.groupBy("source").agg(
            (F.sum(_exact(F.col("n") * F.col("size")) * _exact(F.col("rate"))).cast("double") / UNIT).alias("got"),
            (F.sum(F.when(F.col("rate") < most * UNIT, _exact(F.col("n") * F.col("size")) * _exact(F.round(F.col("rate") * F.least(F.col("z"), F.lit(1e6)))))).cast("double") / UNIT).alias("slope"))
        step = state.join(sums.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left")
        over = F.col("got") > F.col("target")
        low, high = F.when(over, F.col("low")).otherwise(F.col("lam")), F.when(over, F.col("lam")).otherwise(F.col("high"))
        newton = F.col("lam") - F.try_divide(F.col("got") - F.col("target"), F.col("slope"))
        inside = F.coalesce((newton > low) & (newton < high), F.lit(False))
        settled = F.abs(F.col("got") - F.col("target")) <= F.col("target") * 1e-5 + 0.5
        state = stored(step.select(
            "source", "target",
            F.when(F.col("done") | settled, F.col("low")).otherwise(low).alias("low"), F.when(F.col("done") | settled, F.col("high")).otherwise(high).alias("high"),
            F.when(F.col("done") | settled, F.col("lam")).when(inside, newton).otherwise((low + high) / 2).alias("lam"),
            (F.col("done") | settled | (high - low < 1e-12)).alias("done")), "mix-state")
    return state.select("source", "lam")


def _fit(rounded: DataFrame, most: int) -> DataFrame:
    """Per source, one copy more or less of the largest document that fits into what is missing or too much."""
    gaps = rounded.groupBy("source").agg((F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("gap")).withColumnRenamed("source", "s")
    open_ = F.when(F.col("gap") > 0, F.col("copies") < most).otherwise(F.col("copies") > 0)
    fits = rounded.join(gaps, F.col("source").eqNullSafe(F.col("s"))).where(open_ & (F.col("size") > 0) & (F.col("size") <= F.abs("gap")))
    chosen = fits.groupBy("s").agg(F.max(F.struct("size", "row", F.signum("gap").cast("long").alias("sign"))).alias("fit"))
    return rounded.join(chosen, F.col("source").eqNullSafe(F.col("s")), "left").withColumn(
        "copies", F.col("copies") + F.when(F.col("row") == F.col("fit.row"), F.col("fit.sign")).otherwise(0)).drop("s", "fit")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, piece_rows: int = PIECE_ROWS, keep: tuple[str, ...] = ()) -> DataFrame:
    """Per input row: doc_id, size, source, source_size, target, rate, copies, taken, and the columns to keep."""
    sizes = stored(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", *keep, "source", F.size(words(F.col("text"))).cast("long").alias("size")), "mix-sizes")
    targets = stored(source_targets(sizes, weights, most), "mix-targets")
    lam = balance(sizes.groupBy("source", "size").agg(F.count("*").alias("n")), targets, most)
    per = targets.join(lam.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s").withColumnRenamed("source", "s")
    rated = sizes.join(per, F.col("source").eqNullSafe(F.col("s")), "left").withColumn("z", F.try_divide(F.col("size") * F.col("documents"), F.col("source_size")))
    rated = rated.withColumn("rate", F.coalesce(F.when(F.col("size") > 0, _tilt(most)), F.lit(UNIT)))
    pieces = F.ceil(F.col("documents") / piece_rows)
    rated = rated.withColumn("piece", F.pmod(F.xxhash64("doc_id"), pieces))
    run = F.sum(F.col("rate") % UNIT).over(Window.partitionBy("source", "piece").orderBy("size", "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    rated = rated.withColumn("run", run + UNIT // 2)
    extra = F.floor(F.col("run") / UNIT) - F.floor((F.col("run") - F.col("rate") % UNIT) / UNIT)
    copies = (F.floor(F.col("rate") / UNIT) + extra).cast("long")
    rounded = stored(rated.select("row", "doc_id", *keep, "size", "source", "source_size", "target", (F.col("rate") / UNIT).alias("rate"), copies.alias("copies")), "mix-copies")
    for _ in range(FITS):
        rounded = _fit(rounded, most)
    return rounded.withColumn("taken", F.col("copies") * F.col("size"))


def mixed(docs: DataFrame) -> DataFrame:
    """The documents of the mix with all their columns, each as often as it is taken."""
    keyed = docs.withColumns({"_id": F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "_text": F.xxhash64("text", "doc_id")})
    taken = mix(keyed, keep=("_id", "_text")).groupBy("_id", "_text").agg(F.sum("copies").alias("_copies")).where("_copies > 0")
    return keyed.dropDuplicates(["_id", "_text"]).join(taken, ["_id", "_text"]).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
