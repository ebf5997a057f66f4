"""Duplicate, cardinality and roll-up operators that never gather a group in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerproof.session import scratch_path, shuffles_released

# So many hashes go to every task one by one; of more a bitmap goes, of so many words of 64 bits.
MOST_HASHES = 1_000_000
WORDS = 1 << 20


def fingerprint(columns: list[str]) -> str:
    """SQL text of one key for many columns; equal when all values, nulls included, are equal.

    JSON names its fields and leaves nulls out, so different rows never give the same text.
    """
    return f"sha2(to_json(struct({', '.join(columns)})), 256)"


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their counts. Counts combine before the shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def repeated_hashes(frames: list[DataFrame], path: str) -> tuple[DataFrame, int]:
    """Hashes (h) found more than once, written to ``path``, and how many there are.

    The slim pass before an exact search for duplicates: 8 bytes of each row are shuffled, and only rows whose hash repeats
    need to be built and compared.
    """
    seen = reduce(DataFrame.unionByName, frames).groupBy("h").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1").select("h")
    with shuffles_released(seen.sparkSession):
        seen.write.mode("overwrite").parquet(path)
    stored = seen.sparkSession.read.schema(seen.schema).parquet(path)
    return stored, stored.count()


def with_repeated_hash(df: DataFrame, key_hash: str, hashes: DataFrame, n_hashes: int, most: int | None = None) -> DataFrame:
    """Rows whose hash is among those that repeat; no row moves. Up to ``most`` hashes (8 bytes each) go to every task.

    Of more, a bitmap goes that marks them all. It does not grow, so of rows without a double it lets through a part that does
    (n of 2^26; all when there are far more hashes); what is kept is for comparing by key anyway.
    """
    hashed = df.withColumn("_h", F.expr(key_hash))
    if n_hashes <= (MOST_HASHES if most is None else most):
        return hashed.join(F.broadcast(hashes), F.col("_h") == F.col("h"), "left_semi").drop("_h")

    def place(h: str) -> tuple[str, str]:
        # The lowest six bits may tell what the hash is of.
        return f"shiftright({h}, 6) & {WORDS - 1}L", f"CAST(shiftright({h}, 26) & 63 AS INT)"

    word, bit = place("h")
    words = hashes.groupBy(F.expr(word).alias("_word")).agg(F.expr(f"bit_or(shiftleft(1L, {bit}))").alias("_bits"))
    word, bit = place("_h")
    kept = hashed.join(F.broadcast(words), F.expr(f"({word}) = _word")).where(f"shiftright(_bits, {bit}) & 1 = 1")
    return kept.drop("_h", "_word", "_bits")


def rows_in_groups(df: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``df`` whose keys, nulls included, occur in ``groups``.

    A semi join with one row per key on the right: adaptive skew handling splits the left side, so the rows of one
    large group are several tasks.
    """
    wanted = groups.select(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)])
    return df.join(wanted, F.expr(" AND ".join(f"{k} <=> _g{i}" for i, k in enumerate(keys))), "left_semi")


def duplicate_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Every row whose key occurs more than once; rows with a null key are left out.

    A slim pass over hashes of the keys comes first, so rows that cannot have a double are neither shuffled nor compared.
    """
    present, key_hash = df.dropna(subset=keys), f"xxhash64({', '.join(keys)})"
    hashes = repeated_hashes([present.selectExpr(f"{key_hash} AS h")], scratch_path(df.sparkSession, "repeats"))
    candidates = with_repeated_hash(present, key_hash, *hashes)
    return rows_in_groups(candidates, repeated_keys(candidates, keys), keys)


def cardinality(df: DataFrame, group: list[str], **tests: Column) -> DataFrame:
    """Per group, how many rows pass each test (zero included)."""
    return df.groupBy(*group).agg(*[F.count_if(t).alias(n) for n, t in tests.items()])


def members(df: DataFrame, group: list[str], member: list[str]) -> DataFrame:
    """The set of members of each group, as distinct rows instead of one array per group."""
    return df.select(*group, *member).distinct()


def differs_within(column: str) -> Column:
    """Aggregate: does a column take more than one value in the group? Needs no distinct set."""
    return F.coalesce(F.min(column) != F.max(column), F.lit(False))


def first_per_group(df: DataFrame, group: list[str], order: list[str], keep: list[str]) -> DataFrame:
    """First writer wins: the row with the least ``order`` per group, as one mergeable aggregate."""
    picked = F.min_by(F.struct(*keep), F.struct(*order)).alias("picked")
    return df.groupBy(*group).agg(picked).select(*group, *[F.col(f"picked.{c}").alias(c) for c in keep])


def set_difference_keys(df: DataFrame, group: list[str], members: list[str], left: Column, right: Column) -> DataFrame:
    """Groups whose member set on the left side differs from the one on the right side.

    Works member by member: a member is wrong when it is on one side only. A group without any
    right member is not reported.
    """
    sides = df.groupBy(*group, *members).agg(
        F.max(left.cast("int")).alias("in_left"), F.max(right.cast("int")).alias("in_right")
    )
    return (
        sides.groupBy(*group)
        .agg(
            F.max("in_left").alias("any_left"),
            F.max("in_right").alias("any_right"),
            F.count_if(F.col("in_left") != F.col("in_right")).alias("n_different"),
        )
        .filter("any_right = 1 AND n_different > 0")
        .select(*group, "n_different")
    )
