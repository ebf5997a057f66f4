"""Exact duplicates by deterministic block naming.

Texts without white space are cut into blocks of a fixed size. The distinct blocks of the corpus are sorted and each is
named by its place in that order; then the names of adjacent blocks are paired, the distinct pairs sorted and named, and
so on until a document has one name. Names stand for contents one to one, so equal names mean equal texts.

The sort order is (128-bit hash, content). Blocks are grouped by hash *and* content; if two contents ever met in one hash,
the hashes are redrawn with the next seed. After that proof the 16 bytes find a block's name and no text moves twice.
Grouping combines on the map side, so copies of one document reach the shuffle once per task; joins back are plain
equality joins that adaptive execution can split.

Nulls: a null text counts as empty, all empty and blank texts are one group. A null doc_id is an ordinary document that
is chosen last. Rows repeating a doc_id and text: one of them stays. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerproof.llm.base import SPACE, stored, table, without

NAME = "op7_exact_dedup"
BLOCK_CHARS = 4096

SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS n FROM documents),
r AS (SELECT doc_id, n, first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS rn FROM d
      WINDOW w AS (PARTITION BY n ORDER BY length(t) DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, count(*) OVER (PARTITION BY n) AS group_size, rn = 1 AS kept, sha256(n) AS text_sha256 FROM r
"""


def _hashes(content, seed: int):
    """Two 64-bit hashes of one value; the seed is hashed with it."""
    return F.struct(F.xxhash64(F.lit(2 * seed), content).alias("h1"), F.xxhash64(content, F.lit(2 * seed + 1)).alias("h2"))


def _sorted_names(distinct: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Integer names: places in the sorted order of the keys. Stored, so that they are given once."""
    return stored(distinct.repartitionByRange(*keys).sortWithinPartitions(*keys)
                  .withColumn("name", F.monotonically_increasing_id()), name)


def _block_names(blocks: DataFrame, seed: int) -> DataFrame | None:
    """Names of the distinct blocks by hash; None if two contents share a hash."""
    contents = blocks.groupBy("h1", "h2", "block").agg(F.lit(1).alias("one"))
    names = _sorted_names(contents.groupBy("h1", "h2").agg(F.count("one").alias("contents")), ["h1", "h2"], "block-names")
    return names if names.where("contents > 1").isEmpty() else None


def identities(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per input row: row, doc_id, n_chars, text_sha256 and the identity (level, name) of its text."""
    text = F.coalesce("text", F.lit(""))
    cut = docs.select("doc_id", F.char_length(text).alias("n_chars"), without(text, SPACE).alias("bare")).select(
        "doc_id", "n_chars", "bare", F.regexp_extract_all("bare", F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0)).alias("blocks"))
    for seed in range(1000):
        names = _block_names(cut.select(F.explode("blocks").alias("block")).select(_hashes(F.col("block"), seed).alias("h"), "block")
                             .select("h.*", "block"), seed)
        if names is not None:
            break
    rows = stored(cut.select(F.monotonically_increasing_id().alias("row"), "doc_id", "n_chars", F.sha2("bare", 256).alias("text_sha256"),
                             F.transform("blocks", lambda b: _hashes(b, seed)).alias("hashes")), "documents-hashed")
    level = stored(rows.select("row", F.size("hashes").alias("left"), F.posexplode("hashes").alias("pos", "h")).select("row", "left", "pos", "h.*")
                   .join(names.select("h1", "h2", "name"), ["h1", "h2"]).select("row", "left", "pos", "name"), "names")
    done, depth = [level.where("left = 1").select("row", F.lit(0).alias("level"), "name")], 0
    while not (level := level.where("left > 1")).isEmpty():
        depth += 1
        pairs = level.groupBy("row", "left", F.shiftright("pos", 1).alias("pair")).agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"))
        pairs = stored(pairs.select("row", F.shiftright(F.col("left") + 1, 1).alias("left"), F.col("pair").alias("pos"), "a", "b"), "pairs")
        names = _sorted_names(pairs.select("a", "b").distinct(), ["a", "b"], "pair-names")
        level = stored(pairs.join(names, ["a", "b"]).select("row", "left", "pos", "name"), "names")
        done.append(level.where("left = 1").select("row", F.lit(depth).alias("level"), "name"))
    named = done[0]
    for frame in done[1:]:
        named = named.unionByName(frame)
    empty = rows.where(F.size("hashes") == 0).select("row", F.lit(-1).alias("level"), F.lit(0).cast("long").alias("name"))
    return rows.drop("hashes").join(named.unionByName(empty), "row")


def exact_duplicates(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Per input row: doc_id, keep_id, group_size, kept, text_sha256 and n_chars.

    Of equal texts the one with the most code points stays, then the smallest doc_id.
    """
    rows = stored(identities(docs, block_chars), "identities")
    order = F.struct((-F.col("n_chars")).alias("n"), F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    best = rows.groupBy("level", "name").agg(F.min(order).alias("best"), F.count("*").alias("group_size"))
    # Stored, so that the join has plain sides and the copies of one text can be split over tasks.
    best = stored(best.select("level", "name", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("first"), "group_size"), "groups")
    return rows.join(best, ["level", "name"]).select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("first")).alias("kept"), "text_sha256", "n_chars")


def keep_first(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents that stay, with all their columns."""
    bare = F.sha2(without(F.coalesce("text", F.lit("")), SPACE), 256)
    keyed = docs.withColumns({"_sha": bare, "_n": F.char_length(F.coalesce("text", F.lit(""))), "_id": F.col("doc_id").cast("string"), "_null": F.col("doc_id").isNull()})
    kept = exact_duplicates(docs, block_chars).where("kept").select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"), F.col("doc_id").isNull().alias("_null"), F.col("text_sha256").alias("_sha"), F.col("n_chars").alias("_n"))
    keys = ["_id", "_null", "_sha", "_n"]
    return keyed.fillna({"_id": ""}).join(kept, keys, "left_semi").dropDuplicates(keys).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
