"""Spelling variants: words one edit apart, found on a trie that is a table of edges.

Words of the corpus are counted; those long and frequent enough form the vocabulary. Two words are near if one inserted,
deleted or replaced code point turns one into the other. Near pairs are found as states (word, position, node, edits) that
move along the trie level by level, each level one equality join with the edge table:

* a word's own prefixes are its states without an edit; the edit is tried only in the word's further half, since nodes near
  the root have many children. Edits in the nearer half are found the same way on the trie of the words read backwards;
* an edit is one join with the gap edges (node, next ``LOOK`` code points after the gap): it inserts a code point or replaces
  one by a greater one and goes on only where the word's next code points follow on the trie. The deletion and the
  replacement by a smaller one are the same pairs seen from the other word, so each pair is found once;
* after the edit every level takes ``STEP`` code points along the edges. A label shorter than its full length ends a word,
  and a state that takes one is terminal: the node is a neighbour.

A node is its prefix, so nothing collides. The only join that multiplies rows is the gap join, by at most the letters that
follow a node. Hot nodes are split by adaptive execution, since both sides are plain tables. Words over ``LONG`` code points,
whose trie would take one level after another, meet by hashes of the word with one code point deleted, one row for each
position, and are compared in full afterwards; that is exact as well.

Defined: null and empty texts have no words; a null doc_id counts as empty in the hash that picks damaged words; rows that
repeat a document count again; an empty table gives no words; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerproof.llm.base import python_workers, stored, table
from ledgerproof.llm.textscan import mix

NAME = "op12_spelling_variants"
RUN = r"[A-Za-z\x{C0}-\x{FF}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DAMAGED = 31  # one run in so many loses a code point
LEAST_LENGTH, LEAST_COUNT, TIMES = 7, 2, 10
LOOK, STEP, LONG = 3, 8, 64

SQL = r"""
WITH RECURSIVE o AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS w FROM documents),
g AS (SELECT doc_id, w, count(*) AS times, string_split(coalesce(doc_id::VARCHAR, '') || ':' || w, '') AS s FROM o WHERE length(w) >= 7 GROUP BY ALL),
b AS (SELECT w, times, flatten(list_transform(s, lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]
                 ELSE [195, 0, 0, 0, 0, 0, 0, 0, (unicode(c) - 64)::BIGINT, 0, 0, 0, 0, 0, 0, 0] END)) AS bits FROM g),
h AS (SELECT w, times, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, bits), lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1)))) AS h FROM b),
v AS (SELECT word, sum(times)::BIGINT AS n FROM (SELECT CASE WHEN h % 31 = 0 THEN left(w, (h % length(w))::INTEGER) || substr(w, (h % length(w))::INTEGER + 2) ELSE w END AS word, times FROM h)
      WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
x AS (SELECT word, i, left(word, i::INTEGER) || substr(word, i::INTEGER + 2) AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM v)),
p AS (SELECT x.word AS a, v.word AS b FROM x JOIN v ON x.rest = v.word UNION SELECT v.word, x.word FROM x JOIN v ON x.rest = v.word
      UNION SELECT x.word, y.word FROM x JOIN x AS y USING (i, rest) WHERE x.word <> y.word),
f AS (SELECT a AS word, count(*) AS n_near, first(b ORDER BY n DESC, b) AS best, max(n) AS best_n FROM p JOIN v ON v.word = b GROUP BY a),
r AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * v.n THEN best END AS form, CASE WHEN best_n >= 10 * v.n THEN best_n END AS form_n FROM v LEFT JOIN f USING (word)),
c AS (SELECT word AS start, word AS here FROM r UNION ALL SELECT c.start, r.form FROM c JOIN r ON r.word = c.here WHERE r.form IS NOT NULL)
SELECT r.word, r.form, here AS root, r.n, r.n_near, r.form_n FROM r JOIN c ON c.start = r.word JOIN r AS e ON e.word = c.here AND e.form IS NULL
"""


def vocabulary(docs: DataFrame, damaged: int = DAMAGED, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): letter runs with A-Z lower-cased, one in ``damaged`` of them without one code point, long and frequent enough."""
    text = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(text, F.lit(RUN), F.lit(0))).alias("run")).where(F.char_length("run") >= least_length)
    hashed = runs.select("run", F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run").cast("binary")).alias("h"))
    cut = F.pmod("h", F.char_length("run")).cast("int")
    word = F.when(F.col("h") % damaged == 0, F.concat(F.substring("run", F.lit(1), cut), F.substring("run", cut + 2, F.char_length("run")))).otherwise(F.col("run"))
    return hashed.select(word.alias("word")).where(F.char_length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _from(text: str | Column, start: Column, length: int | None = None) -> Column:
    """Code points of a text from a place counted from 0, to its end or at most ``length``."""
    return F.substring(text, start + 1, F.lit(length) if length else F.char_length(text))


def _left(text: str, length: Column) -> Column:
    return F.substring(text, F.lit(1), length)


def _both_ways(words: DataFrame) -> DataFrame:
    """Words as they are read forwards and backwards, with their length and the length of their nearer half."""
    size = F.char_length("word")
    return words.select(F.explode(F.array(F.struct(F.lit(False).alias("back"), F.col("word").alias("s")), F.struct(F.lit(True).alias("back"), F.reverse("word").alias("s")))).alias("x"),
                        size.alias("size"), F.floor(size / 2).cast("int").alias("half")).select("x.*", "size", "half")


def _places(first: Column, last: Column) -> Column:
    return F.explode(F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))).alias("i")


def trie_pairs(words: DataFrame, look: int = LOOK, step: int = STEP) -> DataFrame:
    """(a, b): every pair of near words once; words must be distinct."""
    ways = _both_ways(words)
    i, size, half = F.col("i"), F.col("size"), F.col("half")
    # The shortest word that can reach a word of this size by an edit starts at half of one code point less.
    nearest = F.when(F.col("back"), F.floor(size / 2)).otherwise(F.floor((size - 1) / 2)).cast("int")
    gaps = ways.select("back", "s", "size", _places(nearest, size - 1)).select("back", _left("s", i).alias("node"), _from("s", i, 1).alias("letter"), _from("s", i + 1, look).alias("label")).distinct()
    edges = stored(ways.select("back", "s", "size", _places(nearest + 1 + look, size)).select("back", _left("s", i).alias("node"), _from("s", i, step).alias("label")).distinct(), "trie-edges")
    # A replacement keeps the size, so backwards it begins at the nearer half exactly; an insertion lies one further on.
    replace = ways.select("back", "s", "half", F.lit(False).alias("more"), _places(F.when(F.col("back"), size - half).otherwise(half), size - 1))
    insert = ways.select("back", "s", "half", F.lit(True).alias("more"), _places(F.when(F.col("back"), size - half + 1).otherwise(half), size))
    after = F.when(F.col("more"), i).otherwise(i + 1)
    states = replace.unionByName(insert).select("back", "s", "half", "more", "i", _left("s", i).alias("node"), _from("s", after, look).alias("label"))
    own, full = _from("s", i, 1), look
    ahead = states.join(gaps, ["back", "node", "label"]).where(F.when(F.col("more"), F.col("letter") != own).otherwise(F.col("letter") > own))
    ahead = ahead.select("back", "s", "half", F.concat("node", "letter", "label").alias("node"), _from("s", after + full).alias("rest"), (F.char_length("label") < full).alias("ended"))
    found, depth = [], LEAST_LENGTH // 2 + 1 + look
    while True:
        level = stored(ahead, "trie-level")
        found.append(level.where("ended"))
        if (level := level.where("not ended")).isEmpty():
            break
        reachable = edges.where(F.char_length("node") >= depth)
        ahead = level.withColumn("label", F.substring("rest", 1, step)).join(reachable, ["back", "node", "label"]).select(
            "back", "s", "half", F.concat("node", "label").alias("node"), _from("rest", F.lit(step)).alias("rest"), (F.char_length("label") < step).alias("ended"))
        depth += step
    pairs = found[0]
    for level in found[1:]:
        pairs = pairs.unionByName(level)
    pairs = pairs.select("back", "half", *[F.when(F.col("back"), F.reverse(c)).otherwise(F.col(c)).alias(name) for c, name in (("s", "a"), ("node", "b"))])
    # An insertion into a run of equal letters can be seen from both ends; backwards only those that forwards did not see.
    return pairs.where(~F.col("back") | (F.substring("a", F.lit(1), F.col("half")) != F.substring("b", F.lit(1), F.col("half")))).select("a", "b")


def _deletions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, i, h): hash of the word without code point i; i -1 is the whole word."""
    step = 0x9E3779B97F4A7C15
    down = np.uint64(pow(step, -1, 1 << 64))
    for batch in batches:
        for id_, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            codes = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64)
            up = np.full(len(codes), step, np.uint64)
            up[:1] = 1
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(codes + np.uint64(1)) * np.multiply.accumulate(up))])
            hashes = np.append(total[:-1] + (total[-1] - total[1:]) * down, total[-1:])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(hashes), id_), pa.int64()), pa.array(np.append(np.arange(len(codes)), -1), pa.int32()), pa.array(hashes.view(np.int64))], ["id", "i", "h"])


def long_pairs(words: DataFrame) -> DataFrame:
    """(a, b): every pair of near words once, by hashes of the words without one code point."""
    keyed = stored(words.select(F.monotonically_increasing_id().alias("id"), "word"), "long-words")
    cut = stored(python_workers(keyed).mapInArrow(_deletions, "id long, i int, h long"), "long-deletions")
    part = cut.where("i >= 0")
    replaced = part.join(part.select(F.col("id").alias("other"), "i", "h"), ["i", "h"]).where("id < other").select("id", "other")
    shorter = cut.where("i < 0").select("id", "h").join(part.select(F.col("id").alias("other"), "h"), "h").select("id", "other")
    pairs = replaced.unionByName(shorter).distinct()
    return pairs.join(keyed.withColumnRenamed("word", "a"), "id").join(keyed.select(F.col("id").alias("other"), F.col("word").alias("b")), "other").where(F.levenshtein("a", "b", 1) == 1).select("a", "b")


def near_pairs(words: DataFrame, longest: int = LONG) -> DataFrame:
    """(a, b): every pair of near words once; ``words`` has distinct words."""
    size = F.char_length("word")
    pairs = trie_pairs(words.select("word").where(size <= longest))
    beyond = words.select("word").where(size >= longest)
    if not beyond.where(size > longest).isEmpty():
        pairs = pairs.unionByName(long_pairs(beyond).where(F.greatest(F.char_length("a"), F.char_length("b")) > longest))
    return pairs


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of every word in links (word, form): the last word on its way. Ways must end; each round doubles the steps."""
    links = stored(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        following = links.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        further = stored(links.join(following, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        links = further.drop("moved")
        if further.where("moved").isEmpty():
            return links


def variants(words: DataFrame, times: int = TIMES, longest: int = LONG) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word in (word, n).

    The form is the near word of largest n, then smallest, if it is ``times`` as frequent; the root is where forms lead.
    """
    words = stored(words, "vocabulary")
    pairs = stored(near_pairs(words, longest), "near-words")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    best = both.join(words.select(F.col("word").alias("b"), F.col("n").alias("n_b")), "b").groupBy("a").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n_b")).alias("minus"), "b")).alias("best"))
    often = -F.col("best.minus") >= times * F.col("n")
    formed = stored(words.join(best.withColumnRenamed("a", "word"), "word", "left").select(
        "word", F.when(often, F.col("best.b")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(often, -F.col("best.minus")).alias("form_n")), "forms")
    return formed.join(roots(formed.where("form is not null")), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(vocabulary(table(spark, sf_dir, "documents")))
