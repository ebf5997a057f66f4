"""Quality rules as a short-circuit cascade.

Base counts are taken for every document and decide ``base_failed``. The other rules form a cascade: on a bounded sample
each rule's rejection rate and cost (measured seconds) are estimated, and the rules run in order of rejection per cost. A
document that fails one is not tested by the later ones (CASE evaluates in order). The order changes the time only; a
document is kept if it passes all rules, so the verdict is the same for any order.

Nulls: a null text is an empty one, has no words and fails the base rule. Texts of one word or one line, of any length,
need no special case. Repeated rows are judged alike. Extra columns are ignored.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerproof.llm.base import SPACE, stored, table, without, words

NAME = "op6_quality_rules"
SAMPLE_FRACTION, SAMPLE_ROWS = 0.02, 2000  # bounds of the sample that orders the rules

# Characters counted as symbols, and the limits of the rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
MAX_SYMBOLS_PER_100_WORDS, MIN_MEAN_TENTHS, MAX_MEAN_TENTHS = 10, 25, 120
MAX_DUP_LINE_PERCENT, MAX_SHOUTED_PERCENT, MIN_LETTERED_PERCENT = 40, 50, 60

# rule name -> condition of rejection over the columns of measured()
RULES = {
    "symbols": "100 * n_symbols > {sym} * n_words",
    "word_length": "10 * word_chars < {low} * n_words OR 10 * word_chars > {high} * n_words",
    "duplicate_lines": "100 * n_dup_lines > {dup} * n_lines",
    "shouting": "100 * size(filter(words, w -> char_length(w) > 1 AND w = upper(w) AND w <> lower(w))) > {caps} * n_words",
    "letters": "100 * size(filter(words, w -> w RLIKE '\\\\p{{L}}')) < {letters} * n_words",
}
LIMITS = {"sym": MAX_SYMBOLS_PER_100_WORDS, "low": MIN_MEAN_TENTHS, "high": MAX_MEAN_TENTHS, "dup": MAX_DUP_LINE_PERCENT,
          "caps": MAX_SHOUTED_PERCENT, "letters": MIN_LETTERED_PERCENT}

SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
g AS (SELECT *, list_transform(range(1, len(w) - 1), lambda i: [w[i], w[i + 1], w[i + 2]]) AS g FROM d),
u AS (SELECT rid, unnest(g) AS gram, unnest(range(1, len(w) - 1)) AS p FROM g),
r AS (SELECT rid, p FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, gram) AS c FROM u) WHERE c > 1),
c AS (SELECT rid, count(DISTINCT q) AS n FROM (SELECT rid, unnest([p, p + 1, p + 2]) AS q FROM r) GROUP BY rid),
b AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words, len(l) AS n_lines,
             len(list_filter(w, lambda x: length(x) > 1 AND x = upper(x) AND x <> lower(x))) AS shouted, len(list_filter(w, lambda x: regexp_matches(x, '\p{L}'))) AS lettered
      FROM d LEFT JOIN c USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * n_symbols > 10 * n_words OR 10 * word_chars < 25 * n_words
            OR 10 * word_chars > 120 * n_words OR 100 * n_dup_lines > 40 * n_lines OR 100 * shouted > 50 * n_words OR 100 * lettered < 60 * n_words) AS kept
FROM b
"""


def _bound(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, computed once even if the optimizer moves the expression."""
    return f"transform(array({value}), {name} -> {body})[0]"


#: Words that lie in three-word windows found twice or more in the same text: hashes of the windows, if any is found twice
#: sorted with their places, places whose neighbour has the same hash, and the words these places cover.
REPEATED = _bound("words", "w", _bound(
    "CASE WHEN size(w) < 4 THEN CAST(array() AS array<bigint>) ELSE transform(sequence(0, size(w) - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2])) END", "h",
    "CASE WHEN size(array_distinct(h)) = size(h) THEN 0L ELSE " + _bound(
        "array_sort(transform(h, (x, i) -> named_struct('h', x, 'p', i)))", "s",
        "aggregate(array_sort(transform(filter(s, (x, i) -> x.h = get(s, i - 1).h OR x.h = get(s, i + 1).h), x -> x.p)), named_struct('n', 0L, 'end', 0), "
        "(a, p) -> named_struct('n', a.n + p + 3 - greatest(a.end, p), 'end', p + 3), a -> a.n)") + " END"))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, words, n_lines and the base counts of every document."""
    text = F.coalesce("text", F.lit(""))
    out = docs.select("doc_id", text.alias("t"), words(F.col("text")).alias("words"))
    out = out.select(
        "doc_id", "words", F.size("words").cast("long").alias("n_words"), F.char_length(without(F.col("t"), SPACE)).cast("long").alias("word_chars"),
        (F.char_length("t") - F.char_length(without(F.col("t"), SYMBOLS))).cast("long").alias("n_symbols"),
        F.filter(F.split("t", "\n"), lambda line: without(line, SPACE) != "").alias("lines"))
    out = out.withColumns({"n_lines": F.size("lines"), "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")}).drop("lines")
    out = out.withColumn("n_repeat_words", F.expr(REPEATED))
    return out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def rule_order(sample: DataFrame, rules: dict[str, str]) -> list[str]:
    """Rule names by rejections per second on the sample, best first; what a job takes without a rule is taken off."""
    rates = sample.agg(*[F.avg(F.expr(rule).cast("int")).alias(name) for name, rule in rules.items()]).first()

    def seconds(rule: str) -> float:
        """Least of three runs, the first of which also compiles."""
        took = []
        for _ in range(3):
            began = time.perf_counter()
            sample.select(F.count_if(F.expr(rule)).alias("n")).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - began)
        return min(took)

    idle = seconds("false")
    worth = {name: (rates[name] or 0.0) / max(1e-4, seconds(rule) - idle) for name, rule in rules.items()}
    return sorted(rules, key=lambda name: (-worth[name], name))


def judge(docs: DataFrame, rules: dict[str, str] | None = None, sample_fraction: float = SAMPLE_FRACTION, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Base counts, base_failed, kept and the first failed rule in the chosen order (null if none) of every row."""
    rules = {name: rule.format(**LIMITS) for name, rule in (RULES if rules is None else rules).items()}
    # A share of the rows that gives about sample_rows of them, so what meets in one task does not grow with the corpus.
    share = min(sample_fraction, sample_rows / max(1, docs.count()))
    sample = stored(measured(docs.sample(share, 7).limit(sample_rows)), "rule-sample").where("NOT base_failed")
    failed = F.when(F.col("base_failed"), F.lit("base"))
    for name in rule_order(sample, rules):
        failed = failed.when(F.expr(rules[name]), F.lit(name))
    return measured(docs).withColumn("failed_rule", failed).withColumn("kept", F.col("failed_rule").isNull()).drop("words", "n_lines")


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns; no join, the verdict is computed beside the row.

    The row number keeps the optimizer from moving the filter below the measures and computing these twice.
    """
    row = F.struct(*docs.columns).alias("doc_id")
    judged = judge(docs.select(row, "text")).withColumn("_row", F.monotonically_increasing_id())
    return judged.where("kept AND _row >= 0").select("doc_id.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
