"""The registered queries of this package and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerproof.llm import (exact_dedup, jaccard_join, language_model, line_quality, main_text, mixing, packing, quality_rules, ranked_search, spelling, substring_dedup, toxicity,
                             warc)

MODULES = (jaccard_join, quality_rules, exact_dedup, mixing, packing, substring_dedup, warc, main_text, toxicity, line_quality, ranked_search, spelling, language_model)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {m.NAME: m.query for m in MODULES}


def oracle_sql() -> dict[str, str]:
    return {m.NAME: m.SQL for m in MODULES if m.SQL}
