"""Mutation suite: a clean filing, one set of column changes per case, all cases in one run."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from ledgerproof.context import FilingContext
from ledgerproof.plans.engine import validate
from ledgerproof.plans.rules import Group

# Registries are not part of a filing: they are shared by the cases of a company.
FILING_TABLES = ["transactions", "contracts", "ident", "index"]
REGISTRIES = ["registry", "contacts", "tariffs"]
IDENTIFIERS = ["cid", "seller_cid", "customer_cid"]
CLEAN = "GOLDEN"


@dataclass(frozen=True)
class Mutation:
    """Column changes in one table; the case is named after the rule it should trip."""

    case_id: str
    table: str
    updates: dict[str, str | None] = field(default_factory=dict)


def mutated(ctx: FilingContext, cases: list[Mutation]) -> FilingContext:
    """Every case as filings of its own: company identifiers become ``<case>/<cid>``.

    Rows are multiplied by an explode over the case names, so each table is scanned once however
    many cases there are.
    """
    names = F.array(*[F.lit(n) for n in [CLEAN, *[c.case_id for c in cases]]])

    def apply(table: str) -> DataFrame:
        df = ctx.table(table)
        types = dict(df.dtypes)
        changes: dict[str, Column] = {}
        for case in cases:
            if case.table != table:
                continue
            for column, value in case.updates.items():
                literal = F.lit(value).cast("string").try_cast(types[column])
                unchanged = changes.get(column, F.col(column))
                changes[column] = F.when(F.col("_case") == case.case_id, literal).otherwise(unchanged)
        tagged = {c: F.concat("_case", F.lit("/"), changes.get(c, F.col(c))) for c in IDENTIFIERS if c in types}
        return df.withColumn("_case", F.explode(names)).withColumns({**changes, **tagged}).drop("_case")

    return FilingContext(ctx.spark, {t: apply(t) for t in [*FILING_TABLES, *REGISTRIES]}, ctx.settings)


def mutation_results(ctx: FilingContext, cases: list[Mutation], groups: list[Group]) -> DataFrame:
    """(case, rule, count): which rules fire for which case."""
    counts = validate(mutated(ctx, cases), groups).counts
    case = F.substring_index("cid", "/", 1).alias("case_id")
    return counts.groupBy(case, "rule_id").agg(F.sum("error_count").alias("error_count")).filter("error_count > 0")
