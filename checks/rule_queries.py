"""Rule queries: one per template of the catalogue, the main rules one by one, and all at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import rule_sql
from checks.driver import context, sold_context
from checks.registry import QUERIES, SQL
from checks.views import FILING_TABLES, FULL, with_clause
from ledgerproof.plans.catalogue import catalogue
from ledgerproof.plans.engine import stored_for, validate
from ledgerproof.plans.rules import pick
from ledgerproof.session import empty, scratch_path

NAMES = {
    "T1": "required", "T2": "date_floor", "T3": "lookup", "T1+T3": "required_lookup", "T4": "row_predicate",
    "T5": "registry", "T6": "duplicate", "T7": "cardinality", "T8": "filing_type", "T9": "reference",
    "T10": "cross_record", "T11": "pattern", "T12": "group", "T13": "history",
}
# Rules with a published query or published counts get a query of their own.
SINGLE = ["F.25.18", "F.25.21.2", "F.24.3", "F.24.6", "F.17.8.1", "F.17.1.2", "F.16.25", "F.16.12.1", "F.16.27.1",
          "F.16.11", "F.16.13", "F.20.5", "F.23.21.2", "F.16.3.5"]


def summary(violations: DataFrame) -> DataFrame:
    """Per rule and company: how many violations, and a checksum over the records."""
    digest = F.conv(F.substring(F.md5(F.concat_ws("|", "period", "record_id")), 1, 8), 16, 10).cast("long")
    return violations.groupBy("rule_id", "cid").agg(F.count(F.lit(1)).alias("n"), F.sum(digest).alias("checksum"))


# Groups of rules, and rules, that read a table several times run on stored tables, as they do on a lake.
STORED = {
    "T4": ["ident", "contracts"],
    "T5": ["ident", "contracts", "transactions", "registry", "contacts", "tariffs"], "T6": ["ident", "contracts", "transactions"],
    "T7": ["ident", "contracts", "transactions"], "T8": ["ident", "contracts", "transactions", "index"],
    "T9": ["ident", "contracts", "transactions", "index"], "T10": ["contracts", "transactions"], "T12": ["contracts"], "F.16.3.5": ["contracts"],
}
# Those that read sales in most of their columns, and in several tables, read them from one stored join.
SOLD = {"T4": ["ident", "contracts", "transactions"], "T6": ["ident", "contracts", "transactions"]}


def _run(spark: SparkSession, sf: str, stored: str = "", **chosen):
    """Some rules over the views, or over stored tables that hold what those rules read."""
    ctx = sold_context(spark, sf, SOLD[stored]) if stored in SOLD else context(spark, sf)
    groups = pick(catalogue(ctx.settings), **chosen)
    if stored:
        ctx = stored_for(ctx, groups, scratch_path(spark, "filings"), STORED[stored])
    return validate(ctx, groups)


def _template(template: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return summary(_run(spark, sf, template if template in STORED else "", templates=[template]).violations)

    return run


def _single(rule_id: str, template: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        found = _run(spark, sf, rule_id if rule_id in STORED else template if template == "T6" else "", rule_ids=[rule_id]).violations
        return found.select("rule_id", "cid", "period", F.col("record_id").alias("record"))

    return run


def all_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The whole catalogue in one run, over stored filing tables."""
    sold = sold_context(spark, sf, list(FILING_TABLES))
    ctx = sold.stored(scratch_path(spark, "filings"))
    for path in sold.scratch:
        empty(spark, path)
    counts = validate(ctx, catalogue(ctx.settings)).stored_counts(scratch_path(spark, "counts"), 2 * sold.n_slices - 1)
    return counts.groupBy("rule_id", "cid").agg(F.sum("error_count").alias("n")).filter("n > 0")


for _t, _name in NAMES.items():
    _key = f"{_t.replace('+', '_')}_{_name}"
    QUERIES[_key] = _template(_t)
    SQL[_key] = rule_sql.summary([_t])

for _rule in SINGLE:
    _template_of = next(t for t in rule_sql.TEMPLATES if _rule in rule_sql.rule_ids(t))
    _key = "rule_" + _rule.replace(".", "_")
    QUERIES[_key] = _single(_rule, _template_of)
    SQL[_key] = f"{with_clause(FULL)} SELECT * FROM ({rule_sql.found([_template_of])}) v WHERE rule_id = '{_rule}'"

QUERIES["all_rules_counts"] = all_counts
SQL["all_rules_counts"] = (f"{with_clause(FULL)} SELECT rule_id, cid, count(*) AS n FROM ({rule_sql.found(rule_sql.TEMPLATES)}) v"
                           " GROUP BY rule_id, cid")
