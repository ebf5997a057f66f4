"""Rules as data: a JSON list of {id, table, severity, description, test}."""

from __future__ import annotations

import json
from dataclasses import replace

from pyspark.sql import SparkSession

from ledgerproof.context import Settings
from ledgerproof.functions.predicates import lit
from ledgerproof.plans.rules import Check, RowGroup
from ledgerproof.plans.total import total

def parse_rules(text: str, settings: Settings, cid: str | None = None) -> list[RowGroup]:
    """Row rules from a JSON text, one group per table.

    ``{{CID}}`` and ``{{DATE}}`` in a test become quoted literals. A rule that fails on some rows, by a cast, a division, an
    element, a date or an overflow, does not end the run: it counts the rows it can tell, the other rules finish and the
    statistics name the failure.
    """
    values = {"{{CID}}": lit(cid or ""), "{{DATE}}": lit(settings.run_date.isoformat())}
    by_table: dict[str, list[Check]] = {}
    for entry in json.loads(text):
        test = entry["test"]
        for name, value in values.items():
            test = test.replace(name, value)
        test, failed = total(test)
        check = Check(entry["id"], entry.get("severity", "Error"), "T4", entry.get("description", entry["id"]), test)
        own = by_table.setdefault(entry["table"], [])
        own.append(check)
        own += [replace(check, rule_id=f"{check.rule_id} {reason}", test=lost, guards=check.rule_id, reason=reason) for reason, lost in failed.items()]
    return [RowGroup(table, checks) for table, checks in by_table.items()]


def load_rules(spark: SparkSession, path: str, settings: Settings, cid: str | None = None) -> list[RowGroup]:
    """Rules from a JSON file anywhere that Spark can read."""
    text = spark.read.option("wholetext", True).text(path).head()
    return parse_rules(text.value if text else "[]", settings, cid)
