"""Benchmark: prints one JSON line with seconds per headline query.

The filing tables are derived from the driver tables and stored once (reported as ``store_tables``);
the catalogue then runs over the stored tables, as it does over a lake.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.driver import base, context  # noqa: E402
from checks.registry import QUERIES  # noqa: E402
import checks.operator_queries  # noqa: E402,F401
from ledgerproof.plans.catalogue import catalogue, catalogue_frame  # noqa: E402
from ledgerproof.plans.engine import group_counts, validate  # noqa: E402
from ledgerproof.plans.reports import alerts, briefs  # noqa: E402
from ledgerproof.plans.rules import JoinGroup, pick  # noqa: E402
from ledgerproof.session import local_session, scratch_path  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
OPERATORS = ["J1_anti_join", "J9_known_group", "J10_interval_join", "J12_previous_quarter", "A2_count_by_two", "A5_duplicates",
             "L3_sample_per_group", "P11_relative_tolerance", "R5_mismatch_evidence"]


def run(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = local_session("bench", CPUS)
    seconds: dict[str, float] = {}

    def timed(name: str, action) -> None:
        began = time.perf_counter()
        action()
        seconds[name] = round(time.perf_counter() - began, 3)

    stored = {}
    timed("store_tables", lambda: stored.update(ctx=context(spark, SF_DIR).stored(scratch_path(spark, "filings"))))
    ctx = stored["ctx"]
    groups = catalogue(ctx.settings)
    timed("all_rules_counts", lambda: run(validate(ctx, groups).counts))

    path = scratch_path(spark, "violations")
    timed("all_rules_violations", lambda: validate(ctx, groups).violations.write.parquet(path))
    stats_path = scratch_path(spark, "stats")
    timed("transaction_rule_stats", lambda: validate(ctx, pick(groups, tables=["transactions"])).rule_stats.write.parquet(stats_path))
    violations, stats = spark.read.parquet(path), spark.read.parquet(stats_path)
    timed("alerts", lambda: run(alerts(stats)))
    timed("briefs", lambda: run(briefs(violations, stats, catalogue_frame(spark, groups))))

    for table in ("ident", "contracts", "transactions"):
        rows = [g for g in groups if g.table == table and type(g).__name__ == "RowGroup"]
        timed(f"row_rules_{table}", lambda rows=rows: run(group_counts(ctx, rows[0])))
    for group in groups:
        if isinstance(group, JoinGroup):
            timed(f"join_{group.name}", lambda group=group: run(group_counts(ctx, group)))
    timed("duplicates", lambda: run(validate(ctx, pick(groups, templates=["T6"])).violations))
    base(spark, SF_DIR)
    for name in OPERATORS:
        timed(name, lambda name=name: run(QUERIES[name](spark, SF_DIR)))
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "catalogue_and_operators_seconds", "value": total, "unit": "sec", "queries": seconds,
                      "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
