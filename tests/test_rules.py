"""Golden filing, seeded errors, mutations, and the agreement of the two evaluation paths."""

import re
from collections import Counter

import pytest

from ledgerproof.operators.results import acceptance
from ledgerproof.plans.catalogue import catalogue, catalogue_frame
from ledgerproof.plans import bundle
from ledgerproof.operators import groups
from ledgerproof.plans.engine import find_repeats, group_counts, validate
from ledgerproof.plans.incremental import _sum, current, fingerprints, refresh
from ledgerproof.plans.mutation import Mutation, mutation_results
from ledgerproof.plans.registry import parse_rules
from ledgerproof.plans.rules import JoinGroup, pick
from ledgerproof.plans.total import total
from ledgerproof.sources.registry import with_lookup
from tests.golden import AGENT, CONTRACT, INDEX, SELLER, SETTINGS, TRANSACTION, DAY, filing, frame


def fired(ctx, **chosen) -> set[str]:
    counts = validate(ctx, pick(catalogue(ctx.settings), **chosen)).counts
    return {r.rule_id for r in counts.filter("error_count > 0").collect()}


def test_golden_filing_is_clean(spark):
    ctx = filing(spark)
    run = validate(ctx, catalogue(ctx.settings))
    assert run.failures == {}
    assert run.violations.collect() == []
    stats = run.stats.collect()
    assert len(stats) == len({c.rule_id for g in run.groups for c in g.checks})
    assert {r.error_count for r in stats} == {0} and {r.total_count for r in stats} == {1}
    assert acceptance(run.violations, ctx.filings).collect()[0].status == "accepted"


def test_agent_row_once_missing_twice(spark):
    rule = {"rule_ids": ["F.16.12.1"]}
    assert fired(filing(spark), **rule) == set()
    assert fired(filing(spark, ident=[SELLER]), **rule) == {"F.16.12.1"}
    assert fired(filing(spark, ident=[AGENT, {**AGENT, "contact_name": "Other"}]), **rule) == {"F.16.12.1"}


def test_filing_without_identity_rows_still_reports(spark):
    assert {"F.16.12.1", "F.16.3"} <= fired(filing(spark, ident=[]), templates=["T7"])


def test_seeded_filing(spark):
    """Wrong units, an unauthorized product and a missing index, and nothing else of these rules."""
    wrong = {**CONTRACT, "contract_unique_id": "K2", "contract_service_agreement_id": "A2", "rate_units": "$/MW", "source_row_index": 2}
    other = {**TRANSACTION, "transaction_unique_id": "T2", "product_name": "Ancillary Services", "source_row_index": 2}
    ctx = filing(spark, contracts=[CONTRACT, wrong], transactions=[TRANSACTION, other], index=[])
    seeded = ["F.17.1.2", "F.25.18", "F.16.27.1", "F.24.6", "F.24.3", "F.16.25"]
    rows = validate(ctx, pick(catalogue(ctx.settings), rule_ids=seeded)).violations.collect()
    assert {(r.rule_id, r.record_id) for r in rows} == {("F.17.1.2", "K2"), ("F.25.18", "T2"), ("F.16.27.1", "FS1")}


def test_booked_out_power_needs_energy_or_capacity(spark):
    booked = {**TRANSACTION, "product_name": "Booked Out Power"}
    rule = {"rule_ids": ["F.25.18"]}
    assert fired(filing(spark, transactions=[booked]), **rule) == set()
    own = {**CONTRACT, "product_name": "BOOKED OUT POWER"}
    assert fired(filing(spark, transactions=[booked], contracts=[own]), **rule) == {"F.25.18"}
    early = {**booked, "period": "2013Q2"}
    assert fired(filing(spark, transactions=[early], contracts=[own]), **rule) == set()


def test_null_agreement_counts_as_unauthorized(spark):
    row = {**TRANSACTION, "contract_service_agreement": None}
    assert fired(filing(spark, transactions=[row]), rule_ids=["F.25.18"]) == {"F.25.18"}


@pytest.mark.parametrize(
    "charge, units, expected",
    [(4550.0, "$/MWH", False), (4595.0, "$/MWH", False), (4596.0, "$/MWH", True), (45.5, "cents/KWH", True), (4550.0, "cents/KWH", True)],
)
def test_charge_tolerance(spark, charge, units, expected):
    row = {**TRANSACTION, "total_transaction_charge": charge, "rate_units": units}
    assert (fired(filing(spark, transactions=[row]), rule_ids=["F.24.6"]) == {"F.24.6"}) is expected


def test_cents_are_dollars_divided_by_hundred(spark):
    row = {**TRANSACTION, "total_transaction_charge": 45.5, "rate_units": "cents/KWH", "standardized_price": None}
    assert fired(filing(spark, transactions=[row]), rule_ids=["F.24.6"]) == set()


def test_append_with_same_publishers(spark):
    rule = {"rule_ids": ["F.16.27.5"]}
    append = {**INDEX, "filing_type": "Append"}
    assert fired(filing(spark, index=[INDEX, append]), **rule) == set()
    assert fired(filing(spark, index=[INDEX]), **rule) == set()
    assert fired(filing(spark, index=[INDEX, {**append, "publisher": "Argus"}]), **rule) == {"F.16.27.5"}


def test_registry_versions(spark):
    old = {"cid": "C000001", "legal_name": "Old Name", "role": "Agent", "effective_start": DAY(2019, 1, 1), "effective_end": DAY(2024, 2, 1)}
    new = {**old, "legal_name": "Example Power LLC", "effective_start": DAY(2024, 2, 1), "effective_end": None}
    rules = {"rule_ids": ["F.16.3.1", "F.16.3.4", "F.16.3.5"]}
    named_old = filing(spark, registry=[old, new], ident=[{**SELLER, "company_name": "Old Name"}, AGENT],
                       contracts=[{**CONTRACT, "seller_company_name": "Old Name"}])
    # Registered at some time, valid during the quarter, but not at its end.
    assert fired(named_old, **rules) == {"F.16.3.4"}


MUTATIONS = [
    Mutation("F.24.1", "transactions", {"transaction_unique_id": None}),
    Mutation("F.24.3", "transactions", {"transaction_end_date": "2024-01-15"}),
    Mutation("F.25.21.2", "transactions", {"transaction_quantity": "0"}),
    Mutation("F.17.8.1", "transactions", {"price": "1000.01"}),
    Mutation("F.TYPE_PRICE", "transactions", {"price": "twelve"}),
    Mutation("F.30.48", "transactions", {"point_of_delivery_specific_location": " "}),
    Mutation("F.21.5", "contracts", {"contract_affiliate": "MAYBE"}),
    Mutation("F.20.3", "contracts", {"contract_execution_date": "1900-01-01"}),
    Mutation("F.17.1.2", "contracts", {"rate_units": "$/MW"}),
    Mutation("F.23.24", "contracts", {"rate": None}),
    Mutation("F.16.8", "ident", {"email": "nobody"}),
    Mutation("F.19.1.2", "ident", {"zip": "9810"}),
    Mutation("F.16.28", "index", {"transactions_reported": None}),
    Mutation("F.16.3.1", "ident", {"company_name": "Somebody Else"}),
    Mutation("F.30.41.3", "contracts", {"ferc_tariff_reference": "NPU"}),
]


def test_mutations_trip_their_rule(spark):
    ctx = filing(spark)
    found = mutation_results(ctx, MUTATIONS, catalogue(ctx.settings)).collect()
    by_case: dict[str, set[str]] = {}
    for row in found:
        by_case.setdefault(row.case_id, set()).add(row.rule_id)
    assert "GOLDEN" not in by_case
    for case in MUTATIONS:
        if case.case_id == "F.30.41.3":  # one contract alone cannot be mixed
            assert case.case_id not in by_case[case.case_id]
            assert "F.30.41.1" in by_case[case.case_id]
        else:
            assert case.case_id in by_case[case.case_id], case
    assert by_case["F.23.24"] == {"F.23.24"}
    assert by_case["F.16.28"] == {"F.16.28"}
    assert by_case["F.21.5"] == {"F.21.5"}


def test_broken_rule_is_reported_and_others_run(spark):
    ctx = filing(spark)
    text = """[{"id": "OK", "table": "transactions", "test": "seller_cid = {{CID}}"},
               {"id": "BAD", "table": "transactions", "test": "nothing > 1"}]"""
    run = validate(ctx, parse_rules(text, ctx.settings, "C000001"))
    stats = {r.rule_id: r for r in run.rule_stats.collect()}
    assert stats["OK"].error_count == 1 and stats["OK"].engine_failure is None
    assert stats["BAD"].error_count == 0 and stats["BAD"].engine_failure.startswith("UNRESOLVED_COLUMN")


def test_rule_that_fails_on_rows_is_reported(spark):
    text = """[{"id": "OK", "table": "transactions", "test": "seller_cid = {{CID}}"},
               {"id": "CASTS", "table": "transactions", "test": "CAST(product_name AS INT) > 1"},
               {"id": "FINE", "table": "transactions", "test": "CAST(price AS INT) > 1"}]"""
    ctx = filing(spark)
    run = validate(ctx, parse_rules(text, ctx.settings, "C000001"))
    stats = {r.rule_id: (r.error_count, r.engine_failure) for r in run.rule_stats.collect()}
    assert stats == {"OK": (1, None), "CASTS": (0, "CAST_INVALID_INPUT"), "FINE": (1, None)}
    assert sorted(r.rule_id for r in run.violations.collect()) == ["FINE", "OK"]


def test_long_lookup_becomes_a_join_with_the_same_result(spark):
    rows = [TRANSACTION, {**TRANSACTION, "transaction_unique_id": "T2", "class_name": "X"},
            {**TRANSACTION, "transaction_unique_id": "T3", "class_name": None}]
    values = spark.createDataFrame([("f",), (" NF ",), ("F",)], "value string")
    by_list = filing(spark, with_lookup(SETTINGS, "class", values, as_table=False), transactions=rows)
    by_table = filing(spark, with_lookup(SETTINGS, "class", values), transactions=rows)
    assert "class" in by_table.settings.lookup_tables

    def ids(ctx):
        found = validate(ctx, pick(catalogue(ctx.settings), rule_ids=["F.25.2.1"])).violations
        return sorted(r.record_id for r in found.collect())

    assert ids(by_list) == ids(by_table) == ["T2", "T3"]


def test_hub_and_operator_rules_agree_for_list_and_table(spark):
    hub = {"point_of_delivery_balancing_authority": "Hub"}
    rows = [{**TRANSACTION, "transaction_unique_id": f"T{i}", **hub, "point_of_delivery_specific_location": where, "point_of_delivery_hub": None}
            for i, where in enumerate(["Palo Verde", "elsewhere", None, " "])]
    rows += [{**TRANSACTION, "transaction_unique_id": f"B{i}", "product_name": "Booked Out Power", "customer_company_name": who} for i, who in enumerate(["Operator A", "other", None])]
    deals = [{**CONTRACT, "contract_unique_id": f"K{i}", "porba": "HUB", "porsl": where, "podba": "HUB", "podsl_hub": where} for i, where in enumerate(["PALO VERDE ", "x", None])]
    hubs, operators = (spark.createDataFrame([(v,)], "value string") for v in ("palo verde", "Operator A"))
    rules = ["F.23.8", "F.23.10", "F.23.23", "F.25.3", "F.25.25", "F.25.13.2", "F.25.16"]

    def found(as_table):
        settings = with_lookup(with_lookup(SETTINGS, "hub", hubs, as_table), "iso", operators, as_table)
        run = validate(filing(spark, settings, transactions=rows, contracts=deals), pick(catalogue(settings), rule_ids=rules))
        shown = sorted((r.rule_id, r.record_id, r.message) for r in run.violations.collect())
        counts = {r.rule_id: r.error_count for r in run.rule_stats.collect()}
        assert counts == {rule: sum(r == rule for r, _, _ in shown) for rule in rules}
        return shown

    listed = found(False)
    assert listed == found(True)
    assert [i for r, i, _ in listed if r == "F.25.3"] == ["T1", "T2", "T3"] and ("F.25.13.2", "B0") in {(r, i) for r, i, _ in listed}


def test_filing_without_readable_period_is_counted(spark):
    rows = [{**TRANSACTION, "period": None, "price": None}, {**TRANSACTION, "period": None, "price": None}]
    ctx = filing(spark, SETTINGS, transactions=rows)
    run = validate(ctx, pick(catalogue(SETTINGS), rule_ids=["F.TYPE_PRICE", "F.UNIQUE_TX"]))
    assert {r.rule_id: r.error_count for r in run.rule_stats.collect()} == {"F.TYPE_PRICE": 2, "F.UNIQUE_TX": 2}
    assert run.violations.count() == 4
    status = acceptance(run.violations, ctx.filings).filter("period IS NULL").collect()
    assert [r.status for r in status] == ["rejected"]


def test_catalogue_has_stage_for_every_rule(spark):
    rows = catalogue_frame(spark, catalogue(SETTINGS)).collect()
    assert len({r.rule_id for r in rows}) == len(rows) > 150
    stages = {r.rule_id: r.stage for r in rows}
    assert stages["F.16.4.1"] == "Type 1" and stages["F.25.21.2"] == "Type 5" and stages["F.25.18"] == "Type 2"
    assert frame(spark, "tariffs", []).count() == 0


def test_counts_share_scans_and_shuffles(spark, tmp_path):
    """The whole catalogue counts in a few scans and shuffles, whatever the number of rules."""
    ctx = filing(spark).stored(str(tmp_path))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = validate(ctx, catalogue(ctx.settings)).counts._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(re.findall(rf"{tmp_path.name}/transactions?\]", plan)) <= 8
    assert plan.count("Exchange hashpartitioning") <= 40
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_shared_counts_hash_their_rows(spark, tmp_path):
    """A fact kept as text would make the aggregates sort every entry; nor are entries built in a higher-order function."""
    ctx = filing(spark).stored(str(tmp_path))
    groups = [g for g in catalogue(ctx.settings) if bundle.fits(g)]
    plan = bundle.bundled_counts(ctx, groups)._jdf.queryExecution().sparkPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "lambda" not in plan


def test_bundle_equals_single_joins(spark):
    """Every join group counted alone, by its own join, gives what the bundle gives."""
    wrong = [{**TRANSACTION, "transaction_unique_id": f"T{i}", "filing_type": t, "contract_unique_id": k, "product_name": p, "customer_company_name": c,
              "transaction_end_date": e, "source_row_index": i + 2}
             for i, (t, k, p, c, e) in enumerate([("Replace", "K1", "Energy", None, DAY(2020, 1, 1)), (None, None, None, "Nobody", None), ("New", "K9", "BOOKED OUT POWER", "Nobody", DAY(2050, 1, 1)),
                                                  ("New", TRANSACTION["contract_unique_id"], "x", TRANSACTION["customer_company_name"], DAY(2050, 1, 1))])]
    ctx = filing(spark, transactions=[TRANSACTION, *wrong], index=[], ident=[AGENT, SELLER, {**SELLER, "company_name": None, "contact_name": None}])
    joins = [g for g in catalogue(ctx.settings) if isinstance(g, JoinGroup)]
    assert sum(bundle.fits(g) for g in joins) > 15
    together = {(r.rule_id, r.cid, r.period): r.error_count for r in validate(ctx, joins).counts.where("error_count > 0").collect()}
    alone = Counter()
    for g in joins:
        for r in group_counts(ctx, g).where("error_count > 0").collect():
            alone[r.rule_id, r.cid, r.period] += r.error_count
    assert together == dict(alone) and len(together) > 5


def test_rules_made_total(spark):
    """What can fail gives null; rows behind a guard of the rule's own are not counted as lost."""
    rows = spark.createDataFrame([("1", 0, ["a"]), ("x", 2, []), (None, None, None)], "s string, n int, a array<string>")
    for test, lost in [("CAST(trim(s) AS INT) > 0", 1), ("s::int > 0", 1), ("int(s) > 0", 1), ("4 / n > 1", 1), ("4 % n = 0", 1), ("4 div n = 2", 1), ("element_at(a, 1) = 'a'", 1), ("a[0] = 'a'", 1),
                       ("to_date(s) > DATE'2000-01-01'", 2), ("n * 2000000000 > 1", 1), ("CASE WHEN n <> 0 THEN 4 / n > 1 ELSE false END", 0), ("n <> 0 AND 4 / n > 1", 0), ("n = 0 OR 4 / n > 1", 0),
                       ("if(n = 0, false, 4 / n > 1)", 0), ("TRY_CAST(s AS INT) > 0", 0), ("s RLIKE '^[0-9]+$' AND CAST(s AS INT) > 0", 0), ("exists(a, e -> e = 'a')", 0)]:
        made, failed = total(test, spark)
        rows.selectExpr(made).collect()
        assert sum(rows.where(condition).count() for condition in failed.values()) == lost, test


def test_only_changed_filings_are_validated(spark, tmp_path):
    path, rules = str(tmp_path / "r"), pick(catalogue(SETTINGS), rule_ids=["F.25.21.2", "F.16.12.1"])
    many = [{**TRANSACTION, "cid": f"C{i}", "transaction_unique_id": f"T{i}"} for i in range(6)]
    ctx = filing(spark, transactions=many)
    assert refresh(ctx, rules, path) >= 6
    assert refresh(filing(spark, transactions=many[::-1]), rules, path) == 0
    changed = filing(spark, transactions=[{**many[0], "transaction_quantity": -5.0}, *many[1:5]])
    assert refresh(changed, rules, path) == 1
    found = {(r.rule_id, r.cid, r.period): r.error_count for r in current(changed, path).collect()}
    assert found == {(r.rule_id, r.cid, r.period): r.error_count for r in validate(changed, rules).stats.collect()}
    assert found["F.25.21.2", "C0", many[0]["period"]] == 1
    assert refresh(changed, rules, path, version="next") >= 5


def test_fingerprints_cover_what_the_rules_read(spark, tmp_path):
    """Other columns are not scanned, and a change in them validates nothing; a column, header or table that counts does."""
    of_sales, of_zip = (pick(catalogue(SETTINGS), rule_ids=[r]) for r in ("F.25.21.2", "F.19.1.2"))
    ctx = filing(spark).stored(str(tmp_path / "filings"))
    plan = fingerprints(ctx, of_sales)._jdf.queryExecution().executedPlan().toString()
    assert "transaction_quantity" in plan and "standardized_price" not in plan and "commencement_date" not in plan
    assert refresh(ctx, of_sales, str(tmp_path / "a")) == 1 and refresh(ctx, of_zip, str(tmp_path / "b")) == 1
    moved = filing(spark, ident=[{**SELLER, "zip": "1"}, AGENT])
    assert refresh(moved, of_sales, str(tmp_path / "a")) == 0 and refresh(moved, of_zip, str(tmp_path / "b")) == 1
    assert {r.error_count for r in current(moved, str(tmp_path / "b")).collect()} == {1}
    assert refresh(filing(spark, transactions=[TRANSACTION, {**TRANSACTION, "transaction_unique_id": "T2"}]), of_zip, str(tmp_path / "b")) == 1
    assert {r.total_count for r in current(ctx, str(tmp_path / "b")).collect()} == {2}
    only_ident = filing(spark, ident=[SELLER, AGENT, {**SELLER, "cid": "C9"}])
    assert refresh(only_ident, of_sales, str(tmp_path / "a")) == 1
    assert {r.cid for r in current(only_ident, str(tmp_path / "a")).collect()} == {"C000001", "C9"}


def test_results_of_many_filings_are_written_by_several_tasks(spark, tmp_path):
    many = [{**TRANSACTION, "cid": f"C{i}"} for i in range(120)]
    refresh(filing(spark, transactions=many), pick(catalogue(SETTINGS), rule_ids=["F.25.21.2"]), str(tmp_path / "r"))
    files = [f.name for f in (tmp_path / "r" / "results").rglob("part-*.parquet")]
    assert len(files) == 121 and len({f.split("-")[1] for f in files}) == 3


def test_sum_of_hashes_is_exact(spark):
    values = [2**63 - 1, -2**63, -1, 0, 1, -2**42, 2**21, -2**21 - 1] + [2**63 - 1] * 5 + [-2**63] * 9 + [(-1)**i * 7**(i % 22) for i in range(100)]
    frame_of = spark.createDataFrame([(v,) for v in values], "a long")
    assert frame_of.agg(_sum("a").alias("s")).head().s == sum(values)


def test_doubles_of_one_group_do_not_fill_the_bitmap_of_another(spark, monkeypatch):
    """Hashes are kept by group, and through bitmaps the doubles are the same."""
    same = [{**TRANSACTION, "source_row_index": i, "price": float(i)} for i in range(40)] + [{**TRANSACTION, "transaction_unique_id": f"V{i}", "price": 1.0} for i in range(3)]
    ctx = filing(spark, transactions=same)
    doubles = pick(catalogue(SETTINGS), templates=["T6"], tables=["transactions"])
    kept = find_repeats(ctx, doubles)
    assert [r.n for r in kept.values()] == [1, 1] and [r.hashes.count() for r in kept.values()] == [1, 1]
    assert len({r.hashes.head().h & 63 for r in kept.values()}) == 2

    def found():
        return Counter((r.rule_id, r.record_id) for r in validate(ctx, doubles).violations.collect())

    want = found()
    monkeypatch.setattr(groups, "MOST_HASHES", 0)
    assert found() == want and want["F.25.17.2", "V0"] == 1 and want["F.24.15.1", "V0"] == 0
