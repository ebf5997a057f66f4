"""Readers and writers on small files."""

import datetime as dt
import io
import os
import zipfile

import pyarrow as pa
import pyarrow.parquet as pq

from ledgerproof.plans import coverage, profile, reports
from ledgerproof.sources import archive, lake, registry, tables
from pyspark.sql import functions as F
from tests.golden import CONTRACT, INDEX, SETTINGS, TRANSACTION, filing, frame


def test_lake_layout_gives_company_period_tier(spark, tmp_path):
    for cid, period, tier, n in [("C1", "2025-Q1", "bronze", 3), ("C1", "2025-Q2", "silver", 2), ("C2", "2025Q1", "bronze", 1)]:
        folder = tmp_path / "lake" / cid / period / tier
        os.makedirs(folder)
        pq.write_table(pa.table({"transaction_unique_id": [str(i) for i in range(n)]}), folder / "transactions.parquet")
        pq.write_table(pa.table({"contract_unique_id": ["k"]}), folder / "contracts.parquet")
    root = str(tmp_path / "lake")
    counts = lake.read_files(spark, root, "transactions").groupBy("cid", "period", "tier").count().collect()
    assert sorted(map(tuple, counts)) == [("C1", "2025Q1", "bronze", 3), ("C1", "2025Q2", "silver", 2), ("C2", "2025Q1", "bronze", 1)]
    files = lake.lake_files(spark, root).collect()
    assert len(files) == 6 and {f.table for f in files} == {"transactions", "contracts"}
    for f in files:
        assert f.size_mb == round(os.path.getsize(f.path.removeprefix("file:")) / 1048576, 2)


def test_partitioned_lake_round_trip_and_upsert(spark, tmp_path):
    root = str(tmp_path / "lake")
    ctx = filing(spark)
    for name in ("transactions", "contracts", "ident"):
        lake.write_partitioned(ctx.table(name), f"{root}/{name}")
    loaded = lake.load_context(spark, root, SETTINGS, cid="C000001", period="2024Q1")
    assert loaded.table("transactions").count() == 1 and loaded.table("index").count() == 0
    assert loaded.table("transactions").collect()[0].transaction_end_date == dt.date(2024, 1, 16)
    scan = loaded.table("transactions")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cid" in scan
    newer = frame(spark, "transactions", [{**TRANSACTION, "period": "2024Q2"}, {**TRANSACTION, "period": "2024Q2", "source_row_index": 2}])
    lake.upsert_partitions(newer, f"{root}/transactions", ["cid", "period"])
    stored = spark.read.parquet(f"{root}/transactions").groupBy("period").count().collect()
    assert sorted(map(tuple, stored)) == [("2024Q1", 1), ("2024Q2", 2)]


def test_normalize_renames_types_and_metadata(spark):
    raw = spark.createDataFrame([("T1", "45.5", "2024-01-02", "x"), ("T2", "oops", "not a day", "y")],
                                "transaction_unique_id string, transaction_price string, transaction_begin_date string, extra string")
    rows = tables.normalize(raw, "transactions", {"cid": "C1", "year": "2024", "quarter": "1"}).orderBy("transaction_unique_id").collect()
    assert (rows[0].price, rows[0].transaction_begin_date, rows[0].seller_cid, rows[0].period) == (45.5, dt.date(2024, 1, 2), "C1", "2024Q1")
    assert rows[1].price is None and rows[1].transaction_begin_date is None
    wrong = {(r.record_id, r.column_name, r.value) for r in tables.typing_errors(raw, "transactions").collect()}
    assert wrong == {("T2", "price", "oops"), ("T2", "transaction_begin_date", "not a day")}


def test_registry_csv_blank_end_is_open(spark, tmp_path):
    path = tmp_path / "registry.csv"
    path.write_text("CID,Organization_Name,effective_start_date,effective_end_date\nC7,Birch Grid,2021-03-01,\nC7,Elm Grid,2019-05-01,2021-03-01\n")
    rows = {r.legal_name: r for r in registry.import_registry(spark, str(path)).collect()}
    assert rows["Birch Grid"].effective_end is None and rows["Elm Grid"].effective_end == dt.date(2021, 3, 1)
    closed = registry.close_versions(registry.import_registry(spark, str(path))).collect()
    assert {r.legal_name: r.effective_end for r in closed} == {"Elm Grid": dt.date(2021, 3, 1), "Birch Grid": None}


def _inner(rows: str) -> bytes:
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as inner:
        inner.writestr("filing_ident.CSV", "cid,company_name,state\n" + rows)
        inner.writestr("filing_contracts.CSV", "contract_unique_id\nK1\n")
    return buffer.getvalue()


def test_nested_archive_and_state_discovery(spark, tmp_path):
    path = str(tmp_path / "CSV_2025_Q1.zip")
    many = "".join(f"C{i},Company {i},OR\n" for i in range(10, 6010))  # more than one batch
    with zipfile.ZipFile(path, "w") as outer:
        outer.writestr("b.ZIP", _inner('C1,"Pine Harbor, Town of",WA\nC2,Maple Falls,wa\n'))
        outer.writestr("a.ZIP", _inner("C1,Pine Harbor Light,WA\nC3,,WA\n"))
        outer.writestr("c.ZIP", _inner(many))
        outer.writestr("readme.txt", "not a filing")
    raw = archive.read_archive(spark, path, "_ident.CSV")
    ident = archive.columns_of(raw, ["cid", "company_name", "state"])
    assert ident.count() == 6004
    assert ident.filter("company_name IS NULL").count() == 1
    found = {r.cid: (r.company_name, r.source_filing) for r in archive.discover_entities(ident, "WA").collect()}
    assert found == {"C1": ("Pine Harbor Light", "a.ZIP"), "C2": ("Maple Falls", "b.ZIP"), "C3": (None, "a.ZIP")}
    assert archive.read_archive(spark, path, "_contracts.CSV").count() == 3


def test_metadata_survives_parquet(spark, tmp_path):
    path = str(tmp_path / "draft.parquet")
    tables.with_metadata(frame(spark, "index", [INDEX]), cid="C1", year="2024", quarter="1").write.parquet(path)
    assert tables.metadata_of(spark.read.parquet(path)) == {"cid": "C1", "year": "2024", "quarter": "1"}


def test_optional_table_and_first_available(spark, tmp_path):
    assert tables.read_optional(spark, str(tmp_path / "none.parquet"), frame(spark, "index", []).schema).count() == 0
    df = spark.createDataFrame([("a", "b")], "company_name string, seller_name string")
    assert df.select(tables.first_available(df, ["seller_company_name", "seller_name"]).alias("n")).collect()[0].n == "b"


def test_coverage_has_three_outcomes(spark):
    index = spark.createDataFrame([("C1", "Heron Trading"), ("C2", "Otter Fuel North"), ("C3", "OTTER FUEL South")], "cid string, legal_name string")
    tx = spark.createDataFrame([("C1", "2025Q1"), ("C1", "2025Q1"), ("C1", "2025Q2")], "cid string, period string")
    ct = spark.createDataFrame([("C1", "2025Q1")], "cid string, period string")
    rows = coverage.company_coverage(["heron", "Otter Fuel", "Finch Solar"], index, tx, ct).collect()
    assert sorted((r.search_name, r.matched_name, r.period, r.tx_records, r.ct_records, r.status) for r in rows if r.period) == [
        ("heron", "Heron Trading", "2025Q1", 2, 1, "Found in Lake"), ("heron", "Heron Trading", "2025Q2", 1, 0, "Found in Lake")]
    assert {(r.search_name, r.cid, r.status) for r in rows if not r.period} == {
        ("Otter Fuel", "C2", "Found in Index, not in Lake"), ("Finch Solar", None, "Not in Index")}


def test_schema_profile(spark):
    tx, ct = frame(spark, "transactions", [TRANSACTION]), frame(spark, "contracts", [CONTRACT])
    rows = {(r.table_name, r.column_name): r for r in profile.schema_profile(spark, {"transactions": tx, "contracts": ct}).collect()}
    assert rows["transactions", "price"].data_type == "DOUBLE" and rows["transactions", "trade_date"].data_type == "STRING"
    assert rows["contracts", "contract_unique_id"].is_key_candidate and rows["contracts", "product_name"].shared_with == "transactions"


def test_mismatch_evidence_names_missing_agreements(spark):
    other = {**TRANSACTION, "transaction_unique_id": "T2", "product_name": "CAPACITY"}
    nowhere = {**other, "transaction_unique_id": "T3", "contract_service_agreement": "A9"}
    tx = frame(spark, "transactions", [TRANSACTION, other, nowhere])
    rows = reports.mismatch_evidence(tx, frame(spark, "contracts", [CONTRACT]), ("contract_service_agreement", "contract_service_agreement_id"), "product_name")
    assert {r.transaction_unique_id: r.authorized_product for r in rows.collect()} == {"T2": "ENERGY", "T3": "NONE (Agreement Missing)"}


def test_report_is_one_ordered_text_file(spark, tmp_path):
    stats = spark.createDataFrame([("A", 5), ("B", 12345), ("C", 0)], "rule_id string, error_count long")
    rules = spark.createDataFrame([("A", 0, "Error", "first"), ("B", 1, "Warning", "second")], "rule_id string, seq int, severity string, description string")
    path = str(tmp_path / "report")
    lake.write_report(reports.report_lines(stats, rules, "Audit"), path)
    parts = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(parts) == 1
    assert open(os.path.join(path, parts[0])).read().splitlines() == [
        "# Audit", "12350 violations detected by 2 rules.", "| B | Warning | 12,345 | second |", "| A | Error | 5 | first |"]
    none = reports.report_lines(stats.filter("error_count = 0"), rules, "Audit").orderBy("line_no").collect()
    assert none[1].line == "No violations detected. The filing is compliant."


def test_outcomes_follow_catalogue_order(spark):
    stats = spark.createDataFrame([("C1", "B", 2, None), ("C1", "A", 0, None), ("C1", "Z", 0, "NO_COLUMN")],
                                  "cid string, rule_id string, error_count long, engine_failure string")
    rules = spark.createDataFrame([("B", 0, "b"), ("A", 1, "a"), ("Z", 2, "z")], "rule_id string, seq int, description string")
    rows = reports.outcomes(stats, rules)
    assert [(r.code, r.result) for r in rows.collect()] == [("B", "Failed (2 violations)"), ("A", "Passed"), ("Z", "Failed Execution: NO_COLUMN")]
    wide = reports.result_matrix(rows, ["B", "A", "Z", "Q"]).collect()[0]
    assert tuple(wide) == ("C1", "Failed (2 violations)", "Passed", "Failed Execution: NO_COLUMN", "N/A")


def test_session_names_the_shared_folder(spark):
    from ledgerproof.session import scratch_path, shared_folder
    folder = shared_folder(spark)
    assert spark.conf.get("spark.checkpoint.dir") == folder
    assert scratch_path(spark, "x").startswith(folder) and scratch_path(spark, "x") != scratch_path(spark, "x")
    assert F.lit(1) is not None


def test_lake_reads_only_wanted_partitions(spark, tmp_path):
    """Two tiers; the list of partitions comes from the table of wanted filings before files are opened."""
    rows = [(f"C{i % 5}", f"202{i % 3}Q{1 + i % 4}", "silver" if i % 2 else "bronze", i) for i in range(240)]
    lake.write_lake(spark.createDataFrame(rows, "cid string, period string, tier string, n int"), str(tmp_path), "transactions")
    wanted = spark.createDataFrame([("C1", "2021Q2"), ("C4", "2020Q1"), ("C9", "2020Q1"), (None, "2020Q1")], "cid string, period string")
    read = lake.read_lake(spark, str(tmp_path), "transactions", wanted)
    assert {r.n for r in read.collect()} == {n for c, p, _, n in rows if (c, p) in {("C1", "2021Q2"), ("C4", "2020Q1")}}
    assert "dynamicpruning" in read._jdf.queryExecution().executedPlan().toString()
    silver = lake.read_lake(spark, str(tmp_path), "transactions", wanted, tier="silver")
    assert {r.n for r in silver.collect()} == {n for c, p, t, n in rows if (c, p) in {("C1", "2021Q2"), ("C4", "2020Q1")} and t == "silver"}


def test_joinable_columns_from_sketches(spark):
    """Beyond the sketch size, containment is within three standard errors; below, it is exact."""
    n = 60_000
    a = spark.range(n).selectExpr("id AS a_key", "concat('x', id % 700) AS a_name", "CAST(NULL AS STRING) AS nothing")
    b = spark.range(n).selectExpr("id * 2 AS b_key", "concat('x', id % 900) AS b_name")
    found = {(r.left_column, r.right_column): r for r in profile.joinable_columns({"a": a, "b": b}, least=0.0).collect()}
    assert found["a_name", "b_name"].containment == 1.0 and found["b_name", "a_name"].containment == round(700 / 900, 6)
    assert (found["a_name", "b_name"].n_left, found["a_name", "b_name"].n_right) == (700, 900)
    error = 3 / 4096 ** 0.5
    assert abs(found["a_key", "b_key"].n_left - n) < error * n and abs(found["a_key", "b_key"].containment - 0.5) < 2 * error
    assert ("a_key", "b_name") not in found and not any("nothing" in k for k in found)


def test_joinable_columns_are_exact_at_any_size(spark):
    """More distinct values than a sketch holds, shares just at and below the limit, numbers past 2**53."""
    a = spark.range(20_000).selectExpr("id AS a_key", "CAST(id % 5 AS DOUBLE) AS a_few", "id + 9007199254740992 AS a_large")
    b = spark.range(18_000).selectExpr("id AS b_key", "id * 2 + 9007199254740993 AS b_large")
    found = {(r.left_column, r.right_column): (r.n_left, r.n_right, r.containment) for r in profile.joinable_columns({"a": a, "b": b}).collect()}
    assert found == {("a_key", "b_key"): (20_000, 18_000, 0.9), ("b_key", "a_key"): (18_000, 20_000, 1.0), ("a_few", "b_key"): (5, 18_000, 1.0)}
    few = profile.joinable_columns({"a": spark.range(18_001).selectExpr("id AS a_key"), "b": spark.range(16_200).selectExpr("id AS b_key")}).collect()
    assert {(r.left_column, r.right_column) for r in few} == {("b_key", "a_key")}
