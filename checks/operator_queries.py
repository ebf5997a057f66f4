"""One query per operator over the driver tables, with its SQL counterpart."""

from __future__ import annotations

import json

import datetime as dt

from pyspark.sql import functions as F

from checks.driver import base, context, register
from checks.registry import query
from ledgerproof import schemas
from ledgerproof.context import FilingContext
from ledgerproof.functions import periods
from ledgerproof.operators import groups, intervals, joins, results
from ledgerproof.plans import coverage, incremental, profile, registry as rule_registry, reports
from ledgerproof.plans.catalogue import catalogue, catalogue_frame, charge_is_off_simple, ends_too_early
from ledgerproof.plans.engine import stored_for, validate
from ledgerproof.plans.mutation import Mutation, mutation_results
from ledgerproof.plans.rules import pick
from ledgerproof.session import scratch_path
from ledgerproof.sources import archive, lake, registry, tables

col, lit = F.col, F.lit

# --- sources and sinks ------------------------------------------------------------------------


@query("S1_parquet_scan", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem WHERE l_quantity > 45 GROUP BY 1, 2")
def _(spark, sf):
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").filter("l_quantity > 45")
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.count(lit(1)).alias("n"))


@query("S2_read_table", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus = 'P'")
def _(spark, sf):
    return spark.read.parquet(f"{sf}/orders.parquet").filter("o_orderstatus = 'P'").select("o_orderkey", "o_custkey", "o_orderstatus")


@query("S3_optional_table", "SELECT 'orders' AS table_name, count(*) AS n FROM orders UNION ALL SELECT 'missing', 0")
def _(spark, sf):
    there = tables.read_optional(spark, f"{sf}/orders.parquet", schemas.TRANSACTIONS)
    absent = tables.read_optional(spark, f"{sf}/no_such_table.parquet", schemas.TRANSACTIONS)
    count = F.count(lit(1)).alias("n")
    return there.agg(count).select(lit("orders").alias("table_name"), "n").unionByName(
        absent.agg(count).select(lit("missing").alias("table_name"), "n")
    )


@query("S4_recursive_discovery", """SELECT concat('C', o_custkey % 7) AS cid, concat(year(o_orderdate), 'Q', quarter(o_orderdate)) AS period,
      CASE WHEN o_orderstatus = 'F' THEN 'silver' ELSE 'bronze' END AS tier, count(*) AS n FROM orders
    WHERE (concat('C', o_custkey % 7), concat(year(o_orderdate), 'Q', quarter(o_orderdate))) IN (SELECT concat('C', c_custkey % 7), concat(1992 + c_custkey % 6, 'Q', 1 + c_custkey % 4)
      FROM customer WHERE c_acctbal > 5000) GROUP BY 1, 2, 3""")
def _(spark, sf):
    register(spark, sf)
    root = scratch_path(spark, "lake")
    filed = spark.sql("""SELECT concat('C', o_custkey % 7) AS cid, concat(year(o_orderdate), 'Q', quarter(o_orderdate)) AS period,
        CASE WHEN o_orderstatus = 'F' THEN 'silver' ELSE 'bronze' END AS tier, o_orderkey FROM orders""")
    lake.write_lake(filed, root, "transactions")
    wanted = spark.sql("SELECT concat('C', c_custkey % 7) AS cid, concat(1992 + c_custkey % 6, 'Q', 1 + c_custkey % 4) AS period FROM customer WHERE c_acctbal > 5000")
    return lake.read_lake(spark, root, "transactions", wanted).groupBy("cid", "period", "tier").agg(F.count(lit(1)).alias("n"))


@query("S5_file_sizes")
def _(spark, sf):
    files = lake.lake_files(spark, sf)
    return files.select(F.regexp_extract("path", r"([^/]+)\.parquet$", 1).alias("table_name"), "size_mb")


@query("S6_filing_metadata", """SELECT cid, count(*) AS n, 'C000001' AS company, '1995' AS filing_year, '1' AS filing_quarter
    FROM tx GROUP BY cid""")
def _(spark, sf):
    (tx,) = base(spark, sf, "tx")
    path = scratch_path(spark, "metadata")
    tables.with_metadata(tx.select("cid", "transaction_unique_id"), cid="C000001", year="1995", quarter="1").write.parquet(path)
    stored = spark.read.parquet(path)
    meta = tables.metadata_of(stored)
    return stored.groupBy("cid").agg(F.count(lit(1)).alias("n")).select(
        "cid", "n", lit(meta["cid"]).alias("company"), lit(meta["year"]).alias("filing_year"), lit(meta["quarter"]).alias("filing_quarter")
    )


@query("S7_registry_import", """SELECT CAST(cid AS STRING) AS cid, legal_name, CAST(effective_start AS STRING) AS effective_start,
    CAST(effective_end AS STRING) AS effective_end FROM reg""")
def _(spark, sf):
    (reg,) = base(spark, sf, "reg")
    path = scratch_path(spark, "registry")
    reg.selectExpr("cid AS CID", "legal_name AS Organization_Name", "effective_start AS effective_start_date",
                   "effective_end AS effective_end_date").write.option("header", True).csv(path)
    return registry.import_registry(spark, path).selectExpr(
        "cid", "legal_name", "CAST(effective_start AS STRING) AS effective_start", "CAST(effective_end AS STRING) AS effective_end")


@query("S9_csv_to_parquet", "SELECT c_mktsegment, count(*) AS n, max(c_custkey) AS last_key FROM customer GROUP BY 1")
def _(spark, sf):
    register(spark, sf)
    source, target = scratch_path(spark, "csv"), scratch_path(spark, "parquet")
    spark.table("customer").write.option("header", True).csv(source)
    lake.convert_csv(spark, source, target)
    stored = spark.read.parquet(target)
    return stored.groupBy("c_mktsegment").agg(F.count(lit(1)).alias("n"), F.max(col("c_custkey").cast("long")).alias("last_key"))


@query("S10_typing_errors", """SELECT 'transaction' AS record_type, transaction_unique_id AS record_id, 'price' AS column_name, class_name AS value
    FROM tx WHERE class_name IN ('PROMO', 'SMALL') AND try_cast(class_name AS DOUBLE) IS NULL""")
def _(spark, sf):
    (tx,) = base(spark, sf, "tx")
    raw = tx.select("transaction_unique_id", F.when(col("class_name").isin("PROMO", "SMALL"), col("class_name"))
                    .otherwise(col("price").cast("string")).alias("transaction_price"))
    return tables.typing_errors(raw, "transactions")


@query("S11_in_memory_frame", "SELECT rate_units, count(*) AS n FROM tx WHERE rate_units IN ('$/MW', '$/KW') GROUP BY 1")
def _(spark, sf):
    (tx,) = base(spark, sf, "tx")
    units = spark.createDataFrame([("$/MW",), ("$/KW",)], "rate_units string")
    return tx.join(units, "rate_units", "left_semi").groupBy("rate_units").agg(F.count(lit(1)).alias("n"))


@query("S12_register_views", "SELECT cid, period, count(*) AS n FROM fid GROUP BY 1, 2")
def _(spark, sf):
    context(spark, sf).register_views("v_")
    return spark.sql("SELECT cid, period, count(*) AS n FROM v_ident GROUP BY cid, period")


RULES_AS_DATA = """[
  {"id": "R.1", "table": "transactions", "severity": "Error", "description": "no rate units", "test": "rate_units IS NULL"},
  {"id": "R.2", "table": "transactions", "severity": "Warning", "description": "starts late",
   "test": "transaction_begin_date > CAST({{DATE}} AS DATE)"},
  {"id": "R.3", "table": "transactions", "severity": "Error", "description": "other seller", "test": "seller_cid <> {{CID}}"}]"""


@query("S13_rules_as_data", """SELECT rule_id, cid, count(*) AS n FROM (
    SELECT 'R.1' AS rule_id, cid FROM ftx WHERE rate_units IS NULL
    UNION ALL SELECT 'R.2', cid FROM ftx WHERE transaction_begin_date > DATE '2014-08-15'
    UNION ALL SELECT 'R.3', cid FROM ftx WHERE seller_cid <> 'C3') v GROUP BY 1, 2""")
def _(spark, sf):
    ctx = context(spark, sf)
    counts = validate(ctx, rule_registry.parse_rules(RULES_AS_DATA, ctx.settings, "C3")).counts
    return counts.groupBy("rule_id", "cid").agg(F.sum("error_count").alias("n")).filter("n > 0")


@query("S14_upsert_by_company", """SELECT cid, 'new' AS result, count(*) AS n FROM tx WHERE trade_date IS NULL AND cid >= 10 GROUP BY 1
    UNION ALL SELECT cid, 'old', count(*) FROM tx WHERE cid < 10 OR cid NOT IN (SELECT cid FROM tx WHERE trade_date IS NULL) GROUP BY 1""")
def _(spark, sf):
    (tx,) = base(spark, sf, "tx")
    count = F.count(lit(1)).alias("n")
    old = tx.groupBy("cid").agg(count).select("cid", lit("old").alias("result"), "n")
    new = tx.filter("trade_date IS NULL AND cid >= 10").groupBy("cid").agg(count).select("cid", lit("new").alias("result"), "n")
    return results.upsert(old, new, "cid")


MATRIX_RULES = ["F.24.3", "F.25.21.2", "F.30.48"]
# A rule the run does not hold, so that its column reads N/A.
MATRIX_COLUMNS = [*MATRIX_RULES, "F.99"]


def _matrix(spark, sf):
    ctx = context(spark, sf)
    run = validate(ctx, pick(catalogue(ctx.settings), rule_ids=MATRIX_RULES))
    cells = run.counts.groupBy("cid", "rule_id").agg(F.sum("error_count").cast("string").alias("cell"))
    return results.matrix(cells, "cid", "rule_id", MATRIX_COLUMNS, "cell")


MATRIX_SQL = """SELECT cid, CAST(count(*) FILTER (WHERE transaction_end_date <= transaction_begin_date) AS STRING) AS "F.24.3",
    CAST(count(*) FILTER (WHERE transaction_quantity <= 0) AS STRING) AS "F.25.21.2",
    CAST(count(*) FILTER (WHERE point_of_delivery_specific_location IS NULL) AS STRING) AS "F.30.48", 'N/A' AS "F.99"
    FROM ftx GROUP BY cid"""


@query("S15_matrix_csv", MATRIX_SQL)
def _(spark, sf):
    path = scratch_path(spark, "matrix")
    _matrix(spark, sf).write.option("header", True).csv(path)
    return spark.read.option("header", True).schema("cid string, " + ", ".join(f"`{r}` string" for r in MATRIX_COLUMNS)).csv(path)


@query("S16_report_text", """WITH t AS (SELECT count(*) AS a, (SELECT count(*) FROM orders WHERE o_orderpriority = '1-URGENT') AS b FROM lineitem WHERE l_quantity > 49)
    SELECT '# Audit' AS line UNION ALL SELECT concat(a + b, ' violations detected by 2 rules.') FROM t
    UNION ALL SELECT concat('| Q.1 | Error | ', format('{:,}', a), ' | large quantity |') FROM t
    UNION ALL SELECT concat('| Q.2 | Warning | ', format('{:,}', b), ' | urgent |') FROM t""")
def _(spark, sf):
    register(spark, sf)
    large = spark.table("lineitem").filter("l_quantity > 49").agg(F.count(lit(1)).alias("error_count"))
    urgent = spark.table("orders").filter("o_orderpriority = '1-URGENT'").agg(F.count(lit(1)).alias("error_count"))
    stats = large.select(lit("Q.1").alias("rule_id"), "error_count").unionByName(urgent.select(lit("Q.2").alias("rule_id"), "error_count"))
    rules = spark.createDataFrame([("Q.1", 0, "Error", "large quantity"), ("Q.2", 1, "Warning", "urgent")],
                                  "rule_id string, seq int, severity string, description string")
    path = scratch_path(spark, "report")
    lake.write_report(reports.report_lines(stats, rules, "Audit"), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query("S17_draft_sink", "SELECT 'u1' AS user_id, 's7' AS session_id, class_name, count(*) AS n FROM tx GROUP BY class_name")
def _(spark, sf):
    (tx,) = base(spark, sf, "tx")
    path = scratch_path(spark, "drafts")
    lake.write_draft(tx.select("transaction_unique_id", "class_name"), path, "u1", "s7")
    return spark.read.parquet(path).groupBy("user_id", "session_id", "class_name").agg(F.count(lit(1)).alias("n"))


# --- projections, filters, predicates ---------------------------------------------------------


def tx_query(name, sql, build):
    """A query on the transactions view alone."""

    @query(name, sql)
    def _(spark, sf):
        (tx,) = base(spark, sf, "tx")
        return build(tx)


ID = "transaction_unique_id"

tx_query("P1_project_alias", f"SELECT {ID} AS id, product_name AS authorized_product FROM tx",
         lambda tx: tx.select(col(ID).alias("id"), col("product_name").alias("authorized_product")))
tx_query("P2_equality", f"SELECT {ID}, product_name FROM tx WHERE product_name = 'Brand#7'",
         lambda tx: tx.filter(col("product_name") == "Brand#7").select(ID, "product_name"))
tx_query("P3_null_or_null", f"SELECT {ID} FROM tx WHERE rate_units IS NULL OR trade_date IS NULL",
         lambda tx: tx.filter(col("rate_units").isNull() | col("trade_date").isNull()).select(ID))
tx_query("P4_membership", f"SELECT {ID}, rate_units FROM tx WHERE rate_units IN ('$/MW', '$/KW')",
         lambda tx: tx.filter(col("rate_units").isin("$/MW", "$/KW")).select(ID, "rate_units"))
tx_query("P5_guarded_not_in", f"SELECT {ID}, rate_units FROM tx WHERE rate_units IS NOT NULL AND rate_units NOT IN ('$/MW', '$/KW')",
         lambda tx: tx.filter(col("rate_units").isNotNull() & ~col("rate_units").isin("$/MW", "$/KW")).select(ID, "rate_units"))
tx_query("P8_compare_columns", f"SELECT {ID} FROM tx WHERE transaction_end_date <= transaction_begin_date",
         lambda tx: tx.filter(col("transaction_end_date") <= col("transaction_begin_date")).select(ID))
tx_query("P9_date_bound", f"SELECT {ID} FROM tx WHERE transaction_begin_date <= DATE '1995-06-01'",
         lambda tx: tx.filter(col("transaction_begin_date") <= lit(dt.date(1995, 6, 1))).select(ID))
tx_query("P10_absolute_tolerance", f"SELECT {ID} FROM tx WHERE abs(price * transaction_quantity - total_transaction_charge) > 1.0",
         lambda tx: tx.filter(F.abs(col("price") * col("transaction_quantity") - col("total_transaction_charge")) > 1.0).select(ID))
tx_query("P11_relative_tolerance",
         f"SELECT {ID} FROM tx WHERE abs(price * transaction_quantity - total_transaction_charge) > greatest(1.0, 0.5 * abs(price * transaction_quantity))",
         lambda tx: tx.withColumn("expected", col("price") * col("transaction_quantity")).filter(
             F.abs(col("expected") - col("total_transaction_charge")) > F.greatest(lit(1.0), 0.5 * F.abs("expected"))).select(ID))
tx_query("P12_defaults", f"SELECT {ID}, coalesce(rate_units, 'NONE') AS rate_units FROM tx",
         lambda tx: tx.select(ID, F.coalesce("rate_units", lit("NONE")).alias("rate_units")))
tx_query("P13_message", f"SELECT {ID}, 'Product ' || product_name || ' with units ' || rate_units AS message FROM tx",
         lambda tx: tx.select(ID, F.concat(lit("Product "), "product_name", lit(" with units "), "rate_units").alias("message")))
tx_query("P19_outcome_text",
         """SELECT cid, CASE WHEN cid = 3 THEN 'Failed Execution: no rows' WHEN count(*) FILTER (WHERE price > 998) > 0
            THEN 'Failed (' || count(*) FILTER (WHERE price > 998) || ' violations)' ELSE 'Passed' END AS result FROM tx GROUP BY cid""",
         lambda tx: tx.groupBy("cid").agg(F.count_if(col("price") > 998).alias("n")).select(
             "cid", results.outcome_text(col("n"), F.when(col("cid") == 3, "no rows")).alias("result")))
tx_query("P20_outcome_count",
         """SELECT cid, CASE WHEN cid = 3 THEN 'Failed Execution: no rows' ELSE CAST(count(*) FILTER (WHERE price > 998) AS STRING) END AS n
            FROM tx GROUP BY cid""",
         lambda tx: tx.groupBy("cid").agg(F.count_if(col("price") > 998).alias("n")).select(
             "cid", results.outcome_count(results.outcome_text(col("n"), F.when(col("cid") == 3, "no rows"))).alias("n")))
tx_query("P18_overwrite_columns", "SELECT product_name, rate_units, count(*) AS n FROM (SELECT 'Energy' AS product_name, CAST(NULL AS STRING) AS rate_units FROM tx) v GROUP BY 1, 2",
         lambda tx: tables.overwrite_columns(tx, {"product_name": "Energy", "rate_units": None})
         .groupBy("product_name", "rate_units").agg(F.count(lit(1)).alias("n")))
tx_query("P23_rounding", f"SELECT {ID}, round(transaction_quantity / 8, 2) AS eighth FROM tx",
         lambda tx: tx.select(ID, F.round(col("transaction_quantity") / 8, 2).alias("eighth")))
tx_query("P24_period_gate",
         f"""SELECT {ID} FROM tx WHERE concat(year(transaction_begin_date), 'Q', quarter(transaction_begin_date)) >= '1997Q3'
            AND concat(year(transaction_begin_date), 'Q', quarter(transaction_begin_date)) < '1999Q1'""",
         lambda tx: tx.filter(periods.applies(periods.period_of(col("transaction_begin_date")), "1997Q3", "1999Q1")).select(ID))


@query("P6_regex_non_match", r"SELECT page_id, url FROM pages WHERE NOT regexp_matches(url, '^https?://[a-z0-9.-]+\.(com|org)/')")
def _(spark, sf):
    register(spark, sf)
    return spark.table("pages").filter(~col("url").rlike(r"^https?://[a-z0-9.-]+\.(com|org)/")).select("page_id", "url")


@query("P7_contains_ignoring_case", "SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '(?i)WIDGET')")
def _(spark, sf):
    register(spark, sf)
    return spark.table("part").filter(col("p_name").rlike("(?i)WIDGET")).select("p_partkey", "p_name")


@query("P14_record_type", "SELECT 'transaction' AS record_type, count(*) AS n FROM tx UNION ALL SELECT 'contract', count(*) FROM ct")
def _(spark, sf):
    tx, ct = base(spark, sf, "tx", "ct")
    both = tx.select(lit("transaction").alias("record_type")).unionByName(ct.select(lit("contract").alias("record_type")))
    return both.groupBy("record_type").agg(F.count(lit(1)).alias("n"))


@query("P15_parameters", "SELECT transaction_unique_id, cid FROM tx WHERE cid = 7 AND transaction_begin_date < DATE '1997-01-01'")
def _(spark, sf):
    (tx,) = base(spark, sf, "tx")
    tx.createOrReplaceTempView("p_tx")
    text = "SELECT transaction_unique_id, cid FROM p_tx WHERE cid = {{CID}} AND transaction_begin_date < {{DATE}}"
    return tables.substitute(spark, text, CID=7, DATE=dt.date(1997, 1, 1))


@query("P16_normalize", """SELECT CAST(cid AS STRING) AS cid, CAST(cid AS STRING) AS seller_cid, '1995Q1' AS period, transaction_unique_id, price,
    CAST(transaction_begin_date AS STRING) AS begin_date, CAST(NULL AS STRING) AS time_zone FROM tx""")
def _(spark, sf):
    (tx,) = base(spark, sf, "tx")
    raw = tx.selectExpr("cid AS CID", ID, "CAST(price AS STRING) AS transaction_price", "CAST(transaction_begin_date AS STRING) AS transaction_begin_date")
    done = tables.normalize(raw, "transactions", {"year": "1995", "quarter": "1"})
    return done.select("cid", "seller_cid", "period", ID, "price", col("transaction_begin_date").cast("string").alias("begin_date"), "time_zone")


@query("P17_first_available", "SELECT seller_id, company_name AS company FROM ident")
def _(spark, sf):
    (ident,) = base(spark, sf, "ident")
    name = tables.first_available(ident, ["seller_company_name", "seller_name", "company_name"], "Unknown")
    return ident.select("seller_id", name.alias("company"))


@query("P21_category", """SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN 'CONSISTENCY' WHEN p_type = 'SMALL' THEN 'BOUNDS'
    WHEN p_size < 10 THEN 'STRUCTURAL' ELSE 'MANDATORY' END AS category FROM part""")
def _(spark, sf):
    register(spark, sf)
    severity = F.when(col("p_type") == "PROMO", "Critical").when(col("p_type") == "SMALL", "Warning").otherwise("Error")
    rule = F.when(col("p_size") < 5, "F.16.4.2").when(col("p_size") < 10, "F.TYPE_PRICE").otherwise("F.25.18")
    return spark.table("part").select("p_partkey", results.category(rule, severity).alias("category"))


@query("P22_stage", """SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN 'Type 3' WHEN 'SMALL' THEN 'Type 5' WHEN 'LARGE' THEN 'Type 2'
    WHEN 'ECONOMY' THEN 'Type 1' WHEN 'MEDIUM' THEN 'Type 4' ELSE 'Type 5' END AS stage FROM part""")
def _(spark, sf):
    register(spark, sf)
    name = (F.when(col("p_type") == "PROMO", "ARITHMETIC").when(col("p_type") == "SMALL", "AUDIT").when(col("p_type") == "LARGE", "LOOKUP")
            .when(col("p_type") == "ECONOMY", "SCHEMA").when(col("p_type") == "MEDIUM", "HISTORICAL").otherwise("OTHER"))
    return spark.table("part").select("p_partkey", results.stage(name).alias("stage"))


# --- joins ------------------------------------------------------------------------------------

AGREEMENT = "contract_service_agreement"


def _terms(ct):
    return ct.withColumnRenamed("contract_service_agreement_id", AGREEMENT)


@query("J1_anti_join", f"""SELECT {ID}, {AGREEMENT}, product_name FROM tx WHERE NOT EXISTS (SELECT 1 FROM ct
    WHERE ct.contract_service_agreement_id = tx.contract_service_agreement AND ct.product_name = tx.product_name)""")
def _(spark, sf):
    tx, ct = base(spark, sf, "tx", "ct")
    return joins.without_partner(tx, _terms(ct), [AGREEMENT, "product_name"]).select(ID, AGREEMENT, "product_name")


EDGE_KEYS = [AGREEMENT, "product_name"]
EDGE_SQL = """(SELECT DISTINCT tx.transaction_unique_id, CAST(ct.commencement_date AS STRING) AS contract FROM tx JOIN ct
    ON ct.contract_service_agreement_id = tx.contract_service_agreement AND ct.product_name = tx.product_name)"""


def _edges(tx, ct):
    terms = _terms(ct).withColumn("contract", col("commencement_date").cast("string"))
    return joins.edge_table(tx, terms, EDGE_KEYS, ID, "contract")


@query("J2_anti_edge", f"SELECT {ID}, product_name FROM tx WHERE {ID} NOT IN (SELECT {ID} FROM {EDGE_SQL} e)")
def _(spark, sf):
    tx, ct = base(spark, sf, "tx", "ct")
    return joins.not_in_edge(tx, joins.with_partner(tx, _terms(ct), EDGE_KEYS), ID).select(ID, "product_name")


@query("J3_left_join", f"""SELECT {ID}, tx.product_name, CAST(ct.commencement_date AS STRING) AS commencement_date FROM tx LEFT JOIN ct
    ON ct.contract_service_agreement_id = tx.contract_service_agreement AND ct.product_name = tx.product_name""")
def _(spark, sf):
    tx, ct = base(spark, sf, "tx", "ct")
    joined = joins.partner_optional(tx, _terms(ct), EDGE_KEYS)
    return joined.select(ID, "product_name", col("commencement_date").cast("string"))


@query("J4_inner_join", f"""SELECT {ID}, tx.product_name, CAST(ct.termination_date AS STRING) AS termination_date FROM tx, ct
    WHERE ct.contract_service_agreement_id = tx.contract_service_agreement AND ct.product_name = tx.product_name""")
def _(spark, sf):
    tx, ct = base(spark, sf, "tx", "ct")
    return tx.join(_terms(ct), EDGE_KEYS).select(ID, "product_name", col("termination_date").cast("string"))


@query("J5_adaptive_join", f"""SELECT {ID}, tx.product_name FROM tx JOIN ct ON ct.contract_service_agreement_id = tx.contract_service_agreement
    AND ct.product_name = tx.product_name""")
def _(spark, sf):
    tx, ct = base(spark, sf, "tx", "ct")
    return joins.adaptive_join(tx, _terms(ct), [AGREEMENT], profile.OPTIONAL_KEYS).select(ID, "product_name")


@query("J6_join_residual", f"""SELECT {ID}, tx.cid, legal_name FROM tx JOIN reg ON tx.cid = reg.cid AND legal_name = '1-URGENT'
    AND effective_start <= transaction_end_date AND (effective_end IS NULL OR transaction_end_date < effective_end)""")
def _(spark, sf):
    tx, reg = base(spark, sf, "tx", "reg")
    urgent = reg.filter("legal_name = '1-URGENT'")
    return intervals.interval_join(tx, urgent, "cid", "transaction_end_date", "effective_start", "effective_end").select(ID, "cid", "legal_name")


@query("J7_fixed_path", """SELECT n_name, c_custkey, o_orderkey, count(*) AS n_lines FROM nation JOIN customer ON c_nationkey = n_nationkey
    JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2, 3""")
def _(spark, sf):
    register(spark, sf)
    t = spark.table
    path = (t("nation").join(t("customer"), col("n_nationkey") == col("c_nationkey"))
            .join(t("orders"), col("c_custkey") == col("o_custkey")))
    # Lines are counted per order before the join, so line rows are not shuffled.
    lines = t("lineitem").groupBy("l_orderkey").agg(F.count(lit(1)).alias("n_lines"))
    return path.join(lines, col("o_orderkey") == col("l_orderkey")).select("n_name", "c_custkey", "o_orderkey", "n_lines")


@query("J8_bounded_path", """WITH RECURSIVE e AS (SELECT concat('n', c_nationkey) AS src, concat('c', c_custkey) AS dst FROM customer
      UNION ALL SELECT concat('c', c_custkey), concat('n', c_nationkey) FROM customer
      UNION ALL SELECT concat('c', o_custkey), concat('o', o_orderkey) FROM orders
      UNION ALL SELECT concat('r', n_regionkey), concat('n', n_nationkey) FROM nation),
    p AS (SELECT concat('r', r_regionkey) AS root, concat('r', r_regionkey) AS node, 0 AS hops FROM region
      UNION SELECT root, dst, hops + 1 FROM p JOIN e ON src = node WHERE hops < 4)
    SELECT root, node, min(hops) AS hops FROM p GROUP BY 1, 2 HAVING min(hops) > 0""")
def _(spark, sf):
    register(spark, sf)
    edges = spark.sql("""SELECT concat('r', n_regionkey) AS src, concat('n', n_nationkey) AS dst FROM nation
        UNION ALL SELECT concat('n', c_nationkey), concat('c', c_custkey) FROM customer
        UNION ALL SELECT concat('c', c_custkey), concat('n', c_nationkey) FROM customer
        UNION ALL SELECT concat('c', o_custkey), concat('o', o_orderkey) FROM orders""")
    roots = spark.table("region").select(F.concat(lit("r"), "r_regionkey").alias("root"))
    return joins.within_hops(edges, roots, 4)


@query("J9_known_group", f"""SELECT {ID}, {AGREEMENT}, product_name FROM tx
    WHERE {AGREEMENT} IN (SELECT contract_service_agreement_id FROM ct) AND NOT EXISTS (SELECT 1 FROM ct
    WHERE ct.contract_service_agreement_id = tx.contract_service_agreement AND ct.product_name = tx.product_name)""")
def _(spark, sf):
    tx, ct = base(spark, sf, "tx", "ct")
    return joins.known_group_unknown_member(tx, _terms(ct), [AGREEMENT], ["product_name"]).select(ID, AGREEMENT, "product_name")


@query("J10_interval_join", f"""SELECT {ID}, tx.cid, legal_name, CAST(effective_start AS STRING) AS effective_start FROM tx JOIN reg ON tx.cid = reg.cid
    AND effective_start <= transaction_end_date AND (effective_end IS NULL OR transaction_end_date < effective_end)""")
def _(spark, sf):
    tx, reg = base(spark, sf, "tx", "reg")
    joined = intervals.interval_join(tx, reg, "cid", "transaction_end_date", "effective_start", "effective_end")
    return joined.select(ID, "cid", "legal_name", col("effective_start").cast("string"))


@query("J11_lookup_join", f"SELECT {ID}, product_name FROM tx WHERE product_name IS NOT NULL AND product_name NOT IN (SELECT p_brand FROM part WHERE p_size > 48)")
def _(spark, sf):
    (tx,) = base(spark, sf, "tx")
    known = spark.table("part").filter("p_size > 48").select(col("p_brand").alias("product_name"))
    return joins.without_partner(tx.filter(col("product_name").isNotNull()), known, ["product_name"]).select(ID, "product_name")


@query("J12_previous_quarter", """WITH q AS (SELECT DISTINCT o_custkey AS agreement, year(o_orderdate) * 4 + quarter(o_orderdate) AS n,
      concat(year(o_orderdate), 'Q', quarter(o_orderdate)) AS period FROM orders)
    SELECT a.agreement, a.period FROM q a LEFT JOIN q b ON a.agreement = b.agreement AND b.n = a.n - 1 WHERE b.n IS NULL""")
def _(spark, sf):
    register(spark, sf)
    seen = spark.table("orders").select(col("o_custkey").alias("agreement"), periods.period_of(col("o_orderdate").cast("date")).alias("period")).distinct()
    earlier = seen.select("agreement", col("period").alias("previous"))
    wanted = seen.withColumn("previous", periods.previous_period(col("period")))
    return wanted.join(earlier, ["agreement", "previous"], "left_anti").select("agreement", "period")


NAMES = ["red widget", "Large", "NO SUCH COMPANY", "ring"]


@query("J13_name_match", """SELECT s AS search_name, p_partkey FROM (SELECT 'red widget' AS s UNION ALL SELECT 'Large' UNION ALL SELECT 'NO SUCH COMPANY'
    UNION ALL SELECT 'ring') n LEFT JOIN part ON contains(lower(p_name), lower(s))""")
def _(spark, sf):
    register(spark, sf)
    hits = joins.match_names(spark.table("part"), NAMES, "p_name").select("search_name", "p_partkey")
    wanted = spark.createDataFrame([(n,) for n in NAMES], "search_name string")
    # Hits stay where they are; only the few names without a hit are added.
    without = joins.without_partner(wanted, hits, ["search_name"]).withColumn("p_partkey", lit(None).cast(hits.schema["p_partkey"].dataType))
    return hits.unionByName(without)


@query("J14_registry_order", """SELECT cid, code, CASE WHEN n > 0 THEN concat('Failed (', n, ' violations)') ELSE 'Passed' END AS result FROM (
      SELECT cid, 'F.24.3' AS code, count(*) FILTER (WHERE transaction_end_date <= transaction_begin_date) AS n FROM ffilings LEFT JOIN ftx USING (cid, period) GROUP BY cid
      UNION ALL SELECT cid, 'F.25.21.2', count(*) FILTER (WHERE transaction_quantity <= 0) FROM ffilings LEFT JOIN ftx USING (cid, period) GROUP BY cid
      UNION ALL SELECT cid, 'F.30.48', count(*) FILTER (WHERE source_row_index IS NOT NULL AND point_of_delivery_specific_location IS NULL) FROM ffilings LEFT JOIN ftx USING (cid, period) GROUP BY cid) v""")
def _(spark, sf):
    run = _run(spark, sf, MATRIX_RULES)
    return reports.outcomes(run.stats, catalogue_frame(spark, run.groups)).select("cid", "code", "result")


@query("J15_sibling_table", """SELECT t.cid, t.period, t.n AS tx_records, coalesce(c.n, 0) AS ct_records FROM (SELECT cid, period, count(*) AS n FROM ftx GROUP BY 1, 2) t
    LEFT JOIN (SELECT cid, period, count(*) AS n FROM fct GROUP BY 1, 2) c ON t.cid = c.cid AND t.period = c.period""")
def _(spark, sf):
    ctx = context(spark, sf)
    tx = ctx.table("transactions").groupBy("cid", "period").agg(F.count(lit(1)).alias("tx_records"))
    ct = ctx.table("contracts").groupBy("cid", "period").agg(F.count(lit(1)).alias("ct_records"))
    return tx.join(ct, ["cid", "period"], "left").fillna(0, ["ct_records"])


@query("J16_presence_flag", "SELECT s_suppkey, s_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_quantity = 50 AND l_tax = 0.08) AS active FROM supplier")
def _(spark, sf):
    register(spark, sf)
    used = spark.table("lineitem").filter("l_quantity = 50 AND l_tax = 0.08").select(col("l_suppkey").alias("s_suppkey"))
    return joins.with_flag(spark.table("supplier"), used, ["s_suppkey"], "active").select("s_suppkey", "active")


# --- aggregates -------------------------------------------------------------------------------


def n_rows():
    return F.count(lit(1)).alias("n")



tx_query("A1_row_count", "SELECT count(*) AS n FROM tx", lambda tx: tx.agg(n_rows()))
tx_query("A2_count_by_two", "SELECT class_name, rate_units, count(*) AS n FROM tx GROUP BY 1, 2",
         lambda tx: results.count_by(tx, "class_name", "rate_units"))
tx_query("A3_filtered_count", "SELECT cid, count(*) FILTER (WHERE trade_date IS NULL) AS n FROM tx GROUP BY 1",
         lambda tx: tx.groupBy("cid").agg(F.count_if(col("trade_date").isNull()).alias("n")))
tx_query("A4_totals", "SELECT count(*) AS total, count(DISTINCT cid) AS rules_fired FROM tx WHERE trade_date IS NULL",
         lambda tx: results.summary(tx.groupBy("cid").agg(F.count_if(col("trade_date").isNull()).alias("error_count"))))
tx_query("A5_duplicates", f"SELECT {ID}, count(*) AS n FROM tx GROUP BY 1 HAVING count(*) > 1",
         lambda tx: groups.duplicate_rows(tx, [ID]).groupBy(ID).agg(n_rows()))
tx_query("A6_distinct", "SELECT DISTINCT product_name, class_name FROM tx", lambda tx: tx.select("product_name", "class_name").distinct())
tx_query("A7_set_per_group", "SELECT DISTINCT customer_company_name, product_name FROM tx",
         lambda tx: groups.members(tx, ["customer_company_name"], ["product_name"]))
tx_query("A14_size_limits", "SELECT cid, count(*) AS n FROM tx GROUP BY 1 HAVING count(*) > 2400", lambda tx: tx.groupBy("cid").agg(n_rows()).filter("n > 2400"))
tx_query("A15_mixed_groups", f"SELECT {AGREEMENT} FROM tx GROUP BY 1 HAVING count(DISTINCT trade_date IS NULL) > 1",
         lambda tx: tx.withColumn("open", col("trade_date").isNull()).groupBy(AGREEMENT).agg(groups.differs_within("open").alias("mixed"))
         .filter("mixed").select(AGREEMENT))
tx_query("A9_violation_rate", "SELECT cid, CASE WHEN count(*) > 0 THEN round(count(*) FILTER (WHERE trade_date IS NULL) / CAST(count(*) AS DOUBLE), 9) ELSE 0.0 END AS violation_rate FROM tx GROUP BY 1",
         lambda tx: tx.groupBy("cid").agg(F.count_if(col("trade_date").isNull()).alias("bad"), n_rows())
         .select("cid", F.round(results.rate(col("bad"), col("n")), 9).alias("violation_rate")))
tx_query("A13_average_duration", f"SELECT customer_company_name FROM tx GROUP BY 1 HAVING avg(date_diff('day', transaction_begin_date, transaction_end_date)) > 100",
         lambda tx: tx.groupBy("customer_company_name").agg(F.avg(F.datediff("transaction_end_date", "transaction_begin_date")).alias("days"))
         .filter("days > 100").select("customer_company_name"))


@query("A8_cardinality", "SELECT cid, count(*) FILTER (WHERE filer_unique_id LIKE 'FA%') AS n FROM ident GROUP BY 1 HAVING count(*) FILTER (WHERE filer_unique_id LIKE 'FA%') <> 1")
def _(spark, sf):
    (ident,) = base(spark, sf, "ident")
    return groups.cardinality(ident, ["cid"], n=col("filer_unique_id").startswith("FA")).filter("n <> 1")


@query("A10_matrix", MATRIX_SQL)
def _(spark, sf):
    return _matrix(spark, sf)


@query("A12_throughput", "SELECT count(*) AS rows_scanned, true AS is_measured FROM tx")
def _(spark, sf):
    (tx,) = base(spark, sf, "tx")
    measured = reports.timed(tx, lambda rows: rows.filter("rate_units IS NULL"))
    return measured.select("rows_scanned", (col("seconds") > 0).alias("is_measured"))


@query("A16_set_equality", """SELECT cid, period, count(*) FILTER (WHERE later <> earlier) AS n_different FROM (
      SELECT cid, period, publisher, publication, bool_or(coalesce(filing_type = 'Append', false)) AS later,
             bool_or(coalesce(filing_type, '') <> 'Append') AS earlier FROM fix GROUP BY 1, 2, 3, 4) s
    GROUP BY 1, 2 HAVING bool_or(later) AND count(*) FILTER (WHERE later <> earlier) > 0""")
def _(spark, sf):
    index = context(spark, sf).table("index").withColumn("appended", F.coalesce(col("filing_type") == "Append", lit(False)))
    return groups.set_difference_keys(index, ["cid", "period"], ["publisher", "publication"], ~col("appended"), col("appended"))


@query("A17_acceptance", """SELECT f.cid, f.period, CASE WHEN EXISTS (SELECT 1 FROM fid i WHERE i.cid = f.cid AND i.period = f.period AND coalesce(trim(i.zip), '') = '')
    THEN 'rejected' ELSE 'accepted' END AS status FROM ffilings f""")
def _(spark, sf):
    ctx = context(spark, sf)
    run = validate(ctx, pick(catalogue(ctx.settings), rule_ids=["F.19.1.1", "F.20.22"]))
    return results.acceptance(run.violations, ctx.filings)


# --- sort, limit, top-k -----------------------------------------------------------------------

tx_query("L1_order_by_count", "SELECT product_name, count(*) AS n FROM tx GROUP BY 1", lambda tx: results.count_by(tx, "product_name"))
tx_query("L2_limit", f"SELECT {ID}, cid FROM tx WHERE trade_date IS NULL ORDER BY 1, 2 LIMIT 10",
         lambda tx: tx.filter("trade_date IS NULL").select(ID, "cid").orderBy(ID, "cid").limit(10))
tx_query("L3_sample_per_group", f"SELECT cid, {ID}, product_name FROM (SELECT DISTINCT cid, {ID}, product_name FROM tx) d QUALIFY row_number() OVER (PARTITION BY cid ORDER BY {ID}, product_name) <= 5",
         lambda tx: results.first_n_per_group(tx.select("cid", ID, "product_name").distinct(), ["cid"], [ID, "product_name"], 5))
tx_query("L4_head", f"SELECT {ID}, product_name FROM tx ORDER BY 1, 2 LIMIT 1000", lambda tx: tx.select(ID, "product_name").orderBy(ID, "product_name").limit(1000))
tx_query("L5_first_value", "SELECT cid, min(customer_company_name) AS company FROM tx GROUP BY 1",
         lambda tx: tx.groupBy("cid").agg(F.min_by("customer_company_name", "customer_company_name").alias("company")))
tx_query("L6_first_ten_keys", f"""SELECT class_name AS rule_id, string_agg({ID}, ', ' ORDER BY {ID}) AS record_ids FROM (SELECT DISTINCT class_name, {ID} FROM tx
         QUALIFY dense_rank() OVER (PARTITION BY class_name ORDER BY {ID}) <= 10) v GROUP BY 1""",
         lambda tx: results.first_keys(tx.select(col("class_name").alias("rule_id"), col(ID).alias("record_id"))))

# --- set operations ---------------------------------------------------------------------------


@query("U1_union_violations", """SELECT rule_id, cid, period, count(*) AS n FROM (
    SELECT 'F.24.3' AS rule_id, cid, period FROM ftx WHERE transaction_end_date <= transaction_begin_date
    UNION ALL SELECT 'F.20.3', cid, period FROM fct WHERE contract_execution_date <= DATE '1900-01-01'
    UNION ALL SELECT 'F.19.1.7', cid, period FROM fid WHERE coalesce(trim(address), '') = '') v GROUP BY 1, 2, 3""")
def _(spark, sf):
    ctx = context(spark, sf)
    run = validate(ctx, pick(catalogue(ctx.settings), rule_ids=["F.24.3", "F.20.3", "F.19.1.7"]))
    return run.violations.groupBy("rule_id", "cid", "period").agg(n_rows())


@query("U2_union_record_types", """SELECT cid, record_type, count(*) AS n FROM (SELECT cid, 'transaction' AS record_type FROM ftx UNION ALL SELECT cid, 'contract' FROM fct
    UNION ALL SELECT cid, 'identity' FROM fid UNION ALL SELECT cid, 'index' FROM fix) u GROUP BY 1, 2""")
def _(spark, sf):
    ctx = context(spark, sf)
    parts = [ctx.table(t).select("cid", lit(schemas.RECORD_TYPE[t]).alias("record_type")) for t in ("transactions", "contracts", "ident", "index")]
    merged = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    return merged.groupBy("cid", "record_type").agg(n_rows())


@query("U3_unwind", "SELECT page_id, unnest(string_split(url, '/')) AS part FROM pages")
def _(spark, sf):
    register(spark, sf)
    return spark.table("pages").select("page_id", F.explode(F.split("url", "/")).alias("part"))


# --- scalar functions -------------------------------------------------------------------------

tx_query("F1_abs", f"SELECT {ID}, abs(transaction_quantity - 25) AS v FROM tx", lambda tx: tx.select(ID, F.abs(col("transaction_quantity") - 25).alias("v")))
tx_query("F2_arithmetic", f"SELECT {ID}, price * transaction_quantity AS v FROM tx", lambda tx: tx.select(ID, (col("price") * col("transaction_quantity")).alias("v")))
tx_query("F3_concat", f"SELECT concat({ID}, ':', product_name) AS v FROM tx", lambda tx: tx.select(F.concat(ID, lit(":"), "product_name").alias("v")))
tx_query("F4_regex_extract", f"SELECT {ID}, regexp_extract(product_name, '#(\\d+)$', 1) AS v FROM tx WHERE regexp_matches(product_name, '^Brand')",
         lambda tx: tx.filter(col("product_name").rlike("^Brand")).select(ID, F.regexp_extract("product_name", r"#(\d+)$", 1).alias("v")))
tx_query("F8_date_format", f"SELECT {ID}, strftime(transaction_begin_date, '%Y-%m-%d') AS v FROM tx", lambda tx: tx.select(ID, F.date_format("transaction_begin_date", "yyyy-MM-dd").alias("v")))
tx_query("F9_replace", f"SELECT {ID}, replace(product_name, 'Brand#', 'B') AS v FROM tx", lambda tx: tx.select(ID, F.replace(col("product_name"), lit("Brand#"), lit("B")).alias("v")))
tx_query("F10_to_number", f"SELECT {ID}, try_cast(rate_units AS DOUBLE) AS a, try_cast(CAST(price AS STRING) AS DOUBLE) AS b FROM tx",
         lambda tx: tx.select(ID, col("rate_units").try_cast("double").alias("a"), col("price").cast("string").try_cast("double").alias("b")))
tx_query("F11_case", f"SELECT {ID}, concat(upper(substring(class_name, 1, 1)), lower(substring(class_name, 2))) AS v, lower(product_name) AS w FROM tx",
         lambda tx: tx.select(ID, F.initcap("class_name").alias("v"), F.lower("product_name").alias("w")))
tx_query("F12_thousands", "SELECT cid, format('{:,}', count(*)) AS v FROM tx GROUP BY 1", lambda tx: tx.groupBy("cid").agg(n_rows()).select("cid", F.format_number("n", 0).alias("v")))
tx_query("F13_prefix", f"SELECT {ID} FROM tx WHERE starts_with(product_name, 'Brand#1')", lambda tx: tx.filter(col("product_name").startswith("Brand#1")).select(ID))
tx_query("F14_length", f"SELECT {ID}, length(product_name) AS v FROM tx", lambda tx: tx.select(ID, F.length("product_name").alias("v")))


@query("F5_size_F6_index_F7_split", "SELECT page_id, len(string_split(url, '/')) AS n, string_split(url, '/')[3] AS host FROM pages")
def _(spark, sf):
    register(spark, sf)
    parts = F.split("url", "/")
    return spark.table("pages").select("page_id", F.size(parts).alias("n"), F.get(parts, lit(2)).alias("host"))


# --- pipeline-level operators -----------------------------------------------------------------

R_RULES = ["F.24.3", "F.25.21.2", "F.30.48", "F.TYPE_PRICE"]
R_FOUND = """(SELECT 'F.24.3' AS rule_id, cid, period, transaction_unique_id AS record FROM ftx WHERE transaction_end_date <= transaction_begin_date
    UNION ALL SELECT 'F.25.21.2', cid, period, transaction_unique_id FROM ftx WHERE transaction_quantity <= 0
    UNION ALL SELECT 'F.30.48', cid, period, transaction_unique_id FROM ftx WHERE point_of_delivery_specific_location IS NULL
    UNION ALL SELECT 'F.TYPE_PRICE', cid, period, transaction_unique_id FROM ftx WHERE price IS NULL)"""


def _run(spark, sf, rules=R_RULES, stored=()):
    """The run of some rules. Results that read transactions several times do so from a table of what the rules read."""
    ctx = context(spark, sf)
    groups = pick(catalogue(ctx.settings), rule_ids=rules)
    if stored:
        ctx = stored_for(ctx, groups, scratch_path(spark, "filings"), list(stored))
    return validate(ctx, groups)


@query("R1_validate", f"""SELECT r.rule_id, f.cid, f.period, coalesce(v.n, 0) AS error_count, coalesce(t.n, 0) AS total_count FROM ffilings f
    CROSS JOIN (SELECT DISTINCT rule_id FROM {R_FOUND} x) r
    LEFT JOIN (SELECT rule_id, cid, period, count(*) AS n FROM {R_FOUND} y GROUP BY 1, 2, 3) v ON v.rule_id = r.rule_id AND v.cid = f.cid AND v.period = f.period
    LEFT JOIN (SELECT cid, period, count(*) AS n FROM ftx GROUP BY 1, 2) t ON t.cid = f.cid AND t.period = f.period""")
def _(spark, sf):
    return _run(spark, sf, stored=["transactions"]).stats.select("rule_id", "cid", "period", "error_count", "total_count")


# Rules that fail on some rows: a cast of an expression, a division, a cast by ::, a date, an element.
FAILING = {
    "X.CAST": ("CAST(trim(transaction_unique_id) AS INT) < 0", "TRY_CAST(trim(transaction_unique_id) AS INTEGER)", "< 0", "trim(transaction_unique_id) IS NOT NULL", "CAST_INVALID_INPUT"),
    "X.DIVIDE": ("price / total_transmission_charge > 100000", "price / nullif(total_transmission_charge, 0)", "> 100000", "price IS NOT NULL AND total_transmission_charge IS NOT NULL", "DIVIDE_BY_ZERO"),
    "X.CASTS": ("class_name::int = 1", "TRY_CAST(class_name AS INTEGER)", "= 1", "class_name IS NOT NULL", "CAST_INVALID_INPUT"),
    "X.DATE": ("to_date(contract_unique_id) < DATE'2000-01-01'", "TRY_CAST(contract_unique_id AS DATE)", "< DATE '2000-01-01'", "contract_unique_id IS NOT NULL", "CANNOT_PARSE_TIMESTAMP"),
    "X.ELEMENT": ("element_at(split(product_name, ' '), 2) = 'OUT'", "string_split(product_name, ' ')[2]", "= 'OUT'", "product_name IS NOT NULL", "INVALID_ARRAY_INDEX"),
}
_FAILING_SQL = " UNION ALL ".join(
    f"SELECT '{name}', count(*) FILTER (WHERE {value} {test}), CASE WHEN count(*) FILTER (WHERE {given} AND {value} IS NULL) > 0 THEN '{reason}' END FROM ftx"
    for name, (_, value, test, given, reason) in FAILING.items())


@query("R2_isolated_failure", f"""SELECT rule_id, count(*) AS error_count, CAST(NULL AS STRING) AS engine_failure FROM {R_FOUND} v WHERE rule_id = 'F.24.3' GROUP BY 1
    UNION ALL SELECT 'BROKEN', 0, 'UNRESOLVED_COLUMN.WITH_SUGGESTION' UNION ALL {_FAILING_SQL}""")
def _(spark, sf):
    ctx = context(spark, sf)
    given = [{"id": "BROKEN", "table": "transactions", "test": "no_such_column > 1"},
             *[{"id": name, "table": "transactions", "test": test[0]} for name, test in FAILING.items()]]
    groups = pick(catalogue(ctx.settings), rule_ids=["F.24.3"]) + rule_registry.parse_rules(json.dumps(given), ctx.settings)
    run = validate(stored_for(ctx, groups, scratch_path(spark, "filings"), ["transactions"]), groups)
    return run.rule_stats.select("rule_id", "error_count", "engine_failure")


@query("S14_incremental_results", f"""SELECT r.rule_id, f.cid, f.period, coalesce(v.n, 0) AS error_count FROM ffilings f CROSS JOIN (SELECT DISTINCT rule_id FROM {R_FOUND} x WHERE rule_id <> 'F.TYPE_PRICE') r
    LEFT JOIN (SELECT rule_id, cid, period, count(*) AS n FROM {R_FOUND} y GROUP BY 1, 2, 3) v ON v.rule_id = r.rule_id AND v.cid = f.cid AND v.period = f.period""")
def _(spark, sf):
    ctx = context(spark, sf)
    rules, path = pick(catalogue(ctx.settings), rule_ids=MATRIX_RULES), scratch_path(spark, "results")
    ctx = stored_for(ctx, rules, scratch_path(spark, "filings"), ["transactions"], headers=True)
    # An earlier state in which one company reported other quantities; then only its filings are validated again.
    earlier = ctx.table("transactions").withColumn("transaction_quantity", F.when(col("cid") == "C3", -1.0).otherwise(col("transaction_quantity")))
    incremental.refresh(FilingContext(spark, {**ctx.tables, "transactions": earlier}, ctx.settings), rules, path)
    incremental.refresh(ctx, rules, path)
    return incremental.current(ctx, path).select("rule_id", "cid", "period", "error_count")


@query("A11_first_writer", f"""SELECT rule_id, cid, period, CASE WHEN count(*) = count(record) THEN min(record) END AS record_id FROM {R_FOUND} v GROUP BY 1, 2, 3""")
def _(spark, sf):
    return reports.rolled_up(_run(spark, sf).violations).select("rule_id", "cid", "period", "record_id")


@query("R3_alerts", f"""SELECT rule_id, count(*) AS error_count FROM {R_FOUND} v GROUP BY 1
    HAVING count(*) > 5000 OR count(*) >= 0.025 * (SELECT count(*) FROM ftx)""")
def _(spark, sf):
    return reports.alerts(_run(spark, sf, stored=["transactions"]).rule_stats).select("rule_id", "error_count")


@query("R4_briefs", f"""SELECT rule_id, count(*) AS error_count, (SELECT count(*) FROM ftx) AS total_count,
    (SELECT coalesce(string_agg(record, ',' ORDER BY record), '') FROM (SELECT record FROM {R_FOUND} s WHERE s.rule_id = v.rule_id ORDER BY record NULLS FIRST LIMIT 5) q) AS sample_ids
    FROM {R_FOUND} v GROUP BY rule_id""")
def _(spark, sf):
    run = _run(spark, sf, stored=["transactions"])
    made = reports.briefs(run.violations, run.rule_stats, catalogue_frame(spark, run.groups))
    return made.select("rule_id", "error_count", "total_count", F.array_join("sample_records.record_id", ",").alias("sample_ids"))


@query("R5_mismatch_evidence", f"""SELECT {ID}, {AGREEMENT}, tx.product_name AS attempted_product, coalesce(a.product, 'NONE (Agreement Missing)') AS authorized_product
    FROM tx LEFT JOIN (SELECT DISTINCT contract_service_agreement_id AS k, product_name AS product FROM ct) a ON a.k = tx.contract_service_agreement
    WHERE NOT EXISTS (SELECT 1 FROM ct WHERE ct.contract_service_agreement_id = tx.contract_service_agreement AND ct.product_name = tx.product_name)""")
def _(spark, sf):
    tx, ct = base(spark, sf, "tx", "ct")
    rows = reports.mismatch_evidence(tx, ct, (AGREEMENT, "contract_service_agreement_id"), "product_name")
    return rows.select(ID, AGREEMENT, col("product_name").alias("attempted_product"), "authorized_product")


@query("R6_key_uniqueness", """SELECT 'orders' AS table_name, 'o_orderkey' AS column_name, count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_distinct,
      count(*) FILTER (WHERE o_orderkey IS NULL) AS n_null, count(*) = count(DISTINCT o_orderkey) AS is_unique FROM orders
    UNION ALL SELECT 'transactions', 'transaction_unique_id', count(*), count(DISTINCT transaction_unique_id), count(*) FILTER (WHERE transaction_unique_id IS NULL),
      count(*) = count(DISTINCT transaction_unique_id) FROM ftx""")
def _(spark, sf):
    ctx = context(spark, sf)
    tx = ctx.table("transactions")
    return profile.key_uniqueness({"orders": (spark.table("orders"), "o_orderkey"), "transactions": (tx, profile.key_column(tx.columns))})


JOINABLE = {"region": ["r_regionkey", "r_name"], "nation": ["n_nationkey", "n_name", "n_regionkey"], "customer": ["c_nationkey", "c_mktsegment"],
            "supplier": ["s_suppkey", "s_nationkey", "s_name"]}
_VALUES = " UNION ALL ".join(f"SELECT DISTINCT '{t}' AS t, '{c}' AS c, {'true' if c.endswith('key') else 'false'} AS num, CAST({c} AS STRING) AS v FROM {t}" for t, cs in JOINABLE.items() for c in cs)


@query("R6_joinable_columns", f"""WITH v AS ({_VALUES}), n AS (SELECT t, c, count(v) AS n FROM v GROUP BY 1, 2),
    b AS (SELECT a.t AS lt, a.c AS lc, z.t AS rt, z.c AS rc, count(*) AS n_both FROM v a JOIN v z ON a.v = z.v AND a.num = z.num AND a.t <> z.t GROUP BY 1, 2, 3, 4)
    SELECT lt AS left_table, lc AS left_column, rt AS right_table, rc AS right_column, l.n AS n_left, r.n AS n_right, round(n_both / CAST(l.n AS DOUBLE), 6) AS containment
    FROM b JOIN n l ON l.t = lt AND l.c = lc JOIN n r ON r.t = rt AND r.c = rc WHERE n_both >= 0.9 * l.n""")
def _(spark, sf):
    register(spark, sf)
    return profile.joinable_columns({t: spark.table(t).select(*cs) for t, cs in JOINABLE.items()})


@query("R7_discover_by_state", """SELECT cid, company_name, state, source_filing FROM (SELECT cid, company_name, state, concat('filing_', period, '.zip') AS source_filing,
      row_number() OVER (PARTITION BY cid ORDER BY period, company_name) AS k FROM fid WHERE state = 'WA' AND company_name IS NOT NULL) v WHERE k = 1""")
def _(spark, sf):
    ident = context(spark, sf).table("ident").filter("company_name IS NOT NULL")
    filed = ident.withColumn("source_filing", F.concat(lit("filing_"), "period", lit(".zip")))
    return archive.discover_entities(filed, "wa")


COVERAGE = ["supplier#00000000", "SUPPLIER#000000001", "Nowhere Power"]


@query("R8_coverage", """WITH names AS (SELECT 'supplier#00000000' AS s UNION ALL SELECT 'SUPPLIER#000000001' UNION ALL SELECT 'Nowhere Power'),
    idx AS (SELECT concat('C', s_nationkey) AS cid, s_name AS legal_name FROM supplier),
    m AS (SELECT s, cid, min(legal_name) AS matched_name FROM names JOIN idx ON contains(lower(legal_name), lower(s)) GROUP BY 1, 2),
    sales AS (SELECT concat(CASE WHEN c_nationkey > 6 THEN 'C' ELSE 'X' END, c_nationkey) AS cid, concat(year(o_orderdate), 'Q', quarter(o_orderdate)) AS period, o_orderstatus FROM orders JOIN customer ON o_custkey = c_custkey),
    t AS (SELECT cid, period, count(*) AS tx_records, count(*) FILTER (WHERE o_orderstatus = 'P') AS ct_records FROM sales GROUP BY 1, 2),
    found AS (SELECT s, matched_name, m.cid, period, tx_records, ct_records FROM m JOIN t ON m.cid = t.cid)
    SELECT s AS search_name, matched_name, cid, period, tx_records, ct_records, 'Found in Lake' AS status FROM found
    UNION ALL SELECT n.s, k.matched_name, k.cid, NULL, NULL, NULL, CASE WHEN k.cid IS NULL THEN 'Not in Index' ELSE 'Found in Index, not in Lake' END
    FROM names n LEFT JOIN (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY s ORDER BY cid) = 1) k ON k.s = n.s WHERE n.s NOT IN (SELECT s FROM found)""")
def _(spark, sf):
    register(spark, sf)
    index = spark.table("supplier").select(F.concat(lit("C"), "s_nationkey").alias("cid"), col("s_name").alias("legal_name"))
    sales = spark.table("orders").join(spark.table("customer"), col("o_custkey") == col("c_custkey")).select(
        F.concat(F.when(col("c_nationkey") > 6, "C").otherwise("X"), "c_nationkey").alias("cid"), periods.period_of(col("o_orderdate").cast("date")).alias("period"), "o_orderstatus")
    return coverage.company_coverage(COVERAGE, index, sales, sales.filter("o_orderstatus = 'P'"))


@query("R9_mutations", """WITH n AS (SELECT count(*) AS total, count(*) FILTER (WHERE transaction_quantity <= 0) AS low,
      count(*) FILTER (WHERE coalesce(trim(point_of_delivery_specific_location), '') = '') AS nowhere, count(*) FILTER (WHERE price IS NULL) AS unpriced FROM ftx)
    SELECT c.case_id, r.rule_id, CASE WHEN c.case_id = r.rule_id THEN total WHEN r.rule_id = 'F.25.21.2' THEN low WHEN r.rule_id = 'F.30.48' THEN nowhere ELSE unpriced END AS error_count
    FROM n CROSS JOIN (SELECT 'GOLDEN' AS case_id UNION ALL SELECT 'F.25.21.2' UNION ALL SELECT 'F.30.48' UNION ALL SELECT 'F.TYPE_PRICE') c
    CROSS JOIN (SELECT 'F.25.21.2' AS rule_id UNION ALL SELECT 'F.30.48' UNION ALL SELECT 'F.TYPE_PRICE') r""")
def _(spark, sf):
    ctx = context(spark, sf)
    cases = [Mutation("F.25.21.2", "transactions", {"transaction_quantity": "-1"}),
             Mutation("F.30.48", "transactions", {"point_of_delivery_specific_location": None}),
             Mutation("F.TYPE_PRICE", "transactions", {"price": "12 dollars"})]
    rules = pick(catalogue(ctx.settings), rule_ids=[c.case_id for c in cases])
    return mutation_results(ctx, cases, rules)


@query("R10_rules_by_stage", f"""SELECT CASE WHEN rule_id = 'F.25.21.2' THEN 'Type 5' WHEN rule_id = 'F.TYPE_PRICE' THEN 'Type 1' ELSE 'Type 2' END AS stage, count(DISTINCT rule_id) AS rules, count(*) AS error_count
    FROM {R_FOUND} v GROUP BY 1""")
def _(spark, sf):
    run = _run(spark, sf)
    joined = run.rule_stats.join(catalogue_frame(spark, run.groups).select("rule_id", "stage"), "rule_id")
    return joined.groupBy("stage").agg(F.count(lit(1)).alias("rules"), F.sum("error_count").alias("error_count"))


@query("R11_audit_report", f"""WITH c AS (SELECT rule_id, count(*) AS n FROM {R_FOUND} v GROUP BY 1)
    SELECT '# Audit' AS line UNION ALL SELECT concat(sum(n), ' violations detected by ', count(*), ' rules.') FROM c
    UNION ALL SELECT concat('| ', rule_id, ' | ', CASE WHEN rule_id = 'F.25.21.2' THEN 'Warning' ELSE 'Error' END, ' | ', format('{{:,}}', n), ' | ',
      CASE rule_id WHEN 'F.24.3' THEN 'end date is not after begin date' WHEN 'F.25.21.2' THEN 'quantity is zero or negative'
      WHEN 'F.30.48' THEN 'point_of_delivery_specific_location is missing' ELSE 'price is missing' END, ' |') FROM c""")
def _(spark, sf):
    run = _run(spark, sf)
    lines = reports.report_lines(run.rule_stats, catalogue_frame(spark, run.groups), "Audit")
    return lines.orderBy("line_no").select("line")


@query("R12_violation_records", """SELECT sha2 AS violation_id, rule_id, cid, period, record_type, record_id, message, severity, detected_at FROM (
    SELECT sha256(concat('F.TYPE_PRICE|transaction|', cid, '|', period, coalesce('|' || transaction_unique_id, ''), '|', source_filename, '#', source_row_index)) AS sha2,
      'F.TYPE_PRICE' AS rule_id, cid, period, 'transaction' AS record_type, transaction_unique_id AS record_id, 'price is missing' AS message,
      'Error' AS severity, '2014-08-15' AS detected_at FROM ftx WHERE price IS NULL) v""")
def _(spark, sf):
    return _run(spark, sf, ["F.TYPE_PRICE"]).violations


# --- other readings of a rule -----------------------------------------------------------------


@query("V_F_24_3_same_day", "SELECT cid, period, count(*) AS n FROM ftx WHERE transaction_end_date < transaction_begin_date GROUP BY 1, 2")
def _(spark, sf):
    found = context(spark, sf).table("transactions").filter(ends_too_early(same_day_allowed=True))
    return found.groupBy("cid", "period").agg(F.count(lit(1)).alias("n"))


@query("V_F_24_6_simple", "SELECT cid, period, count(*) AS n FROM ftx WHERE abs(price * transaction_quantity - total_transaction_charge) > 1 GROUP BY 1, 2")
def _(spark, sf):
    found = context(spark, sf).table("transactions").filter(charge_is_off_simple())
    return found.groupBy("cid", "period").agg(F.count(lit(1)).alias("n"))


def _per_filing(found):
    return found.groupBy("cid", "period").agg(F.count(lit(1)).alias("n"))


SAME_DEAL = "c.customer_company_name = t.customer_company_name AND c.product_name = t.product_name"


@query("V_F_25_18_linked_terms", """SELECT t.cid, t.period, count(*) AS n FROM ftx t
    WHERE EXISTS (SELECT 1 FROM fct c WHERE c.contract_unique_id = t.contract_unique_id AND c.product_name <> t.product_name) GROUP BY 1, 2""")
def _(spark, sf):
    ctx = context(spark, sf)
    terms = ctx.table("contracts").select(col("contract_unique_id").alias("linked"), col("product_name").alias("agreed")).distinct()
    on = F.expr("contract_unique_id = linked AND product_name <> agreed")
    return _per_filing(ctx.table("transactions").join(terms, on, "left_semi"))


@query("V_F_25_18_customer", f"SELECT t.cid, t.period, count(*) AS n FROM ftx t WHERE NOT EXISTS (SELECT 1 FROM fct c WHERE {SAME_DEAL}) GROUP BY 1, 2")
def _(spark, sf):
    ctx = context(spark, sf)
    return _per_filing(joins.without_partner(ctx.table("transactions"), ctx.table("contracts"), ["customer_company_name", "product_name"]))


@query("V_F_25_18_known_customer", f"""SELECT t.cid, t.period, count(*) AS n FROM ftx t WHERE NOT EXISTS (SELECT 1 FROM fct c WHERE {SAME_DEAL})
    AND EXISTS (SELECT 1 FROM fct c WHERE c.customer_company_name = t.customer_company_name) GROUP BY 1, 2""")
def _(spark, sf):
    ctx = context(spark, sf)
    return _per_filing(joins.known_group_unknown_member(ctx.table("transactions"), ctx.table("contracts"), ["customer_company_name"], ["product_name"]))
