"""Filing-shaped views over the driver tables. The text runs unchanged in Spark and in DuckDB.

``BASE`` holds the four small-schema views used by the operator queries. ``FULL`` holds views
with every column of the canonical schemas, used by the rule queries. Dates move forward by a
number of years that depends on the nation, so that all period gates of the rules are crossed.
Nulls, blanks and bad values are made with CASE, because the tables hold none.
"""

from __future__ import annotations

BASE = {
    "tx": """
  SELECT concat(l_orderkey,'-',l_linenumber) AS transaction_unique_id,
         o_custkey AS contract_service_agreement, l_suppkey AS seller_id,
         c_name AS customer_company_name, p_brand AS product_name, p_type AS class_name,
         CASE WHEN o_orderpriority='1-URGENT' THEN '$/MW'
              WHEN o_orderpriority='2-HIGH' THEN '$/KW'
              WHEN o_orderpriority='3-MEDIUM' THEN NULL ELSE '$/MWH' END AS rate_units,
         l_quantity AS transaction_quantity, p_retailprice AS price,
         l_extendedprice AS total_transaction_charge, l_tax AS total_transmission_charge,
         CAST(o_orderdate AS DATE) AS transaction_begin_date,
         CAST(l_shipdate AS DATE) AS transaction_end_date,
         CASE WHEN o_orderstatus='P' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS trade_date,
         c_nationkey AS cid
  FROM lineitem JOIN orders ON l_orderkey=o_orderkey
       JOIN part ON l_partkey=p_partkey JOIN customer ON o_custkey=c_custkey""",
    "ct": """
  SELECT contract_service_agreement AS contract_service_agreement_id, product_name,
         min(transaction_begin_date) AS commencement_date,
         max(transaction_end_date) AS termination_date
  FROM tx WHERE transaction_begin_date < DATE '1996-01-01' GROUP BY 1,2""",
    "ident": """
  SELECT s_suppkey AS seller_id,
         concat(CASE WHEN s_suppkey % 3 = 0 THEN 'FA' ELSE 'FS' END, s_suppkey) AS filer_unique_id,
         s_name AS company_name, s_nationkey AS cid FROM supplier""",
    "reg": """
  SELECT cid, legal_name, effective_start,
         lead(effective_start) OVER (PARTITION BY cid ORDER BY effective_start) AS effective_end
  FROM (SELECT o_custkey AS cid, min(o_orderpriority) AS legal_name,
               CAST(o_orderdate AS DATE) AS effective_start
        FROM orders GROUP BY o_custkey, CAST(o_orderdate AS DATE)) v""",
}


def _shift(nation: str) -> str:
    return f"CASE {nation} % 3 WHEN 0 THEN 6 WHEN 1 THEN 12 ELSE 14 END"


def _moved(day: str, nation: str) -> str:
    return f"make_date(year({day}) + {_shift(nation)}, month({day}), least(day({day}), 28))"


def _quarter(day: str) -> str:
    return f"concat(year({day}), 'Q', quarter({day}))"


def _supplier_name(key: str) -> str:
    return f"concat('Supplier#', lpad(CAST({key} AS STRING), 9, '0'))"


_PRODUCT = """CASE p_type WHEN 'STANDARD' THEN 'ENERGY' WHEN 'MEDIUM' THEN 'Energy' WHEN 'ECONOMY' THEN 'Capacity'
                   WHEN 'PROMO' THEN 'BOOKED OUT POWER' WHEN 'SMALL' THEN 'Exchange'
                   ELSE CASE WHEN p_size < 10 THEN NULL ELSE 'Ancillary Services' END END"""

FULL = {
    "fsales": f"""
  SELECT concat('C', c_nationkey) AS cid, {_moved("CAST(o_orderdate AS DATE)", "c_nationkey")} AS begin_day,
         {_moved("CAST(l_shipdate AS DATE)", "c_nationkey")} AS end_day, {_PRODUCT} AS product, c_nationkey, c_name,
         c_mktsegment, o_custkey, o_orderkey, o_orderstatus, o_orderpriority, o_totalprice, l_linenumber, l_suppkey,
         l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, p_type, p_size, p_brand, p_retailprice
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
       JOIN customer ON o_custkey = c_custkey""",
    "ftx": f"""
  SELECT cid, {_quarter("begin_day")} AS period,
         CASE WHEN l_linenumber = 6 AND o_orderstatus = 'P' THEN 'Replace'
              WHEN l_linenumber = 5 AND o_orderstatus = 'O' THEN NULL ELSE 'New' END AS filing_type,
         CASE WHEN l_quantity = 1 AND l_linenumber = 1 THEN NULL WHEN l_quantity = 1 AND l_linenumber = 2 THEN ' '
              ELSE concat(o_orderkey, '-', l_linenumber) END AS transaction_unique_id,
         CASE WHEN l_quantity = 2 THEN NULL ELSE concat('K', o_custkey) END AS contract_unique_id,
         CASE WHEN l_quantity = 3 THEN NULL ELSE concat('A', o_custkey) END AS contract_service_agreement,
         cid AS seller_cid, CASE WHEN l_discount = 0.1 THEN c_name ELSE {_supplier_name("l_suppkey")} END AS seller_company_name,
         CASE WHEN l_quantity = 4 THEN NULL ELSE c_name END AS customer_company_name,
         product AS product_name,
         CASE o_orderpriority WHEN '1-URGENT' THEN '$/MW' WHEN '4-NOT SPECIFIED' THEN '$/MWh' WHEN '5-LOW' THEN '$/MWH'
              WHEN '2-HIGH' THEN CASE l_linenumber % 3 WHEN 0 THEN '$/KWH' WHEN 1 THEN 'cents/KWH' ELSE '$/KW' END
              ELSE CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN '' ELSE '$/MW-month' END END AS rate_units,
         CASE WHEN p_type = 'LARGE' AND p_size > 40 THEN NULL ELSE p_type END AS class_name,
         CASE WHEN l_returnflag = 'R' AND l_quantity > 45 THEN NULL WHEN l_returnflag = 'A' THEN 'LT' ELSE 'ST' END AS term_name,
         CASE WHEN l_tax = 0.0 THEN '' WHEN l_tax > 0.06 THEN 'Q' ELSE 'H' END AS increment_name,
         CASE WHEN l_tax = 0.01 THEN NULL WHEN l_tax = 0.02 THEN 'XX' ELSE 'P' END AS increment_peaking_name,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'ES' WHEN 'MACHINERY' THEN 'PS' WHEN 'FURNITURE' THEN NULL ELSE 'ZZ' END AS time_zone,
         CASE l_linenumber WHEN 1 THEN 'HUB' WHEN 2 THEN 'Hub' WHEN 3 THEN NULL WHEN 4 THEN 'PJM' ELSE p_brand END AS point_of_delivery_balancing_authority,
         CASE WHEN l_quantity < 10 THEN NULL WHEN l_quantity < 20 THEN 'Palo Verde' ELSE 'Elsewhere' END AS point_of_delivery_specific_location,
         CASE WHEN l_quantity < 15 THEN 'MID-C' WHEN l_quantity > 48 THEN 'Nohub' END AS point_of_delivery_hub,
         CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE 'Tariff 1' END AS ferc_tariff_reference,
         CASE WHEN o_orderstatus = 'F' THEN NULL ELSE 'Fixed' END AS type_of_rate, 'filing.csv' AS source_filename,
         CASE WHEN l_discount >= 0.05 THEN p_retailprice * l_quantity + l_tax WHEN l_discount = 0.01 THEN 0.0
              ELSE l_extendedprice END AS total_transaction_charge,
         CASE WHEN l_discount = 0.09 THEN NULL ELSE l_tax END AS total_transmission_charge,
         CASE WHEN l_quantity = 5 THEN 0.0 WHEN l_quantity = 6 THEN NULL WHEN l_quantity = 7 THEN -7.0 ELSE l_quantity END AS transaction_quantity,
         CASE WHEN l_quantity = 8 THEN NULL WHEN o_orderpriority = '5-LOW' THEN p_retailprice * 1.1
              WHEN o_orderpriority = '2-HIGH' THEN p_retailprice / 950.0 * (CASE WHEN l_tax > 0.04 THEN 1 ELSE -100 END)
              ELSE p_retailprice END AS price,
         CASE WHEN l_tax < 0.03 THEN NULL WHEN l_tax < 0.06 THEN p_retailprice ELSE p_retailprice * 2 END AS standardized_price,
         CASE WHEN l_discount < 0.03 THEN NULL WHEN l_discount < 0.06 THEN l_quantity ELSE l_quantity / 2 END AS standardized_quantity,
         CASE WHEN l_quantity = 9 THEN NULL ELSE begin_day END AS transaction_begin_date,
         CASE WHEN l_quantity = 10 THEN NULL ELSE end_day END AS transaction_end_date,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE begin_day END AS trade_date,
         CAST(o_orderkey AS BIGINT) * 10 + l_linenumber AS source_row_index
  FROM (SELECT * FROM fsales UNION ALL SELECT * FROM fsales WHERE l_quantity = 50) twice""",
    "fct": f"""
  SELECT cid, period, CASE WHEN q < 4 THEN 'Replace' WHEN q < 8 THEN 'Delete' WHEN q = 9 THEN NULL ELSE 'New' END AS filing_type,
         CASE WHEN o_custkey % 50 = 0 THEN NULL ELSE concat('K', o_custkey) END AS contract_unique_id,
         CASE WHEN supp % 10 = 0 THEN 'C99' ELSE cid END AS seller_cid,
         CASE WHEN q = 10 THEN NULL ELSE {_supplier_name("supp")} END AS seller_company_name,
         CASE WHEN q = 11 THEN NULL WHEN q = 12 THEN concat(c_name, repeat('x', 60)) ELSE c_name END AS customer_company_name,
         CASE WHEN q > 40 THEN NULL WHEN q > 30 THEN 'C77' ELSE cid END AS customer_cid,
         CASE WHEN status = 'P' THEN 'MAYBE' WHEN status = 'O' THEN NULL ELSE 'Y' END AS contract_affiliate,
         CASE o_custkey % 6 WHEN 0 THEN 'NPU' WHEN 1 THEN CASE WHEN q > 20 THEN NULL ELSE 'NPU' END
              ELSE concat('Tariff ', o_custkey % 6) END AS ferc_tariff_reference,
         CASE WHEN q = 13 THEN '' ELSE concat('A', o_custkey) END AS contract_service_agreement_id,
         CASE WHEN q = 14 THEN NULL ELSE 'Evergreen' END AS extension_provision_description,
         CASE WHEN q = 15 THEN NULL ELSE kind END AS class_name, CASE WHEN q < 20 THEN 'LT' WHEN q < 22 THEN '' ELSE 'XT' END AS term_name,
         CASE WHEN q < 30 THEN 'H' ELSE 'Q' END AS increment_name, CASE WHEN q < 33 THEN 'P' ELSE NULL END AS increment_peaking_name,
         CASE WHEN q < 25 THEN 'MB' WHEN q < 35 THEN 'CR' WHEN q < 37 THEN NULL ELSE 'ZZ' END AS product_type_name,
         CASE WHEN q = 33 THEN 'Point-To-Point Agreement' ELSE product END AS product_name,
         CASE WHEN q < 10 THEN NULL WHEN q < 20 THEN 'MWH' ELSE 'LBS' END AS units,
         CASE WHEN q = 17 OR q = 18 THEN 'formula' END AS rate_description,
         CASE WHEN q % 5 = 0 THEN '$/MW' WHEN q % 5 = 1 THEN '$/kWh' WHEN q % 5 = 2 THEN NULL WHEN q % 5 = 3 THEN '$/lb' ELSE '$/MWH' END AS rate_units,
         CASE WHEN q % 4 = 0 THEN 'HUB' WHEN q % 4 = 1 THEN 'PJM' WHEN q % 4 = 2 THEN 'Nowhere' END AS porba,
         CASE WHEN q < 20 THEN 'Palo Verde' WHEN q < 28 THEN NULL ELSE 'Elsewhere' END AS porsl,
         CASE WHEN q < 12 THEN 'MID-C' WHEN q > 30 THEN 'Nohub' END AS porsl_hub,
         CASE WHEN q % 3 = 0 THEN 'Hub' WHEN q % 3 = 1 THEN 'Nowhere' END AS podba,
         CASE WHEN q < 25 THEN 'Elsewhere' WHEN q < 32 THEN NULL ELSE 'MID-C' END AS podsl,
         CASE WHEN q > 20 THEN 'PALO VERDE' END AS podsl_hub, 'contracts.csv' AS source_filename,
         CASE WHEN q = 16 THEN NULL WHEN q = 17 THEN DATE '1899-12-31' ELSE first_day END AS contract_execution_date,
         CASE WHEN q = 18 THEN NULL WHEN q = 19 THEN DATE '1900-01-01' ELSE first_day END AS commencement_date,
         CASE WHEN q = 20 THEN NULL WHEN q = 21 THEN DATE '1850-06-30' ELSE last_day END AS termination_date,
         CASE WHEN q < 22 THEN NULL WHEN q = 22 THEN DATE '1900-01-01' ELSE last_day END AS actual_termination_date,
         CASE WHEN q = 23 THEN NULL WHEN q = 24 THEN DATE '1900-01-01' WHEN q = 25 THEN DATE '1900-01-02' ELSE first_day END AS begin_date,
         CASE WHEN q = 26 THEN NULL WHEN q = 27 THEN DATE '1899-01-01' ELSE last_day END AS end_date,
         CASE WHEN q < 12 THEN 10.5 END AS rate, CASE WHEN q = 13 THEN 1.0 END AS rate_minimum, CASE WHEN q = 14 THEN 2.0 END AS rate_maximum,
         CAST(o_custkey AS BIGINT) * 1000 + CAST(q AS BIGINT) AS source_row_index
  FROM (SELECT cid, {_quarter("begin_day")} AS period, o_custkey, c_name, CASE WHEN l_returnflag = 'R' THEN 'Old ' || product ELSE product END AS product, min(l_quantity) AS q, min(l_suppkey) AS supp,
               min(o_orderstatus) AS status, min(p_type) AS kind, min(begin_day) AS first_day, max(end_day) AS last_day
        FROM fsales GROUP BY 1, 2, 3, 4, 5) g""",
    "fseller": f"""
  SELECT s_nationkey, s_suppkey, s_name, s_acctbal, {_moved("CAST(o_orderdate AS DATE)", "s_nationkey")} AS begin_day
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey""",
    "fid": f"""
  SELECT concat('C', s_nationkey) AS cid, period,
         CASE substring(period, 6, 1) WHEN '2' THEN 'Replace' WHEN '3' THEN 'Delete' ELSE 'New' END AS filing_type,
         CASE s_suppkey % 5 WHEN 0 THEN 'FA1' WHEN 1 THEN 'FS1' WHEN 2 THEN NULL WHEN 3 THEN concat('FS', s_suppkey)
              ELSE concat('FA', s_suppkey) END AS filer_unique_id,
         CASE WHEN s_suppkey % 11 = 10 THEN NULL WHEN s_suppkey % 4 = 0 THEN 'Joint Seller' ELSE s_name END AS company_name,
         CASE WHEN s_acctbal < 0 THEN NULL ELSE concat('C', s_nationkey) END AS company_identifier,
         CASE WHEN s_suppkey % 13 = 5 THEN NULL ELSE concat('Person ', s_suppkey % 9) END AS contact_name,
         CASE WHEN s_suppkey % 6 = 1 THEN NULL ELSE 'Manager' END AS contact_title,
         CASE WHEN s_suppkey % 8 = 3 THEN '' ELSE 'Main Street 1' END AS address, 'Springfield' AS city,
         CASE WHEN s_suppkey % 3 = 1 THEN 'Wash' ELSE 'WA' END AS state,
         CASE s_suppkey % 10 WHEN 0 THEN NULL WHEN 1 THEN '98101' WHEN 2 THEN '98101-1234' WHEN 3 THEN '9810' WHEN 4 THEN 'SW1A 1AA'
              WHEN 5 THEN 'K1A 0B1' WHEN 6 THEN 'K1A-0B1' WHEN 7 THEN '0123456' WHEN 8 THEN '44100' ELSE '  ' END AS zip,
         CASE s_suppkey % 4 WHEN 0 THEN 'US' WHEN 1 THEN 'MX' WHEN 2 THEN 'GB' ELSE 'CA' END AS country,
         CASE WHEN s_suppkey % 9 = 2 THEN NULL ELSE '555-0100' END AS phone,
         CASE s_suppkey % 5 WHEN 1 THEN 'not an address' WHEN 2 THEN NULL ELSE concat('person', s_suppkey, '@example.com') END AS email,
         CASE s_suppkey % 4 WHEN 0 THEN 'Y' WHEN 1 THEN 'yes' WHEN 2 THEN 'N' END AS report_to_index,
         CASE s_suppkey % 4 WHEN 0 THEN 'Seller' WHEN 1 THEN 'Agent' WHEN 2 THEN 'Customer' ELSE 'Seller' END AS role,
         concat('Person ', s_nationkey % 9) AS submitter_name, 'ident.csv' AS source_filename, s_suppkey AS source_row_index
  FROM (SELECT DISTINCT s_nationkey, s_suppkey, s_name, s_acctbal, {_quarter("begin_day")} AS period FROM fseller
        UNION ALL SELECT DISTINCT s_nationkey, s_suppkey, s_name, s_acctbal, {_quarter("begin_day")} AS period
        FROM fseller WHERE s_acctbal > 8000) v""",
    "fix": f"""
  SELECT DISTINCT concat(CASE WHEN o_totalprice > 300000 THEN 'C' ELSE 'X' END, c_nationkey) AS cid, {_quarter(_moved("CAST(o_orderdate AS DATE)", "c_nationkey"))} AS period,
         CASE WHEN o_orderstatus = 'P' THEN 'Append' WHEN o_orderstatus = 'O' THEN NULL ELSE 'New' END AS filing_type,
         CASE WHEN o_custkey % 4 = 3 THEN 'FS1' ELSE concat('FS', o_custkey % 10) END AS filer_unique_id,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'Platts' ELSE 'Argus' END AS publisher, c_mktsegment AS publication,
         CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 500 THEN ' ' ELSE 'All' END AS transactions_reported
  FROM orders JOIN customer ON o_custkey = c_custkey""",
    "freg": """
  SELECT concat(CASE WHEN yr % 3 = 1 THEN 'X' ELSE 'C' END, s_nationkey) AS cid,
         CASE WHEN yr % 2 = 0 THEN min(s_name) ELSE max(s_name) END AS legal_name,
         CASE WHEN s_nationkey % 4 = 3 THEN 'Other' WHEN yr % 4 = 0 THEN 'Agent' WHEN s_nationkey % 2 = 0 THEN 'Account Manager' ELSE 'Other' END AS role,
         make_date(yr, 1, 1) AS effective_start,
         CASE WHEN yr % 5 = 0 THEN NULL WHEN yr % 5 = 1 THEN make_date(yr, 7, 1) ELSE make_date(yr + 1, 1, 1) END AS effective_end,
         s_nationkey % 2 = 0 AS is_npu
  FROM (SELECT s_nationkey, s_name, year(begin_day) AS yr FROM fseller) v
  GROUP BY s_nationkey, yr""",
    "fcontacts": """
  SELECT DISTINCT concat(CASE WHEN c_nationkey > 4 THEN 'C' ELSE 'X' END, c_nationkey) AS cid, concat('Person ', c_custkey % 7) AS contact_name,
         CASE WHEN c_acctbal < 0 THEN 'Agent' ELSE 'Seller' END AS role FROM customer""",
    "ftariffs": """
  SELECT DISTINCT concat(CASE WHEN c_nationkey > 2 THEN 'C' ELSE 'X' END, c_nationkey) AS cid, concat('Tariff ', c_custkey % 4) AS ferc_tariff_reference,
         CASE c_custkey % 4 WHEN 0 THEN DATE '2005-01-01' WHEN 1 THEN DATE '2009-01-01' WHEN 2 THEN DATE '2012-01-01' END AS tariff_end
  FROM customer""",
    "ffilings": f"""
  SELECT cid, period, max(filing_type) AS filing_type, max(submitter_name) AS submitter_name,
         make_date(CAST(substring(period, 1, 4) AS INT), CAST(substring(period, 6, 1) AS INT) * 3 - 2, 1) AS period_start,
         last_day(make_date(CAST(substring(period, 1, 4) AS INT), CAST(substring(period, 6, 1) AS INT) * 3, 1)) AS period_end
  FROM (SELECT cid, period, filing_type, submitter_name FROM fid
        UNION ALL SELECT DISTINCT cid, period, NULL, NULL FROM fct
        UNION ALL SELECT DISTINCT cid, period, NULL, NULL FROM ftx
        UNION ALL SELECT DISTINCT cid, period, NULL, NULL FROM fix) u
  GROUP BY cid, period""",
}

# Table of the canonical schema -> view.
FILING_TABLES = {"transactions": "ftx", "contracts": "fct", "ident": "fid", "index": "fix", "registry": "freg",
                 "contacts": "fcontacts", "tariffs": "ftariffs"}

# Reference lists that go with the views.
LOOKUPS = {
    "class": ["STANDARD", "ECONOMY", "PROMO", "SMALL"],
    "term": ["LT", "ST"],
    "increment": ["H", "D"],
    "peaking": ["P", "OP"],
    "product_type": ["MB", "CR"],
    "product": ["ENERGY", "CAPACITY", "BOOKED OUT POWER", "EXCHANGE"],
    "unit": ["MWH", "MW"],
    "rate_unit": ["$/MWH", "$/KWH", "$/MW", "$/KW", "$/MW-MONTH", "CENTS/KWH"],
    "authority": ["HUB", "PJM", "BRAND#1", "BRAND#2"],
    "tariff": ["NPU", "TARIFF 2", "TARIFF 3"],
    "time_zone": ["ES", "PS"],
    "hub": ["PALO VERDE", "MID-C"],
    "iso": ["CUSTOMER#000000001", "CUSTOMER#000000002", "CUSTOMER#000000003", "CUSTOMER#000000005",
            "CUSTOMER#000000007", "CUSTOMER#000000011", "CUSTOMER#000000013"],
}
RUN_DATE = "2014-08-15"
# Contracts and contract products per filing, and products per contract, that the size rule allows here.
SIZE_LIMITS = (40, 80, 6)


def with_clause(views: dict[str, str], upto: list[str] | None = None) -> str:
    """``WITH`` prefix of the named views (all when none are named) and what they are built on."""
    names = list(views) if upto is None else needed(views, upto)
    return "WITH " + ",\n".join(f"{n} AS ({views[n]})" for n in names)


def needed(views: dict[str, str], wanted: list[str]) -> list[str]:
    """The wanted views and those they read, in definition order."""
    found: set[str] = set()
    todo = list(wanted)
    while todo:
        name = todo.pop()
        if name in found:
            continue
        found.add(name)
        words = set(views[name].replace("(", " ").replace(")", " ").split())
        todo += [v for v in views if v in words and v != name]
    return [v for v in views if v in found]
