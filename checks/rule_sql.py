"""Every rule written once more, as plain SQL over the views, for DuckDB.

Written from the rule text and not from the Spark tests. ``ROWS`` holds conditions on one row of a
view; ``SELECTS`` holds whole queries that give (cid, period, record).
"""

from __future__ import annotations

from checks.views import FULL, LOOKUPS, RUN_DATE, SIZE_LIMITS, with_clause

RECORD = {"ftx": "transaction_unique_id", "fct": "contract_unique_id", "fid": "filer_unique_id", "fix": "publisher",
          "ffilings": "cid"}


def _in(name: str, lookup: str) -> str:
    values = ", ".join(f"'{v}'" for v in LOOKUPS[lookup])
    return f"upper(trim({name})) IN ({values})"


def _blank(name: str) -> str:
    return f"coalesce(trim({name}), '') = ''"


def _strange(name: str, lookup: str) -> str:
    return f"NOT ({_in(name, lookup)})"


def _blank_or_strange(name: str, lookup: str) -> str:
    return f"CASE WHEN {_blank(name)} THEN true ELSE {_strange(name, lookup)} END"


FS, FA = "filer_unique_id LIKE 'FS%'", "filer_unique_id LIKE 'FA%'"
METERED = "upper(product_name) IN ('ENERGY', 'CAPACITY', 'BOOKED OUT POWER')"
START = "make_date(CAST(substring(period, 1, 4) AS INT), 3 * CAST(substring(period, 6) AS INT) - 2, 1)"
END = "last_day(make_date(CAST(substring(period, 1, 4) AS INT), 3 * CAST(substring(period, 6) AS INT), 1))"
YES = "coalesce(upper(report_to_index) IN ('Y', 'YES'), false)"
POWER, ENERGY = "upper(rate_units) IN ('$/MW', '$/KW')", "upper(rate_units) IN ('$/MWH', '$/KWH')"
ENERGY_OR_BOOKED = "upper(product_name) IN ('ENERGY', 'BOOKED OUT POWER')"
PODBA, PODSL = "point_of_delivery_balancing_authority", "point_of_delivery_specific_location"
STANDARD = """(upper(product_name) = 'ENERGY' AND coalesce(upper(rate_units), '') <> '$/MWH'
  OR upper(product_name) = 'CAPACITY' AND coalesce(upper(rate_units), '') <> '$/MW-MONTH'
  OR upper(product_name) = 'BOOKED OUT POWER' AND coalesce(upper(rate_units), '') NOT IN ('$/MWH', '$/MW-MONTH'))"""
CHARGE = """abs({e} - total_transaction_charge) > greatest(1.0, 0.01 * abs({e}))"""
REPORTED = """(price * transaction_quantity * (CASE WHEN upper(rate_units) = 'CENTS/KWH' THEN 0.01 ELSE 1.0 END)
  + coalesce(total_transmission_charge, 0.0))"""
STANDARDIZED = "(standardized_price * standardized_quantity + coalesce(total_transmission_charge, 0.0))"
EMAIL = r"regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$')"


def _hub(authority: str, location: str) -> str:
    return f"upper({authority}) = 'HUB' AND {location} IS NOT NULL AND {_strange(location, 'hub')}"


def _no_hub(authority: str, location: str) -> str:
    return f"(upper({authority}) = 'HUB' AND ({location} IS NULL OR {_strange(location, 'hub')}))"


# template -> {(rule, view): condition}
ROWS = {
    "T1": {
        ("F.16.13", "fid"): "filer_unique_id IS NULL OR company_name IS NULL OR contact_name IS NULL OR email IS NULL",
        ("F.16.15", "fid"): f"{FS} AND (contact_name IS NULL OR contact_title IS NULL OR address IS NULL OR city IS NULL OR phone IS NULL OR email IS NULL)",
        ("F.16.23.2", "fid"): f"({FS} OR {FA}) AND {_blank('company_identifier')}",
        ("F.19.1.1", "fid"): _blank("zip"),
        ("F.19.1.7", "fid"): _blank("address"),
        ("F.20.1.1", "fid"): f"role = 'Seller' AND {_blank('filer_unique_id')}",
        ("F.16.28", "fix"): _blank("transactions_reported"),
        ("F.16.11", "fct"): "contract_unique_id IS NULL OR seller_company_name IS NULL OR customer_company_name IS NULL OR product_name IS NULL",
        ("F.20.2.2", "fct"): "period >= '2004Q1' AND contract_execution_date IS NULL",
        ("F.20.4.2", "fct"): "commencement_date IS NULL",
        ("F.20.22", "fct"): _blank("ferc_tariff_reference"),
        ("F.21.3.2", "fct"): _blank("customer_company_name"),
        ("F.21.6", "fct"): _blank("ferc_tariff_reference"),
        ("F.21.7", "fct"): _blank("contract_service_agreement_id"),
        ("F.21.12", "fct"): _blank("extension_provision_description"),
        ("F.22.2.2", "fct"): "begin_date IS NULL",
        ("F.22.4.2", "fct"): "end_date IS NULL",
        ("F.23.24", "fct"): "rate IS NULL AND rate_minimum IS NULL AND rate_maximum IS NULL AND rate_description IS NULL",
        ("tx_complete", "ftx"): "transaction_unique_id IS NULL OR product_name IS NULL OR transaction_quantity IS NULL OR price IS NULL",
        ("F.24.1", "ftx"): _blank("transaction_unique_id"),
        ("F.25.1", "ftx"): _blank("transaction_unique_id"),
        ("F.25.19", "ftx"): "period >= '2013Q3' AND trade_date IS NULL",
        ("F.25.20", "ftx"): f"period >= '2013Q3' AND {METERED} AND standardized_price IS NULL",
        ("F.25.21", "ftx"): "period >= '2013Q3' AND type_of_rate IS NULL",
        ("F.25.24", "ftx"): f"period >= '2013Q3' AND {METERED} AND standardized_quantity IS NULL",
        ("F.30.48", "ftx"): _blank(PODSL),
        ("F.TYPE_PRICE", "ftx"): "price IS NULL",
    },
    "T2": {
        (rule, "fct"): f"{name} <= DATE '1900-01-01'"
        for rule, name in {
            "F.20.3": "contract_execution_date", "F.20.5": "commencement_date", "F.20.7": "termination_date",
            "F.20.9": "actual_termination_date", "F.22.3": "begin_date", "F.22.5": "end_date",
        }.items()
    },
    "T3": {
        ("F.21.5", "fct"): "contract_affiliate NOT IN ('Y', 'N')",
        ("F.23.3", "fct"): _strange("units", "unit"),
        ("F.23.5", "fct"): _strange("rate_units", "rate_unit"),
        ("F.23.7", "fct"): _strange("porba", "authority"),
        ("F.23.9", "fct"): _strange("podba", "authority"),
        ("F.23.8", "fct"): _hub("porba", "porsl"),
        ("F.23.10", "fct"): _hub("podba", "podsl"),
        ("F.30.41.2", "fct"): _strange("ferc_tariff_reference", "tariff"),
        ("F.25.3", "ftx"): f"upper({PODBA}) = 'HUB' AND ({PODSL} IS NULL OR {_strange(PODSL, 'hub')})",
        ("F.25.13.2", "ftx"): f"product_name = 'BOOKED OUT POWER' AND {_in('customer_company_name', 'iso')} AND transaction_begin_date >= DATE '2006-10-01'",
    },
    "T1+T3": {
        (rule, view): _blank_or_strange(name, lookup)
        for rule, view, name, lookup in [
            ("F.23.1.1", "fct", "class_name", "class"), ("F.23.1.2", "fct", "term_name", "term"),
            ("F.23.1.3", "fct", "increment_name", "increment"), ("F.23.1.4", "fct", "increment_peaking_name", "peaking"),
            ("F.23.1.5", "fct", "product_type_name", "product_type"), ("F.23.1.6", "fct", "product_name", "product"),
            ("F.25.2.1", "ftx", "class_name", "class"), ("F.25.2.2", "ftx", "term_name", "term"),
            ("F.25.2.3", "ftx", "increment_name", "increment"), ("F.25.2.4", "ftx", "increment_peaking_name", "peaking"),
            ("F.25.2.5", "ftx", "product_name", "product"), ("F.25.2.6", "ftx", "rate_units", "rate_unit"),
            ("F.25.2.7", "ftx", "time_zone", "time_zone"), ("F.25.2.8", "ftx", PODBA, "authority"),
        ]
    },
    "T4": {
        ("F.16.17", "fid"): f"role = 'Customer' AND coalesce(contact_name, phone, email) IS NOT NULL AND (contact_name IS NULL OR phone IS NULL OR email IS NULL OR NOT {EMAIL})",
        ("F.16.27.2", "fid"): f"{YES} AND coalesce(filer_unique_id, '') NOT LIKE 'FS%'",
        ("F.19.1.3", "fid"): "country = 'US' AND length(state) <> 2",
        ("F.18.1.1", "ffilings"): "period_start < DATE '2002-01-01'",
        ("F.18.1.2", "ffilings"): f"period_start > DATE '{RUN_DATE}'",
        ("F.18.2", "ffilings"): f"period_end >= DATE '{RUN_DATE}'",
        ("F.17.1.1", "fct"): f"period < '2005Q1' AND {ENERGY_OR_BOOKED} AND {POWER}",
        ("F.17.1.2", "fct"): f"period >= '2005Q1' AND upper(product_name) = 'ENERGY' AND {POWER}",
        ("F.17.3.1", "fct"): f"period < '2005Q1' AND upper(product_name) = 'CAPACITY' AND {ENERGY}",
        ("F.17.3.2", "fct"): f"period >= '2005Q1' AND upper(product_name) = 'CAPACITY' AND {ENERGY}",
        ("F.20.8", "fct"): f"actual_termination_date > {END}",
        ("F.21.15", "fct"): f"actual_termination_date > {END}",
        ("F.21.22", "fct"): "length(customer_company_name) > 70",
        ("F.23.6", "fct"): "product_type_name = 'CR' AND product_name NOT IN ('Reassignment Agreement', 'Point-To-Point Agreement')",
        ("F.23.22", "fct"): "podsl IS NOT NULL AND podsl_hub IS NOT NULL",
        ("F.23.23", "fct"): f"(podsl IS NOT NULL AND podsl_hub IS NOT NULL) OR (porsl IS NOT NULL AND porsl_hub IS NOT NULL) OR {_no_hub('podba', 'podsl_hub')} OR {_no_hub('porba', 'porsl_hub')}",
        ("F.17.2.1", "ftx"): f"period < '2005Q1' AND {ENERGY_OR_BOOKED} AND {POWER}",
        ("F.17.2.2", "ftx"): f"period >= '2005Q1' AND {ENERGY_OR_BOOKED} AND {POWER}",
        ("F.17.4.1", "ftx"): f"period < '2005Q1' AND upper(product_name) = 'CAPACITY' AND {ENERGY}",
        ("F.17.4.2", "ftx"): f"period >= '2005Q1' AND upper(product_name) = 'CAPACITY' AND {ENERGY}",
        ("F.17.8.1", "ftx"): "upper(rate_units) = '$/MWH' AND (price > 1000 OR price < -1000)",
        ("F.17.8.2", "ftx"): "upper(rate_units) = '$/KWH' AND (price > 1 OR price < -1)",
        ("F.17.8.3", "ftx"): "upper(rate_units) = 'CENTS/KWH' AND (price > 100 OR price < -100)",
        ("F.24.3", "ftx"): "transaction_end_date <= transaction_begin_date",
        ("F.24.4", "ftx"): f"transaction_end_date IS NULL OR transaction_end_date > {END}",
        ("F.24.5", "ftx"): f"transaction_begin_date IS NULL OR transaction_begin_date < {START}",
        ("F.24.6", "ftx"): f"{CHARGE.format(e=REPORTED)} OR ({METERED} AND {CHARGE.format(e=STANDARDIZED)})",
        ("F.25.14.1", "ftx"): "coalesce(transaction_quantity, 0) = 0 AND transaction_begin_date < DATE '2006-10-01'",
        ("F.25.15", "ftx"): "transaction_quantity = 0 AND total_transaction_charge = 0 AND transaction_begin_date > DATE '2006-10-01'",
        ("F.25.21.2", "ftx"): "transaction_quantity <= 0",
        ("F.25.25", "ftx"): f"({PODSL} IS NOT NULL AND point_of_delivery_hub IS NOT NULL) OR {_no_hub(PODBA, 'point_of_delivery_hub')}",
        ("F.30.46", "ftx"): f"transaction_quantity = standardized_quantity AND {STANDARD}",
        ("F.30.47", "ftx"): f"price = standardized_price AND {STANDARD}",
    },
    "T11": {
        ("F.16.8", "fid"): f"NOT {EMAIL}",
        ("F.19.1.2", "fid"): r"country = 'US' AND NOT regexp_matches(zip, '^\d{5}(-\d{4})?$')",
        ("F.19.1.4", "fid"): r"country = 'MX' AND NOT regexp_matches(zip, '^\d{5}$')",
        ("F.19.1.5", "fid"): r"country = 'GB' AND NOT regexp_matches(zip, '^[A-Za-z]{1,2}\d[A-Za-z0-9]? ?\d[A-Za-z]{2}$')",
        ("F.19.1.6", "fid"): r"country = 'CA' AND NOT regexp_matches(zip, '^[A-Za-z]\d[A-Za-z] ?\d[A-Za-z]\d$')",
    },
}

IDENT_14 = ("filer_unique_id, company_name, company_identifier, contact_name, contact_title, address, city, state, zip, "
            "country, phone, email, report_to_index")


def _dup(view: str, keys: str, where: str = "true") -> str:
    return (f"SELECT cid, period, {RECORD[view]} AS record FROM (SELECT *, count(*) OVER (PARTITION BY cid, period, {keys}) AS copies"
            f" FROM {view} WHERE {where}) d WHERE copies > 1")


def _components(header: str, test: str) -> str:
    return " UNION ALL ".join(
        f"SELECT v.cid, v.period, v.{RECORD[view]} AS record FROM {view} v JOIN ffilings f"
        f" ON v.cid = f.cid AND v.period = f.period WHERE f.filing_type = '{header}' AND {test}"
        for view in ("fct", "ftx")
    )


def _absent(view: str, partner: str, on: str, test: str = "true") -> str:
    return (f"SELECT v.cid, v.period, v.{RECORD[view]} AS record FROM {view} v WHERE ({test.replace('~', 'v.')})"
            f" AND NOT EXISTS (SELECT 1 FROM {partner} p WHERE {on})")


def _there(view: str, partner: str, on: str, test: str = "true") -> str:
    return _absent(view, partner, on, test).replace("AND NOT EXISTS", "AND EXISTS")


V_END, V_START = END.replace("period", "v.period"), START.replace("period", "v.period")
AT_END = f"p.effective_start <= {V_END} AND (p.effective_end IS NULL OR {V_END} < p.effective_end)"
DURING = f"p.effective_start <= {V_END} AND (p.effective_end IS NULL OR p.effective_end > {V_START})"
SAME_FILING = "p.cid = v.cid AND p.period = v.period"
V_METERED = METERED.replace("product_name", "v.product_name")


def _recent(test: str) -> str:
    return _there("ftx", "fct", f"{SAME_FILING} AND p.contract_unique_id = v.contract_unique_id AND p.contract_execution_date >= DATE '2013-07-01'", test)


def _per_filing(measure: str, test: str) -> str:
    return (f"SELECT f.cid, f.period, f.cid AS record FROM ffilings f LEFT JOIN (SELECT cid, period, {measure} FROM fid GROUP BY cid, period) i"
            f" ON f.cid = i.cid AND f.period = i.period WHERE {test}")


N_FA1 = "count(*) FILTER (WHERE filer_unique_id = 'FA1') AS n"
N_FS, N_FA = f"count(*) FILTER (WHERE {FS}) AS s", f"count(*) FILTER (WHERE {FA}) AS a"
ROLES = "count(*) FILTER (WHERE role = 'Seller') AS s, count(*) FILTER (WHERE role = 'Agent') AS a"
DELETED = "f.filing_type = 'Delete'"

# template -> {rule: query}
SELECTS = {
    "T5": {
        "F.16.3.1": _absent("fid", "freg", "p.cid = v.cid AND p.legal_name = v.company_name"),
        "F.16.3.2": _absent("fct", "freg", "p.cid = v.cid AND p.legal_name = v.seller_company_name"),
        "F.16.3.4": _absent("fid", "freg", f"p.cid = v.cid AND p.legal_name = v.company_name AND {AT_END}", "~filer_unique_id LIKE 'FS%'"),
        "F.16.3.5": _absent("fct", "freg", f"p.cid = v.cid AND p.legal_name = v.seller_company_name AND {DURING}"),
        "F.16.26": _absent("fid", "freg", f"p.cid = v.cid AND {DURING}", "~filer_unique_id LIKE 'FS%' OR ~filer_unique_id LIKE 'FA%'"),
        "F.21.2.2": _absent("fct", "freg", f"p.cid = v.seller_cid AND {DURING}"),
        "F.21.3.3": _absent("fct", "freg", f"p.cid = v.customer_cid AND {DURING}", "~customer_cid IS NOT NULL"),
        "F.30.41.1": _absent("fct", "freg", "p.cid = v.seller_cid AND p.is_npu", "~ferc_tariff_reference = 'NPU'"),
        "F.16.13.1": _absent("fid", "fcontacts", "p.cid = v.cid AND p.contact_name = v.contact_name", "~filer_unique_id LIKE 'FA%'"),
        "F.16.14.5": _absent("fid", "fcontacts", "p.cid = v.cid AND p.contact_name = v.contact_name", "~filer_unique_id LIKE 'FS%'"),
        "F.16.14.4": f"""SELECT cid, period, company_name AS record FROM fid i WHERE {FS} GROUP BY cid, period, company_name
            HAVING count(*) FILTER (WHERE concat(cid, '/', contact_name) IN (SELECT concat(cid, '/', contact_name) FROM fcontacts)) = 0""",
        "F.16.16.3": """SELECT f.cid, f.period, f.cid AS record FROM ffilings f WHERE NOT EXISTS (SELECT 1 FROM fid i JOIN fcontacts c
            ON i.cid = c.cid AND i.contact_name = c.contact_name WHERE i.cid = f.cid AND i.period = f.period)""",
        "F.16.21": """SELECT v.cid, v.period, v.filer_unique_id AS record FROM fid v
            WHERE EXISTS (SELECT 1 FROM fcontacts p WHERE p.cid = v.cid AND p.contact_name = v.contact_name)
              AND NOT EXISTS (SELECT 1 FROM fcontacts p WHERE p.cid = v.cid AND p.contact_name = v.contact_name AND p.role = v.role)""",
        "F.20.19": _absent("fct", "ftariffs", "p.cid = v.cid", "coalesce(~ferc_tariff_reference, '') <> 'NPU'"),
        "F.20.20": _there("fct", """(SELECT cid, ferc_tariff_reference AS ref, max(coalesce(tariff_end, DATE '9999-12-31')) AS last_end
            FROM ftariffs GROUP BY 1, 2)""", f"p.cid = v.cid AND p.ref = v.ferc_tariff_reference AND p.last_end < {V_END}"),
        "F.20.21": _absent("fct", "ftariffs", "p.cid = v.cid AND p.ferc_tariff_reference = v.ferc_tariff_reference",
                           "~cid IN (SELECT cid FROM ftariffs)"),
        "F.31.01": f"""SELECT v.cid, v.period, v.filer_unique_id AS record FROM fid v WHERE {FS}
            AND v.cid IN (SELECT cid FROM freg)
            AND v.cid NOT IN (SELECT cid FROM freg WHERE role IN ('Agent', 'Account Manager'))""",
    },
    "T6": {
        "F.16.4.1": _dup("fid", IDENT_14),
        "F.16.4.2": _dup("fid", "filer_unique_id", "filer_unique_id IS NOT NULL"),
        "F.16.5": _dup("fid", "company_name", f"{FS} AND company_name IS NOT NULL"),
        "F.16.6": _dup("fid", "company_name", f"{FS} AND company_name IS NOT NULL"),
        "F.16.25": " UNION ALL ".join(_dup(v, RECORD[v], f"{RECORD[v]} IS NOT NULL") for v in ("fid", "fct", "ftx")),
        "F.20.23": _dup("fct", "contract_unique_id", "contract_unique_id IS NOT NULL"),
        "F.21.31": _dup("fct", "seller_company_name, customer_company_name, ferc_tariff_reference, contract_service_agreement_id"),
        "F.24.15.1": _dup("ftx", "transaction_unique_id", "transaction_unique_id IS NOT NULL"),
        "F.UNIQUE_TX": _dup("ftx", "transaction_unique_id", "transaction_unique_id IS NOT NULL"),
        "F.25.17.2": _dup("ftx", f"""transaction_begin_date, transaction_end_date, contract_service_agreement, seller_company_name,
            customer_company_name, product_name, rate_units, class_name, term_name, increment_name, increment_peaking_name, time_zone,
            {PODBA}, {PODSL}, ferc_tariff_reference, type_of_rate, trade_date, transaction_quantity, price, standardized_price,
            standardized_quantity, total_transaction_charge, total_transmission_charge"""),
    },
    "T7": {
        "F.16.3": _per_filing(f"{N_FS}, {N_FA}", "coalesce(s, 0) = 0 OR coalesce(a, 0) = 0"),
        "F.16.12.1": _per_filing(N_FA1, "coalesce(n, 0) <> 1"),
        "F.16.12.2": _per_filing(N_FA1, "coalesce(n, 0) <> 1"),
        "F.16.14.1": _per_filing(N_FS, "coalesce(s, 0) <> 1"),
        "F.16.14.2": f"""SELECT cid, period, company_name AS record FROM fid WHERE {FS} GROUP BY cid, period, company_name
            HAVING count(DISTINCT contact_name) <> 1""",
        "F.16.20.2": _per_filing(ROLES, f"{DELETED} AND (coalesce(s, 0) = 0 OR coalesce(a, 0) = 0)"),
        "F.16.20.3": _per_filing("count(DISTINCT company_name) AS n", f"{DELETED} AND n > 2"),
        "F.16.20.4": _per_filing("count(*) FILTER (WHERE coalesce(role, '') NOT IN ('Seller', 'Agent')) AS n",
                                 f"""{DELETED} AND (n > 0 OR EXISTS (SELECT 1 FROM fct c WHERE c.cid = f.cid AND c.period = f.period)
                                 OR EXISTS (SELECT 1 FROM ftx t WHERE t.cid = f.cid AND t.period = f.period))"""),
        "F.16.23.1": _per_filing(ROLES, "coalesce(s, 0) = 0 OR coalesce(a, 0) = 0"),
        "F.31.02": _per_filing(N_FA, "coalesce(a, 0) <> 1"),
    },
    "T8": {
        "D.3.9.1": _components("New", "v.filing_type <> 'New'"),
        "F.16.18": _components("New", "v.filing_type <> 'New'"),
        "D.3.9.2": _components("Replace", "v.filing_type <> 'New'"),
        "F.16.19": _components("Replace", "v.filing_type <> 'New'"),
        "D.3.9.3": _components("Delete", "true"),
        "F.16.20.1": _components("Delete", "true"),
        "D.3.9.6": _there("ftx", "fct", f"{SAME_FILING} AND p.contract_unique_id = v.contract_unique_id AND p.filing_type = 'New'",
                          "~filing_type <> 'New'"),
        "D.3.9.8": _there("fct", "ftx", f"{SAME_FILING} AND p.contract_unique_id = v.contract_unique_id", "~filing_type = 'Delete'"),
    },
    "T9": {
        "F.17.5": _absent("ffilings", "fid", f"{SAME_FILING} AND p.filer_unique_id LIKE 'FA%' AND p.contact_name = v.submitter_name"),
        "F.16.27.1": _absent("fid", "fix", SAME_FILING, "upper(~report_to_index) IN ('Y', 'YES')"),
        "F.16.27.3": _absent("fix", "fid", f"{SAME_FILING} AND p.filer_unique_id LIKE 'FS%' AND p.filer_unique_id = v.filer_unique_id"),
        "F.16.27.4": _there("fid", "fix", SAME_FILING, "~filer_unique_id LIKE 'FS%' AND coalesce(upper(~report_to_index), 'N') NOT IN ('Y', 'YES')"),
        "F.21.2.1": _absent("fct", "fid", f"{SAME_FILING} AND p.filer_unique_id LIKE 'FS%' AND p.company_name = v.seller_company_name"),
        "F.21.3.1": _absent("ftx", "fct", f"{SAME_FILING} AND p.customer_company_name = v.customer_company_name"),
        "F.25.18": _absent("ftx", "fct", f"""{SAME_FILING} AND p.contract_service_agreement_id = v.contract_service_agreement
            AND (CASE WHEN upper(v.product_name) = 'BOOKED OUT POWER' THEN upper(p.product_name) IN ('ENERGY', 'CAPACITY')
                 ELSE upper(p.product_name) = upper(v.product_name) END)""", "~period >= '2013Q3'"),
    },
    "T10": {
        "F.23.21.2": _there("ftx", "fct", f"{SAME_FILING} AND p.contract_unique_id = v.contract_unique_id AND p.termination_date < v.transaction_end_date"),
        "F.30.42": _recent("~trade_date IS NULL"),
        "F.30.43": _recent("~type_of_rate IS NULL"),
        "F.30.44": _recent(f"~standardized_price IS NULL AND {V_METERED}"),
        "F.30.45": _recent(f"~standardized_quantity IS NULL AND {V_METERED}"),
    },
    "T12": {
        "F.20.11": """SELECT cid, period, contract_unique_id AS record FROM fct WHERE contract_unique_id IS NOT NULL GROUP BY 1, 2, 3
            HAVING count(DISTINCT customer_company_name) > 1 OR count(DISTINCT seller_company_name) > 1""",
        "F.21.32": f"""SELECT cid, period, cid AS record FROM (
              SELECT cid, period, count(*) AS rows_all, count(DISTINCT contract_unique_id) AS contracts FROM fct GROUP BY 1, 2) s
            WHERE contracts > {SIZE_LIMITS[0]} OR rows_all > {SIZE_LIMITS[1]} OR EXISTS (
              SELECT 1 FROM fct c WHERE c.cid = s.cid AND c.period = s.period AND c.contract_unique_id IS NOT NULL
              GROUP BY c.contract_unique_id HAVING count(*) > {SIZE_LIMITS[2]})""",
        "F.30.41.3": """SELECT cid, period, seller_company_name AS record FROM fct GROUP BY 1, 2, 3
            HAVING count(DISTINCT ferc_tariff_reference = 'NPU') > 1""",
        "F.25.16": f"""SELECT cid, period, customer_company_name AS record FROM ftx
            WHERE {_in('customer_company_name', 'iso')} AND (product_name = 'BOOKED OUT POWER' OR
              (upper(product_name) = 'ENERGY' AND coalesce(class_name, '') <> 'BA' AND seller_company_name = customer_company_name))
            GROUP BY 1, 2, 3 HAVING avg(24.0 * date_diff('day', transaction_begin_date, transaction_end_date)) > 3""",
    },
    "T13": {
        "F.16.27.5": """SELECT cid, period, cid AS record FROM (
              SELECT cid, period, publisher, publication, bool_or(filing_type = 'Append') IS NOT DISTINCT FROM true AS later,
                     bool_or(coalesce(filing_type, '') <> 'Append') AS earlier
              FROM fix GROUP BY 1, 2, 3, 4) s
            GROUP BY 1, 2 HAVING bool_or(later) AND count(*) FILTER (WHERE later <> earlier) > 0""",
    },
}

CHECKSUM = "CAST(sum(CAST(concat('0x', substring(md5(concat_ws('|', period, record)), 1, 8)) AS BIGINT)) AS BIGINT)"


def parts(template: str) -> list[str]:
    rows = [
        f"SELECT '{rule}' AS rule_id, cid, period, {RECORD[view]} AS record FROM {view} WHERE {test}"
        for (rule, view), test in ROWS.get(template, {}).items()
    ]
    return rows + [
        f"SELECT '{rule}' AS rule_id, cid, period, record FROM ({text}) q" for rule, text in SELECTS.get(template, {}).items()
    ]


TEMPLATES = list(ROWS) + list(SELECTS)


def rule_ids(template: str) -> set[str]:
    return {rule for rule, _ in ROWS.get(template, {})} | set(SELECTS.get(template, {}))


def found(templates: list[str]) -> str:
    """All violations of the templates as (rule_id, cid, period, record)."""
    return " UNION ALL ".join(p for t in templates for p in parts(t))


def summary(templates: list[str]) -> str:
    """Per rule and company: how many violations, and a checksum over the records."""
    return (f"{with_clause(FULL)} SELECT rule_id, cid, count(*) AS n, {CHECKSUM} AS checksum"
            f" FROM ({found(templates)}) a GROUP BY rule_id, cid")
