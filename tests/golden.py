"""A clean filing in the canonical schema, and frames built from partial rows."""

from __future__ import annotations

import datetime as dt

from ledgerproof import schemas
from ledgerproof.context import FilingContext, Settings

CID, PERIOD, NAME = "C000001", "2024Q1", "Example Power LLC"
KEYS = {"cid": CID, "period": PERIOD, "filing_type": "New", "source_filename": "filing.csv"}
DAY = dt.date

SETTINGS = Settings(
    run_date=DAY(2024, 6, 1),
    lookups={
        "class": ["F", "NF"], "term": ["LT", "ST"], "increment": ["H", "D"], "peaking": ["P", "OP"], "product_type": ["MB", "CR"],
        "product": ["ENERGY", "CAPACITY", "BOOKED OUT POWER", "ANCILLARY SERVICES"], "unit": ["MWH"],
        "rate_unit": ["$/MWH", "$/KWH", "$/MW", "$/KW", "$/MW-MONTH", "CENTS/KWH"], "authority": ["HUB", "PJM"],
        "tariff": ["TARIFF 1", "NPU"], "time_zone": ["ES"], "hub": ["PALO VERDE"], "iso": ["GRID OPERATOR"],
    },
)

TRANSACTION = {
    **KEYS, "transaction_unique_id": "T1", "contract_unique_id": "K1", "contract_service_agreement": "A1", "seller_cid": CID,
    "seller_company_name": NAME, "customer_company_name": "Regional Utility", "product_name": "ENERGY", "rate_units": "$/MWH",
    "class_name": "F", "term_name": "LT", "increment_name": "H", "increment_peaking_name": "P", "time_zone": "ES",
    "point_of_delivery_balancing_authority": "PJM", "point_of_delivery_specific_location": "Bus 7", "ferc_tariff_reference": "Tariff 1",
    "type_of_rate": "Fixed", "total_transaction_charge": 4550.0, "total_transmission_charge": 0.0, "transaction_quantity": 100.0,
    "price": 45.5, "standardized_price": 45.5, "standardized_quantity": 100.0, "transaction_begin_date": DAY(2024, 1, 15),
    "transaction_end_date": DAY(2024, 1, 16), "trade_date": DAY(2024, 1, 10), "source_row_index": 1,
}
CONTRACT = {
    **KEYS, "contract_unique_id": "K1", "seller_cid": CID, "seller_company_name": NAME, "customer_company_name": "Regional Utility",
    "customer_cid": None, "contract_affiliate": "N", "ferc_tariff_reference": "Tariff 1", "contract_service_agreement_id": "A1",
    "extension_provision_description": "none", "class_name": "F", "term_name": "LT", "increment_name": "H",
    "increment_peaking_name": "P", "product_type_name": "MB", "product_name": "ENERGY", "rate_units": "$/MWH", "rate": 45.5,
    "contract_execution_date": DAY(2023, 12, 1), "commencement_date": DAY(2024, 1, 1), "termination_date": DAY(2025, 12, 31),
    "begin_date": DAY(2024, 1, 1), "end_date": DAY(2025, 12, 31), "source_row_index": 1,
}
SELLER = {
    **KEYS, "filer_unique_id": "FS1", "company_name": NAME, "company_identifier": CID, "contact_name": "Ann Field",
    "contact_title": "Manager", "address": "Main Street 1", "city": "Springfield", "state": "WA", "zip": "98101", "country": "US",
    "phone": "555-0100", "email": "ann@example.com", "report_to_index": "Y", "role": "Seller", "submitter_name": "Bo Agent",
    "source_row_index": 1,
}
AGENT = {**SELLER, "filer_unique_id": "FA1", "contact_name": "Bo Agent", "role": "Agent", "report_to_index": "N", "source_row_index": 2}
INDEX = {**KEYS, "filer_unique_id": "FS1", "publisher": "Platts", "publication": "Gas Daily", "transactions_reported": "All", "source_row_index": 1}
REGISTRY = {"cid": CID, "legal_name": NAME, "role": "Account Manager", "effective_start": DAY(2020, 1, 1), "is_npu": False}
CONTACTS = [{"cid": CID, "contact_name": "Ann Field", "role": "Seller"}, {"cid": CID, "contact_name": "Bo Agent", "role": "Agent"}]
TARIFF = {"cid": CID, "ferc_tariff_reference": "Tariff 1"}


def frame(spark, table: str, rows: list[dict]):
    schema = schemas.TABLES[table]
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)


def filing(spark, settings=SETTINGS, **changed) -> FilingContext:
    """The clean filing, with whole tables replaced by name."""
    tables = {
        "transactions": [TRANSACTION], "contracts": [CONTRACT], "ident": [SELLER, AGENT], "index": [INDEX],
        "registry": [REGISTRY], "contacts": CONTACTS, "tariffs": [TARIFF], **changed,
    }
    return FilingContext(spark, {n: frame(spark, n, rows) for n, rows in tables.items()}, settings)
