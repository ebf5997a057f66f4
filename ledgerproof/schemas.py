"""Canonical schema per table, and the alternative spellings of its columns."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {"s": T.StringType(), "d": T.DateType(), "f": T.DoubleType(), "l": T.LongType(), "b": T.BooleanType()}


def _schema(**columns: str) -> T.StructType:
    fields = []
    for code, names in columns.items():
        fields += [T.StructField(n, _TYPES[code]) for n in names.split()]
    return T.StructType(fields)


_KEYS = "cid period filing_type"
_ORIGIN = "source_filename"

TRANSACTIONS = _schema(
    s=f"""{_KEYS} transaction_unique_id contract_unique_id contract_service_agreement seller_cid
    seller_company_name customer_company_name product_name rate_units class_name term_name increment_name
    increment_peaking_name time_zone point_of_delivery_balancing_authority
    point_of_delivery_specific_location point_of_delivery_hub ferc_tariff_reference type_of_rate {_ORIGIN}""",
    f="""total_transaction_charge total_transmission_charge transaction_quantity price
    standardized_price standardized_quantity""",
    d="transaction_begin_date transaction_end_date trade_date",
    l="source_row_index",
)

CONTRACTS = _schema(
    s=f"""{_KEYS} contract_unique_id seller_cid seller_company_name customer_company_name customer_cid
    contract_affiliate ferc_tariff_reference contract_service_agreement_id extension_provision_description
    class_name term_name increment_name increment_peaking_name product_type_name product_name units
    rate_description rate_units porba porsl porsl_hub podba podsl podsl_hub {_ORIGIN}""",
    d="""contract_execution_date commencement_date termination_date actual_termination_date
    begin_date end_date""",
    f="rate rate_minimum rate_maximum",
    l="source_row_index",
)

IDENT = _schema(
    s=f"""{_KEYS} filer_unique_id company_name company_identifier contact_name contact_title address city
    state zip country phone email report_to_index role submitter_name {_ORIGIN}""",
    l="source_row_index",
)

INDEX = _schema(
    s=f"{_KEYS} filer_unique_id publisher publication transactions_reported {_ORIGIN}",
    l="source_row_index",
)

REGISTRY = _schema(s="cid legal_name role", d="effective_start effective_end", b="is_npu")
CONTACTS = _schema(s="cid contact_name role")
TARIFFS = _schema(s="cid ferc_tariff_reference", d="tariff_end")

TABLES = {
    "transactions": TRANSACTIONS,
    "contracts": CONTRACTS,
    "ident": IDENT,
    "index": INDEX,
    "registry": REGISTRY,
    "contacts": CONTACTS,
    "tariffs": TARIFFS,
}

# Alternative source spelling -> canonical name.
ALIASES = {
    "transactions": {
        "transaction_price": "price",
        "company_identifier": "cid",
        "contract_service_agreement_id": "contract_service_agreement",
        "Field_45_TransactionUniqueID": "transaction_unique_id",
        "Field_51_TransactionBeginDate": "transaction_begin_date",
        "Field_52_TransactionEndDate": "transaction_end_date",
        "Field_63_ProductName": "product_name",
        "Field_64_Quantity": "transaction_quantity",
        "Field_64_TransactionQuantity": "transaction_quantity",
        "Field_65_Price": "price",
        "Field_65_TransactionPrice": "price",
        "Field_66_RateUnits": "rate_units",
        "Field_70_TotalTransactionCharge": "total_transaction_charge",
        "FilingPeriod": "period",
        "FilingType": "filing_type",
        "CID": "cid",
    },
    "contracts": {
        "contract_service_agreement": "contract_service_agreement_id",
        "Field_15_ContractUniqueID": "contract_unique_id",
        "Field_16_SellerCompanyName": "seller_company_name",
        "Field_17_CustomerCompanyName": "customer_company_name",
        "Field_21_ContractExecutionDate": "contract_execution_date",
        "Field_22_CommencementDate": "commencement_date",
        "Field_23_TerminationDate": "termination_date",
        "Field_30_ProductName": "product_name",
        "Field_34_Rate": "rate",
        "Field_38_RateUnits": "rate_units",
        "FilingPeriod": "period",
        "FilingType": "filing_type",
        "CID": "cid",
    },
    "ident": {
        "CID": "cid",
        "seller_cid": "cid",
        "seller_company_name": "company_name",
        "seller_name": "company_name",
        "Field_1_FilerUniqueID": "filer_unique_id",
        "Field_2_CompanyName": "company_name",
        "Field_4_ContactName": "contact_name",
        "Field_6_Email": "email",
        "Field_13_ReportToIndex": "report_to_index",
        "FilingPeriod": "period",
        "FilingType": "filing_type",
    },
    "index": {
        "CID": "cid",
        "Field_73_IndexPublisher": "publisher",
        "Field_74_IndexPublication": "publication",
        "FilingPeriod": "period",
        "FilingType": "filing_type",
    },
    "registry": {
        "CID": "cid",
        "Organization_Name": "legal_name",
        "effective_start_date": "effective_start",
        "effective_end_date": "effective_end",
    },
    "contacts": {},
    "tariffs": {},
}

# Column that identifies a record in each table.
RECORD_ID = {
    "transactions": "transaction_unique_id",
    "contracts": "contract_unique_id",
    "ident": "filer_unique_id",
    "index": "publisher",
    "filings": "cid",
}
RECORD_TYPE = {
    "transactions": "transaction",
    "contracts": "contract",
    "ident": "identity",
    "index": "index",
    "filings": "filing",
}
