"""The rule catalogue, grouped by the rows each rule reads."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerproof import constants as K
from ledgerproof.context import FILING_KEYS, FilingContext, Settings
from ledgerproof.functions import predicates as P
from ledgerproof.operators.groups import differs_within, set_difference_keys
from ledgerproof.operators.joins import left_join_null_safe
from ledgerproof.operators.results import category, stage
from ledgerproof.schemas import RECORD_ID, RECORD_TYPE
from ledgerproof.plans.rules import Check, DerivedGroup, DuplicateGroup, Frame, Group, JoinGroup, KeyFacts, RowGroup

ERROR, WARNING, XSD = "Error", "Warning", "XSD"

NPU = P.known("ferc_tariff_reference", ["NPU"])
METERED = P.known("product_name", K.METERED_PRODUCTS)


def required(rule_id: str, name: str, severity: str = ERROR) -> Check:
    """A text column that must not be blank."""
    return Check(rule_id, severity, "T1", f"{name} is missing", P.blank(name))


def present(rule_id: str, name: str, gate: str = "true", severity: str = ERROR, template: str = "T1") -> Check:
    """A typed column that must not be null where the gate holds."""
    return Check(rule_id, severity, template, f"{name} is missing", f"{gate} AND {P.missing(name)}")


def floor(rule_id: str, name: str) -> Check:
    return Check(rule_id, ERROR, "T2", f"{name} must be after {K.DATE_FLOOR}", P.on_or_before_floor(name), name)


def wrong_units(rule_id: str, severity: str, gate: str, products: list[str], units: list[str]) -> Check:
    test = f"{gate} AND {P.known('product_name', products)} AND {P.known('rate_units', units)}"
    return Check(rule_id, severity, "T4", "units do not fit the product", test, "rate_units")


# --- tables of one row per record -------------------------------------------------------------


def ident_checks() -> list[Check]:
    contact = ["contact_name", "contact_title", "address", "city", "phone", "email"]
    seller, agent = P.is_seller(), P.is_agent()

    def zip_rule(rule_id: str, country: str) -> Check:
        test = f"{P.norm('country')} = '{country}' AND {P.not_matching('zip', K.ZIP_PATTERNS[country])}"
        return Check(rule_id, ERROR, "T11", f"zip is not valid for {country}", test, "zip")

    sound_email = P.surely(f"email RLIKE r'{K.EMAIL}'")
    customer_contact = (
        f"{P.norm('role')} = 'CUSTOMER' AND NOT (contact_name IS NULL AND phone IS NULL AND email IS NULL)"
        f" AND ({P.blank('contact_name')} OR {P.blank('phone')} OR NOT {sound_email})"
    )
    return [
        Check("F.16.8", ERROR, "T11", "email is not valid", P.not_matching("email", K.EMAIL), "email"),
        Check("F.16.13", ERROR, "T1", "identity data is incomplete",
              P.any_missing("filer_unique_id", "company_name", "contact_name", "email")),
        Check("F.16.15", ERROR, "T1", "seller contact is incomplete", f"{seller} AND {P.any_missing(*contact)}"),
        Check("F.16.17", XSD, "T4", "customer contact is given but not valid", customer_contact),
        Check("F.16.23.2", ERROR, "T1", "seller or agent has no company identifier",
              f"({seller} OR {agent}) AND {P.blank('company_identifier')}"),
        Check("F.16.27.2", ERROR, "T4", "only a seller may report to an index",
              f"{P.says_yes('report_to_index')} AND NOT {P.surely(seller)}"),
        required("F.19.1.1", "zip"),
        zip_rule("F.19.1.2", "US"),
        Check("F.19.1.3", ERROR, "T4", "US state code must have two letters",
              f"{P.norm('country')} = 'US' AND length(state) <> 2", "state"),
        zip_rule("F.19.1.4", "MX"),
        zip_rule("F.19.1.5", "GB"),
        zip_rule("F.19.1.6", "CA"),
        required("F.19.1.7", "address"),
        Check("F.20.1.1", ERROR, "T1", "seller identifier is blank",
              f"{P.norm('role')} = 'SELLER' AND {P.blank('filer_unique_id')}"),
    ]


def filing_checks(settings: Settings) -> list[Check]:
    today = f"DATE'{settings.run_date.isoformat()}'"
    return [
        Check("F.18.1.1", ERROR, "T4", "filing period starts too early",
              f"period_start < DATE'{K.FIRST_FILING_DAY}'", "period"),
        Check("F.18.1.2", ERROR, "T4", "filing period starts in the future", f"period_start > {today}", "period"),
        Check("F.18.2", ERROR, "T4", "filing period has not ended", f"{today} <= period_end", "period"),
    ]


def contract_checks(settings: Settings) -> list[Check]:
    early, later = P.before(K.PERIOD_UNITS_ENFORCED), P.since(K.PERIOD_UNITS_ENFORCED)
    still_running = f"actual_termination_date > {P.period_end()}"
    reassigned = P.unknown("product_name", ["Reassignment Agreement", "Point-To-Point Agreement"])
    rates = "rate IS NULL AND rate_minimum IS NULL AND rate_maximum IS NULL AND rate_description IS NULL"
    return [
        Check("F.16.11", ERROR, "T1", "contract data is incomplete",
              P.any_missing("contract_unique_id", "seller_company_name", "customer_company_name", "product_name")),
        wrong_units("F.17.1.1", WARNING, early, [K.ENERGY, K.BOOKED_OUT], K.POWER_UNITS),
        wrong_units("F.17.1.2", ERROR, later, [K.ENERGY], K.POWER_UNITS),
        wrong_units("F.17.3.1", WARNING, early, [K.CAPACITY], K.ENERGY_UNITS),
        wrong_units("F.17.3.2", ERROR, later, [K.CAPACITY], K.ENERGY_UNITS),
        present("F.20.2.2", "contract_execution_date", P.since(K.PERIOD_EXECUTION_REQUIRED)),
        floor("F.20.3", "contract_execution_date"),
        present("F.20.4.2", "commencement_date"),
        floor("F.20.5", "commencement_date"),
        floor("F.20.7", "termination_date"),
        Check("F.20.8", ERROR, "T4", "actual termination lies after the filing period", still_running,
              "actual_termination_date"),
        floor("F.20.9", "actual_termination_date"),
        required("F.20.22", "ferc_tariff_reference", WARNING),
        required("F.21.3.2", "customer_company_name"),
        Check("F.21.5", XSD, "T3", "contract_affiliate is not Y or N", P.unknown("contract_affiliate", ["Y", "N"]),
              "contract_affiliate"),
        required("F.21.6", "ferc_tariff_reference"),
        required("F.21.7", "contract_service_agreement_id"),
        required("F.21.12", "extension_provision_description"),
        Check("F.21.15", ERROR, "T4", "actual termination lies after the filing period", still_running,
              "actual_termination_date"),
        Check("F.21.22", XSD, "T4", "customer name is too long",
              f"length(customer_company_name) > {K.MAX_BUYER_NAME}"),
        present("F.22.2.2", "begin_date"),
        floor("F.22.3", "begin_date"),
        present("F.22.4.2", "end_date"),
        floor("F.22.5", "end_date"),
        Check("F.23.6", ERROR, "T4", "product name does not fit product type CR",
              f"{P.norm('product_type_name')} = 'CR' AND {reassigned}", "product_name"),
        Check("F.23.22", ERROR, "T4", "two delivery locations are given", P.both_set("podsl", "podsl_hub")),
        Check("F.23.24", ERROR, "T1", "no rate is given", rates),
    ]


def charge_is_off() -> str:
    """Charge against price times quantity plus transmission, for the reported and the standardized
    pair. Prices in cents count as dollars divided by one hundred."""
    transmission = "coalesce(total_transmission_charge, 0D)"
    dollars = f"CASE WHEN {P.known('rate_units', K.CENTS_UNITS)} THEN 0.01D ELSE 1D END"
    reported = f"(price * transaction_quantity * {dollars} + {transmission})"
    standardized = f"(standardized_price * standardized_quantity + {transmission})"
    off = P.off_by_more_than(reported, "total_transaction_charge")
    standard_off = P.off_by_more_than(standardized, "total_transaction_charge")
    return f"{off} OR ({METERED} AND {standard_off})"


def ends_too_early(same_day_allowed: bool = False) -> str:
    """End date not after the begin date; the other reading lets both fall on one day."""
    return f"transaction_end_date {'<' if same_day_allowed else '<='} transaction_begin_date"


def charge_is_off_simple() -> str:
    """Variant without transmission charge and with one dollar of tolerance."""
    return f"abs(price * transaction_quantity - total_transaction_charge) > {K.ABS_TOLERANCE}D"


def units_not_standard(a: str, b: str) -> str:
    """Equal reported and standardized value although the units are not the standard ones."""
    wrong = [
        f"({P.known('product_name', [product])} AND NOT {P.surely(P.known('rate_units', units))})"
        for product, units in K.STANDARD_UNITS.items()
    ]
    return f"{a} = {b} AND ({' OR '.join(wrong)})"


def transaction_checks(settings: Settings) -> list[Check]:
    begin, end = "transaction_begin_date", "transaction_end_date"
    early, later = P.before(K.PERIOD_UNITS_ENFORCED), P.since(K.PERIOD_UNITS_ENFORCED)
    standardized = P.since(K.PERIOD_STANDARDIZED)
    metered = f"{standardized} AND {METERED}"
    cutover = f"DATE'{K.BOOKED_OUT_CUTOVER}'"

    def over(rule_id: str, unit: str) -> Check:
        limit = K.PRICE_LIMITS[unit]
        test = f"{P.known('rate_units', [unit])} AND abs(price) > {limit}D"
        return Check(rule_id, WARNING, "T4", f"price is outside {limit} {unit}", test, "price")

    return [
        Check("tx_complete", ERROR, "T1", "transaction data is incomplete",
              P.any_missing("transaction_unique_id", "product_name", "transaction_quantity", "price")),
        wrong_units("F.17.2.1", WARNING, early, [K.ENERGY, K.BOOKED_OUT], K.POWER_UNITS),
        wrong_units("F.17.2.2", ERROR, later, [K.ENERGY, K.BOOKED_OUT], K.POWER_UNITS),
        wrong_units("F.17.4.1", WARNING, early, [K.CAPACITY], K.ENERGY_UNITS),
        wrong_units("F.17.4.2", ERROR, later, [K.CAPACITY], K.ENERGY_UNITS),
        over("F.17.8.1", "$/MWH"),
        over("F.17.8.2", "$/KWH"),
        over("F.17.8.3", "CENTS/KWH"),
        required("F.24.1", "transaction_unique_id"),
        Check("F.24.3", ERROR, "T4", "end date is not after begin date", ends_too_early(), end),
        Check("F.24.4", ERROR, "T4", "end date is missing or after the filing period",
              f"{end} IS NULL OR {end} > {P.period_end()}", end),
        Check("F.24.5", ERROR, "T4", "begin date is missing or before the filing period",
              f"{begin} IS NULL OR {begin} < {P.period_start()}", begin),
        Check("F.24.6", ERROR, "T4", "total charge does not follow from price and quantity", charge_is_off(),
              "total_transaction_charge"),
        required("F.25.1", "transaction_unique_id", XSD),
        Check("F.25.14.1", WARNING, "T4", "quantity is zero or missing",
              f"coalesce(transaction_quantity, 0D) = 0 AND {begin} < {cutover}"),
        Check("F.25.15", ERROR, "T4", "quantity and total charge are both zero",
              f"transaction_quantity = 0 AND total_transaction_charge = 0 AND {begin} > {cutover}"),
        present("F.25.19", "trade_date", standardized, WARNING),
        present("F.25.20", "standardized_price", metered, WARNING),
        present("F.25.21", "type_of_rate", standardized, WARNING),
        present("F.25.24", "standardized_quantity", metered, WARNING),
        Check("F.25.21.2", WARNING, "T4", "quantity is zero or negative", "transaction_quantity <= 0",
              "transaction_quantity"),
        Check("F.30.46", ERROR, "T4", "units are not standard although quantities are equal",
              units_not_standard("transaction_quantity", "standardized_quantity"), "rate_units"),
        Check("F.30.47", ERROR, "T4", "units are not standard although prices are equal",
              units_not_standard("price", "standardized_price"), "rate_units"),
        required("F.30.48", POD_LOCATION),
        present("F.TYPE_PRICE", "price"),
    ]


# --- lookups ----------------------------------------------------------------------------------

# rule id, table, column, lookup name, severity, a blank value is a violation as well
LOOKUP_RULES = [
    ("F.23.1.1", "contracts", "class_name", "class", ERROR, True),
    ("F.23.1.2", "contracts", "term_name", "term", ERROR, True),
    ("F.23.1.3", "contracts", "increment_name", "increment", ERROR, True),
    ("F.23.1.4", "contracts", "increment_peaking_name", "peaking", ERROR, True),
    ("F.23.1.5", "contracts", "product_type_name", "product_type", ERROR, True),
    ("F.23.1.6", "contracts", "product_name", "product", ERROR, True),
    ("F.23.3", "contracts", "units", "unit", XSD, False),
    ("F.23.5", "contracts", "rate_units", "rate_unit", XSD, False),
    ("F.23.7", "contracts", "porba", "authority", XSD, False),
    ("F.23.9", "contracts", "podba", "authority", XSD, False),
    ("F.30.41.2", "contracts", "ferc_tariff_reference", "tariff", WARNING, False),
    ("F.25.2.1", "transactions", "class_name", "class", ERROR, True),
    ("F.25.2.2", "transactions", "term_name", "term", ERROR, True),
    ("F.25.2.3", "transactions", "increment_name", "increment", ERROR, True),
    ("F.25.2.4", "transactions", "increment_peaking_name", "peaking", ERROR, True),
    ("F.25.2.5", "transactions", "product_name", "product", ERROR, True),
    ("F.25.2.6", "transactions", "rate_units", "rate_unit", ERROR, True),
    ("F.25.2.7", "transactions", "time_zone", "time_zone", ERROR, True),
    ("F.25.2.8", "transactions", "point_of_delivery_balancing_authority", "authority", ERROR, True),
]


def lookup_groups(settings: Settings) -> tuple[dict[str, list[Check]], list[Group]]:
    """Lookup rules. A short list is tested in the row scan; a long table is anti-joined."""
    in_scan: dict[str, list[Check]] = {"contracts": [], "transactions": []}
    joined: list[Group] = []
    for rule_id, table, name, lookup, severity, blank_violates in LOOKUP_RULES:
        template = "T1+T3" if blank_violates else "T3"
        text = f"{name} is missing or unknown" if blank_violates else f"{name} is unknown"
        if lookup in settings.lookup_tables:
            values = settings.lookup_tables[lookup]
            test = "true" if blank_violates else f"{name} IS NOT NULL"
            joined.append(JoinGroup(
                f"lookup_{rule_id}", table,
                lambda ctx, values=values: values.selectExpr("upper(trim(value)) AS value").distinct(),
                {"value": P.norm(name)}, "left_anti", [Check(rule_id, severity, template, text, test, name)],
            ))
        else:
            test = P.unknown(name, settings.values(lookup))
            if blank_violates:
                test = f"{P.blank(name)} OR {test}"
            in_scan[table].append(Check(rule_id, severity, template, text, test, name))
    return in_scan, joined


Known = Callable[[str], str]
POD_AUTHORITY, POD_LOCATION, POD_HUB = (
    "point_of_delivery_balancing_authority", "point_of_delivery_specific_location", "point_of_delivery_hub",
)


def membership(settings: Settings, lookup: str, table: str, columns: list[str]) -> tuple[Frame, Known]:
    """Rows of a table, and the text that tells whether a column's value is in the lookup; never null.

    A list is tested in place. A lookup kept as a table is joined, one column after the other, and leaves flags.
    """
    values = settings.lookup_tables.get(lookup)
    if values is None:
        listed = settings.values(lookup)
        return (lambda ctx: ctx.table(table)), (lambda name: P.surely(P.known(name, listed)))

    def frame(ctx: FilingContext) -> DataFrame:
        rows, known = ctx.table(table), values.selectExpr("upper(trim(value)) AS value").dropna().distinct()
        for name in columns:
            found = known.select(F.col("value").alias(f"_{name}"))
            rows = rows.join(found, F.expr(f"{P.norm(name)} = _{name}"), "left")
            rows = rows.withColumn(f"known_{name}", F.col(f"_{name}").isNotNull()).drop(f"_{name}")
        return rows.withColumn("record_id", F.expr(RECORD_ID[table]))

    return frame, (lambda name: f"known_{name}")


def contract_hub_checks(known: Known) -> list[Check]:
    def unknown_location(rule_id: str, authority: str, location: str) -> Check:
        test = f"{P.norm(authority)} = 'HUB' AND {location} IS NOT NULL AND NOT {known(location)}"
        return Check(rule_id, ERROR, "T3", f"{location} is no known hub", test, location)

    def no_hub(authority: str, location: str) -> str:
        return f"({P.norm(authority)} = 'HUB' AND NOT {known(location)})"

    conflict = [P.both_set("podsl", "podsl_hub"), P.both_set("porsl", "porsl_hub"), no_hub("podba", "podsl_hub"), no_hub("porba", "porsl_hub")]
    return [
        unknown_location("F.23.8", "porba", "porsl"),
        unknown_location("F.23.10", "podba", "podsl"),
        Check("F.23.23", ERROR, "T4", "location and hub conflict", " OR ".join(conflict)),
    ]


def transaction_hub_checks(known: Known) -> list[Check]:
    """F.25.3 asks for a non-empty value, so a blank location violates it."""
    at_hub = f"{P.norm(POD_AUTHORITY)} = 'HUB'"
    return [
        Check("F.25.3", ERROR, "T3", f"{POD_LOCATION} is no known hub", f"{at_hub} AND NOT {known(POD_LOCATION)}", POD_LOCATION),
        Check("F.25.25", ERROR, "T4", "delivery location and hub conflict",
              f"{P.both_set(POD_LOCATION, POD_HUB)} OR ({at_hub} AND NOT {known(POD_HUB)})"),
    ]


def operator_checks(known: Known) -> list[Check]:
    booked_out = f"{P.known('product_name', [K.BOOKED_OUT])} AND {known('customer_company_name')}"
    return [Check("F.25.13.2", ERROR, "T3", "booked out power sold to a market operator",
                  f"{booked_out} AND transaction_begin_date >= DATE'{K.BOOKED_OUT_CUTOVER}'", "customer_company_name")]


def membership_groups(settings: Settings, in_table: bool) -> list[DerivedGroup]:
    """Rules on hubs and market operators whose lookup is kept as a table, or those whose lookup is a list."""
    specs = [
        ("hub", "contracts", ["porsl", "podsl", "podsl_hub", "porsl_hub"], contract_hub_checks),
        ("hub", "transactions", [POD_LOCATION, POD_HUB], transaction_hub_checks),
        ("iso", "transactions", ["customer_company_name"], operator_checks),
    ]
    groups = []
    for lookup, table, columns, checks in specs:
        if (lookup in settings.lookup_tables) == in_table:
            frame, known = membership(settings, lookup, table, columns)
            groups.append(DerivedGroup(f"{lookup}_{table}", RECORD_TYPE[table], frame, checks(known), table))
    return groups


# --- checks per filing or per other subject ---------------------------------------------------


def ident_per_filing(ctx: FilingContext) -> DataFrame:
    """Counts of identity rows per filing, zero for a filing that has none.

    Headers and everything counted meet in one aggregate, which combines on the map side.
    """
    role, ident = "upper(trim(role))", ctx.table("ident")
    tests = {
        "n_seller": P.is_seller(), "n_agent": P.is_agent(), "n_fa1": "filer_unique_id = 'FA1'",
        "n_seller_role": f"{role} = 'SELLER'", "n_agent_role": f"{role} = 'AGENT'",
        "n_other_role": f"NOT {P.surely(role + ' IN (' + P.listed(['SELLER', 'AGENT']) + ')')}",
        "n_organizations": "company_name IS NOT NULL", "n_content": "true", "n_registered": "true",
    }

    def part(rows: DataFrame, *names: str, header: str = "CAST(null AS STRING)") -> DataFrame:
        counted = [f"{f'CAST({tests[n]} AS INT)' if n in names else '0'} AS {n}" for n in tests]
        return rows.selectExpr(*FILING_KEYS, f"{header} AS filing_type", *counted)

    registered = ident.join(ctx.table("contacts").select("cid", "contact_name").distinct(), ["cid", "contact_name"], "left_semi")
    merged = part(ctx.filings, header="filing_type")
    for other in (
        part(ident, *list(tests)[:6]), part(ident.select(*FILING_KEYS, "company_name").distinct(), "n_organizations"),
        part(ctx.table("contracts"), "n_content"), part(ctx.table("transactions"), "n_content"), part(registered, "n_registered"),
    ):
        merged = merged.unionByName(other)
    counts = [F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in tests]
    return merged.groupBy(*FILING_KEYS).agg(F.max("filing_type").alias("filing_type"), *counts).selectExpr("*", "cid AS record_id")


def per_filing_checks() -> list[Check]:
    deleted = "filing_type = 'Delete'"
    return [
        Check("F.16.3", ERROR, "T7", "needs a seller row and an agent row", "n_seller < 1 OR n_agent < 1"),
        Check("F.16.12.1", WARNING, "T7", "needs exactly one FA1 row", "n_fa1 <> 1", "n_fa1"),
        Check("F.16.12.2", ERROR, "T7", "needs exactly one FA1 row", "n_fa1 <> 1", "n_fa1"),
        Check("F.16.14.1", ERROR, "T7", "needs exactly one seller", "n_seller <> 1", "n_seller"),
        Check("F.16.16.3", ERROR, "T5", "has no registered contact", "n_registered = 0"),
        Check("F.16.20.2", ERROR, "T7", "deleting filing lacks filer or seller",
              f"{deleted} AND (n_seller_role < 1 OR n_agent_role < 1)"),
        Check("F.16.20.3", ERROR, "T7", "deleting filing lists more than two organizations",
              f"{deleted} AND n_organizations > 2", "n_organizations"),
        Check("F.16.20.4", ERROR, "T7", "deleting filing lists more than seller and filer",
              f"{deleted} AND (n_other_role > 0 OR n_content > 0)"),
        Check("F.16.23.1", ERROR, "T7", "needs a seller role and an agent role",
              "n_seller_role < 1 OR n_agent_role < 1"),
        Check("F.31.02", ERROR, "T7", "needs exactly one agent contact", "n_agent <> 1", "n_agent"),
    ]


def contacts_per_seller(ctx: FilingContext) -> DataFrame:
    """Per seller of a filing: distinct contacts, and how many are registered."""
    people = ctx.table("ident").filter(P.is_seller()).select(*FILING_KEYS, "company_name", "contact_name").distinct()
    registered = ctx.table("contacts").select("cid", "contact_name").distinct().withColumn("known", F.lit(1))
    return (
        people.join(registered, ["cid", "contact_name"], "left")
        .groupBy(*FILING_KEYS, "company_name")
        .agg(F.count("contact_name").alias("n_contacts"), F.count("known").alias("n_known"))
        .withColumnRenamed("company_name", "record_id")
    )


def contracts_per_id(ctx: FilingContext) -> DataFrame:
    return (
        ctx.table("contracts").filter("contract_unique_id IS NOT NULL")
        .groupBy(*FILING_KEYS, "contract_unique_id")
        .agg(differs_within("customer_company_name").alias("buyers_differ"),
             differs_within("seller_company_name").alias("sellers_differ"))
        .withColumnRenamed("contract_unique_id", "record_id")
    )


def contract_sizes(ctx: FilingContext) -> DataFrame:
    per_contract = ctx.table("contracts").groupBy(*FILING_KEYS, "contract_unique_id").agg(F.count(F.lit(1)).alias("n"))
    return (
        per_contract.groupBy(*FILING_KEYS)
        .agg(F.count("contract_unique_id").alias("n_contracts"), F.sum("n").alias("n_products"),
             F.max(F.when(F.col("contract_unique_id").isNotNull(), F.col("n"))).alias("max_products"))
        .selectExpr("*", "cid AS record_id")
    )


def tariff_kinds_per_seller(ctx: FilingContext) -> DataFrame:
    kinds = ctx.table("contracts").selectExpr("*", f"{NPU} AS npu")
    return (
        kinds.groupBy(*FILING_KEYS, "seller_company_name").agg(differs_within("npu").alias("mixed"))
        .withColumnRenamed("seller_company_name", "record_id")
    )


def operator_sales(settings: Settings, booked_out_too: bool = True):
    """Average hours per market operator that buys: energy sales (class BA left out) of a seller to
    itself and, unless switched off, booked out power. The wording allows both readings.
    """
    energy = f"{P.known('product_name', [K.ENERGY])} AND NOT {P.surely(P.known('class_name', ['BA']))}"
    wanted = f"({energy} AND seller_company_name = customer_company_name)"
    if booked_out_too:
        wanted += f" OR {P.known('product_name', [K.BOOKED_OUT])}"
    seconds = "unix_seconds(CAST({0} AS TIMESTAMP))"
    hours = f"({seconds.format('transaction_end_date')} - {seconds.format('transaction_begin_date')}) / 3600.0D"

    rows_with_flags, known = membership(settings, "iso", "transactions", ["customer_company_name"])

    def frame(ctx: FilingContext) -> DataFrame:
        rows = rows_with_flags(ctx)
        return (
            rows.filter(f"({wanted}) AND {known('customer_company_name')}")
            .groupBy(*FILING_KEYS, "customer_company_name").agg(F.expr(f"avg({hours}) AS avg_hours"))
            .withColumnRenamed("customer_company_name", "record_id")
        )

    return frame


def changed_publishers(ctx: FilingContext) -> DataFrame:
    """Filings whose appended index rows name other publishers than the original."""
    rows = ctx.table("index").selectExpr("*", "coalesce(lower(filing_type) = 'append', false) AS appended")
    different = set_difference_keys(rows, FILING_KEYS, ["publisher", "publication"], ~F.col("appended"), F.col("appended"))
    return different.selectExpr("*", "cid AS record_id")


def contacts_with_other_role(ctx: FilingContext) -> DataFrame:
    """Registered contacts that act in a role they are not registered for."""
    contacts = ctx.table("contacts")
    known = contacts.select("cid", "contact_name").distinct()
    roles = contacts.select("cid", "contact_name", "role").distinct()
    rows = ctx.table("ident").join(known, ["cid", "contact_name"], "left_semi")
    return rows.join(roles, ["cid", "contact_name", "role"], "left_anti").selectExpr("*", "filer_unique_id AS record_id")


def tariff_not_found(ctx: FilingContext) -> DataFrame:
    """Contracts of sellers that have tariffs, but not the one named."""
    tariffs = ctx.table("tariffs")
    rows = ctx.table("contracts").join(tariffs.select("cid").distinct(), "cid", "left_semi")
    named = tariffs.select("cid", "ferc_tariff_reference").distinct()
    return rows.join(named, ["cid", "ferc_tariff_reference"], "left_anti").selectExpr("*", "contract_unique_id AS record_id")


# --- right sides of join rules ----------------------------------------------------------------

CONTRACT_KEYS = [*FILING_KEYS, "contract_unique_id"]


def distinct_of(table: str, *columns: str, where: str = "true") -> KeyFacts:
    return KeyFacts(table, {c: c for c in columns}, where)


# A filing has one header; its type as flags, since an aggregate over texts would sort the rows it counts.
HEADER_TYPES = KeyFacts("filings", {k: k for k in FILING_KEYS}, facts={
    f"header_{kind.lower()}": ("any", f"filing_type = '{kind}'") for kind in ("New", "Replace", "Delete")})

# One row per contract of a filing: is it new, is it recent, when does its first term end.
CONTRACT_FACTS = KeyFacts("contracts", {k: k for k in CONTRACT_KEYS}, "contract_unique_id IS NOT NULL", {
    "is_new": ("any", "filing_type = 'New'"),
    "is_recent": ("any", f"contract_execution_date >= DATE'{K.STANDARDIZED_SINCE}'"),
    "first_termination": ("first", "termination_date"),
})

# Per tariff, its last end date, and whether a version is open.
TARIFF_ENDS = KeyFacts("tariffs", {c: c for c in ("cid", "ferc_tariff_reference")}, facts={
    "open": ("any", "tariff_end IS NULL"), "tariff_end": ("last", "tariff_end")})

ROLES = KeyFacts("registry", {"cid": "cid"}, facts={"fits": ("any", "lower(role) IN ('agent', 'account manager')")})


def authorized_products() -> KeyFacts:
    """(filing, agreement, product) a transaction may carry. Booked out power is covered by an
    energy or capacity contract and not by one of its own name."""
    product, booked_out = P.norm("product_name"), P.lit(K.BOOKED_OUT)
    keys = {**{k: k for k in FILING_KEYS}, "agreement": "contract_service_agreement_id"}
    covers = f"{product} IN ({P.listed([K.ENERGY, K.CAPACITY])})"
    return KeyFacts("contracts", {**keys, "product": product}, f"{product} <> {booked_out}", also=((covers, {**keys, "product": booked_out}),))


def join_groups() -> list[Group]:
    filing = {"cid": "cid", "period": "period"}
    contract = {**filing, "contract_unique_id": "contract_unique_id"}
    not_new = "filing_type <> 'New'"
    groups: list[Group] = []

    # Filing types of the components against the header, and contract facts: one join per table
    # and key serves all rules that need it.
    def by_header(rule_id: str, header: str, text: str, test: str | None) -> Check:
        return Check(rule_id, ERROR, "T8", text, test, "filing_type", f"r_header_{header.lower()}")

    for table in ("contracts", "transactions"):
        groups.append(JoinGroup(f"header_{table}", table, HEADER_TYPES, filing, "inner", [
            by_header("D.3.9.1", "New", "new filing holds another filing type", not_new),
            by_header("F.16.18", "New", "new filing holds another filing type", not_new),
            by_header("D.3.9.2", "Replace", "replacing filing holds another type than New", not_new),
            by_header("F.16.19", "Replace", "replacing filing holds another type than New", not_new),
            by_header("D.3.9.3", "Delete", "deleting filing holds data", None),
            by_header("F.16.20.1", "Delete", "deleting filing holds data", None),
        ]))

    def recent(rule_id: str, name: str, gate: str = "true") -> Check:
        return replace(present(rule_id, name, gate, template="T10"), partner="r_is_recent")

    groups += [
        JoinGroup("contract_facts", "transactions", CONTRACT_FACTS, contract, "inner", [
            Check("D.3.9.6", ERROR, "T8", "new contract has a transaction of another type", not_new, "filing_type",
                  "r_is_new"),
            Check("F.23.21.2", WARNING, "T10", "transaction ends after its contract", None, "transaction_end_date",
                  "r_first_termination < l_end"),
            recent("F.30.42", "trade_date"),
            recent("F.30.43", "type_of_rate"),
            recent("F.30.44", "standardized_price", METERED),
            recent("F.30.45", "standardized_quantity", METERED),
        ], carry={"end": "transaction_end_date"}),
        JoinGroup("deleted_contract", "contracts", distinct_of("transactions", *CONTRACT_KEYS), contract, "left_semi", [
            Check("D.3.9.8", ERROR, "T8", "deleted contract has transactions", "filing_type = 'Delete'")]),
    ]

    # Names and identifiers against the versions of the company registry.
    versions = distinct_of("registry", "cid", "legal_name", "effective_start", "effective_end")
    first_day, last_day = P.period_start("period"), P.period_end("period")
    at_end, during = {"during": (last_day, last_day)}, {"during": (first_day, last_day)}
    ident_name = {"cid": "cid", "legal_name": "company_name"}
    seller_name = {"cid": "cid", "legal_name": "seller_company_name"}
    groups += [
        JoinGroup("ident_name", "ident", versions, ident_name, "left_anti", [
            Check("F.16.3.1", ERROR, "T5", "company name is not registered", None, "company_name")]),
        JoinGroup("contract_seller_name", "contracts", versions, seller_name, "left_anti", [
            Check("F.16.3.2", ERROR, "T5", "seller name is not registered", None, "seller_company_name")]),
        JoinGroup("ident_name_at_end", "ident", versions, ident_name, "left_anti", [
            Check("F.16.3.4", ERROR, "T5", "company name was not valid at the end of the period", P.is_seller(),
                  "company_name")], **at_end),
        JoinGroup("contract_seller_name_during", "contracts", versions, seller_name, "left_anti", [
            Check("F.16.3.5", ERROR, "T5", "seller name was not valid during the period", None,
                  "seller_company_name")], **during),
        JoinGroup("ident_cid", "ident", versions, {"cid": "cid"}, "left_anti", [
            Check("F.16.26", ERROR, "T5", "company identifier was not valid during the period",
                  f"{P.is_seller()} OR {P.is_agent()}", "company_identifier")], **during),
        JoinGroup("contract_cid", "contracts", versions, {"cid": "seller_cid"}, "left_anti", [
            Check("F.21.2.2", ERROR, "T5", "seller identifier was not valid during the period", None, "seller_cid")],
            **during),
        JoinGroup("buyer_cid", "contracts", versions, {"cid": "customer_cid"}, "left_anti", [
            Check("F.21.3.3", ERROR, "T5", "buyer identifier was not valid during the period",
                  "customer_cid IS NOT NULL", "customer_cid")], **during),
        JoinGroup("not_public", "contracts", distinct_of("registry", "cid", where="is_npu"), {"cid": "seller_cid"},
                  "left_anti", [Check("F.30.41.1", WARNING, "T5", "seller is not registered as non-public utility",
                                      NPU, "seller_company_name")]),
    ]

    groups.append(JoinGroup("seller_role", "ident", ROLES, {"cid": "cid"}, "inner", [
        Check("F.31.01", WARNING, "T5", "seller is no agent or account manager in the registry", P.is_seller(),
              partner="NOT coalesce(r_fits, false)")]))

    # Contact and tariff registries.
    tariff = {"cid": "cid", "ferc_tariff_reference": "ferc_tariff_reference"}
    groups += [
        JoinGroup("contacts", "ident", distinct_of("contacts", "cid", "contact_name"),
                  {"cid": "cid", "contact_name": "contact_name"}, "left_anti", [
                      Check("F.16.13.1", ERROR, "T5", "agent contact is not registered", P.is_agent(), "contact_name"),
                      Check("F.16.14.5", ERROR, "T5", "seller contact is not registered", P.is_seller(), "contact_name")]),
        JoinGroup("tariff_seller", "contracts", distinct_of("tariffs", "cid"), {"cid": "cid"}, "left_anti", [
            Check("F.20.19", ERROR, "T5", "seller has no tariff", f"NOT {P.surely(NPU)}", "ferc_tariff_reference")]),
        JoinGroup("tariff_expired", "contracts", TARIFF_ENDS, tariff, "left_semi", [
            Check("F.20.20", WARNING, "T5", "tariff expired before the end of the period", None,
                  "ferc_tariff_reference")], f"NOT r_open AND r_tariff_end < {P.period_end('l_period')}", {"period": "period"}),
    ]

    # References between the tables of a filing.
    lists_index = distinct_of("index", *FILING_KEYS)
    seller, reports = P.is_seller(), P.says_yes("report_to_index")
    groups += [
        JoinGroup("submitter", "filings", distinct_of("ident", *FILING_KEYS, "contact_name", where=P.is_agent()),
                  {**filing, "contact_name": "submitter_name"}, "left_anti", [
                      Check("F.17.5", ERROR, "T9", "submitter is no agent of the filing", None, "submitter_name")]),
        JoinGroup("index_missing", "ident", lists_index, filing, "left_anti", [
            Check("F.16.27.1", ERROR, "T9", "reports to an index but lists none", reports)]),
        JoinGroup("index_unannounced", "ident", lists_index, filing, "left_semi", [
            Check("F.16.27.4", ERROR, "T9", "lists an index but does not report to one", f"{seller} AND NOT {reports}")]),
        JoinGroup("index_owner", "index", distinct_of("ident", *FILING_KEYS, "filer_unique_id", where=seller),
                  {**filing, "filer_unique_id": "filer_unique_id"}, "left_anti", [
                      Check("F.16.27.3", ERROR, "T9", "only a seller may list an index", None, "filer_unique_id")]),
        JoinGroup("contract_seller", "contracts", distinct_of("ident", *FILING_KEYS, "company_name", where=seller),
                  {**filing, "company_name": "seller_company_name"}, "left_anti", [
                      Check("F.21.2.1", ERROR, "T9", "seller is not part of the filing", None, "seller_company_name")]),
        JoinGroup("customer", "transactions", distinct_of("contracts", *FILING_KEYS, "customer_company_name"),
                  {**filing, "customer_company_name": "customer_company_name"}, "left_anti", [
                      Check("F.21.3.1", ERROR, "T9", "customer has no contract", None, "customer_company_name")]),
        JoinGroup("authorized_product", "transactions", authorized_products(),
                  {**filing, "agreement": "contract_service_agreement", "product": P.norm("product_name")},
                  "left_anti", [Check("F.25.18", ERROR, "T9", "no contract authorizes the product",
                                      P.since(K.PERIOD_STANDARDIZED), "product_name")]),
    ]
    return groups


IDENT_FIELDS = ["filer_unique_id", "company_name", "company_identifier", "contact_name", "contact_title", "address",
                "city", "state", "zip", "country", "phone", "email", "report_to_index"]
TRANSACTION_VALUES = [
    "transaction_begin_date", "transaction_end_date", "contract_service_agreement", "seller_company_name",
    "customer_company_name", "product_name", "rate_units", "class_name", "term_name", "increment_name",
    "increment_peaking_name", "time_zone", "point_of_delivery_balancing_authority",
    "point_of_delivery_specific_location", "ferc_tariff_reference", "type_of_rate", "trade_date",
    "transaction_quantity", "price", "standardized_price", "standardized_quantity", "total_transaction_charge",
    "total_transmission_charge",
]


def duplicate_groups() -> list[Group]:
    def dup(rule_id: str, severity: str, what: str) -> Check:
        return Check(rule_id, severity, "T6", f"duplicate {what}")

    return [
        DuplicateGroup("ident", IDENT_FIELDS, [dup("F.16.4.1", ERROR, "identity row")]),
        DuplicateGroup("ident", ["filer_unique_id"], [dup("F.16.4.2", ERROR, "filer identifier"),
                                                      dup("F.16.25", XSD, "identifier")]),
        DuplicateGroup("ident", ["company_name"], [dup("F.16.5", ERROR, "seller"), dup("F.16.6", ERROR, "seller")],
                       P.is_seller()),
        DuplicateGroup("contracts", ["contract_unique_id"], [dup("F.16.25", XSD, "identifier"),
                                                             dup("F.20.23", XSD, "contract identifier")]),
        DuplicateGroup("contracts", ["seller_company_name", "customer_company_name", "ferc_tariff_reference",
                                     "contract_service_agreement_id"], [dup("F.21.31", ERROR, "contract")]),
        DuplicateGroup("transactions", ["transaction_unique_id"], [
            dup("F.16.25", XSD, "identifier"), dup("F.24.15.1", XSD, "transaction identifier"),
            dup("F.UNIQUE_TX", ERROR, "transaction identifier")]),
        DuplicateGroup("transactions", TRANSACTION_VALUES, [dup("F.25.17.2", WARNING, "transaction data")]),
    ]


def known_but_not(table: str, right: str, group: list[str], member: str, check: Check) -> tuple[tuple[int, JoinGroup], ...]:
    """Rows whose group is known less those whose member is known too, which are some of the former."""
    keys = [group, [*group, member]]
    return tuple((sign, JoinGroup(f"{right}_{len(k)}", table, distinct_of(right, *k), {c: c for c in k}, "left_semi", [check])) for sign, k in zip((1, -1), keys))


def derived_groups(settings: Settings) -> list[Group]:
    other_role = Check("F.16.21", ERROR, "T5", "contact acts in an unregistered role", None, "role")
    no_tariff = Check("F.20.21", ERROR, "T5", "tariff is not registered for the seller", None, "ferc_tariff_reference")
    too_large = (
        f"n_contracts > {settings.max_contracts} OR n_products > {settings.max_products}"
        f" OR max_products > {settings.max_products_per_contract}"
    )
    return [
        DerivedGroup("ident_per_filing", "filing", ident_per_filing, per_filing_checks(), reads={
            "ident": ["role", "filer_unique_id", "company_name", "contact_name"], "contacts": ["cid", "contact_name"],
            "contracts": [], "transactions": [], "filings": []}),
        DerivedGroup("contacts_per_seller", "identity", contacts_per_seller, [
            Check("F.16.14.2", ERROR, "T7", "seller needs exactly one contact", "n_contacts <> 1", "n_contacts"),
            Check("F.16.14.4", ERROR, "T5", "seller has no registered contact", "n_known = 0")],
            reads={"ident": ["filer_unique_id", "company_name", "contact_name"], "contacts": ["cid", "contact_name"]}),
        DerivedGroup("contract_parties", "contract", contracts_per_id, [
            Check("F.20.11", XSD, "T12", "contract has several buyers or sellers", "buyers_differ OR sellers_differ")],
            reads={"contracts": ["contract_unique_id", "customer_company_name", "seller_company_name"]}),
        DerivedGroup("contract_sizes", "filing", contract_sizes, [
            Check("F.21.32", ERROR, "T12", "filing exceeds a size limit", too_large, "n_products")], reads={"contracts": ["contract_unique_id"]}),
        DerivedGroup("tariff_kinds", "contract", tariff_kinds_per_seller, [
            Check("F.30.41.3", WARNING, "T12", "seller is both public and non-public", "mixed")],
            reads={"contracts": ["seller_company_name", "ferc_tariff_reference"]}),
        DerivedGroup("operator_sales", "transaction", operator_sales(settings), [
            Check("F.25.16", ERROR, "T12", "sales to a market operator look aggregated",
                  f"avg_hours > {K.MAX_AVERAGE_HOURS}D", "avg_hours")], reads={"transactions": [
                "product_name", "class_name", "seller_company_name", "customer_company_name", "transaction_begin_date", "transaction_end_date"]}),
        DerivedGroup("publishers", "index", changed_publishers, [
            Check("F.16.27.5", ERROR, "T13", "appended index publishers differ from the original")]),
        DerivedGroup("contact_role", "identity", contacts_with_other_role, [other_role],
                     counted=known_but_not("ident", "contacts", ["cid", "contact_name"], "role", other_role),
                     reads={"ident": ["contact_name", "role", "filer_unique_id"], "contacts": ["cid", "contact_name", "role"]}),
        DerivedGroup("tariff_reference", "contract", tariff_not_found, [no_tariff],
                     counted=known_but_not("contracts", "tariffs", ["cid"], "ferc_tariff_reference", no_tariff),
                     reads={"contracts": ["ferc_tariff_reference", "contract_unique_id"], "tariffs": ["cid", "ferc_tariff_reference"]}),
    ]


def catalogue(settings: Settings) -> list[Group]:
    """All rules. F.16.1 (acceptance) is a result of the others: see ``operators.results.acceptance``."""
    in_scan, looked_up = lookup_groups(settings)
    in_rows: dict[str, list[Check]] = {"contracts": [], "transactions": []}
    for group in membership_groups(settings, in_table=False):
        in_rows[group.table].extend(group.checks)
    return [
        RowGroup("ident", ident_checks()),
        RowGroup("filings", filing_checks(settings)),
        RowGroup("contracts", contract_checks(settings) + in_scan["contracts"] + in_rows["contracts"]),
        RowGroup("index", [required("F.16.28", "transactions_reported")]),
        RowGroup("transactions", transaction_checks(settings) + in_scan["transactions"] + in_rows["transactions"]),
        *looked_up,
        *join_groups(),
        *membership_groups(settings, in_table=True),
        *duplicate_groups(),
        *derived_groups(settings),
    ]


def catalogue_frame(spark: SparkSession, groups: list[Group]) -> DataFrame:
    """The catalogue as data: order, id, text, severity, template, table, test, category and stage."""
    seen: dict[str, tuple] = {}
    for group in groups:
        for c in (c for c in group.checks if not c.guards):
            seen.setdefault(c.rule_id, (len(seen), c.rule_id, c.text, c.severity, c.template, group.table, c.test))
    schema = "seq int, rule_id string, description string, severity string, template string, source_table string, test string"
    frame = spark.createDataFrame(list(seen.values()), schema)
    return frame.withColumn("category", category(F.col("rule_id"), F.col("severity"))).withColumn(
        "stage", stage(F.col("category"))
    )
