"""Fixed values. They must equal the published ones for results to agree."""

# Product names (compared upper-cased and trimmed).
ENERGY = "ENERGY"
CAPACITY = "CAPACITY"
BOOKED_OUT = "BOOKED OUT POWER"
METERED_PRODUCTS = [ENERGY, CAPACITY, BOOKED_OUT]

# Rate units (compared upper-cased and trimmed).
POWER_UNITS = ["$/MW", "$/KW"]
ENERGY_UNITS = ["$/MWH", "$/KWH"]
CENTS_UNITS = ["CENTS/KWH"]
STANDARD_UNITS = {
    ENERGY: ["$/MWH"],
    CAPACITY: ["$/MW-MONTH"],
    BOOKED_OUT: ["$/MWH", "$/MW-MONTH"],
}

# Price bounds per unit.
PRICE_LIMITS = {"$/MWH": 1000.0, "$/KWH": 1.0, "CENTS/KWH": 100.0}

# Dates and periods at which rules start or stop to apply.
DATE_FLOOR = "1900-01-01"
FIRST_FILING_DAY = "2002-01-01"
BOOKED_OUT_CUTOVER = "2006-10-01"
STANDARDIZED_SINCE = "2013-07-01"
PERIOD_UNITS_ENFORCED = "2005Q1"
PERIOD_EXECUTION_REQUIRED = "2004Q1"
PERIOD_STANDARDIZED = "2013Q3"

# Arithmetic tolerance: the larger of one dollar and one percent.
ABS_TOLERANCE = 1.0
REL_TOLERANCE = 0.01

# Size limits of one filing.
MAX_CONTRACTS = 30_000
MAX_PRODUCTS = 100_000
MAX_PRODUCTS_PER_CONTRACT = 40_000
MAX_BUYER_NAME = 70

# Average sale to a market operator may not exceed this many hours.
MAX_AVERAGE_HOURS = 3.0

# Threshold at which a rule gets a brief.
BRIEF_RATE = 0.025
BRIEF_COUNT = 5000
BRIEF_SAMPLES = 5

# Text patterns.
EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
ZIP_PATTERNS = {
    "US": r"^[0-9]{5}(-[0-9]{4})?$",
    "MX": r"^[0-9]{5}$",
    "GB": r"^[A-Za-z]{1,2}[0-9][A-Za-z0-9]? ?[0-9][A-Za-z]{2}$",
    "CA": r"^[A-Za-z][0-9][A-Za-z] ?[0-9][A-Za-z][0-9]$",
}
SELLER_PREFIX = "FS"
AGENT_PREFIX = "FA"
YES_VALUES = ["Y", "YES"]

# Category of a rule -> stage it runs in.
STAGE_OF_CATEGORY = {
    "SCHEMA": "Type 1",
    "STRUCTURAL": "Type 1",
    "MANDATORY": "Type 2",
    "LOOKUP": "Type 2",
    "IDENTITY": "Type 2",
    "REGISTRY": "Type 2",
    "ARITHMETIC": "Type 3",
    "CONSISTENCY": "Type 3",
    "CONDITIONAL": "Type 3",
    "DEDUP": "Type 3",
    "HISTORICAL": "Type 4",
    "BOUNDS": "Type 5",
    "AUDIT": "Type 5",
}
DEFAULT_STAGE = "Type 5"
STRUCTURAL_PREFIXES = ["F.16.4", "F.24.1", "F.TYPE"]
NO_AGREEMENT = "NONE (Agreement Missing)"  # fixed output text
