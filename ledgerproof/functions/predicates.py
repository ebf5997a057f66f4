"""Building blocks of rule tests, as Spark SQL text.

A test is TRUE for a violating row; NULL is no violation. Text instead of Column objects, because a
catalogue of many rules then reaches the JVM in one call per table and can be kept as data.
"""

from __future__ import annotations

from ledgerproof import constants as K


def lit(value: str) -> str:
    """A quoted string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def listed(values: list[str]) -> str:
    return ", ".join(lit(v.strip().upper()) for v in values)


def missing(name: str) -> str:
    return f"({name} IS NULL)"


def blank(name: str) -> str:
    """Null, empty or white space only."""
    return f"({name} IS NULL OR trim({name}) = '')"


def any_missing(*names: str) -> str:
    return "(" + " OR ".join(f"{n} IS NULL" for n in names) + ")"


def norm(name: str) -> str:
    """Upper-cased, trimmed text for comparison with fixed names."""
    return f"upper(trim({name}))"


def unknown(name: str, values: list[str]) -> str:
    """Present and outside the list."""
    if not values:
        return f"({name} IS NOT NULL)"
    return f"({name} IS NOT NULL AND {norm(name)} NOT IN ({listed(values)}))"


def known(name: str, values: list[str]) -> str:
    return f"({norm(name)} IN ({listed(values)}))" if values else "false"


def surely(test: str) -> str:
    """The test with NULL read as FALSE, for use under NOT."""
    return f"coalesce({test}, false)"


def on_or_before_floor(name: str) -> str:
    return f"(CAST({name} AS DATE) <= DATE'{K.DATE_FLOOR}')"


def not_matching(name: str, pattern: str) -> str:
    return f"({name} NOT RLIKE r'{pattern}')"


def is_seller(name: str = "filer_unique_id") -> str:
    return f"startswith({name}, '{K.SELLER_PREFIX}')"


def is_agent(name: str = "filer_unique_id") -> str:
    return f"startswith({name}, '{K.AGENT_PREFIX}')"


def says_yes(name: str) -> str:
    return surely(known(name, K.YES_VALUES))


def period_start(period: str = "period") -> str:
    return f"make_date(int(substr({period}, 1, 4)), int(substr({period}, 6, 1)) * 3 - 2, 1)"


def period_end(period: str = "period") -> str:
    return f"last_day(make_date(int(substr({period}, 1, 4)), int(substr({period}, 6, 1)) * 3, 1))"


def since(period: str) -> str:
    """Period gate; canonical quarters order like strings."""
    return f"(period >= '{period}')"


def before(period: str) -> str:
    return f"(period < '{period}')"


def off_by_more_than(expected: str, reported: str) -> str:
    """Difference beyond the larger of an absolute and a relative tolerance."""
    allowed = f"greatest({K.ABS_TOLERANCE}D, {K.REL_TOLERANCE}D * abs({expected}))"
    return f"(abs({expected} - {reported}) > {allowed})"


def both_set(a: str, b: str) -> str:
    return f"({a} IS NOT NULL AND {b} IS NOT NULL)"


def effective_at(day: str, start: str, end: str) -> str:
    """Validity interval with an open end when null."""
    return f"({start} <= {day} AND ({end} IS NULL OR {day} < {end}))"


def overlaps(first: str, last: str, start: str, end: str) -> str:
    """Valid on some day of [first, last]."""
    return f"({start} <= {last} AND ({end} IS NULL OR {end} > {first}))"
