"""Quarter strings. The canonical spelling is ``2025Q1``; ``2025-Q1`` is accepted."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def canonical_period(text: Column) -> Column:
    """``2025-Q1`` or ``2025q1`` to ``2025Q1``; null when it is no quarter."""
    cleaned = F.upper(F.replace(F.trim(text), F.lit("-"), F.lit("")))
    return F.when(cleaned.rlike("^[0-9]{4}Q[1-4]$"), cleaned)


def dashed_period(period: Column) -> Column:
    return F.concat(F.substring(period, 1, 4), F.lit("-"), F.substring(period, 5, 2))


def period_of(day: Column) -> Column:
    """Quarter in which a date lies."""
    return F.concat(F.year(day).cast("string"), F.lit("Q"), F.quarter(day).cast("string"))


def _ordinal(period: Column) -> Column:
    year = F.substring(period, 1, 4).try_cast("int")
    quarter = F.substring(period, 6, 1).try_cast("int")
    return year, quarter


def period_start(period: Column) -> Column:
    year, quarter = _ordinal(period)
    return F.make_date(year, quarter * 3 - 2, F.lit(1))


def period_end(period: Column) -> Column:
    return F.last_day(F.add_months(period_start(period), 2))


def previous_period(period: Column) -> Column:
    return period_of(F.add_months(period_start(period), -3))


def applies(period: Column, valid_from: str | None = None, valid_before: str | None = None) -> Column:
    """Period gate; canonical quarters order like strings."""
    gate = F.lit(True)
    if valid_from is not None:
        gate = gate & (period >= F.lit(valid_from))
    if valid_before is not None:
        gate = gate & (period < F.lit(valid_before))
    return gate
