"""Spark-native validation of large tabular filings against a rule catalogue."""

from ledgerproof.context import FilingContext, Settings
from ledgerproof.plans.engine import validate
from ledgerproof.plans.catalogue import catalogue

__all__ = ["FilingContext", "Settings", "validate", "catalogue"]
