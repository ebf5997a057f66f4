"""What a rule is. Rules that read the same rows are kept in one group and run as one plan.

Tests, keys and residual conditions are Spark SQL text (see ``functions.predicates``).
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, functions as F

from ledgerproof.context import FilingContext
from ledgerproof.functions.predicates import lit

Frame = Callable[[FilingContext], DataFrame]
#: How rows of one key merge into a fact: aggregate function and type.
FACTS = {"any": ("max", "boolean"), "first": ("min", "date"), "last": ("max", "date"), "text": ("max", "string")}


@dataclass(frozen=True)
class KeyFacts:
    """The partner side of a join as data: the keys that occur in a table, and merged facts about each.

    ``keys`` maps a name to an expression over the table's rows, ``facts`` a name to a kind of ``FACTS`` and an expression.
    ``also`` lists further (condition, keys) under which the same row gives another key. Called with a context it is the
    frame of distinct keys with their facts; being data, many of them can be read off one scan of their table.
    """

    table: str
    keys: dict[str, str]
    where: str = "true"
    facts: dict[str, tuple[str, str]] = field(default_factory=dict)
    also: tuple[tuple[str, dict[str, str]], ...] = ()

    def variants(self) -> list[tuple[str, dict[str, str]]]:
        return [(self.where, self.keys), *self.also]

    def __call__(self, ctx: FilingContext) -> DataFrame:
        rows = ctx.table(self.table)
        if self.also:
            structs = ", ".join(
                f"CASE WHEN {where} THEN named_struct({', '.join(f'{lit(n)}, {text}' for n, text in keys.items())}) END"
                for where, keys in self.variants()
            )
            rows = rows.selectExpr(f"explode(array_compact(array({structs}))) AS k").select("k.*")
        else:
            rows = rows.filter(self.where).selectExpr(
                *[f"{text} AS {n}" for n, text in self.keys.items()],
                *[f"CAST({text} AS {FACTS[kind][1]}) AS _{n}" for n, (kind, text) in self.facts.items()],
            )
        if not self.facts:
            return rows.distinct()
        merged = [F.expr(f"{FACTS[kind][0]}(_{n}) AS {n}") for n, (kind, _) in self.facts.items()]
        return rows.groupBy(*self.keys).agg(*merged)


@dataclass(frozen=True)
class Check:
    """One rule of a group. Without a test every row of the group's result violates it.

    ``test`` sees the columns of the row. ``partner``, for inner join groups only, is a further
    condition on the partner's columns (``r_<column>``) and the carried ones (``l_<name>``).
    """

    rule_id: str
    severity: str
    template: str
    text: str
    test: str | None = None
    show: str | None = None
    partner: str | None = None
    # The rule whose failing rows this check counts; such a check makes no violations.
    guards: str | None = None
    reason: str | None = None


@dataclass(frozen=True)
class RowGroup:
    """Checks that look at one row of a table: one scan for all of them."""

    table: str
    checks: list[Check]


@dataclass(frozen=True)
class DerivedGroup:
    """Checks over a frame of one row per subject (cid, period, record_id and what tests need)."""

    name: str
    record_type: str
    frame: Frame
    checks: list[Check]
    table: str | None = None
    # Join groups whose counts, added or taken away, are the count of the group's only check.
    counted: tuple[tuple[int, JoinGroup], ...] = ()
    # Columns of each table that the frame reads; None if that is not told.
    reads: dict[str, list[str]] | None = None


@dataclass(frozen=True)
class JoinGroup:
    """Checks on rows of a table that have (left_semi), or lack (left_anti), a partner, or whose one
    partner (inner, the right frame being unique on the keys) meets the ``partner`` condition. The
    last form lets rules that need the same key share one join.

    ``keys`` maps a column of the right frame to the left expression it must equal. ``residual`` is
    an extra condition over right columns, named ``r_<column>``, and the left expressions of
    ``carry``, named ``l_<name>``. ``during`` makes the partners versions: a row lacks one if no
    version of its key, valid from ``effective_start`` until before ``effective_end`` (open if
    null), reaches any day of the row's span (first and last day, over left columns).
    """

    name: str
    table: str
    right: Frame
    keys: dict[str, str]
    how: str
    checks: list[Check]
    residual: str | None = None
    carry: dict[str, str] = field(default_factory=dict)
    during: tuple[str, str] | None = None


@dataclass(frozen=True)
class DuplicateGroup:
    """Checks that a key occurs once per filing. Several columns compare null-safe."""

    table: str
    keys: list[str]
    checks: list[Check]
    where: str | None = None


Group = RowGroup | DerivedGroup | JoinGroup | DuplicateGroup


def words_read(groups: list[Group]) -> dict[str, set[str]] | None:
    """The words of the texts over each table, among them every column that the groups read; None if a group does not tell."""
    found: dict[str, set[str]] = {}

    def add(table: str, *texts: str | None) -> None:
        found.setdefault(table, set()).update(w.lower() for text in texts if text for w in re.findall(r"\w+", text))

    for group in groups:
        own = [text for c in group.checks for text in (c.test, c.show)]
        if isinstance(group, DerivedGroup):
            if group.reads is None:
                return None
            for table, columns in group.reads.items():
                add(table, *columns)
        elif isinstance(group, JoinGroup):
            if not isinstance(group.right, KeyFacts):
                return None
            add(group.table, *own, *group.keys.values(), *group.carry.values(), *(group.during or ()))
            facts = [text for _, text in group.right.facts.values()]
            add(group.right.table, *facts, *[text for where, keys in group.right.variants() for text in (where, *keys.values())])
        elif isinstance(group, DuplicateGroup):
            add(group.table, group.where, *group.keys, *own)
        else:
            add(group.table, *own)
    return found


def pick(groups: list[Group], rule_ids=None, templates=None, tables=None) -> list[Group]:
    """Subset of a catalogue by rule, template or table."""
    chosen = []
    for group in groups:
        if tables is not None and group.table not in tables:
            continue
        checks = [
            c
            for c in group.checks
            if (rule_ids is None or c.rule_id in rule_ids) and (templates is None or c.template in templates)
        ]
        if checks:
            chosen.append(replace(group, checks=checks))
    return chosen
