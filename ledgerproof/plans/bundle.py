"""Counts of many join rules from one scan per table and one keyed aggregate.

Every join rule asks the same of its rows: does the key occur on the other side, and with which facts? So each table is read
once; each of its rows becomes one entry for every rule group it takes part in, as the left side (which tests the row passes)
or as the partner (facts about the key). Entries carry the number of their group as part of the key. They are summed per
(group, key, filing) on the map side and after one shuffle; a window over (group, key) hands the partner's presence and facts
to the left entries; a last aggregate adds up per filing. The number of shuffles does not grow with the number of rules, and a
key with a third of all rows is one row per task.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from ledgerproof.context import FILING_KEYS, FilingContext
from ledgerproof.functions.predicates import lit
from ledgerproof.operators.intervals import covered
from ledgerproof.plans.rules import FACTS, Check, JoinGroup, KeyFacts

KEYS = [f"j{i}" for i in range(4)]
SLOTS = {f"{kind}{i}": FACTS[kind] for kind, i in (("any", 0), ("any", 1), ("any", 2), ("first", 0), ("last", 0), ("text", 0))}


def _test(check: Check) -> str:
    return "true" if check.test is None else f"({check.test})"


def _carried(group: JoinGroup) -> list[str]:
    return [n for n in group.carry if n != "period"]


def slots(right: KeyFacts) -> dict[str, str]:
    """Column that holds each fact."""
    used: dict[str, int] = {}
    out = {}
    for name, (kind, _) in right.facts.items():
        out[name] = f"{kind}{used.setdefault(kind, 0)}"
        used[kind] += 1
    return out


def used_slots(groups: list[JoinGroup]) -> dict[str, tuple[str, str]]:
    """The columns of facts that some group has. A text would make every aggregate sort its rows, so none is carried unasked."""
    wanted = {s for g in groups for s in slots(g.right).values()}
    return {s: kind for s, kind in SLOTS.items() if s in wanted}


def fits(group) -> bool:
    """Can the group's counts come from the bundle? The carried value, if any, must be a date."""
    return (
        isinstance(group, JoinGroup) and isinstance(group.right, KeyFacts) and group.during is None
        and len(group.keys) <= len(KEYS) and len(_carried(group)) <= 1 and set(slots(group.right).values()) <= set(SLOTS)
    )


def _struct(fields: dict[str, str]) -> str:
    return f"named_struct({', '.join(f'{lit(n)}, {text}' for n, text in fields.items())})"


def _blank(facts: dict[str, tuple[str, str]]) -> dict[str, str]:
    return {
        "space": "0", **{k: "CAST(null AS STRING)" for k in (*KEYS, *FILING_KEYS)}, "carried": "CAST(null AS DATE)", "hits": "0",
        "partner": "false", **{s: f"CAST(null AS {kind})" for s, (_, kind) in facts.items()},
    }


def _by_filing(group: JoinGroup) -> bool:
    return set(FILING_KEYS) <= set(group.keys)


def _filing_first(group: JoinGroup) -> bool:
    """Does the key begin with the row's filing? Its entries then do not hold the filing a second time."""
    return [*group.keys.items()][:len(FILING_KEYS)] == [(k, k) for k in FILING_KEYS]


def _left_entry(space: int, group: JoinGroup, facts: dict) -> str:
    tests = [_test(c) for c in group.checks]
    fields = {**_blank(facts), "space": str(space)}
    if not _filing_first(group):
        fields |= {k: k for k in FILING_KEYS}
    fields |= {j: f"CAST({text} AS STRING)" for j, text in zip(KEYS, group.keys.values())}
    fields |= {"carried": f"CAST({group.carry[n]} AS DATE)" for n in _carried(group)}
    fields["hits"] = " + ".join(f"IF({t}, {1 << i}, 0)" for i, t in enumerate(tests))
    return f"CASE WHEN {' OR '.join(tests)} THEN {_struct(fields)} END"


def _right_entries(space: int, group: JoinGroup, facts: dict) -> list[str]:
    out = []
    place = slots(group.right)
    # Without facts only the keys matter; a null key, but for those of a filing, is no partner.
    free = FILING_KEYS if _by_filing(group) else []
    for where, keys in group.right.variants():
        present = [f"({keys[k]}) IS NOT NULL" for k in group.keys if k not in free]
        fields = {**_blank(facts), "space": str(space), "partner": "true"}
        fields |= {j: f"CAST({keys[k]} AS STRING)" for j, k in zip(KEYS, group.keys)}
        fields |= {place[n]: f"CAST({text} AS {FACTS[kind][1]})" for n, (kind, text) in group.right.facts.items()}
        out.append(f"CASE WHEN {' AND '.join([f'({where})', *present])} THEN {_struct(fields)} END")
    return out


def entries(ctx: FilingContext, groups: list[JoinGroup]) -> DataFrame:
    """One row per table row and rule group that it takes part in."""
    by_table: dict[str, list[str]] = {}
    facts = used_slots(groups)
    for space, group in enumerate(groups):
        by_table.setdefault(group.table, []).append(_left_entry(space, group, facts))
        by_table.setdefault(group.right.table, []).extend(_right_entries(space, group, facts))
    return unfolded(ctx, by_table)


def unfolded(ctx: FilingContext, by_table: dict[str, list[str]]) -> DataFrame:
    """One row per entry that is not null. Entries are a projected column, and nulls go after the array is unfolded: inside a
    higher-order function their tests would be interpreted."""
    parts = [ctx.table(t).selectExpr(f"array({', '.join(own)}) AS e").selectExpr("explode(e) AS e").where("e IS NOT NULL").select("e.*") for t, own in by_table.items()]
    return reduce(DataFrame.unionByName, parts)


def _condition(group: JoinGroup, check: Check) -> str:
    """Does a left entry violate the check, given its key's partner?"""
    names = {f"r_{n}": s for n, s in slots(group.right).items()} | {f"l_{n}": "carried" for n in _carried(group)} | {"l_period": "period"}

    def told(text: str) -> str:
        return re.sub(r"\b[rl]_\w+", lambda m: names[m[0]], text)

    met = "partner" if group.residual is None else f"(partner AND coalesce({told(group.residual)}, false))"
    if group.how == "left_anti":
        return f"NOT {met}"
    return met if check.partner is None else f"{met} AND ({told(check.partner)})"


def bundled_counts(ctx: FilingContext, groups: list[JoinGroup]) -> DataFrame:
    """(cid, period, n): n has the counts of every check of every group, in order."""
    most = max(len(g.checks) for g in groups)
    hits = [F.sum(F.shiftright("hits", i).bitwiseAND(1)).alias(f"n{i}") for i in range(most)]
    slots_used = used_slots(groups)
    facts = [F.expr(f"{merge}({s}) AS {s}") for s, (merge, _) in slots_used.items()]
    in_key = [space for space, g in enumerate(groups) if _filing_first(g)]
    filing = [F.when(F.col("space").isin(in_key), F.col(j)).otherwise(F.col(k)).alias(k) for j, k in zip(KEYS, FILING_KEYS)]
    keyed = entries(ctx, groups).groupBy("space", *KEYS, *FILING_KEYS, "carried").agg(*hits, F.max("partner").alias("partner"), *facts)
    same_key = Window.partitionBy("space", *KEYS)
    shared = [F.max("partner").over(same_key).alias("partner"), *[F.expr(f"{merge}({s})").over(same_key).alias(s) for s, (merge, _) in slots_used.items()]]
    left = keyed.select("space", *filing, "carried", *[f"n{i}" for i in range(most)], *shared).where(" + ".join(f"n{i}" for i in range(most)) + " > 0")
    sums = [f"sum(IF(space = {space} AND ({_condition(g, c)}), n{i}, 0))" for space, g in enumerate(groups) for i, c in enumerate(g.checks)]
    return left.groupBy(*FILING_KEYS).agg(F.expr(f"array({', '.join(sums)}) AS n"))


def spans(ctx: FilingContext, groups: list[JoinGroup], held: Callable[[DataFrame], DataFrame] = lambda frame: frame) -> DataFrame:
    """(space, keys, group, cid, period, first, last, n..., covered): the distinct spans of version groups, with their rows counted.

    Groups whose versions have the same keys share them; every table is read once. ``held`` may store the counted spans, which
    the pass over dates reads twice.
    """
    width, most = max(len(g.keys) for g in groups), max(len(g.checks) for g in groups)
    sources = list(dict.fromkeys((g.right.table, tuple(g.keys)) for g in groups))

    def keys(texts) -> dict[str, str]:
        # Keys that a group does not have are one blank text, so that null keeps meaning no partner.
        return dict(zip(KEYS[:width], [*(f"CAST({t} AS STRING)" for t in texts), *["''"] * width]))

    asked: dict[str, list[str]] = {}
    told: dict[str, list[str]] = {}
    for i, g in enumerate(groups):
        fields = {"space": str(sources.index((g.right.table, tuple(g.keys)))), **keys(g.keys.values()), "grp": str(i), **{k: k for k in FILING_KEYS}}
        fields |= {"first": g.during[0], "last": g.during[1], "hits": " + ".join(f"IF({_test(c)}, {1 << j}, 0)" for j, c in enumerate(g.checks))}
        asked.setdefault(g.table, []).append(f"CASE WHEN {' OR '.join(_test(c) for c in g.checks)} THEN {_struct(fields)} END")
    for space, (table, names) in enumerate(sources):
        right = next(g.right for g in groups if g.right.table == table and tuple(g.keys) == names)
        fields = {"space": str(space), **keys(right.keys[n] for n in names), "start": "effective_start", "end": "effective_end"}
        told.setdefault(table, []).append(f"CASE WHEN {right.where} THEN {_struct(fields)} END")

    counted = unfolded(ctx, asked).groupBy("space", *KEYS[:width], "grp", *FILING_KEYS, "first", "last").agg(*[F.sum(F.shiftright("hits", i).bitwiseAND(1)).alias(f"n{i}") for i in range(most)])
    return covered(held(counted), unfolded(ctx, told), ["space", *KEYS[:width]])


def span_counts(ctx: FilingContext, groups: list[JoinGroup], held: Callable[[DataFrame], DataFrame] = lambda frame: frame) -> DataFrame:
    """(cid, period, n): rows that no version covers, for every check of every group, in order."""
    sums = [f"sum(IF(grp = {at} AND NOT covered, n{i}, 0))" for at, g in enumerate(groups) for i in range(len(g.checks))]
    return spans(ctx, groups, held).groupBy(*FILING_KEYS).agg(F.expr(f"array({', '.join(sums)}) AS n"))
