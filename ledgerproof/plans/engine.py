"""Evaluate a catalogue: lazily, as violation rows and as counts per rule and filing."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import cached_property, partial, reduce
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

from ledgerproof.context import FILING_KEYS, FilingContext
from ledgerproof.functions.predicates import lit
from ledgerproof.operators.groups import fingerprint, repeated_hashes, repeated_keys, rows_in_groups, with_repeated_hash
from ledgerproof.operators.joins import left_join_null_safe
from ledgerproof.operators.results import rate
from ledgerproof.plans import bundle
from ledgerproof.plans.rules import Check, DerivedGroup, DuplicateGroup, Group, JoinGroup, RowGroup, words_read
from ledgerproof.schemas import RECORD_ID, RECORD_TYPE
from ledgerproof.session import scratch_path, shuffles_released

VIOLATION_COLUMNS = [
    "violation_id", "rule_id", "cid", "period", "record_type", "record_id", "message", "severity", "detected_at",
]


@dataclass(frozen=True)
class Validation:
    """Lazy results of one run."""

    ctx: FilingContext
    groups: list[Group]
    failures: dict[str, str]

    @cached_property
    def violations(self) -> DataFrame:
        """One row per (rule, record)."""
        parts = [group_violations(self.ctx, g, self.repeats, self.lacking) for g in _rules_only(self.groups)]
        found = reduce(DataFrame.unionByName, parts)
        locator = F.concat_ws("|", "rule_id", "record_type", "cid", "period", "record_id", "origin")
        return found.select(
            F.sha2(locator, 256).alias("violation_id"),
            "rule_id", "cid", "period", "record_type", "record_id", "message", "severity",
            F.lit(self.ctx.settings.run_date.isoformat()).alias("detected_at"),
        )

    @cached_property
    def counts(self) -> DataFrame:
        """Violations per (rule, filing), without building the violation rows.

        Row rules become conditional counts over one scan, and join rules count per key before
        they join, so that only filings and keys are shuffled, not records.
        """
        return _counted(self.ctx, _rules_only(self.groups), self.repeats)

    def stored_counts(self, path: str, passes: int = 1) -> DataFrame:
        """``counts``, one part after another written below ``path``: the disk holds the shuffles of one part.

        Rules that share their scans and shuffles are dealt to so many passes.
        """
        spark = self.ctx.spark

        def held(frame: DataFrame) -> DataFrame:
            place = scratch_path(spark, "spans")
            with shuffles_released(spark):
                frame.write.parquet(place)
            return spark.read.schema(frame.schema).parquet(place)

        parts = _count_parts(self.ctx, _rules_only(self.groups), self.repeats, passes, held)
        for i, part in enumerate(parts):
            rows = part()
            with shuffles_released(spark):
                rows.write.mode("append" if i else "overwrite").parquet(path)
        return _added(spark.read.schema(COUNTS).parquet(path))

    @cached_property
    def repeats(self) -> dict[str, Repeats]:
        """Hashes of keys that may occur twice, by group; found once for rows and counts."""
        return find_repeats(self.ctx, [g for g in self.groups if isinstance(g, DuplicateGroup)])

    @cached_property
    def lacking(self) -> Lacking | None:
        """Spans without a version, of all groups that ask for versions: one pass over dates for all of them, stored."""
        groups = [g for g in _rules_only(self.groups) if isinstance(g, JoinGroup) and g.during is not None]
        return find_lacking(self.ctx, groups) if groups else None

    @cached_property
    def failed_rows(self) -> DataFrame | None:
        """Rows per (rule, filing) on which a rule could not be evaluated; None if no rule can fail on rows."""
        guards = [replace(g, checks=own) for g in self.groups if (own := [c for c in g.checks if c.guards])]
        if not guards:
            return None
        checks = [c for g in guards for c in g.checks]
        rule, reason = (F.create_map(*[F.lit(x) for c in checks for x in (c.rule_id, getattr(c, what))]) for what in ("guards", "reason"))
        told = _counted(self.ctx, guards).where("error_count > 0").select(
            F.try_element_at(rule, F.col("rule_id")).alias("rule_id"), *FILING_KEYS, "error_count", F.try_element_at(reason, F.col("rule_id")).alias("reason"))
        return told.groupBy("rule_id", *FILING_KEYS).agg(F.sum("error_count").alias("failed"), F.min("reason").alias("reason"))

    @cached_property
    def stats(self) -> DataFrame:
        """One row per (rule, filing), zero counts and failed rules included."""
        rules = sorted({c.rule_id for g in self.groups for c in g.checks if not c.guards} | set(self.failures))
        listed = F.explode(F.array(*[F.lit(r) for r in rules]))
        base = self.ctx.filings.select(*FILING_KEYS, listed.alias("rule_id"))
        totals = self.ctx.table("transactions").groupBy(*FILING_KEYS).agg(F.count(F.lit(1)).alias("total_count"))
        joined = left_join_null_safe(base, self.counts, ["rule_id", *FILING_KEYS])
        joined = left_join_null_safe(joined, totals, FILING_KEYS)
        count, total = F.coalesce("error_count", F.lit(0)), F.coalesce("total_count", F.lit(0))
        failure = F.lit(None).cast("string")
        if self.failed_rows is not None:
            joined = left_join_null_safe(joined, self.failed_rows, ["rule_id", *FILING_KEYS])
            failure = F.col("reason")
        for rule_id, reason in sorted(self.failures.items()):
            failure = F.when(F.col("rule_id") == rule_id, F.lit(reason)).otherwise(failure)
        return joined.select(
            "rule_id", *FILING_KEYS, count.alias("error_count"), total.alias("total_count"),
            rate(count, total).alias("violation_rate"), failure.alias("engine_failure"),
        )

    @cached_property
    def rule_stats(self) -> DataFrame:
        """Counts per rule over all filings."""
        totals = self.stats.groupBy("rule_id").agg(
            F.sum("error_count").alias("error_count"),
            F.sum("total_count").alias("total_count"),
            F.max("engine_failure").alias("engine_failure"),
        )
        return totals.withColumn("violation_rate", rate(F.col("error_count"), F.col("total_count")))


def _rules_only(groups: list[Group]) -> list[Group]:
    return [replace(g, checks=own) for g in groups if (own := [c for c in g.checks if not c.guards])]


COUNTS = "rule_id string, cid string, period string, error_count long"


def _added(counts: DataFrame) -> DataFrame:
    return counts.groupBy("rule_id", *FILING_KEYS).agg(F.sum("error_count").alias("error_count"))


def _dealt(signed: list[tuple[int, JoinGroup]], passes: int) -> list[list[tuple[int, JoinGroup]]]:
    """Groups with the most entries (on transactions, then on contracts, then with the most keys) go to different passes."""
    def entries(group: JoinGroup) -> tuple:
        tables = {group.table, group.right.table}
        return "transactions" in tables, "contracts" in tables, len(group.keys)

    order = sorted(signed, key=lambda s: entries(s[1]))
    return [own for i in range(passes) if (own := order[i::passes])]


def _counted(ctx: FilingContext, groups: list[Group], repeats: dict[str, Repeats] | None = None) -> DataFrame:
    """Counts of all groups; those that only ask for partners, or for doubles, are counted together."""
    return _added(reduce(DataFrame.unionByName, [part() for part in _count_parts(ctx, groups, repeats)]))


def _count_parts(ctx: FilingContext, groups: list[Group], repeats: dict[str, Repeats] | None = None, passes: int = 1,
                 held: Callable[[DataFrame], DataFrame] = lambda frame: frame) -> list[Callable[[], DataFrame]]:
    """What makes the counts: of groups alone, of doubles, of partners and of versions, whose spans, read twice, may be held."""
    signed = [(sign, g) for group in groups for sign, g in _as_joins(group)]
    together = [(sign, g) for sign, g in signed if bundle.fits(g)]
    during = [(sign, g) for sign, g in signed if isinstance(g, JoinGroup) and g.during is not None]
    doubles = [g for g in groups if isinstance(g, DuplicateGroup)]
    alone = [g for _, g in signed if not bundle.fits(g) and not (isinstance(g, JoinGroup) and g.during is not None) and not isinstance(g, DuplicateGroup)]

    def shared(counts, own: list[tuple[int, JoinGroup]]) -> DataFrame:
        checks = [(sign, c) for sign, g in own for c in g.checks]
        return _unpivot(counts(ctx, [g for _, g in own]), [c for _, c in checks], [sign for sign, _ in checks])

    parts: list[Callable[[], DataFrame]] = []
    if alone:
        parts.append(lambda: reduce(DataFrame.unionByName, [group_counts(ctx, g) for g in alone]))
    if doubles:
        parts.append(lambda: _duplicate_counts(ctx, doubles, repeats or find_repeats(ctx, doubles)))
    for counts, wanted in ((bundle.bundled_counts, together), (partial(bundle.span_counts, held=held), during)):
        parts += [partial(shared, counts, own) for own in _dealt(wanted, passes)]
    return parts


def _as_joins(group: Group) -> list[tuple[int, Group]]:
    if isinstance(group, DerivedGroup) and group.counted:
        return [(sign, replace(g, checks=group.checks)) for sign, g in group.counted]
    return [(1, group)]


def validate(ctx: FilingContext, groups: list[Group]) -> Validation:
    """Check every rule against the schemas first; a rule that cannot run is reported, not dropped."""
    sound: list[Group] = []
    failures: dict[str, str] = {}
    for group in groups:
        checks, broken = _analyzed(ctx, group)
        failures.update(broken)
        if checks:
            sound.append(replace(group, checks=checks))
    return Validation(ctx, sound, failures)


# What headers of filings and rows of violations are made of, besides the columns that rules name.
ALWAYS_READ = {*FILING_KEYS, "source_filename", "source_row_index", "filing_type", "filer_unique_id", "submitter_name"}


def columns_read(ctx: FilingContext, words: dict[str, set[str]], name: str) -> list[str]:
    """The columns of a table kept by filing that groups with these words (``words_read``) read."""
    wanted = words.get(name, set()) | ALWAYS_READ | ({RECORD_ID[name]} if name in words else set())
    return [c for c in ctx.table(name).columns if c.lower() in wanted]


def stored_for(ctx: FilingContext, groups: list[Group], path: str, names: list[str], headers: bool = False) -> FilingContext:
    """The named tables stored with the columns that the groups read, and headers of filings if they read those or are asked for.

    A group that does not tell what it reads makes all columns be stored.
    """
    words = words_read(groups)
    if words is None:
        return ctx.stored(path, names)
    columns = {name: columns_read(ctx, words, name) for name in set(names) & set(RECORD_ID)}
    return ctx.stored(path, names, columns, headers or "filings" in words)


def _analyzed(ctx: FilingContext, group: Group) -> tuple[list[Check], dict[str, str]]:
    try:
        group_violations(ctx, group)
        return group.checks, {}
    except AnalysisException:
        pass
    good, broken = [], {}
    for check in group.checks:
        try:
            group_violations(ctx, replace(group, checks=[check]))
            good.append(check)
        except AnalysisException as problem:
            broken[check.rule_id] = problem.getCondition() or "ANALYSIS_ERROR"
    return good, broken


def _test(check: Check) -> str:
    return "true" if check.test is None else f"({check.test})"


def _with_partner(check: Check) -> str:
    return _test(check) if check.partner is None else f"({_test(check)} AND ({check.partner}))"


def _any_test(checks: list[Check]) -> str:
    """Condition under which a row can violate anything."""
    return " OR ".join(_test(c) for c in checks)


def _entry(check: Check) -> str:
    message = lit(check.text)
    if check.show is not None:
        message = f"concat({lit(check.text + ': ')}, coalesce(CAST({check.show} AS STRING), 'none'))"
    fields = f"'rule_id', {lit(check.rule_id)}, 'severity', {lit(check.severity)}, 'message', {message}"
    return f"CASE WHEN {_with_partner(check)} THEN named_struct({fields}) END"


def _explode(df: DataFrame, checks: list[Check], record_type: str, record_id: str) -> DataFrame:
    """All violated rules of each row in one projection."""
    columns = set(df.columns)
    has_origin = {"source_filename", "source_row_index"} <= columns
    origin = "concat_ws('#', source_filename, source_row_index)" if has_origin else "''"
    hits = df.selectExpr(
        *FILING_KEYS,
        f"{lit(record_type)} AS record_type",
        f"CAST({record_id} AS STRING) AS record_id",
        f"{origin} AS origin",
        f"array({', '.join(_entry(c) for c in checks)}) AS hits",
    )
    # The entries are a projected column first: inside a higher-order function their tests would be interpreted.
    hits = hits.selectExpr(*FILING_KEYS, "record_type", "record_id", "origin", "explode(array_compact(hits)) AS hit")
    return hits.selectExpr(*FILING_KEYS, "record_type", "record_id", "origin", "hit.*")


def _with_keys(group: JoinGroup, left: DataFrame, extra: list[str]) -> DataFrame:
    """Key and carried expressions as columns ``l_<name>``."""
    named = {**group.keys, **group.carry}
    return left.selectExpr(*extra, *[f"{text} AS l_{name}" for name, text in named.items()])


def _matched(group: JoinGroup, left: DataFrame, right: DataFrame) -> DataFrame:
    partner = right.selectExpr(*[f"{c} AS r_{c}" for c in right.columns])
    # A filing whose period is not readable is still one filing: its keys compare null-safe.
    by_filing = set(FILING_KEYS) <= set(group.keys)
    on = [f"l_{k} {'<=>' if by_filing and k in FILING_KEYS else '='} r_{k}" for k in group.keys]
    if group.residual is not None:
        on.append(group.residual)
    return left.join(partner, F.expr(" AND ".join(on)), group.how)


class Lacking(NamedTuple):
    """Spans that no version covers, with the number of their group, and the numbers by name."""

    spans: DataFrame
    number: dict[str, int]


def find_lacking(ctx: FilingContext, groups: list[JoinGroup]) -> Lacking:
    path = scratch_path(ctx.spark, "lacking")
    found = bundle.spans(ctx, groups).where("NOT covered")
    with shuffles_released(ctx.spark):
        found.write.parquet(path)
    return Lacking(ctx.spark.read.schema(found.schema).parquet(path), {g.name: i for i, g in enumerate(groups)})


def _not_covered(ctx: FilingContext, group: JoinGroup, rows: DataFrame, lacking: Lacking | None) -> DataFrame:
    """Rows whose key has no version in their span: a semi join with the spans that lack one."""
    spans = bundle.spans(ctx, [group]).where("NOT covered") if lacking is None else lacking.spans.where(F.col("grp") == lacking.number[group.name])
    keys = bundle.KEYS[:len(group.keys)]
    found = spans.select(*[F.col(j).alias(f"_{j}") for j in keys], *[F.col(k).alias(f"_{k}") for k in FILING_KEYS])
    on = [f"CAST({text} AS STRING) <=> _{j}" for j, text in zip(keys, group.keys.values())] + [f"{k} <=> _{k}" for k in FILING_KEYS]
    return rows.join(found, F.expr(" AND ".join(on)), "left_semi")


class Repeats(NamedTuple):
    """Hashes of keys of a duplicate group that may occur twice, how many, and the group's number in its table."""

    hashes: DataFrame
    n: int
    number: int


def _named(group: DuplicateGroup) -> str:
    return "|".join([group.table, group.where or "", *group.keys])


def _key_hash(group: DuplicateGroup, number: int) -> str:
    """One number for a row's key; its lowest six bits are the group's number."""
    return f"(xxhash64({lit(_named(group))}, {', '.join([*FILING_KEYS, *group.keys])}) & -64L) | {number}L"


def _has_key(group: DuplicateGroup) -> str:
    """Rows that the group compares: a single key that is null is no key."""
    present = f"{group.keys[0]} IS NOT NULL" if len(group.keys) == 1 else "true"
    return present if group.where is None else f"({group.where}) AND {present}"


def find_repeats(ctx: FilingContext, groups: list[DuplicateGroup]) -> dict[str, Repeats]:
    """One scan per table hashes the keys of all its duplicate groups; a job of its own, since its size decides how rows are met.

    Kept by group (``_named``): one whose rows mostly repeat would fill the bitmap of another.
    """
    found = {}
    for table in dict.fromkeys(g.table for g in groups):
        own = [g for g in groups if g.table == table]
        if len(own) > 64:
            raise ValueError("a hash has room for the numbers of 64 groups of a table")
        listed = ", ".join(f"CASE WHEN {_has_key(g)} THEN {_key_hash(g, i)} END" for i, g in enumerate(own))
        hashes, _ = repeated_hashes([ctx.table(table).selectExpr(f"explode(array_compact(array({listed}))) AS h")], scratch_path(ctx.spark, "repeats"))
        counted = {r.number: r["n"] for r in hashes.groupBy(F.expr("h & 63").alias("number")).agg(F.count("h").alias("n")).collect()}
        found |= {_named(g): Repeats(hashes.where(f"h & 63 = {i}"), counted.get(i, 0), i) for i, g in enumerate(own)}
    return found


def _duplicate_frame(ctx: FilingContext, group: DuplicateGroup, repeats: dict[str, Repeats] | None) -> tuple[DataFrame, list[str]]:
    """Rows of a duplicate group that may have a double, with their exact key. Without repeats, all its rows."""
    df = ctx.table(group.table).filter(_has_key(group))
    if repeats is not None:
        hashes, n, number = repeats[_named(group)]
        df = with_repeated_hash(df, _key_hash(group, number), hashes, n)
    if len(group.keys) == 1:
        return df.withColumn("_key", F.expr(f"CAST({group.keys[0]} AS STRING)")), [*FILING_KEYS, "_key"]
    # As bytes, half as many as in hexadecimal.
    return df.withColumn("_key", F.expr(f"unhex({fingerprint(group.keys)})")), [*FILING_KEYS, "_key"]


def _duplicate_counts(ctx: FilingContext, groups: list[DuplicateGroup], repeats: dict[str, Repeats]) -> DataFrame:
    """Counts of all duplicate groups: one aggregate finds the repeated keys of all, one adds them up per filing."""
    parts = []
    for i, g in enumerate(groups):
        df, keys = _duplicate_frame(ctx, g, repeats)
        parts.append(df.select(F.lit(i).alias("grp"), *keys))
    repeated = repeated_keys(reduce(DataFrame.unionByName, parts), ["grp", *FILING_KEYS, "_key"])
    sums = [f"sum(IF(grp = {i}, copies, 0))" for i, g in enumerate(groups) for _ in g.checks]
    per_filing = repeated.groupBy(*FILING_KEYS).agg(F.expr(f"array({', '.join(sums)}) AS n"))
    return _unpivot(per_filing, [c for g in groups for c in g.checks])


def group_violations(ctx: FilingContext, group: Group, repeats: dict[str, Repeats] | None = None, lacking: Lacking | None = None) -> DataFrame:
    """Violation rows of one group. What was found for all groups of a run, doubles and spans without a version, need not be found again."""
    if isinstance(group, DerivedGroup):
        return _explode(group.frame(ctx), group.checks, group.record_type, "record_id")
    if isinstance(group, RowGroup):
        rows = ctx.table(group.table)
    elif isinstance(group, DuplicateGroup):
        df, keys = _duplicate_frame(ctx, group, repeats)
        rows = rows_in_groups(df, repeated_keys(df, keys), keys)
    else:
        candidates = ctx.table(group.table).filter(_any_test(group.checks))
        if group.during is not None:
            rows = _not_covered(ctx, group, candidates, lacking)
        else:
            rows = _matched(group, _with_keys(group, candidates, ["*"]), group.right(ctx))
    return _explode(rows, group.checks, RECORD_TYPE[group.table], RECORD_ID[group.table])


def _unpivot(per_filing: DataFrame, checks: list[Check], signs: list[int] | None = None) -> DataFrame:
    """The array column ``n`` of counts as one row per check; a rule may have several."""
    structs = ", ".join(
        f"named_struct('rule_id', {lit(c.rule_id)}, 'error_count', {sign} * n[{i}])"
        for i, (c, sign) in enumerate(zip(checks, signs or [1] * len(checks)))
    )
    return per_filing.selectExpr(*FILING_KEYS, f"explode(array({structs})) AS c").select("c.rule_id", *FILING_KEYS, "c.error_count")


def _count_array(tests: list[str]) -> str:
    return "array(" + ", ".join(f"count_if({t})" for t in tests) + ") AS n"


def group_counts(ctx: FilingContext, group: Group) -> DataFrame:
    """Violations per rule and filing of one group, counted without making violation rows."""
    checks = group.checks
    if isinstance(group, DuplicateGroup):
        return _duplicate_counts(ctx, [group], find_repeats(ctx, [group]))
    if isinstance(group, JoinGroup) and group.during is not None:
        per_filing = bundle.span_counts(ctx, [group])
    elif isinstance(group, JoinGroup):
        keys = [f"l_{k}" for k in {**group.keys, **group.carry}]
        candidates = ctx.table(group.table).filter(_any_test(checks))
        tests = [f"{_test(c)} AS t{i}" for i, c in enumerate(checks)]
        slim = _with_keys(group, candidates, [*FILING_KEYS, *tests])
        counted = [F.expr(f"count_if(t{i}) AS n{i}") for i in range(len(checks))]
        per_key = slim.groupBy(*FILING_KEYS, *keys).agg(*counted)
        # Conditions on the partner apply to the counted keys, after the join.
        sums = ", ".join(
            f"sum(n{i})" if c.partner is None else f"sum(CASE WHEN {c.partner} THEN n{i} ELSE 0 END)"
            for i, c in enumerate(checks)
        )
        per_filing = _matched(group, per_key, group.right(ctx)).groupBy(*FILING_KEYS).agg(F.expr(f"array({sums}) AS n"))
    else:
        df = ctx.table(group.table) if isinstance(group, RowGroup) else group.frame(ctx)
        per_filing = df.groupBy(*FILING_KEYS).agg(F.expr(_count_array([_test(c) for c in checks])))
    return _unpivot(per_filing, checks)
