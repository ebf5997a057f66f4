"""Operators against brute force on small data, with hot keys, and the plans they get."""

import datetime as dt
import random

import pytest

from ledgerproof.functions import periods
from ledgerproof.operators import groups, intervals, joins, results
from pyspark.sql import functions as F


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def hot(spark):
    """One key holds a third of all rows; a few keys are single; some are null."""
    keys = ["hot"] * 1000 + [f"k{i % 900}" for i in range(1700)] + [f"one{i}" for i in range(200)] + [None] * 100
    return spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key string, id long")


def test_duplicates_of_a_hot_group_keep_every_row(spark, hot):
    counts = {}
    for r in hot.collect():
        counts[r.key] = counts.get(r.key, 0) + 1
    want = sorted(r.id for r in hot.collect() if r.key is not None and counts[r.key] > 1)
    found = groups.duplicate_rows(hot, ["key"])
    assert plan_of(found).count("Scan ExistingRDD") <= 2
    assert sorted(r.id for r in found.collect()) == want


def test_rows_in_groups_finds_null_keys(spark):
    df = spark.sql("SELECT * FROM VALUES (1, null, 'x'), (2, null, 'x'), (3, 'a', 'x'), (4, 'a', null) AS t(id, k, l)")
    found = groups.rows_in_groups(df, groups.repeated_keys(df, ["k", "l"]), ["k", "l"])
    assert sorted(r.id for r in found.collect()) == [1, 2]


def test_fingerprint_tells_null_from_text(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', null), (null, 'a'), ('null', 'a'), ('a', null), ('', 'a') AS t(x, y)")
    marks = [r.f for r in df.selectExpr(f"{groups.fingerprint(['x', 'y'])} AS f").collect()]
    assert len(set(marks)) == 4 and marks[0] == marks[3]


def test_interval_join_equals_brute_force(spark):
    rng = random.Random(7)
    base = dt.date(1990, 1, 1)
    days = [base + dt.timedelta(days=rng.randrange(0, 22000)) for _ in range(300)]  # far outside the buckets too
    left = [("hot" if i % 3 == 0 else f"c{i % 5}", i, d) for i, d in enumerate(days)]
    right = []
    for key in ["hot", "c0", "c1", "c2"]:
        for n in range(12):
            start = base + dt.timedelta(days=rng.randrange(0, 20000))
            end = None if n % 4 == 0 else start + dt.timedelta(days=rng.randrange(0, 2500))
            right.append((key, n, start, end))
    a = spark.createDataFrame(left, "key string, id int, day date")
    b = spark.createDataFrame(right, "key string, version int, first date, last date")
    want = sorted((i, n) for k, i, d in left for k2, n, s, e in right if k == k2 and s <= d and (e is None or d < e))
    joined = intervals.interval_join(a, b, "key", "day", "first", "last")
    assert sorted((r.id, r.version) for r in joined.collect()) == want
    assert sorted(joined.columns) == sorted(["key", "id", "day", "version", "first", "last"])
    anti = intervals.interval_join(a, b, "key", "day", "first", "last", how="left_anti")
    assert sorted(r.id for r in anti.collect()) == sorted({i for _, i, _ in left} - {i for i, _ in want})
    assert "NestedLoop" not in plan_of(joined)


def test_anti_join_keeps_null_keys_and_uses_no_nested_loop(spark):
    left = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, id int")
    right = spark.createDataFrame([("a",), (None,)], "k string")
    out = joins.without_partner(left, right, ["k"])
    assert sorted(r.id for r in out.collect()) == [2, 3]
    assert "NestedLoop" not in plan_of(out)


def test_sample_limits_groups_before_the_shuffle(spark, hot):
    sample = results.first_n_per_group(hot, ["key"], ["id"], 5)
    assert plan_of(sample).count("WindowGroupLimit") >= 2
    rows = sample.filter("key = 'hot'").collect()
    assert sorted(r.id for r in rows) == [0, 1, 2, 3, 4]


def test_paths_up_to_three_hops(spark):
    edges = spark.createDataFrame([("f", "c"), ("c", "t"), ("t", "x"), ("x", "y")], "src string, dst string")
    roots = spark.createDataFrame([("f",)], "root string")
    assert sorted((r.node, r.hops) for r in joins.within_hops(edges, roots, 3).collect()) == [("c", 1), ("t", 2), ("x", 3)]


def test_outcome_text_and_back(spark):
    df = spark.sql("SELECT * FROM VALUES (0, null), (12, null), (3, 'boom') AS t(n, f)")
    text = results.outcome_text(F.col("n"), F.col("f"))
    rows = df.select(text.alias("a"), results.outcome_count(text).alias("b")).collect()
    assert [tuple(r) for r in rows] == [("Passed", "0"), ("Failed (12 violations)", "12"), ("Failed Execution: boom", "Failed Execution: boom")]


def test_alert_threshold(spark):
    df = spark.sql("SELECT * FROM VALUES (25, 1000), (24, 1000), (5001, 10000000), (5000, 10000000), (0, 0) AS t(n, total)")
    assert [r[0] for r in df.select(results.needs_brief(F.col("n"), F.col("total"))).collect()] == [True, False, True, False, False]


def test_matrix_shows_missing_cells(spark):
    df = spark.createDataFrame([("C1", "F.1", "0"), ("C2", "F.2", "3")], "cid string, rule string, cell string")
    rows = {r.cid: tuple(r)[1:] for r in results.matrix(df, "cid", "rule", ["F.1", "F.2"], "cell").collect()}
    assert rows == {"C1": ("0", "N/A"), "C2": ("N/A", "3")}


def test_upsert_and_flag(spark):
    old = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 9), ("c", 9)], "k string, v int")
    assert sorted(map(tuple, results.upsert(old, new, "k").collect())) == [("a", 1), ("b", 9), ("c", 9)]
    assert sorted(map(tuple, joins.with_flag(old.select("k").distinct(), new, ["k"], "seen").collect())) == [("a", False), ("b", True)]


def test_period_functions(spark):
    df = spark.sql("SELECT * FROM VALUES ('2025-Q1'), ('2024q4'), ('2024Q5'), ('x') AS t(p)")
    p = periods.canonical_period(F.col("p"))
    rows = df.select(p.alias("p"), periods.period_start(p).cast("string"), periods.period_end(p).cast("string"),
                     periods.previous_period(p), periods.dashed_period(p)).collect()
    assert [tuple(r) for r in rows] == [
        ("2025Q1", "2025-01-01", "2025-03-31", "2024Q4", "2025-Q1"), ("2024Q4", "2024-10-01", "2024-12-31", "2024Q3", "2024-Q4"),
        (None,) * 5, (None,) * 5,
    ]


def test_set_difference_skips_groups_without_right_side(spark):
    rows = [("a", "p", False), ("a", "p", True), ("b", "p", False), ("b", "q", True), ("c", "p", False)]
    df = spark.createDataFrame(rows, "g string, m string, later boolean")
    out = groups.set_difference_keys(df, ["g"], ["m"], ~F.col("later"), F.col("later"))
    assert [tuple(r) for r in out.collect()] == [("b", 2)]


@pytest.mark.parametrize("most", [1_000_000, 0], ids=["sent to tasks", "joined"])
def test_hash_pass_keeps_every_double(spark, most, tmp_path):
    """Doubles, nulls in different places and a key with a third of all rows; rows without a double are left out."""
    rows = [(i, "a") for i in range(300)] + [(7, "b")] * 150 + [(None, "x"), (None, "x"), ("y" and 8, None), (8, None), (9, None)]
    df = spark.createDataFrame(rows, "k int, l string")
    key_hash = "xxhash64(k, l)"
    hashes = groups.repeated_hashes([df.selectExpr(f"{key_hash} AS h")], str(tmp_path / "h"))
    kept = groups.with_repeated_hash(df, key_hash, *hashes, most)
    assert sorted((r.k or 0, r.l or "") for r in kept.collect()) == sorted([(7, "b")] * 150 + [(0, "x")] * 2 + [(8, "")] * 2)


def test_many_repeated_hashes_move_no_rows(spark, tmp_path):
    """However many hashes repeat, rows meet them where they are; a shuffle would move every row of the table."""
    df = spark.range(2000).selectExpr("CAST(id % 1500 AS INT) AS k", "repeat('x', 50) AS l")
    hashes = groups.repeated_hashes([df.selectExpr("xxhash64(k) AS h")], str(tmp_path / "h"))
    kept = groups.with_repeated_hash(df, "xxhash64(k)", *hashes, 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joins = [line for line in kept._jdf.queryExecution().sparkPlan().toString().splitlines() if "Join" in line]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(joins) == 1 and "BroadcastHashJoin" in joins[0]
    assert sorted(r.k for r in kept.collect()) == sorted([*range(500)] * 2)


@pytest.mark.parametrize("seed", range(3))
def test_covered_spans(spark, seed):
    """Against every version of every key: open ends, overlaps, empty versions, nulls, and one key with a third of all rows."""
    rng = random.Random(seed)
    day = lambda: rng.choice([None] + [dt.date(2010, 1, 1) + dt.timedelta(days=rng.randrange(2500)) for _ in range(12)])
    key = lambda: rng.choice(["hot", *[f"k{i}" for i in range(3)], None]) if rng.random() < 0.9 else f"q{rng.randrange(5)}"
    versions = [(key(), day(), day()) for _ in range(60)]
    asked = [(i, key(), a, b) for i, (a, b) in enumerate((day(), day()) for _ in range(400))]
    found = intervals.covered(spark.createDataFrame(asked, "id int, k string, first date, last date"),
                              spark.createDataFrame(versions, "k string, start date, end date"), ["k"])
    want = {i: any(k is not None and k == v and a and b and s and s <= b and (e is None or e > a) for v, s, e in versions) for i, k, a, b in asked}
    assert {r.id: r.covered for r in found.collect()} == {i: bool(w) for i, w in want.items()}


def test_reachable_nodes_with_cycles(spark):
    """Each node once with its least steps, whatever cycles and numbers of paths there are."""
    rng = random.Random(4)
    edges = [(f"n{rng.randrange(30)}", f"n{rng.randrange(30)}") for _ in range(90)] + [("n1", "n2"), ("n2", "n1"), ("n3", "n3")] * 3
    for hops in (1, 3, 40):
        found = joins.within_hops(spark.createDataFrame(edges, "src string, dst string"), spark.createDataFrame([("n1",), ("n3",), ("lone",)], "root string"), hops)
        want = set()
        for root in ("n1", "n3", "lone"):
            seen, frontier = {root}, {root}
            for depth in range(1, hops + 1):
                frontier = {b for a, b in edges if a in frontier} - seen
                seen |= frontier
                want |= {(root, n, depth) for n in frontier}
        rows = found.collect()
        assert len(rows) == len(want) and {tuple(r) for r in rows} == want


def test_many_names(spark):
    """100,000 names against a few thousand values, with short, blank and null names; no nested loop."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeFGH") for _ in range(rng.randrange(3, 9)))
    values = [f"{word()} {word()} {word()}" for _ in range(3000)] + [None, "", "ab", "É x"] + ["same value abcd"] * 500
    names = sorted({f"{word()} {word()[:2]}" for _ in range(100_000)} | {word() for _ in range(3000)}) + ["a", "É", "bc", "", None, "zz"]
    index = spark.createDataFrame(list(enumerate(values)), "id int, legal_name string")
    found = joins.match_names(index, spark.createDataFrame([(n,) for n in names], "search_name string"), "legal_name")
    lower = {}
    for n in names:
        if n is not None:
            lower.setdefault(n.lower(), []).append(n)
    want = {(i, n) for i, v in enumerate(values) if v is not None for t in {v.lower()[a:b] for a in range(len(v) + 1) for b in range(a, len(v) + 1)} for n in lower.get(t, ())}
    rows = found.select("id", "search_name").collect()
    assert len(rows) == len(want) and {tuple(r) for r in rows} == want
    assert "NestedLoop" not in plan_of(found) and "Cartesian" not in plan_of(found)
