"""Ranked search, spelling variants and language-model scores against SQL and plain versions."""

import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from checks.compare import compare, duck
from ledgerproof.llm import language_model, ranked_search, registry, spelling
from ledgerproof.llm.base import python_workers
from tests.llm.brute import UPPER, WORD
from tests.llm.frames import documents, odd_rows, random_rows

DATA = "/root/testdata/sf0.001"


def con(tmp_path, **tables):
    out = duckdb.connect()
    for name, frame in tables.items():
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
        out.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    return out


@pytest.mark.parametrize("name", ["op12_spelling_variants", "op13_ranked_search"])
def test_query_equals_sql(spark, name):
    ok, text = compare(spark, duck(DATA), DATA, name, registry.queries()[name], registry.oracle_sql()[name])
    assert ok, text


def items(spark, texts):
    return spark.createDataFrame([(i % 5 or None, t, "clash", "clash") for i, t in enumerate(texts)], "item_id long, text string, rank string, score string")


@pytest.mark.parametrize("rows", [random_rows(4), odd_rows(), []], ids=["random", "odd", "empty"])
def test_ranked_odd_rows(spark, rows, tmp_path):
    texts = [None, "", " ,;", "w1 w2 w3 W1", "same line here", *[t for _, t in rows[:6] if t and len(t) < 5000], "É Ünïcode 漢字 a a a", "absent"]
    db = con(tmp_path, documents=documents(spark, rows), benchmark=items(spark, texts))
    for block_bytes in (1 << 20, 60):
        found = ranked_search.ranked(spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/benchmark.parquet"), block_bytes=block_bytes)
        # Rows of equal score and doc_id have no order of their own, and items may repeat an id.
        assert Counter(map(tuple, found.select("item_id", "rank", "doc_id", "score").collect())) == Counter(db.sql(f"SELECT item_id, rank, doc_id, score FROM ({ranked_search.SQL})").fetchall())


def test_no_queries(spark):
    assert ranked_search.ranked(documents(spark, random_rows(4)), items(spark, [])).isEmpty()


@pytest.mark.parametrize("seed", range(4))
def test_ball_tree(seed):
    """Best scores equal a full scan's; in clustered vectors most documents are never scored."""
    rng = np.random.default_rng(seed)
    rows, terms = 1500, 200
    topic = rng.integers(0, 20, rows)
    entries = sorted({(r, int(topic[r] * 10 + t)) for r in range(rows) for t in rng.integers(0, 10, 6)} | {(r, int(t)) for r in range(rows) for t in rng.integers(0, terms, 1)})
    row, term = np.array(entries).T
    value = rng.integers(1, 10**6, len(row))
    weight = rng.integers(0, 12_000, terms)
    tree = ranked_search.BallTree(row, term, value, np.maximum(weight, 1) ** 0.5)
    dense = np.zeros((rows, terms), np.int64)
    dense[row, term] = value
    assert all((dense[tree.rows[a:b]] @ weight <= most + 0.5).all() for (a, b), most in zip(tree.bounds, tree.most(np.arange(terms), weight)))
    scored = 0
    for t in range(20):
        at = np.arange(t * 10, t * 10 + 6)
        want = np.sort(dense[:, at] @ weight[at])[::-1][:20]
        found, scores, n = tree.search(at, weight[at], 0, 20)
        best = np.sort(scores)[::-1][:20]
        assert (best == want[want > 0][:len(best)]).all() and len(best) == min(20, (want > 0).sum())
        assert (scores == dense[found][:, at] @ weight[at]).all()
        scored += n
    assert scored < 0.5 * rows * 20


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def test_near_words(spark):
    rng = random.Random(2)
    words = {"".join(rng.choice("abé") for _ in range(n)) for n in range(7, 12) for _ in range(160)} | {"a" * n for n in range(7, 80)}
    for n in (9, 15, 16, 17, 33, 62, 63, 64, 65, 66, 90):
        base = "".join(rng.choice("abcdeÿ") for _ in range(n))
        words |= {base} | {base[:i] + base[i + 1:] for i in (0, n // 2, n - 1)} | {base[:i] + "z" + base[i + e:] for i in (0, 3, n // 2, n - 1) for e in (0, 1)} | {base + "q"}
    words = sorted(w for w in words if len(w) >= 7)
    by_size = defaultdict(list)
    for w in words:
        by_size[len(w)].append(w)
    want = {frozenset(p) for n, own in by_size.items() for p in itertools.chain(itertools.combinations(own, 2), itertools.product(own, by_size.get(n + 1, []))) if near(*p)}
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    for longest in (64, 20):
        found = [frozenset(r) for r in spelling.near_pairs(frame, longest).collect()]
        assert len(found) == len(set(found)) and set(found) == want


def test_roots(spark):
    """Forms lead from word to word; the root is where they end. Ties go to the smallest word."""
    rows = [("aaaaaaa", 2), ("aaaaaab", 20), ("aaaaabb", 200), ("aaaabbb", 2000), ("ccccccc", 10), ("cccccca", 100), ("ccccccb", 100), ("eeeeeee", 11), ("eeeeeef", 109)]
    found = {r.word: tuple(r)[1:] for r in spelling.variants(spark.createDataFrame(rows, "word string, n long")).collect()}
    assert found["aaaaaaa"] == ("aaaaaab", "aaaabbb", 2, 1, 20) and found["aaaaabb"] == ("aaaabbb", "aaaabbb", 200, 2, 2000)
    assert found["ccccccc"] == ("cccccca", "cccccca", 10, 2, 100) and found["eeeeeee"] == (None, "eeeeeee", 11, 1, None)


@pytest.mark.parametrize("rows", [odd_rows() + [(i, "Garten Gartenhaus gartenhaus Gärtenhaus xgartenhaus " * 9) for i in range(40)] + [(77, "y" * 200 + " " + "y" * 200 + " " + "y" * 199 + " " + "y" * 199)], []], ids=["odd", "empty"])
def test_spelling_odd_rows(spark, rows, tmp_path):
    db = con(tmp_path, documents=documents(spark, rows))
    found = spelling.query(spark, str(tmp_path))
    assert Counter(map(tuple, found.collect())) == Counter(db.sql(f"SELECT {', '.join(found.columns)} FROM ({spelling.SQL})").fetchall())


def plain_scores(rows, order):
    """The model in plain dictionaries."""
    text_id = lambda d: "" if d is None else str(d)
    streams, held, deleted = [], [], []
    for d, t in rows:
        streams.append([f"<{i}>" for i in range(order - 1)] + WORD.findall((t or "").translate(UPPER)) + ["\n"])
        held.append(zlib.crc32(text_id(d).encode()) % 7 == 2)
        deleted.append(not held[-1] and zlib.crc32((text_id(d) + "#").encode()) % 16 == 0)

    def count(keep):
        return Counter(tuple(s[i:i + k]) for s, ok in zip(streams, keep) if ok for k in range(1, order + 1) for i in range(len(s) - k + 1))

    full, kept = count([not h for h in held]), count([not h and not d for h, d in zip(held, deleted)])
    real = lambda c: {g[0]: n for g, n in c.items() if len(g) == 1 and not re.fullmatch(r"<\d>", g[0])}
    tokens, retained, distinct = sum(real(full).values()), sum(real(kept).values()), len(real(full))

    def parts(counts, n, s, i):
        p, bucket = [1 / (distinct + 1), counts[(s[i],)] / max(n, 1)] + [0.0] * (order - 1), 0
        for k in range(1, order):
            context = counts[tuple(s[i - k:i])]
            if context:
                p[k + 1], bucket = counts[tuple(s[i - k:i + 1])] / context, k * language_model.LEVELS + int(math.log2(context))
        return p, bucket

    usable = language_model.open_components(order).astype(float)
    weights, before = usable / usable.sum(1, keepdims=True), -math.inf
    events = [parts(kept, retained, s, i) for s, d in zip(streams, deleted) if d for i in range(order - 1, len(s))]
    for _ in range(language_model.ROUNDS):
        share, log = usable.copy(), 0.0
        for p, b in events:
            mixed = np.array(p) * weights[b]
            log += math.log(mixed.sum())
            share[b] += mixed / mixed.sum()
        weights = share / share.sum(1, keepdims=True)
        if log == 0 or log - before < language_model.SETTLED * abs(log):
            break
        before = log
    out = []
    for (d, _), s, h in zip(rows, streams, held):
        own = s[order - 1:]
        events = [parts(full, tokens, s, i) for i in range(order - 1, len(s))]
        out.append((d, h, len(own), sum(full[(w,)] > 0 for w in own), tokens, sum(math.log10((full[(w,)] + 1) / (tokens + distinct + 1)) for w in own), sum(math.log10(float(np.dot(p, weights[b]))) for p, b in events)))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
@pytest.mark.parametrize("rows", [random_rows(8, 40), odd_rows(), [(2, "held out only")] if zlib.crc32(b"2") % 7 == 2 else [(11, "a b")], []], ids=["random", "odd", "one", "empty"])
def test_model(spark, rows, order, tmp_path):
    documents(spark, rows).write.parquet(f"{tmp_path}/d")
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[6])
    found, want = sorted(map(tuple, language_model.scores(spark.read.parquet(f"{tmp_path}/d"), order).collect()), key=key), sorted(plain_scores(rows, order), key=key)
    assert [r[:5] for r in found] == [r[:5] for r in want]
    assert all(math.isclose(a[i], b[i], rel_tol=1e-9, abs_tol=1e-9) for a, b in zip(found, want) for i in (5, 6))


def test_chunks_are_filled_over_batches(spark):
    """Small batches do not make small chunks: one chunk of each role here."""
    docs = spark.range(0, 400, 1, 1).selectExpr("id AS doc_id", "concat('a b ', id) AS text", "CAST(id % 3 AS INT) AS role")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    try:
        found = python_workers(docs).mapInArrow(language_model._carry, language_model.CHUNKS).selectExpr("role", "length(ids) / 8 AS n").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((r.role, r.n) for r in found) == [(0, 134), (1, 133), (2, 133)]


def test_replies_hold_one_range(spark):
    """The replies of a range are given before the range after the next is read."""
    read = []

    def batches():
        for part in range(4):
            hashes = language_model._pack_hashes(np.array([5, 9], np.uint64) + np.uint64(part << 60), 8)
            rows = [(part, chunk, 1, language_model.LEARNED, hashes, language_model._squeeze(np.array([1, 2]))) for chunk in (0, 1)]
            read.append(part)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["part", "chunk", "k", "role", "hashes", "counts"])

    out = language_model._reply(1)(batches())
    first = next(out)
    assert first.column(1).to_pylist()[:2] == [0, 0] and read == [0, 1]
    assert sorted(p for b in [first, *out] for c, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if c >= 0) == [0, 0, 1, 1, 2, 2, 3, 3]


def test_model_is_a_distribution_and_beats_the_base(spark):
    """Over all tokens after a context the mixture sums to 1; held-out documents are likelier than by single words."""
    counts = [np.array([3, 1, 2, 0]), np.array([2, 0, 1, 0])]
    parts, bucket = language_model.components(counts, [np.full(4, 3)], 6, 3)
    assert np.allclose(parts.sum(1), 1) and (bucket == language_model.LEVELS + 1).all()
    row = language_model.query(spark, DATA.replace("0.001", "0.01")).where("held_out").selectExpr("sum(score) / sum(n_tokens) AS score", "sum(base_score) / sum(n_tokens) AS base").head()
    assert row.score > row.base + 0.3
