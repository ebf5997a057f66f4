"""Ranked lexical search: exact largest inner products over sparse ball trees.

A document is a sparse vector of whole-number term scores, a query one of whole-number term weights; a document's score is
their inner product. Every task builds ball trees over runs of its own documents: a node has the centroid of its documents,
a radius that holds them all, and along each term the radius upward from the centroid. No document below it scores more than
``<query, centroid>`` plus the smaller of ``|query| * radius`` and the query's product with the upward radii; weights are never
negative. In text the ball alone leaves nearly every node open (documents differ in thousands of terms that a query lacks), the
radii by term close four of five. Bounds are rounded up. Nodes are opened best first; when the best open node cannot reach the
query's 20th score of the task so far, all others stay closed. Documents of opened leaves are scored in 64-bit integers, so
results equal those of a full scan. The tasks' lists meet in one ranking per query.

Queries are taken in blocks of at most ``BLOCK_BYTES`` of text, which bounds what tasks are sent; each block reads the
documents twice (term statistics, then search). Vectors hold only terms of the block's queries: others add nothing.

Nulls and texts without terms: such a document is in no result and not counted in N, such a query has no result. Equal
scores go by doc_id, null last. Rows that repeat a doc_id or an item_id count one by one. Very long texts are scanned in
whole. Empty tables give an empty result. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerproof.llm.base import python_workers, stored, table
from ledgerproof.llm.textscan import NOT_ALNUM, owners, pieces, row_bounds, scan

NAME = "op13_ranked_search"
TOP = 20
BLOCK_BYTES = 4 << 20  # of query text in one block
LEAF = 8  # documents in a leaf at most, unless centroids would take more than CENTROIDS numbers
TREE_DOCS, TREE_ENTRIES, CENTROIDS = 16_384, 2_000_000, 8_000_000
POWER = 0.5  # terms are stretched by their weight to this power, so that rare terms shape the tree
SLACK = 1e-9  # far above the error of any sum of doubles here

SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
s AS (SELECT count(*)::BIGINT AS n_docs, sum(len(t))::BIGINT AS n_terms FROM d WHERE len(t) > 0),
p AS (SELECT r, doc_id, len(t)::BIGINT AS n, unnest(t) AS term FROM d),
f AS (SELECT r, doc_id, n, term, count(*)::BIGINT AS tf FROM p GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM f, s GROUP BY term, n_docs),
q AS (SELECT i, item_id, term, count(*)::BIGINT AS c FROM (
        SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
x AS (SELECT i, item_id, r, doc_id, sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
      FROM q JOIN w USING (term) JOIN f USING (term), s GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST, r)::INTEGER AS rank FROM x WHERE score > 0) WHERE rank <= 20
"""


class Block(NamedTuple):
    """Queries of one block: terms are sorted hashes; query i has the terms at[i] with repeats[i] of each."""

    ids: list
    terms: np.ndarray
    at: list[np.ndarray]
    repeats: list[np.ndarray]


def term_rows(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, term hashes, bounds of the rows in them) of every piece of a text column."""
    for first, data, offsets in pieces(texts):
        starts, _, hashes = scan(data, offsets, True, separators=NOT_ALNUM)
        yield first, hashes, row_bounds(starts, offsets)


def _blocks(queries: DataFrame, block_bytes: int) -> Iterator[Block]:
    text = F.coalesce("text", F.lit(""))
    size = queries.agg(F.sum(F.octet_length(text))).head()[0] or 0
    n = math.ceil(size / block_bytes)
    for b in range(n):
        rows = queries.select("item_id", text.alias("text")).where(F.pmod(F.xxhash64("text", "item_id"), F.lit(n)) == b).toArrow()
        ids, at, repeats, own = rows.column("item_id").to_pylist(), [], [], []
        for _, hashes, bounds in term_rows(rows.column("text")):
            own += [hashes[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        terms = np.unique(np.concatenate(own)) if own else np.zeros(0, np.uint64)
        for x in own:
            found, times = np.unique(x, return_counts=True)
            at.append(np.searchsorted(terms, found))
            repeats.append(times)
        if len(terms):
            yield Block(ids, terms, at, repeats)


def _matches(hashes: np.ndarray, bounds: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, tf) of the rows' occurrences of the terms, in that order."""
    place = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
    held = terms[place] == hashes
    key, tf = np.unique(owners(bounds)[held] * len(terms) + place[held], return_counts=True)
    return key // len(terms), key % len(terms), tf


def _statistics(terms: np.ndarray) -> Callable:
    """(what, n): documents that hold term number ``what``; -1 documents with a term, -2 terms of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, total, df = 0, 0, np.zeros(len(terms), np.int64)
        for batch in batches:
            for _, hashes, bounds in term_rows(batch.column(0)):
                docs, total = docs + int((np.diff(bounds) > 0).sum()), total + len(hashes)
                df += np.bincount(_matches(hashes, bounds, terms)[1], minlength=len(terms))
        what = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-1, -2], what]), pa.int64()), pa.array(np.concatenate([[docs, total], df[what]]), pa.int64())], ["what", "n"])

    return run


class BallTree:
    """Nodes over sparse non-negative integer vectors; rows are re-ordered so that a node's documents are one run.

    Centroids and distances are taken in a space where each term is stretched by ``scale``; queries shrink by it.
    """

    def __init__(self, row: np.ndarray, term: np.ndarray, value: np.ndarray, scale: np.ndarray, leaf: int = LEAF):
        """Entries must be sorted by row; every row from 0 on must have one."""
        rows, n_terms = int(row[-1]) + 1, len(scale)
        starts = np.searchsorted(row, np.arange(rows + 1))
        self.scale, self._term, self._real, self._starts = scale, term, value * scale[term], starts
        squares = np.add.reduceat(self._real * self._real, starts[:-1])
        leaf = max(leaf, math.ceil(2 * rows * n_terms / CENTROIDS))
        order, nodes = np.arange(rows), [(0, rows)]
        self.children: list[tuple[int, int] | None] = []
        while len(self.children) < len(nodes):
            a, b = nodes[len(self.children)]
            if b - a <= leaf:
                self.children.append(None)
                continue
            own = order[a:b]
            take, ends = self._entries(own)
            held = term[take], self._real[take], ends[:-1]
            # Two documents far apart; the others are halved by which of the two is nearer, so depth is logarithmic.
            one = own[np.argmax(squares[own] - 2 * self._dots(held, own[0]))]
            to_one = squares[one] - 2 * self._dots(held, one)
            other = own[np.argmax(squares[own] + to_one)]
            to_other = squares[other] - 2 * self._dots(held, other)
            order[a:b] = own[np.argsort(to_one - to_other, kind="stable")]
            middle = (a + b) // 2
            self.children.append((len(nodes), len(nodes) + 1))
            nodes += [(a, middle), (middle, b)]
        take, self.starts = self._entries(order)
        self.rows, self.bounds, self.term, self.value, real = order, nodes, term[take], value[take], self._real[take]
        del self._term, self._real, self._starts
        self.centroids, self.upward, self.radii = np.zeros((len(nodes), n_terms)), np.zeros((len(nodes), n_terms), np.float32), np.zeros(len(nodes))
        for i, (a, b) in enumerate(nodes):
            lo, hi = self.starts[a], self.starts[b]
            centroid = np.bincount(self.term[lo:hi], real[lo:hi], n_terms) / (b - a)
            dots = np.add.reduceat(real[lo:hi] * centroid[self.term[lo:hi]], self.starts[a:b] - lo)
            self.centroids[i] = centroid
            self.radii[i] = math.sqrt(max(0.0, float(((squares[order[a:b]] + centroid @ centroid) * (1 + SLACK) - 2 * dots).max())))
            most = np.zeros(n_terms)
            np.maximum.at(most, self.term[lo:hi], real[lo:hi])
            self.upward[i] = np.nextafter((most - centroid).astype(np.float32), np.float32(np.inf))

    def _entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = self._starts[rows + 1] - self._starts[rows]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return np.arange(ends[-1]) + np.repeat(self._starts[rows] - ends[:-1], sizes), ends

    def _dots(self, held: tuple, row: int) -> np.ndarray:
        """Inner products of one document with those held."""
        terms, values, at = held
        lo, hi = self._starts[row], self._starts[row + 1]
        dense = np.zeros(len(self.scale))
        dense[self._term[lo:hi]] = self._real[lo:hi]
        return np.add.reduceat(values * dense[terms], at)

    def most(self, at: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """What no document below each node exceeds: the nearer of the ball's bound and that of the terms' own radii."""
        query = weight / self.scale[at]
        centre = self.centroids[:, at] @ query
        away = np.minimum(math.sqrt(float(query @ query)) * self.radii, self.upward[:, at] @ query)
        return (centre + away) * (1 + SLACK) + 1

    def search(self, at: np.ndarray, weight: np.ndarray, floor: int, top: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(rows, scores, documents scored): all rows that score at least the ``top``-th best of the tree and ``floor``, and above 0.

        More rows than that may come. ``weight`` has the whole weights of the query's terms ``at``.
        """
        above = self.most(at, weight)
        dense = np.zeros(len(self.scale), np.int64)
        dense[at] = weight
        open_, best, rows, scores, scored = [(-above[0], 0)], [], [], [], 0
        while open_:
            bound, i = heapq.heappop(open_)
            if -bound < floor:
                break
            if self.children[i]:
                for child in self.children[i]:
                    if above[child] >= floor:
                        heapq.heappush(open_, (-above[child], child))
                continue
            a, b = self.bounds[i]
            lo, hi = self.starts[a], self.starts[b]
            own = np.add.reduceat(dense[self.term[lo:hi]] * self.value[lo:hi], self.starts[a:b] - lo)
            scored += b - a
            keep = np.flatnonzero(own >= max(floor, 1))
            rows.append(self.rows[a + keep])
            scores.append(own[keep])
            best = sorted([*best, *own[keep].tolist()], reverse=True)[:top]
            if len(best) == top:
                floor = max(floor, best[-1])
        return (np.concatenate(rows), np.concatenate(scores), scored) if rows else (np.zeros(0, np.int64), np.zeros(0, np.int64), scored)


def _search(block: Block, weights: np.ndarray, n_docs: int, n_terms: int, top: int, leaf: int) -> Callable:
    """Each task's best documents of every query: (item, doc_id, score, scored); scored is the documents scored in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)) for _ in block.at]
        scored = np.zeros(len(block.at), np.int64)
        held, entries, docs = [], 0, 0

        def flush() -> None:
            nonlocal held, entries, docs
            if not held:
                return
            row, term, value, ids, none = (np.concatenate(x) for x in zip(*held))
            tree = BallTree(row, term, value, np.maximum(weights, 1).astype(float) ** POWER, leaf)
            for i, (at, repeats) in enumerate(zip(block.at, block.repeats)):
                scores, own, missing = best[i]
                found, new, n = tree.search(at, weights[at] * repeats, int(scores[-1]) if len(scores) == top else 0, top)
                scored[i] += n
                scores, own, missing = np.concatenate([scores, new]), np.concatenate([own, ids[found]]), np.concatenate([missing, none[found]])
                order = np.lexsort((own, missing, -scores))[:top]
                best[i] = scores[order], own[order], missing[order]
            held, entries, docs = [], 0, 0

        for batch in batches:
            for first, hashes, bounds in term_rows(batch.column(1)):
                row, term, tf = _matches(hashes, bounds, block.terms)
                if not len(row):
                    continue
                some, dense_row = np.unique(row, return_inverse=True)
                m = 75 + (25 * n_docs * np.diff(bounds)[row].astype(np.int64)) // n_terms
                ids = batch.column(0).slice(first, len(bounds) - 1).take(pa.array(some))
                held.append((dense_row + docs, term, 1_000_000_000 * tf // (1000 * tf + 12 * m), ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False)))
                entries, docs = entries + len(row), docs + len(some)
                if docs >= TREE_DOCS or entries >= TREE_ENTRIES:
                    flush()
        flush()
        sizes = [len(s) for s, _, _ in best]
        if sum(sizes):
            scores, own, missing = (np.concatenate(x) for x in zip(*best))
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(sizes)), sizes), pa.int32()), pa.array(own, pa.int64(), mask=missing), pa.array(scores, pa.int64()), pa.array(np.repeat(scored, sizes), pa.int64())],
                                             ["item", "doc_id", "score", "scored"])

    return run


def ranked(docs: DataFrame, queries: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES, leaf: int = LEAF) -> DataFrame:
    """(item_id, rank, doc_id, score, scored): each query's ``top`` best documents; scored says how many its task had to score.

    ``docs`` has doc_id (long) and text, ``queries`` item_id and text.
    """
    spark = docs.sparkSession
    docs = python_workers(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    kind = queries.schema["item_id"].dataType
    out = spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id long, score long, scored long")
    for block in _blocks(queries, block_bytes):
        counts = {r.what: r.n for r in docs.select("text").mapInArrow(_statistics(block.terms), "what long, n long").groupBy("what").agg(F.sum("n").alias("n")).collect()}
        n_docs, n_terms = counts.get(-1, 0), counts.get(-2, 0)
        if not n_docs:
            return out
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * counts.get(i, 0) + 1))) for i in range(len(block.terms))], np.int64)
        lists = docs.mapInArrow(_search(block, weights, n_docs, n_terms, top, leaf), "item int, doc_id long, score long, scored long")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        ids = spark.createDataFrame(list(enumerate(block.ids)), f"item int, item_id {kind.simpleString()}")
        out = out.unionByName(stored(best.join(ids, "item").select("item_id", "rank", "doc_id", "score", "scored"), "ranked"))
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select("item_id", "rank", "doc_id", "score")
