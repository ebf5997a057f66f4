"""Toxicity by the nearest labelled examples under exact TF-IDF cosine, through a block-max inverted index.

Terms are words (runs of letters and digits, A-Z lower-cased). Every term of the labelled sample is indexed; its inverse
document frequency is scaled by how strongly the term goes with label 1 (chi-square, never below ``FLOOR``). A term that no
example has counts in a text's length like one that one example has, so a text equal to an example has cosine 1. Posting lists
are cut into blocks of ``BLOCK`` neighbouring examples with the largest weight of each. A query takes its terms by falling
upper bound; once the k-th best partial score is above what the terms left can add to a block of examples, that block is
skipped. The k nearest are exact. Their votes weighted by cosine are the only signal; a logistic curve fitted on the
examples, each left out of its own vote, makes them a score. The nearest example is the evidence.

The index is built from at most ``LABELLED`` documents of the learning folds with at most ``MOST_TERMS`` terms in all (taken
by the hash of their id); by these bounds it is small and broadcast. Every text is scored whole. Term weights, k and the power
of the vote were chosen by cross-validation within the learning folds.

Nulls: null, empty and blank texts have no terms and get the calibrated score of a text without evidence; so does a text
that shares no term with any example. Without labels of both kinds the score is the share of label 1 (0.5 if there is none).
Repeated rows score alike. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerproof.llm.base import in_fold, python_workers, stored, table
from ledgerproof.llm.labelled import labelled_sample, logistic, probability
from ledgerproof.llm.textscan import NOT_ALNUM, pieces, row_bounds, scan

NAME = "op2_toxicity"
LABELLED = 4000
MOST_TERMS = 8_000_000  # (example, term) pairs of the index, 16 bytes each
NEAREST = 50
BLOCK = 16  # examples in a block of a posting list
FLOOR, HALF_CHI = 0.2, 60.0  # least scale of a term's weight, and the chi-square that adds a half
FIRST_TERMS = 0.95  # share of a query's total bound that is added up before blocks are judged
SLACK = 1e-9  # more than rounding can add to a sum of at most 1
SQL = None


def term_counts(texts: pa.Array) -> Iterator[tuple[int, list[tuple[np.ndarray, np.ndarray]]]]:
    """(first row, distinct terms and how often each occurs, for every row) per piece of a text column."""
    for first, data, offsets in pieces(texts):
        starts, _, hashes = scan(data, offsets, True, separators=NOT_ALNUM)
        bounds = row_bounds(starts, offsets).tolist()
        found = []
        for a, b in zip(bounds[:-1], bounds[1:]):
            found.append(np.unique(hashes[a:b], return_counts=True))
        yield first, found


def relevance(p: np.ndarray, df: np.ndarray, pos: float, neg: float) -> np.ndarray:
    """Scale of the weight of a term in p of pos examples of label 1 and df - p of neg others: FLOOR to FLOOR + 1."""
    m, n = df - p, pos + neg
    chi = n * (p * (neg - m) - m * (pos - p)) ** 2 / np.maximum(df * (n - df + 1) * pos * neg, 1)
    return FLOOR + np.where(p * neg > m * pos, chi / (chi + HALF_CHI), 0)


def _ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The numbers first[i] to last[i] - 1 of every i, one after the other."""
    sizes = last - first
    return np.arange(int(sizes.sum())) + np.repeat(first - (np.cumsum(sizes) - sizes), sizes)


class Index:
    """Unit TF-IDF vectors of the examples by term, in blocks of neighbouring examples."""

    def __init__(self, terms: np.ndarray, idf: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, labels: np.ndarray, names: list[str]):
        self.terms, self.idf = terms, idf
        n = len(labels)
        weight = self.weight(term, tf)
        norm = np.sqrt(np.bincount(doc, weight**2, n))
        weight = weight / np.where(norm > 0, norm, 1)[doc]
        order = np.lexsort((doc, term))
        self.doc, self.weights, term = doc[order], weight[order], term[order]
        block = self.doc // BLOCK
        new = np.append(True, (term[1:] != term[:-1]) | (block[1:] != block[:-1])) if len(term) else np.zeros(0, bool)
        starts = np.flatnonzero(new)
        self.block_at = np.append(starts, len(term))
        self.block = block[starts]
        self.block_max = np.maximum.reduceat(self.weights, starts) if len(starts) else np.zeros(0)
        self.term_at = np.searchsorted(term[starts], np.arange(len(terms) + 1))
        self.largest = np.maximum.reduceat(self.block_max, self.term_at[:-1]) if len(terms) else np.zeros(0)
        self.n, self.labels, self.names = n, labels, names
        self.curve: np.ndarray | None = None

    def weight(self, term: np.ndarray, tf: np.ndarray) -> np.ndarray:
        return (1 + np.log(np.maximum(tf, 1))) * self.idf[term]

    def numbers(self, hashes: np.ndarray, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """(term numbers, counts, squared weight of the terms that no example has)."""
        if not len(self.terms):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), 0.0
        place = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        hit = self.terms[place] == hashes
        return place[hit], tf[hit], float((((1 + np.log(tf[~hit])) * FLOOR * np.log(self.n + 1)) ** 2).sum())

    def _add(self, first: np.ndarray, last: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Scores of all examples from some spans of postings, q being the query's weight for each span."""
        at = _ranges(first, last)
        return np.bincount(self.doc[at], self.weights[at] * np.repeat(q, last - first), self.n)

    def nearest(self, term: np.ndarray, tf: np.ndarray, leave: slice | None = None, unseen: float = 0.0) -> tuple[np.ndarray, np.ndarray, int]:
        """(examples, cosines, skipped blocks) of the nearest with a positive cosine, best first; exact."""
        if not len(term):
            return np.zeros(0, np.int64), np.zeros(0), 0
        q = self.weight(term, tf)
        q = q / max(np.sqrt((q**2).sum() + unseen), 1e-12)
        bound = q * self.largest[term]
        order = np.argsort(-bound, kind="stable")
        term, q, total = term[order], q[order], np.cumsum(bound[order])
        cut = int(np.searchsorted(total, FIRST_TERMS * total[-1])) + 1
        first, last = self.term_at[term], self.term_at[term + 1]
        scores = self._add(self.block_at[first[:cut]], self.block_at[last[:cut]], q[:cut])
        shown = np.arange(self.n)
        if leave is not None:
            shown = np.delete(shown, leave)
        rest, weight = _ranges(first[cut:], last[cut:]), np.repeat(q[cut:], (last - first)[cut:])
        skipped = 0
        if len(rest):
            places = -(-self.n // BLOCK)
            more = np.bincount(self.block[rest], self.block_max[rest] * weight, places)
            kth = np.partition(scores[shown], -NEAREST)[-NEAREST] if len(shown) > NEAREST else 0.0
            reach = scores[shown] + more[shown // BLOCK] + SLACK >= kth
            shown = shown[reach]
            open_ = np.zeros(places, bool)
            open_[shown // BLOCK] = True
            take = open_[self.block[rest]]
            skipped = int(len(rest) - take.sum())
            scores += self._add(self.block_at[rest[take]], self.block_at[rest[take] + 1], weight[take])
        own = scores[shown]
        if len(own) > NEAREST:
            keep = own >= np.partition(own, -NEAREST)[-NEAREST]
            shown, own = shown[keep], own[keep]
        best = np.lexsort((shown, -own))[:NEAREST]
        best = best[own[best] > 0]
        return shown[best], own[best], skipped

    def vote(self, best: np.ndarray, cosines: np.ndarray) -> float:
        """Share of the votes, weighted by cosine, that are for label 1; none without a neighbour."""
        return float((cosines * self.labels[best]).sum() / cosines.sum()) if len(best) else 0.0


def build_index(docs: DataFrame, labels: DataFrame, bound: int = LABELLED, most_terms: int = MOST_TERMS) -> Index | float:
    """The calibrated index, or the share of label 1 if the sample does not have both labels."""

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, found in term_counts(batch.column(1)):
                part, cuts = batch.slice(first, len(found)), pa.array(np.cumsum([0, *(len(t) for t, _ in found)]), pa.int32())
                terms, tf = (np.concatenate([x[i] for x in found]).astype(np.int64) for i in (0, 1))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.ListArray.from_arrays(cuts, pa.array(terms)), pa.ListArray.from_arrays(cuts, pa.array(tf))], ["doc", "label", "terms", "tf"])

    # Repeated rows are one example; texts that share an id are examples that leave each other out.
    sample = python_workers(labelled_sample(docs, labels, "toxic", bound).select("doc", "text", "label").distinct())
    held = stored(sample.mapInArrow(occurrences, "doc string, label int, terms array<long>, tf array<long>"), "toxic-terms")
    sizes = held.groupBy("doc").agg(F.sum(F.size("terms")).alias("n")).orderBy(F.xxhash64("doc"), "doc").collect()  # one row per labelled document
    fit = np.cumsum([x.n for x in sizes]) <= most_terms
    if not fit.all():
        held = held.where(F.col("doc").isin([x.doc for x, f in zip(sizes, fit) if f]))
    seen = held.toArrow().combine_chunks()
    seen = seen.take(pa.array(sorted(range(len(seen)), key=lambda i, d=seen["doc"].to_pylist(), t=seen["terms"]: (d[i], t[i].values.to_numpy().tobytes())), pa.int64()))
    y = np.array(seen["label"].to_pylist(), np.int64)
    if not len(y) or y.min() == y.max():
        return float(y.mean()) if len(y) else 0.5
    names, n = np.array(seen["doc"].to_pylist(), object), len(y)
    hashes, tf = (seen[c].combine_chunks().flatten().to_numpy() for c in ("terms", "tf"))
    cuts = np.append(0, np.cumsum([len(t) for t in seen["terms"]]))
    doc = np.repeat(np.arange(n), np.diff(cuts))
    terms, term = np.unique(hashes.view(np.uint64), return_inverse=True)
    df, p = np.bincount(term, minlength=len(terms)), np.bincount(term, y[doc], len(terms))
    idf = np.log((n + 1) / df) * relevance(p, df, float(y.sum()), float((1 - y).sum()))
    index = Index(terms, idf, doc, term, tf, y, names.tolist())
    same = [slice(int(a), int(b)) for a, b in zip(np.searchsorted(names, names, "left"), np.searchsorted(names, names, "right"))]
    votes = [index.vote(*index.nearest(term[a:b], tf[a:b], same[i])[:2]) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:]))]
    index.curve = logistic(np.array(votes)[:, None], y, 0.1)
    return index


def score_texts(docs: DataFrame, index: Index | float) -> DataFrame:
    """Per input row: doc_id, held_out, score, predicted, nearest example and its cosine (null without evidence)."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            if isinstance(index, float):
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([index] * n, pa.float64()), pa.array([None] * n, pa.string()), pa.array([None] * n, pa.float64())], ["doc_id", "held_out", "score", "evidence", "cosine"])
                continue
            for first, found in term_counts(batch.column(2)):
                rows = len(found)
                votes, evidence, cosines = np.zeros((rows, 1)), [None] * rows, [None] * rows
                for i, (hashes, counts) in enumerate(found):
                    term, tf, unseen = index.numbers(hashes, counts)
                    best, near, _ = index.nearest(term, tf, unseen=unseen)
                    if len(best):
                        votes[i] = index.vote(best, near)
                        evidence[i], cosines[i] = index.names[best[0]], float(near[0])
                part = batch.slice(first, rows)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(probability(votes, index.curve)), pa.array(evidence, pa.string()), pa.array(cosines, pa.float64())], ["doc_id", "held_out", "score", "evidence", "cosine"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = python_workers(docs.select("doc_id", (~in_fold(F.col("doc_id"))).alias("held_out"), "text")).mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, evidence string, cosine double")
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_texts(docs, build_index(docs, table(spark, sf_dir, "labels"))).select("doc_id", "held_out", "score", "predicted", "evidence", "cosine")
