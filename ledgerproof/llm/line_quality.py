"""Document quality from a linear-chain conditional random field over lines.

Every line with a word is labelled good or bad. Its features are shares of kinds of characters and words, repetition
within the document, and the same of the line before and the line after; two labels in sequence have a weight too.
The field is trained on at most ``LABELLED`` labelled documents whose lines all take the document's label; of a document of
more than ``TRAIN_LINES`` lines it sees that many, in windows of ``WINDOW`` neighbouring lines spread over the whole document,
and each document counts equally. Scoring covers every line and runs
the forward-backward recursion over each document's lines; the marginals of "good", weighted by line length, are averaged
and calibrated with a logistic curve fitted on the same sample.

Nulls: null, empty and blank texts have no line and get the share of label 1. One line or many, of any length, are alike.
Without labels of both kinds every score is the share of label 1 (0.5 if there is none). Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerproof.llm.base import in_fold, python_workers, table
from ledgerproof.llm.labelled import labelled_sample, logistic, probability
from ledgerproof.llm.textscan import owners, pieces, row_bounds, scan, windows

NAME = "op5_line_quality"
LABELLED = 3000
TRAIN_LINES, WINDOW = 400, 50  # lines that a labelled document gives to training, and in a window of a longer one
THRESHOLD = 0.3
STEPS, RATE, RIDGE = 300, 0.05, 1e-3
SQL = None

# Bytes by kind.
KINDS = {"upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "symbol": b"#*$%&|<>", "stop": b".,;:?", "shout": b"!", "other": range(128, 256)}
_TABLE = np.zeros((256, len(KINDS)), bool)
for _i, _bytes in enumerate(KINDS.values()):
    _TABLE[list(_bytes), _i] = True
FEATURES = len(KINDS) + 6


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of every line with a word, its features, its bytes in words) of one piece of texts."""
    starts, ends, hashes = scan(data, offsets)
    bounds = row_bounds(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros((0, FEATURES)), np.zeros(0)
    row = owners(bounds)
    breaks = np.cumsum(np.append(False, data == 10))[starts]  # line breaks before each word
    first = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (breaks[1:] != breaks[:-1])))
    words = np.diff(np.append(first, len(starts)))
    size = ends - starts
    length = np.add.reduceat(size, first).astype(float)
    shares = []
    for i in range(len(KINDS)):
        total = np.append(0, np.cumsum(_TABLE[data, i], dtype=np.int64))
        shares.append(np.add.reduceat(total[ends] - total[starts], first) / length)
    line_row = row[first]
    line = np.add.reduceat(hashes * (np.arange(len(hashes)) - np.repeat(first, words) + 1).astype(np.uint64), first)
    order = np.lexsort((np.arange(len(line)), line, line_row))
    again = np.zeros(len(line))
    again[order[1:]] = (line[order][1:] == line[order][:-1]) & (line_row[order][1:] == line_row[order][:-1])
    repeated = np.zeros(len(starts))
    whole = np.flatnonzero(np.repeat(bounds[1:], np.diff(bounds)) - np.arange(len(starts)) >= 3)
    if len(whole):
        triple = windows(hashes, 3)[whole]
        order = np.lexsort((triple, row[whole]))
        same = (triple[order][1:] == triple[order][:-1]) & (row[whole][order][1:] == row[whole][order][:-1])
        repeated[whole[order[1:][same]]] = repeated[whole[order[:-1][same]]] = 1
    alone = (np.add.reduceat((size == 1).astype(float), first)) / words
    features = np.column_stack([*shares, np.minimum(length / words, 20) / 10, np.minimum(np.log1p(words), 8) / 4, again, np.add.reduceat(repeated, first) / words, alone, np.ones(len(first))])
    return line_row, features, length


def with_neighbours(row: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Features of each line, of the line before and of the line after; zeros at the ends of a document."""
    before, after = np.zeros_like(features), np.zeros_like(features)
    joined = (row[1:] == row[:-1])[:, None]
    before[1:] = features[:-1] * joined
    after[:-1] = features[1:] * joined
    return np.column_stack([features, before, after])


@dataclass
class Field:
    """Weights of good against bad per feature, of the label pairs (before, after), and the calibration."""

    emission: np.ndarray
    pairs: np.ndarray
    curve: np.ndarray | None = None
    prior: float = 0.5


def marginals(field: Field, row: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(probability of good per line, expected label pairs per line with a line before it), all documents at once."""
    score = np.column_stack([np.zeros(len(x)), x @ field.emission])
    first = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(first, len(row)))
    order = np.argsort(-sizes, kind="stable")
    first, sizes = first[order], sizes[order]
    alive = np.searchsorted(-sizes, -np.arange(1, (sizes[0] if len(sizes) else 0) + 1), "right")
    forward, backward = np.zeros_like(score), np.zeros_like(score)
    for t, n in enumerate(alive):
        at = first[:n] + t
        forward[at] = score[at]
        if t:
            before = forward[at - 1]
            forward[at] += np.logaddexp(before[:, :1] + field.pairs[0], before[:, 1:] + field.pairs[1])
        forward[at] -= forward[at].max(1, keepdims=True)
    for t in range(len(alive) - 2, -1, -1):
        at = first[:alive[t + 1]] + t
        after = backward[at + 1] + score[at + 1]
        backward[at] = np.logaddexp(after[:, :1] + field.pairs[:, 0], after[:, 1:] + field.pairs[:, 1])
        backward[at] -= backward[at].max(1, keepdims=True)
    both = forward + backward
    good = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -50, 50)))
    at = np.flatnonzero(np.append(False, row[1:] == row[:-1])) if len(row) else np.zeros(0, np.int64)
    joint = forward[at - 1][:, :, None] + field.pairs + (score[at] + backward[at])[:, None, :]
    joint = np.exp(joint - joint.max((1, 2), keepdims=True))
    return good, joint / joint.sum((1, 2), keepdims=True)


def document_quality(good: np.ndarray, row: np.ndarray, length: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(length-weighted share of good, whether there is a line) per row."""
    total = np.bincount(row, length, rows)
    return np.bincount(row, good * length, rows) / np.where(total > 0, total, 1), total > 0


def training_lines(n: int, most_lines: int = TRAIN_LINES) -> tuple[np.ndarray, np.ndarray]:
    """(line, window) of the lines that a document of n lines gives to training: all, or windows spread from first to last line."""
    if n <= most_lines:
        return np.arange(n), np.zeros(n, np.int64)
    count = max(1, most_lines // WINDOW)
    first = np.linspace(0, n - most_lines // count, count).astype(np.int64)
    line = (first[:, None] + np.arange(most_lines // count)).ravel()
    return line, np.repeat(np.arange(count), most_lines // count)


def train(row: np.ndarray, features: np.ndarray, length: np.ndarray, labels: np.ndarray, window: np.ndarray | None = None) -> Field:
    """Maximum likelihood with a ridge, by Adam; each document (row) counts equally whatever its number of lines.

    Lines are neighbours within a row and, if given, a window of it.
    """
    doc, y = row, labels[row]
    if window is not None:
        row = np.cumsum(np.append(0, (doc[1:] != doc[:-1]) | (window[1:] != window[:-1])))
    x = with_neighbours(row, features)
    weight = (1 / np.bincount(doc, minlength=len(labels))[doc]) / len(labels)
    field = Field(np.zeros(x.shape[1]), np.zeros((2, 2)))
    at = np.flatnonzero(np.append(False, row[1:] == row[:-1]))
    seen = np.zeros((len(at), 2, 2))
    seen[np.arange(len(at)), y[at - 1], y[at]] = 1
    theta, m, v = np.zeros(x.shape[1] + 4), 0.0, 0.0
    for step in range(1, STEPS + 1):
        field.emission, field.pairs = theta[:-4], theta[-4:].reshape(2, 2)
        good, joint = marginals(field, row, x)
        grad = np.append(x.T @ ((y - good) * weight), ((seen - joint) * weight[at][:, None, None]).sum(0).ravel()) - RIDGE * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta = theta + RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    field.emission, field.pairs = theta[:-4], theta[-4:].reshape(2, 2)
    good, _ = marginals(field, row, x)
    share, has = document_quality(good, doc, length, len(labels))
    field.curve, field.prior = logistic(share[has][:, None], labels[has], 0.1), float(labels.mean())
    return field


def learn(docs: DataFrame, labels: DataFrame, bound: int = LABELLED, most_lines: int = TRAIN_LINES) -> Field | float:
    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in pieces(batch.column(1)):
                rows = len(offsets) - 1
                row, features, length = line_features(data, offsets)
                cuts = np.searchsorted(row, np.arange(rows + 1))
                part = batch.slice(first, rows)
                packed = []
                for a, b in zip(cuts[:-1], cuts[1:]):
                    line, window = training_lines(b - a, most_lines)
                    packed.append(np.column_stack([features[a + line], length[a + line], window]).astype("<f8").tobytes())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(packed, pa.binary())], ["doc", "label", "lines"])

    sample = python_workers(labelled_sample(docs, labels, "quality", bound).select("doc", "text", "label"))
    found = sample.mapInArrow(lines, "doc string, label int, lines binary").orderBy("doc").collect()
    y = np.array([x.label for x in found])
    if not len(found) or y.min() == y.max():
        return float(y.mean()) if len(found) else 0.5
    per = [np.frombuffer(x.lines, "<f8").reshape(-1, FEATURES + 2) for x in found]
    row, table_ = np.repeat(np.arange(len(per)), list(map(len, per))), np.concatenate(per)
    return train(row, table_[:, :-2], table_[:, -2], y, table_[:, -1]) if len(row) else float(y.mean())


def score_texts(docs: DataFrame, field: Field | float, threshold: float = THRESHOLD) -> DataFrame:
    """Per input row: doc_id, held_out, score, predicted, n_lines and n_bad_lines."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for batch in batches:
            for first, data, offsets in pieces(batch.column(2)):
                rows = len(offsets) - 1
                row, features, length = line_features(data, offsets)
                if isinstance(field, float):
                    score, good = np.full(rows, field), np.ones(len(row))
                else:
                    good, _ = marginals(field, row, with_neighbours(row, features))
                    share, has = document_quality(good, row, length, rows)
                    score = np.where(has, probability(share[:, None], field.curve), field.prior)
                part = batch.slice(first, rows)
                counts = np.bincount(row, minlength=rows), np.bincount(row[good < 0.5], minlength=rows)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(score), *(pa.array(c.astype(np.int64)) for c in counts)], ["doc_id", "held_out", "score", "n_lines", "n_bad_lines"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = python_workers(docs.select("doc_id", (~in_fold(F.col("doc_id"))).alias("held_out"), "text")).mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, n_lines long, n_bad_lines long")
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_texts(docs, learn(docs, table(spark, sf_dir, "labels"))).select("doc_id", "held_out", "score", "predicted", "n_lines", "n_bad_lines")
