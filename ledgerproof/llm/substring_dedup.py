"""Removal of word sequences that repeat anywhere in the corpus, found by difference-cover anchors.

A window of ``length`` words repeats if its words also start somewhere else. The positions of a text that are in a
difference cover modulo ``period`` carry anchors, hashes of length - period + 1 words. Two equal windows, wherever they
start, have an offset below the period at which both are on cover positions, so they share an aligned anchor. Round one
sends the anchors only (5 of 21 positions) and learns which of them repeat. Round two extends those: the whole windows
around a repeated anchor are compared, and the words of windows that repeat are removed. Texts without a repeated
anchor are finished after round one.

Nulls: a null text has no words. Texts shorter than a window lose nothing. Equal texts, also of the same doc_id, are
repeats of each other. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerproof.llm.base import python_workers, stored, table
from ledgerproof.llm.occurrences import Emit, repeats, text_key
from ledgerproof.llm.textscan import owners, pieces, row_bounds, scan, windows

NAME = "op10_repeated_passages"
LENGTH = 35
PERIOD, COVER = 21, (0, 1, 4, 14, 16)  # every residue is a difference of two members
SQL = None


def _covered(found: list, starts: np.ndarray, sizes: np.ndarray, back: int, forward: int, total: int) -> np.ndarray:
    """Words from ``back`` before to ``forward`` after a marked word of the same row, as a mask over all words."""
    delta = np.zeros(total + 1, np.int32)
    for start, size, marks in zip(starts.tolist(), sizes.tolist(), found):
        if marks:
            at = np.frombuffer(marks, np.uint32).astype(np.int64)
            np.add.at(delta, start + np.maximum(at - back, 0), 1)
            np.add.at(delta, start + np.minimum(at + forward + 1, size), -1)
    return np.cumsum(delta[:-1]) > 0


def anchors(length: int = LENGTH, period: int = PERIOD, cover: tuple[int, ...] = COVER) -> Emit:
    size, on = length - period + 1, np.isin(np.arange(period), cover)

    def emit(words: np.ndarray, bounds: np.ndarray, _) -> tuple[np.ndarray, np.ndarray, None]:
        row = owners(bounds)
        place = np.arange(len(words)) - bounds[:-1][row]
        left = bounds[1:][row] - np.arange(len(words))
        at = np.flatnonzero(on[place % period] & (left >= size) & (place + left >= length))
        return at, windows(words, size)[at] if len(at) else np.zeros(0, np.uint64), None

    return emit


def around(length: int = LENGTH, period: int = PERIOD) -> Emit:
    def emit(words: np.ndarray, bounds: np.ndarray, marks: list) -> tuple[np.ndarray, np.ndarray, None]:
        sizes = np.diff(bounds)
        near = _covered(marks, bounds[:-1], sizes, period - 1, 0, len(words))
        left = np.repeat(bounds[1:], sizes) - np.arange(len(words))
        at = np.flatnonzero(near & (left >= length))
        return at, windows(words, length, 1)[at] if len(at) else np.zeros(0, np.uint64), None

    return emit


def _finish(length: int, final: bool):
    """doc_id, n_words, n_removed, kept_sha256; unless final, texts with marks are left for later."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in pieces(batch.column(1)):
                rows = len(offsets) - 1
                marks = batch.column(2).slice(first, rows).to_pylist()
                starts, ends, _ = scan(data, offsets)
                bounds = row_bounds(starts, offsets)
                sizes = np.diff(bounds)
                gone = _covered(marks if final else [None] * rows, bounds[:-1], sizes, 0, length - 1, len(starts))
                kept = np.flatnonzero(~gone)
                s, n = starts[kept], ends[kept] - starts[kept] + 1
                out = np.cumsum(n) - n
                text = np.empty(int(n.sum()), np.uint8)
                index = np.repeat(s - out, n) + np.arange(len(text))
                text[:] = data[np.minimum(index, len(data) - 1)] if len(data) else 0
                text[out + n - 1] = 32
                text = text.tobytes()
                byte = np.append(out, len(text))[np.searchsorted(kept, bounds)]
                lost = np.add.reduceat(np.append(gone, False).astype(np.int64), bounds[:-1]) * (sizes > 0) if rows else sizes
                open_ = [bool(m) and not final for m in marks]
                digest = [None if o else hashlib.sha256(text[a:max(a, b - 1)]).hexdigest() for o, a, b in zip(open_, byte[:-1].tolist(), byte[1:].tolist())]
                own = batch.slice(first, rows)
                columns = [own.column(0), pa.array(sizes, pa.int64()), pa.array(lost, pa.int64()), pa.array(digest, pa.string())]
                names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
                if not final:
                    late = pa.array(open_)
                    columns += [own.column(1).filter(late).take(pa.array(np.where(open_, np.cumsum(open_) - 1, 0), pa.int64(), mask=~np.array(open_))), own.column(2), own.column(3), own.column(4)]
                    names += ["text", "marks", "k1", "k2"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, period: int = PERIOD, cover: tuple[int, ...] = COVER) -> DataFrame:
    """Per input row: doc_id, n_words, n_removed, kept_sha256."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    keyed = docs.select("doc_id", "text", *text_key())
    # Stored, so that adaptive execution can split the copies of one text in the joins.
    shared = stored(repeats(keyed, anchors(length, period, cover)), "repeated-anchors")
    joined = keyed.join(shared, ["k1", "k2"], "left").select("doc_id", "text", "marks", "k1", "k2")
    done = f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string"
    rows = stored(python_workers(joined).mapInArrow(_finish(length, False), f"{done}, text string, marks binary, k1 long, k2 long"), "anchored")
    late = rows.where("kept_sha256 IS NULL").select("doc_id", "text", "marks", "k1", "k2")
    removed = stored(repeats(late, around(length, period)), "repeated-windows")
    late = late.drop("marks").join(removed, ["k1", "k2"], "left").select("doc_id", "text", "marks")
    return rows.where("kept_sha256 IS NOT NULL").select("doc_id", "n_words", "n_removed", "kept_sha256").unionByName(late.mapInArrow(_finish(length, True), done))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))
