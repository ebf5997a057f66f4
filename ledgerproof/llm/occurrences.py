"""Which hashes of a corpus occur more than once, told to every text that holds them.

Texts are scanned in chunks. A chunk sends each distinct hash once to the task that owns its hash range; a hash found twice
within the chunk is known to repeat and asks for no reply, so even a hash held by a third of all texts arrives once per
chunk. The number of ranges follows the bytes of the texts (``RANGE``), and a task holds one range at a time, so its memory
does not depend on how many tasks share the work. Range owners sort what they got and reply to the chunks whose hashes others hold too; replies meet the chunk's
list of texts and become word positions per text. Rows in the shuffles are packed arrays, 12 bytes a hash.

A text is known by two 64-bit hashes of its content: equal texts have equal repeats, so nulls or repeats in doc_id do not
matter here.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerproof.llm.base import python_workers
from ledgerproof.llm.textscan import mix, pieces, row_bounds, scan

SILENT = np.uint32(0xFFFFFFFF)  # asks for no reply
HASHES, TEXTS, MARKS = 0, 1, 2
PACKED = "part int, kind int, chunk long, a binary, b binary"
CHUNK = 3 << 20
RANGE = 128 << 20  # bytes of text whose hashes make up one range

#: (word hashes, row bounds, batch rows' marks or None) -> (indices of words, their hashes, keys of the rows or None to keep them)
Emit = Callable[[np.ndarray, np.ndarray, list | None], tuple[np.ndarray, np.ndarray, np.ndarray | None]]


def text_key() -> list[Column]:
    text = F.coalesce("text", F.lit(""))
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    part, kind, chunk, a, b = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(kind, pa.int32()), pa.array(chunk, pa.int64()), pa.array(a, pa.binary()), pa.array(b, pa.binary())],
                                      ["part", "kind", "chunk", "a", "b"])


def _send(emit: Emit, bits: int, lower: bool, marked: bool) -> Callable:
    edges = (np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], 1)
            for first, data, offsets in pieces(batch.column(2), CHUNK):
                starts, _, words = scan(data, offsets, lower)
                bounds = row_bounds(starts, offsets)
                rows = len(offsets) - 1
                at, hashes, other = emit(words, bounds, batch.column(3).slice(first, rows).to_pylist() if marked else None)
                if not len(at):
                    continue
                own = np.ascontiguousarray(keys[first:first + rows] if other is None else other)
                chunk = int(np.bitwise_xor.reduce(mix(own.ravel().view(np.uint64) + mix(np.arange(1, 2 * rows + 1, dtype=np.uint64)))).astype(np.int64))
                order = np.argsort(hashes, kind="stable")
                hashes, at = hashes[order], at[order].astype(np.uint32)
                new = np.append(True, hashes[1:] != hashes[:-1])
                place = np.flatnonzero(new)
                many = np.diff(np.append(place, len(hashes))) > 1
                ask = np.where(many, SILENT, at[place])
                sent = hashes[place]
                cuts = np.concatenate([[0], np.searchsorted(sent, edges), [len(sent)]])
                out = [(i, HASHES, chunk, sent[a:b].tobytes(), ask[a:b].tobytes()) for i, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())) if b > a]
                home = chunk % (1 << bits)
                out.append((home, TEXTS, chunk, own.tobytes(), bounds[:-1].astype(np.uint32).tobytes()))
                local = at[np.repeat(many, np.diff(np.append(place, len(hashes))))]
                if len(local):
                    out.append((home, MARKS, chunk, local.tobytes(), b""))
                yield _batch(out)

    return run


def _replies(hashes: list[np.ndarray], asks: list[np.ndarray], chunks: list[int]) -> Iterator[pa.RecordBatch]:
    """Marks for the chunks whose hashes of one range occur elsewhere too."""
    sizes = np.array([len(x) for x in hashes])
    hashes, asks = np.concatenate(hashes), np.concatenate(asks)
    order = np.argsort(hashes, kind="stable")
    same = np.zeros(len(hashes), bool)
    ordered = hashes[order]
    equal = ordered[1:] == ordered[:-1]
    same[order[1:][equal]] = True
    same[order[:-1][equal]] = True
    # A chunk that asks for no reply holds its hash twice, but every other chunk hears of it.
    ends = np.cumsum(sizes)
    told = np.flatnonzero(same & (asks != SILENT))
    cuts = np.searchsorted(told, np.concatenate([[0], ends]))
    out = [(chunk % (1 << 30), MARKS, chunk, asks[told[a:b]].tobytes(), b"") for chunk, a, b in zip(chunks, cuts[:-1].tolist(), cuts[1:].tolist()) if b > a]
    for i in range(0, len(out), 5000):
        yield _batch(out[i:i + 5000])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replies of the owner of some ranges, which come in order, so that one range is held at a time; lists of texts and
    marks pass through."""
    hashes, asks, chunks, current = [], [], [], None
    for batch in batches:
        kinds = batch.column(1).to_numpy()
        other = np.flatnonzero(kinds != HASHES)
        if len(other):
            yield pa.RecordBatch.from_arrays([c.take(pa.array(other)) for c in batch.columns], batch.schema.names)
        part, chunk = batch.column(0).to_numpy(), batch.column(2).to_numpy()
        for i in np.flatnonzero(kinds == HASHES).tolist():
            if part[i] != current:
                if hashes:
                    yield from _replies(hashes, asks, chunks)
                hashes, asks, chunks, current = [], [], [], part[i]
            hashes.append(np.frombuffer(batch.column(3)[i].as_buffer(), np.uint64))
            asks.append(np.frombuffer(batch.column(4)[i].as_buffer(), np.uint32))
            chunks.append(int(chunk[i]))
    if hashes:
        yield from _replies(hashes, asks, chunks)


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k1, k2, marks) per text: marks are the word positions whose hashes repeat."""
    texts: dict[int, tuple[bytes, bytes]] = {}
    marks: dict[int, list[bytes]] = {}
    for batch in batches:
        for kind, chunk, a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist()):
            if kind == TEXTS:
                texts[chunk] = (a, b)
            else:
                marks.setdefault(chunk, []).append(a)
    for chunk, found in marks.items():
        keys, bounds = np.frombuffer(texts[chunk][0], np.int64).reshape(-1, 2), np.frombuffer(texts[chunk][1], np.uint32)
        at = np.unique(np.frombuffer(b"".join(found), np.uint32))
        row = np.searchsorted(bounds, at, "right") - 1
        cuts = np.searchsorted(row, np.arange(len(bounds) + 1))
        held = np.flatnonzero(np.diff(cuts))
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys[held, 0]), pa.array(keys[held, 1]), pa.array([(at[cuts[i]:cuts[i + 1]] - bounds[i]).tobytes() for i in held.tolist()], pa.binary())], ["k1", "k2", "marks"])


def range_bits(text_bytes: int, tasks: int) -> int:
    """Leading bits of a hash that name its range: at most ``RANGE`` bytes of text on average, and at least two ranges for each task."""
    return max(6, (2 * tasks).bit_length(), (text_bytes // RANGE).bit_length())


def repeats(texts: DataFrame, emit: Emit, lower: bool = False) -> DataFrame:
    """(k1, k2, marks) of texts with hashes found twice or more; marks holds word positions as little-endian uint32.

    ``texts`` has k1, k2, text and, if the emitter wants them, marks of an earlier round.
    """
    spark = texts.sparkSession
    bits = range_bits(texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0, int(spark.conf.get("spark.sql.shuffle.partitions")))
    columns = ["k1", "k2", "text"] + (["marks"] if "marks" in texts.columns else [])
    sent = python_workers(texts.select(*columns)).mapInArrow(_send(emit, bits, lower, len(columns) == 4), PACKED)
    replies = sent.repartition("part").sortWithinPartitions("part").mapInArrow(_compare, PACKED)
    return replies.repartition("chunk").mapInArrow(_resolve, "k1 long, k2 long, marks binary").dropDuplicates(["k1", "k2"])
