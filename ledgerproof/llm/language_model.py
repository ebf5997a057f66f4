"""Scores of texts under an n-gram model by deleted interpolation.

``P(token | context)`` mixes maximum-likelihood estimates of every order, from the n-gram down to equal shares of the
vocabulary and one unknown token. The weights depend on the bucket of the context: the longest context that training has seen,
and its frequency in powers of two. They are learned by expectation-maximisation on held-out counts: one in ``FOLD`` learning
documents is deleted from the counts, and its tokens are predicted from what is left. Scores then use all learning documents.

Counts stay distributed. Texts are scanned in chunks; each sends its distinct n-grams (64-bit hashes of words, 56 bits of
those of longer n-grams) once, with their counts, to the owner of the hash range. Owners reply only where other chunks hold
the n-gram too, and hold one range at a time. Replies meet the chunk's texts again, sent as one compressed row a chunk; so an n-gram that a third of all
texts hold arrives once per chunk and nothing larger than a chunk or a range is in one task. The number of ranges follows the
bytes of the texts. Chunks are numbered by the place of the scan, so ``docs`` must be a table that is read the same way twice.

Only bucket weights (a few hundred numbers) and totals reach the driver. Null and empty texts are the end token alone; a null
doc_id counts as empty in the folds; repeated rows count again; without learning documents all counts are 0 and the model is
the uniform one. Other columns are ignored. Results have one row per row, in any order.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerproof.llm.base import python_workers, table
from ledgerproof.llm.textscan import mix, owners, pieces, row_bounds, scan, windows
from ledgerproof.session import scratch_path

NAME = "op11_lm_score"
SQL = None
ORDER = 2
LEARN_BY, LEFT_OUT = 7, 2  # crc32(doc_id) mod 7 = 2 is never learned from
FOLD = 16
CHUNK, RANGE = 4 << 20, 32 << 20  # bytes of text in a chunk and, on average, behind a hash range
ROWS = 256  # rows that are dealt to chunks at a time
ROUNDS, SETTLED = 60, 1e-6
LEVELS = 40  # powers of two of context frequencies
HELD, LEARNED, DELETED = 0, 1, 2  # roles: scored only; learned from; learned from, and deleted while weights are learned

_END = mix(np.array([3], np.uint64))[0]
SENT = "part int, chunk long, k int, role int, hashes binary, counts binary"
REPLIES = "chunk long, part int, k int, n int, places binary, others binary, retained binary, tokens long, retained_tokens long, distinct long"
CHUNKS = "chunk long, role int, ids binary, missing binary, offsets binary, text binary"
RESOLVED = "kind int, held boolean, ids binary, missing binary, sizes binary, known binary, logs binary, counts binary, tokens long, retained_tokens long, distinct long"
SCORES, TUPLES, TOTALS = 0, 1, 2


def roles(doc_id: Column) -> Column:
    """The part a document plays, by the checksum of its id."""
    id_ = F.coalesce(doc_id.cast("string"), F.lit(""))
    deleted = F.crc32(F.concat(id_, F.lit("#")).cast("binary")) % FOLD == 0
    return F.when(F.crc32(id_.cast("binary")) % LEARN_BY == LEFT_OUT, HELD).when(deleted, DELETED).otherwise(LEARNED)


def _squeeze(a: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(a.astype("<u4").reshape(-1).view(np.uint8).reshape(-1, 4).T).tobytes(), 3)


def _expand(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(b), np.uint8).reshape(4, -1).T).reshape(-1).view("<u4").astype(np.int64)


def _pack_hashes(h: np.ndarray, width: int) -> bytes:
    """The leading bytes of sorted hashes, byte by byte, so that the slow ones compress."""
    return np.ascontiguousarray(h.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _unpack_hashes(b: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(b, np.uint8).reshape(width, -1)
    full = np.zeros((planes.shape[1], 8), np.uint8)
    full[:, :width] = planes.T
    return full.reshape(-1).view(">u8").astype(np.uint64)


def _width(k: int) -> int:
    return 8 if k == 1 else 7


class Chunk(NamedTuple):
    number: int
    role: int
    ids: np.ndarray
    missing: np.ndarray
    data: np.ndarray
    offsets: np.ndarray


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    """Runs of rows of one role, in the order of the scan; columns are doc_id, text, role.

    Rows are gathered over batches until a chunk of their role is full, so small batches do not make small chunks.
    """
    number = TaskContext.get().partitionId() << 32
    held: dict[int, list[pa.RecordBatch]] = {r: [] for r in (HELD, LEARNED, DELETED)}
    size = dict.fromkeys(held, 0)

    def cut(r: int) -> Iterator[Chunk]:
        nonlocal number
        rows = pa.Table.from_batches(held[r]).combine_chunks()
        held[r], size[r] = [], 0
        ids, missing = rows.column(0).fill_null(0).to_numpy(), rows.column(0).is_null().to_numpy()
        for first, data, offsets in pieces(rows.column(1), CHUNK):
            last = first + len(offsets) - 1
            yield Chunk(number, r, ids[first:last], missing[first:last], data, offsets)
            number += 1

    for whole in batches:
        for at in range(0, len(whole), ROWS):
            batch = whole.slice(at, ROWS)
            role = batch.column(2).to_numpy()
            for r in held:
                rows = np.flatnonzero(role == r)
                if not len(rows):
                    continue
                part = batch.take(pa.array(rows))
                n = pc.sum(pc.binary_length(part.column(1))).as_py() or 0
                if held[r] and size[r] + n > CHUNK:
                    yield from cut(r)
                held[r].append(part)
                size[r] += n
    for r in held:
        if held[r]:
            yield from cut(r)


class Grams(NamedTuple):
    """A chunk's tokens with ``order`` - 1 starts before and an end after every text, and its distinct n-grams.

    sizes: tokens of each row, starts and end included; of order k, distinct[k - 1] are sorted hashes, own[k - 1] their counts,
    at[k - 1] the place in them of the n-gram that ends at each token (0 where it would begin before the text).
    """

    sizes: np.ndarray
    distinct: list[np.ndarray]
    own: list[np.ndarray]
    at: list[np.ndarray]


def _starts(order: int) -> np.ndarray:
    return mix(np.arange(5, 4 + order, dtype=np.uint64))


def grams(data: np.ndarray, offsets: np.ndarray, order: int) -> Grams:
    starts, _, hashes = scan(data, offsets, True)
    bounds = row_bounds(starts, offsets)
    rows = len(offsets) - 1
    sizes = np.diff(bounds) + order
    ends = np.cumsum(sizes)
    stream = np.empty(len(hashes) + rows * order, np.uint64)
    for j, h in enumerate(_starts(order)):
        stream[ends - sizes + j] = h
    stream[np.arange(len(hashes)) + owners(bounds) * order + order - 1] = hashes
    stream[ends - 1] = _END
    inside = np.arange(len(stream)) - np.repeat(ends - sizes, sizes)
    distinct, own, at = [], [], []
    for k in range(1, order + 1):
        h = stream if k == 1 else (windows(stream, k, k) & ~np.uint64(255))
        valid = np.flatnonzero(inside >= k - 1)
        found, place, count = np.unique(h[valid - k + 1], return_inverse=True, return_counts=True)
        full = np.zeros(len(stream), np.int64)
        full[valid] = place
        distinct.append(found)
        own.append(count)
        at.append(full)
    return Grams(sizes, distinct, own, at)


def _cuts(hashes: np.ndarray, bits: int) -> np.ndarray:
    edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.concatenate([[0], np.searchsorted(hashes, edges), [len(hashes)]])


def _send(order: int, bits: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in _chunks(batches):
            g = grams(c.data, c.offsets, order)
            out = []
            for k in range(1, order + 1):
                cuts = _cuts(g.distinct[k - 1], bits)
                for part in np.flatnonzero(np.diff(cuts)).tolist():
                    a, b = cuts[part], cuts[part + 1]
                    out.append((part, c.number, k, c.role, _pack_hashes(g.distinct[k - 1][a:b], _width(k)), b"" if c.role == HELD else _squeeze(g.own[k - 1][a:b])))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))], ["part", "chunk", "k", "role", "hashes", "counts"])

    return run


def _reply(order: int) -> Callable:
    names = [c.split()[0] for c in REPLIES.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names)

    def told(sent: dict[int, list[tuple]]) -> Iterator[pa.RecordBatch]:
        for k in sorted(sent):
            rows = sent.pop(k)
            distinct, place = np.unique(np.concatenate([r[3] for r in rows]), return_inverse=True)
            learned, deleted, cuts = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64), np.cumsum([0, *(len(r[3]) for r in rows)])
            for (_, _, role, _, counts), a, b in zip(rows, cuts[:-1], cuts[1:]):
                if role != HELD:
                    learned[place[a:b]] += counts
                if role == DELETED:
                    deleted[place[a:b]] += counts
            out = []
            for (part, chunk, role, _, counts), a, b in zip(rows, cuts[:-1], cuts[1:]):
                others = learned[place[a:b]] - (0 if counts is None else counts)
                at = np.flatnonzero(others)
                if len(at):
                    kept = _squeeze((learned - deleted)[place[a:b][at]]) if role == DELETED else b""
                    out.append((chunk, part, k, b - a, _squeeze(np.diff(at, prepend=0)), _squeeze(others[at]), kept, None, None, None))
            if k == 1:
                real = ~np.isin(distinct, _starts(order)) & (learned > 0)
                out.append((-1, 0, 0, 0, b"", b"", b"", int(learned[real].sum()), int((learned - deleted)[real].sum()), int(real.sum())))
            for i in range(0, len(out), 200):
                yield batch(out[i:i + 200])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Ranges come in order, so that one is held at a time.
        sent: dict[int, list[tuple]] = {}
        current = None
        for b in batches:
            for part, chunk, k, role, hashes, counts in zip(*b.columns):
                part, k = part.as_py(), k.as_py()
                if part != current:
                    yield from told(sent)
                    sent, current = {}, part
                counts = counts.as_py()
                sent.setdefault(k, []).append((part, chunk.as_py(), role.as_py(), _unpack_hashes(hashes.as_py(), _width(k)), _expand(counts) if counts else None))
        yield from told(sent)

    return run


def _carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for c in _chunks(batches):
        row = [pa.array([c.number], pa.int64()), pa.array([c.role], pa.int32())]
        row += [pa.array([x], pa.binary()) for x in (c.ids.tobytes(), c.missing.tobytes(), c.offsets.tobytes(), zstandard.compress(c.data.tobytes(), 3))]
        yield pa.RecordBatch.from_arrays(row, ["chunk", "role", "ids", "missing", "offsets", "text"])


def _resolve(order: int, bits: int) -> Callable:
    """A chunk's replies and texts become what scoring needs: counts of every n-gram at every token, and totals of rows."""
    names = [c.split()[0] for c in RESOLVED.split(", ")]
    kinds = [pa.int32(), pa.bool_(), *[pa.binary()] * 6, pa.int64(), pa.int64(), pa.int64()]

    def run(replies: pa.Table, texts: pa.Table) -> pa.Table:
        out = [(TOTALS, None, *[None] * 6, r["tokens"], r["retained_tokens"], r["distinct"]) for r in replies.select(["k", "tokens", "retained_tokens", "distinct"]).to_pylist() if r["k"] == 0]
        for text in texts.to_pylist():
            offsets, role = np.frombuffer(text["offsets"], np.int64), text["role"]
            g = grams(np.frombuffer(zstandard.decompress(text["text"]), np.uint8), offsets, order)
            total = [own.copy() if role != HELD else np.zeros_like(own) for own in g.own]
            retained = [np.zeros_like(own) for own in g.own]
            cuts = [_cuts(d, bits) for d in g.distinct]
            for r in replies.to_pylist():
                k, part = r["k"] - 1, r["part"]
                if cuts[k][part + 1] - cuts[k][part] != r["n"]:
                    raise RuntimeError("the documents were not read the same way twice; store them first")
                at = cuts[k][part] + np.cumsum(_expand(r["places"]))
                total[k][at] += _expand(r["others"])
                if role == DELETED:
                    retained[k][at] = _expand(r["retained"])
            ends = np.cumsum(g.sizes)
            real = np.arange(ends[-1]) - np.repeat(ends - g.sizes, g.sizes) >= order - 1
            row = np.repeat(np.arange(len(ends)), g.sizes)[real]
            words = total[0][g.at[0]][real]
            known, logs = np.bincount(row[words > 0], minlength=len(ends)), np.bincount(row, np.log10(words + 1.0), len(ends))
            counts = np.concatenate([total[k][g.at[k]] for k in range(order)])
            out.append((SCORES, role == HELD, text["ids"], text["missing"], (g.sizes - order + 1).astype(np.int64).tobytes(), known.astype(np.int64).tobytes(), logs.tobytes(), _squeeze(counts), None, None, None))
            if role == DELETED:
                at = np.flatnonzero(real)
                tuples = np.stack([retained[k][g.at[k]][at] for k in range(order)] + [retained[k][g.at[k]][at - 1] for k in range(order - 1)])
                tuples, times = np.unique(tuples, axis=1, return_counts=True)
                out.append((TUPLES, *[None] * 6, _squeeze(np.concatenate([tuples.ravel(), times])), None, None, None))
        return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(zip(*out) if out else [[]] * len(kinds), kinds)], names)

    return run


class Totals(NamedTuple):
    tokens: int
    retained: int
    distinct: int


def components(counts: list[np.ndarray], contexts: list[np.ndarray], tokens: int, distinct: int) -> tuple[np.ndarray, np.ndarray]:
    """(estimates of each order from 0 on, bucket) of tokens; counts[k - 1] are of order k, contexts[k - 1] of the k tokens before."""
    n = len(counts[0])
    parts = [np.full(n, 1 / (distinct + 1)), counts[0] / max(tokens, 1)]
    longest, often = np.zeros(n, np.int64), np.ones(n, np.int64)
    for k, (own, context) in enumerate(zip(counts[1:], contexts), 1):
        seen = context > 0
        parts.append(np.where(seen, own / np.maximum(context, 1), 0.0))
        longest, often = np.where(seen, k, longest), np.where(seen, context, often)
    return np.stack(parts), longest * LEVELS + np.where(longest > 0, np.minimum(np.log2(often).astype(np.int64), LEVELS - 1), 0)


def _expectation(order: int, totals: Totals, weights: np.ndarray) -> Callable:
    """(bucket, component, share): tokens that each component explains; component -1 has their log likelihood."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share, log = np.zeros_like(weights), 0.0
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                *tuples, times = _expand(packed).reshape(2 * order, -1)
                parts, bucket = components(tuples[:order], tuples[order:], totals.retained, totals.distinct)
                mixed = parts * weights[bucket].T
                whole = mixed.sum(0)
                log += float(times @ np.log(whole))
                for j in range(order + 1):
                    share[:, j] += np.bincount(bucket, mixed[j] / whole * times, len(share))
        bucket, j = np.nonzero(share)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(bucket, -1), pa.int32()), pa.array(np.append(j, -1), pa.int32()), pa.array(np.append(share[bucket, j], log), pa.float64())], ["bucket", "component", "share"])

    return run


def open_components(order: int) -> np.ndarray:
    """Which components a bucket can use: orders up to one more than its context's length."""
    return np.arange(order + 1)[None, :] <= (np.arange(order * LEVELS) // LEVELS + 1)[:, None]


def learn_weights(tuples: DataFrame, order: int, totals: Totals) -> np.ndarray:
    """Mixture weights by bucket. One imagined token per component keeps every weight above 0, also in buckets without tokens."""
    usable = open_components(order).astype(float)
    weights, before = usable / usable.sum(1, keepdims=True), -math.inf
    for _ in range(ROUNDS):
        found = tuples.mapInArrow(_expectation(order, totals, weights), "bucket int, component int, share double").groupBy("bucket", "component").agg(F.sum("share").alias("share")).collect()
        log = sum(r.share for r in found if r.bucket < 0)
        share = usable.copy()
        for r in found:
            if r.bucket >= 0:
                share[r.bucket, r.component] += r.share
        weights = share / share.sum(1, keepdims=True)
        if log == 0 or log - before < SETTLED * abs(log):
            break
        before = log
    return weights


def _score(order: int, totals: Totals, weights: np.ndarray) -> Callable:
    unit = math.log10(totals.tokens + totals.distinct + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for held, ids, missing, sizes, known, logs, counts in zip(*(c.to_pylist() for c in batch.columns)):
                sizes, counts = np.frombuffer(sizes, np.int64), _expand(counts).reshape(order, -1)
                full = sizes + order - 1
                real = np.flatnonzero(np.arange(counts.shape[1]) - np.repeat(np.cumsum(full) - full, full) >= order - 1)
                parts, bucket = components([c[real] for c in counts], [c[real - 1] for c in counts[:-1]], totals.tokens, totals.distinct)
                score = np.bincount(np.repeat(np.arange(len(sizes)), sizes), np.log10((parts * weights[bucket].T).sum(0)), len(sizes))
                columns = [pa.array(np.frombuffer(ids, np.int64), mask=np.frombuffer(missing, bool)), pa.array(np.full(len(sizes), held)), pa.array(sizes), pa.array(np.frombuffer(known, np.int64)), pa.array(np.full(len(sizes), totals.tokens)),
                           pa.array(np.frombuffer(logs, float) - sizes * unit), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def scores(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row; doc_id is long."""
    spark = docs.sparkSession
    docs = python_workers(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", roles(F.col("doc_id")).cast("int").alias("role")))
    size = docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    bits = max(6, math.ceil(math.log2(max(size, 1) / RANGE)))
    replies = docs.mapInArrow(_send(order, bits), SENT).repartition("part").sortWithinPartitions("part").mapInArrow(_reply(order), REPLIES)
    met = replies.groupBy("chunk").cogroup(docs.mapInArrow(_carry, CHUNKS).groupBy("chunk")).applyInArrow(_resolve(order, bits), RESOLVED)
    path = scratch_path(spark, "language-model")
    met.write.partitionBy("kind").parquet(path)
    resolved = python_workers(spark.read.schema(RESOLVED).parquet(path))
    sums = resolved.where(F.col("kind") == TOTALS).agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("tokens", "retained_tokens", "distinct")]).head()
    totals = Totals(*sums)
    weights = learn_weights(resolved.where(F.col("kind") == TUPLES).select("counts"), order, totals)
    return resolved.where(F.col("kind") == SCORES).select("held", "ids", "missing", "sizes", "known", "logs", "counts").mapInArrow(
        _score(order, totals, weights), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(table(spark, sf_dir, "documents"))
