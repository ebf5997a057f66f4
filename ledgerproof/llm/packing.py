"""Best-fit packing of tokenized documents into sequences, with hierarchical merging of residual bins.

Texts become token ids in Arrow batches: each distinct white-space-free piece of text is tokenized once per worker (the
tokenizer drops white space and no token crosses it), then ids are gathered for all words. Documents, closed by id 0, are
cut at the sequence length only if they are longer. Packing moves sizes, not ids. Every partition packs its pieces
best-fit in decreasing order; nearly full bins are final, the others become items that are dealt out anew to fewer tasks
of at most ``task_bins`` and packed again, until one task held all that was left or the rounds are over.

Nulls: a null text is empty and makes one piece of one token (id 0); a null doc_id stays null. Repeated rows are packed as
documents of their own. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerproof.llm.base import python_workers, stored, table
from ledgerproof.llm.textscan import pieces, row_bounds, scan

NAME = "op9_pack_sequences"
LENGTH = 2048
END_ID = 0
NEARLY_FULL = 8  # a bin with at most so many free tokens is final
TASK_BINS = 50_000
ROUNDS = 8
CACHE_WORDS = 3_000_000  # words a worker remembers, about 25 bytes each; then it starts anew
SQL = None


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordIds:
    """Token ids by word hash: sorted hashes, and where each word's ids lie in one flat array."""

    _kept: dict[str, WordIds] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._clear()

    def _clear(self) -> None:
        self.hashes, self.starts, self.sizes, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32), [np.zeros(0, np.uint16)]
        self.flat = self.ids[0]

    @classmethod
    def of(cls, path: str) -> WordIds:
        """One per worker process, however many tasks it runs."""
        if path not in cls._kept:
            cls._kept[path] = cls(path)
        return cls._kept[path]

    def _add(self, hashes: np.ndarray, words: list[str]) -> None:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        ids = [x.ids for x in found]
        sizes = np.fromiter(map(len, ids), np.int32, len(ids))
        flat = np.fromiter((y for x in ids for y in x), np.uint32, int(sizes.sum()))
        if flat.size and flat.max() > 65535:
            raise ValueError("vocabularies above 65,536 entries need a wider id type")
        starts = len(self.flat) + np.cumsum(sizes, dtype=np.int64) - sizes
        self.flat = np.concatenate([self.flat, flat.astype(np.uint16)])
        place = np.searchsorted(self.hashes, hashes)
        self.hashes, self.starts, self.sizes = np.insert(self.hashes, place, hashes), np.insert(self.starts, place, starts), np.insert(self.sizes, place, sizes)

    def encode(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in order, ids per word)."""
        if len(self.hashes) > CACHE_WORDS:
            self._clear()
        distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.minimum(np.searchsorted(self.hashes, distinct), max(0, len(self.hashes) - 1))
        new = np.flatnonzero(self.hashes[place] != distinct) if len(self.hashes) else np.arange(len(distinct))
        if len(new):
            raw = data.tobytes()
            at = first[new]
            self._add(distinct[new], [raw[s:e].decode() for s, e in zip(starts[at].tolist(), ends[at].tolist())])
        place = np.searchsorted(self.hashes, distinct)[inverse]
        sizes = self.sizes[place]
        out = np.cumsum(sizes, dtype=np.int64) - sizes
        ids = self.flat[np.repeat(self.starts[place] - out, sizes) + np.arange(int(sizes.sum()))]
        return ids, sizes


PIECES = "piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, path: str | None = None, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32): documents as ids, the longer ones cut."""
    path = path or vocabulary_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds.of(path)
        for batch in batches:
            for first, data, offsets in pieces(batch.column(1)):
                starts, ends, hashes = scan(data, offsets)
                ids, sizes = words.encode(data, starts, ends, hashes)
                ends_at = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])[row_bounds(starts, offsets)]
                rows, cols = [], ([], [], [], [])
                for row, (a, b) in enumerate(zip(ends_at[:-1].tolist(), ends_at[1:].tolist())):
                    own = np.empty(b - a + 1, "<u4")
                    own[:-1], own[-1] = ids[a:b], end_id
                    for piece, start in enumerate(range(0, len(own), length)):
                        part = own[start:start + length]
                        rows.append(first + row)
                        for col, value in zip(cols, (piece, start, len(part), zlib.crc32(part.tobytes()))):
                            col.append(value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(cols[0], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[1:])],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])

    return python_workers(docs.select("doc_id", "text")).mapInArrow(cut, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {PIECES}")


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Best fit in decreasing order; bins as lists of item indices. Open bins are found by their free space in a bit set."""
    free, bins = 0, []
    by_space: dict[int, list[int]] = {}
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        fitting = free >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            own = by_space[space]
            at = own.pop()
            if not own:
                free &= ~(1 << space)
            bins[at].append(item)
        else:
            space, at = capacity, len(bins)
            bins.append([item])
        if space > size:
            by_space.setdefault(space - size, []).append(at)
            free |= 1 << (space - size)
    return bins


BINS = "fill long, closed boolean, items array<long>, sizes array<int>"


def _pack(bins: DataFrame, length: int, last: bool) -> DataFrame:
    """Bins of each partition packed into fewer bins; last: all of them are final."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if got is None or not len(got):
            return
        got = got.combine_chunks()
        order = np.argsort(np.array([x[0] for x in got["items"].to_pylist()]), kind="stable")  # whatever order rows arrived in
        got = got.take(pa.array(order))
        fill, items, sizes = got["fill"].to_numpy(), got["items"].to_pylist(), got["sizes"].to_pylist()
        packed = best_fit(fill, length)
        total = [int(fill[b].sum()) for b in packed]
        for i in range(0, len(packed), 10_000):
            part = packed[i:i + 10_000]
            yield pa.RecordBatch.from_arrays([
                pa.array(total[i:i + 10_000], pa.int64()), pa.array([last or t >= length - NEARLY_FULL for t in total[i:i + 10_000]]),
                pa.array([[x for j in b for x in items[j]] for b in part], pa.list_(pa.int64())),
                pa.array([[x for j in b for x in sizes[j]] for b in part], pa.list_(pa.int32()))], ["fill", "closed", "items", "sizes"])

    return python_workers(bins).mapInArrow(run, BINS)


def pack(pieces_: DataFrame, length: int = LENGTH, task_bins: int = TASK_BINS, rounds: int = ROUNDS) -> DataFrame:
    """Pieces (with a ``length`` column) with sequence_id and offset; the other columns stay."""
    rows = stored(pieces_.withColumn("_item", F.monotonically_increasing_id()), "pieces")
    single = rows.select(F.col("length").alias("fill"), (F.col("length") >= length - NEARLY_FULL).alias("closed"), F.array("_item").alias("items"), F.array(F.col("length").cast("int")).alias("sizes"))
    final, left = [single.where("closed")], single.where("not closed")
    left = stored(_pack(left.select("fill", "items", "sizes"), length, False), "bins")
    for turn in range(rounds):
        final.append(left.where("closed"))
        left = left.where("not closed")
        count = left.count()
        if not count:
            break
        tasks = -(-count // task_bins)
        last = tasks == 1 or turn == rounds - 1
        dealt = left.select("fill", "items", "sizes")
        dealt = dealt.coalesce(1) if tasks == 1 else dealt.repartition(tasks, F.xxhash64(F.lit(turn), F.col("items")[0]))
        left = stored(_pack(dealt, length, last), "bins")
        if last:
            final.append(left)
            break
    bins = final[0]
    for frame in final[1:]:
        bins = bins.unionByName(frame)
    offsets = F.expr("transform(items, (x, i) -> named_struct('item', x, 'offset', CAST(aggregate(slice(sizes, 1, i), 0, (a, s) -> a + s) AS BIGINT)))")
    places = bins.select(F.col("items")[0].alias("sequence_id"), F.explode(offsets).alias("x")).select("sequence_id", "x.item", "x.offset")
    return rows.join(places, F.col("_item") == F.col("item")).drop("_item", "item")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(token_pieces(table(spark, sf_dir, "documents"))).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
