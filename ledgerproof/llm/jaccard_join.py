"""Exact Jaccard join on word shingles through a token-group matrix.

1. Every text becomes its set of distinct shingle hashes; equal sets become one.
2. A set can only link if at most a quarter of its shingles is held by no other set. This is tested on the shingles in a
   fixed part of the hash range (``SAMPLED``; what is missing there is missing), through the exchange of occurrences. Sets
   that fail are done; the others carry on with all their shingles.
3. Partition: sets are grouped by their smallest repeated shingle hash. The most typical member leads; members of at least
   ``LOOSE`` percent similarity to it stay in its group, linked (its star) or not, the rest are groups of their own.
4. Token-group matrix: one row (shingle, group) of the union of the rarest shingles of each group's members. A set that links
   with a member shares a number of these with the group that grows with its size (``least_shared``), which bounds the
   overlap. A set asks larger groups, and its own if it is not in the star. So the thousands of texts that lie just outside
   each other's reach meet as one group, not pair by pair.
5. Groups that qualify are opened in blocks. A block joins what its links connect, so it returns no more links than it has
   sets; links within stars and these are joined to components.

The order "rarest first" comes from a count sketch of fixed size; any order gives the same links.

Nulls: null, empty and blank texts have an empty set, n_shingles 0 and link with nothing. Texts of fewer words than a
shingle are one shingle. Repeated rows have equal sets and one component. A null doc_id is ignored as the smallest of its
component unless it is alone, then its component_id is null. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerproof.llm.base import python_workers, stored, table
from ledgerproof.llm.components import components
from ledgerproof.llm.occurrences import repeats, text_key
from ledgerproof.llm.textscan import mix, owners, pieces, row_bounds, scan, windows

NAME = "op1_ngram_jaccard"
SHINGLE = 5
PERCENT = 75
LOOSE = 40  # similarity to a leader with which a set stays in its group
SAMPLED = 0.4  # part of the hash range that the first test looks at
LEVEL_PART = 16
BLOCK = 256  # sets of one side in an opened block
CELLS, BLOCKS = 1 << 20, 64  # the count sketch: four bytes a cell
SQL = None


def sets(words: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first word, hash) of every distinct shingle, by row and hash."""
    row, left = owners(bounds), np.repeat(bounds[1:], np.diff(bounds)) - np.arange(len(words))
    whole = np.flatnonzero(left >= size)
    hashes = windows(words, size)[whole]
    at, found = [whole], [hashes]
    counts = np.diff(bounds)
    for n in range(1, size):  # texts with fewer words than a shingle
        short = bounds[:-1][counts == n]
        at.append(short)
        found.append(windows(words, n, n)[short] if len(short) else np.zeros(0, np.uint64))
    at, found = np.concatenate(at), np.concatenate(found)
    order = np.lexsort((found, row[at]))
    at, found = at[order], found[order]
    own = row[at]
    first = np.append(True, (found[1:] != found[:-1]) | (own[1:] != own[:-1])) if len(at) else np.zeros(0, bool)
    return own[first], at[first], found[first]


def set_keys(row: np.ndarray, hashes: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(two 64-bit hashes of each row's set, its size)."""
    sums = np.zeros((2, len(hashes) + 1), np.uint64)
    np.cumsum(mix(hashes), out=sums[0, 1:])
    np.cumsum(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), out=sums[1, 1:])
    cuts = np.searchsorted(row, np.arange(rows + 1))
    return np.ascontiguousarray((sums[:, cuts[1:]] - sums[:, cuts[:-1]]).T).view(np.int64), np.diff(cuts)


def _limit(part: float) -> np.uint64:
    return np.uint64(int(part * 2**64) - 1)


def _describe(size: int, part: float):
    """Per text: doc_id, n, sampled, h1, h2, k1, k2."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in pieces(batch.column(1)):
                rows = len(offsets) - 1
                starts, _, words = scan(data, offsets, True)
                row, _, hashes = sets(words, row_bounds(starts, offsets), size)
                keys, n = set_keys(row, hashes, rows)
                sampled = np.bincount(row[hashes <= _limit(part)], minlength=rows)
                own = batch.slice(first, rows)
                yield pa.RecordBatch.from_arrays([own.column(0), *(pa.array(x, pa.int64()) for x in (n, sampled, np.ascontiguousarray(keys[:, 0]), np.ascontiguousarray(keys[:, 1]))), own.column(2), own.column(3)],
                                                 ["doc_id", "n", "sampled", "h1", "h2", "k1", "k2"])

    return run


def _sampled_shingles(size: int, part: float):
    def emit(words: np.ndarray, bounds: np.ndarray, _) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        row, at, hashes = sets(words, bounds, size)
        keys, _ = set_keys(row, hashes, len(bounds) - 1)
        _, one = np.unique(keys, axis=0, return_index=True)  # of equal sets in a chunk, one speaks
        speaks = np.zeros(len(keys), bool)
        speaks[one] = True
        use = (hashes <= _limit(part)) & speaks[row]
        return at[use], hashes[use], keys

    return emit


def _tokens(size: int):
    """Per text: sid, n, its sorted shingle hashes, its group (smallest marked hash), and how typical it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in pieces(batch.column(1)):
                rows = len(offsets) - 1
                starts, _, words = scan(data, offsets, True)
                bounds = row_bounds(starts, offsets)
                row, at, hashes = sets(words, bounds, size)
                cuts = np.searchsorted(row, np.arange(rows + 1))
                groups = []
                for i, marks in enumerate(batch.column(2).slice(first, rows).to_pylist()):
                    a, b = cuts[i], cuts[i + 1]
                    marked = np.isin(at[a:b] - bounds[i], np.frombuffer(marks, np.uint32)) if marks else np.zeros(b - a, bool)
                    own = hashes[a:b][marked]
                    groups.append(int((own if len(own) else hashes[a:b])[0].astype(np.int64)))
                own = batch.slice(first, rows)
                tokens = hashes.tobytes()
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(3), own.column(4), pa.array(groups, pa.int64()), pa.array([tokens[8 * a:8 * b] for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())],
                                                 ["sid", "n", "typical", "grp", "tokens"])

    return run


def _led(percent: int, loose: int):
    """Keep the pairs (a, b, tokens, tokens_b) of at least ``loose`` percent similarity, and say which link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, linked = [], []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                place = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[place] == x).sum())
                keep.append(100 * both >= loose * (len(x) + len(y) - both))
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], ["a", "b", "linked"]).filter(pa.array(keep, pa.bool_()))

    return run


def _similar_size(x: str, y: str, percent: int) -> str:
    return f"100 * least({x}, {y}) >= {percent} * greatest({x}, {y})"


def _sketch(all_sets: DataFrame) -> np.ndarray:
    """Approximate number of sets per hash cell; a fixed 4 MB, however large the corpus."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CELLS, np.uint32)
        for batch in batches:
            for x in batch.column(0):
                np.add.at(cells, (np.frombuffer(x.as_buffer(), np.uint64) & np.uint64(CELLS - 1)).astype(np.int64), 1)
        yield pa.RecordBatch.from_arrays([pa.array(range(BLOCKS), pa.int32()), pa.array([c.tobytes() for c in np.split(cells, BLOCKS)], pa.binary())], ["block", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = np.frombuffer(counts, np.uint32)
                total[block] = total[block] + own if block in total else own
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([c.tobytes() for c in total.values()], pa.binary())], ["block", "counts"])

    blocks = all_sets.select("tokens").mapInArrow(count, "block int, counts binary").repartition("block").mapInArrow(add, "block int, counts binary")
    cells = np.zeros((BLOCKS, CELLS // BLOCKS), np.uint32)
    for block, counts in blocks.collect():
        cells[block] = np.frombuffer(counts, np.uint32)
    return cells.ravel()


def least_shared(n: int, percent: int = PERCENT) -> int:
    """How many of its rarest shingles a set of n must share with a link (``need``); grows with n."""
    return min(-(-percent * n // 100), 1 + n // LEVEL_PART)


def _rarest(cells, percent: int):
    """(token, sid, n, need, small) of the rarest shingles of each set, enough for links to smaller sets.

    A link of sets of n and m >= n shingles overlaps in 2t / (1 + t) * n, so ``small`` marks the fewer ones that do for links
    to sets of the same size or larger ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = cells.value
        for batch in batches:
            columns: tuple[list, ...] = ([], [], [], [], [])
            for sid, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                x = np.frombuffer(x.as_buffer(), np.uint64)
                n = len(x)
                need = least_shared(n, percent)
                length = n + need - -(-percent * n // 100)
                small = n + need - -(-2 * percent * n // (100 + percent))
                seen = counts[(x & np.uint64(CELLS - 1)).astype(np.int64)]
                own = x[np.lexsort((x, seen))[:length]]
                for column, value in zip(columns, (own, np.full(len(own), sid), np.full(len(own), n), np.full(len(own), need), np.arange(len(own)) < small)):
                    column.append(value)
            if columns[0]:
                token, sid, n, need, small = map(np.concatenate, columns)
                yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(sid, pa.int64()), pa.array(n, pa.int32()), pa.array(need, pa.int32()), pa.array(small)], ["token", "sid", "n", "need", "small"])

    return run


def set_components(all_sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(node, component) of the sets (sid, n, typical, grp, tokens) that link with another."""
    spark = all_sets.sparkSession
    leads = all_sets.groupBy("grp").agg(F.max(F.struct("typical", (-F.col("sid")).alias("minus"))).alias("x"), F.count("*").alias("members")).where("members > 1").select("grp", (-F.col("x.minus")).alias("leader"))
    led = all_sets.join(leads, F.col("sid") == F.col("leader"), "left_semi").select("grp", F.col("sid").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("tokens_a"))
    loose = min(LOOSE, percent)
    near = all_sets.join(led, "grp").where(F.col("sid") != F.col("a")).where(_similar_size("n", "na", loose)).select("a", F.col("sid").alias("b"), F.col("tokens_a").alias("tokens"), F.col("tokens").alias("tokens_b"))
    near = stored(near.mapInArrow(_led(percent, loose), "a long, b long, linked boolean"), "led-sets")
    links = near.where("linked").select("a", "b")

    cells = spark.sparkContext.broadcast(_sketch(all_sets))
    rare = all_sets.select("sid", "tokens").mapInArrow(_rarest(cells, percent), "token long, sid long, n int, need int, small boolean")
    shared = rare.groupBy("token").agg(F.count("*").alias("holders")).where("holders > 1").select("token")
    # Sets of groups of two and more: their group, and the star they are in (alone, themselves).
    held = near.select(F.col("b").alias("node"), F.col("a").alias("grp"), F.when(F.col("linked"), F.col("a")).otherwise(F.col("b")).alias("star"))
    whole = stored(held.unionByName(near.select(F.col("a").alias("node"), F.col("a").alias("grp"), F.col("a").alias("star")).distinct()), "groups")

    # Sets against the groups they are not in, from the side of the group with fewer members, and against the rest of their own.
    sizes = whole.groupBy("grp").agg(F.count("*").alias("members"))
    named = rare.join(shared, "token", "left_semi").join(whole.join(sizes, "grp").withColumnRenamed("node", "sid"), "sid", "left")
    outside = (F.col("star") == F.col("sid")) & (F.col("sid") != F.col("grp"))
    named = stored(named.select("token", "sid", "n", "need", "small", F.coalesce("grp", "sid").alias("grp"), F.coalesce("members", F.lit(1)).alias("members"), F.coalesce(outside, F.lit(False)).alias("outside")), "rare-shingles")
    late = stored(_open(_bounded(named), whole, all_sets, percent), "late-links")
    return components(links.unionByName(late))


def _bounded(rare: DataFrame) -> DataFrame:
    """(sid, grp): sets that share enough with the union of a larger group, or of their own; for links to sets of either size."""
    queries = rare.select("token", "sid", "n", "need", "small", F.col("grp").alias("own"), F.col("members").alias("own_members"), "outside")
    matrix = rare.groupBy("token", "grp", "members").agg(F.max("n").alias("largest"), F.min(F.when(F.col("small"), F.col("n"))).alias("smallest"), F.min(F.when(F.col("small"), F.col("need"))).alias("least"), F.count("*").alias("holders"))
    # In its own group a set must share the shingle with another member.
    met = queries.join(matrix, "token").where("(own = grp AND outside AND holders > 1) OR (own <> grp AND (own_members < members OR (own_members = members AND own < grp)))")
    upward, downward = F.col("small") & (F.col("largest") >= F.col("n")), F.col("smallest") <= F.col("n")
    counts = met.where(upward | downward).groupBy("sid", "grp").agg(F.count_if(upward).alias("up"), F.first("need").alias("need"), F.count_if(downward).alias("down"), F.min(F.when(downward, F.col("least"))).alias("least"))
    return counts.where("up >= need OR down >= least").select("sid", "grp")


def _links_in_block(percent: int):
    """Links between the queries and the members of one opened block, as few as connect what they connect."""

    def run(block: pa.Table) -> pa.Table:
        side, sids, stars = block["side"].to_numpy(), block["sid"].to_numpy(), block["star"].to_numpy()
        parent = {x: x for x in stars.tolist()}

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        tokens = [np.frombuffer(x.as_buffer(), np.uint64) for x in block["tokens"]]
        members, queries = np.flatnonzero(side == 1), np.flatnonzero(side == 0)
        found: list[tuple[int, int]] = []
        if len(members) and len(queries):
            size = np.array([len(tokens[i]) for i in members])
            flat = np.concatenate([tokens[i] for i in members])
            order = np.argsort(flat, kind="stable")
            flat, holder = flat[order], np.repeat(np.arange(len(members)), size)[order]
            for i in queries:
                x = tokens[i]
                a, b = np.searchsorted(flat, x, "left"), np.searchsorted(flat, x, "right")
                n = b - a
                at = np.repeat(a - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                both = np.bincount(holder[at], minlength=len(members))
                hit = members[np.flatnonzero(100 * both >= percent * (len(x) + size - both))]
                own = int(stars[i])
                for j in hit[np.unique(stars[hit], return_index=True)[1]].tolist():
                    if root(own) != root(int(stars[j])):
                        parent[root(own)] = root(int(stars[j]))
                        found.append((int(sids[i]), int(sids[j])))
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return run


def _open(bounded: DataFrame, whole: DataFrame, all_sets: DataFrame, percent: int) -> DataFrame:
    """Links of the bounded sets with members of the groups opened for them, in blocks of both."""
    bounded = stored(bounded, "opened")
    asked = bounded.groupBy("grp").agg(F.count("*").alias("asking"))
    member = asked.join(whole, "grp", "left").select("grp", "asking", F.coalesce("node", "grp").alias("sid"), F.coalesce("star", "grp").alias("star"))
    blocks = member.groupBy("grp").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("mine"), F.ceil(F.max("asking") / BLOCK).cast("int").alias("theirs"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    place = lambda n: F.pmod(F.xxhash64("sid"), F.col(n)).cast("int")
    members = member.select("grp", "sid", "star").join(blocks, "grp").select("grp", "sid", "star", F.lit(1).alias("side"), place("mine").alias("m"), every("theirs").alias("q"))
    stars = whole.select(F.col("node").alias("sid"), "star")
    queries = bounded.join(blocks, "grp").join(stars, "sid", "left").select("grp", "sid", F.coalesce("star", "sid").alias("star"), F.lit(0).alias("side"), place("theirs").alias("q"), every("mine").alias("m"))
    held = members.unionByName(queries).join(all_sets.select("sid", "tokens"), "sid").select("grp", "m", "q", "side", "sid", "star", "tokens")
    return held.groupBy("grp", "m", "q").applyInArrow(_links_in_block(percent), "a long, b long")


def jaccard_components(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, part: float = SAMPLED) -> DataFrame:
    """Per input row: doc_id, n_shingles, component_id."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    keyed = python_workers(docs.select("doc_id", "text", *text_key()))
    described = stored(keyed.mapInArrow(_describe(size, part), f"doc_id {kind}, n long, sampled long, h1 long, h2 long, k1 long, k2 long"), "sets")
    distinct = described.where("n > 0").groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("rep"), F.max("sampled").alias("sampled"), F.min(F.struct("k1", "k2")).alias("key"))
    marks = repeats(keyed, _sampled_shingles(size, part), lower=True).select(F.col("k1").alias("h1"), F.col("k2").alias("h2"), "marks")
    held = F.coalesce(F.octet_length("marks") / 4, F.lit(0))
    alive = distinct.where("n > 2").join(marks, ["h1", "h2"], "left").where(held >= F.col("sampled") - F.floor(F.col("n") * (100 - percent) / 100))
    alive = stored(alive.select(F.monotonically_increasing_id().alias("sid"), "h1", "h2", "n", "key.k1", "key.k2", "marks", F.coalesce(F.try_divide(held, F.col("sampled")), F.lit(0.0)).alias("typical")), "alive-sets")
    # One document speaks for each content, so copies of a text are not tokenized and a hot content is no hot key.
    speaker = described.where("n > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("speaker"))
    speaker = stored(speaker.join(alive, ["k1", "k2"]).select(F.col("k1").alias("c1"), F.col("k2").alias("c2"), "speaker", "sid", "marks", "n", "typical"), "speakers")
    texts = keyed.join(speaker, F.expr("doc_id <=> speaker AND k1 = c1 AND k2 = c2")).select("sid", "text", "marks", "n", "typical")
    all_sets = stored(texts.mapInArrow(_tokens(size), "sid long, n long, typical double, grp long, tokens binary").dropDuplicates(["sid"]), "shingle-sets")
    found = set_components(all_sets, percent)
    named = alive.join(found, F.col("sid") == F.col("node")).select("h1", "h2", "n", "component")
    least = distinct.join(named, ["h1", "h2", "n"]).groupBy("component").agg(F.min("rep").alias("component_id"))
    by_set = distinct.join(named, ["h1", "h2", "n"], "left").join(least, "component", "left").select("h1", "h2", "n", F.coalesce("component_id", "rep").alias("component_id"))
    return described.join(by_set, ["h1", "h2", "n"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component (the one with the smallest doc_id) stays, and those that link with nothing."""
    gone = jaccard_components(docs).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
