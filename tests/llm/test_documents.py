"""Operators on documents against SQL, brute force and a round trip, with odd rows, empty tables and clashing columns."""

import math
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from checks.compare import compare, duck
from ledgerproof.llm import exact_dedup, jaccard_join, mixing, occurrences, packing, quality_rules, registry, substring_dedup
from ledgerproof.llm.components import components
from tests.llm import brute
from tests.llm.frames import documents, odd_rows, random_rows

DATA = "/root/testdata/sf0.001"


def plain(frame, *columns):
    return Counter(map(tuple, frame.select(*columns).collect()))


@pytest.mark.parametrize("name", ["op4_resolve_revisits", "op6_quality_rules", "op7_exact_dedup"])
def test_query_equals_sql(spark, name):
    ok, text = compare(spark, duck(DATA), DATA, name, registry.queries()[name], registry.oracle_sql()[name])
    assert ok, text


@pytest.mark.parametrize("module", [quality_rules, exact_dedup])
def test_odd_rows_equal_sql(spark, module, tmp_path):
    documents(spark, odd_rows()).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    found = module.query(spark, str(tmp_path))
    assert Counter(con.sql(f"SELECT {', '.join(found.columns)} FROM ({module.SQL})").fetchall()) == Counter(map(tuple, found.collect()))


@pytest.mark.parametrize("rows", [random_rows(), random_rows(9, 20), odd_rows()], ids=["random", "more", "odd"])
def test_near_components(spark, rows):
    found = jaccard_join.jaccard_components(documents(spark, rows))
    assert plain(found, "doc_id", "n_shingles", "component_id") == Counter(brute.near_components(rows))


def test_near_chain_and_threshold(spark):
    """a-b and b-c link, a-c do not; three of four shingles link, fewer do not."""
    words = [f"v{i}" for i in range(60)]
    chain = [" ".join(words[i:i + 40]) for i in (0, 4, 8)]
    edge = [" ".join(words[:7]), " ".join(words[:8]), " ".join(words[10:16]), " ".join(words[10:18])]
    rows = list(enumerate(chain + edge))
    assert plain(jaccard_join.jaccard_components(documents(spark, rows)), "doc_id", "n_shingles", "component_id") == Counter(brute.near_components(rows))


def test_texts_just_outside_each_other(spark):
    """Hundreds of texts near one base, few of which link: groups, not pairs, meet, and no link is lost."""
    rng = random.Random(11)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(400):
        words = list(base)
        for at in rng.sample(range(120), rng.choice([1, 3, 4, 5])):
            words[at] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    found = jaccard_join.jaccard_components(documents(spark, rows))
    assert plain(found, "doc_id", "n_shingles", "component_id") == Counter(brute.near_components(rows))


def test_bounds_grow_with_groups_not_pairs(spark):
    """2,000 sets outside the star of their group: rows of the bound join stay in step with the sets."""
    made = {}
    for n in (500, 2000):
        sets = [(i, t, 40, 3, True, 0, n, i > 0) for i in range(n) for t in range(30)]
        rare = spark.createDataFrame(sets, "sid long, token long, n int, need int, small boolean, grp long, members int, outside boolean")
        bound = jaccard_join._bounded(rare)
        matrix = rare.groupBy("token", "grp").count().count()
        made[n] = (matrix, bound.count())
    assert made[500] == (30, 499) and made[2000] == (30, 1999)


@pytest.mark.parametrize("rows", [random_rows(), random_rows(5, 20), odd_rows()], ids=["random", "more", "odd"])
def test_repeated_passages(spark, rows):
    found = substring_dedup.remove_repeats(documents(spark, rows))
    assert plain(found, "doc_id", "n_words", "n_removed", "kept_sha256") == Counter(brute.without_repeats(rows))


def test_ranges_follow_the_bytes(spark, monkeypatch):
    """Many ranges in one task, one held at a time, give the same result; their number grows with the text, not with the tasks."""
    assert occurrences.range_bits(1 << 20, 8) == 6 and occurrences.range_bits(0, 200) == 9
    assert occurrences.range_bits(10**14, 200) == 20 and 10**14 / 2**20 <= occurrences.RANGE
    monkeypatch.setattr(occurrences, "RANGE", 16)
    rows = random_rows()
    assert occurrences.range_bits(sum(len(t) for _, t in rows), 8) > 8
    assert plain(substring_dedup.remove_repeats(documents(spark, rows)), "doc_id", "n_words", "n_removed", "kept_sha256") == Counter(brute.without_repeats(rows))


def test_copies_of_one_passage_text_can_be_split(spark):
    """The whole texts meet a stored table by their content, not an aggregate of the same stage, so a hot content is several tasks."""
    rows = [(i, " ".join(f"c{j}" for j in range(60))) for i in range(50)] + [(99, "alone " * 3)]
    found = substring_dedup.remove_repeats(documents(spark, rows))
    assert {(x.n_words, x.n_removed) for x in found.collect() if x.doc_id < 99} == {(60, 60)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Deduplicate" not in plan


def test_cover_has_every_difference():
    period, cover = substring_dedup.PERIOD, substring_dedup.COVER
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_repeat_within_one_text(spark):
    words = [f"q{i}" for i in range(36)]
    rows = [(1, " ".join(words + ["gap"] + words)), (2, " ".join(["same"] * 40)), (3, " ".join(["once"] * 35))]
    assert plain(substring_dedup.remove_repeats(documents(spark, rows)), "doc_id", "n_words", "n_removed", "kept_sha256") == Counter(brute.without_repeats(rows))


@pytest.mark.parametrize("rows", [random_rows(), odd_rows() + [(20, "a <|endoftext|> b<|startoftext|>c <|endoftext|><|endoftext|> d")]], ids=["random", "odd"])
def test_packing_round_trip(spark, rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.vocabulary_path())
    expected = Counter()
    for d, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        expected.update((d, i, s, len(ids[s:s + 2048]), zlib.crc32(ids[s:s + 2048].tobytes())) for i, s in enumerate(range(0, len(ids), 2048)))
    packed = packing.pack(packing.token_pieces(documents(spark, rows))).collect()
    assert Counter((x.doc_id, x.piece, x.start, x.length, x.ids_crc32) for x in packed) == expected
    bins = defaultdict(list)
    for x in packed:
        bins[x.sequence_id].append((x.offset, x.length))
    for own in bins.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 2048


def test_packing_in_many_tasks_stays_tight(spark):
    rng = random.Random(2)
    pieces = spark.createDataFrame([(i, rng.choice([1, 7, 100, 900, 1100, 2048])) for i in range(4000)], "doc_id long, length long").repartition(16)
    packed = packing.pack(pieces, task_bins=150)
    assert packed.count() == 4000
    total = sum(x.length for x in packed.collect())
    assert packed.select("sequence_id").distinct().count() <= 1.03 * math.ceil(total / 2048)
    assert packed.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").isEmpty()


@pytest.mark.parametrize("rows", [random_rows(4, 60), odd_rows()], ids=["random", "odd"])
def test_mixing(spark, rows):
    found = mixing.mix(documents(spark, rows)).collect()
    assert len(found) == len(rows)
    by_source = defaultdict(list)
    for x in found:
        by_source[x.source].append(x)
    expected = brute.targets({s: sum(x.size for x in own) for s, own in by_source.items()})
    for source, own in by_source.items():
        assert own[0].target == pytest.approx(expected[source])
        assert {x.source_size for x in own} == {sum(x.size for x in own)}
        assert all(x.taken == x.copies * x.size and 0 <= x.copies <= 3 for x in own)
        assert abs(sum(x.taken for x in own) - own[0].target) <= max(x.size for x in own)
    assert Counter(map(tuple, mixing.mix(documents(spark, rows)).collect())) == Counter(map(tuple, found))


def test_rates_are_an_exponential_tilt(spark):
    found = mixing.mix(documents(spark, [(4 * i, " ".join(["w"] * (5 + i % 50))) for i in range(400)] + [(4 * i + 1, "w " * 200) for i in range(50)])).where("source = 's0' AND rate < 3").collect()
    logs = {x.size: math.log(x.rate) for x in found}
    sizes = sorted(logs)
    slopes = [logs[s] / s for s in sizes if s > 10]
    assert max(slopes) - min(slopes) < 1e-4


def test_quality_order_does_not_matter(spark):
    docs = documents(spark, random_rows() + odd_rows())
    names = list(quality_rules.RULES)
    one = quality_rules.judge(docs, {n: quality_rules.RULES[n] for n in names})
    other = quality_rules.judge(docs, {n: quality_rules.RULES[n] for n in reversed(names)})
    assert plain(one, "doc_id", "kept") == plain(other, "doc_id", "kept")


def test_components(spark):
    rng = random.Random(8)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(1000, 1060)] + [(5000, i) for i in range(5001, 5400)]
    parent = {}

    def find(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    found = {x.node: x.component for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: find(i) for a, b in links if a != b for i in (a, b)}


def test_components_with_two_roots(spark):
    """After one round node 5 is linked to both roots, which no link of a target shows."""
    links = spark.createDataFrame([(2, 5), (5, 6), (6, 7), (7, 1)], "a long, b long")
    assert {x.node: x.component for x in components(links).collect()} == dict.fromkeys([1, 2, 5, 6, 7], 1)


@pytest.mark.parametrize("shape, size, seed", [("path", 5, 3), ("path", 8, 10), ("path", 12, 47), ("tree", 7, 11), ("tree", 12, 66)])
def test_components_of_shuffled_graphs(spark, shape, size, seed):
    """Paths and random trees with shuffled node numbers, each alone: the round that ends one graph's work would hide another's."""
    rng = random.Random(seed)
    nodes = rng.sample(range(size), size)
    links = [(nodes[i], nodes[i - 1 if shape == "path" else rng.randrange(i)]) for i in range(1, size)]
    found = {x.node: x.component for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == dict.fromkeys(range(size), 0)


@pytest.mark.parametrize("operator", [jaccard_join.jaccard_components, substring_dedup.remove_repeats, exact_dedup.exact_duplicates, exact_dedup.keep_first, mixing.mix, mixing.mixed,
                                      quality_rules.judge, quality_rules.keep_good, jaccard_join.keep_one, lambda d: packing.pack(packing.token_pieces(d))])
def test_empty_table(spark, operator):
    assert operator(documents(spark, odd_rows()).limit(0)).count() == 0


def test_exact_duplicates_with_text_ids(spark):
    """Ids of any type that sorts; null ids are chosen last."""
    rows = [("b", "same text"), ("a", "sametext"), (None, "same  text"), ("c", "other"), (None, None), ("d", " ")]
    found = exact_dedup.exact_duplicates(spark.createDataFrame(rows, "doc_id string, text string"))
    assert plain(found, "doc_id", "keep_id", "group_size", "kept") == Counter(
        [("b", None, 3, False), ("a", None, 3, False), (None, None, 3, True), ("c", "c", 1, True), (None, "d", 2, False), ("d", "d", 2, True)])


def test_letters_of_every_script(spark):
    """Clean prose without upper and lower case is kept; lines of digits are not."""
    rng = random.Random(6)
    rows = [(i, " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(80))) for i, letters in enumerate(["אבגדהו", "ابتثجح", "कखगघचछ", "กขคงจฉ", "가나다라마", "天地玄黄宇", "0123456789"])]
    assert {r.doc_id: r.kept for r in quality_rules.judge(documents(spark, rows)).collect()} == {i: i < 6 for i in range(7)}
