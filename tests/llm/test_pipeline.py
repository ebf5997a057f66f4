"""The pipeline against plain versions of its stages."""

from collections import Counter, defaultdict

import corpus_pipeline
from ledgerproof.llm.base import DOCUMENT_COLUMNS
from tests.llm import brute

DATA = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    texts = {x.doc_id: x for x in docs.collect()}
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DATA)
        assert docs.columns == DOCUMENT_COLUMNS
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        seen[name] = Counter(x.doc_id for x in docs.collect())
        assert all(tuple(x) == tuple(texts[x.doc_id]) for x in docs.collect())
    good = seen["quality_rules"]
    assert 0 < len(good) < len(texts) and set(good.values()) == {1}
    groups = defaultdict(list)
    for i in good:
        groups["".join(brute.WORD.findall(texts[i].text))].append(i)
    once = {min(own, key=lambda i: (-len(texts[i].text), i)) for own in groups.values()}
    assert set(seen["exact_dedup"]) == once
    near = brute.near_components([(i, texts[i].text) for i in sorted(once)])
    assert set(seen["ngram_jaccard"]) == {d for d, _, c in near if d == c}
    sizes = {i: len(brute.WORD.findall(texts[i].text)) for i in texts}
    by_source = Counter()
    for i in seen["ngram_jaccard"]:
        by_source[texts[i].source] += sizes[i]
    targets = brute.targets(by_source)
    taken = Counter()
    for i, n in seen["mix_sources"].items():
        assert n <= 3
        taken[texts[i].source] += n * sizes[i]
    for source, target in targets.items():
        assert abs(taken[source] - target) <= max(sizes[i] for i in texts if texts[i].source == source)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    pieces = Counter(x.doc_id for x in packed.where("piece = 0").collect())
    assert pieces == seen["mix_sources"]
    assert packed.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").isEmpty()
