"""Held-out accuracy of the classifiers, exactness of their parts, and odd inputs."""

import itertools
import random

import numpy as np
import pytest

from ledgerproof.llm import line_quality, toxicity
from tests.llm.frames import documents, odd_rows

DATA = "/root/testdata/sf0.1"


def auc(y, s):
    order = np.argsort(s, kind="stable")
    rank = np.empty(len(s))
    rank[order] = np.arange(1, len(s) + 1)
    return (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))


@pytest.mark.parametrize("module, label, least", [(toxicity, "toxic", 0.93), (line_quality, "quality", 0.97)])
def test_held_out(spark, module, label, least):
    found = module.query(spark, DATA)
    assert found.count() == spark.read.parquet(f"{DATA}/documents.parquet").count()
    held = found.where("held_out").join(spark.read.parquet(f"{DATA}/labels.parquet"), "doc_id").select("score", "predicted", label).toPandas()
    y, s = held[label].to_numpy(), held["score"].to_numpy()
    assert len(y) > 500 and 0 <= s.min() and s.max() <= 1
    assert auc(y, s) > least
    assert (held["predicted"] == y).mean() > 0.95


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (line_quality, "quality")])
def test_odd_rows(spark, module, label):
    rng = random.Random(5)
    bad = ["vile" if label == "toxic" else "###"] * 6
    rows = [(100 + i, " ".join([f"w{rng.randrange(300)}" for _ in range(60)] + bad * (i % 2)) + "\nlast line") for i in range(200)]
    docs = documents(spark, rows + odd_rows())
    labels = spark.createDataFrame([(100 + i, i % 2 if label == "toxic" else 1 - i % 2, "x") for i in range(200)] + [(1, None, "x"), (None, 1, "x")], f"doc_id long, {label} int, text string")
    train = (lambda d, l: toxicity.build_index(d, l)) if module is toxicity else line_quality.learn
    model = train(docs, labels)
    found = module.score_texts(docs, model).collect()
    assert len(found) == len(rows) + len(odd_rows())
    assert all(0 <= x.score <= 1 and x.predicted in (0, 1) for x in found)
    right = [x.predicted == ((x.doc_id % 2) if label == "toxic" else int(x.score >= 0.3)) for x in found if x.doc_id and x.doc_id >= 100]
    assert np.mean(right) > 0.9
    one_kind = labels.where(f"{label} = 1")
    assert {x.score for x in module.score_texts(docs, train(docs, one_kind)).collect()} == {1.0}
    assert {x.score for x in module.score_texts(docs, train(docs, labels.limit(0))).collect()} == {0.5}
    assert module.score_texts(docs.limit(0), model).count() == 0


def test_nearest_is_exact():
    """The k nearest by brute force, also with an example left out, whatever blocks are skipped; and blocks are skipped."""
    rng = np.random.default_rng(3)
    n, terms, skipped = 1500, 400, 0
    group = np.arange(n)[:, None] // 100 == np.arange(terms)[None, :] % 15  # a hundred neighbours share their rarer terms
    doc, term = np.nonzero(rng.random((n, terms)) < np.where(group, 0.5, np.linspace(0.002, 0.6, terms)))
    tf = rng.integers(1, 6, len(doc))
    idf = np.log((n + 1) / np.maximum(np.bincount(term, minlength=terms), 1)) * rng.choice([0.2, 1.2], terms)
    used = np.unique(term)
    index = toxicity.Index(used.astype(np.uint64) + 1, idf[used], doc, np.searchsorted(used, term), tf, rng.integers(0, 2, n), [str(i) for i in range(n)])
    full = np.zeros((n, len(used)))
    full[doc, np.searchsorted(used, term)] = index.weight(np.searchsorted(used, term), tf)
    full /= np.maximum(np.linalg.norm(full, axis=1), 1e-300)[:, None]
    for round_ in range(80):
        own = np.flatnonzero(rng.random(len(used)) < (0.2 if round_ < 40 else np.where(used % 15 == round_ % 15, 0.6, 0.05)))
        counts = rng.integers(1, 5, len(own))
        q = np.zeros(len(used))
        q[own] = index.weight(own, counts)
        cosines = full @ (q / np.linalg.norm(q))
        leave = slice(7, 9) if round_ % 2 else None
        if leave:
            cosines[leave] = 0
        examples, found, missed = index.nearest(own, counts, leave)
        best = np.sort(cosines)[::-1][:toxicity.NEAREST]
        skipped += missed
        assert np.allclose(found, best[best > 1e-15]) and np.allclose(cosines[examples], found)
    assert skipped > 0


def test_bound_on_terms(spark):
    """More terms than the bound leave examples out, not the text of any document."""
    docs = documents(spark, [(i, " ".join(f"w{i}x{j}" for j in range(50)) + " vile" * (i % 2)) for i in range(100)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id long, toxic int")
    index = toxicity.build_index(docs, labels, most_terms=1000)
    assert 15 <= index.n <= 20 and toxicity.score_texts(docs, index).count() == 100


def test_every_text_finds_its_own_example(spark):
    """Also texts without a word that goes with label 1; and a text equal to an example has cosine 1."""
    rng = random.Random(6)
    rows = [(i, " ".join([f"w{rng.randrange(10**6)}" for _ in range(30)] + ["vile"] * (i % 4 == 0))) for i in range(120)]
    docs = documents(spark, rows)
    index = toxicity.build_index(docs, spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(120)], "doc_id long, toxic int"))
    again = documents(spark, [(1000 + i, t) for i, t in rows] + [(9, "none of these")])
    found = {x.doc_id: x for x in toxicity.score_texts(again, index).collect()}
    learned = [i for i in range(120) if str(i) in index.names]
    assert len(learned) > 60
    assert all(found[1000 + i].evidence == str(i) and abs(found[1000 + i].cosine - 1) < 1e-9 for i in learned)
    assert found[9].evidence is None and found[9].cosine is None


def test_forward_backward_is_exact():
    rng = np.random.default_rng(1)
    row = np.repeat([0, 1, 3, 4], [4, 1, 6, 3])
    x = rng.normal(size=(len(row), 3))
    field = line_quality.Field(rng.normal(size=3), rng.normal(size=(2, 2)))
    good, _ = line_quality.marginals(field, row, x)
    for r in np.unique(row):
        score = x[row == r] @ field.emission
        total = expected = 0.0
        for labels in itertools.product((0, 1), repeat=len(score)):
            weight = np.exp(sum(s * y for s, y in zip(score, labels)) + sum(field.pairs[a, b] for a, b in zip(labels, labels[1:])))
            total, expected = total + weight, expected + weight * np.array(labels)
        assert np.allclose(good[row == r], expected / total)


def test_long_documents_train(spark):
    """Labelled documents of more lines than a document may give are learned from: here no other holds the bad lines."""
    line, window = line_quality.training_lines(1003)
    assert len(line) == line_quality.TRAIN_LINES and line[0] == 0 and line[-1] == 1002
    assert all((np.diff(line[window == w]) == 1).all() for w in range(window.max() + 1))
    assert list(line_quality.training_lines(7)[0]) == list(range(7))
    good = [(i, "\n".join(f"a line of plain words w{i}x{j}" for j in range(5))) for i in range(60)]
    bad = [(100 + i, "\n".join(f"### {j} $$$ {i}" for j in range(1500))) for i in range(20)]
    docs = documents(spark, good + bad)
    labels = spark.createDataFrame([(i, int(i < 100)) for i, _ in good + bad], "doc_id long, quality int")
    found = line_quality.score_texts(docs, line_quality.learn(docs, labels)).collect()
    assert all(x.predicted == int(x.doc_id < 100) for x in found)
