"""Toxicity votes: the index against a scan of all examples, learning only from what may be learned, held-out accuracy."""

import math
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from histmart.llm import queries, toxicity

SF = "/root/testdata/sf0.1"
VECTORS = st.lists(st.dictionaries(st.integers(0, 7), st.integers(1, 3), min_size=1), min_size=1, max_size=200)


def unit(v):
    terms = tuple(sorted(v))
    return terms, toxicity.unit(terms, [v[t] for t in terms], np.linspace(1, 4, 8))


def scan(vectors, query, k):
    out = []
    for i, (terms, weights) in enumerate(vectors):
        own = dict(zip(terms, weights, strict=True))
        c = 0.0
        for t, w in zip(*query, strict=True):
            if t in own:
                c += w * own[t]
        if c > 0:
            out.append((c, i))
    return sorted(out, key=lambda x: (-x[0], x[1]))[:k]


@given(VECTORS, VECTORS, st.integers(1, 9))
@settings(max_examples=80, deadline=None)
def test_nearest_are_those_of_a_scan(examples, queries_, k):
    vectors = [unit(v) for v in examples]
    index = toxicity.BlockMaxIndex(vectors, 8)
    for q in queries_[:20]:
        assert index.nearest(*unit(q), k) == scan(vectors, unit(q), k)


def test_blocks_that_cannot_reach_the_nearest_are_left_out():
    vectors = [unit({k % 4: 1, 4 + k % 4: 1 + k % 3}) for k in range(64 * 40)]
    index = toxicity.BlockMaxIndex(vectors, 8)
    assert index.nearest(*unit({1: 1, 5: 2}), 5) == scan(vectors, unit({1: 1, 5: 2}), 5)
    assert index.visited < index.n_blocks / 2


def test_votes_by_hand():
    idf = np.array([1.0, 2.0])
    model = toxicity.Model.of(["bad", "nice"], idf, [(7, (0,), (1,), 1), (3, (0,), (1,), 1), (5, (0, 1), (1, 1), 0), (9, (), (), 0)], 0.25, 25)
    assert model.without == (0 + 0.25) / 2 and model.judge((), ()) == (0.125, [])
    score, evidence = model.judge((0,), (1,))
    c = 1 / math.sqrt(5)
    assert score == pytest.approx((2 + 0.25) / (2 + c ** 4 + 1))
    assert [e[0] for e in evidence] == [3, 5] and evidence[1][1] == pytest.approx(c) and evidence[0][2] == 1.0


def collect(docs, labels, **options):
    return {r.id: r for r in toxicity.scores(docs, labels, **options).collect()}


def corpus(spark, n=400):
    rows, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        name = "".join("abcdefghij"[int(x)] for x in str(i))
        rows.append((i, f"plain words number{i % 7} here {name} {'you Grumbler%s there' % 'abcdefg'[i % 7] if bad else ''}", i))
        labels.append((i, int(bad)))
    return rows, labels


def test_word_beginnings_and_defined_cases(spark):
    rows, labels = corpus(spark)
    rows += [(None, "a grumblerz", 0), (1000, None, 0), (1001, "", 0), (1002, "grumblerxyz! " * 100_000, 0), (0, "another text", 0), (1003, "GRUMBLERS!", 0)]
    labels += [(None, 1), (3, None), (777, 1), (5, 1), (5, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score long")
    out = toxicity.scores(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert len(out) == len(rows)
    by = {r.id: r for r in out}
    assert by[1002].predicted == by[None].predicted == by[1003].predicted == 1
    assert by[1000].score == by[1001].score < 0.1 and not by[1000].evidence
    assert all(0 <= r.score <= 1 for r in out)
    assert all(by[i].predicted == (i % 5 == 0) for i in range(1, 400))
    assert by[5].held_out == (zlib.crc32(b"5") % 5 == 0)
    assert all(zlib.crc32(str(e.id).encode()) % 5 for r in out for e in r.evidence)


def test_held_out_labels_are_not_read(spark):
    rows, labels = corpus(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long")
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    a, b = (collect(docs, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (labels, turned))
    assert a == b


def test_copies_and_one_sided_labels(spark):
    rows, labels = corpus(spark)
    rows += [(5000 + i, "one copied clean text", 0) for i in range(600)]
    labels += [(5000 + i, 0) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long")
    found = collect(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert found[10].predicted == 1 and found[5000].predicted == found[5001].predicted == 0
    clean = collect(docs, spark.createDataFrame([(i, 0) for i in range(50)], "doc_id long, toxic int"))
    assert {r.score for r in clean.values()} == {0.0}
    none = collect(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.score for r in none.values()} == {0.0}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert toxicity.scores(docs, spark.createDataFrame([(1, 1)], "doc_id long, toxic int")).collect() == []


def test_held_out_accuracy_on_the_test_table(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    found = [r for r in queries.op11_toxicity(spark, SF).collect() if r.held_out and r.doc_id in labels]
    toxic = [r for r in found if labels[r.doc_id]]
    right = sum(r.predicted == labels[r.doc_id] for r in found) / len(found)
    assert len(found) > 500 and right > 0.97
    assert sum(r.predicted for r in toxic) / len(toxic) > 0.75
    assert sum(r.predicted for r in found if not labels[r.doc_id]) <= 0.01 * len(found)
    low = [labels[r.doc_id] for r in found if r.score < 0.2]
    high = [labels[r.doc_id] for r in found if r.score > 0.8]
    assert sum(low) / len(low) < 0.05 and sum(high) / len(high) > 0.9  # the scores are near the rates
