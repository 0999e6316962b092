import random

import numpy as np
import pytest
from brute import reach, simhash, vectors
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from histmart.llm import components, embedding_dedup, queries
from histmart.llm import simhash as sim

DOCS = "doc_id long, text string, source string"


def near_texts(n=60, seed=3):
    """Random texts, some of them copies with one word changed, in groups."""
    pick = random.Random(seed)
    out = []
    for i in range(n):
        words = [f"w{pick.randrange(400)}" for _ in range(pick.choice([1, 2, 3, 40, 400, 900]))]
        if i % 3 and out:
            words = pick.choice(out)[1].split()
            words[pick.randrange(len(words))] = "changed"
        out.append((i, " ".join(words)))
    return out


def result(spark, rows, **kw):
    got = sim.near_duplicates(spark.createDataFrame([(d, t, "s") for d, t in rows], DOCS), **kw)
    return {r["id"]: (f"{r['fp'] & sim.ALL:016x}", r["component_id"]) for r in got.collect()}


@pytest.mark.parametrize("max_shard", [2048, 4])
def test_simhash_equals_all_pairs(spark, max_shard):
    rows = near_texts() + [(100, None), (101, ""), (102, " \n\t"), (103, "Öl A b"), (104, "Öl a B"), (105, "x" * 200_000), (106, "x y " * 60_000)]
    assert result(spark, rows, max_shard=max_shard) == simhash(rows)
    assert len({c for _, c in simhash(rows).values()}) < len(rows) - 10


def test_simhash_large_group_of_near_fingerprints(spark):
    """All fingerprints near one centre, shards far above the bound: recursion must lose no link."""
    pick = random.Random(5)
    centre = pick.getrandbits(64)
    fps = sorted({centre ^ sum(1 << b for b in pick.sample(range(64), pick.randrange(5))) for _ in range(250)})
    frame = spark.createDataFrame([(sim.signed(f),) for f in fps], "fp long")
    links = [(r["a"] & sim.ALL, r["b"] & sim.ALL) for r in sim.links(frame, 2, max_shard=16).collect()]
    assert all((a ^ b).bit_count() <= 2 for a, b in links)
    pairs = [(a, b) for i, a in enumerate(fps) for b in fps[:i] if (a ^ b).bit_count() <= 2]
    assert reach(fps, links) == reach(fps, pairs)


@given(st.lists(st.integers(0, 2 ** 64 - 1), max_size=40), st.integers(0, 64))
@settings(max_examples=60, deadline=None)
def test_bk_tree_finds_all_within(fps, radius):
    tree = sim.BKTree()
    for f in fps:
        tree.add(f)
    for q in fps[:5]:
        assert sorted(tree.within(q, radius)) == sorted({f for f in fps if (f ^ q).bit_count() <= radius})


def test_simhash_empty_table_and_query_columns(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op2_simhash(spark, str(tmp_path))
    assert got.columns == ["doc_id", "fingerprint", "component_id"] and got.count() == 0


def test_keep_one(spark):
    rows = [(5, "a b c d", 1), (3, "a b c d", 2), (9, "e f g h", 3), (9, "e f g h", 3), (None, "a b c d", 4), (None, None, 5)]
    rows += [(7, "aa bb cc dd", 6), (7, "xx yy zz ww", 7), (None, "k l m n", 8), (None, "k l m n", 8), (7, "e f g h", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long").withColumn("gone", F.lit("x")).withColumn("id", F.lit(1))
    got = sim.keep_one(docs)
    assert got.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["n"]) for r in got.collect()) == [(0, 5), (0, 8), (3, 2), (7, 6), (7, 7), (7, 9)]


def test_components_equal_search(spark):
    pick = random.Random(1)
    pairs = [(pick.randrange(150), pick.randrange(150)) for _ in range(110)] + [(500, k) for k in range(501, 560)] + [(7, 7)]
    pairs += [(k, k + 1) for k in range(1000, 1100)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = reach({x for p in pairs for x in p}, pairs)
    assert {k: v for k, v in want.items() if v != k} == got


def clustered(n=700, dims=24, seed=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims))
    out = [centres[rng.integers(12)] + rng.normal(size=dims) * rng.choice([0.02, 0.25, 0.6]) for _ in range(n)]
    return [(i, v.astype(np.float32).tolist()) for i, v in enumerate(out)]


@pytest.mark.parametrize("block_rows", [4096, 64])
def test_embeddings_equal_all_pairs(spark, block_rows):
    rows = clustered()
    rows += [(800 + k, rows[3][1]) for k in range(30)]
    rows += [(900, None), (901, []), (902, [0.0] * 24), (903, [float("nan")] * 24), (904, [float("inf")] + [0.0] * 23), (905, [None] * 24)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("label", F.lit(1)).withColumn("key", F.lit(2))
    got = {r["id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.near_duplicates(frame, block_rows=block_rows).collect()}
    want = vectors(rows)
    assert got == want
    assert sum(n for n, _ in want.values()) > 1000


def test_embeddings_empty_and_all_null(spark):
    for rows in ([], [(1, None), (2, [0.0])]):
        got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
        assert [(r["id"], r["n_links"], r["component_id"], r["kept"]) for r in sorted(got)] == [(i, 0, i, True) for i, _ in rows]


def test_spanning_links_of_a_matrix_keep_its_parts():
    rng = np.random.default_rng(0)
    for n, m, share in ((30, 40, 0.5), (20, 20, 0.08), (1, 50, 0.9), (16, 16, 1.0)):
        link = rng.random((n, m)) < share
        r, c = embedding_dedup.spanning(link)
        assert len(r) <= n + m and link[r, c].all()
        nodes = [*range(n), *range(100, 100 + m)]
        assert reach(nodes, zip(r.tolist(), (c + 100).tolist())) == reach(nodes, [(i, j + 100) for i, j in np.argwhere(link).tolist()])


def test_vectors_of_every_length_are_compared(spark):
    """Copies and near copies of the rarer length link as those of the commoner one do."""
    pick = random.Random(6)
    rows = [(i, [pick.gauss(0, 1) for _ in range(8 if i % 5 < 3 else 12)]) for i in range(60)]
    rows += [(100 + i, v if i % 2 else [x * 1.01 + 0.001 for x in v]) for i, v in rows[:20]] + [(200, [1.0, 2.0, 3.0]), (201, None)]
    got = {r["id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.near_duplicates(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    want = {}
    for size in (0, 3, 8, 12):
        want |= vectors([r for r in rows if len(r[1] or []) == size])
    assert got == want and all(got[100 + i][0] >= 1 for i in range(20))


@pytest.mark.parametrize("dims", [3, 64, 768, 20_000])
def test_single_precision_stays_within_the_bound(dims):
    rng = np.random.default_rng(dims)
    rows = np.vstack([rng.normal(size=(40, dims)), rng.uniform(1, 2, size=(40, dims)), np.ones((1, dims))])
    unit = embedding_dedup.unit(rows)
    single = unit.astype(np.float32)
    assert np.abs(single @ single.T - unit @ unit.T).max() < embedding_dedup.near(dims) / 2
