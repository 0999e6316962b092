"""The pipeline's stages against brute-force versions, and what deleting it leaves."""

import os
import random
import shutil
import subprocess
import sys

import pytest
import tiktoken
from brute import base_counts, simhash
from oracle_check import compare
from pyspark.sql import functions as F
from test_text_judges import DOCS, corpus

import corpus_pipeline
from histmart.llm import byte_bpe, queries

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def toxic(text):
    words = text.split()
    return " ".join(w if k % 12 else "foulword" for k, w in enumerate(words))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with exact and near copies, nulls and junk; labels for most of them."""
    path, pick = str(tmp_path_factory.mktemp("sf")), random.Random(9)
    rows = [(i, toxic(t) if g and i % 10 == 1 else t, lang, source) for i, t, lang, source, g in corpus(150)]
    for i in range(30):
        text = rows[pick.randrange(0, 150)][1]
        rows.append((500 + i, text if i % 2 else text + " the", "en", "s0"))
    rows += [(700, None, None, None), (701, "", "en", "s1"), (702, "zz " * 30, None, "s1")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("n_chars", F.length("text").cast("long")).withColumn("kept", F.lit("theirs"))
    docs.repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(g), int(g and i % 10 == 1)) for i, *_, g in corpus(150)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, names = docs.columns, [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "language_id", "simhash_near_dedup", "mixing", "byte_bpe"]
    before = {r["doc_id"]: r for r in docs.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        rows = docs.collect()
        after = {r["doc_id"]: r for r in rows}
        assert set(after) <= set(before)
        if k < 4:
            assert docs.columns == columns and {r["kept"] for r in rows} == {"theirs"}
        if name == "quality_rules":
            assert not any(base_counts(r["text"])["base_failed"] for r in rows)
            assert all(i in after for i, *_, good in corpus(150) if good)
        elif name == "language_id":
            assert set(after) == set(before)  # nothing but prose is left here
        elif name == "simhash_near_dedup":
            assert {i for i, (_, top) in simhash([(i, r["text"]) for i, r in before.items()]).items() if i == top} == set(after)
            assert len(after) < len(before)
        elif name == "mixing":
            assert len(rows) < len(before) and all(i in after for i in before if i < 150 and i % 10 != 1)
        else:
            tik = tiktoken.Encoding("own", pat_str=queries.split_pattern(), special_tokens={},
                                    mergeable_ranks=byte_bpe.read_ranks(queries.tokenizer_file("byte_bpe_50k.tiktoken")))
            assert len(rows) == last and all(r["n_tokens"] == len(tik.encode_ordinary(before[r["doc_id"]]["text"])) for r in rows)
        before, last = after, len(rows)
    whole = corpus_pipeline.run(spark, folder)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, docs.collect()))


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    for name, query in queries.queries().items():
        assert query(spark, str(tmp_path)).count() == (1 if name.startswith("op9") else 0), name


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_oracle(spark, name):
    r = compare(spark, "/root/testdata/sf0.001", name, queries.queries()[name], queries.oracle_sql()[name])
    assert r["cols_ok"] and r["rows_ok"] and r["hash_ok"], r


def test_entry_without_the_subpackage(tmp_path):
    for name in ("histmart", "__spark_entry__.py"):
        copy = shutil.copytree if os.path.isdir(f"{ROOT}/{name}") else shutil.copy
        copy(f"{ROOT}/{name}", f"{tmp_path}/{name}")
    code = "import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.oracle_sql()), any(q.startswith('op') for q in e.queries()))"
    shutil.rmtree(f"{tmp_path}/histmart/llm")
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120,
                         env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert out.stdout.strip() == "True False", out.stderr
