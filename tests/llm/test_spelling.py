"""Spelling variants against every pair of words; the index against a scan."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from histmart.llm import queries, spelling


def words_of(rows):
    """(doc_id, text) -> the vocabulary, by the contract's sentences."""
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(vocabulary):
    """word -> (form, root, n, n_near, form_n); candidates share a deletion of one character."""
    by = defaultdict(set)
    for w in vocabulary:
        for k in range(len(w)):
            by[w[:k] + w[k + 1:]].add(w)
        by[w].add(w)
    found = defaultdict(set)
    for group in by.values():
        for a in group:
            found[a] |= {b for b in group if b != a and near(a, b)}
    form = {}
    for w, n in vocabulary.items():
        best = min(found[w], key=lambda x: (-vocabulary[x], x), default=None)
        form[w] = best if best and vocabulary[best] >= 5 * n else None
    out = {}
    for w, n in vocabulary.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, len(found[w]), vocabulary[form[w]] if form[w] else None)
    return out


def got(df):
    rows = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    out = {r[0]: tuple(r[1:]) for r in rows}
    assert len(out) == len(rows)
    return out


@given(st.lists(st.text("abé", min_size=3, max_size=8), min_size=1, max_size=40, unique=True))
@settings(max_examples=60, deadline=None)
def test_the_index_finds_just_the_words_at_one_error(words):
    index = spelling.FMIndex(words)
    exact = np.array([len(w) // 2 for w in words])
    q, v = index.search(words, exact)
    found = {(words[a], words[b]) for a, b in zip(q, v, strict=True)}
    assert all(near(a, b) for a, b in found)
    for a in words:
        for b in words:
            k = len(a) // 2
            if near(a, b) and a[len(a) - k:] == b[len(b) - k:] and len(b) >= k:
                assert (a, b) in found


@given(st.lists(st.integers(2, 5), max_size=60))
@settings(max_examples=60, deadline=None)
def test_suffixes_are_sorted(symbols):
    text = np.array([*symbols, 0])
    assert spelling.suffix_order(text).tolist() == sorted(range(len(text)), key=lambda k: text[k:].tolist())


@pytest.mark.parametrize("max_shard", [4096, 3])
def test_forms_against_every_pair(spark, max_shard):
    rng = random.Random(5)
    stem = ["".join(rng.choice("abcé") for _ in range(rng.randint(6, 9))) for _ in range(60)]
    rows = [(k, " ".join(rng.choice(stem[:k % 60 + 1]) + rng.choice([""] * 12 + ["a", "X"]) for _ in range(60))) for k in range(300)]
    rows += [(None, "commun" * 2 + " Commun" * 7), (3, None), (4, ""), (4, "×÷ßÀé " * 5), (9, "short " * 9), (9, "short " * 9)]
    rows += [(10 ** 6, "zzzzzz" * 300 + " ")] * 6 + [(11, "Ångström ångströmĀlanger " * 5)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, word string")
    want = brute(words_of(rows))
    assert got(spelling.variants(docs, max_shard=max_shard)) == want
    assert sum(r[0] is not None for r in want.values()) > 5


def test_hot_beginnings_are_dealt_anew_until_they_are_small(spark):
    words = [f"communal{a}{b}{c}" for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh"]
    table = spark.createDataFrame([(w, 5 + k) for k, w in enumerate(words)], "word string, n long")
    rows = spelling.shards(table, 20)
    assert rows.groupBy("shard").count().agg({"count": "max"}).first()[0] <= 64
    found = {r.word: (r.n_near, r.form) for r in spelling.near_words(table, 20).collect()}
    counts = {w: 5 + k for k, w in enumerate(words)}
    assert found == {w: (x[3], min((y for y in words if near(w, y)), key=lambda y: (-counts[y], y))) for w, x in brute(counts).items()}


def test_very_long_text_is_read_in_pieces(spark):
    text = "administration " * 200_000 + "x" * 3_000_000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert got(spelling.variants(docs)) == brute(words_of([(1, text)]))


def test_empty_table(spark):
    assert got(spelling.variants(spark.createDataFrame([], "doc_id long, text string"))) == {}


def test_the_query_against_every_pair_on_the_test_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert got(queries.op13_spelling(spark, sf)) == brute(words_of(rows))
