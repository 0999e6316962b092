"""Source divergence audit against sums over every term and pair, and its tree against a plain sum."""

import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from histmart.llm import common, source_audit


def brute(rows, min_docs=10, top=10):
    """(text, lang, source) -> the result rows, by the contract's sentences."""
    def low(text):
        return re.sub("[A-Z]", lambda m: m.group().lower(), text)

    docs = [([low(t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")], lang or "", source or "") for text, lang, source in rows]
    seen, own = defaultdict(Counter), defaultdict(Counter)
    for terms, lang, _ in docs:
        seen[lang].update(set(terms))
    kept = {lang: sorted(t for t, n in c.items() if n >= min_docs) for lang, c in seen.items()}
    for terms, lang, source in docs:
        own[lang, source].update(t for t in terms if seen[lang][t] >= min_docs)
    whole = defaultdict(Counter)
    for (lang, _), c in own.items():
        whole[lang].update(c)

    def share(counts, lang, term):
        return 1 + 10 ** 9 * (counts[term] + 2) // (sum(counts.values()) + 2 * len(kept[lang]))

    def f(p, q):
        return (p - q) ** 2 // (p + q)

    out = []
    for (lang, source), counts in own.items():
        pairs = [(-sum(f(share(counts, lang, t), share(other, lang, t)) for t in kept[lang]), item)
                 for (x, item), other in own.items() if x == lang and item != source]
        terms = [(-f(share(counts, lang, t), share(whole[lang], lang, t)), t) for t in kept[lang]
                 if counts[t] and share(counts, lang, t) > share(whole[lang], lang, t)]
        for part, found in (("pair", pairs), ("term", terms)):
            found = sorted(found, key=lambda x: (x[0], x[1].encode()))
            out += [(lang, source, part, item, -v, k + 1) for k, (v, item) in enumerate(found) if part == "pair" or k < top]
    return sorted(out)


ROWS = [(" ".join(w for k, w in enumerate(["the", "The", "été", "naïve", "of", "漢字", "x1y", "a_b", "rare\x00word", "z" * 40]) if (i * (k + 3)) % 7 < 4), lang, f"s{i % n}")
        for lang, n in (("en", 7), ("fr", 3), (None, 2)) for i in range(60)]
ROWS += [(None, "en", "s1"), ("", "en", "void"), (None, None, None), ("alone", "xx", "one"), ("alone", "xx", "two"), ("the the of " * 500, "en", "long")]
ROWS += [("the of copy", "en", "hot")] * 90


@pytest.mark.parametrize("block", [128, 3, 1])
def test_result_against_every_term_and_pair(spark, block):
    docs = spark.createDataFrame([(*r, 1, "extra") for r in ROWS], "text string, lang string, source string, p long, item string")
    got = [tuple(r) for r in source_audit.audit(docs, block=block).collect()]
    assert sorted(got) == brute(ROWS)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "text string, lang string, source string")
    assert source_audit.audit(docs).collect() == []


def test_shares_pass_64_bits(spark):
    row = spark.sql(f"SELECT {10 ** 13} AS n, {3 * 10 ** 13} AS total, 1000 AS kept").select(source_audit.share("n", "total", "kept")).first()
    assert row[0] == 1 + 10 ** 9 * (10 ** 13 + 2) // (3 * 10 ** 13 + 2000)


def plain_sum(rows, two, width):
    sums = np.zeros((2 * width, 2 * width) if two else (width, width), np.int64)
    f = source_audit.differ
    for row, n in rows:
        for (s, p, p0), (t, q, q0) in combinations([tuple(np.int64(v) for v in x) for x in row], 2):
            if not two or s < width <= t:
                sums[t, s] += n * (f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0))
    return sums


@given(st.lists(st.tuples(st.dictionaries(st.integers(0, 5), st.integers(3, 6), min_size=1), st.integers(1, 4)), max_size=25), st.booleans())
@settings(max_examples=60, deadline=None)
def test_tree_counts_every_node_with_every_ancestor(rows, two):
    rows = sorted(([(s, p * 10 ** 8, 2 * 10 ** 8) for s, p in sorted(r.items())], n) for r, n in rows)
    width = 3 if two else 6
    tree = source_audit.TermTree(width, two)
    for row, n in rows:
        tree.insert(np.array(row, np.int64), n)
    tree.close(0)
    assert (tree.sums == plain_sum(rows, two, width)).all()


def test_shared_beginnings_are_corrected_once(monkeypatch):
    calls = []
    plain = source_audit.differ
    monkeypatch.setattr(source_audit, "differ", lambda p, q: calls.append(np.broadcast(p, q).size) or plain(p, q))
    tree = source_audit.TermTree(4, False)
    head = [(0, 5 * 10 ** 8, 10 ** 8), (1, 6 * 10 ** 8, 10 ** 8), (2, 7 * 10 ** 8, 10 ** 8)]
    for last in range(50):
        tree.insert(np.array([*head, (3, (10 + last) * 10 ** 7, 10 ** 8)], np.int64), 1)
    before = sum(calls)
    tree.close(0)
    assert before == 4 * 49 * 4  # of each row but the last only its own node has been closed: four terms, four cells
    assert tree.count[0] == 50


def test_letter_runs_in_pieces():
    text = ("Abc é漢 x9Y_z " * 50).encode()
    whole = [w for some in common.letter_runs(text) for w in some]
    assert whole == [w for some in common.letter_runs(text, 7) for w in some]
    assert whole[:6] == [b"abc", "é漢".encode(), b"x", b"y", b"z", b"abc"]
