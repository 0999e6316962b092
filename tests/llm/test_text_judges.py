import random

import numpy as np
import pytest
from brute import base_counts
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from histmart.llm import common, language_id, mixing, quality_classifier, quality_rules

ENDINGS = {"en": "ing the of and tion er to".split(), "de": "ung der und keit sch die ein".split(), "fr": "eau les que et tion ment un".split()}
STOP = {k: quality_rules.COMMON_WORDS[k][:8] for k in ENDINGS}
DOCS = "doc_id long, text string, lang string, source string"


def prose(lang, n, pick):
    words = [pick.choice(STOP[lang]) if pick.random() < 0.4 else "".join(pick.choices(ENDINGS[lang], k=pick.choice([1, 2, 3]))) for _ in range(n)]
    return " ".join(w + ("." if pick.random() < 0.1 else "") for w in words)


def junk(kind, n, pick):
    base = prose("en", n, pick).split()
    return {"symbols": " ".join(w + pick.choice(["###", "$$$", "&&&"]) for w in base), "upper": " ".join(w.upper() + "!!" for w in base),
            "pipes": " | ".join(w for w in base if len(w) > 4), "repeat": " ".join(base[:12] * (n // 12))}[kind]


def corpus(n=240, seed=7):
    """(id, text, lang, source, good): source s0 holds a third of all rows, source bad mostly junk."""
    pick, rows = random.Random(seed), []
    for i in range(n):
        lang = pick.choice(["en", "en", "de", "fr"])
        source = "s0" if i % 3 == 0 else f"s{pick.randrange(1, 6)}"
        good = pick.random() > 0.2
        text = prose(lang, pick.choice([60, 200, 600]), pick) if good else junk(pick.choice(["symbols", "upper", "pipes", "repeat"]), 240, pick)
        rows.append((i, text, lang if good else "en", source, good))
    return rows


EDGES = [(900, None, None, None), (901, "", "en", "s1"), (902, " \n ", "xx", None), (903, "word " * 40_000, "en", "s0"), (903, "word " * 40_000, "en", "s0")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [r[:4] for r in corpus()] + EDGES
    return spark.createDataFrame(rows, DOCS).withColumn("kept", F.lit("theirs")).withColumn("host", F.lit(1)).repartition(5).cache()


@given(st.text(st.sampled_from("ab \n\t#|é  \x1c"), max_size=150), st.integers(0, 3))
@settings(max_examples=200, deadline=None)
def test_base_counts_equal_brute_force(text, times):
    text = text * (times + 1)
    raw = text.encode()
    words = raw.split()
    assert quality_rules.base_counts(raw, words, quality_rules.histogram(raw, words), quality_rules.Rules()) == base_counts(text)


def test_js_distance():
    p, q = np.array([1, 0, 3]), np.array([0, 2, 0])
    assert quality_rules.js_distance(p, q) == 1 and quality_rules.js_distance(p, 5 * p) == 0
    assert quality_rules.js_distance(p, np.zeros(3)) == 1
    m = (p / 4 + np.array([1, 1, 2]) / 4) / 2
    want = sum(a * np.log2(a / c) / 2 for d in (p / 4, np.array([1, 1, 2]) / 4) for a, c in zip(d, m) if a)
    assert quality_rules.js_distance(p, np.array([1, 1, 2])) == pytest.approx(np.sqrt(want))


def test_quality_rules_equal_brute_force(docs):
    rows = docs.collect()
    refs = {}
    for r in rows:
        raw = (r["text"] or "").encode()
        hist = quality_rules.histogram(raw, raw.split())
        if r["lang"] in quality_rules.COMMON_WORDS and quality_rules.feeds_reference(raw.split(), hist, r["lang"], quality_rules.Rules()):
            refs[r["lang"]] = refs.get(r["lang"], 0) + hist
    got = quality_rules.references(docs)
    assert set(got) == set(refs) == set(ENDINGS) and all((got[k] == refs[k]).all() for k in refs)
    out = quality_rules.quality_rules(docs).collect()
    assert len(out) == len(rows)
    good = {r[0]: r[4] for r in corpus()}
    for r in out:
        want = base_counts(r["text"])
        assert {k: r[k] for k in want} == want
        raw = (r["text"] or "").encode()
        ok = quality_rules.verdict(quality_rules.histogram(raw, raw.split()), len(raw.split()), refs, quality_rules.Rules())[-1]
        assert r["kept"] == (ok and not want["base_failed"]) == good.get(r["doc_id"], False)


def test_quality_rules_guard_short_texts_and_empty_tables(spark):
    refs = {"en": quality_rules.histogram(t := prose("en", 4000, random.Random(1)).encode(), t.split())}
    for n in (20, 30, 45):
        for seed in range(20):
            raw = prose("en", n, random.Random(seed)).encode()
            assert quality_rules.verdict(quality_rules.histogram(raw, raw.split()), n, refs, quality_rules.Rules())[-1]
    assert quality_rules.quality_rules(spark.createDataFrame([], DOCS)).count() == 0


def test_quality_rules_learn_other_languages(spark):
    """Russian has a reference of its own, which tells its junk; Greek has too few documents, so only the base rules judge it."""
    pick, rows = random.Random(5), [r[:4] for r in corpus(60)]

    def other(n, stop, letters):
        return " ".join(pick.choice(stop) if pick.random() < 0.4 else "".join(pick.choices(letters, k=pick.randrange(3, 9))) for _ in range(n))

    russian = [other(pick.choice([60, 200, 500]), "и в не на что он с как это по но из".split(), "абвгдежзиклмнопрстуфя") for _ in range(60)]
    greek = [other(200, "και το να του η της με που από".split(), "αβγδεζηθικλμνοπρστυφω") for _ in range(5)]
    noise = [" ".join(w + "###" for w in x.split()) for x in russian[:6]]
    rows += [(1000 + i, t, "ru", "s1") for i, t in enumerate(russian)] + [(2000 + i, t, "el", "s1") for i, t in enumerate(greek)]
    rows += [(3000 + i, t, "ru", "s1") for i, t in enumerate(noise)] + [(4000, russian[7], None, "s1"), (4001, russian[8], "en", "s1"), (4002, "раз два", "ru", "s1")]
    kept = {r["doc_id"]: r for r in quality_rules.quality_rules(spark.createDataFrame(rows, DOCS).repartition(4)).collect()}
    assert all(kept[1000 + i]["kept"] and kept[1000 + i]["near_lang"] == "ru" for i in range(60)) and all(kept[2000 + i]["kept"] for i in range(5))
    assert not any(kept[3000 + i]["kept"] for i in range(6)) and kept[4000]["kept"] and kept[4001]["kept"] and not kept[4002]["kept"]
    assert all(kept[r[0]]["kept"] == r[4] for r in corpus(60))


def test_language_id(docs):
    good = {r[0]: r for r in corpus() if r[4]}
    out = language_id.identify(docs).collect()
    assert len(out) == docs.count()
    for r in out:
        if r["doc_id"] in good:
            assert r["language"] == good[r["doc_id"]][2] and r["kept"]
        if r["doc_id"] in (900, 901, 902):
            assert (r["language"], r["kept"]) == ("und", False)
    assert len({(r["language"], r["posterior"]) for r in out if r["doc_id"] == 903}) == 1


def test_language_evidence(spark):
    """A text that says little follows its host, its suffix and its tag; a clear text does not."""
    pick = random.Random(3)
    rows = [(i, prose("de" if i % 2 else "en", 80, pick), "de" if i % 2 else "en", "www.eins.de" if i % 2 else "www.one.com") for i in range(80)]
    rows += [(100, "an", None, "www.eins.de"), (101, "an", None, "www.one.com"), (102, prose("de", 60, pick), "en", "www.one.com"), (103, "an", "de", None)]
    got = {r["doc_id"]: r["language"] for r in language_id.identify(spark.createDataFrame(rows, DOCS)).collect()}
    assert (got[100], got[101], got[102], got[103]) == ("de", "en", "de", "de")
    wanted = language_id.Settings(wanted=frozenset(["de"]))
    kept = [r["doc_id"] for r in language_id.identify(spark.createDataFrame(rows, DOCS), wanted).where("kept").collect()]
    assert sorted(kept) == sorted([*range(1, 80, 2), 100, 102, 103])


def test_language_prior_arithmetic():
    own, total, p = language_id.Settings(), np.array([60.0, 40.0, 0.0]), np.array([1.0, 0.0, 0.0])
    h = {"__host_n": 3, "__host_p": [2.0, 1.0, 0.0], "__site_n": 10, "__site_p": [4.0, 6.0, 0.0]}
    world = (total + 1e-3) / (total + 1e-3).sum()
    site = (np.array([3.0, 6, 0]) + 20 * world) / 29
    assert np.exp(language_id.host_prior(h, p, total, own)) == pytest.approx((np.array([1.0, 1, 0]) + 10 * site) / 12)
    assert language_id.suffix_of("a.b.DE.") == "de" and language_id.suffix_of("src0") is None and language_id.site_of("x.y.com") == "y.com"


def test_rare_declared_languages_are_kept(spark):
    """Four documents of a language too rare for a text model, and one beyond the modelled ones."""
    fin = ["hyvää huomenta kaikille, jotka työskentelevät täällä yönä päivänä", "metsässä käveli hiljaa pieni äiti lähellä järveä",
           "tänään syödään lämmintä keittoa äidin pöydässä", "yöllä jäätyi järvi, ja hän lähti hiihtämään"]
    rows = [(i, text, lang, source) for i, text, lang, source, good in corpus() if good]
    rows += [(5000 + k, t * 3, "fi", "s1") for k, t in enumerate(fin)]
    greek = "η γλώσσα μας είναι όμορφη και παλιά, όπως λένε πολλοί άνθρωποι "
    rows += [(6000 + k, greek * (k + 1), "el", "s2") for k in range(6)]
    rows += [(7000, greek, None, "s2")]
    docs = spark.createDataFrame(rows, DOCS)
    found = {r.doc_id: r for r in language_id.identify(docs, language_id.Settings(max_languages=3)).collect()}
    assert all(found[5000 + k].language == "fi" and found[5000 + k].kept for k in range(4))
    assert all(found[6000 + k].language == "el" and found[6000 + k].kept for k in range(6))
    assert found[7000].language == language_id.UND and not found[7000].kept  # nothing names its language


def test_language_id_empty_and_untagged(spark):
    assert language_id.identify(spark.createDataFrame([], DOCS)).count() == 0
    got = language_id.identify(spark.createDataFrame([(1, "some text", None, None)], DOCS)).collect()
    assert [(r["language"], r["kept"]) for r in got] == [("und", False)]


def classified(spark, docs, labels, **kw):
    return quality_classifier.classify(docs, labels, F.col("source"), F.col("lang"), **kw)


def test_quality_classifier_held_out(spark, docs):
    good = {r[0]: int(r[4]) for r in corpus()}
    labels = spark.createDataFrame([(i, q) for i, q in good.items() if i % 2] + [(1, None), (5000, 1), (None, 1)], "doc_id long, quality int")
    out = classified(spark, docs, labels).collect()
    assert len(out) == docs.count()
    held = [r for r in out if r["id"] in good and r["id"] % 2 == 0]
    assert sum(r["kept"] == bool(good[r["id"]]) for r in held) >= 0.95 * len(held)


def test_quality_classifier_posteriors(spark):
    """Equal texts: only hosts and paths differ; posteriors as computed by hand."""
    rows = [(i, "same text", "p1" if i % 4 else "p2", "h1" if i < 40 else "h2") for i in range(80)]
    q = {i: int(i >= 40 or i % 4 == 0) for i, *_ in rows}
    labels = spark.createDataFrame(list(q.items()), "doc_id long, quality int")
    out = {r["id"]: r for r in classified(spark, spark.createDataFrame(rows, DOCS), labels).collect()}
    n = {h: 40 for h in ("h1", "h2")}
    s = {h: sum(q[i] for i, _, _, x in rows if x == h) for h in n}
    world = sum(s.values()) / 80

    def strength(groups):  # (n, sum, parent mean)
        total = sum(g[0] for g in groups)
        spread = sum(a * (b / a - g) ** 2 for a, b, g in groups) / total
        between = spread - sum(g * (1 - g) for *_, g in groups) / total
        within = sum(a * g * (1 - g) for a, _, g in groups) / total
        return min(max(within / between - 1, 1.0), 1e4) if between > 0 else 1e4

    kh = strength([(n[h], s[h], world) for h in n])
    parent = {h: (s[h] + kh * world) / (n[h] + kh) for h in n}
    paths = {}
    for i, _, p, h in rows:
        a = paths.setdefault((h, p), [0, 0])
        a[0] += 1
        a[1] += q[i]
    kp = strength([(a, b, parent[h]) for (h, _), (a, b) in paths.items()])
    for i, _, p, h in rows:
        a, b = paths[h, p]
        host = (s[h] - q[i] + kh * world) / (n[h] - 1 + kh)
        site = (b - q[i] + kp * host) / (a - 1 + kp)
        assert out[i]["site_posterior"] == pytest.approx(min(max(site, 1e-6), 1 - 1e-6))
    assert not out[1]["kept"] and out[50]["kept"]


def test_quality_classifier_without_labels(spark):
    docs = spark.createDataFrame([(1, "a", "en", "s"), (2, None, None, None)], DOCS)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [(r["quality"], r["kept"]) for r in classified(spark, docs, none).collect()] == [(0.5, True)] * 2
    assert classified(spark, spark.createDataFrame([], DOCS), none).count() == 0


def test_logistic_fit_recovers_weights():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 3)) * [1, 5, 0.1] + [0, 2, 1]
    y = (rng.random(4000) < 1 / (1 + np.exp(-(x @ [1, -0.4, 6] - 5)))).astype(float)
    assert quality_classifier.fit_logistic(x, y) == pytest.approx([1, -0.4, 6, -5], rel=0.3)


def test_mixing_reaches_targets(spark, docs):
    good = {r[0]: r[4] for r in corpus()}
    labels = spark.createDataFrame([(i, "good" if g else "junk") for i, g in good.items() if i % 2] + [(1, None)], "doc_id long, kind string")
    out = mixing.mix(docs, labels, F.col("kind"), {"good": 0.6, "junk": 0.4}, anchor="good", tolerance=1e-6, steps=300, keep=["doc_id"]).collect()
    assert len(out) == docs.count() and set(out[0].asDict()) == {"doc_id", "n_tokens", "domain", "posteriors", "rate", "copies"}
    held = [r for r in out if r["doc_id"] in good]
    assert sum((r["domain"] == "good") == good[r["doc_id"]] for r in held) >= 0.95 * len(held)
    p, n, rate = (np.array([r[c] for r in out]) for c in ("posteriors", "n_tokens", "rate"))
    reached, start = (rate * n) @ p, n @ p
    assert reached[0] == pytest.approx(start[0], rel=1e-3) and reached[1] / reached[0] == pytest.approx(0.4 / 0.6, rel=1e-3)
    # the same fit by plain projected gradient on all rows at once
    r, want = np.ones(len(n)), start[0] * np.array([1, 0.4 / 0.6])
    for _ in range(300):
        r = np.maximum(0, r - p @ (((r * n) @ p - want) / start))
    assert rate == pytest.approx(r, abs=1e-4)
    assert all(abs(x["copies"] - x["rate"]) < 1 for x in out)
    wide = mixing.mix(docs, labels, F.col("kind"), {"good": 0.6, "junk": 0.4}, anchor="good", tolerance=1e-6, steps=300, stage=False)
    assert sorted((x["doc_id"], x["copies"]) for x in wide.collect()) == sorted((x["doc_id"], x["copies"]) for x in out)
    assert mixing.realise(wide, ["doc_id"]).count() == sum(x["copies"] for x in out)


def test_mixing_realises_small_rates_and_reports(spark, caplog):
    """A domain thinned to a fiftieth keeps its share of copies, no anchor document is lost, and a miss is logged."""
    pick = random.Random(2)
    rows = [(i, prose("en", 60, pick) if i % 3 == 0 else junk("symbols", 60, pick), "en", "s") for i in range(3000)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, "junk" if i % 3 else "good") for i in range(0, 3000, 5)], "doc_id long, kind string")
    with caplog.at_level("INFO", "histmart.llm.mixing"):
        out = mixing.mix(docs, labels, F.col("kind"), {"good": 0.98, "junk": 0.02}, anchor="good", tolerance=1e-4, steps=200, anchor_floor=1.0,
                         keep=["doc_id"]).collect()
    p, n, rate, copies = (np.array([r[c] for r in out]) for c in ("posteriors", "n_tokens", "rate", "copies"))
    sure = p[:, 1] > 0.99
    assert 1900 < sure.sum() < 2100 and 0 < rate[sure].max() < 0.05
    assert copies[sure].sum() > 0 and abs(copies[sure].sum() - rate[sure].sum()) < 4 * np.sqrt(rate[sure].sum())
    assert all(r["copies"] >= 1 for r in out if r["domain"] == "good")
    want = n @ p[:, 0] * 0.02 / 0.98
    assert abs((copies * n) @ p[:, 1] - want) < 4 * 60 * np.sqrt(want / 60)
    assert "targets reached" in caplog.text and "good: wanted" in caplog.text
    mixing.mix(docs, labels, F.col("kind"), {"good": 0.5, "junk": 0.5}, anchor="good", tolerance=1e-6, steps=0, keep=["doc_id"])
    assert "not reached when the steps ran out" in caplog.text


def test_mixing_replaces_clashing_columns(spark):
    rows = [(i, t, "en", "s") for i, t, *_ in corpus(30)] + [(100, None, None, None)] * 2
    docs = spark.createDataFrame(rows, DOCS).select("*", F.lit("own").alias("p"), F.lit("own").alias("n_tokens"), F.lit("own").alias("rate"))
    labels = spark.createDataFrame([(i, "good" if g else "junk") for i, *_, g in corpus(30)], "doc_id long, kind string")
    for stage in (True, False):
        out = mixing.mix(docs, labels, F.col("kind"), {"good": 1.0, "junk": 0.0}, anchor="good", stage=stage)
        assert sorted(out.columns) == sorted([*docs.columns, "domain", "posteriors", "copies"])
        got = out.collect()
        assert len(got) == 32 and {r["p"] for r in got} == {"own"}
        assert all(r["n_tokens"] == len((r["text"] or "").split()) and isinstance(r["rate"], float) for r in got)


def test_mixing_rates_never_negative_and_edges(spark):
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t, *_ in corpus(60)], DOCS)
    labels = spark.createDataFrame([(i, "good" if g else "junk") for i, *_, g in corpus(60)], "doc_id long, kind string")
    out = mixing.mix(docs, labels, F.col("kind"), {"good": 1.0, "junk": 0.0, "absent": 0.5}, anchor="good").collect()
    assert min(r["rate"] for r in out) >= 0 and all(r["copies"] == (r["domain"] == "good") for r in out)
    none = spark.createDataFrame([], "doc_id long, kind string")
    alone = mixing.mix(docs, none, F.col("kind"), {"good": 1.0}, anchor="good").collect()
    assert {(r["domain"], r["copies"]) for r in alone} == {("good", 1)}
    assert mixing.mix(spark.createDataFrame([], DOCS), labels, F.col("kind"), {"good": 1.0}, anchor="good").count() == 0


def test_attach_equals_join_on_every_path(spark):
    left = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i % 700}") for i in range(3000)], "id long, k string")
    right = left.groupBy("k").agg(F.count("*").alias("w"), F.max("id").alias("top"))
    want = sorted(map(tuple, left.join(right.drop("w"), "k").select("id", "k", "top").collect()))
    for most in (10 ** 6, 0):
        got = common.attach(left, common.cut(right), "k", "w", max_rows=most)
        assert sorted(map(tuple, got.select("id", "k", "top").collect())) == want
    some = common.cut(right.where("k <> 'k3'"))
    assert common.attach(left, some, "k", "w", "left", 0).count() == common.attach(left, some, "k", "w", "left").count() == 3000


def test_batches_of_lists_are_cut():
    import pyarrow as pa

    rows = [[0.5] * 100_000 if i % 3 else None for i in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), pa.array(range(40))], ["v", "i"])
    parts = list(common.slices(batch, "v", 2_000_000))
    assert len(parts) > 10 and [x for p in parts for x in p.column("i").to_pylist()] == list(range(40))


def test_long_batches_are_cut(spark):
    frame = spark.createDataFrame([(i, "x" * 3_000_000 if i % 2 else None) for i in range(12)], "doc_id long, text string").coalesce(1)
    out = quality_rules.quality_rules(frame.withColumn("lang", F.lit("en")), keep=["doc_id"]).collect()
    assert sorted((r["doc_id"], r["word_chars"]) for r in out) == [(i, 3_000_000 * (i % 2)) for i in range(12)]
