"""Quality rules (operator 8): rule counts plus distribution divergence.

A document is compared with language references by Jensen-Shannon distance:
one histogram of character classes, one of common words. References are the
summed histograms of all documents of a language that pass the base rules and
hold a share of its function words, gathered by grouped aggregation (a few hundred numbers in all). Function
words of four languages are given; those of any other declared language are its
LEARNED_WORDS most widespread words, and its word histogram is one of its own. A document
keeps the verdict of its nearest reference, so a wrong language tag alone
never rejects it. Short texts are guarded: below ``min_words`` the word
histogram is not judged, and both limits widen by the sampling noise
``slack / sqrt(n)``.

Defined cases: null text counts as empty (no words, fails the base rules);
null, empty and ``und`` languages are compared with all references and feed none;
a language other than the four has a reference if at least
``min_reference_docs`` documents feed it; for documents of a language without a
reference, and with no reference at all (empty table), only the base rules decide; repeated
rows are judged each by itself; columns of the result replace columns of the
same name.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField

from . import common

# Frequent function words of each language.
COMMON_WORDS = {
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus".split(),
    "en": "the of and to in a is that for it as was with be by on not he this are or from at which but".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il".split(),
}
WORDS = {w.encode(): i for i, w in enumerate(sorted({w for ws in COMMON_WORDS.values() for w in ws}))}

# Character classes by byte of UTF-8: a code point counts by its first byte.
LOWER, UPPER, DIGIT, SPACE, STOP, SYMBOL, OTHER, WIDE, CONTINUATION = range(9)
CLASS_OF = np.full(256, OTHER, np.uint8)
CLASS_OF[0x80:0xC0] = CONTINUATION
CLASS_OF[0xC0:] = WIDE
for chars, kind in ((b"abcdefghijklmnopqrstuvwxyz", LOWER), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", UPPER),
                    (b"0123456789", DIGIT), (b" \t\n\x0b\f\r", SPACE), (b".,;:!?'\"()-", STOP),
                    (b"#*$%&|<>", SYMBOL)):
    CLASS_OF[list(chars)] = kind
#: Tags that name no language; function words learned for each language that has none given, each in at least
#: a share of the language's documents, so that what only its junk repeats is none.
NO_LANGUAGE = ("", "und")
LEARNED_WORDS, LEARNED_SHARE = 24, 0.2
BINS = CONTINUATION + len(WORDS) + 1  # classes, common words, all other words


@dataclass(frozen=True)
class Rules:
    """Limits of the rules.

    ``min_words`` and ``max_repeat_pct`` are the base rules; a window is
    ``window`` words. A document feeds the reference of its language if at least
    ``reference_common_pct`` % of its words are function words of it; a language whose function words
    are learned needs ``min_reference_docs`` such documents. ``max_char_js`` and ``max_word_js`` are limits on the
    two distances (0 = equal, 1 = disjoint).
    """

    min_words: int = 20
    max_repeat_pct: int = 30
    window: int = 8
    reference_common_pct: int = 10
    min_reference_docs: int = 20
    judge_words_from: int = 50
    max_char_js: float = 0.16
    max_word_js: float = 0.30
    slack: float = 1.0


def repeated_words(words: list[bytes], window: int) -> int:
    """Words lying in a window of ``window`` words that occurs at least twice (first occurrence included)."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.uint64, len(words))
    if len(seen) == len(words):
        return 0
    h = np.zeros(n, np.uint64)
    for k in range(window):  # equal windows have equal hashes; unequal ones are sorted out below
        h = h * np.uint64(0x9E3779B97F4A7C15) + (ids[k:k + n] + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
    order = np.sort(h)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(h, twice))
    windows = np.stack([ids[at + k] for k in range(window)], axis=1)
    _, inverse, count = np.unique(windows, axis=0, return_inverse=True, return_counts=True)
    at = at[count[inverse.ravel()] >= 2]
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int(np.count_nonzero(np.cumsum(edge[:-1])))


def dup_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


def histogram(text: bytes, words: list[bytes]) -> np.ndarray:
    """Counts of character classes, of each common word, and of all other words."""
    out = np.zeros(BINS, np.int64)
    out[:CONTINUATION] = np.bincount(CLASS_OF[np.frombuffer(text, np.uint8)], minlength=9)[:CONTINUATION]
    found = 0
    counts = Counter(words)
    for w in counts.keys() & WORDS.keys():
        out[CONTINUATION + WORDS[w]] = counts[w]
        found += counts[w]
    out[-1] = len(words) - found
    return out


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Square root of the Jensen-Shannon divergence in bits; 1 if either histogram is empty."""
    if not p.sum() or not q.sum():
        return 1.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2

    def bits(a: np.ndarray) -> float:
        on = a > 0
        return float((a[on] * np.log2(a[on] / m[on])).sum())

    return math.sqrt(max(0.0, (bits(p) + bits(q)) / 2))


def base_counts(text: bytes, words: list[bytes], hist: np.ndarray, rules: Rules) -> dict[str, int]:
    repeat = repeated_words(words, rules.window)
    return {"n_words": len(words), "word_chars": int(hist[:CONTINUATION].sum() - hist[SPACE]),
            "n_symbols": int(hist[SYMBOL]), "n_dup_lines": dup_lines(text), "n_repeat_words": repeat,
            "base_failed": len(words) < rules.min_words or 100 * repeat > rules.max_repeat_pct * len(words)}


def feeds_reference(words: list[bytes], hist: np.ndarray, lang: str, rules: Rules) -> bool:
    """Whether a document counts as ordinary text of ``lang``: base rules and a share of its function words."""
    own = sum(int(hist[CONTINUATION + WORDS[w.encode()]]) for w in COMMON_WORDS[lang])
    return (len(words) >= rules.min_words and 100 * own >= rules.reference_common_pct * len(words)
            and 100 * repeated_words(words, rules.window) <= rules.max_repeat_pct * len(words))


def references(docs: DataFrame, rules: Rules = Rules(), text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """Summed histograms of the ordinary documents of each known language (see feeds_reference)."""

    def partial(batches):
        for batch in batches:
            sums: dict[str, np.ndarray] = {}
            langs = batch.column(1).to_pylist()
            for raw, tag in zip(common.encoded(batch.column(0)), langs, strict=True):
                if tag not in COMMON_WORDS:
                    continue
                words = raw.split()
                hist = histogram(raw, words)
                if feeds_reference(words, hist, tag, rules):
                    sums[tag] = sums.get(tag, 0) + hist
            rows = [(k, b, int(n)) for k, v in sums.items() for b, n in enumerate(v) if n]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in
                                              enumerate((pa.string(), pa.int32(), pa.int64()))], ["lang", "bin", "n"])

    texts = docs.select(common.quoted(text).alias("t"), common.quoted(lang).cast("string").alias("l"))
    got = common.in_batches(texts, partial, "lang string, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    out = {}
    for r in got.collect():  # at most languages x bins rows
        out.setdefault(r["lang"], np.zeros(BINS, np.int64))[r["bin"]] = r["n"]
    return out


@dataclass
class Learned:
    """Reference of a language by its own words: character classes, each word, all other words."""

    words: dict[bytes, int]
    hist: np.ndarray

    def word_counts(self, counts: Counter, n_words: int) -> np.ndarray:
        out = np.zeros(len(self.words) + 1, np.int64)
        for w in counts.keys() & self.words.keys():
            out[self.words[w]] = counts[w]
        out[-1] = n_words - out.sum()
        return out


def learned_references(docs: DataFrame, rules: Rules = Rules(), text: str = "text", lang: str = "lang") -> dict[str, Learned]:
    """References of the declared languages without given function words; two more passes, over their documents only."""
    rows = docs.select(common.quoted(text).alias("t"), common.quoted(lang).cast("string").alias("l"))
    rows = rows.where(~F.col("l").isin(*COMMON_WORDS, *NO_LANGUAGE))
    tags = {r["l"] for r in rows.groupBy("l").count().where(F.col("count") >= rules.min_reference_docs).collect()}
    if not tags:
        return {}

    def passing(batch: pa.RecordBatch):
        """(language, text, words) of the documents that pass the base rules."""
        for raw, tag in zip(common.encoded(batch.column(0)), batch.column(1).to_pylist(), strict=True):
            if tag in tags:
                words = raw.split()
                if len(words) >= rules.min_words and 100 * repeated_words(words, rules.window) <= rules.max_repeat_pct * len(words):
                    yield tag, raw, words

    def summed(sums: dict[tuple, int], kind: pa.DataType, name: str) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k[0] for k in sums], pa.string()), pa.array([k[1] for k in sums], kind),
                                           pa.array(list(sums.values()), pa.int64())], ["lang", name, "n"])

    def holding(batches):
        for batch in batches:
            sums = Counter()
            for tag, _, words in passing(batch):
                sums.update((tag, w) for w in {b"", *words})  # the empty word counts the documents
            yield summed(sums, pa.binary(), "word")

    seen = common.in_batches(rows, holding, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))  # the empty word comes first
    found: dict[str, Learned] = {}
    for r in seen.withColumn("k", rank).where(F.col("k") <= LEARNED_WORDS + 1).orderBy("lang", "k").collect():
        if not r["word"]:
            found[r["lang"]], enough = Learned({}, np.zeros(0)), LEARNED_SHARE * r["n"]
        elif r["n"] >= enough:
            found[r["lang"]].words[bytes(r["word"])] = r["k"] - 2

    def partial(batches):
        for batch in batches:
            sums = Counter()
            for tag, raw, words in passing(batch):
                counts = found[tag].word_counts(Counter(words), len(words))
                if 100 * counts[:-1].sum() >= rules.reference_common_pct * len(words):
                    sums[tag, -1] += 1
                    for b, n in enumerate([*histogram(raw, words)[:CONTINUATION], *counts]):
                        sums[tag, b] += int(n)
            yield summed(sums, pa.int32(), "bin")

    got = common.in_batches(rows, partial, "lang string, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    feeding = {tag: 0 for tag in found}
    for own in found.values():
        own.hist = np.zeros(CONTINUATION + len(own.words) + 1, np.int64)
    for r in got.collect():  # at most languages x bins rows
        if r["bin"] < 0:
            feeding[r["lang"]] = r["n"]
        else:
            found[r["lang"]].hist[r["bin"]] = r["n"]
    return {tag: own for tag, own in found.items() if feeding[tag] >= rules.min_reference_docs}


def verdict(hist: np.ndarray, n_words: int, refs: dict[str, np.ndarray], rules: Rules, learned: dict[str, Learned] | None = None,
            words: list[bytes] | None = None) -> tuple[str | None, float, float, bool]:
    """(nearest language, character distance, word distance, kept) against the nearest reference.

    ``words`` are those of the text; needed for ``learned`` references only.
    """
    learned = learned or {}
    chars, listed = hist[:CONTINUATION], hist[CONTINUATION:]
    counts = Counter(words) if learned else None
    char_limit = rules.max_char_js + rules.slack / math.sqrt(max(1, int(chars.sum())))
    word_limit = rules.max_word_js + rules.slack / math.sqrt(max(1, n_words))
    best = None
    for lang in sorted([*refs, *learned]):
        ref = refs[lang] if lang in refs else learned[lang].hist
        c = js_distance(chars, ref[:CONTINUATION])
        if best and best[-1] and (c > char_limit or c > best[0][1]):
            continue  # neither kept by this reference nor nearer to it
        w = js_distance(listed if lang in refs else learned[lang].word_counts(counts, n_words), ref[CONTINUATION:])
        ok = c <= char_limit and (n_words < rules.judge_words_from or w <= word_limit)
        if best is None or (not ok, c + w) < best[0]:
            best = ((not ok, c + w), lang, c, w, ok)
    return best[1:] if best else (None, 0.0, 0.0, True)


def quality_rules(docs: DataFrame, rules: Rules = Rules(), text: str = "text", lang: str = "lang",
                  keep: list[str] | None = None) -> DataFrame:
    """``docs`` with rule counts, distances, ``base_failed`` and ``kept``.

    Two passes over the texts (four over those of languages without given
    function words), no shuffle of documents: the first sums the references,
    the last judges each document beside its own columns.
    """
    refs, learned = references(docs, rules, text, lang), learned_references(docs, rules, text, lang)
    judged = {None, *NO_LANGUAGE, *refs, *learned}

    def judge(batch: pa.RecordBatch) -> dict:
        rows = []
        for raw, tag in zip(common.encoded(batch.column(text)), batch.column(lang).cast(pa.string()).to_pylist(), strict=True):
            words = raw.split()
            hist = histogram(raw, words)
            row = base_counts(raw, words, hist, rules)
            near, c, w, ok = verdict(hist, len(words), refs, rules, learned, words)
            rows.append(row | {"near_lang": near, "char_js": c, "word_js": w, "kept": not row["base_failed"] and (ok or tag not in judged)})
        return {f.name: [r[f.name] for r in rows] for f in FIELDS}

    return common.map_batches(docs, judge, FIELDS, [text, lang], keep)


FIELDS = [*(StructField(c, LongType()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
          StructField("base_failed", BooleanType()), StructField("near_lang", StringType()),
          StructField("char_js", DoubleType()), StructField("word_js", DoubleType()), StructField("kept", BooleanType())]
