"""Language ID (operator 3) by Bayesian evidence fusion.

Four kinds of evidence about a document's language are multiplied:

* text: likelihood of its byte trigrams (letters lower-cased in ASCII, all
  other ASCII bytes as one space) under each language's trigram counts, summed
  over all documents by their declared language;
* declared markup language: how often each tag goes with each language;
* address suffix: the same for the last label of the host (hosts without a dot
  give no evidence);
* host: a prior smoothed hierarchically, host towards its site (last two
  labels) towards the whole corpus, from soft counts of text posteriors.

All counts come from grouped aggregation over all rows; a document's own share
is taken out of the tag, suffix and host counts before they judge it (of the
trigram counts it is not). ``und`` (undetermined) competes as
a uniform trigram model. A document is kept if its most probable language is
wanted and reaches ``min_posterior``.

Defined cases: null and letterless texts are ``und`` and not kept; null tags,
hosts and suffixes give no evidence of their kind; tags with fewer than
``min_docs`` documents, or beyond the ``max_languages`` commonest, have no text
model of their own: a document that declares one, and that no modelled
language explains better than the uniform model, is of the language it declares
(their tags are pooled as evidence, and so are tags and suffixes beyond the
1,000 commonest); ties go to the first language by name;
without any language all is ``und``; repeated rows get equal results; columns
of the result replace columns of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField

from . import common

UND = "und"
BUCKETS = 8192
SPACE = 0x20
FOLD = np.full(256, SPACE, np.uint32)
FOLD[0x80:] = np.arange(0x80, 0x100)
FOLD[ord("a"):ord("z") + 1] = FOLD[ord("A"):ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


@dataclass(frozen=True)
class Settings:
    """``host_strength`` and ``site_strength`` are the pseudo-documents by which a level is drawn to the next one;
    ``tag_strength`` the same for tags and suffixes; trigrams overlap, so ``text_weight`` scales their likelihood."""

    min_docs: int = 5
    max_languages: int = 200
    text_weight: float = 1 / 3
    und_prior: float = 1e-3
    host_strength: float = 10.0
    site_strength: float = 20.0
    tag_strength: float = 5.0
    min_posterior: float = 0.5
    wanted: frozenset[str] | None = None


def trigrams(text: bytes) -> np.ndarray:
    """Buckets of all byte trigrams with a letter in the middle."""
    b = FOLD[np.frombuffer(b" " + text + b" ", np.uint8)]
    if len(b) < 3:
        return np.zeros(0, np.uint32)
    code = ((b[:-2] * np.uint32(0x9E3779B1) + b[1:-1]) * np.uint32(0x85EBCA77) + b[2:]) * np.uint32(0xC2B2AE3D)
    return (code >> np.uint32(19))[b[1:-1] != SPACE]


@dataclass
class Model:
    """Text model: log probabilities, one column per language, the last for ``und``."""

    langs: list[str]
    logp: np.ndarray
    prior: np.ndarray  # log prior of each column

    def scores(self, text: bytes, weight: float) -> np.ndarray:
        t = trigrams(text)
        if not len(t):
            return np.full(len(self.langs) + 1, np.nan)
        counts = np.bincount(t, minlength=BUCKETS)
        on = np.flatnonzero(counts)
        return weight * (counts[on] @ self.logp[on])


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def train(docs: DataFrame, text: str, lang: str, own: Settings) -> Model:
    """Trigram counts of every declared language, summed over all documents."""
    tags = docs.where(common.quoted(lang).isNotNull()).groupBy(common.quoted(lang).cast("string").alias("tag")).agg(F.count("*").alias("n"))
    common_tags = tags.where((F.col("n") >= own.min_docs) & (F.col("tag") != UND)).orderBy(F.desc("n"), "tag").limit(own.max_languages)
    langs = sorted((r["tag"], r["n"]) for r in common_tags.collect())
    names = [x for x, _ in langs]
    place = {x: i for i, x in enumerate(names)}

    def count(batches):
        sums = np.zeros((len(names), BUCKETS), np.int64)
        for batch in batches:
            for raw, tag in zip(common.encoded(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                if tag in place:
                    sums[place[tag]] += np.bincount(trigrams(raw), minlength=BUCKETS)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(sums.ravel()[at])], ["at", "n"])

    counts = np.zeros(len(names) * BUCKETS)
    if names:
        texts = docs.select(common.quoted(text).cast("string"), common.quoted(lang).cast("string"))
        for at, n in common.in_batches(texts, count, "at int, n long").groupBy("at").agg(F.sum("n")).collect():
            counts[at] = n  # at most languages x buckets rows
    counts = counts.reshape(len(names), BUCKETS).T + 0.5
    logp = np.hstack([np.log(counts / counts.sum(axis=0)), np.full((BUCKETS, 1), -np.log(BUCKETS))])
    n = np.array([x for _, x in langs], float)
    prior = np.append(n / n.sum() * (1 - own.und_prior), own.und_prior) if names else np.ones(1)
    return Model(names, logp, np.log(prior))


def suffix_of(host: str | None) -> str | None:
    return host.rstrip(".").rpartition(".")[2].lower() if host and "." in host.rstrip(".") else None


def site_of(host: str | None) -> str:
    return ".".join((host or "").lower().rstrip(".").split(".")[-2:])


@dataclass
class Evidence:
    """Soft counts by tag and by suffix (rows beyond the commonest are pooled) and in all."""

    total: np.ndarray
    tags: dict[str, np.ndarray] = field(default_factory=dict)
    suffixes: dict[str, np.ndarray] = field(default_factory=dict)


def posteriors(batch: pa.RecordBatch, text: str, model: Model, own: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Text scores and text-only posteriors of each row; rows without letters have nan scores and zero posteriors."""
    scores = np.array([model.scores(t, own.text_weight) for t in common.encoded(batch.column(text))]).reshape(batch.num_rows, -1)
    p = np.zeros_like(scores)
    on = ~np.isnan(scores[:, 0]) if batch.num_rows else []
    for i in np.flatnonzero(on):
        p[i] = softmax(scores[i] + model.prior)
    return scores, p


def statistics(docs: DataFrame, text: str, lang: str, host: str, model: Model, own: Settings) -> tuple[Evidence, DataFrame]:
    """Tag and suffix evidence, and the host table (names start with __, so that no column clashes)."""
    k = len(model.langs) + 1

    def sums(batches):
        for batch in batches:
            _, p = posteriors(batch, "t", model, own)
            held: dict[tuple, np.ndarray] = {}
            for h, tag, row in zip(batch.column("h").to_pylist(), batch.column("l").to_pylist(), p, strict=True):
                held[h, tag] = held.get((h, tag), 0) + np.append(row, 1.0)
            keys, values = list(held), list(held.values())
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in keys], pa.string()), pa.array([x[1] for x in keys], pa.string()),
                 pa.array([suffix_of(x[0]) for x in keys], pa.string()), pa.array([site_of(x[0]) for x in keys], pa.string()),
                 pa.array([v[-1] for v in values], pa.float64()), pa.array([v[:-1] for v in values], pa.list_(pa.float64()))],
                ["host", "tag", "suffix", "site", "n", "p"])

    rows = docs.select(common.quoted(text).cast("string").alias("t"), common.quoted(host).cast("string").alias("h"),
                       common.quoted(lang).cast("string").alias("l"))
    parts = common.cut(common.in_batches(rows, sums, "host string, tag string, suffix string, site string, n double, p array<double>"))

    def by(*keys: str) -> DataFrame:
        return parts.groupBy(*keys).agg(F.sum("n").alias("n"), F.array(*(F.sum(F.col("p")[i]) for i in range(k))).alias("p"))

    def table(key: str) -> dict[str, np.ndarray]:
        top = by(key).where(F.col(key).isNotNull()).orderBy(F.desc("n"), key).limit(1000).collect()
        return {r[key]: np.array(r["p"]) for r in top}

    total = by().first()
    evidence = Evidence(np.array([x or 0.0 for x in total["p"]]), table("tag"), table("suffix"))
    sites = common.cut(by("site").select("site", F.col("n").alias("__site_n"), F.col("p").alias("__site_p")))
    hosts = by("host", "site").select("host", "site", F.col("n").alias("__host_n"), F.col("p").alias("__host_p"))
    placed = common.cut(common.attach(hosts, sites.withColumn("w", F.lit(1)), "site", "w")
                        .select(host_key(F.col("host")).alias("__host_key"), "__host_n", "__host_p", "__site_n", "__site_p"))
    return evidence, placed


def host_key(host):
    """Null is a key of its own."""
    return F.coalesce(F.concat(F.lit("h"), host.cast("string")), F.lit(""))


def tag_evidence(key: str | None, table: dict[str, np.ndarray], total: np.ndarray, own_p: np.ndarray, strength: float) -> np.ndarray:
    """log p(tag | language), smoothed towards the tag's share of all rows; the row's own share taken out."""
    if key is None:
        return np.zeros(len(total))
    pooled = np.maximum(total - sum(table.values()), 0) if table else total
    counts = np.maximum(table.get(key, pooled) - own_p, 0)
    share = (counts.sum() + 1e-3) / (total.sum() + 1)
    return np.log((counts + strength * share) / (np.maximum(total - own_p, 0) + strength))


def host_prior(h: dict, own_p: np.ndarray, total: np.ndarray, own: Settings) -> np.ndarray:
    """log prior: host counts drawn to the site's, those to the corpus; the row's own share taken out."""
    world = (total + own.und_prior) / (total + own.und_prior).sum()
    here = float(own_p.sum())
    site = (np.maximum(np.array(h["__site_p"]) - own_p, 0) + own.site_strength * world) / (max(0.0, h["__site_n"] - here) + own.site_strength)
    prior = (np.maximum(np.array(h["__host_p"]) - own_p, 0) + own.host_strength * site) / (max(0.0, h["__host_n"] - here) + own.host_strength)
    return np.log(prior / prior.sum())


def identify(docs: DataFrame, own: Settings = Settings(), text: str = "text", lang: str = "lang", host: str = "source",
             keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``language``, ``posterior``, ``text_language`` (text alone) and ``kept``."""
    model = train(docs, text, lang, own)
    evidence, hosts = statistics(docs, text, lang, host, model, own)
    names = [*model.langs, UND]
    modelled = set(names)

    def fuse(batch: pa.RecordBatch) -> dict:
        scores, p = posteriors(batch, text, model, own)
        out = {"language": [], "posterior": [], "text_language": [], "kept": []}
        stats = zip(*(batch.column(c).to_pylist() for c in ("__host_n", "__host_p", "__site_n", "__site_p")), strict=True)
        known = zip(batch.column(lang).cast(pa.string()).to_pylist(), batch.column(host).cast(pa.string()).to_pylist(), strict=True)
        for s, own_p, (tag, at), h in zip(scores, p, known, stats, strict=True):
            if np.isnan(s[0]):
                found, best, alone = UND, 1.0, UND
            else:
                post = softmax(s + tag_evidence(tag, evidence.tags, evidence.total, own_p, own.tag_strength)
                               + tag_evidence(suffix_of(at), evidence.suffixes, evidence.total, own_p, own.tag_strength)
                               + host_prior(dict(zip(("__host_n", "__host_p", "__site_n", "__site_p"), h, strict=True)), own_p, evidence.total, own))
                found, best, alone = names[int(post.argmax())], float(post.max()), names[int(own_p.argmax())]
                if found == UND and tag and tag not in modelled:
                    found = tag  # one of the languages without a text model of their own
            out["language"].append(found)
            out["posterior"].append(best)
            out["text_language"].append(alone)
            out["kept"].append(found != UND and best >= own.min_posterior and (own.wanted is None or found in own.wanted))
        return out

    used = docs.columns if keep is None else keep
    needed = list(dict.fromkeys([*used, text, lang, host]))
    rows = docs.select(*map(common.quoted, needed), host_key(common.quoted(host)).alias("__host_key"))
    rows = common.attach(rows, hosts.withColumn("w", F.col("__host_n").cast("long")), "__host_key", "w")
    return common.map_batches(rows, fuse, FIELDS, [text, lang, host, "__host_n", "__host_p", "__site_n", "__site_p"], used)


FIELDS = [StructField("language", StringType()), StructField("posterior", DoubleType()),
          StructField("text_language", StringType()), StructField("kept", BooleanType())]
