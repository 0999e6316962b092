"""Mixing sources to target weights (operator 6) with soft memberships.

A softmax classifier fitted on the labelled table gives every document a
probability for each domain. A nonnegative rate per document is then fitted so
that the expected tokens of each domain, sum(rate * tokens * probability), match
target weights: projected gradient on the least squares of the relative misses,
with one grouped sum over all documents per step. Only the misses of each step
(one number per domain) pass through the driver; a task rebuilds its documents'
rates from them, so no rate is ever stored. The step in the metric of the token
counts has a Lipschitz constant of at most one (rows of the membership matrix
sum to one), so the plain step converges.

The total is set by an anchor domain; rates of documents whose most probable
domain it is are fitted with the floor ``anchor_floor`` (at one, none is lost).
``copies`` turns every rate into whole copies: its integer part, and one more if
a hash of the id falls below the rest. The tokens of the copies are summed per
domain and logged beside the targets, as a warning if steps run out before the
fit reaches the targets, or if the copies miss the fit by more than the draw
explains.

The classifier is fitted on at most ``max_train`` labelled documents, those with
the smallest hashed ids; totals and rates cover all rows.

Defined cases: null text has no tokens, and its rate moves nothing; labels that
repeat an id count once (the smallest domain); documents without a label are
predicted like all others; of more than MAX_DOMAINS domains the commonest are
modelled; a target without labelled documents cannot be met
and is ignored; with no labels at all every document is of the anchor domain; repeated rows
have equal rates; columns of the result replace columns of the same name.
"""

from __future__ import annotations

import logging
import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, LongType, StringType, StructField

from . import common
from .quality_rules import CLASS_OF, CONTINUATION

MAX_TRAIN = 10_000
MAX_WORDS = 400
#: Domains are classes of one model; a labelled table has few of them.
MAX_DOMAINS = 200
#: Standard deviations of the hashed draw by which realised totals may miss the fitted ones.
DRAW_SIGMAS = 4
LOG = logging.getLogger(__name__)


@dataclass
class Model:
    domains: list[str]
    words: dict[bytes, int]
    weights: np.ndarray  # features and intercept x domains

    def posteriors(self, text: bytes, words: list[bytes]) -> np.ndarray:
        z = features(text, words, self.words) @ self.weights[:-1] + self.weights[-1]
        e = np.exp(z - z.max())
        return e / e.sum()


def bare(words: list[bytes]) -> list[bytes]:
    return [w.strip(b".,;:!?") for w in words]


def features(text: bytes, words: list[bytes], chosen: dict[bytes, int]) -> np.ndarray:
    """Shares of character classes, of repeated words and lines, and of the chosen words."""
    out = np.zeros(CONTINUATION + 2 + len(chosen))
    classes = np.bincount(CLASS_OF[np.frombuffer(text, np.uint8)], minlength=9)[:CONTINUATION]
    out[:CONTINUATION] = np.sqrt(classes / max(1, int(classes.sum())))
    lines = [x for x in text.split(b"\n") if x]
    out[CONTINUATION] = len(set(words)) / max(1, len(words))
    out[CONTINUATION + 1] = len(set(lines)) / max(1, len(lines))
    if chosen:
        counts = Counter(bare(words))
        for w in counts.keys() & chosen.keys():
            out[CONTINUATION + 2 + chosen[w]] = math.sqrt(counts[w] / len(words))
    return out


def fit_softmax(x: np.ndarray, y: np.ndarray, k: int, ridge: float = 1e-4, steps: int = 400) -> np.ndarray:
    """Softmax regression by accelerated gradient steps on standardised features, in the features' own scale."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-4
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    target = np.eye(k)[y]
    rate = 2 / (np.linalg.norm(z, 2) ** 2 / len(z) + ridge)
    w = ahead = np.zeros((z.shape[1], k))
    for t in range(1, steps + 1):
        e = z @ ahead
        p = np.exp(e - e.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        after = ahead - rate * (z.T @ (p - target) / len(z) + ridge * ahead)
        w, ahead = after, after + (t - 1) / (t + 2) * (after - w)
    own = w[:-1] / scale[:, None]
    return np.vstack([own, w[-1] - mean @ own])


def train(docs: DataFrame, labelled: DataFrame, anchor: str, doc_id: str, text: str, max_train: int) -> Model:
    """``labelled`` holds ``__id`` and ``__domain``; at most ``max_train`` of its documents are used."""
    some = labelled.orderBy(F.xxhash64("__id"), "__id").limit(max_train)
    texts = common.cut(docs.select(common.quoted(doc_id).alias("__id"), common.quoted(text).cast("string").alias("t"))
                       .join(F.broadcast(some), "__id"))

    sizes = dict(texts.groupBy("__domain").count().orderBy(F.desc("count"), "__domain").limit(MAX_DOMAINS).collect())
    names, total = sorted(sizes), sum(sizes.values())
    if len(names) < 2:
        names = names or [anchor]
        return Model(names, {}, np.zeros((CONTINUATION + 3, len(names))))
    texts = texts.where(F.col("__domain").isin(names))

    def words(batch: pa.RecordBatch) -> dict:
        return {"words": [list({w.decode("utf-8", "replace") for w in bare(t.split()) if w}) for t in common.encoded(batch.column("t"))]}

    seen = (common.map_batches(texts, words, [StructField("words", ArrayType(StringType()))], ["t"], ["__domain"])
            .select("__domain", F.explode("words").alias("w")).groupBy("w").pivot("__domain", names).count().na.fill(0))
    n = sum(F.col(f"`{d}`") for d in names)
    expect = [n * sizes.get(d, 0) / total for d in names]
    chi = sum((F.col(f"`{d}`") - e) * (F.col(f"`{d}`") - e) / (e + 1e-9) for d, e in zip(names, expect, strict=True))
    top = seen.where(n >= max(5, total // 1000)).orderBy(chi.desc(), "w").limit(MAX_WORDS).select("w").collect()
    chosen = {r["w"].encode(): i for i, r in enumerate(top)}

    def shape(batch: pa.RecordBatch) -> dict:
        x = np.empty((batch.num_rows, CONTINUATION + 2 + len(chosen)), np.float32)
        for i, t in enumerate(common.encoded(batch.column("t"))):
            x[i] = features(t, t.split(), chosen)
        return {"x": pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))}

    got = common.map_batches(texts, shape, [StructField("x", ArrayType(FloatType()))], ["t"], ["__domain"]).limit(2 * max_train).toArrow()
    y = np.array([names.index(d) for d in got.column("__domain").to_pylist()])
    return Model(names, chosen, fit_softmax(common.stacked(got.column("x")), y, len(names)))


def rates(p: np.ndarray, misses: np.ndarray, floor: float | np.ndarray = 0.0) -> np.ndarray:
    """Rates of documents with memberships ``p`` after the steps whose misses are given, each projected on ``>= floor``."""
    r = np.ones(len(p))
    for m in misses:
        r = np.maximum(floor, r - p @ m)
    return r


def anchored(p: np.ndarray, anchor: int | None, floor: float) -> np.ndarray:
    """Least rate of each document: ``floor`` in the anchor domain, zero elsewhere."""
    return floor * (p.argmax(axis=1) == (-1 if anchor is None else anchor))


def copies_of(r: np.ndarray, u: np.ndarray) -> np.ndarray:
    return np.floor(r) + (u < r - np.floor(r))


def grouped(scored: DataFrame, size: int, fn) -> np.ndarray:
    """Sum of ``fn(batch)``, a vector of ``size`` numbers, over all batches."""

    def sums(batches):
        held = np.zeros(size)
        for batch in batches:
            held += fn(batch)
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(held)], ["at", "s"])

    out = np.zeros(size)
    for at, s in common.in_batches(scored, sums, "at int, s double").groupBy("at").agg(F.sum("s")).collect():
        out[at] = s
    return out


def members(batch: pa.RecordBatch, k: int) -> np.ndarray:
    return batch.column("__p").flatten().to_numpy(zero_copy_only=False).reshape(-1, k)


def fit(scored: DataFrame, k: int, weights: np.ndarray, anchor: int | None, steps: int, tolerance: float,
        floor: float = 0.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Misses of every step, and reached and wanted tokens of each domain. ``scored`` holds ``n_tokens`` and ``__p``."""

    def totals(misses: np.ndarray) -> np.ndarray:
        def sums(batch: pa.RecordBatch) -> np.ndarray:
            p = members(batch, k)
            return (rates(p, misses, anchored(p, anchor, floor)) * batch.column("n_tokens").to_numpy(zero_copy_only=False)) @ p

        return grouped(scored.select("n_tokens", "__p"), k, sums)

    misses = np.zeros((0, k))
    start = reached = totals(misses)
    on = (start > 0) & ~np.isnan(weights)
    wanted = np.where(on, np.nan_to_num(weights), 0.0)
    at = anchor or 0
    wanted = wanted / wanted[at] * start[at] if wanted[at] > 0 else start
    wanted = np.where(on, wanted, start)
    for _ in range(steps):
        miss = np.where(on, (reached - wanted) / np.maximum(start, 1e-12), 0.0)
        if np.abs(reached - wanted).max() <= tolerance * max(wanted.sum(), 1e-12):
            break
        misses = np.vstack([misses, miss])
        reached = totals(misses)
    return misses, reached, wanted


def realised(drawn: DataFrame, k: int, misses: np.ndarray, anchor: int | None, floor: float) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each domain in the copies, and their standard deviation by the draw. ``drawn`` holds ``n_tokens``, ``__p``, ``__u``."""

    def sums(batch: pa.RecordBatch) -> np.ndarray:
        p, n = members(batch, k), batch.column("n_tokens").to_numpy(zero_copy_only=False).astype(float)
        r = rates(p, misses, anchored(p, anchor, floor))
        rest = r - np.floor(r)
        return np.append((copies_of(r, batch.column("__u").to_numpy(zero_copy_only=False)) * n) @ p, (rest * (1 - rest) * n * n) @ (p * p))

    out = grouped(drawn.select("n_tokens", "__p", "__u"), 2 * k, sums)
    return out[:k], np.sqrt(out[k:])


def report(domains: list[str], wanted: np.ndarray, reached: np.ndarray, got: np.ndarray, noise: np.ndarray, tolerance: float) -> None:
    """Log the tokens of each domain: wanted, fitted, in the copies."""
    most = tolerance * max(wanted.sum(), 1e-12)
    said = "; ".join(f"{d}: wanted {w:.0f}, fitted {r:.0f}, copies {g:.0f}" for d, w, r, g in zip(domains, wanted, reached, got, strict=True))
    if np.abs(reached - wanted).max() > most:
        LOG.warning("mixing: targets not reached when the steps ran out (tokens of %s)", said)
    elif (np.abs(got - reached) > DRAW_SIGMAS * noise + most).any():
        LOG.warning("mixing: copies miss the fitted totals (tokens of %s)", said)
    else:
        LOG.info("mixing: targets reached (tokens of %s)", said)


def mix(docs: DataFrame, labels: DataFrame, domain: Column, targets: dict[str, float], anchor: str, doc_id: str = "doc_id",
        text: str = "text", max_train: int = MAX_TRAIN, steps: int = 60, tolerance: float = 1e-3, anchor_floor: float = 0.0,
        keep: list[str] | None = None, stage: bool = True) -> DataFrame:
    """``docs`` with ``n_tokens`` (words), ``domain``, ``posteriors`` (in ``domains`` order), ``rate`` and ``copies``.

    ``domain`` is an expression over ``labels``. With ``stage`` the scored rows
    are written once; without (wide rows) they are computed again for the result.
    """
    labelled = (labels.select(common.quoted(doc_id).alias("__id"), domain.cast("string").alias("__domain"))
                .where("__id IS NOT NULL AND __domain IS NOT NULL").groupBy("__id").agg(F.min("__domain").alias("__domain")))
    model = train(docs, labelled, anchor, doc_id, text, max_train)
    k = len(model.domains)

    def score(batch: pa.RecordBatch) -> dict:
        out = {"n_tokens": [], "__p": []}
        for t in common.encoded(batch.column(text)):
            words = t.split()
            out["n_tokens"].append(len(words))
            out["__p"].append(model.posteriors(t, words))
        return out

    fields = [FIELDS[0], StructField("__p", ArrayType(DoubleType()))]
    used = list(dict.fromkeys([*(docs.columns if keep is None else keep), doc_id]))
    narrow = common.cut(common.map_batches(docs, score, fields, [text], used if stage else [doc_id]))
    weights = np.array([targets.get(d, math.nan) for d in model.domains])
    at = model.domains.index(anchor) if anchor in model.domains else None
    misses, reached, wanted = fit(narrow, k, weights, at, steps, tolerance, anchor_floor)
    drawn = (F.pmod(F.xxhash64(common.quoted(doc_id), F.lit("mix")), F.lit(1 << 40)) / float(1 << 40)).alias("__u")
    report(model.domains, wanted, reached, *realised(narrow.select("n_tokens", "__p", drawn), k, misses, at, anchor_floor), tolerance)

    def decide(batch: pa.RecordBatch) -> dict:
        p = members(batch, k)
        r = rates(p, misses, anchored(p, at, anchor_floor))
        copies = copies_of(r, batch.column("__u").to_numpy(zero_copy_only=False))
        return {"domain": [model.domains[i] for i in p.argmax(axis=1)], "posteriors": list(p), "rate": r, "copies": copies.astype(np.int32)}

    rows = narrow if stage else docs
    rows = rows.select("*", drawn)
    if stage:
        return common.map_batches(rows, decide, FIELDS[1:], ["__p", "__u"], list(dict.fromkeys([*used, "n_tokens"])))

    def both(batch: pa.RecordBatch) -> dict:
        own = score(batch)
        with_p = pa.RecordBatch.from_arrays([pa.array(own["__p"], pa.list_(pa.float64())), batch.column("__u")], ["__p", "__u"])
        return {"n_tokens": own["n_tokens"]} | decide(with_p)

    return common.map_batches(rows, both, FIELDS, [text, "__u"], used)


def realise(mixed: DataFrame, columns: list) -> DataFrame:
    """One row per copy, with ``columns`` only."""
    return mixed.where("copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*columns)


FIELDS = [StructField("n_tokens", LongType()), StructField("domain", StringType()), StructField("posteriors", ArrayType(DoubleType())),
          StructField("rate", DoubleType()), StructField("copies", IntegerType())]
