"""Quality classifier (operator 1): hierarchical empirical Bayes.

A logistic model on shape features of the text gives each document's own
evidence. Grouped aggregation gives the mean quality of each host and of each
path within a host (a label where there is one, else the model's probability).
Sparse groups are shrunk: a path towards its host, a host towards the global
mean, with strengths estimated by the method of moments from how much the
groups differ. A document's log odds are its evidence (odds against the
training base rate) plus the log odds of its path's posterior, from which its
own share is taken out first.

The model is fitted on at most ``max_train`` labelled documents, those with the
smallest hashed ids; everything else covers all rows.

Defined cases: null text counts as empty; null host or path is a group of its
own; labels that repeat an id count by their mean, null labels not at all;
without labels of both kinds the text gives no evidence and the global mean is
the labels' (or one half); ties at one half are kept; repeated rows are
documents of their own; columns of the result replace columns of the same name.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField

from . import common
from .quality_rules import CLASS_OF, CONTINUATION

MAX_TRAIN = 20_000
STRENGTHS = (1.0, 1e4)


def features(text: bytes) -> np.ndarray:
    """Shape of a text: shares of character classes, word and line statistics."""
    words = text.split()
    classes = np.bincount(CLASS_OF[np.frombuffer(text, np.uint8)], minlength=9)[:CONTINUATION]
    n, w = max(1, int(classes.sum())), max(1, len(words))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return np.array([
        *(np.sqrt(classes / n)),
        math.log1p(len(words)),
        sum(map(len, words)) / w / 10,
        len(set(words)) / w,
        1 - len(set(lines)) / max(1, len(lines)),
        math.log1p(len(words) / max(1, len(lines))) / 5,
        sum(x.isalpha() or x[:-1].isalpha() and x[-1:] in b".,;:!?" for x in words) / w,
    ])


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights (the last is the intercept) by Newton steps on standardised features, in the features' own scale."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    w, keep = np.zeros(z.shape[1]), np.diag([ridge] * x.shape[1] + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + keep, z.T @ (p - y) + keep @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return np.append(w[:-1] / scale, w[-1] - (w[:-1] * mean / scale).sum())


@dataclass
class Model:
    weights: np.ndarray
    base: float  # share of good documents among those it was fitted on

    def evidence(self, text: bytes) -> float:
        """Log odds that the text adds to the base rate."""
        return float(features(text) @ self.weights[:-1] + self.weights[-1]) - logit(self.base)


def logit(p: float) -> float:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return math.log(p / (1 - p))


def label_means(labels: DataFrame, doc_id: str, label: str) -> DataFrame:
    return (labels.where(common.quoted(doc_id).isNotNull()).groupBy(common.quoted(doc_id).alias("__id"))
            .agg(F.avg(common.quoted(label).cast("double")).alias("__label")).where("__label IS NOT NULL"))


def train(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, max_train: int = MAX_TRAIN) -> Model:
    """Fit on the ``max_train`` labelled documents with the smallest hashed ids."""
    some = labels.orderBy(F.xxhash64("__id"), "__id").limit(max_train)
    rows = docs.select(common.quoted(doc_id).alias("__id"), common.quoted(text).cast("string").alias("t")).join(F.broadcast(some), "__id")

    def shape(batch: pa.RecordBatch) -> dict:
        return {"x": [features(t) for t in common.encoded(batch.column("t"))]}

    got = common.map_batches(rows, shape, [StructField("x", ArrayType(DoubleType()))], ["t"], ["__label"]).limit(2 * max_train).toArrow()
    x, y = common.stacked(got.column("x")), (got.column("__label").to_numpy() >= 0.5).astype(float)
    if not len(y) or y.min() == y.max():
        base = float(y.mean()) if len(y) else 0.5
        return Model(np.append(np.zeros(len(features(b""))), logit(base)), base)  # no evidence from any text
    return Model(fit_logistic(x, y), float(y.mean()))


def strength(groups: DataFrame, n: str, s: str, parent: str) -> float:
    """Pseudo-documents by which groups are drawn to ``parent`` (mean of the level above), by the method of moments."""
    m, g = F.col(s) / F.col(n), F.col(parent)
    r = groups.agg(F.sum(F.col(n) * (m - g) * (m - g)), F.sum(g * (1 - g)), F.sum(n), F.sum(F.col(n) * g * (1 - g))).first()
    if not r[2]:
        return STRENGTHS[0]
    spread, noise, within = r[0] / r[2], r[1] / r[2], r[3] / r[2]
    between = spread - noise
    return min(max(within / between - 1, STRENGTHS[0]), STRENGTHS[1]) if between > 0 else STRENGTHS[1]


def key_of(*parts: Column) -> Column:
    return F.to_json(F.array(*(p.cast("string") for p in parts)))


def classify(docs: DataFrame, labels: DataFrame, host: Column, path: Column, doc_id: str = "doc_id", text: str = "text",
             label: str = "quality", max_train: int = MAX_TRAIN) -> DataFrame:
    """``id, evidence, site_posterior, quality, kept`` for every row of ``docs``."""
    means = label_means(labels, doc_id, label)
    model = train(docs, means, doc_id, text, max_train)

    def score(batch: pa.RecordBatch) -> dict:
        return {"evidence": [model.evidence(t) for t in common.encoded(batch.column("t"))]}

    rows = docs.select(common.quoted(doc_id).alias("id"), common.quoted(text).cast("string").alias("t"),
                       key_of(host).alias("host"), key_of(host, path).alias("path"))
    rows = common.map_batches(rows, score, [StructField("evidence", DoubleType())], ["t"], ["id", "host", "path"])
    rows = rows.join(means.withColumnRenamed("__id", "id"), "id", "left")
    chance = 1 / (1 + F.exp(-(F.col("evidence") + logit(model.base))))
    rows = common.cut(rows.select("id", "host", "path", "evidence", F.coalesce("__label", chance).alias("y")))

    paths = common.cut(rows.groupBy("host", "path").agg(F.count("*").alias("path_n"), F.sum("y").alias("path_s")))
    hosts = paths.groupBy("host").agg(F.sum("path_n").alias("host_n"), F.sum("path_s").alias("host_s"), F.count("*").alias("w"))
    n, s = hosts.agg(F.sum("host_n"), F.sum("host_s")).first()
    world = s / n if n else model.base
    k_host = strength(hosts.withColumn("g", F.lit(world)), "host_n", "host_s", "g")
    hosts = common.cut(hosts.withColumn("g", (F.col("host_s") + k_host * world) / (F.col("host_n") + k_host)))
    paths = common.cut(common.attach(paths, hosts, "host", "w").drop("host"))
    k_path = strength(paths, "path_n", "path_s", "g")

    mine = common.attach(rows, paths.withColumn("w", F.col("path_n")), "path", "w")
    at_host = (F.col("host_s") - F.col("y") + k_host * world) / (F.col("host_n") - 1 + k_host)
    at_path = (F.col("path_s") - F.col("y") + k_path * at_host) / (F.col("path_n") - 1 + k_path)
    site = F.least(F.greatest(at_path, F.lit(1e-6)), F.lit(1 - 1e-6))
    odds = F.col("evidence") + F.log(site / (1 - site))
    out = mine.select("id", "evidence", site.alias("site_posterior"), (1 / (1 + F.exp(-odds))).alias("quality"))
    return out.withColumn("kept", F.col("quality") >= 0.5)
