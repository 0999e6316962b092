"""Toxicity (operator 11): votes of the nearest labelled examples by exact TF-IDF cosine, on a block-max inverted index.

Terms are word beginnings of 3 to 8 characters (letters, and characters beyond
ASCII; A-Z made small) that occur in clearly more toxic than other labelled
documents (log-likelihood ratio and odds), of nested ones the strongest and
purest, the longest of equals. A word counts for one term. Weights are (1 + ln count) * idf, idf over all documents.

Labelled documents with equal counts are one example with its numbers of
toxic and other documents, so copies are one entry. The index holds, by term,
the weights of the examples in blocks of ``BLOCK``, and each block's largest
weight. A document adds up the bounds of its terms by block, visits blocks from
the largest bound down and stops when no bound reaches the k-th cosine: exactly
the k nearest. Their votes are weighted by cosine^4 and documents, and drawn to
the labelled share of toxic documents by one vote. Documents without any term
have no cosine; they get the share of toxic ones among the labelled documents
without terms, drawn likewise. The evidence is the nearest examples.

Bounds: fitted on ``max_train`` labelled documents (smallest hashed ids) and
``max_terms`` terms, so index and terms, all that is broadcast, hold at most
max_train * max_terms weights. Document counts and scores cover all documents.

Defined cases: null text is empty; null ids score but are never learned from;
documents labelled twice count by their mean label; of rows that repeat an id
the smallest is learned; without labels of both kinds every score is the
share of toxic labels (0 without any); ties of cosine go to the smaller id;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from . import common

MAX_TRAIN, MAX_TERMS, NEAREST = 20_000, 512, 25
LENGTHS = range(3, 9)
#: A term's log-likelihood ratio (2 ln) and odds at least.
MIN_G2, MIN_ODDS = 30.0, 5.0
#: Of stems that begin one another the one with the largest ratio times this power of its share of toxic documents is a term.
PURITY = 2
BLOCK = 64
#: Document vectors whose votes a task remembers.
REMEMBERED = 20_000


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def stems(words: set[bytes]) -> set[str]:
    """Beginnings of the words."""
    return {w[:k] for w in (x.decode() for x in words) for k in LENGTHS if len(w) >= k}


def stem_counts(texts: DataFrame) -> DataFrame:
    """``(stem, toxic, other)``: labelled documents that hold the stem."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch, "text"):
                seen = Counter(), Counter()
                for text, toxic in zip(common.encoded(part.column("text")), part.column("toxic").to_pylist(), strict=True):
                    words = {w for some in common.letter_runs(text) for w in some}
                    seen[not toxic].update(stems(words))
                every = list(seen[0] | seen[1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(every, pa.string()), *(pa.array([s[x] for x in every], pa.int64()) for s in seen)], ["stem", "toxic", "other"])

    found = common.in_batches(texts, run, "stem string, toxic long, other long")
    return found.groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def choose(counts: DataFrame, toxic: int, other: int, max_terms: int) -> list[str]:
    """Stems that tell toxic documents, the strongest first; none begins another."""
    if not toxic or not other:
        return []
    a, b = F.col("toxic"), F.col("other")
    part = lambda n, of: F.when(n > 0, n * F.log(n * (toxic + other) / of)).otherwise(0.0)
    g2 = 2 * (part(a, (a + b) * toxic) + part(b, (a + b) * other)
              + part(toxic - a, (toxic + other - a - b) * toxic) + part(other - b, (toxic + other - a - b) * other))
    odds = (a + 0.5) * (other - b + 0.5) / ((b + 0.5) * (toxic - a + 0.5))
    pure = F.pow(a / (a + b), F.lit(PURITY))
    rows = (counts.where(odds >= MIN_ODDS).where(g2 >= MIN_G2).select("stem", F.round(g2 * pure, 6).alias("rank"))
            .orderBy(F.desc("rank"), F.desc(F.length("stem")), "stem").limit(40 * max_terms).collect())
    chosen: list[str] = []
    for (stem, _) in rows:
        if not any(stem.startswith(x) or x.startswith(stem) for x in chosen):
            chosen.append(stem)
        if len(chosen) == max_terms:
            break
    return chosen


def term_finder(terms: list[str]):
    """A function from a text to the sorted numbers of its terms and their counts."""
    known = {t: k for k, t in enumerate(terms)}
    heads = {t.encode()[:3] for t in terms}

    def find(text: bytes) -> tuple[tuple[int, ...], tuple[int, ...]]:
        counts: Counter = Counter()
        for words in common.letter_runs(text):
            for w in words:
                if w[:3] in heads:
                    w = w.decode()
                    for k in LENGTHS:
                        if (t := known.get(w[:k])) is not None:
                            counts[t] += 1
                            break
        order = sorted(counts)
        return tuple(order), tuple(counts[t] for t in order)

    return find


class BlockMaxIndex:
    """Exact nearest unit vectors by cosine; equal cosines by position."""

    def __init__(self, vectors: list[tuple[tuple[int, ...], np.ndarray]], n_terms: int):
        # alike vectors side by side, so that a block's largest weights are near its members' own
        strongest = [(t[int(w.argmax())] if len(t) else -1) for t, w in vectors]
        self.place = sorted(range(len(vectors)), key=lambda i: (strongest[i], vectors[i][0], i))
        self.n_blocks = -(-len(vectors) // BLOCK)
        lists: list[list[tuple[int, float]]] = [[] for _ in range(n_terms)]
        for at, i in enumerate(self.place):
            for t, w in zip(*vectors[i], strict=True):
                lists[t].append((at, float(w)))
        self.postings = []
        for entries in lists:
            at, w = np.array([x[0] for x in entries], np.int64), np.array([x[1] for x in entries])
            blocks, first = np.unique(at // BLOCK, return_index=True)
            largest = np.maximum.reduceat(w, first) if len(w) else w
            ends = np.append(first, len(at))[1:]
            self.postings.append((at % BLOCK, w, blocks, largest, {int(b): (int(s), int(e)) for b, s, e in zip(blocks, first, ends, strict=True)}))
        self.visited = 0  # blocks scored so far

    def nearest(self, terms: tuple[int, ...], weights: np.ndarray, k: int) -> list[tuple[float, int]]:
        """(cosine, position) of the k nearest with a cosine over zero, nearest first."""
        bound = np.zeros(self.n_blocks)
        for t, w in zip(terms, weights, strict=True):
            _, _, blocks, largest, _ = self.postings[t]
            bound[blocks] += w * largest
        held: list[tuple[float, int]] = []  # (cosine, -position), the worst first
        for b in np.argsort(-bound, kind="stable").tolist():
            if bound[b] <= 0 or len(held) == k and bound[b] < held[0][0] * (1 - 1e-12):
                break
            self.visited += 1
            cosine = np.zeros(BLOCK)
            for t, w in zip(terms, weights, strict=True):
                at, own, _, _, spans = self.postings[t]
                if b in spans:
                    s, e = spans[b]
                    cosine[at[s:e]] += w * own[s:e]
            for i in np.flatnonzero(cosine > 0).tolist():
                entry = (float(cosine[i]), -self.place[b * BLOCK + i])
                if len(held) < k:
                    heapq.heappush(held, entry)
                elif entry > held[0]:
                    heapq.heapreplace(held, entry)
        return [(c, -i) for c, i in sorted(held, reverse=True)]


@dataclass
class Model:
    """Examples by id; ``toxic`` and ``n`` count their documents."""
    terms: list[str]
    idf: np.ndarray
    ids: list
    toxic: np.ndarray
    n: np.ndarray
    index: BlockMaxIndex
    base: float
    without: float
    k: int

    @classmethod
    def of(cls, terms: list[str], idf: np.ndarray, examples: list[tuple], base: float, k: int) -> Model:
        """``examples``: (id, terms, counts, toxic) of labelled documents."""
        groups: dict = {}
        for i, t, c, y in sorted(examples, key=lambda x: x[0]):
            held = groups.setdefault((tuple(t), tuple(c)), [i, 0.0, 0])
            held[1] += y
            held[2] += 1
        empty = groups.pop(((), ()), [None, 0.0, 0])
        keys = list(groups)
        index = BlockMaxIndex([(t, unit(t, c, idf)) for t, c in keys], len(terms))
        rows = [groups[x] for x in keys]
        return cls(terms, idf, [r[0] for r in rows], np.array([r[1] for r in rows]), np.array([r[2] for r in rows], float), index,
                   base, (empty[1] + base) / (empty[2] + 1), k)

    def judge(self, terms: tuple[int, ...], counts: tuple[int, ...]) -> tuple[float, list[tuple]]:
        """Score, and the nearest examples as (id, cosine, share of toxic documents)."""
        if not terms:
            return self.without, []
        near = self.index.nearest(terms, unit(terms, counts, self.idf), self.k)
        at, power = np.array([i for _, i in near], np.int64), np.array([min(c, 1.0) for c, _ in near]) ** 4
        score = (float(power @ self.toxic[at]) + self.base) / (float(power @ self.n[at]) + 1)
        return score, [(self.ids[i], min(c, 1.0), float(self.toxic[i] / self.n[i])) for c, i in near[:5]]


def unit(terms, counts, idf: np.ndarray) -> np.ndarray:
    w = (1 + np.log(np.array(counts, float))) * idf[list(terms)]
    return w / math.sqrt(float(w @ w))


def scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
           max_train: int = MAX_TRAIN, max_terms: int = MAX_TERMS, k: int = NEAREST) -> DataFrame:
    """``id, held_out, score, predicted, evidence`` for every row of ``docs``."""
    spark = docs.sparkSession
    lid = common.quoted(doc_id)
    means = (labels.where(lid.isNotNull() & ~held_out(lid)).groupBy(lid.alias("id")).agg(F.avg(common.quoted(label).cast("double")).alias("y"))
             .where("y IS NOT NULL").orderBy(F.xxhash64("id"), "id").limit(max_train))
    some = F.broadcast(common.cut(means.select("id", F.when(F.col("y") >= 0.5, 1).otherwise(0).alias("toxic"))))
    every = docs.select(lid.alias("id"), common.quoted(text).cast("string").alias("text"))
    learned = every.join(some, "id").groupBy("id", "toxic").agg(F.min("text").alias("text"))
    # exact copies of a text are learned once
    learned = learned.groupBy("text").agg(F.max("toxic").alias("toxic"))
    learned = common.table(learned)
    n, toxic = learned.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    base = toxic / n if n else 0.0
    terms = choose(stem_counts(learned), toxic, n - toxic, max_terms)
    find = term_finder(terms)

    def count(batch: pa.RecordBatch) -> dict:
        found = [find(t) for t in common.encoded(batch.column("text"))]
        return {"terms": [x[0] for x in found], "counts": [x[1] for x in found]}

    ints = ArrayType(IntegerType())
    rows = common.table(common.map_batches(every, count, [StructField("terms", ints), StructField("counts", ints)], ["text"], ["id"]))
    seen = dict(rows.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*")).collect())  # at most max_terms
    total = rows.count()
    idf = np.array([math.log((1 + total) / (1 + seen.get(t, 0))) + 1 for t in range(len(terms))])
    examples = (rows.join(some, "id").groupBy("id", "toxic").agg(F.min(F.struct("terms", "counts")).alias("v"))
                .select("id", "v.terms", "v.counts", "toxic").collect())  # at most max_train
    model = spark.sparkContext.broadcast(Model.of(terms, idf, [tuple(r) for r in examples], base, k))
    kind = docs.schema[doc_id].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            found = []
            for key in zip(map(tuple, batch.column("terms").to_pylist()), map(tuple, batch.column("counts").to_pylist()), strict=True):
                if key not in known:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[key] = model.value.judge(*key)
                found.append(known[key])
            evidence = [[{"id": i, "cosine": c, "toxic": y} for i, c, y in e] for _, e in found]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([s for s, _ in found], pa.float64()),
                                              pa.array(evidence, arrow.field("evidence").type)], schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema

    near = ArrayType(StructType([StructField("id", kind), StructField("cosine", DoubleType()), StructField("toxic", DoubleType())]))
    schema = StructType([StructField("id", kind), StructField("score", DoubleType()), StructField("evidence", near)])
    arrow = to_arrow_schema(schema)
    judged = common.in_batches(rows.select("id", "terms", "counts"), run, schema)
    return judged.select("id", held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")
