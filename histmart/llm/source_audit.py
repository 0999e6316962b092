"""Source divergence audit (operator 12) with a frequent-pattern tree of term rows.

Every language keeps the terms of at least ``min_docs`` of its documents. Each
(lang, source) group, and the language, gives every kept term the share
``p = 1 + floor(10^9 * (count + 2) / (N + 2 V))``. Two shares differ by
``f = floor((p - q)^2 / (p + q))``; a pair of sources by the sum of f over all
kept terms. All arithmetic is in integers.

Summing over every (term, pair of sources) would be the vocabulary times the
square of the sources. Most counts are zero, so the sum is taken apart: with
p0 the share of an absent term,

    sum f = V * f(p0, q0)                                   no counts at all
          + sum over p's counts of f(p, q0) - f(p0, q0)     one side, by histogram
          + sum over q's counts of f(p0, q) - f(p0, q0)
          + sum over common terms of f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)

The last sum needs the terms both sources hold. A term's row is the list of its
sources in order, each with its count's share; equal rows are one row with a
multiplicity. Rows are range-partitioned and sorted, and each task inserts its
rows into a tree whose nodes are (source, share): rows that begin alike share
a path, a node's multiplicity is the number of terms below it, and each
combination of a node and an ancestor is corrected once, times that multiplicity.
As the rows come sorted, only the current path is held. A path that spans two
tasks is two nodes whose multiplicities add up.

Sources are dealt to blocks of about ``block`` by their hash, and a row is
inserted once per pair of blocks, so a path holds two blocks at most however
many sources a language has.

Defined cases: null text, lang and source are ''; a group without terms has
shares of absent terms only; a language without kept terms has value 0 for all
pairs; ties are ranked by item in UTF-8 order; repeated rows are documents of
their own; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

SCALE = 1_000_000_000
#: A task's counts are passed on when it holds so many of them.
HELD = 300_000


def f(p: str, q: str) -> Column:
    """floor((p - q)^2 / (p + q)) of two columns."""
    return F.expr(f"({p} - {q}) * ({p} - {q}) div ({p} + {q})")


def share(count: str, total: str, kept: str) -> Column:
    """1 + floor(10^9 (count + 2) / (total + 2 kept)); the product is a decimal, as it may pass 64 bits."""
    return F.expr(f"1 + (cast({SCALE} as decimal(10)) * cast({count} + 2 as decimal(19))) div cast({total} + 2 * {kept} as decimal(19))")


def term_counts(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, n, n_docs)``: occurrences and documents, over whole texts."""

    def rows(held: dict) -> pa.RecordBatch:
        flat = [(lang, source, term, n, seen[term]) for (lang, source), (counts, seen) in held.items() for term, n in counts.items()]
        cols = list(zip(*flat, strict=True)) or [()] * 5
        kinds = [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()]
        arrays = [pa.array(c, kind) for c, kind in zip(cols, kinds, strict=True)]
        arrays[2] = arrays[2].cast(pa.string())
        return pa.RecordBatch.from_arrays(arrays, ["lang", "source", "term", "n", "n_docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0
        for batch in batches:
            for part in common.slices(batch, "text"):
                for lang, source, text in zip(part.column("lang").to_pylist(), part.column("source").to_pylist(), common.encoded(part.column("text")), strict=True):
                    counts, seen = held.setdefault((lang, source), (Counter(), Counter()))
                    before, once = len(counts), set()
                    for words in common.letter_runs(text):
                        counts.update(words)
                        once.update(words)
                    seen.update(once)
                    size += len(counts) - before
                if size >= HELD:
                    yield rows(held)
                    held, size = {}, 0
        yield rows(held)

    texts = docs.select(*(F.coalesce(common.quoted(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    found = common.in_batches(texts, run, "lang string, source string, term string, n long, n_docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def kept_entries(docs: DataFrame, min_docs: int) -> DataFrame:
    """Counts of the kept terms, with the term's count in the language; ``head`` marks one row of each term."""
    of_term = Window.partitionBy("lang", "term")
    return (term_counts(docs)
            .select("lang", "source", "term", "n", F.sum("n").over(of_term).alias("n_lang"), F.sum("n_docs").over(of_term).alias("df"),
                    (F.row_number().over(of_term.orderBy("source")) == 1).alias("head"))
            .where(F.col("df") >= min_docs).drop("df"))


def group_key() -> Column:
    return F.concat(F.length("lang"), F.lit(":"), "lang", "source").alias("key")


def groups_of(docs: DataFrame, entries: DataFrame, block: int) -> DataFrame:
    """One row per occurring (lang, source): totals, the share of an absent term, its block and place in the block."""
    seen = docs.select(*(F.coalesce(common.quoted(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    own = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("weight"), F.sum(F.col("head").cast("long")).alias("heads"))
    rows = common.cut(seen.join(own, ["lang", "source"], "left").na.fill(0, ["total", "weight", "heads"]))
    langs = rows.groupBy("lang").agg(F.sum("heads").alias("kept"), F.sum("total").alias("lang_total"),
                                     F.ceil(F.count("*") / block).alias("n_blocks"))
    rows = (rows.drop("heads").join(langs, "lang")
            .withColumn("p0", F.when(F.col("kept") > 0, share("0L", "total", "kept")))
            .withColumn("block", F.pmod(F.xxhash64("source"), "n_blocks")))
    place = F.row_number().over(Window.partitionBy("lang", "block").orderBy("source")) - 1
    return common.cut(rows.withColumn("place", place.cast("long")).withColumn("key", group_key()))


def with_others(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Every row beside each other source of its language (``item``, ``q0``), dealt by block."""
    other = groups.select("lang", F.col("block").alias("at"), F.col("source").alias("item"), F.col("p0").alias("q0"))
    return (rows.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)))
            .join(other, ["lang", "at"]).where("item <> source"))


def term_rows(entries: DataFrame, width: int) -> DataFrame:
    """``(lang, a, b, items, n)``: source-ordered rows of (slot, share, absent share), flat, with multiplicities.

    (a, b) is a pair of blocks; the slots of the second block come after those of the first."""
    tiles = (entries.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)))
             .select("lang", "term", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"),
                     F.struct((F.col("place") + F.when(F.col("other") < F.col("block"), width).otherwise(0)).alias("slot"), "p", "p0").alias("item")))
    items = F.sort_array(F.collect_list("item"))
    rows = tiles.groupBy("lang", "a", "b", "term").agg(items.alias("items"))
    both = (F.col("items")[0]["slot"] < width) & (F.element_at("items", -1)["slot"] >= width)
    rows = rows.where((F.size("items") > 1) & ((F.col("a") == F.col("b")) | both))
    flat = F.flatten(F.transform("items", lambda x: F.array(x["slot"], x["p"], x["p0"])))
    return rows.groupBy("lang", "a", "b", flat.alias("items")).agg(F.count("*").alias("n"))


def differ(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


class TermTree:
    """The current path of a tree of rows that come sorted; nodes are corrected against their ancestors when they close."""

    def __init__(self, width: int, two_blocks: bool):
        self.width, self.two = width, two_blocks
        self.sums = np.zeros((2 * width, 2 * width) if two_blocks else (width, width), np.int64)
        self.path = np.zeros((0, 3), np.int64)
        self.count = np.zeros(0, np.int64)

    def insert(self, row: np.ndarray, n: int) -> None:
        """``row``: (slot, share, absent share) by slot."""
        shared = min(len(row), len(self.path))
        same = (row[:shared] == self.path[:shared]).all(axis=1)
        shared = shared if same.all() else int(same.argmin())
        self.close(shared)
        self.path = np.concatenate([self.path[:shared], row[shared:]])
        self.count = np.concatenate([self.count[:shared] + n, np.full(len(row) - shared, n, np.int64)])

    def close(self, depth: int) -> None:
        """Count the nodes from ``depth`` on, each with every ancestor."""
        slot, p, p0 = self.path.T
        if depth < len(slot) and len(slot) > 1:
            x, x0, y, y0 = p[depth:, None], p0[depth:, None], p[None, :], p0[None, :]
            joint = differ(x, y) - differ(x, y0) - differ(x0, y) + differ(x0, y0)
            above = np.arange(len(slot))[None, :] < np.arange(depth, len(slot))[:, None]
            if self.two:
                above &= (slot[None, :] < self.width) & (slot[depth:, None] >= self.width)
            self.sums[np.ix_(slot[depth:], slot)] += joint * above * self.count[depth:, None]


def pair_corrections(rows: DataFrame, width: int, tasks: int) -> DataFrame:
    """``(lang, a, b, i, j, value)``: summed corrections of the sources at places i of block a and j of block b."""

    def emit(key, tree: TermTree):
        tree.close(0)
        node, above = np.nonzero(tree.sums)
        k = len(node)
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]] * k, pa.string()), pa.array([key[1]] * k, pa.int64()), pa.array([key[2]] * k, pa.int64()),
             pa.array(above), pa.array(node - (width if tree.two else 0)), pa.array(tree.sums[node, above])],
            ["lang", "a", "b", "i", "j", "value"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, tree = None, None
        for batch in batches:
            items, n = batch.column("items"), batch.column("n").to_numpy()
            flat, ends = items.flatten().to_numpy(), items.offsets.to_numpy() - items.offsets[0].as_py()
            keys = zip(*(batch.column(c).to_pylist() for c in ("lang", "a", "b")), strict=True)
            for at, own in enumerate(keys):
                if own != key:
                    if tree:
                        yield emit(key, tree)
                    key, tree = own, TermTree(width, own[1] != own[2])
                tree.insert(flat[ends[at]:ends[at + 1]].reshape(-1, 3), n[at])
        if tree:
            yield emit(key, tree)

    by = ["lang", "a", "b", "items"]
    ordered = rows.repartitionByRange(tasks, *by).sortWithinPartitions(*by)
    return common.in_batches(ordered, run, "lang string, a long, b long, i long, j long, value long")


def audit(docs: DataFrame, min_docs: int = 10, top_terms: int = 10, block: int = 128) -> DataFrame:
    """``lang, source, part, item, value, rank``: the other sources of the language by divergence (part ``pair``),
    and the ``top_terms`` terms a source uses more than its language (part ``term``)."""
    spark = docs.sparkSession
    entries = common.table(kept_entries(docs, min_docs))
    groups = groups_of(docs, entries, block)
    width = (groups.agg(F.max("place")).first()[0] or 0) + 1
    facts = groups.where("weight > 0").select("key", "weight", "total", "kept", "lang_total", "n_blocks", "p0", "block", "place")
    entries = (common.attach(entries.withColumn("key", group_key()), facts, "key", "weight").drop("key")
               .withColumn("p", share("n", "total", "kept")))

    base = with_others(groups, groups).select(
        "lang", "source", "item", F.when(F.col("kept") > 0, F.col("kept") * f("p0", "q0")).otherwise(0).alias("value"))
    steps = entries.groupBy("lang", "source", "p", "p0", "n_blocks").agg(F.count("*").alias("n"))
    one_side = (with_others(steps, groups).groupBy("lang", "source", "item")
                .agg(F.sum(F.col("n") * (f("p", "q0") - f("p0", "q0"))).alias("value")))
    rows = common.table(term_rows(entries, width))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    place = lambda x, i, name: groups.select("lang", F.col("block").alias(x), F.col("place").alias(i), F.col("source").alias(name))
    joint = (pair_corrections(rows, width, tasks).groupBy("lang", "a", "b", "i", "j").agg(F.sum("value").alias("value"))
             .join(place("a", "i", "source"), ["lang", "a", "i"]).join(place("b", "j", "item"), ["lang", "b", "j"])
             .select("lang", "source", "item", "value"))
    turned = lambda df: df.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    pairs = base
    for part in (one_side, turned(one_side), joint, turned(joint)):
        pairs = pairs.unionByName(part)
    pairs = pairs.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    terms = (entries.withColumn("q", share("n_lang", "lang_total", "kept")).where("p > q")
             .select("lang", "source", F.col("term").alias("item"), f("p", "q").alias("value")))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    out = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(ranked).alias("rank"))
    return out(pairs, "pair").unionByName(out(terms, "term").where(F.col("rank") <= top_terms))
