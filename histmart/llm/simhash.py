"""SimHash near-duplicates (operator 2) with sharded BK-trees.

Fingerprint: 64 bits over word shingles, each hashed by XXH64; a bit is 1 if
set in over half the hashes. Texts are lower-cased in A-Z, words are runs of
anything but ASCII white space, repeats count.

Search: identical fingerprints are one class (grouped aggregation), so copies
never meet in the trees. Two fingerprints within ``radius`` bits agree on one
of ``radius + 1`` bit ranges, so a shard holds the fingerprints that agree on
one range, and each shard gets a BK-tree: children are keyed by their Hamming
distance to the parent, and a search follows only the edges whose key is
within the radius of its own distance to the node. Shards are dealt to tasks
instead of broadcast, since all trees together grow with the corpus and have
no size bound. A shard above ``max_shard`` is dealt anew by the same rule over
its remaining bits; after three levels at most 2^19 fingerprints can share one
shard. Within a shard only spanning links are emitted; components run over all
of them.

Defined cases: null and wordless texts have fingerprint 0 and link like any
other; a null id never names a component (a class of null ids only has a null
``component_id``); tied and repeated rows share their class; an empty table
gives no rows; clashing extra columns are not carried.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, MapType, StructField

from . import common
from .components import components

BITS = 64
ALL = 2 ** BITS - 1
LEVELS = 3
#: Characters of row keys that may be broadcast.
MAX_BROADCAST = 32 << 20


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 (seed 42) of each shingle of ``size`` words; a shorter text is one shingle."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = list(accumulate((len(w) + 1 for w in words)))
    starts = [0, *ends[:-1]]
    spans = zip(starts, ends[size - 1:], strict=False) if len(words) >= size else [(0, len(joined) + 1)]
    return np.array([xxh64_intdigest(joined[s:e - 1], 42) for s, e in spans], np.uint64)


def fingerprint(text: bytes, size: int = 3) -> int:
    """Bits set in over half the shingle hashes, as a signed 64-bit number; 0 without words."""
    hashes = shingle_hashes(text, size)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int32)
    bits = 2 * ones > len(hashes)
    return int(np.packbits(bits).view(">i8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 3) -> DataFrame:
    """``(id, fp)`` of every row."""

    def run(batch: pa.RecordBatch) -> dict:
        return {"fp": [fingerprint(t, size) for t in common.encoded(batch.column("text"))]}

    rows = docs.select(common.quoted(doc_id).alias("id"), common.quoted(text).cast("string").alias("text"))
    return common.map_batches(rows, run, [StructField("fp", LongType())], ["text"], ["id"])


class BKTree:
    """Fingerprints under a root; a child hangs on the edge named by its distance to the parent."""

    def __init__(self):
        self.root: tuple[int, dict] | None = None

    def add(self, fp: int) -> None:
        if self.root is None:
            self.root = (fp, {})
            return
        node = self.root
        while (d := (node[0] ^ fp).bit_count()) in node[1]:
            node = node[1][d]
        if d:
            node[1][d] = (fp, {})

    def within(self, fp: int, radius: int) -> list[int]:
        found, stack = [], [self.root] if self.root else []
        while stack:
            at, edges = stack.pop()
            d = (at ^ fp).bit_count()
            if d <= radius:
                found.append(at)
            for e, child in edges.items():
                if d - radius <= e <= d + radius:
                    stack.append(child)
        return found


def spanning_links(members: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that connect what lies within the radius, one less than the members of each connected part."""
    tree, above, links = BKTree(), {}, []

    def top(x: int) -> int:
        while above[x] != x:
            above[x] = above[above[x]]
            x = above[x]
        return x

    for fp in members:
        above[fp] = fp
        for near in tree.within(fp, radius):
            if (a := top(near)) != (b := top(fp)):
                above[b] = a
                links.append((near, fp))
        tree.add(fp)
    return links


def ranges(mask: int, parts: int) -> list[int]:
    """The bits of ``mask`` in ``parts`` masks of nearly equal size."""
    bits = [1 << k for k in range(BITS) if mask >> k & 1]
    return [sum(bits[len(bits) * i // parts:len(bits) * (i + 1) // parts]) for i in range(parts)]


def signed(x: int) -> int:
    return x - 2 ** BITS if x >> BITS - 1 else x


def deal(rows: DataFrame, radius: int, known: bool) -> DataFrame:
    """One row per fingerprint and further bit range: ``mask`` grows by the range, ``value`` is the bits under it."""
    if not known:
        masks = F.array(*(F.lit(signed(m)) for m in ranges(ALL, radius + 1)))
        return rows.select("fp", F.explode(masks).alias("mask")).select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value"))
    held = [r[0] for r in rows.select("mask").distinct().collect()]  # at most (radius + 1) ** level masks
    grown = F.create_map(*(x for m in held for x in (F.lit(m), F.array(*(F.lit(signed((m & ALL) | part)) for part in ranges(ALL & ~(m & ALL), radius + 1))))))
    return (rows.select("fp", F.explode(grown[F.col("mask")]).alias("mask"))
            .select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value")).distinct())


def links(fps: DataFrame, radius: int, max_shard: int = 2048) -> DataFrame:
    """Spanning links ``(a, b)`` of the distinct fingerprints ``fp`` within ``radius`` bits."""
    found, rows = [], deal(fps.select("fp"), radius, known=False)
    for level in range(1, LEVELS + 1):
        shards = rows
        if level < LEVELS:
            large = common.cut(rows.groupBy("mask", "value").agg(F.count("*").alias("n")).where(F.col("n") > max_shard).drop("n"))
            n = large.count()
            side = F.broadcast(large) if n <= common.BROADCAST_ROWS else large
            if n:
                shards = rows.join(side, ["mask", "value"], "left_anti")
                rows = common.cut(deal(rows.join(side, ["mask", "value"], "left_semi"), radius, known=True))
        found.append(shards.groupBy("mask", "value").agg(F.collect_list("fp").alias("members")).where(F.size("members") > 1))
        if level == LEVELS or not n:
            break
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)

    def search(batches):
        for batch in batches:
            pairs = [p for m in batch.column(0).to_pylist() for p in spanning_links([x & ALL for x in m], radius)]
            yield pa.RecordBatch.from_arrays([pa.array([signed(p[i]) for p in pairs], pa.int64()) for i in (0, 1)], ["a", "b"])

    return common.in_batches(every.select("members"), search, "a long, b long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 3, radius: int = 2,
                    max_shard: int = 2048) -> DataFrame:
    """``id, fp, component_id`` for every row; ``component_id`` is the smallest id reachable by links."""
    rows = common.cut(fingerprints(docs, doc_id, text, size))
    classes = common.cut(rows.groupBy("fp").agg(F.min("id").alias("first"), F.count("*").alias("n")))
    tree = components(links(classes, radius, max_shard)).select(F.col("node").alias("fp"), F.col("component").alias("top"))
    placed = common.cut(classes.join(tree, "fp", "left").withColumn("top", F.coalesce("top", "fp")))
    tops = common.cut(placed.groupBy("top").agg(F.min("first").alias("component_id"), F.count("*").alias("m")))
    placed = common.cut(common.attach(placed, tops, "top", "m").select("fp", "n", "component_id"))
    return common.attach(rows, placed, "fp", "n").select("id", "fp", "component_id")


def row_key(docs: DataFrame, doc_id: str):
    """Orders rows by id (null last), then by two hashes of the whole row, so rows of one id are told apart."""
    parts = [x for f in docs.schema.fields if not isinstance(f.dataType, MapType)
             for x in (common.quoted(f.name), common.quoted(f.name).isNull())]
    own = common.quoted(doc_id)
    return F.struct(own.isNull().alias("n"), own.alias("i"), F.xxhash64(*parts).alias("x"), F.hash(*parts).alias("y"))


def joined_key(key: str):
    """The row key as one text, for joins."""
    at = lambda c: F.col(key)[c].cast("string")
    return F.concat_ws(":", at("n"), at("x"), at("y"), F.coalesce(at("i"), F.lit("")))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 3, radius: int = 2) -> DataFrame:
    """``docs`` with one row of each component: the one of the smallest id, and of rows that repeat it the smallest by hash.

    Rows are decided one by one, so two unrelated texts under one id both stay, and of copies under null ids one goes
    if another row stays for them. Rows equal in every column are one row (columns of maps are not compared)."""
    key, row = "__simhash_key", "__simhash_row"
    marked = docs.withColumn(key, row_key(docs, doc_id))
    found = near_duplicates(marked, key, text, size, radius)
    seen = common.cut(found.groupBy("id").agg(F.min(F.col("id") != F.col("component_id")).alias("gone"), F.count("*").alias("n"))
                      .where("gone OR n > 1").select(joined_key("id").alias(row), "gone"))
    n, wide = seen.agg(F.count("*"), F.max(F.length(row))).first()
    side = F.broadcast(seen) if n * (wide or 0) <= MAX_BROADCAST else seen
    marked = marked.withColumn(row, joined_key(key))
    single = marked.join(side, row, "left_anti")
    repeated = marked.join(side.where("NOT gone").select(row), row, "left_semi")
    own = [c for c in docs.columns]
    first = (repeated.groupBy(row).agg(F.min(F.struct(*map(common.quoted, own))).alias("r"))
             .select(*(F.col("r")[c].alias(c) for c in own)))
    return single.select(*map(common.quoted, own)).unionByName(first)
