"""Embedding near-duplicates (operator 5) by an epsilon grid order join.

A cosine of at least ``c`` between two vectors is a distance of at most
``eps = sqrt(2 - 2c)`` between their unit vectors, and an orthogonal projection
never lengthens a distance. Unit vectors are projected on their leading
principal directions (a covariance summed by grouped aggregation), placed in a
grid of width eps on the first of them, sorted by grid cell (range
partitions, so a full cell spans many), and cut into blocks of bounded size.
Two blocks are joined only if they touch the same or a neighbouring cell and
their boxes lie within eps. Inside a pair of blocks the join halves the longer
sequence interval and skips pairs whose boxes are farther apart than eps; what
is left is compared by its cosines, in double precision near the limit.

Equal vectors are one class from the start, so a group of copies is compared
once; links are counted with the sizes of classes. Per compared interval only
spanning links go on, never all pairs of a group.

Defined cases: null, empty, zero and non-finite vectors link with nothing;
vectors of different lengths don't link, those of each length are joined by
themselves; a null id names no component; repeated rows are vectors of
one class; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, StructField

from . import common
from .components import components

#: Directions used for boxes, and of these for grid cells.
BOX_DIMS, GRID_DIMS = 16, 3
LEAF = 512

def near(dims: int) -> float:
    """Cosines in single precision this close to the limit are computed again in double precision.

    Rounding both unit vectors and ``dims`` products and sums shifts a cosine by less than (dims + 3) * 2^-24 (and its
    square, negligible); twice that is taken.
    """
    return max(1e-5, (dims + 4) * 2.0 ** -23)


def as_vector(x) -> np.ndarray | None:
    """Double-precision vector, or None if it links with nothing."""
    if x is None or not len(x):
        return None
    v = np.array([math.nan if e is None else e for e in x] if any(e is None for e in x) else x, np.float64)
    if not np.isfinite(v).all():
        return None
    top = np.abs(v).max()
    return v if top > 0 else None


def unit(v: np.ndarray) -> np.ndarray:
    """Rows at length 1; scaled by the largest entry first, so that squares neither overflow nor vanish."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def keyed(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``id, size, key``: a 128-bit digest of the vector's values; null key if it links with nothing."""

    def run(batch: pa.RecordBatch) -> dict:
        found = [as_vector(x) for x in batch.column("v").to_pylist()]
        return {"size": [None if v is None else len(v) for v in found],
                "key": [None if v is None else hashlib.blake2b((v + 0.0).tobytes(), digest_size=16).digest() for v in found]}

    rows = vectors.select(common.quoted(vec_id).alias("id"), common.quoted(embedding).cast("array<double>").alias("v"))
    return common.map_batches(rows, run, [StructField("size", IntegerType()), StructField("key", BinaryType())], ["v"], ["id", "v"])


def matrix(batch: pa.RecordBatch, column: str, dims: int) -> np.ndarray:
    col = batch.column(column)
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), dims)


def principal(classes: DataFrame, dims: int) -> np.ndarray:
    """Leading principal directions of the unit vectors (columns); dims x dims sums reach the driver."""

    def sums(batches):
        total = np.zeros((dims + 1, dims + 1))
        for batch in batches:
            u = np.hstack([unit(matrix(batch, "v", dims)), np.ones((batch.num_rows, 1))])
            total += u.T @ u
        flat = total.ravel()
        on = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(on, pa.int32()), pa.array(flat[on])], ["at", "s"])

    got = common.in_batches(classes.select("v"), sums, "at int, s double").groupBy("at").agg(F.sum("s").alias("s")).collect()
    total = np.zeros((dims + 1) ** 2)
    for at, s in got:
        total[at] = s
    total = total.reshape(dims + 1, dims + 1)
    n = max(1.0, total[-1, -1])
    mean = total[-1, :-1] / n
    _, directions = np.linalg.eigh(total[:-1, :-1] / n - np.outer(mean, mean))
    return directions[:, ::-1][:, :BOX_DIMS]


def blocks_in_order(classes: DataFrame, basis: np.ndarray, eps: float, dims: int, block_rows: int) -> DataFrame:
    """Vectors in grid order, one row per block: ids, class sizes, values and the box of their coordinates."""
    m = basis.shape[1]
    grid = min(GRID_DIMS, m)

    def place(batch: pa.RecordBatch) -> dict:
        at = unit(matrix(batch, "v", dims)) @ basis
        return {f"c{i}": np.floor(at[:, i] / eps).astype(np.int32) for i in range(grid)} | \
            {f"p{i}": at[:, i] for i in range(grid)}

    cells, ties = [f"c{i}" for i in range(grid)], [f"p{i}" for i in range(grid)]
    fields = [*(StructField(c, IntegerType()) for c in cells), *(StructField(p, DoubleType()) for p in ties)]
    placed = common.cut(common.map_batches(classes, place, fields, ["v"], ["id", "n", "v"]))
    ordered = placed.repartitionByRange(*cells, *ties).sortWithinPartitions(*cells, *ties).select("id", "n", "v")

    def pack(batches):
        own, held, k = TaskContext.get().partitionId(), [], 0
        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= block_rows:
                table = pa.Table.from_batches(held)
                yield packed(table.slice(0, block_rows), (own << 32) + k, basis)
                held, k = table.slice(block_rows).to_batches(), k + 1
        if sum(b.num_rows for b in held):
            yield packed(pa.Table.from_batches(held), (own << 32) + k, basis)

    return common.cut(common.in_batches(ordered, pack, "block long, n int, data binary, lo array<double>, hi array<double>"))


def packed(table: pa.Table, block: int, basis: np.ndarray) -> pa.RecordBatch:
    """One block; values that single precision holds exactly are packed so."""
    batch = table.combine_chunks().to_batches()[0]
    v = matrix(batch, "v", len(basis))
    at, short = unit(v) @ basis, v.astype("<f4")
    values = short if (short == v).all() else v.astype("<f8")
    data = b"".join([np.array([values.itemsize], "<i8").tobytes(), batch.column("id").to_numpy().astype("<i8").tobytes(),
                     batch.column("n").to_numpy().astype("<i8").tobytes(), values.tobytes()])
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int64()), pa.array([len(v)], pa.int32()), pa.array([data], pa.binary()),
         pa.array([at.min(axis=0)]), pa.array([at.max(axis=0)])], ["block", "n", "data", "lo", "hi"])


class Block:
    """A block unpacked; intervals of it are slices."""

    def __init__(self, data: bytes, n: int, basis: np.ndarray):
        width, *_ = np.frombuffer(data, "<i8", 1)
        self.ids, self.sizes = np.frombuffer(data, "<i8", 2 * n, 8).reshape(2, n)
        self.unit = unit(np.frombuffer(data, f"<f{width}", -1, 8 + 16 * n).reshape(n, len(basis)).astype(np.float64))
        self.at = self.unit @ basis
        self.single = self.unit.astype(np.float32)


def box_gap(lo_a, hi_a, lo_b, hi_b) -> float:
    """Squared distance between two boxes."""
    gap = np.maximum(0, np.maximum(lo_a - hi_b, lo_b - hi_a))
    return float((gap * gap).sum())


def joined(a: Block, b: Block, same: bool, cosine: float, eps: float):
    """Yields (row intervals, link matrix) of the interval pairs that can't be skipped, each pair of rows once."""
    limit, close = eps * eps + 1e-9, near(a.unit.shape[1])
    stack = [(0, len(a.ids), 0, len(b.ids))]
    while stack:
        i, j, k, l = stack.pop()
        if same and k < i and l <= i:
            continue
        pa_, pb = a.at[i:j], b.at[k:l]
        if box_gap(pa_.min(axis=0), pa_.max(axis=0), pb.min(axis=0), pb.max(axis=0)) > limit:
            continue
        if j - i <= LEAF and l - k <= LEAF:
            dot = a.single[i:j] @ b.single[k:l].T
            link = dot >= cosine + close
            r, c = np.nonzero(np.abs(dot - cosine) <= close)
            link[r, c] = np.einsum("ij,ij->i", a.unit[i + r], b.unit[k + c]) >= cosine
            if same and i == k:
                link &= np.tri(j - i, l - k, -1, dtype=bool).T
            if link.any():
                yield i, j, k, l, link
        elif same and i == k and j == l:
            h = (i + j) // 2
            stack += [(i, h, i, h), (i, h, h, j), (h, j, h, j)]
        elif j - i >= l - k:
            h = (i + j) // 2
            stack += [(i, h, k, l), (h, j, k, l)]
        else:
            h = (k + l) // 2
            stack += [(i, j, k, h), (i, j, h, l)]


def spanning(link: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) links that keep the connected parts of a link matrix: at most rows + columns of them."""
    r, c = np.nonzero(link)
    if len(r) <= sum(link.shape):
        return r, c
    n = link.shape[0]
    top_r, top_c = np.arange(n), np.full(link.shape[1], n)  # smallest row of the part, by growing minima
    while True:
        new_c = np.minimum(top_c, np.where(link, top_r[:, None], n).min(axis=0))
        new_r = np.minimum(top_r, np.where(link, new_c[None, :], n).min(axis=1))
        if (new_r == top_r).all() and (new_c == top_c).all():
            break
        top_r, top_c = new_r, new_c
    # a breadth-first tree from the smallest rows: each further row or column takes one link towards its part's tree
    done_r, done_c = (top_r == np.arange(n)) & link.any(axis=1), np.zeros(link.shape[1], bool)
    out_r, out_c = [], []
    while True:
        reach = link & done_r[:, None] & ~done_c[None, :]
        cols = np.flatnonzero(reach.any(axis=0))
        out_r.append(reach[:, cols].argmax(axis=0)), out_c.append(cols)
        done_c[cols] = True
        reach = link & done_c[None, :] & ~done_r[:, None]
        rows = np.flatnonzero(reach.any(axis=1))
        out_r.append(rows), out_c.append(reach[rows].argmax(axis=1))
        done_r[rows] = True
        if not len(cols) and not len(rows):
            return np.concatenate(out_r), np.concatenate(out_c)


def block_pairs(blocks: DataFrame, eps: float, m: int) -> DataFrame:
    """Pairs ``a <= b`` of blocks that touch equal or neighbouring cells and whose boxes lie within eps."""
    grid = min(GRID_DIMS, m)

    cells = [f"c{i}" for i in range(grid)]

    def touched(name: str, reach: int) -> DataFrame:
        out = blocks.select(F.col("block").alias(name), F.col("lo").alias(f"lo_{name}"), F.col("hi").alias(f"hi_{name}"))
        for i, c in enumerate(cells):
            first, last = (F.floor(F.col(f"{end}_{name}")[i] / eps) + by for end, by in (("lo", -reach), ("hi", reach)))
            out = out.withColumn(c, F.explode(F.sequence(first.cast("int"), last.cast("int"))))
        return out

    gap = F.aggregate(F.arrays_zip("lo_a", "hi_a", "lo_b", "hi_b"), F.lit(0.0), lambda s, z: s + F.pow(
        F.greatest(F.lit(0.0), z["lo_a"] - z["hi_b"], z["lo_b"] - z["hi_a"]), F.lit(2.0)))
    return touched("a", 0).join(touched("b", 1), cells).where("a <= b").where(gap <= eps * eps + 1e-9).select("a", "b").distinct()


def links(classes: DataFrame, cosine: float, dims: int, block_rows: int) -> DataFrame:
    """``(a, b, w)``: spanning links ``a <> b`` with ``w`` null, and link counts ``w`` of ``a`` with ``b`` null."""
    eps = math.sqrt(max(0.0, 2 - 2 * cosine))
    basis = principal(classes, dims)
    m = basis.shape[1]
    blocks = blocks_in_order(classes, basis, eps, dims, block_rows)
    pairs = common.cut(block_pairs(blocks, eps, m))
    needed = pairs.select("a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("block"))
    sides = needed.join(blocks.select("block", "n", "data"), "block")

    def compare(pair: pa.Table) -> pa.Table:
        at = {r["block"]: Block(r["data"], r["n"], basis) for r in pair.to_pylist()}
        first, second = pair.column("a")[0].as_py(), pair.column("b")[0].as_py()
        same, a, b = first == second, at[first], at[second]
        n_a, n_b = np.zeros(len(a.ids), np.int64), np.zeros(len(b.ids), np.int64)
        parts = []
        for i, j, k, l, link in joined(a, b, same, cosine, eps):
            n_a[i:j] += link @ b.sizes[k:l]
            n_b[k:l] += a.sizes[i:j] @ link
            r, c = spanning(link)
            parts.append(out(a.ids[i + r], b.ids[k + c], None))
        for ids, n in [(a.ids, n_a + n_b)] if same else [(a.ids, n_a), (b.ids, n_b)]:
            parts.append(out(ids[n > 0], None, n[n > 0]))
        return pa.Table.from_batches(parts)

    def out(a, b, w):
        null = pa.nulls(len(a), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), null if b is None else pa.array(b, pa.int64()),
                                           null if w is None else pa.array(w, pa.int64())], ["a", "b", "w"])

    common.prepare(sides.sparkSession)
    return common.cut(sides.groupBy("a", "b").applyInArrow(compare, "a long, b long, w long"))


def near_duplicates(vectors: DataFrame, cosine: float = 0.9, vec_id: str = "vec_id", embedding: str = "embedding",
                    block_rows: int = 4096) -> DataFrame:
    """``id, n_links, component_id, kept`` for every row; ``component_id`` is the smallest id reachable by links."""
    rows = keyed(vectors, vec_id, embedding)
    ids = common.cut(rows.select("id", "key"))
    classes = rows.where("key IS NOT NULL").groupBy("size", "key").agg(
        F.min(F.col("id")).alias("first"), F.count("*").alias("n"), F.first("v").alias("v"))
    classes = common.cut(classes.withColumn("id", F.monotonically_increasing_id()))
    sizes = [r["size"] for r in classes.groupBy("size").count().where("count > 1").orderBy("size").collect()]
    found = classes.sparkSession.createDataFrame([], "a long, b long, w long")
    for k, dims in enumerate(sizes):
        more = links(classes.where(F.col("size") == dims).select("id", "n", "v"), cosine, dims, block_rows)
        found = found.unionByName(more) if k else more
    counts = found.where("w IS NOT NULL").groupBy(F.col("a").alias("id")).agg(F.sum("w").alias("w"))
    tree = components(found.where("b IS NOT NULL")).select(F.col("node").alias("id"), F.col("component").alias("top"))
    placed = common.cut(classes.select("id", "key", "first", "n").join(counts, "id", "left").join(tree, "id", "left")
                        .select("key", "first", "n", (F.coalesce("w", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                                F.coalesce("top", "id").alias("top")))
    tops = common.cut(placed.groupBy("top").agg(F.min("first").alias("component_id"), F.count("*").alias("m")))
    placed = common.cut(common.attach(placed, tops, "top", "m").select("key", "n", "n_links", "component_id"))
    linked = common.attach(ids.where("key IS NOT NULL"), placed, "key", "n").select("id", "n_links", "component_id")
    alone = ids.where("key IS NULL").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)))
