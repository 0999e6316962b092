"""Shared helpers: lineage cuts, skew-safe joins, Arrow batch plumbing."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..session import checkpoint_dir, cut_lineage

#: A side of a join is broadcast only if it was counted and has at most so many rows.
BROADCAST_ROWS = 100_000
#: A key is hot if it holds more than this share of all rows; so at most 1 / HOT_SHARE keys are hot.
HOT_SHARE = 1 / 256
#: An Arrow batch holds about so many bytes at most (one longer row is a batch of its own).
BATCH_BYTES = 4 << 20
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
#: And so many rows at most, as objects made of short rows are larger than the rows.
BATCH_ROWS, ROWS_CONF = 2_000, "spark.sql.execution.arrow.maxRecordsPerBatch"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared checkpoint folder (survives lost executors)."""
    return cut_lineage(df)


def table(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet into the shared checkpoint folder and read again: columnar and compressed, for
    what is large or read in parts. The files go when the session ends."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)


def attach(left: DataFrame, right: DataFrame, key: str, weight: str, how: str = "inner",
           max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join ``right`` (one row per ``key``, already computed; ``weight`` = its rows in ``left``) to ``left``.

    A counted small side is broadcast. Beyond that, keys holding more than
    HOT_SHARE of the rows (at most 1 / HOT_SHARE of them) are joined by
    broadcast and all others by shuffle, so that no task gets a hot key.
    ``how``: inner or left. ``right`` must have no other column of ``left``.
    """
    n, total = right.agg(F.count("*"), F.sum(weight)).first()
    if n <= max_rows:
        return left.join(F.broadcast(right.drop(weight)), key, how)
    hot = F.col(weight) > total * HOT_SHARE
    few = F.broadcast(right.where(hot).drop(weight))
    many = right.where(~hot).drop(weight)
    rest = left.join(F.broadcast(few.select(key)), key, "left_anti")
    return left.join(few, key).unionByName(rest.join(many, key, how))


def in_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` over Arrow batches of ``df``."""
    prepare(df.sparkSession)
    return df.mapInArrow(fn, schema)


def prepare(spark: SparkSession) -> None:
    """Bounded Arrow batches, in the JVM and in Python; workers look for this package where the driver found it
    (a cluster ships it by --py-files)."""
    if int(spark.conf.get(BATCH_CONF).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))
    if not 0 < int(spark.conf.get(ROWS_CONF)) <= BATCH_ROWS:
        spark.conf.set(ROWS_CONF, str(BATCH_ROWS))
    env = spark.sparkContext.environment
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict[str, list | pa.Array]],
                fields: list[StructField], inputs: list[str], keep: list[str] | None = None) -> DataFrame:
    """Append the columns ``fn`` computes from ``inputs``, by Arrow batches.

    ``keep`` names the columns passed through (default: all but clashing
    ones); new columns replace those of the same name.
    """
    new = {f.name for f in fields}
    keep = [c for c in (df.columns if keep is None else keep) if c not in new]
    used = list(dict.fromkeys([*keep, *inputs]))
    schema = StructType([*(df.schema[c] for c in keep), *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            for part in slices(batch, inputs[0]):
                cols = fn(part)
                yield pa.RecordBatch.from_arrays(
                    [as_type(part.column(c) if c in keep else cols[c], arrow.field(c).type) for c in arrow.names],
                    schema=arrow)

    return in_batches(df.select(*(quoted(c) for c in used)), run, schema)


def quoted(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def set_aside(df: DataFrame, names) -> tuple[DataFrame, list]:
    """``df`` with its columns among ``names`` renamed, and the columns that give all back under their own names."""
    safe = {c: f"__own_{c}" if c in names else c for c in df.columns}
    return df.select(*(quoted(c).alias(a) for c, a in safe.items())), [quoted(a).alias(c) for c, a in safe.items()]


def as_type(col, kind: pa.DataType) -> pa.Array:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not isinstance(col, pa.Array):
        return pa.array(col, kind)
    return col if col.type == kind else col.cast(kind)


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose ``column`` (text, binary or lists) holds about ``most_bytes`` each; a longer value is alone."""
    col = batch.column(column)
    if batch.num_rows <= 1 or col.nbytes <= most_bytes:
        yield batch
        return
    sizes = pc.multiply(pc.list_value_length(col), 8) if pa.types.is_list(col.type) else pc.binary_length(col)
    start, held = 0, 0
    for i, n in enumerate(sizes.fill_null(0).to_pylist()):
        if held and held + n > most_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    yield batch.slice(start)


def encoded(col: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column; null gives no bytes."""
    return [x or b"" for x in col.cast(pa.binary()).to_pylist()]


#: ASCII but for letters becomes a space, capital letters small ones; other bytes stay.
LETTERS = bytes(32 if not (65 <= b <= 90 or 97 <= b <= 122 or b >= 128) else b + 32 if 65 <= b <= 90 else b for b in range(256))


def letter_runs(text: bytes, piece: int = 1 << 20) -> Iterator[list[bytes]]:
    """Runs of ASCII letters (made small) and of characters beyond ASCII, in lists of about ``piece`` bytes of text."""
    text, at = text.translate(LETTERS), 0
    while at < len(text):
        end = text.find(b" ", at + piece)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def stacked(col: pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as a matrix."""
    flat = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in col.chunks] or [np.zeros(0)])
    return flat.reshape(len(col), -1).astype(np.float64) if len(col) else flat.reshape(0, 1)
