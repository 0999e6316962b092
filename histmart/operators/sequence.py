"""Skew-safe "next row" (``lead``) within a partition ordered by time.

``lead(x) over (partition by card order by ts)`` sends every row of a card to
one task. That is right for ordinary cards: one shuffle, one sort. A group
(card and day) above ``HOT_ROWS`` rows would be a straggler, so such groups,
found by a map-side-combined count, take two windows whose groups are bounded:

1. rows are windowed by (partition keys, time bucket) - a bucket is one
   minute by default; every row except the last of its bucket gets its
   successor here;
2. only the first and last row of each bucket are kept (at most 2 x 1440 rows
   per card and day) and windowed by the partition keys alone; there the
   successor of a bucket's last row is the first row of the next non-empty
   bucket, whatever the gap.

The rows of (1) are hash-repartitioned on all its keys, so the split by bucket
holds even when the input is already partitioned by the card alone. The bucket
id comes from the calendar fields of the TIMESTAMP_NTZ, so it is monotonic in
time regardless of the session zone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import col

#: A group of more rows goes through the bucketed path.
HOT_ROWS = 1_000_000

_B, _FIRST, _LAST = "__seq_bucket", "__seq_first", "__seq_last"


def time_bucket(ts, bucket_minutes: int = 1):
    """Minutes since 1970-01-01 of ``ts`` (NTZ calendar), divided by width."""
    ts = col(ts)
    minutes = (F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long") * 1440
               + F.hour(ts) * 60 + F.minute(ts))
    return F.floor(minutes / F.lit(bucket_minutes)) if bucket_minutes != 1 else minutes


def hot_groups(df: DataFrame, partition_by: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """Keys of the groups above ``hot_rows`` rows (at most rows / hot_rows of
    them, so the result may be broadcast); None when there is none."""
    counts = df.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > hot_rows)
    keys = counts.select(*partition_by).collect()
    return df.sparkSession.createDataFrame(keys, df.select(*partition_by).schema) if keys else None


def with_next(df: DataFrame, partition_by: Sequence[str], order_by: str, tiebreak: str,
              carry: Sequence[str], prefix: str = "next_", hot: DataFrame | None = None,
              bucket_minutes: int = 1) -> DataFrame:
    """Add ``prefix+c`` = value of ``c`` on the following row of the sequence
    (partition ``partition_by``, order ``(order_by, tiebreak)``), null on the
    last row. ``hot`` holds the keys of groups to split by time bucket."""
    plain = df if hot is None else df.join(F.broadcast(hot), list(partition_by), "left_anti").select(df.columns)
    w = Window.partitionBy(*partition_by).orderBy(F.col(order_by), F.col(tiebreak))
    out = plain.select(*df.columns, *[F.lead(c).over(w).alias(prefix + c) for c in carry])
    if hot is None:
        return out
    split = df.join(F.broadcast(hot), list(partition_by), "left_semi").select(df.columns)
    return out.unionByName(_by_bucket(split, partition_by, order_by, tiebreak, carry, prefix, bucket_minutes))


def _by_bucket(df: DataFrame, partition_by, order_by, tiebreak, carry, prefix, bucket_minutes) -> DataFrame:
    cols = df.columns
    parts = [F.col(c) for c in partition_by]
    order = [F.col(order_by).asc(), F.col(tiebreak).asc()]
    w_bucket = Window.partitionBy(*parts, F.col(_B)).orderBy(*order)
    x = df.withColumn(_B, time_bucket(order_by, bucket_minutes)).repartition(*parts, F.col(_B))
    x = x.select(
        *cols, _B,
        *[F.lead(c).over(w_bucket).alias(prefix + c) for c in carry],
        F.lag(F.lit(True)).over(w_bucket).isNull().alias(_FIRST),
        F.lead(F.lit(True)).over(w_bucket).isNull().alias(_LAST),
    )
    inside = x.where(~F.col(_LAST)).select(*cols, *[prefix + c for c in carry])
    w_edge = Window.partitionBy(*parts).orderBy(*order)
    edges = (x.where(F.col(_FIRST) | F.col(_LAST))
             .select(*cols, _LAST, *[F.lead(c).over(w_edge).alias(prefix + c) for c in carry])
             .where(F.col(_LAST))
             .select(*cols, *[prefix + c for c in carry]))
    return inside.unionByName(edges)
