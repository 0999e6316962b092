"""Join helpers: broadcast a side only after its size has been measured.

``sized_broadcast`` counts the rows of a side and sums the byte width of its
columns in one global aggregate (one row per task, no rows moved). The side is
hinted for broadcast only when both checks pass; otherwise the join stays a
shuffle join, where AQE can still split a skewed partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

DEFAULT_MAX_ROWS = 2_000_000
DEFAULT_MAX_BYTES = 64 * 1024 * 1024

_FIXED_WIDTH = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4,
    T.LongType: 8, T.FloatType: 4, T.DoubleType: 8, T.TimestampType: 8,
    T.TimestampNTZType: 8, T.DecimalType: 16,
}


def _conf_int(spark, key, default):
    try:
        v = spark.conf.get(key, None)
    except Exception:
        v = None
    return int(v) if v else default


def _size_aggs(df: DataFrame):
    fixed, var = 8, []
    for f in df.schema.fields:
        w = next((w for t, w in _FIXED_WIDTH.items() if isinstance(f.dataType, t)), None)
        if w is not None:
            fixed += w
        else:
            var.append(F.coalesce(F.octet_length(F.col(f.name).cast("string")), F.lit(0)))
    var_sum = F.sum(sum(var[1:], var[0]).cast("long")) if var else F.lit(0).cast("long")
    return fixed, [F.count(F.lit(1)).alias("n"), var_sum.alias("v")]


def measured_size(df: DataFrame) -> tuple[int, int]:
    """(rows, payload bytes) of ``df``: fixed widths + string octets + 8 per row.

    One global aggregate: each task sends one row, whatever the side's size."""
    fixed, aggs = _size_aggs(df)
    row = df.agg(*aggs).head()
    return int(row["n"]), int(row["n"]) * fixed + int(row["v"] or 0)


def broadcast_limits(spark) -> tuple[int, int]:
    return (_conf_int(spark, "histmart.broadcast.maxRows", DEFAULT_MAX_ROWS),
            _conf_int(spark, "histmart.broadcast.maxBytes", DEFAULT_MAX_BYTES))


def sized_broadcast(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None,
                    staged: bool = False) -> DataFrame:
    """Return ``broadcast(df)`` if ``df`` is proven small, else ``df``.

    The side is computed once, into the shared checkpoint folder, then
    measured and joined from there; ``staged`` says that it already is (or is
    a plain scan, cheaper to read twice than to copy)."""
    rows_cap, bytes_cap = broadcast_limits(df.sparkSession)
    side = df if staged else cut_lineage(df)
    n, size = measured_size(side)
    if n > (max_rows or rows_cap) or size > (max_bytes or bytes_cap):
        return side
    return F.broadcast(side)


def sized_broadcasts(*sides: tuple[DataFrame, bool]) -> list[DataFrame]:
    """``sized_broadcast`` of several ``(side, staged)``, measured concurrently."""
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=len(sides)) as pool:
        return list(pool.map(lambda s: sized_broadcast(s[0], staged=s[1]), sides))
