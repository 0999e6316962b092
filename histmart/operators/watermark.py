"""High-water mark bookkeeping.

The new mark is ``coalesce(max(update_dt), max(create_dt), old)`` computed
over the extracted delta in one aggregate (partial per task, one row in the
end). The meta relation is rebuilt by an equi-join on its key, so no scalar
value has to travel through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ts_lit


def delta_marks(delta: DataFrame, created: str = "create_dt", updated: str = "update_dt") -> DataFrame:
    """A1: one row with max(update) and max(create) of the delta, which must
    hold timestamps without zone (``extract.conform``): a zoned mark would be
    read back in the driver's own zone."""
    for c in (created, updated):
        if not isinstance(delta.schema[c].dataType, T.TimestampNTZType):
            raise TypeError(f"{c} is {delta.schema[c].dataType.simpleString()}; watermarks need timestamp_ntz")
    return delta.agg(F.max(updated).alias("max_update"), F.max(created).alias("max_create"))


def advance_watermark(delta: DataFrame, old, created: str = "create_dt",
                      updated: str = "update_dt") -> DataFrame:
    """A2: one row ``max_update_dt`` = the new mark (old when the delta is
    empty)."""
    oldc = old if hasattr(old, "_jc") else ts_lit(old)
    m = delta_marks(delta, created, updated)
    return m.select(F.coalesce("max_update", "max_create", oldc).alias("max_update_dt"))


def update_meta(meta: DataFrame, delta: DataFrame, schema_name: str, table_name: str,
                created: str = "create_dt", updated: str = "update_dt") -> DataFrame:
    """The meta relation with one table's mark advanced."""
    keys = ["schema_name", "table_name"]
    marks = delta_marks(delta, created, updated).select(
        F.lit(schema_name).alias("schema_name"), F.lit(table_name).alias("table_name"),
        "max_update", "max_create")
    m = meta.join(marks, keys, "left")
    return m.select(*keys, F.coalesce("max_update", "max_create", "max_update_dt")
                    .alias("max_update_dt"))
