"""Change capture from a source system: watermark delta, key snapshot.

Sources are DataFrames: a Parquet extract, a table, or a JDBC relation
(``jdbc_table``). The predicates stay on raw columns, so Spark pushes them to
the source: Parquet row-group statistics or the JDBC ``WHERE`` clause.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.predicates import changed_since
from ..functions.scalars import col, rtrim_char
from ..schemas import META, WATERMARK_SEED_TEXT, ts_lit


def jdbc_table(spark: SparkSession, url: str, table: str, *, partition_column: str | None = None,
               lower: int | None = None, upper: int | None = None, num_partitions: int = 64,
               fetchsize: int = 10_000, **options) -> DataFrame:
    """A source table read in ``num_partitions`` parallel range slices
    (instead of one cursor through one process). Credentials come from the
    caller's options, never from this code."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table) \
        .option("fetchsize", fetchsize).option("preferTimestampNTZ", True)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load()


class SourceTypeError(ValueError):
    pass


def conform(src: DataFrame, schema: T.StructType) -> DataFrame:
    """``src`` with exactly the declared columns and types.

    A zoned timestamp becomes its UTC wall time, whatever the session's zone;
    a missing column or a type that cannot hold the declared one raises."""
    out = []
    for f in schema.fields:
        if f.name not in src.columns:
            raise SourceTypeError(f"the source has no column {f.name}")
        have, c = src.schema[f.name].dataType, F.col(f.name)
        if have == f.dataType:
            pass
        elif isinstance(f.dataType, T.TimestampNTZType) and isinstance(have, T.TimestampType):
            c = F.to_utc_timestamp(c, F.current_timezone()).cast(f.dataType)
        elif isinstance(f.dataType, T.StringType) and isinstance(have, (T.IntegralType, T.VarcharType, T.CharType)) \
                or isinstance(f.dataType, T.TimestampNTZType) and isinstance(have, T.DateType) \
                or isinstance(f.dataType, T.DateType) and isinstance(have, T.TimestampNTZType):
            c = c.cast(f.dataType)
        elif isinstance(f.dataType, T.DateType) and isinstance(have, T.TimestampType):
            c = F.to_utc_timestamp(c, F.current_timezone()).cast(T.TimestampNTZType()).cast(f.dataType)
        else:
            raise SourceTypeError(f"column {f.name} is {have.simpleString()}, declared {f.dataType.simpleString()}")
        out.append(c.alias(f.name))
    return src.select(*out)


def delta_scan(src: DataFrame, watermark, created: str = "create_dt",
               updated: str = "update_dt") -> DataFrame:
    """Rows changed after the watermark.

    ``(updated is null and created > wm) or updated > wm`` (strict).
    ``watermark`` is a datetime/str literal or a Column.
    """
    wm = watermark if hasattr(watermark, "_jc") else ts_lit(watermark)
    return src.where(changed_since(wm, created, updated))


def key_snapshot(src: DataFrame, key: str, source_key: str | None = None,
                 trim: bool = False) -> DataFrame:
    """Every (non-null) key present in the source now. Only the key
    column is read; ``distinct`` runs a map-side partial aggregate first."""
    k = col(source_key or key)
    if trim:
        k = rtrim_char(k)
    return src.select(k.alias(key)).where(F.col(key).isNotNull()).distinct()


def seed_meta(spark: SparkSession, tables, schema_name: str = "dwh") -> DataFrame:
    """One watermark row per source table at the seed instant."""
    seed = datetime.strptime(WATERMARK_SEED_TEXT, "%Y-%m-%d %H:%M:%S")
    return spark.createDataFrame([(schema_name, t, seed) for t in tables], META)


def read_watermark(meta: DataFrame, schema_name: str, table_name: str) -> datetime:
    """The single watermark value of one table (one row to the
    driver, like the source's fetchone)."""
    row = (meta.where((F.col("schema_name") == schema_name) & (F.col("table_name") == table_name))
           .select("max_update_dt").head(1))
    if not row or row[0][0] is None:
        raise KeyError(f"no watermark for {schema_name}.{table_name}")
    return row[0][0]
