"""Daily landing files: delimited text read with an all-text schema.

Every column is read as a string (no type inference: ids keep their leading
zeros, empty cells become nulls) and typed afterwards, so that a malformed
value goes to quarantine instead of failing the whole batch. Columns are bound
to the header: a file whose header differs from the schema fails. A line with
too few or too many fields keeps its text in ``MALFORMED``, which the loads
send to quarantine. The batch date comes from the file name (``<name>_DDMMYYYY.<ext>``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import batch_date_from_path

FILE_COL = "__file"
MALFORMED = "__malformed"


def read_landing(spark: SparkSession, path: str, schema: T.StructType, sep: str = ";",
                 header: bool = True, with_batch_date: bool = True) -> DataFrame:
    """S7-S9 (+S10): read landing files (a file, folder or glob) as text
    columns in ``schema`` order plus ``MALFORMED`` (the line, if its number of
    fields is wrong), adding ``report_dt`` from each file name."""
    held = T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])
    df = (spark.read.schema(held).option("sep", sep).option("header", header)
          .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", MALFORMED)
          .option("nullValue", "").option("emptyValue", None)
          .option("enforceSchema", not header).csv(path))
    if with_batch_date:
        df = df.withColumn(FILE_COL, F.col("_metadata.file_name")) \
            .withColumn("report_dt", batch_date_from_path(FILE_COL)).drop(FILE_COL)
    return df


def split_malformed(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(well-formed rows, malformed lines as ``line``). ``df`` should be staged:
    Spark reads the line text only together with the other columns."""
    return (df.where(F.col(MALFORMED).isNull()).drop(MALFORMED),
            df.where(F.col(MALFORMED).isNotNull()).select(F.col(MALFORMED).alias("line")))


def batch_dates(spark: SparkSession, path: str, prefix: str = "terminals") -> list:
    """All batch dates present in a landing folder, oldest first.

    Only file names are listed (``binaryFile`` with the content column
    pruned), never file contents.
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", f"{prefix}_*")
             .load(path).select(F.col("path")))
    days = files.select(batch_date_from_path("path").alias("d")).where(F.col("d").isNotNull()) \
        .distinct().orderBy("d")
    return [r["d"] for r in days.collect()]


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def file_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def move_file(spark: SparkSession, source: str, folder: str) -> None:
    """Move one file into ``folder``, replacing an older one of its name."""
    p, fs = _fs(spark, source)
    to, _ = _fs(spark, folder)
    fs.mkdirs(to)
    target, _ = _fs(spark, f"{folder}/{p.getName()}")
    if fs.exists(target):
        fs.delete(target, False)
    if not fs.rename(p, target):
        raise OSError(f"cannot move {source} to {folder}")
