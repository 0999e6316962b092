"""Landing-folder pick-up as a Structured Streaming query.

The stream lists the landing folder with the ``binaryFile`` source and only
ever selects the ``path`` column, so file contents are not read by the
stream itself. A micro-batch turns the new file names into batch dates (one
small row per file); the streaming checkpoint remembers which files were seen,
so a restart resumes instead of reloading.

* A date runs once its set of files is complete; an incomplete date waits, and
  its files stay where they are until the rest has arrived.
* Each batch builds on the one before, so a date older than finished ones is
  run first and every later finished date after it.
* Files are moved to the archive only after the batch of their date is logged.
  A file dropped again (its date is finished) makes its date run again; the
  other files of the date come from the archive. The file source does not
  report a path twice, so such files are found by listing, at every start and
  with every later micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.scalars import batch_date_from_path
from ..plans import publish
from ..plans.batch import FILE_NAMES, BatchConfig, landing_file, run_batch
from ..sources.landing import file_exists, move_file

BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])
LANDING_GLOB = "*_[0-9][0-9][0-9][0-9][0-9][0-9][0-9][0-9].*"


def default_run_ts(d: date) -> datetime:
    """The batch of day d runs the next morning at 03:27."""
    return datetime(d.year, d.month, d.day) + timedelta(days=1, hours=3, minutes=27)


def landing_files(spark: SparkSession, landing: str) -> DataFrame:
    return (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
            .option("pathGlobFilter", LANDING_GLOB).load(landing).select("path"))


def batch_dates_of(files: DataFrame) -> set:
    """Distinct batch dates of a relation of file names (one per date)."""
    d = files.select(batch_date_from_path("path").alias("d")).where(F.col("d").isNotNull())
    return {r["d"] for r in d.distinct().collect()}


def dates_present(spark: SparkSession, folder: str) -> set:
    """Batch dates with any file in a folder (none if it does not exist)."""
    if not file_exists(spark, folder):
        return set()
    return batch_dates_of(spark.read.format("binaryFile").option("pathGlobFilter", LANDING_GLOB).load(folder).select("path"))


def finished_dates(spark: SparkSession, warehouse: str) -> set:
    return set(publish.finished_batches(spark, publish.Warehouse(warehouse)))


def run_ready(spark: SparkSession, cfg: BatchConfig, seen: set,
              run_ts_for: Callable[[date], datetime] = default_run_ts) -> list:
    """Run every date that is complete and has something new, then all later
    finished dates; returns the dates run. ``seen``: dates of files just seen."""
    done = finished_dates(spark, cfg.warehouse)
    landed = dates_present(spark, cfg.landing)
    new = {d for d in landed if cfg.archive or d in seen or d not in done}
    ready = {d for d in new if all(file_exists(spark, landing_file(cfg, kind, d, spark)) for kind in FILE_NAMES)}
    if not ready:
        return []
    days = sorted(ready | {d for d in done if d > min(ready)})
    for d in days:
        run_batch(spark, cfg, d, run_ts_for(d))
        for kind in FILE_NAMES if cfg.archive else ():
            path = landing_file(cfg, kind, d, spark)
            if path.startswith(f"{cfg.landing}/") and file_exists(spark, path):
                move_file(spark, path, cfg.archive)
    return days


def landing_stream(spark: SparkSession, cfg: BatchConfig, checkpoint: str,
                   archive_dir: str | None = None,
                   run_ts_for: Callable[[date], datetime] = default_run_ts,
                   available_now: bool = True, interval: str = "1 hour") -> StreamingQuery:
    """Start the pick-up query; with ``available_now`` it handles every file
    present and stops."""
    cfg = replace(cfg, archive=archive_dir or cfg.archive)
    run_ready(spark, cfg, set(), run_ts_for)

    def on_batch(files: DataFrame, epoch_id: int) -> None:
        run_ready(files.sparkSession, cfg, batch_dates_of(files), run_ts_for)

    w = landing_files(spark, cfg.landing).writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()
