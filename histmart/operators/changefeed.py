"""Change feed of files that hold everything every day.

Two days' files are compared by key and two hashes of each row: one grouped
aggregation of (key, hashes, day), in hash aggregates of fixed width, gives
the keys that were added, changed or are gone. Only their rows are then
looked up, so an unchanged row costs its key and hashes and nothing after.
A list without attributes (a row is its own key) has added and gone rows only.

Null keys take no part (callers quarantine them); exact copies within a file
count once; a key that a file holds with different rows is reported as
changed whenever its set of rows is not the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHANGE = "change"
ADDED, CHANGED, GONE = "added", "changed", "gone"


def _marked(rows: DataFrame, key: list[str], attrs: list[str], day: int) -> DataFrame:
    parts = [x for c in attrs for x in (F.col(c), F.col(c).isNull())]  # a null counts as such in its place
    known = rows.dropna(subset=key).select(*key, *attrs).distinct() if attrs else rows.dropna(subset=key).select(*key)
    return known.select(*key, F.lit(day).alias("__day"), *((F.xxhash64(*parts).alias("__x"), F.hash(*parts).cast("long").alias("__s"))
                                                           if attrs else (F.lit(0).cast("long").alias("__x"), F.lit(0).cast("long").alias("__s"))))


def changed_keys(old: DataFrame, new: DataFrame, key: str | list[str], attrs) -> DataFrame:
    """``key`` and ``change`` of every key that is not the same in both files."""
    key, attrs = [key] if isinstance(key, str) else list(key), list(attrs)
    both = _marked(old, key, attrs, 0).unionByName(_marked(new, key, attrs, 1))

    def of(day):
        here = F.col("__day") == day
        return [F.count(F.when(here, 1)).alias(f"n{day}"),
                *(F.sum(F.when(here, F.shiftright(F.col(c), k) if k else F.col(c).bitwiseAND(0xFFFFFFFF))).alias(f"{c}{k}{day}")
                  for c in ("__x", "__s") for k in (0, 32))]

    g = both.groupBy(*key).agg(*of(0), *of(1))
    sums = [f"{c}{k}" for c in ("__x", "__s") for k in (0, 32)]
    differs = F.lit(False)
    if attrs:
        differs = F.col("n0") != F.col("n1")
        for s in sums:
            differs = differs | (F.col(f"{s}0") != F.col(f"{s}1"))
    change = F.when(F.col("n0") == 0, ADDED).when(F.col("n1") == 0, GONE).when(differs, CHANGED)
    return g.select(*key, change.alias(CHANGE)).where(F.col(CHANGE).isNotNull())


def snapshot_changes(old: DataFrame, new: DataFrame, key: str | list[str], attrs=()) -> DataFrame:
    """``key, attrs, change``: rows added or changed as they are in ``new``, and rows gone as they were in ``old``."""
    key, attrs = [key] if isinstance(key, str) else list(key), list(attrs)
    changes = changed_keys(old, new, key, attrs)
    if not attrs:
        return changes
    rows = lambda df, gone: (df.select(*key, *attrs).distinct()
                             .join(changes.where((F.col(CHANGE) == GONE) == F.lit(gone)), key))
    return rows(new, False).unionByName(rows(old, True)).select(*key, *attrs, CHANGE)
