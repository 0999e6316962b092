"""Compaction of appended leaves (W3): small day folders of many loads become few sorted files.

Every load appends its operations by the day they happened, so a late operation
costs a file of its own, and a day ends up in as many files as loads brought rows for it.
``compact`` rewrites a day's small folders together; large ones stay where they are.

A *unit* is one day folder of one attempt (``attempt/op_day``) or of an earlier compaction.
What a compaction wrote lies beside the table in ``<table>_compact/compact=c/op_day=d``, each row
with the attempt and the load it came from; its log row in ``<table>_compact_log``,
written last, names the units it stands for and all attempts whose rows it holds.

Readers (``read_compacted``) take a compaction if it is in the log, all its attempts belong to their
view and none of its units is taken by an earlier one; they leave those units out. So a
reader gets every row once, before, during and after a compaction, in any view: one of
another chain (before a re-run, say), a crashed one, and the later of two that ran at the same time count for nothing.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .publish import ATTEMPT, OP_DAY, View, Warehouse, _exists, _folders, _fs, finished_batches, finished_view

COMPACT = "compact"
#: Units below so many bytes are packed together.
SMALL = 64 << 20


@dataclass(frozen=True)
class Compaction:
    name: str
    attempts: frozenset
    units: frozenset


def _folder(path: str) -> str:
    return f"{path}_compact"


def _log(path: str) -> str:
    return f"{path}_compact_log"


def compactions(spark: SparkSession, path: str, view: View) -> list[Compaction]:
    """The compactions of a table that hold in a view, oldest first."""
    if not _exists(spark, _log(path)):
        return []
    rows = spark.read.parquet(_log(path)).collect()  # a row per compaction
    taken, out = set(), []
    for r in sorted(rows, key=lambda r: r.name):
        own = Compaction(r.name, frozenset(r.attempts), frozenset(r.units))
        earlier = {c.name for c in out}
        stands = all(u.partition("/")[0] in earlier | set(view.attempts) for u in own.units)
        if stands and own.attempts <= set(view.attempts) and not own.units & taken:
            out.append(own)
            taken |= own.units
    return out


def _unit(folder: str) -> Column:
    return F.concat_ws("/", F.col(folder), F.col(OP_DAY).cast("string"))


def read_compacted(spark: SparkSession, path: str, view: View, attempts: list[str] | None = None) -> DataFrame:
    """A table's rows in a view (or those of some of its attempts), with the attempt, from units and compactions.

    Units are left out by partition filters: their files are not opened."""
    wanted = list(view.attempts if attempts is None else attempts)
    found = compactions(spark, path, view)
    leaves = spark.read.parquet(path).where(F.col(ATTEMPT).isin(wanted)) if not found or _exists(spark, path) else None
    if not found:
        return leaves
    gone = [u for c in found for u in c.units]
    packed = spark.read.parquet(_folder(path)).where(F.col(COMPACT).isin([c.name for c in found]) & ~_unit(COMPACT).isin(gone)) \
        .where(F.col(ATTEMPT).isin(wanted)).drop(COMPACT)
    return packed if leaves is None else leaves.where(~_unit(ATTEMPT).isin(gone)).unionByName(packed)


def holds(spark: SparkSession, path: str) -> bool:
    """Whether a table has any rows' files: its own or packed ones (after ``drop_packed`` perhaps these alone)."""
    return _exists(spark, path) or _exists(spark, _folder(path))


def _sizes(spark: SparkSession, path: str, column: str) -> DataFrame:
    """(unit's folder, day, bytes, files) of a table, from a listing of its files; none is opened. Rows without a day stay where they are."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(path)
    part = rf"/{column}=([^/]+)/{OP_DAY}=([^/]+)/"
    return files.select(F.regexp_extract("path", part, 1).alias("held"), F.regexp_extract("path", part, 2).alias("day"), "length") \
        .where("day rlike '^[0-9]'").groupBy("held", "day").agg(F.sum("length").alias("bytes"), F.count("*").alias("files"))


def small_units(spark: SparkSession, path: str, view: View, small: int = SMALL) -> list[str]:
    """Units of a view below ``small`` bytes, of days with two or more such files (a name per folder, as a file listing)."""
    found = compactions(spark, path, view)
    gone = {u for c in found for u in c.units}
    units = _sizes(spark, path, ATTEMPT).where(F.col("held").isin(list(view.attempts)))
    if found:
        units = units.unionByName(_sizes(spark, _folder(path), COMPACT).where(F.col("held").isin([c.name for c in found])))
    of_day: dict[str, list] = {}
    for r in units.where(F.col("bytes") < small).orderBy("held").collect():
        if f"{r.held}/{r.day}" not in gone:
            of_day.setdefault(r.day, []).append(r)
    return [f"{r.held}/{r.day}" for rs in of_day.values() if sum(r.files for r in rs) > 1 for r in rs]


def compact(spark: SparkSession, path: str, view: View, small: int = SMALL, sort_by: str = "trans_date") -> str | None:
    """Pack the small units of a view; returns the compaction's name (None: nothing to pack).

    The rows go through a rebalance by day, so AQE joins small days to one task and splits a hot one, and are sorted
    within files by ``sort_by``. Nothing is deleted: views of other chains, and readers that began before, go on."""
    units = small_units(spark, path, view, small)
    if not units:
        return None
    found = compactions(spark, path, view)
    of_attempts = [u for u in units if u.partition("/")[0] in view.attempts]
    rows = spark.read.parquet(path).where(_unit(ATTEMPT).isin(of_attempts)) if of_attempts else None
    held = {u.partition("/")[0] for u in of_attempts}
    of_earlier = [u for u in units if u not in set(of_attempts)]
    if of_earlier:
        named = {u.partition("/")[0] for u in of_earlier}
        held |= {a for c in found if c.name in named for a in c.attempts}
        earlier = spark.read.parquet(_folder(path)).where(_unit(COMPACT).isin(of_earlier)).drop(COMPACT)
        rows = earlier if rows is None else rows.unionByName(earlier)
    last = max((int(re.match(r"c(\d+)", r[0]).group(1)) for r in spark.read.parquet(_log(path)).select("name").collect()),
               default=0) if _exists(spark, _log(path)) else 0
    name = f"c{last + 1:07d}-{uuid.uuid4().hex[:8]}"
    rows.hint("rebalance", OP_DAY).sortWithinPartitions(OP_DAY, sort_by).write.mode("errorifexists") \
        .partitionBy(OP_DAY).parquet(f"{_folder(path)}/{COMPACT}={name}")
    commit(spark, path, Compaction(name, frozenset(held), frozenset(units)))
    return name


def commit(spark: SparkSession, path: str, made: Compaction) -> None:
    """The log row, written last: from now on readers take the compaction."""
    row = spark.createDataFrame([(made.name, sorted(made.attempts), sorted(made.units))],
                                "name string, attempts array<string>, units array<string>")
    row.coalesce(1).write.mode("append").parquet(_log(path))


def drop_packed(spark: SparkSession, wh: Warehouse, path: str, keep: int) -> list[str]:
    """Retention: remove units that compactions stand for in each of the newest ``keep`` finished batches. Earlier
    batches can then no longer be read or re-run. Returns the folders."""
    views = [finished_view(spark, wh, b) for b in finished_batches(spark, wh)[-keep:]]
    states = [(set(v.attempts), compactions(spark, path, v)) for v in views]
    gone = [{u for c in found for u in c.units} for _, found in states]
    held = [attempts | {c.name for c in found} for attempts, found in states]
    drop = {u for u in set().union(*gone)
            if all(u in out or u.partition("/")[0] not in names for out, names in zip(gone, held, strict=True))}
    of = {f.getPath().getName().partition("=")[2]: f.getPath().toString()
          for day in _folders(spark, path) for f in _folders(spark, day.getPath().toString())}
    of |= {f.getPath().getName().partition("=")[2]: f.getPath().toString() for f in _folders(spark, _folder(path))}
    removed = []
    for folder, day in sorted(u.split("/") for u in drop):
        if folder in of:
            p, fs = _fs(spark, f"{of[folder]}/{OP_DAY}={day}")
            if fs.exists(p):
                fs.delete(p, True)
                removed.append(p.toString())
    return removed
