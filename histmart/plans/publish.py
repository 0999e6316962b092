"""Warehouse layout and all-or-nothing publishing.

Plain Parquet has no UPDATE/MERGE, so nothing is changed in place. Every run of
a batch is an *attempt* with folders of its own, and the batch log says which
attempts count:

* ``dim/<name>/batch_dt=b/attempt=a/state=current/bucket=k``: current rows whose
  key hashes to bucket k, for the buckets the attempt changed;
  ``.../state=settled/bucket=-1``: the rows it settled;
* ``fact/transactions/report_dt=b/attempt=a/op_day=d``: operations loaded by b, by the
  day they happened, so a report opens only its day's partitions of any load;
* ``fact/passport_blacklist``, ``mart/rep_fraud``, ``quarantine/<name>``:
  ``report_dt=b/attempt=a``;
* ``meta/watermark``: the high-water marks after b;
* ``meta/buckets``: for every dimension and bucket the attempt that holds its current
  rows, with digests of their keys and of whole rows;
* ``meta/batches/batch_dt=b/attempt=a``: the log row, written last. It names the attempt the run
  was built on, so a finished batch is a chain of attempts (a :class:`View`).

Readers take the tables through a view: the leaves of its attempts and no others.
An attempt without a log row (crashed or still running) is seen by nobody, and
a re-run of a batch leaves the old state in sight until its own log row exists:
one small file commits all tables. A batch after the re-run one keeps standing
on the attempts it was built on until it is run again itself.

Buckets are copy-on-write: an attempt writes the current rows of the buckets it
changed; the others are named where they are (``meta/buckets``), not copied.
"""

from __future__ import annotations

import re
import time
import uuid
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.predicates import is_current
from ..schemas import EFF_TO, open_end
from ..session import Rows

STATE, BATCH, REPORT_DT, OP_DAY, ATTEMPT, BUCKET = "state", "batch_dt", "report_dt", "op_day", "attempt", "bucket"
CURRENT, SETTLED = "current", "settled"
#: Buckets of a dimension's current rows; fixed for a warehouse.
BUCKETS = 16
NO_BUCKET = -1


@dataclass(frozen=True)
class Warehouse:
    root: str
    buckets: int = BUCKETS

    def dim(self, name: str) -> str:
        return f"{self.root}/dim/{name}"

    def fact(self, name: str) -> str:
        return f"{self.root}/fact/{name}"

    def quarantine(self, name: str) -> str:
        return f"{self.root}/quarantine/{name}"

    @property
    def mart(self) -> str:
        return f"{self.root}/mart/rep_fraud"

    @property
    def meta(self) -> str:
        return f"{self.root}/meta/watermark"

    @property
    def bucket_table(self) -> str:
        return f"{self.root}/meta/buckets"

    @property
    def log(self) -> str:
        return f"{self.root}/meta/batches"


@dataclass(frozen=True)
class View:
    """One state of all tables: a batch and the attempts it stands on, oldest first, its own last."""
    batch: date | None = None
    attempts: tuple[str, ...] = ()

    @property
    def own(self) -> str | None:
        return self.attempts[-1] if self.attempts else None


_ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a Parquet table. Only "no such path" and "no
    data files" mean absent; any other failure (storage, permissions) is
    raised, so a batch never mistakes an unreadable log for a first run."""
    try:
        spark.read.format("parquet").load(path).schema  # noqa: B018 - resolves the path
        return True
    except AnalysisException as e:
        cls = e.getCondition() if hasattr(e, "getCondition") else e.getErrorClass()
        if cls in _ABSENT:
            return False
        raise


# ---- the log ----

def commits(spark: SparkSession, wh: Warehouse) -> list[tuple[date, str, str | None]]:
    """(batch, attempt, attempt it was built on) of every finished attempt; one small row each."""
    if not _exists(spark, wh.log):
        return []
    return [tuple(r) for r in spark.read.parquet(wh.log).select(F.col(BATCH).cast("date"), ATTEMPT, "base").collect()]


def finished_view(spark: SparkSession, wh: Warehouse, batch=None, before=None) -> View:
    """The finished ``batch`` (default: the newest), or the newest one strictly before a date; empty if there is none."""
    log = commits(spark, wh)
    latest = {b: a for b, a, _ in sorted(log, key=lambda r: r[1])}  # of a batch the newest attempt counts
    days = [b for b in latest if (batch is None or b == _day(batch)) and (before is None or b < _day(before))]
    if not days:
        return View()
    built_on, chain, at = {a: base for _, a, base in log}, [], latest[max(days)]
    while at is not None:
        chain.append(at)
        at = built_on[at]
    return View(max(days), tuple(reversed(chain)))


def finished_batches(spark: SparkSession, wh: Warehouse) -> list[date]:
    return sorted({b for b, _, _ in commits(spark, wh)})


def previous_batch(spark: SparkSession, wh: Warehouse, report_dt):
    """The newest finished batch strictly before ``report_dt`` (or None)."""
    return finished_view(spark, wh, before=report_dt).batch


def begin(spark: SparkSession, wh: Warehouse, batch, base: View | None = None) -> View:
    """A new attempt of a batch on the newest finished batch before it. Nobody sees it until ``commit``."""
    base = finished_view(spark, wh, before=batch) if base is None else base
    last = max((int(re.match(r"a(\d+)", a).group(1)) for _, a, _ in commits(spark, wh)), default=0)
    return View(_day(batch), (*base.attempts, f"a{last + 1:07d}-{uuid.uuid4().hex[:8]}"))


def commit(spark: SparkSession, wh: Warehouse, view: View, run_ts, counts: dict | None = None) -> None:
    """Write the attempt's log row, with the counts of its operation rows: from now on the batch is finished."""
    base = view.attempts[-2] if len(view.attempts) > 1 else None
    row = spark.createDataFrame([(view.batch, run_ts, counts or {}, base)],
                                f"{REPORT_DT} date, run_ts timestamp_ntz, counts map<string,long>, base string")
    write_leaf(row.coalesce(1), wh.log, BATCH, view)


def _day(x) -> date:
    return date.fromisoformat(x) if isinstance(x, str) else x


def _view(spark: SparkSession, wh: Warehouse, at) -> View:
    return at if isinstance(at, View) else View() if at is None else finished_view(spark, wh, at)


# ---- leaves ----

def write_leaf(df: DataFrame, path: str, column: str, view: View, partition_by: str | list | None = None,
               sort_by: str | None = None, small: bool = False, rows: Rows | None = None) -> None:
    """Write an attempt's rows of a table, even none, into its own folder ``path/column=batch/attempt=a``.

    ``small`` outputs (mart, quarantine, logs) go through a rebalance so AQE
    sizes the files; ``sort_by`` orders rows within files so that row-group
    statistics prune. ``rows`` counts what is written."""
    partition_by = [partition_by] if isinstance(partition_by, str) else partition_by or []
    out = df.drop(column)
    if small:
        out = out.hint("rebalance")
    if sort_by:
        out = out.sortWithinPartitions(*partition_by, sort_by)
    if rows is not None:
        out = rows.of(out)
    w = out.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(f"{path}/{column}={view.batch}/{ATTEMPT}={view.own}")


def read_table(spark: SparkSession, wh: Warehouse, path: str, at=..., schema: T.StructType | None = None) -> DataFrame | None:
    """The rows of a table in a view (a View or a finished batch; default: the newest finished batch)."""
    from .compact import holds
    view = finished_view(spark, wh) if at is ... else _view(spark, wh, at)
    if not view.attempts or not holds(spark, path):
        return spark.createDataFrame([], schema) if schema is not None else None
    return read_leaves(spark, path, view).drop(ATTEMPT)


def read_leaves(spark: SparkSession, path: str, view: View, attempts: list[str] | None = None) -> DataFrame:
    """What a view's attempts (or some of them) wrote into a table (a filter on its partitions), with the attempt;
    packed rows come from the compactions that hold in the view."""
    from .compact import read_compacted
    return read_compacted(spark, path, view, attempts)


def own_rows(spark: SparkSession, path: str, column: str, view: View) -> DataFrame | None:
    """What an attempt wrote into a table so far."""
    leaf = f"{path}/{column}={view.batch}/{ATTEMPT}={view.own}"
    return spark.read.parquet(leaf) if _exists(spark, leaf) else None


# ---- dimensions ----

def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _hashes(columns: list[str], live: Column | None = None) -> list[Column]:
    """Order-free digest of rows: two hashes of ``columns`` summed up (a null counts as such in its place)."""
    parts = [x for c in columns for x in (F.col(c), F.col(c).isNull())]
    x, s = F.xxhash64(*parts), F.hash(*parts).cast("long")
    return [F.bit_xor(x if live is None else F.when(live, x)), F.sum(s if live is None else F.when(live, s))]


def digests(rows: DataFrame, columns: list[str], key: str, buckets: int) -> dict[int, tuple]:
    """Per bucket the number of rows and their digest (one small row per bucket; nothing else is shuffled)."""
    got = (rows.where(F.col(key).isNotNull()).groupBy(bucket_of(key, buckets).alias(BUCKET))
           .agg(F.count("*"), *_hashes(columns)).collect())
    return {r[0]: tuple(r[1:]) for r in got}


def buckets_with(rows: DataFrame, key: str, buckets: int) -> set[int]:
    return {r[0] for r in rows.where(F.col(key).isNotNull()).select(bucket_of(key, buckets)).distinct().collect()}


@dataclass(frozen=True)
class Held:
    """Where a bucket's current rows are, and their digests: of the keys, and of key and attributes."""
    attempt: str
    keys: tuple
    rows: tuple


_BUCKET_SCHEMA = "buckets int, name string, bucket int, held string, n long, key_x long, key_s long, row_x long, row_s long"


def bucket_map(spark: SparkSession, wh: Warehouse, at) -> dict[str, dict[int, Held]]:
    """Of every dimension and bucket with current rows in a view: :class:`Held` (at most a row per bucket)."""
    view = _view(spark, wh, at)
    if not view.attempts or not _exists(spark, wh.bucket_table):
        return {}
    out: dict[str, dict[int, Held]] = {}
    for r in spark.read.parquet(wh.bucket_table).where(F.col(ATTEMPT) == view.own).collect():
        if r.buckets != wh.buckets:
            raise ValueError(f"the warehouse has {r.buckets} buckets, not {wh.buckets}")
        out.setdefault(r.name, {})[r.bucket] = Held(r.held, (r.n, r.key_x, r.key_s), (r.n, r.row_x, r.row_s))
    return out


def write_bucket_map(spark: SparkSession, wh: Warehouse, view: View, held: dict[str, dict[int, Held]]) -> None:
    rows = [(wh.buckets, name, k, h.attempt, *h.keys, *h.rows[1:]) for name, of in held.items() for k, h in of.items()]
    write_leaf(spark.createDataFrame(rows, _BUCKET_SCHEMA).coalesce(1), wh.bucket_table, BATCH, view)


def _leaves(held: dict[int, Held], buckets=None) -> Column:
    """Predicate on partition columns alone: the current leaves that hold these buckets."""
    named = [f"{h.attempt}/{k}" for k, h in held.items() if buckets is None or k in buckets]
    return (F.col(STATE) == CURRENT) & F.concat_ws("/", ATTEMPT, F.col(BUCKET).cast("string")).isin(named)


def touched_buckets(now: dict[int, tuple], before: dict[int, tuple]) -> set[int]:
    """Buckets whose digests differ."""
    return {k for k in now.keys() | before.keys() if now.get(k) != before.get(k)}


def read_current(spark: SparkSession, wh: Warehouse, name: str, at, schema: T.StructType,
                 held: dict[int, Held] | None = None, buckets: set[int] | None = None) -> DataFrame:
    """Current versions of a dimension in a view, or only those of some buckets."""
    held = bucket_map(spark, wh, at).get(name, {}) if held is None else held
    if not held or not _exists(spark, wh.dim(name)):
        return spark.createDataFrame([], schema)
    return spark.read.parquet(wh.dim(name)).where(_leaves(held, buckets)).select(*schema.fieldNames())


def read_history(spark: SparkSession, wh: Warehouse, name: str, at, schema: T.StructType) -> DataFrame:
    """Full history in a view: its current rows, and what its attempts settled."""
    view = _view(spark, wh, at)
    if not view.attempts or not _exists(spark, wh.dim(name)):
        return spark.createDataFrame([], schema)
    settled = (F.col(STATE) == SETTLED) & F.col(ATTEMPT).isin(list(view.attempts))
    df = spark.read.parquet(wh.dim(name)).where(_leaves(bucket_map(spark, wh, view).get(name, {})) | settled)
    return df.select(*schema.fieldNames())


def write_versions(spark: SparkSession, wh: Warehouse, name: str, view: View, versions: DataFrame, key: str, attrs,
                   held: dict[int, Held] | None = None, touched: set[int] | None = None,
                   carry_tombstones: bool = False) -> dict[int, Held]:
    """One write: the current rows of the ``touched`` buckets and the newly settled rows of an attempt; returns the
    dimension's buckets from now on (``held``: those before). Without ``touched`` all buckets are written.

    With ``carry_tombstones`` open tombstones stay with the current rows, so that a later batch can close them."""
    out = dict(held or {})
    if touched is not None and not touched:
        return out
    stays = F.coalesce(F.col(EFF_TO) == open_end() if carry_tombstones else is_current(), F.lit(False))
    rows = versions.withColumn(STATE, F.when(stays, F.lit(CURRENT)).otherwise(F.lit(SETTLED))).withColumn(
        BUCKET, F.when(stays, F.coalesce(bucket_of(key, wh.buckets), F.lit(0))).otherwise(F.lit(NO_BUCKET)))
    write_leaf(rows.hint("rebalance", BUCKET), wh.dim(name), BATCH, view, partition_by=[STATE, BUCKET])
    for k in touched if touched is not None else list(out):
        out.pop(k, None)
    mine = own_rows(spark, wh.dim(name), BATCH, view)
    if mine is None:
        return out
    mine = mine.where(F.col(STATE) == CURRENT)
    live = is_current()  # tombstones carried along have no part in the digests
    got = mine.groupBy(BUCKET).agg(F.count(F.when(live, True)), *_hashes([key], live), *_hashes([key, *attrs], live)).collect()
    return out | {r[0]: Held(view.own, (r[1], r[2], r[3]), (r[1], r[4], r[5])) for r in got}


# ---- retention ----

def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _folders(spark: SparkSession, path: str) -> list:
    p, fs = _fs(spark, path)
    return [s for s in fs.listStatus(p) if s.isDirectory()] if fs.exists(p) else []


def drop_old_current(spark: SparkSession, wh: Warehouse, name: str, keep: int) -> list[str]:
    """Retention: remove the current rows of a dimension that none of the newest ``keep`` finished batches names
    (settled rows stay, as history needs them). Earlier batches can then no longer be re-run. Returns the folders."""
    days = finished_batches(spark, wh)[-keep:]
    named = {f"{h.attempt}/{k}" for d in days for k, h in bucket_map(spark, wh, d).get(name, {}).items()}
    done = {a for _, a, _ in commits(spark, wh)}
    gone = []
    for day in _folders(spark, wh.dim(name)):
        for attempt in _folders(spark, day.getPath().toString()):
            own = attempt.getPath().getName().partition("=")[2]
            for leaf in _folders(spark, f"{attempt.getPath()}/{STATE}={CURRENT}") if own in done else ():
                if f"{own}/{leaf.getPath().getName().partition('=')[2]}" not in named:
                    p, fs = _fs(spark, leaf.getPath().toString())
                    fs.delete(p, True)
                    gone.append(p.toString())
    return gone


def remove_unused(spark: SparkSession, wh: Warehouse, tables: list[str], older_than: timedelta = timedelta(days=7)) -> list[str]:
    """Remove the folders of attempts no finished batch stands on (crashed, or replaced by a re-run of all that was
    built on them), if they are ``older_than`` (a running attempt, and readers that opened an old state, need theirs)."""
    log = commits(spark, wh)
    views = [finished_view(spark, wh, b) for b in {b for b, _, _ in log}]
    used = reduce(set.union, (set(v.attempts) for v in views), set())
    for v in views:
        used |= {h.attempt for of in bucket_map(spark, wh, v).values() for h in of.values()}
    gone, limit = [], (time.time() - older_than.total_seconds()) * 1000
    for table in tables:
        for day in _folders(spark, table):
            for attempt in _folders(spark, day.getPath().toString()):
                if attempt.getPath().getName().partition("=")[2] not in used and attempt.getModificationTime() <= limit:
                    p, fs = _fs(spark, attempt.getPath().toString())
                    fs.delete(p, True)
                    gone.append(p.toString())
    return gone
