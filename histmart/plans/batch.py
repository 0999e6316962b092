"""The daily batch (E0): sources + landing files -> dimensions, facts, mart.

Order of work, as in the original job: change capture and key snapshots,
the four SCD2 dimensions, watermarks, the two fact loads, then the three
rules appended to the mart; the batch log row is written last. Each step
is a distributed read -> plan -> write; the driver only holds the batch
date, the watermark values and the previous batch's date.

A source dimension is read once per batch, into a staged snapshot: the delta,
the watermark and the key set all come from it, so a source that moves while
the batch runs cannot show a key in one and not in the other.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.predicates import changed_since
from ..functions.scalars import batch_text_to_date, day_of, rtrim_char
from ..operators import facts, rules, scd2, watermark
from ..operators.ids import IdTable
from ..schemas import (ACCOUNTS, ACCOUNTS_SRC, BLACKLIST_TXT, CARDS, CARDS_SRC, CLIENTS, CLIENTS_SRC, DIM_ACCOUNTS, DIM_CARDS,
                       DIM_CLIENTS, DIM_TERMINALS, FACT_BLACKLIST, META, TERMINALS,
                       TERMINALS_TXT, TRANSACTIONS_TXT, DimensionSpec, date_lit, ts_lit)
from ..sources import extract
from ..sources.landing import file_exists, read_landing, split_malformed
from ..session import Rows, cut_lineage
from . import compact, publish
from .publish import BATCH, OP_DAY, REPORT_DT, View, Warehouse

DIM_SCHEMAS = {"accounts": DIM_ACCOUNTS, "cards": DIM_CARDS, "clients": DIM_CLIENTS,
               "terminals": DIM_TERMINALS}
SOURCE_SCHEMAS = {"accounts": ACCOUNTS_SRC, "cards": CARDS_SRC, "clients": CLIENTS_SRC}
# landing file names of one batch date (DDMMYYYY)
FILE_NAMES = {"transactions": "transactions_{d}.txt", "terminals": "terminals_{d}.csv",
              "blacklist": "passport_blacklist_{d}.csv"}


MART = T.StructType([T.StructField(n, t) for n, t in zip(rules.MART_COLUMNS, (
    T.TimestampNTZType(), T.StringType(), T.StringType(), T.StringType(), T.ShortType(), T.DateType()), strict=True)])
FACT_TRANSACTIONS = T.StructType([
    *(T.StructField(n, t) for n, t in (("trans_id", T.StringType()), ("trans_date", T.TimestampNTZType()), ("card_num", T.StringType()),
                                       ("terminal", T.StringType()), (REPORT_DT, T.DateType()), (OP_DAY, T.DateType())))])


class EmptySnapshotError(ValueError):
    pass


@dataclass
class BatchConfig:
    warehouse: str
    landing: str
    sources: dict = field(default_factory=dict)   # accounts/cards/clients DataFrames
    schema_name: str = "dwh"
    tx_sep: str = ";"
    list_sep: str = ";"
    drop_dead_delta: bool = False    # Q21: leave out changed rows whose key is gone
    dedupe_transactions: bool = True  # Q11
    allow_empty_terminals: bool = False  # Q8
    catch_up: bool = False           # Q9: take a skipped day's blacklist entries too
    close_tombstone: bool = False    # Q6: close a tombstone when its key is back
    valid_through_end_of_day: bool = False  # Q15: a contract holds through its last day
    lookback: bool = False           # Q16: city changes across midnight count
    archive: str | None = None       # where handled landing files are moved
    keep_current: int | None = None  # retention of current rows, in batches that name them
    id_buckets: int | None = None    # known operation ids in a table of so many buckets (J2 for ids not ordered by time)
    buckets: int = publish.BUCKETS   # of each dimension's current rows; fixed for a warehouse


def landing_file(cfg: BatchConfig, kind: str, report_dt: date, spark: SparkSession | None = None) -> str:
    """A date's landing file; once archived (and not dropped again), the archived one."""
    name = FILE_NAMES[kind].format(d=report_dt.strftime("%d%m%Y"))
    if spark is not None and cfg.archive and not file_exists(spark, f"{cfg.landing}/{name}") \
            and file_exists(spark, f"{cfg.archive}/{name}"):
        return f"{cfg.archive}/{name}"
    return f"{cfg.landing}/{name}"


def source_snapshot(src: DataFrame, spec: DimensionSpec, schema: T.StructType, wm) -> DataFrame:
    """One row per source row: key, and the whole row where it changed after
    the watermark. Types are those declared; char padding is stripped."""
    s = extract.conform(src, schema)
    for a, b in spec.renames.items():
        s = s.withColumnRenamed(a, b)
    for c in {spec.key, *spec.char_columns}:
        s = s.withColumn(c, rtrim_char(c))
    changed = F.coalesce(changed_since(ts_lit(wm), spec.created, spec.updated), F.lit(False))
    return s.select(spec.key, F.when(changed, F.struct(*spec.attrs, spec.created, spec.updated)).alias("__row"))


def _source_delta(src: DataFrame, spec: DimensionSpec, wm, schema: T.StructType | None = None,
                  stage=lambda df: df) -> tuple[DataFrame, DataFrame]:
    """(delta in history naming, live keys) of one source dimension."""
    snap = stage(source_snapshot(src, spec, schema or SOURCE_SCHEMAS[spec.name], wm))
    delta = snap.where(F.col("__row").isNotNull()).select(spec.key, "__row.*")
    return delta, extract.key_snapshot(snap, spec.key)


def _read_meta(spark: SparkSession, wh: Warehouse, base: View, schema_name: str) -> DataFrame:
    m = publish.read_table(spark, wh, wh.meta, base)
    if m is None:
        return extract.seed_meta(spark, [ACCOUNTS.name, CARDS.name, CLIENTS.name], schema_name)
    return m.where(F.col(BATCH) == date_lit(base.batch)).select(*META.fieldNames())


def changed_buckets(wh: Warehouse, held: dict, spec: DimensionSpec, delta: DataFrame, live: DataFrame | None) -> set[int]:
    """Buckets a batch can change: those with a delta row, and those where the source's keys have another digest than
    the current rows (S5, S6: a key is gone). For a whole snapshot as delta (``live`` None) those where whole rows differ.

    Number and two hashes of a bucket's keys must agree to leave it out; a source that repeats
    keys has another digest, so its buckets are compared row by row."""
    if live is None:
        return publish.touched_buckets(publish.digests(delta, [spec.key, *spec.attrs], spec.key, wh.buckets),
                                       {k: h.rows for k, h in held.items()})
    return publish.touched_buckets(publish.digests(live, [spec.key], spec.key, wh.buckets), {k: h.keys for k, h in held.items()}) \
        | publish.buckets_with(delta, spec.key, wh.buckets)


def update_dimension(spark: SparkSession, wh: Warehouse, view: View, base: View, held: dict, spec: DimensionSpec, schema: T.StructType,
                     delta: DataFrame, live: DataFrame | None, close_tombstone: bool = False, **times) -> dict:
    """D1-D5 on the buckets a batch can change (W4, W5 copy-on-write); returns the dimension's buckets after it.

    Only these buckets' current rows, delta rows and live keys are read, joined and written."""
    touched = changed_buckets(wh, held, spec, delta, live)
    here = publish.bucket_of(spec.key, wh.buckets).isin(list(touched))
    hist = publish.read_current(spark, wh, spec.name, base, schema, held, touched)
    keys = delta.select(spec.key) if live is None else live
    versions = scd2.scd2_versions(hist, delta.where(here), keys.where(here), key=spec.key, attrs=spec.attrs,
                                  close_tombstone=close_tombstone, check_unique=True, **times)
    return publish.write_versions(spark, wh, spec.name, view, versions, spec.key, spec.attrs, held, touched, close_tombstone)


def load_dimensions(spark: SparkSession, cfg: BatchConfig, wh: Warehouse, view: View, base: View, run_ts: datetime) -> dict:
    """D1-D5 for the three source dimensions and the terminal snapshot; the
    watermarks advance only after the dimension they belong to is written.
    Returns every dimension's buckets after the batch."""
    run, report_dt = ts_lit(run_ts), view.batch
    meta = _read_meta(spark, wh, base, cfg.schema_name)
    held = publish.bucket_map(spark, wh, base)

    for spec in (ACCOUNTS, CARDS, CLIENTS):
        wm = extract.read_watermark(meta, cfg.schema_name, spec.name)
        delta, live = _source_delta(cfg.sources[spec.name], spec, wm, stage=cut_lineage)
        _quarantine_null_keys(wh, spec, delta, view)
        ef, ec = scd2.dimension_times(spec.created, spec.updated, run)
        held[spec.name] = update_dimension(spark, wh, view, base, held.get(spec.name, {}), spec, DIM_SCHEMAS[spec.name], delta, live,
                                           eff_from=ef, eff_change=ec, delete_ts=run, drop_dead_delta=cfg.drop_dead_delta,
                                           close_tombstone=cfg.close_tombstone)
        meta = watermark.update_meta(meta, delta, cfg.schema_name, spec.name)

    # terminals: the daily file is a full snapshot; every time is the batch date
    landed = cut_lineage(read_landing(spark, landing_file(cfg, "terminals", report_dt, spark), TERMINALS_TXT,
                                      sep=cfg.list_sep, with_batch_date=False))
    term, lines = split_malformed(landed)
    term = term.select(*[rtrim_char(c).alias(c) for c in TERMINALS_TXT.fieldNames()])
    _quarantine_null_keys(wh, TERMINALS, term, view, lines)
    if not cfg.allow_empty_terminals and not term.where(F.col(TERMINALS.key).isNotNull()).limit(1).collect():
        raise EmptySnapshotError("empty terminal snapshot would delete every terminal")
    day = ts_lit(datetime(report_dt.year, report_dt.month, report_dt.day))
    held[TERMINALS.name] = update_dimension(spark, wh, view, base, held.get(TERMINALS.name, {}), TERMINALS, DIM_TERMINALS, term, None,
                                            eff_from=day, eff_change=day, delete_ts=day, close_tombstone=cfg.close_tombstone)
    publish.write_leaf(meta, wh.meta, BATCH, view, small=True)
    publish.write_bucket_map(spark, wh, view, held)
    return held


def _quarantine_null_keys(wh: Warehouse, spec: DimensionSpec, rows: DataFrame, view: View,
                          lines: DataFrame | None = None) -> None:
    """Q13: rows without a key, and malformed lines, are kept aside."""
    bad = scd2.null_keys(rows, spec.key).withColumn("reason", F.lit("missing key"))
    if lines is not None:
        bad = bad.unionByName(lines.withColumn("reason", F.lit("malformed line")), allowMissingColumns=True)
    publish.write_leaf(bad, wh.quarantine(spec.name), REPORT_DT, view, small=True)


def load_blacklist(spark: SparkSession, cfg: BatchConfig, wh: Warehouse, view: View, base: View) -> None:
    """K2: the batch date's slice of the cumulative list."""
    report_dt = view.batch
    landed = cut_lineage(read_landing(spark, landing_file(cfg, "blacklist", report_dt, spark), BLACKLIST_TXT,
                                      sep=cfg.list_sep, with_batch_date=False))
    rows, lines = split_malformed(landed)
    typed = rows.select(rtrim_char("passport_num").alias("passport_num"),
                        F.coalesce(F.try_to_date("entry_dt", "yyyy-MM-dd"),
                                   batch_text_to_date("entry_dt")).alias("entry_dt"),
                        F.col("entry_dt").alias("entry_dt_text"))
    ok = F.col("entry_dt").isNotNull() & F.col("passport_num").isNotNull()
    loaded = None
    if cfg.catch_up:
        loaded = publish.read_table(spark, wh, wh.fact("passport_blacklist"), base, FACT_BLACKLIST).select(*FACT_BLACKLIST.fieldNames())
    new = facts.append_slice(typed.where(ok).drop("entry_dt_text"), "entry_dt", report_dt,
                             loaded=loaded, catch_up=cfg.catch_up)
    publish.write_leaf(new, wh.fact("passport_blacklist"), REPORT_DT, view)
    bad = typed.where(~ok).select("passport_num", "entry_dt_text", F.lit("bad entry").alias("reason"))
    publish.write_leaf(bad.unionByName(lines.withColumn("reason", F.lit("malformed line")), allowMissingColumns=True),
                       wh.quarantine("passport_blacklist"), REPORT_DT, view, small=True)


class RowCountError(ValueError):
    pass


def known_ids(spark: SparkSession, cfg: BatchConfig, wh: Warehouse, fact: DataFrame | None, base: View) -> IdTable:
    """The bucketed ids of the attempts a batch stands on; attempts from before the table was in use are stored first."""
    ids = IdTable(spark, f"{wh.fact('transactions')}_ids", buckets=cfg.id_buckets)
    if fact is not None:
        late = publish.read_leaves(spark, wh.fact("transactions"), base, sorted(set(base.attempts) - ids.loads()))
        for attempt in [r[0] for r in late.select(publish.ATTEMPT).distinct().collect()]:
            ids.add(late.where(F.col(publish.ATTEMPT) == attempt), attempt)
    return ids


def load_transactions(spark: SparkSession, cfg: BatchConfig, wh: Warehouse, view: View, base: View) -> dict:
    """K1: typed append of new operations; returns where every line went.

    Known are the operations of the finished batches this one stands on: neither its own earlier attempts, nor
    later or unfinished batches (so a re-run leaves what a first run would)."""
    path = landing_file(cfg, "transactions", view.batch, spark)
    stg = read_landing(spark, path, TRANSACTIONS_TXT, sep=cfg.tx_sep, with_batch_date=False)
    parsed_rows, unique_rows, loaded_rows, bad_rows = Rows(), Rows(), Rows(), Rows()
    parsed = cut_lineage(parsed_rows.of(facts.parse_transactions(stg)))
    fact = publish.read_table(spark, wh, wh.fact("transactions"), base)
    fresh, bad = facts.append_new(parsed, None, dedupe=cfg.dedupe_transactions, parse=lambda df: df, staged=True)
    fresh = cut_lineage(unique_rows.of(fresh))
    ids = known_ids(spark, cfg, wh, fact, base) if cfg.id_buckets else None
    if ids is not None:
        new = ids.unknown(fresh, list(base.attempts))
    else:
        new = fresh if fact is None else facts.new_rows(fresh, fact.select("trans_id"), "trans_id", prune=True)
    publish.write_leaf(new.withColumn(OP_DAY, day_of("trans_date")), wh.fact("transactions"), REPORT_DT, view,
                       partition_by=OP_DAY, sort_by="trans_date", rows=loaded_rows)
    publish.write_leaf(bad, wh.quarantine("transactions"), REPORT_DT, view, small=True, rows=bad_rows)

    if ids is not None and (own := publish.own_rows(spark, wh.fact("transactions"), REPORT_DT, view)) is not None:
        ids.add(own, view.own)

    lines = spark.read.text(path).where(F.trim("value") != "").count() - 1  # the header; counted apart from the parser
    unique, loaded, quarantined = unique_rows.n, loaded_rows.n, bad_rows.n
    counts = {"lines": lines, "loaded": loaded, "already_known": unique - loaded, "quarantined": quarantined,
              "exact_copies": parsed_rows.n - quarantined - unique}
    if lines != sum(n for k, n in counts.items() if k != "lines") or min(counts.values()) < 0:
        raise RowCountError(f"operation rows do not add up: {counts}")
    return counts


def build_reports(spark: SparkSession, wh: Warehouse, view: View, held: dict | None = None, through_day: bool = False,
                  lookback: bool = False) -> DataFrame:
    """R1-R3 for the batch date on the dimensions as of this batch: only the
    day's partitions of the fact, only the profiles of the cards in them.

    ``held``: the buckets of an attempt that is not finished yet."""
    report_dt = view.batch
    held = publish.bucket_map(spark, wh, view) if held is None else held
    cur = {n: publish.read_current(spark, wh, n, view, s, held.get(n, {})) for n, s in DIM_SCHEMAS.items()}
    bl = publish.read_table(spark, wh, wh.fact("passport_blacklist"), view, FACT_BLACKLIST)
    tx = publish.read_table(spark, wh, wh.fact("transactions"), view, FACT_TRANSACTIONS)
    first = report_dt - timedelta(days=int(lookback))
    tx = tx.where(F.col(OP_DAY).between(date_lit(first), date_lit(report_dt))) \
        .select("trans_id", "trans_date", "card_num", "terminal")
    cards = cur["cards"].join(tx.select("card_num").distinct(), "card_num", "left_semi")
    profile = rules.card_profile(cards, cur["accounts"], cur["clients"], bl.select("passport_num", "entry_dt"))
    return rules.fraud_mart(tx, profile, cur["terminals"], report_dt, through_day=through_day, lookback=lookback)


def run_batch(spark: SparkSession, cfg: BatchConfig, report_dt: date, run_ts: datetime) -> dict:
    """Run (or re-run) the batch of ``report_dt``; returns the paths written.

    All tables are written into the folders of a new attempt; the log row commits them at once."""
    wh = Warehouse(cfg.warehouse, cfg.buckets)
    base = publish.finished_view(spark, wh, before=report_dt)
    view = publish.begin(spark, wh, report_dt, base)
    held = load_dimensions(spark, cfg, wh, view, base, run_ts)
    load_blacklist(spark, cfg, wh, view, base)
    counts = load_transactions(spark, cfg, wh, view, base)
    mart = build_reports(spark, wh, view, held, cfg.valid_through_end_of_day, cfg.lookback)
    publish.write_leaf(mart, wh.mart, REPORT_DT, view, small=True)
    publish.commit(spark, wh, view, run_ts, counts)
    if cfg.keep_current is not None:
        for name in DIM_SCHEMAS:
            publish.drop_old_current(spark, wh, name, cfg.keep_current)
    return {"previous_batch": base.batch, "mart": wh.mart, "warehouse": wh.root, "counts": counts}


def compact_operations(spark: SparkSession, warehouse: str, small: int = compact.SMALL) -> str | None:
    """Pack the small day folders of all operations the newest finished batch stands on (a job of its own, run at will)."""
    wh = Warehouse(warehouse)
    return compact.compact(spark, wh.fact("transactions"), publish.finished_view(spark, wh), small)


def tables(wh: Warehouse) -> list[str]:
    """The folders of all tables but the log (for ``publish.remove_unused``)."""
    names = (*DIM_SCHEMAS, "transactions", "passport_blacklist")
    return [*map(wh.dim, DIM_SCHEMAS), *map(wh.fact, names[-2:]), *map(wh.quarantine, names), wh.mart, wh.meta, wh.bucket_table]


def read_mart(spark: SparkSession, warehouse: str, report_dt: date | None = None) -> DataFrame:
    """The mart of all finished batches, or of one; a batch that is not finished has no rows."""
    wh = Warehouse(warehouse)
    m = publish.read_table(spark, wh, wh.mart, publish.finished_view(spark, wh, report_dt), MART)
    if report_dt is not None:
        m = m.where(F.col(REPORT_DT) == date_lit(report_dt))
    return m.select("event_dt", "passport", "fio", "phone",
                    F.col("event_type").cast(T.ShortType()).alias("event_type"), REPORT_DT)


def run_backfill(spark: SparkSession, cfg: BatchConfig, start: date,
                 run_ts_for=None) -> list:
    """Re-run every batch date found in the landing folder from ``start`` on,
    oldest first: each batch builds on the one before, so a back-filled date
    is followed by all later ones. Returns the dates run."""
    from ..sources.landing import batch_dates
    if run_ts_for is None:
        from ..streaming.landing import default_run_ts as run_ts_for
    days = [d for d in batch_dates(spark, cfg.landing, prefix="transactions") if d >= start]
    for d in days:
        run_batch(spark, cfg, d, run_ts_for(d))
    return days
