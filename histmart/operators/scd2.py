"""Slowly changing dimension, type 2: inserts, changes and logical deletes.

History rows carry ``effective_from``, ``effective_to`` and ``deleted_flg``.
A row is *current* when it is open (``effective_to = 9999-12-31``) and live
(``'N'``); every other row is *settled* and never changes again.

The batch semantics are those of five ordered statements per dimension:

* D1 insert a delta row whose key has no current version
  (from = its creation/update time, open, 'N');
* D2 close the current version of a changed key (to = change time - 1 day);
* D3 insert the changed row as the new current version (from = change time);
* D4 for each current version whose key is no longer in the source key
  snapshot insert a tombstone (same attributes, from = delete time, open, 'Y');
* D5 close those versions (to = delete time - 1 day).

``scd2_apply`` produces the same history in one pass: one shuffle of the
current rows, the delta and the live keys on the key, a full outer join,
and a per-row ``inline`` of up to three output versions. Settled rows are
never shuffled; they are passed through by a union.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import attrs_differ, is_current, not_current
from ..functions.scalars import col, minus_gap
from ..schemas import CLOSE_GAP, DELETED, EFF_FROM, EFF_TO, FLAG_DELETED, FLAG_LIVE, open_end

_O, _D = "o", "d"


class DuplicateKeyError(ValueError):
    pass


def current_view(hist: DataFrame) -> DataFrame:
    """The open live versions."""
    return hist.where(is_current())


def settled_rows(hist: DataFrame) -> DataFrame:
    return hist.where(not_current())


def new_keys(delta: DataFrame, hist: DataFrame, key: str) -> DataFrame:
    """Delta rows whose key has no current version (the current-view
    filter is applied to the history *before* the anti join)."""
    return delta.join(current_view(hist).select(key), key, "left_anti")


def changed_rows(delta: DataFrame, hist: DataFrame, key: str, attrs) -> DataFrame:
    """Delta rows joined to their current version where any tracked
    attribute differs (null-safe). Columns of both sides stay reachable as
    ``o.<col>`` (current version) and ``d.<col>`` (delta)."""
    cur = current_view(hist).alias(_O)
    d = delta.alias(_D)
    return d.join(cur, F.col(f"{_D}.{key}") == F.col(f"{_O}.{key}")).where(
        attrs_differ(_D, _O, attrs))


def deleted_keys(hist: DataFrame, live_keys: DataFrame, key: str) -> DataFrame:
    """Current versions whose key is absent from the live key set."""
    return current_view(hist).join(live_keys.select(key).where(F.col(key).isNotNull()),
                                   key, "left_anti")


def require_unique_keys(delta: DataFrame, key: str) -> None:
    """Q12: a delta with two rows for one key would create two current
    versions; fail before writing anything."""
    dup = delta.groupBy(key).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"delta holds several rows for {key}={dup[0][key]!r}")


def _version(attrs, key_col, frm: Column, to: Column, flag: str | Column, keep: Column) -> Column:
    flag = F.lit(flag) if isinstance(flag, str) else flag
    fields = [key_col.alias("k")] + [c.alias(f"a{i}") for i, c in enumerate(attrs)]
    fields += [frm.alias(EFF_FROM), to.alias(EFF_TO), flag.alias(DELETED), keep.alias("keep")]
    return F.struct(*fields)


def scd2_apply(hist: DataFrame, delta: DataFrame, live_keys: DataFrame | None, *,
               key: str, attrs, eff_from: Column, eff_change: Column, delete_ts: Column,
               close_gap: str = CLOSE_GAP, drop_dead_delta: bool = False,
               close_tombstone: bool = False, check_unique: bool = False) -> DataFrame:
    """The new history: settled rows passed through + ``scd2_versions``."""
    rest, out = _scd2(hist, delta, live_keys, key=key, attrs=attrs, eff_from=eff_from,
                      eff_change=eff_change, delete_ts=delete_ts, close_gap=close_gap,
                      drop_dead_delta=drop_dead_delta, close_tombstone=close_tombstone,
                      check_unique=check_unique)
    return rest.unionByName(out)


def scd2_versions(hist: DataFrame, delta: DataFrame, live_keys: DataFrame | None, *,
                  key: str, attrs, eff_from: Column, eff_change: Column, delete_ts: Column,
                  close_gap: str = CLOSE_GAP, drop_dead_delta: bool = False,
                  close_tombstone: bool = False, check_unique: bool = False) -> DataFrame:
    """Only the rows a batch writes: every current row after the batch and
    the rows the batch settled (closed versions, tombstones). Settled rows
    of earlier batches are not read beyond the current-view filter; with
    ``close_tombstone`` the open tombstones in ``hist`` are carried on, closed
    when their key is back."""
    rest, out = _scd2(hist, delta, live_keys, key=key, attrs=attrs, eff_from=eff_from,
                      eff_change=eff_change, delete_ts=delete_ts, close_gap=close_gap,
                      drop_dead_delta=drop_dead_delta, close_tombstone=close_tombstone,
                      check_unique=check_unique)
    return rest.where(F.col(DELETED) == FLAG_DELETED).unionByName(out) if close_tombstone else out


def null_keys(delta: DataFrame, key: str) -> DataFrame:
    """Delta rows that no version can be kept for (Q13: quarantine)."""
    return delta.where(F.col(key).isNull())


def _scd2(hist: DataFrame, delta: DataFrame, live_keys: DataFrame | None, *,
          key: str, attrs, eff_from: Column, eff_change: Column, delete_ts: Column,
          close_gap: str, drop_dead_delta: bool, close_tombstone: bool,
          check_unique: bool) -> tuple[DataFrame, DataFrame]:
    """(settled rows passed through, rows emitted by this batch).

    hist       history (key, attrs, effective_from, effective_to, deleted_flg)
    delta      changed source rows, already renamed to history column names
    live_keys  every key present in the source now (None: no deletions)
    eff_from   Column on ``delta``: start of a version for a new key
    eff_change Column on ``delta``: start of a version for a changed key
    delete_ts  literal Column: one deletion time for the whole batch
    drop_dead_delta  drop delta rows whose key is not live (Q21)
    close_tombstone  close an open tombstone when its key returns (Q6)
    """
    attrs = list(attrs)
    delta = delta.where(F.col(key).isNotNull())
    if check_unique:
        require_unique_keys(delta, key)

    d = delta.select(key, *attrs, eff_from.alias("__from"), eff_change.alias("__change"))
    cur = current_view(hist).select(key, *attrs, EFF_FROM)
    rest = settled_rows(hist).select(key, *attrs, *(EFF_FROM, EFF_TO, DELETED))

    if live_keys is not None:
        live = live_keys.select(key).where(F.col(key).isNotNull()).distinct() \
            .withColumn("__live", F.lit(True))
        # left joins keep the left side's hash partitioning on the key, so the
        # full outer join below needs no further exchange
        cur = cur.join(live, key, "left")
        d = d.join(live, key, "left")
        if drop_dead_delta:
            d = d.where(F.col("__live"))
    else:
        cur = cur.withColumn("__live", F.lit(True))
        d = d.withColumn("__live", F.lit(True))

    x = cur.alias(_O).join(d.alias(_D), F.col(f"{_O}.{key}") == F.col(f"{_D}.{key}"), "full_outer")
    o, dd = (lambda c: F.col(f"{_O}.{c}")), (lambda c: F.col(f"{_D}.{c}"))
    o_here = o(key).isNotNull()
    d_here = dd(key).isNotNull()
    is_new = d_here & ~o_here
    changed = o_here & d_here & attrs_differ(_D, _O, attrs)
    take_delta = is_new | changed
    live_now = F.coalesce(o("__live"), dd("__live"), F.lit(False))
    key_col = F.coalesce(o(key), dd(key))
    cur_attrs = [F.when(take_delta, dd(a)).otherwise(o(a)) for a in attrs]
    cur_from = F.when(is_new, dd("__from")).when(changed, dd("__change")).otherwise(o(EFF_FROM))
    cur_to = F.when(live_now, open_end()).otherwise(minus_gap(delete_ts, close_gap))

    versions = F.array(
        # The changed current version is closed the day before the change
        _version([o(a) for a in attrs], key_col, o(EFF_FROM),
                 minus_gap(dd("__change"), close_gap), FLAG_LIVE, changed),
        # unchanged / D1 / D3 version, closed by D5 when the key is gone
        _version(cur_attrs, key_col, cur_from, cur_to, FLAG_LIVE, F.lit(True)),
        # The tombstone
        _version(cur_attrs, key_col, delete_ts, open_end(), FLAG_DELETED, ~live_now),
    )
    out = (x.select(F.inline(F.filter(versions, lambda v: v["keep"])))
           .select(F.col("k").alias(key),
                   *[F.col(f"a{i}").alias(a) for i, a in enumerate(attrs)],
                   EFF_FROM, EFF_TO, DELETED))
    if close_tombstone:
        rest = _close_returned_tombstones(rest, delta.select(key, eff_from.alias("__back")),
                                          key, close_gap)
    return rest, out


def _close_returned_tombstones(rest: DataFrame, returning: DataFrame, key: str,
                               close_gap: str) -> DataFrame:
    """Q6 option: an open tombstone whose key comes back is closed the gap
    before the returning version starts. Only open tombstones are joined;
    closed versions pass through without a shuffle."""
    open_tomb = (F.col(EFF_TO) == open_end()) & (F.col(DELETED) == F.lit(FLAG_DELETED))
    closed = rest.where(~F.coalesce(open_tomb, F.lit(False)))
    tomb = rest.where(open_tomb).join(returning, key, "left")
    tomb = tomb.withColumn(EFF_TO, F.when(F.col("__back").isNotNull(),
                                          minus_gap(F.col("__back"), close_gap))
                           .otherwise(F.col(EFF_TO)))
    return closed.unionByName(tomb.select(*rest.columns))


# ---- the five statements one by one (building blocks and tests) ----

def step_insert_new(hist, delta, *, key, attrs, eff_from: Column) -> DataFrame:
    """D1 rows."""
    return new_keys(delta.where(F.col(key).isNotNull()), hist, key).select(
        key, *attrs, eff_from.alias(EFF_FROM), open_end().alias(EFF_TO),
        F.lit(FLAG_LIVE).alias(DELETED))


def step_close_changed(hist, delta, *, key, attrs, eff_change: Column,
                       close_gap: str = CLOSE_GAP) -> DataFrame:
    """D2 rows: the current versions as they look after being closed."""
    j = changed_rows(delta.withColumn("__change", eff_change), hist, key, attrs)
    return j.select(F.col(f"{_O}.{key}").alias(key), *[F.col(f"{_O}.{a}").alias(a) for a in attrs],
                    F.col(f"{_O}.{EFF_FROM}").alias(EFF_FROM),
                    minus_gap(F.col(f"{_D}.__change"), close_gap).alias(EFF_TO),
                    F.lit(FLAG_LIVE).alias(DELETED))


def step_new_version(hist, delta, *, key, attrs, eff_change: Column) -> DataFrame:
    """D3 rows."""
    j = changed_rows(delta.withColumn("__change", eff_change), hist, key, attrs)
    return j.select(F.col(f"{_D}.{key}").alias(key), *[F.col(f"{_D}.{a}").alias(a) for a in attrs],
                    F.col(f"{_D}.__change").alias(EFF_FROM), open_end().alias(EFF_TO),
                    F.lit(FLAG_LIVE).alias(DELETED))


def _current_after_changes(hist, delta, *, key, attrs, eff_from, eff_change) -> DataFrame:
    """Current versions once D1-D3 have run (the input of D4/D5)."""
    cur = current_view(hist).select(key, *attrs, EFF_FROM)
    changed = changed_rows(delta.withColumn("__change", eff_change), hist, key, attrs) \
        .select(F.col(f"{_D}.{key}").alias(key))
    kept = cur.join(changed, key, "left_anti")
    d1 = step_insert_new(hist, delta, key=key, attrs=attrs, eff_from=eff_from).select(key, *attrs, EFF_FROM)
    d3 = step_new_version(hist, delta, key=key, attrs=attrs, eff_change=eff_change).select(key, *attrs, EFF_FROM)
    return kept.unionByName(d1).unionByName(d3)


def step_tombstone(hist, delta, live_keys, *, key, attrs, eff_from, eff_change,
                   delete_ts: Column) -> DataFrame:
    """D4 rows."""
    cur = _current_after_changes(hist, delta, key=key, attrs=attrs,
                                 eff_from=eff_from, eff_change=eff_change)
    gone = cur.join(live_keys.select(key).where(F.col(key).isNotNull()), key, "left_anti")
    return gone.select(key, *attrs, delete_ts.alias(EFF_FROM), open_end().alias(EFF_TO),
                       F.lit(FLAG_DELETED).alias(DELETED))


def step_close_deleted(hist, delta, live_keys, *, key, attrs, eff_from, eff_change,
                       delete_ts: Column, close_gap: str = CLOSE_GAP) -> DataFrame:
    """D5 rows: the versions of vanished keys after being closed."""
    cur = _current_after_changes(hist, delta, key=key, attrs=attrs,
                                 eff_from=eff_from, eff_change=eff_change)
    gone = cur.join(live_keys.select(key).where(F.col(key).isNotNull()), key, "left_anti")
    return gone.select(key, *attrs, EFF_FROM, minus_gap(delete_ts, close_gap).alias(EFF_TO),
                       F.lit(FLAG_LIVE).alias(DELETED))


def dimension_times(spec_created: str | None, spec_updated: str | None, batch_ts: Column):
    """(eff_from, eff_change) for a dimension: ``coalesce(update, create)``
    and the update time (falling back to creation, then the batch time, so
    a change without an update time still gets a version, Q4); snapshot
    dimensions use the batch time for both."""
    if spec_created is None:
        return batch_ts, batch_ts
    return (F.coalesce(col(spec_updated), col(spec_created)),
            F.coalesce(col(spec_updated), col(spec_created), batch_ts))
