"""Fact loads: typed append of new rows, daily slice of a list.

``append_new`` parses the all-text staging rows (``parse`` gives typed columns
and a failure reason), sends rows that do not parse (bad time, bad or
overflowing amount, missing id) to a quarantine relation instead of failing
the batch, collapses exact copies (only rows of ids seen twice are compared), and
keeps only ids not yet in the fact table. Rows that share an id but differ
are all quarantined: nothing says which one is right.

The existing-id check is one exact anti join on the id. With a staged batch
the fact's id column is first pruned to the batch's id range at the scan,
where Parquet row-group statistics skip files of older ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import decimal_comma_amount, rtrim_char, text_to_ts
from ..schemas import date_lit
from ..session import cut_lineage
from ..sources.landing import MALFORMED
from . import joins

QUARANTINE_REASON = "reason"
CONFLICT = "conflicting rows for one id"


def parse_transactions(stg: DataFrame) -> DataFrame:
    """F2, F5, F6 + P1: typed columns plus the parse failure reason."""
    ts = text_to_ts("transaction_date")
    amt = decimal_comma_amount("amount")
    tid = rtrim_char(F.trim("transaction_id"))
    whole = F.col(MALFORMED).isNull() if MALFORMED in stg.columns else F.lit(True)
    reason = (F.when(~whole, F.lit("malformed line"))
              .when(tid.isNull() | (tid == ""), F.lit("missing id"))
              .when(ts.isNull(), F.lit("bad transaction_date"))
              .when(amt.isNull(), F.lit("bad amount")))
    extra = [c for c in stg.columns if c not in
             ("transaction_id", "transaction_date", "amount", "card_num", "oper_type",
              "oper_result", "terminal")]
    return stg.select(
        tid.alias("trans_id"), ts.alias("trans_date"), rtrim_char("card_num").alias("card_num"),
        F.col("oper_type"), amt.alias("amt"), F.col("oper_result"), rtrim_char("terminal").alias("terminal"),
        *extra, reason.alias(QUARANTINE_REASON))


def one_per_key(df: DataFrame, key: str, staged: bool = False) -> tuple[DataFrame, DataFrame]:
    """Q11: (one row per id whose rows are all equal, ids with differing rows).

    Ids seen twice or more come from a count of the id column alone. Only their rows are compared as a
    whole (``distinct``, whose partial aggregate collapses copies before the shuffle); all others pass by.
    With ``staged`` input these ids are counted first: if there are none, nothing else is done; if they are
    few, they are broadcast, so that no other whole row is shuffled. Rows without an id are all kept."""
    again = _seen_twice(df, key)
    if staged:
        again = cut_lineage(again)
        if again.isEmpty():
            return df, again
        again = joins.sized_broadcast(again, staged=True)
    several = df.join(again, key, "left_semi").distinct()
    differing = _seen_twice(several, key)
    once = df.join(again, key, "left_anti")
    return once.unionByName(several.join(differing, key, "left_anti")), differing


def _seen_twice(rows: DataFrame, key: str) -> DataFrame:
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("__n")).where("__n > 1").select(key)


def new_rows(batch: DataFrame, fact: DataFrame, key: str, prune: bool = False) -> DataFrame:
    """Batch rows whose id the fact does not hold (exact anti join).

    ``prune`` (for a staged batch, read cheaply twice) pushes the batch's id
    range to the fact scan; only ids inside it can match."""
    ids = fact.select(key)
    if prune:
        lo, hi = batch.agg(F.min(key), F.max(key)).head()
        if lo is None:
            return batch
        ids = ids.where(F.col(key).between(F.lit(lo), F.lit(hi)))
    return batch.join(ids, key, "left_anti")


def append_new(stg: DataFrame, fact: DataFrame | None, key: str = "trans_id", dedupe: bool = True,
               stage: Callable[[DataFrame], DataFrame] | None = None,
               parse: Callable[[DataFrame], DataFrame] = parse_transactions, staged: bool = False) -> tuple[DataFrame, DataFrame]:
    """K1 (+J2): (rows to append, quarantined rows).

    ``stage`` (e.g. ``session.cut_lineage``) materialises the parsed batch
    once, so that it is parsed once for both results; ``staged`` says that it already is."""
    staged = staged or stage is not None
    parsed = parse(stg)
    if stage is not None:
        parsed = stage(parsed)
    good = parsed.where(F.col(QUARANTINE_REASON).isNull()).drop(QUARANTINE_REASON, MALFORMED)
    bad = parsed.where(F.col(QUARANTINE_REASON).isNotNull())
    if dedupe:
        every = good
        good, conflicts = one_per_key(every, key, staged)
        rows = every.join(conflicts, key, "left_semi").withColumn(QUARANTINE_REASON, F.lit(CONFLICT))
        bad = bad.unionByName(rows, allowMissingColumns=True)
    if fact is not None:
        good = new_rows(good, fact, key, prune=staged)
    return good, bad


def append_slice(stg: DataFrame, column: str, report_dt, *, loaded: DataFrame | None = None,
                 catch_up: bool = False) -> DataFrame:
    """K2 (+P6): from a cumulative list keep the rows of the batch date.

    ``catch_up=True`` keeps every row up to the batch date that is not in
    ``loaded`` yet, so a skipped day is not lost (Q9)."""
    d = date_lit(report_dt)
    if not catch_up:
        return stg.where(F.col(column) == d)
    out = stg.where(F.col(column) <= d)
    if loaded is not None:
        out = out.join(loaded, list(stg.columns), "left_anti")
    return out.distinct()
