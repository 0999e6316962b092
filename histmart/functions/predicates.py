"""Boolean building blocks of the warehouse SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import DELETED, EFF_TO, FLAG_LIVE, open_end
from .scalars import col, day_of


def is_current(eff_to=EFF_TO, flag=DELETED) -> Column:
    """The open live version: ``effective_to = OPEN_END and flag = 'N'``."""
    return (col(eff_to) == open_end()) & (col(flag) == F.lit(FLAG_LIVE))


def not_current(eff_to=EFF_TO, flag=DELETED) -> Column:
    """Complement of P3 that keeps rows with null end/flag (never current)."""
    return ~F.coalesce(is_current(eff_to, flag), F.lit(False))


def attrs_differ(left: str, right: str, attrs) -> Column:
    """Null-safe difference OR-ed over all tracked attributes.

    ``a <> b or (a is null and b is not null) or (a is not null and b is
    null)`` is exactly ``not (a <=> b)``; the fold starts from false.
    """
    return reduce(lambda acc, a: acc | ~F.col(f"{left}.{a}").eqNullSafe(F.col(f"{right}.{a}")),
                  attrs, F.lit(False))


def changed_since(watermark: Column, created="create_dt", updated="update_dt") -> Column:
    """S1 predicate: rows created (never updated) or updated after ``wm``.

    Kept on raw columns so the comparison reaches the source as pushed
    filters (Parquet row-group stats / JDBC WHERE).
    """
    return (col(updated).isNull() & (col(created) > watermark)) | (col(updated) > watermark)


def on_day(ts_col, day: Column) -> Column:
    """P5: ``ts::date = day``; Catalyst turns it into a pushed timestamp range."""
    return day_of(ts_col) == day


def expired_before(valid_to, day: Column) -> Column:
    """Strictly before the report day; null is never expired."""
    return col(valid_to) < day
