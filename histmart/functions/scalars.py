"""Scalar column functions (all JVM-side built-ins, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CLOSE_GAP

# text layouts of the landing files and of the watermark (fixed values)
TS_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"
BATCH_DATE_FORMAT = "ddMMyyyy"
BATCH_NAME_PATTERN = r"_(\d{8})\.[^/]*$"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_to_text(c) -> Column:
    """timestamp -> 'yyyy-MM-dd HH:mm:ss' text."""
    return F.date_format(col(c), TS_TEXT_FORMAT)


TS_TEXT_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"


def text_to_ts(c, strict: bool = False) -> Column:
    """'yyyy-MM-dd HH:mm:ss' text -> TIMESTAMP_NTZ.

    ``strict=False`` returns null on bad text (quarantine path) instead of
    raising under ANSI mode. The value is built from the text's calendar
    fields, so no session-zone conversion is involved.
    """
    if strict:
        return F.to_timestamp_ntz(col(c), F.lit(TS_TEXT_FORMAT))
    t = F.trim(col(c))
    # one regex validates the fixed layout; the fields are then taken by position
    part = [F.substring(t, pos, n).cast("int") for pos, n in
            ((1, 4), (6, 2), (9, 2), (12, 2), (15, 2), (18, 2))]
    return F.when(t.rlike(TS_TEXT_PATTERN), F.try_make_timestamp_ntz(*part))


def batch_text_to_date(c) -> Column:
    """'DDMMYYYY' text -> DATE (null when malformed)."""
    return F.try_to_date(col(c), BATCH_DATE_FORMAT)


def batch_date_from_path(path_col) -> Column:
    """The DDMMYYYY date embedded in a landing file name."""
    return batch_text_to_date(F.regexp_extract(col(path_col), BATCH_NAME_PATTERN, 1))


def null_skipping_concat(*cols, sep: str = " ") -> Column:
    """``concat(a,' ',b,' ',c)`` that treats null parts as empty text.

    Spark's ``concat`` is null-propagating and ``concat_ws`` drops the
    separator of a null part; the warehouse keeps every separator.
    """
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(F.coalesce(col(c).cast("string"), F.lit("")))
    return F.concat(*parts)


def minus_gap(c, gap: str = CLOSE_GAP) -> Column:
    """timestamp minus the version gap (default one day)."""
    return col(c) - F.expr(gap)


def day_of(c) -> Column:
    """``ts::date``."""
    return F.to_date(col(c))


def hour_component(later, earlier) -> Column:
    """``extract(hour from later - earlier)``: the hour *field* of the
    day-time interval (1 day 00:30 gives 0)."""
    return F.extract(F.lit("HOUR"), col(later) - col(earlier))


def trunc_to_second(c) -> Column:
    """Drop sub-second digits of a TIMESTAMP_NTZ without a zone round trip."""
    c = col(c)
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c),
                                F.hour(c), F.minute(c), F.second(c))


def decimal_comma_amount(c, precision: int = 8, scale: int = 2) -> Column:
    """'1234,50' -> DECIMAL(8,2), half-up; null when not a number or
    when it overflows (the quarantine path)."""
    txt = F.regexp_replace(F.trim(col(c)), ",", ".")
    return F.try_cast(txt, T.DecimalType(precision, scale)) if hasattr(F, "try_cast") \
        else txt.try_cast(T.DecimalType(precision, scale))


def rtrim_char(c) -> Column:
    """char(n) padding is not significant: strip it at ingestion."""
    return F.rtrim(col(c))
