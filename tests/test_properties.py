"""Properties: the watermark never moves back; broadcasts respect their bound."""

from datetime import datetime, timedelta

from hypothesis import given, settings
from hypothesis import strategies as st

from histmart.operators import joins, watermark
from histmart.sources import extract

SCHEMA = "k string, create_dt timestamp_ntz, update_dt timestamp_ntz"
BASE = datetime(2021, 1, 1)
minutes = st.integers(0, 60 * 24 * 30)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(minutes, st.one_of(st.none(), minutes)), max_size=12), minutes)
def test_watermark_never_decreases(spark, rows, wm_min):
    wm = BASE + timedelta(minutes=wm_min)
    src = spark.createDataFrame(
        [(str(i), BASE + timedelta(minutes=c), None if u is None else BASE + timedelta(minutes=u))
         for i, (c, u) in enumerate(rows)], SCHEMA)
    new = watermark.advance_watermark(extract.delta_scan(src, wm), wm).head()[0]
    assert new >= wm


def _is_broadcast(df):
    return "ResolvedHint (strategy=broadcast)" in df._jdf.queryExecution().analyzed().toString() \
        or "broadcast" in df._jdf.queryExecution().logical().toString().lower()


def test_sized_broadcast_respects_bounds(spark):
    small = spark.range(100).selectExpr("id", "repeat('x', 10) AS s")
    assert _is_broadcast(joins.sized_broadcast(small, max_rows=1000, max_bytes=10_000))
    assert not _is_broadcast(joins.sized_broadcast(small, max_rows=50, max_bytes=10_000))
    assert not _is_broadcast(joins.sized_broadcast(small, max_rows=1000, max_bytes=1_000))
    n, size = joins.measured_size(small)
    assert n == 100 and size == 100 * (8 + 8) + 100 * 10
