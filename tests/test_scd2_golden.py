"""SCD2 golden cases (hand-computed), replay and two-formulation checks."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from histmart.operators import scd2
from histmart.schemas import DIM_ACCOUNTS, ts_lit

OPEN = datetime(9999, 12, 31)
START = datetime(2020, 1, 1)
RUN = datetime(2021, 3, 3, 3, 27)
KEY, ATTRS = "account_num", ["valid_to", "client"]
D25, D26 = date(2025, 1, 1), date(2026, 1, 1)


def t(h, m=0, day=2):
    return datetime(2021, 3, day, h, m)


HIST = [
    ("A1", D25, "C", START, OPEN, "N"),
    ("A2", D25, "C", START, OPEN, "N"),
    ("A3", None, "C", START, OPEN, "N"),
    ("A4", D25, "C", START, OPEN, "N"),
    ("A5", D25, "C", START, OPEN, "N"),
    ("A6", D25, "C", START, OPEN, "N"),
    ("A7", D25, "C", START, datetime(2020, 6, 1), "N"),
    ("A7", D25, "C", datetime(2020, 6, 2), OPEN, "Y"),
    ("A10", None, "C", START, OPEN, "N"),
    ("A11", D25, "C", START, OPEN, "N"),
]
DELTA = [  # account_num, valid_to, client, create_dt, update_dt
    ("A2", D26, "C", START, t(10)),
    ("A3", D25, "C", START, t(11)),
    ("A4", None, "C", START, t(12)),
    ("A6", D25, "C", START, t(13)),
    ("A7", D25, "C", t(14), None),
    ("A8", D25, "C", t(15), None),
    ("A9", D25, "C", t(15), t(16)),
    ("A10", None, "C", START, t(16, 30)),
    ("A11", D26, "C", START, t(17)),
]
LIVE = ["A1", "A2", "A3", "A4", "A6", "A7", "A8", "A9", "A10"]

EXPECTED = {
    ("A1", D25, "C", START, OPEN, "N"),
    ("A2", D25, "C", START, t(10, day=1), "N"),
    ("A2", D26, "C", t(10), OPEN, "N"),
    ("A3", None, "C", START, t(11, day=1), "N"),
    ("A3", D25, "C", t(11), OPEN, "N"),
    ("A4", D25, "C", START, t(12, day=1), "N"),
    ("A4", None, "C", t(12), OPEN, "N"),
    ("A5", D25, "C", START, datetime(2021, 3, 2, 3, 27), "N"),
    ("A5", D25, "C", RUN, OPEN, "Y"),
    ("A6", D25, "C", START, OPEN, "N"),
    ("A7", D25, "C", START, datetime(2020, 6, 1), "N"),
    ("A7", D25, "C", datetime(2020, 6, 2), OPEN, "Y"),
    ("A7", D25, "C", t(14), OPEN, "N"),
    ("A8", D25, "C", t(15), OPEN, "N"),
    ("A9", D25, "C", t(16), OPEN, "N"),
    ("A10", None, "C", START, OPEN, "N"),
    ("A11", D25, "C", START, t(17, day=1), "N"),
    ("A11", D26, "C", t(17), datetime(2021, 3, 2, 3, 27), "N"),
    ("A11", D26, "C", RUN, OPEN, "Y"),
}

DELTA_SCHEMA = "account_num string, valid_to date, client string, create_dt timestamp_ntz, update_dt timestamp_ntz"


@pytest.fixture
def inputs(spark):
    hist = spark.createDataFrame(HIST, DIM_ACCOUNTS)
    delta = spark.createDataFrame(DELTA, DELTA_SCHEMA)
    live = spark.createDataFrame([(k,) for k in LIVE], "account_num string")
    return hist, delta, live


def _apply(hist, delta, live, **kw):
    run = ts_lit(RUN)
    ef, ec = scd2.dimension_times("create_dt", "update_dt", run)
    return scd2.scd2_apply(hist, delta, live, key=KEY, attrs=ATTRS, eff_from=ef,
                           eff_change=ec, delete_ts=run, **kw)


def rows(df):
    return {tuple(r) for r in df.select(KEY, *ATTRS, "effective_from", "effective_to",
                                        "deleted_flg").collect()}


def test_golden_accounts(inputs):
    hist, delta, live = inputs
    out = _apply(hist, delta, live)
    got = rows(out)
    assert got == EXPECTED
    assert out.count() == len(EXPECTED)  # no duplicates


def test_replay_is_noop_except_dead_delta(inputs):
    hist, delta, live = inputs
    once = _apply(hist, delta, live)
    d = delta.where(F.col(KEY) != "A11")
    twice = _apply(once, d, live)
    assert rows(twice) == rows(once)
    assert twice.count() == once.count()


def test_drop_dead_delta(inputs):
    hist, delta, live = inputs
    got = rows(_apply(hist, delta, live, drop_dead_delta=True))
    a11 = {r for r in got if r[0] == "A11"}
    assert a11 == {("A11", D25, "C", START, datetime(2021, 3, 2, 3, 27), "N"),
                   ("A11", D25, "C", RUN, OPEN, "Y")}


def test_one_open_live_version_per_key(inputs):
    hist, delta, live = inputs
    out = _apply(hist, delta, live)
    cur = scd2.current_view(out).groupBy(KEY).count()
    assert cur.where("count > 1").count() == 0


def test_unchanged_batch_changes_nothing(inputs, spark):
    hist, _, _ = inputs
    empty = spark.createDataFrame([], DELTA_SCHEMA)
    live = hist.select(KEY).distinct()
    assert rows(_apply(hist, empty, live)) == rows(hist)


def test_one_pass_equals_five_steps(inputs):
    hist, delta, live = inputs
    run = ts_lit(RUN)
    ef, ec = scd2.dimension_times("create_dt", "update_dt", run)
    kw = dict(key=KEY, attrs=ATTRS)
    d2 = scd2.step_close_changed(hist, delta, eff_change=ec, **kw)
    d4 = scd2.step_tombstone(hist, delta, live, eff_from=ef, eff_change=ec, delete_ts=run, **kw)
    d5 = scd2.step_close_deleted(hist, delta, live, eff_from=ef, eff_change=ec, delete_ts=run, **kw)
    after = scd2._current_after_changes(hist, delta, eff_from=ef, eff_change=ec, **kw)
    kept = after.join(live, KEY, "left_semi").select(
        KEY, *ATTRS, "effective_from", ts_lit(OPEN).alias("effective_to"),
        F.lit("N").alias("deleted_flg"))
    steps = scd2.settled_rows(hist).unionByName(d2).unionByName(kept).unionByName(d4).unionByName(d5)
    assert rows(steps) == EXPECTED


def test_terminals_use_report_date(spark):
    """Snapshot dimension: every time is the report date's midnight."""
    from histmart.schemas import DIM_TERMINALS
    rd = datetime(2021, 3, 3)
    hist = spark.createDataFrame([
        ("T1", "POS", "X", "a", START, OPEN, "N"),
        ("T2", "POS", "X", "a", START, OPEN, "N"),
        ("T5", "POS", "X", "a", START, OPEN, "N")], DIM_TERMINALS)
    snap = spark.createDataFrame([("T1", "POS", "X", "a"), ("T2", "ATM", "Y", "b"),
                                  ("T8", "POS", "Z", "c")],
                                 "terminal_id string, terminal_type string, terminal_city string, terminal_address string")
    r = ts_lit(rd)
    out = scd2.scd2_apply(hist, snap, snap.select("terminal_id"), key="terminal_id",
                          attrs=["terminal_type", "terminal_city", "terminal_address"],
                          eff_from=r, eff_change=r, delete_ts=r)
    got = {tuple(x) for x in out.collect()}
    assert got == {
        ("T1", "POS", "X", "a", START, OPEN, "N"),
        ("T2", "POS", "X", "a", START, datetime(2021, 3, 2), "N"),
        ("T2", "ATM", "Y", "b", rd, OPEN, "N"),
        ("T5", "POS", "X", "a", START, datetime(2021, 3, 2), "N"),
        ("T5", "POS", "X", "a", rd, OPEN, "Y"),
        ("T8", "POS", "Z", "c", rd, OPEN, "N"),
    }


def test_duplicate_delta_keys_fail_fast(inputs, spark):
    hist, delta, live = inputs
    dup = delta.unionByName(delta.where(F.col(KEY) == "A2"))
    with pytest.raises(scd2.DuplicateKeyError):
        _apply(hist, dup, live, check_unique=True)


def test_close_tombstone_option(inputs):
    hist, delta, live = inputs
    got = rows(_apply(hist, delta, live, close_tombstone=True))
    a7 = sorted(r for r in got if r[0] == "A7")
    assert ("A7", D25, "C", datetime(2020, 6, 2), t(14, day=1), "Y") in a7
    assert all(not (r[4] == OPEN and r[5] == "Y") for r in a7)
