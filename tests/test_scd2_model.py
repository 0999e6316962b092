"""One-pass SCD2 vs a literal model of the five statements, random histories.

The model applies D1..D5 in order to a Python list with the semantics of
``INSERT ... SELECT`` (select evaluated before inserting) and ``UPDATE``.
Scenarios are independent per key, so hundreds of them run in one Spark job
(keys are prefixed with the scenario number).
"""

import random
from datetime import datetime, timedelta

from histmart.operators import scd2
from histmart.schemas import ts_lit

OPEN = datetime(9999, 12, 31)
RUN = datetime(2021, 3, 3, 3, 27)
DAY = timedelta(days=1)
VALUES = [None, "a", "b"]
SCHEMA_H = "k string, x string, y string, effective_from timestamp_ntz, effective_to timestamp_ntz, deleted_flg string"
SCHEMA_D = "k string, x string, y string, create_dt timestamp_ntz, update_dt timestamp_ntz"


def _key(r):
    return tuple((v is not None, v) for v in r)


def _diff(s, t):
    return any(a != b for a, b in zip(s[1:3], t[1:3]))


def model(hist, stg, live):
    h = [list(r) for r in hist]

    def change(s):
        return s[4] if s[4] is not None else (s[3] if s[3] is not None else RUN)
    # D1
    ins = [[s[0], s[1], s[2], s[4] if s[4] is not None else s[3], OPEN, "N"] for s in stg
           if not any(t[0] == s[0] and t[4] == OPEN and t[5] == "N" for t in h)]
    h += ins
    # D2
    tmp = [(s[0], change(s)) for s in stg for t in h
           if t[0] == s[0] and t[4] == OPEN and t[5] == "N" and _diff(s, t)]
    for key, ch in tmp:
        for t in h:
            if t[0] == key and t[4] == OPEN and t[5] == "N":
                t[4] = ch - DAY
    # D3
    ins = [[s[0], s[1], s[2], change(s), OPEN, "N"] for s in stg for t in h
           if t[0] == s[0] and t[4] == change(s) - DAY and t[5] == "N" and _diff(s, t)]
    h += ins
    # D4
    gone = {t[0] for t in h if t[4] == OPEN and t[5] == "N" and t[0] not in live}
    h += [[t[0], t[1], t[2], RUN, OPEN, "Y"] for t in h
          if t[0] in gone and t[4] == OPEN and t[5] == "N"]
    # D5
    gone = {t[0] for t in h if t[4] == OPEN and t[5] == "N" and t[0] not in live}
    for t in h:
        if t[0] in gone and t[4] == OPEN and t[5] == "N":
            t[4] = RUN - DAY
    return [tuple(r) for r in h]


def scenario(rnd, sid):
    hist, stg, live = [], [], set()
    for i in range(rnd.randint(1, 6)):
        k = f"s{sid}_k{i}"
        state = rnd.choice(["none", "open", "open_hist", "tomb", "tomb_back"])
        t0 = datetime(2020, 1, 1) + timedelta(days=rnd.randrange(300))
        xv, yv = rnd.choice(VALUES), rnd.choice(VALUES)
        if state in ("open_hist", "tomb", "tomb_back"):
            hist.append((k, rnd.choice(VALUES), rnd.choice(VALUES), t0 - 20 * DAY, t0 - DAY, "N"))
        if state in ("open", "open_hist", "tomb_back"):
            hist.append((k, xv, yv, t0, OPEN, "N"))
        if state in ("tomb", "tomb_back"):
            hist.append((k, xv, yv, t0 + 10 * DAY, OPEN, "Y"))
        if rnd.random() < 0.7:
            same = rnd.random() < 0.3
            sx, sy = (xv, yv) if same else (rnd.choice(VALUES), rnd.choice(VALUES))
            cre = datetime(2021, 3, 2) + timedelta(minutes=rnd.randrange(600))
            upd = None if rnd.random() < 0.3 else cre + timedelta(minutes=rnd.randrange(300))
            if state != "none" and rnd.random() < 0.5:
                cre = t0 - 30 * DAY  # an old row updated now
                upd = datetime(2021, 3, 2) + timedelta(minutes=rnd.randrange(600))
            stg.append((k, sx, sy, cre, upd))
        if rnd.random() < 0.75:
            live.add(k)
    return hist, stg, live


def test_one_pass_equals_literal_model(spark):
    rnd = random.Random(2024)
    hist, stg, live, want = [], [], set(), []
    for sid in range(400):
        h, s, lv = scenario(rnd, sid)
        hist += h
        stg += s
        live |= lv
        want += model(h, s, lv)
    hdf = spark.createDataFrame(hist, SCHEMA_H)
    ddf = spark.createDataFrame(stg, SCHEMA_D)
    ldf = spark.createDataFrame([(k,) for k in sorted(live)], "k string")
    run = ts_lit(RUN)
    ef, ec = scd2.dimension_times("create_dt", "update_dt", run)
    out = scd2.scd2_apply(hdf, ddf, ldf, key="k", attrs=["x", "y"], eff_from=ef,
                          eff_change=ec, delete_ts=run)
    got = sorted((tuple(r) for r in out.collect()), key=_key)
    assert len(got) == len(want)
    assert got == sorted(want, key=_key)


def _next_round(rnd, hist_rows, round_no, keys):
    """A later batch: new deltas (times after the previous run) and live keys."""
    stg, live = [], set()
    base = datetime(2021, 3, 2) + round_no * 3 * DAY
    cur = {r[0]: r for r in hist_rows if r[4] == OPEN and r[5] == "N"}
    for k in keys:
        if rnd.random() < 0.5:
            old = cur.get(k)
            same = old is not None and rnd.random() < 0.3
            sx, sy = (old[1], old[2]) if same else (rnd.choice(VALUES), rnd.choice(VALUES))
            cre = base + timedelta(minutes=rnd.randrange(600))
            upd = None if (old is None and rnd.random() < 0.5) else cre + timedelta(minutes=rnd.randrange(300))
            stg.append((k, sx, sy, cre, upd))
        if rnd.random() < 0.8:
            live.add(k)
    return stg, live


def test_consecutive_batches_equal_literal_model(spark):
    """Three batches in a row; each output history is the next input."""
    global RUN
    rnd = random.Random(77)
    hist, keys = [], []
    for sid in range(150):
        h, _, _ = scenario(rnd, sid)
        hist += h
        keys += sorted({r[0] for r in h}) + [f"s{sid}_new"]
    model_hist = list(hist)
    spark_hist = spark.createDataFrame(hist, SCHEMA_H)
    saved = RUN
    try:
        for rn in range(3):
            RUN = datetime(2021, 3, 3, 3, 27) + rn * 3 * DAY
            stg, live = _next_round(rnd, model_hist, rn, keys)
            model_hist = model(model_hist, stg, live)
            run = ts_lit(RUN)
            ef, ec = scd2.dimension_times("create_dt", "update_dt", run)
            out = scd2.scd2_apply(spark_hist, spark.createDataFrame(stg, SCHEMA_D),
                                  spark.createDataFrame([(k,) for k in sorted(live)], "k string"),
                                  key="k", attrs=["x", "y"], eff_from=ef, eff_change=ec,
                                  delete_ts=run)
            rows = [tuple(r) for r in out.collect()]
            assert sorted(rows, key=_key) == sorted(model_hist, key=_key), rn
            spark_hist = spark.createDataFrame(rows, SCHEMA_H)
    finally:
        RUN = saved
