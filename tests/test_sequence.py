"""The split of hot groups by time bucket equals the single-window lead."""

import random
from datetime import datetime, timedelta

from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import Window
from pyspark.sql import functions as F

from histmart.operators.sequence import hot_groups, with_next

SCHEMA = "card string, day string, ts timestamp_ntz, id long, city string"


def _rows(seed, n=3000):
    rnd = random.Random(seed)
    base = datetime(2024, 1, 1)
    out = []
    for i in range(n):
        # one hot card holds about a third of the rows
        card = "HOT" if rnd.random() < 0.34 else f"c{rnd.randrange(40)}"
        t = base + timedelta(seconds=rnd.choice([rnd.randrange(86400 * 2), rnd.randrange(600)]))
        out.append((card, t.date().isoformat(), t, i, rnd.choice("XYZ")))
    # exact ties on time, broken by id
    out.append(("HOT", "2024-01-01", base + timedelta(seconds=5), 10**6, "X"))
    out.append(("HOT", "2024-01-01", base + timedelta(seconds=5), 10**6 + 1, "Y"))
    return out


def _collect(df):
    return sorted(tuple(r) for r in df.collect())


def _check(spark, rows, bucket_minutes, hot_rows=5):
    df = spark.createDataFrame(rows, SCHEMA)
    hot = hot_groups(df, ["card", "day"], hot_rows)
    a = with_next(df, ["card", "day"], "ts", "id", ["ts", "city"], hot=hot, bucket_minutes=bucket_minutes)
    w = Window.partitionBy("card", "day").orderBy("ts", "id")
    b = df.select("*", F.lead("ts").over(w).alias("next_ts"), F.lead("city").over(w).alias("next_city"))
    assert _collect(a) == _collect(b)
    assert a.count() == df.count()


def test_bucketed_lead_equals_window(spark):
    _check(spark, _rows(7), 1)


def test_only_hot_groups_are_split(spark):
    df = spark.createDataFrame(_rows(7), SCHEMA)
    assert {r["card"] for r in hot_groups(df, ["card", "day"], 300).collect()} == {"HOT"}
    assert hot_groups(df, ["card", "day"], 10 ** 6) is None
    _check(spark, _rows(7), 1, hot_rows=300)


def test_bucketed_lead_wide_buckets(spark):
    _check(spark, _rows(11, 1500), 30)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 7200), st.sampled_from("XY")),
                min_size=0, max_size=40))
def test_bucketed_lead_property(spark, ops):
    base = datetime(2024, 1, 1)
    rows = [(c, "d", base + timedelta(seconds=s), i, city) for i, (c, s, city) in enumerate(ops)]
    if not rows:
        return
    _check(spark, rows, 1)
