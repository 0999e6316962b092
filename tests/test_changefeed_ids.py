"""Day-to-day changes of whole files and the bucketed table of known ids, against plain comparisons."""

import os
from datetime import date

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from histmart.operators.changefeed import snapshot_changes
from histmart.operators.ids import IdTable
from histmart.plans import batch, publish

from landing_fixture import sources, write_day
from test_batch import _contents, _edit, _run_ts

SCHEMA = "k string, a string, b string"
VALUE = st.sampled_from([None, "", "x", "y"])
FILE = st.lists(st.tuples(st.sampled_from("abcdef"), VALUE, VALUE), max_size=8)


def brute(old, new):
    out = set()
    for k in {r[0] for r in old + new}:
        a, b = {r for r in old if r[0] == k}, {r for r in new if r[0] == k}
        if a != b:
            change = "added" if not a else "gone" if not b else "changed"
            out |= {(*r, change) for r in (b or a)}
    return out


@given(FILE, FILE)
@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_changes_against_sets(spark, old, new):
    frames = [spark.createDataFrame(x, SCHEMA) for x in (old, new)]
    got = [tuple(r) for r in snapshot_changes(*frames, "k", ["a", "b"]).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(old, new)


def test_values_that_move_between_columns_null_keys_and_copies(spark):
    old = spark.createDataFrame([("1", None, "x"), ("2", "p", "q"), (None, "n", "n"), ("3", "s", "t"), ("3", "s", "t")], SCHEMA)
    new = spark.createDataFrame([("1", "x", None), ("2", "q", "p"), (None, "m", "m"), ("3", "s", "t")], SCHEMA)
    assert {(r.k, r.change) for r in snapshot_changes(old, new, "k", ["a", "b"]).collect()} == {("1", "changed"), ("2", "changed")}
    lists = [df.select("k", "a") for df in (old, new)]
    assert {(r.k, r.a, r.change) for r in snapshot_changes(*lists, ["k", "a"]).collect()} == {
        ("1", "x", "added"), ("2", "q", "added"), ("2", "p", "gone")}


def test_unchanged_rows_are_aggregated_by_hash(spark):
    old = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.lit("x").alias("a"))
    plan = snapshot_changes(old, old, ["k", "a"])._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "Join" not in plan


def ids(spark, a, b):
    return spark.range(a, b).select(F.sha2(F.col("id").cast("string"), 256).alias("trans_id"), F.col("id").alias("v"))


def test_known_ids_are_not_exchanged(spark, tmp_path):
    table = IdTable(spark, str(tmp_path / "ids"), buckets=16)
    for k in range(3):
        table.add(ids(spark, 1000 * k, 1000 * k + 1000), f"a{k}")
    table.add(ids(spark, 0, 1000).unionByName(spark.sql("SELECT CAST(NULL AS STRING) AS trans_id, 1L AS v")), "a0")  # a repeat replaces
    new = ids(spark, 2500, 3500).unionByName(spark.sql("SELECT CAST(NULL AS STRING) AS trans_id, 1L AS v"))
    df = table.unknown(new, ["a0", "a1", "a2"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and plan.count("Exchange") == 1  # that of the new rows
    stored = table.known(["a0", "a1", "a2"])
    assert stored.count() == 3000 and table.loads() == {"a0", "a1", "a2"}
    assert sorted(map(str, df.collect())) == sorted(map(str, new.join(stored, "trans_id", "left_anti").collect()))
    assert table.unknown(new, ["a0"]).count() == 1001
    again = IdTable(spark.newSession(), str(tmp_path / "ids"), buckets=16)  # nothing but the folder is needed
    assert again.known().count() == 3000


def test_batches_with_the_id_table_load_the_same(spark, tmp_path):
    d1, d2 = date(2024, 1, 1), date(2024, 1, 2)
    landing = tmp_path / "landing"
    for d in (d1, d2):
        write_day(spark, str(landing), d)
    again = (landing / "transactions_01012024.txt").read_text().splitlines()[1:5]
    _edit(landing / "transactions_02012024.txt", lambda rows: [*rows, *again])
    made = {}
    for name, options in (("plain", {}), ("ids", {"id_buckets": 4})):
        cfg = batch.BatchConfig(warehouse=str(tmp_path / name), landing=str(landing), sources=sources(spark))
        batch.run_batch(spark, cfg, d1, _run_ts(d1))
        for k, v in options.items():  # the table comes into use later: the first day's ids are stored then
            setattr(cfg, k, v)
        batch.run_batch(spark, cfg, d2, _run_ts(d2))
        made[name] = _contents(spark, cfg)
    assert made["plain"] == made["ids"]
    wh = publish.Warehouse(str(tmp_path / "ids"))
    assert {p.partition("=")[2] for p in os.listdir(f"{wh.fact('transactions')}_ids") if "=" in p} == set(publish.finished_view(spark, wh).attempts)


