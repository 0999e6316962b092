"""Compaction of appended leaves: same rows in every view, fewer files, nothing seen of crashed or overtaken runs."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from histmart.plans import compact, publish

FIRST = date(2024, 1, 1)


def load(spark, wh, k, days=3, base=None):
    """The k-th load: 5 operations on each of some days."""
    view = publish.begin(spark, wh, FIRST + timedelta(days=k), base)
    rows = spark.range(0, 5 * days, 1, 1).select(
        (F.col("id") + 1000 * k).alias("trans_id"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 86400 / 5 - k).cast("timestamp_ntz").alias("trans_date"))
    publish.write_leaf(rows.withColumn("op_day", F.to_date("trans_date")), wh.fact("t"), publish.REPORT_DT, view,
                       partition_by="op_day", sort_by="trans_date")
    publish.commit(spark, wh, view, datetime(2024, 2, 1))
    return view


def rows(spark, wh, view):
    return sorted(map(tuple, publish.read_table(spark, wh, wh.fact("t"), view).collect()))


def files(spark, wh, view):
    return publish.read_table(spark, wh, wh.fact("t"), view).select(F.input_file_name()).distinct().count()


@pytest.fixture
def wh(workdir):
    return publish.Warehouse(workdir)


def test_same_rows_in_fewer_sorted_files(spark, wh):
    views = [load(spark, wh, k) for k in range(3)]
    path, last = wh.fact("t"), views[-1]
    before, n = [rows(spark, wh, v) for v in views], files(spark, wh, last)
    name = compact.compact(spark, path, last)
    assert [rows(spark, wh, v) for v in views] == before  # also in the views the compaction does not hold in
    assert files(spark, wh, last) < n and files(spark, wh, views[0]) > 1
    assert compact.compact(spark, path, last) is None  # nothing left to pack
    for day in [r[0] for r in spark.read.parquet(f"{path}_compact").select("op_day").distinct().collect()]:
        got = [r[0] for r in spark.read.parquet(f"{path}_compact/compact={name}/op_day={day}").select("trans_date").collect()]
        assert got == sorted(got)
    plan = publish.read_table(spark, wh, path, last).where("op_day = DATE '2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    scans = plan.split("PartitionFilters: ")[1:]
    assert len(scans) == 2 and all("op_day" in x.split("PushedFilters")[0] for x in scans)

    more = load(spark, wh, 3)
    want, n = rows(spark, wh, more), files(spark, wh, more)
    assert len(want) == len(before[-1]) + 15
    second = compact.compact(spark, path, more)  # packs the new load with what the first compaction wrote
    assert rows(spark, wh, more) == want and files(spark, wh, more) < n and second > name
    assert rows(spark, wh, last) == before[-1]
    assert publish.read_leaves(spark, path, more, [last.own]).count() == 15  # of one attempt, wherever its rows are
    gone = compact.drop_packed(spark, wh, path, keep=4)
    assert gone and not any(f"attempt={v.own}" in g for v in views[:2] for g in gone)  # what the first batches stand on stays
    assert [rows(spark, wh, v) for v in views] == before
    assert compact.drop_packed(spark, wh, path, keep=1)
    assert rows(spark, wh, more) == want


def test_a_crash_before_the_log_row_and_an_overtaken_run_count_for_nothing(spark, wh, monkeypatch):
    for k in range(2):
        view = load(spark, wh, k)
    path, want = wh.fact("t"), rows(spark, wh, view)
    made = []
    with monkeypatch.context() as m:
        m.setattr(compact, "commit", lambda spark, path, c: made.append(c))
        compact.compact(spark, path, view)
    assert compact.compactions(spark, path, view) == [] and rows(spark, wh, view) == want
    name = compact.compact(spark, path, view)
    compact.commit(spark, path, made[0])  # the other one comes through after all, and stands for the same units
    assert len(compact.compactions(spark, path, view)) == 1 and rows(spark, wh, view) == want
    assert compact.compactions(spark, path, view)[0].name == min(name, made[0].name)


def test_a_rerun_leaves_the_compaction_of_the_old_chain_out(spark, wh):
    views = [load(spark, wh, k) for k in range(2)]
    path = wh.fact("t")
    old = rows(spark, wh, views[1])
    compact.compact(spark, path, views[1])
    again = load(spark, wh, 1, days=2, base=views[0])
    want = rows(spark, wh, again)
    assert len(want) == 25 and compact.compactions(spark, path, again) == []
    assert compact.compact(spark, path, again) and rows(spark, wh, again) == want
    assert rows(spark, wh, views[1]) == old and len(rows(spark, wh, views[0])) == 15


def test_large_and_single_files_stay(spark, wh):
    view = load(spark, wh, 0)
    load(spark, wh, 1)
    both = publish.finished_view(spark, wh)
    assert compact.small_units(spark, wh.fact("t"), both, small=1) == []
    assert compact.compact(spark, wh.fact("t"), both, small=1) is None
    lone = publish.Warehouse(wh.root + "-lone")
    view = load(spark, lone, 0, days=1)
    assert compact.compact(spark, lone.fact("t"), view) is None and len(rows(spark, lone, view)) == 5
