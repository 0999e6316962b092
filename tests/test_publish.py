"""One commit for all tables: crashes leave the old state, re-runs build on finished batches only, buckets are copied on write."""

import glob
import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from histmart.plans import batch, catalog, publish

from landing_fixture import sources, write_day
from test_batch import _contents, _edit, _rows, _run_ts

D1, D2 = date(2024, 1, 1), date(2024, 1, 2)


class Crash(RuntimeError):
    pass


#: After all dimensions and facts are written; after the mart is.
STEPS = ["build_reports", "publish.commit"]


def crash_at(monkeypatch, step):
    def fail(*args, **kwargs):
        raise Crash(step)

    owner = publish if step.startswith("publish.") else batch
    monkeypatch.setattr(owner, step.rpartition(".")[2], fail)


def seen(spark, cfg):
    """All a reader can get from the newest finished state."""
    wh = publish.Warehouse(cfg.warehouse)
    view = publish.finished_view(spark, wh)
    out = {n: sorted(map(str, publish.read_history(spark, wh, n, view, s).collect())) for n, s in batch.DIM_SCHEMAS.items()}
    out |= {f"{n} now": sorted(map(str, publish.read_current(spark, wh, n, view, s).collect())) for n, s in batch.DIM_SCHEMAS.items()}
    for p in batch.tables(wh)[len(out) // 2:-1]:
        df = publish.read_table(spark, wh, p)
        out[p] = [] if df is None else sorted(str(sorted(r.asDict().items())) for r in df.collect())
    out["mart"] = sorted(map(str, batch.read_mart(spark, cfg.warehouse).collect()))
    return view, out


def test_a_crash_after_any_step_leaves_the_old_state(spark, tmp_path, monkeypatch):
    landing = tmp_path / "landing"
    for d in (D1, D2):
        write_day(spark, str(landing), d)
    cfg = batch.BatchConfig(warehouse=str(tmp_path / "dwh"), landing=str(landing), sources=sources(spark))

    def crashes(day, steps):
        before = seen(spark, cfg)
        for step in steps:
            with monkeypatch.context() as m:
                crash_at(m, step)
                with pytest.raises(Crash):
                    batch.run_batch(spark, cfg, day, _run_ts(day))
            assert seen(spark, cfg) == before, step
        return before

    assert crashes(D1, STEPS[1:])[0] == publish.View()  # a first run
    batch.run_batch(spark, cfg, D1, _run_ts(D1))
    cfg.sources = sources(spark, changed_clients=(["3"], "2030-01-01", "2024-01-02 12:00:00"))
    _edit(landing / "transactions_01012024.txt", lambda rows: rows[:-5])
    view, old = crashes(D1, STEPS)  # a re-run with other input
    assert publish.previous_batch(spark, publish.Warehouse(cfg.warehouse), D2) == D1 and old["mart"]
    batch.run_batch(spark, cfg, D1, _run_ts(D1))
    new_view, new = seen(spark, cfg)
    assert new_view.batch == D1 and new_view.attempts != view.attempts and new != old
    fresh = batch.BatchConfig(warehouse=str(tmp_path / "fresh"), landing=str(landing), sources=cfg.sources)
    batch.run_batch(spark, fresh, D1, _run_ts(D1))
    assert _contents(spark, cfg) == _contents(spark, fresh)
    wh = publish.Warehouse(cfg.warehouse)
    assert publish.remove_unused(spark, wh, batch.tables(wh)) == []  # too young
    assert publish.remove_unused(spark, wh, batch.tables(wh), timedelta(seconds=-5))
    assert seen(spark, cfg) == (new_view, new)
    left = {os.path.basename(p) for p in glob.glob(f"{cfg.warehouse}/*/*/*/attempt=*") if "/batches/" not in p}
    assert left == {f"attempt={new_view.own}"}


def test_a_rerun_does_not_know_operations_of_later_batches(spark, tmp_path):
    """An operation first loaded by day 2 and then added to day 1's file belongs to day 1 after the re-runs in order."""
    landing = tmp_path / "landing"
    for d in (D1, D2):
        write_day(spark, str(landing), d)
    late = (landing / "transactions_02012024.txt").read_text().splitlines()[1:4]
    cfg = batch.BatchConfig(warehouse=str(tmp_path / "dwh"), landing=str(landing), sources=sources(spark))
    for d in (D1, D2):
        batch.run_batch(spark, cfg, d, _run_ts(d))
    _edit(landing / "transactions_01012024.txt", lambda rows: [*rows, *late])
    mart = _rows(batch.read_mart(spark, cfg.warehouse))
    batch.run_batch(spark, cfg, D1, _run_ts(D1))
    assert _rows(batch.read_mart(spark, cfg.warehouse)) == mart  # the newest batch still stands on the first run of day 1
    batch.run_batch(spark, cfg, D2, _run_ts(D2))
    fresh = batch.BatchConfig(warehouse=str(tmp_path / "fresh"), landing=str(landing), sources=cfg.sources)
    for d in (D1, D2):
        batch.run_batch(spark, fresh, d, _run_ts(d))
    assert _contents(spark, cfg) == _contents(spark, fresh)
    loaded = publish.read_table(spark, publish.Warehouse(cfg.warehouse), publish.Warehouse(cfg.warehouse).fact("transactions"))
    ids = [x.split(";")[0] for x in late]
    assert {r.report_dt for r in loaded.where(F.col("trans_id").isin(ids)).collect()} == {D1}


def test_a_small_delta_writes_its_buckets_only(spark, tmp_path):
    """1 % of the keys change, one key vanishes: only their buckets get new files; the history is that of the plain operator."""
    landing = str(tmp_path / "landing")
    for d in (D1, D2):
        write_day(spark, landing, d)
    cfg = batch.BatchConfig(warehouse=str(tmp_path / "dwh"), landing=landing, sources=sources(spark), buckets=64)
    batch.run_batch(spark, cfg, D1, _run_ts(D1))
    wh = publish.Warehouse(cfg.warehouse, 64)
    changed = sources(spark, changed_clients=(["3"], "2030-01-01", "2024-01-02 12:00:00"))
    changed["cards"] = changed["cards"].where("card_num <> '7'")
    cfg.sources = changed
    first = publish.finished_view(spark, wh)
    batch.run_batch(spark, cfg, D2, _run_ts(D2))
    view = publish.finished_view(spark, wh)

    def written(name):
        return {int(os.path.basename(p)[7:]) for p in glob.glob(f"{wh.dim(name)}/*/attempt={view.own}/state=current/bucket=*")}

    def bucket(key):
        return spark.sql(f"SELECT '{key}' AS k").select(publish.bucket_of("k", 64)).first()[0]

    assert written("clients") == {bucket("3")} and written("cards") == {bucket("7")}
    assert written("accounts") == written("terminals") == set()
    for name, gone in (("clients", 0), ("cards", 1)):
        now = publish.read_current(spark, wh, name, view, batch.DIM_SCHEMAS[name])
        before = publish.read_current(spark, wh, name, first, batch.DIM_SCHEMAS[name])
        assert now.count() == before.count() - gone
        assert publish.read_history(spark, wh, name, view, batch.DIM_SCHEMAS[name]).count() == before.count() + 1
    tomb = publish.read_history(spark, wh, "cards", view, batch.DIM_CARDS).where("card_num = '7'").collect()
    assert sorted(r.deleted_flg for r in tomb) == ["N", "Y"]


def test_only_differing_buckets_are_read(spark):
    wh, schema, _, live = catalog._publish_first(spark, "/root/testdata/sf0.001")
    view = publish.finished_view(spark, wh)
    held = publish.bucket_map(spark, wh, view)["order_accounts"]
    current = publish.read_current(spark, wh, "order_accounts", view, schema)
    victim = current.agg(F.min("account_num")).first()[0]
    keys = current.select("account_num").where(F.col("account_num") != victim)
    touched = publish.touched_buckets(publish.digests(keys, ["account_num"], "account_num", wh.buckets), {k: h.keys for k, h in held.items()})
    assert len(touched) == 1
    part = publish.read_current(spark, wh, "order_accounts", view, schema, held, touched)
    files = [r[0] for r in part.select(F.input_file_name()).distinct().collect()]
    assert files and all(f"bucket={next(iter(touched))}/" in f for f in files)
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in plan.split("PartitionFilters")[1].split("]")[0]
    assert current.count() == current.distinct().count() and part.where(F.col("account_num") == victim).count() == 1


def test_equal_numbers_of_other_keys_differ(spark):
    """One key gone and another one come in the same bucket: the count is the same, the hashes are not."""
    keys = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    a = publish.digests(keys, ["k"], "k", 1)
    b = publish.digests(keys.where("k <> '5'").unionByName(spark.sql("SELECT 'x' AS k")), ["k"], "k", 1)
    assert a[0][0] == b[0][0] and a[0][1] != b[0][1] and a[0][2] != b[0][2]
    swapped = publish.digests(spark.sql("SELECT 'k' AS k, CAST(NULL AS STRING) AS a, 'x' AS b"), ["k", "a", "b"], "k", 1)
    assert swapped != publish.digests(spark.sql("SELECT 'k' AS k, 'x' AS a, CAST(NULL AS STRING) AS b"), ["k", "a", "b"], "k", 1)


def test_number_of_buckets_is_fixed(spark):
    wh, *_ = catalog._publish_first(spark, "/root/testdata/sf0.001")
    with pytest.raises(ValueError, match="buckets"):
        publish.bucket_map(spark, publish.Warehouse(wh.root, 7), publish.finished_view(spark, wh))


def test_log_rows_are_small_and_last(spark, tmp_path):
    wh = publish.Warehouse(str(tmp_path / "w"))
    one = publish.begin(spark, wh, "2024-01-01")
    assert publish.finished_view(spark, wh) == publish.View() and publish.finished_batches(spark, wh) == []
    publish.commit(spark, wh, one, datetime(2024, 1, 2))
    two = publish.begin(spark, wh, D2)
    assert two.attempts[:-1] == one.attempts and two.own > one.own
    publish.commit(spark, wh, two, datetime(2024, 1, 3))
    again = publish.begin(spark, wh, D1)
    publish.commit(spark, wh, again, datetime(2024, 1, 4))
    assert publish.finished_view(spark, wh) == two  # stands on the first run of day 1
    assert publish.finished_view(spark, wh, D1) == again == publish.finished_view(spark, wh, before="2024-01-02")
