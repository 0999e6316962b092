"""Registered queries over the driver's test tables, and their SQL oracles.

Every query reads whole test tables (through ``sources.testdata``) and runs
the engine's operators on them; ``ORACLE_SQL`` holds, for the same key, an
independent formulation in plain SQL (DuckDB dialect): the SCD2 oracle is
the literal five-statement semantics, the rule oracles use the correlated
``IN``/``lead`` forms of the original reports.
"""

from __future__ import annotations

import functools
import uuid
from datetime import date, timedelta

from pyspark.sql import functions as F

from ..functions.scalars import (batch_date_from_path, day_of, decimal_comma_amount,
                                 hour_component, minus_gap, ts_to_text)
from ..operators import changefeed, facts, rules, scd2, watermark
from ..operators.ids import IdTable
from .. import schemas
from ..schemas import EFF_FROM, META, date_lit, ts_lit
from ..session import checkpoint_dir, cut_lineage
from ..sources import extract
from ..sources import testdata as td
from ..sources.landing import file_exists, read_landing, split_malformed
from ..streaming.landing import landing_stream
from . import batch, compact, publish
from .publish import Warehouse

_SCD_SPEC = td.ORDER_ACCOUNTS
KEY = td.ORDER_ACCOUNTS.key
ATTRS = list(td.ORDER_ACCOUNTS.attrs)
RUN_FOR_SCALARS = "2024-02-01 03:27:00"


# ---------------------------------------------------------------- spark side

def _scd_inputs(spark, d):
    hist = td.account_hist_t0(spark, d)
    src = td.account_source(spark, d, td.SCD_T1)
    delta = extract.delta_scan(src, td.SCD_T0)
    live = td.account_live_keys(spark, d, td.SCD_T1)
    return hist, delta, live


def _scd_times():
    run = ts_lit(td.SCD_RUN_TS)
    eff_from, eff_change = scd2.dimension_times("create_dt", "update_dt", run)
    return eff_from, eff_change, run


def q_s1_watermark_delta(spark, d):
    """Raw orders changed after the mark; an order's date is its only change time."""
    return extract.delta_scan(td.load(spark, d, "orders"), td.SCD_T0, "o_orderdate", "o_orderdate").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_orderdate")


def q_s5_key_snapshot(spark, d):
    return extract.key_snapshot(td.load(spark, d, "orders"), KEY, source_key="o_custkey")


def q_a1_watermark_advance(spark, d):
    _, delta, _ = _scd_inputs(spark, d)
    meta = spark.createDataFrame(
        [("dwh", "order_accounts", td.parse_ts(td.SCD_T0)), ("dwh", "cards", td.parse_ts(td.SCD_T0)),
         ("dwh", "clients", td.parse_ts(td.SCD_T0))], schema=META)
    return watermark.update_meta(meta, delta, "dwh", "order_accounts")


def q_p4_null_safe_diff(spark, d):
    attrs = td.CLIENT_ATTRS
    j = scd2.changed_rows(td.client_nulls_now(spark, d), td.client_nulls_hist(spark, d), "client_id", attrs)
    return j.select(F.col("d.client_id").alias("client_id"),
                    *[F.col(f"o.{a}").alias(f"{a}_old") for a in attrs],
                    *[F.col(f"d.{a}").alias(f"{a}_new") for a in attrs])


def q_j1_new_keys_anti(spark, d):
    hist, delta, _ = _scd_inputs(spark, d)
    return scd2.new_keys(delta, hist, KEY).select(KEY, *ATTRS, "create_dt", "update_dt")


def q_j5_deleted_keys(spark, d):
    hist, _, live = _scd_inputs(spark, d)
    return scd2.deleted_keys(hist, live, KEY).select(KEY, *ATTRS, EFF_FROM)


def q_d1_scd2_insert(spark, d):
    hist, delta, _ = _scd_inputs(spark, d)
    ef, _, _ = _scd_times()
    return scd2.step_insert_new(hist, delta, key=KEY, attrs=ATTRS, eff_from=ef)


def q_d2_scd2_close_changed(spark, d):
    hist, delta, _ = _scd_inputs(spark, d)
    _, ec, _ = _scd_times()
    return scd2.step_close_changed(hist, delta, key=KEY, attrs=ATTRS, eff_change=ec)


def q_d3_scd2_new_version(spark, d):
    hist, delta, _ = _scd_inputs(spark, d)
    _, ec, _ = _scd_times()
    return scd2.step_new_version(hist, delta, key=KEY, attrs=ATTRS, eff_change=ec)


def q_d4_scd2_tombstone(spark, d):
    hist, delta, live = _scd_inputs(spark, d)
    ef, ec, run = _scd_times()
    return scd2.step_tombstone(hist, delta, live, key=KEY, attrs=ATTRS, eff_from=ef,
                               eff_change=ec, delete_ts=run)


def q_d5_scd2_close_deleted(spark, d):
    hist, delta, live = _scd_inputs(spark, d)
    ef, ec, run = _scd_times()
    return scd2.step_close_deleted(hist, delta, live, key=KEY, attrs=ATTRS, eff_from=ef,
                                   eff_change=ec, delete_ts=run)


def q_d_scd2_apply(spark, d):
    hist, delta, live = _scd_inputs(spark, d)
    ef, ec, run = _scd_times()
    return scd2.scd2_apply(hist, delta, live, key=KEY, attrs=ATTRS, eff_from=ef,
                           eff_change=ec, delete_ts=run)


def q_d_scd2_versions(spark, d):
    hist, delta, live = _scd_inputs(spark, d)
    ef, ec, run = _scd_times()
    return scd2.scd2_versions(hist, delta, live, key=KEY, attrs=ATTRS, eff_from=ef,
                              eff_change=ec, delete_ts=run)


def q_d_scd2_terminals(spark, d):
    """Snapshot dimension: every time is the batch date; the file's keys are
    the live keys."""
    hist = td.terminals_hist_t0(spark, d)
    snap = td.terminal_snapshot(spark, d)
    day = ts_lit(f"{td.REPORT_DAY} 00:00:00")
    spec = schemas.TERMINALS
    return scd2.scd2_apply(hist, snap, extract.key_snapshot(snap, spec.key), key=spec.key,
                           attrs=list(spec.attrs), eff_from=day, eff_change=day, delete_ts=day)


def q_p3_current_view(spark, d):
    return scd2.current_view(q_d_scd2_apply(spark, d)).select(KEY, *ATTRS, EFF_FROM)


@td.derived
def _profile(spark, d):
    return rules.card_profile(td.cards_hist(spark, d), td.accounts_hist(spark, d),
                              td.clients_hist(spark, d), td.blacklist(spark, d))


def _enriched(spark, d):
    return rules.enriched_tx(td.operations(spark, d), _profile(spark, d))


def q_j8_enriched_tx(spark, d):
    return _enriched(spark, d).select(
        "trans_id", "trans_date", "card_num", "report_dt", "valid_to", "passport_num",
        "passport_valid_to", "fio", "phone", "listed_since")


def q_j9_terminal_city(spark, d):
    ops = td.operations(spark, d).select("trans_id", "terminal")
    return rules.with_terminal_city(ops, td.terminals_hist(spark, d)).select("trans_id", "terminal", "terminal_city")


def q_j7_blacklist_existence(spark, d):
    """Clients whose passport is bad on the report day, by R1's own predicate."""
    cl = scd2.current_view(td.clients_hist(spark, d)).select("client_id", "passport_num", "passport_valid_to")
    listed = rules.blacklist_since(td.blacklist(spark, d))
    return cl.join(listed, "passport_num", "left").withColumn("report_dt", date_lit(td.REPORT_DAY)) \
        .where(rules.passport_bad()).select("client_id", "passport_num", "passport_valid_to")


def q_j2_new_fact_anti(spark, d):
    ops = td.operations(spark, d)
    return facts.new_rows(ops, ops.where(F.col("trans_date") < ts_lit(td.REPORT_DAY)), "trans_id")


@td.derived
def _staging_text(spark, d):
    """Operations rendered as the landing file's text columns."""
    e = td.load(spark, d, "events")
    return e.select(
        F.lpad(F.col("event_id").cast("string"), 11, "0").alias("transaction_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("transaction_date"),
        F.regexp_replace(F.col("value").cast("decimal(10,2)").cast("string"), r"\.", ",")
        .alias("amount"),
        F.col("user_id").cast("string").alias("card_num"),
        F.col("event_type").alias("oper_type"),
        F.when(F.col("event_type") == "error", F.lit("REJECT")).otherwise(F.lit("SUCCESS"))
        .alias("oper_result"),
        F.get_json_object("props", "$.k").alias("terminal"))


def q_k1_typed_append(spark, d):
    stg = _staging_text(spark, d)
    parsed = cut_lineage(facts.parse_transactions(stg))
    first = parsed.where(F.col("trans_date") < ts_lit(td.REPORT_DAY))
    loaded, _ = facts.append_new(first, None, parse=lambda df: df, staged=True)
    new, _ = facts.append_new(parsed, loaded, parse=lambda df: df, staged=True)
    return new


def q_k2_slice_append(spark, d):
    return facts.append_slice(td.blacklist(spark, d), "entry_dt", td.REPORT_DAY)


def q_f_scalars(spark, d):
    ops = td.operations(spark, d)
    name = F.concat(F.lit("transactions_"), F.date_format("trans_date", "ddMMyyyy"), F.lit(".txt"))
    return ops.select(
        "trans_id",
        ts_to_text("trans_date").alias("ts_text"),
        name.alias("file_name"),
        batch_date_from_path(name).alias("batch_dt"),
        day_of("trans_date").alias("day"),
        minus_gap("trans_date").alias("day_before"),
        hour_component(ts_lit(RUN_FOR_SCALARS), "trans_date").alias("hours_field"),
        decimal_comma_amount(F.regexp_replace(F.col("amt").cast("string"), r"\.", ","))
        .alias("amt_parsed"))


def q_n1_lead_pair(spark, d):
    return rules.city_hop_pairs(td.operations(spark, d), _profile(spark, d), td.terminals_hist(spark, d)).select(
        "trans_id", "card_num", "report_dt", "trans_date", "terminal_city",
        "next_trans_date", "next_terminal_city")


def q_r1_passport(spark, d):
    return rules.rule_passport(_enriched(spark, d))


def q_r2_contract(spark, d):
    return rules.rule_contract(_enriched(spark, d))


def q_r3_city_hop(spark, d):
    return rules.rule_city_hop(td.operations(spark, d), _profile(spark, d), td.terminals_hist(spark, d))


def q_u1_fraud_mart(spark, d):
    return rules.fraud_mart(td.operations(spark, d), _profile(spark, d), td.terminals_hist(spark, d))


def q_p5_day_report(spark, d):
    """The mart of one report day, as the daily batch of that day builds it."""
    return rules.fraud_mart(td.operations(spark, d), _profile(spark, d), td.terminals_hist(spark, d), td.REPORT_DAY)


def _scratch(spark) -> str:
    """A new folder on the shared store, for queries whose operator reads or writes files."""
    return f"{checkpoint_dir(spark)}/query-{uuid.uuid4().hex}"


def q_s4_watermark_read(spark, d):
    """The seed advanced by the first load, read back as one value, and the delta after it."""
    first = extract.delta_scan(td.account_source(spark, d, td.SCD_T0), schemas.WATERMARK_SEED_TEXT)
    meta = watermark.update_meta(extract.seed_meta(spark, [td.ORDER_ACCOUNTS.name, "cards"]), first, "dwh", td.ORDER_ACCOUNTS.name)
    mark = extract.read_watermark(meta, "dwh", td.ORDER_ACCOUNTS.name)
    return extract.delta_scan(td.account_source(spark, d, td.SCD_T1), mark).select(
        KEY, *ATTRS, "create_dt", "update_dt", ts_lit(mark).alias("mark"))


def q_s7_landing_load(spark, d):
    """Landing text written from the test operations, read back and typed."""
    folder = _scratch(spark)
    _staging_text(spark, d).write.option("sep", ";").option("header", True).csv(folder)
    good, _ = facts.append_new(read_landing(spark, folder, schemas.TRANSACTIONS_TXT, with_batch_date=False), None)
    return good


def _publish_first(spark, d):
    """A warehouse whose one finished batch holds the history before the changes."""
    hist, delta, live = _scd_inputs(spark, d)
    wh = Warehouse(_scratch(spark))
    view = publish.begin(spark, wh, td.SCD_T0[:10])
    held = {_SCD_SPEC.name: publish.write_versions(spark, wh, _SCD_SPEC.name, view, hist, KEY, ATTRS)}
    publish.write_bucket_map(spark, wh, view, held)
    publish.commit(spark, wh, view, td.parse_ts(td.SCD_T0))
    return wh, hist.schema, delta, live


def _publish_second(spark, wh, schema, delta, live, finish=True):
    ef, ec, run = _scd_times()
    base = publish.finished_view(spark, wh, before=td.SCD_T1[:10])
    view = publish.begin(spark, wh, td.SCD_T1[:10], base)
    held = publish.bucket_map(spark, wh, base)[_SCD_SPEC.name]
    held = batch.update_dimension(spark, wh, view, base, held, _SCD_SPEC, schema, delta, live, eff_from=ef, eff_change=ec, delete_ts=run)
    publish.write_bucket_map(spark, wh, view, {_SCD_SPEC.name: held})
    if finish:
        publish.commit(spark, wh, view, td.parse_ts(td.SCD_RUN_TS))


def q_w8_published_history(spark, d):
    """Two published batches, the second one begun with other input at first; the history read back."""
    wh, schema, delta, live = _publish_first(spark, d)
    _publish_second(spark, wh, schema, delta.limit(100), live, finish=False)
    _publish_second(spark, wh, schema, delta, live)
    return publish.read_history(spark, wh, _SCD_SPEC.name, td.SCD_T1[:10], schema)


def q_w8_crash_rerun(spark, d):
    """What a reader of the newest state sees: after the first batch, after a crash of the second, after
    its run, and after a crash of its re-run with other input."""
    wh, schema, delta, live = _publish_first(spark, d)

    def seen(step):
        df = publish.read_history(spark, wh, _SCD_SPEC.name, publish.finished_view(spark, wh), schema)
        return df.select(F.lit(step).alias("step"), *df.columns)

    steps = [seen("first")]
    _publish_second(spark, wh, schema, delta, live, finish=False)
    steps.append(seen("crash"))
    _publish_second(spark, wh, schema, delta, live)
    steps.append(seen("second"))
    _publish_second(spark, wh, schema, delta.where(F.col("status") != "F"), live, finish=False)
    steps.append(seen("crashed re-run"))
    return functools.reduce(lambda a, b: a.unionByName(b), steps)


def q_j5_digest_deleted_keys(spark, d):
    """Deleted keys found in the buckets alone whose key digest differs from the source's."""
    wh, schema, _, live = _publish_first(spark, d)
    held = publish.bucket_map(spark, wh, publish.finished_view(spark, wh))[_SCD_SPEC.name]
    keys = {k: h.keys for k, h in held.items()}
    touched = publish.touched_buckets(publish.digests(live, [KEY], KEY, wh.buckets), keys)
    hist = publish.read_current(spark, wh, _SCD_SPEC.name, publish.finished_view(spark, wh), schema, held, touched)
    live = live.where(publish.bucket_of(KEY, wh.buckets).isin(list(touched)))
    return scd2.deleted_keys(hist, live, KEY).select(KEY, *ATTRS, EFF_FROM)


def q_j2_bucketed_ids(spark, d):
    """New operations by the bucketed table of known ids: two finished loads, and one that was never finished."""
    ops = td.operations(spark, d)
    known = ops.where(F.col("trans_date") < ts_lit(td.REPORT_DAY))
    ids = IdTable(spark, _scratch(spark), key_type="bigint", buckets=16)
    ids.add(known.where("oper_result = 'SUCCESS'"), "first")
    ids.add(known.where("oper_result <> 'SUCCESS'"), "second")
    ids.add(ops, "unfinished")
    return ids.unknown(ops, ["first", "second"])


def q_w3_compact(spark, d):
    """Operations loaded by three batches, each over many days; small day folders packed after the second and again
    after the third. What a reader gets."""
    ops, wh = td.operations(spark, d), Warehouse(_scratch(spark))
    before, path = F.col("trans_date") < ts_lit(td.REPORT_DAY), wh.fact("transactions")
    parts = (before & (F.col("oper_result") == "SUCCESS"), before & (F.col("oper_result") != "SUCCESS"), ~before)
    last = date.fromisoformat(td.REPORT_DAY) + timedelta(days=1)
    for k, (day, part) in enumerate(zip((td.REPORT_DAY_BEFORE, td.REPORT_DAY, last), parts, strict=True)):
        view = publish.begin(spark, wh, day)
        publish.write_leaf(ops.where(part).withColumn(publish.OP_DAY, day_of("trans_date")), path, publish.REPORT_DT, view,
                           partition_by=publish.OP_DAY, sort_by="trans_date")
        publish.commit(spark, wh, view, td.parse_ts(td.SCD_RUN_TS))
        if k:
            compact.compact(spark, path, view)
    return publish.read_table(spark, wh, path)


def _written(spark, lines):
    folder = _scratch(spark)
    lines.write.text(folder)
    return folder


def _file_changes(spark, schema, old, new, key, attrs):
    """Changes between two landing files, and the number of malformed lines of the new one."""
    rows, bad = split_malformed(cut_lineage(read_landing(spark, new, schema, header=False, with_batch_date=False)))
    before, _ = split_malformed(cut_lineage(read_landing(spark, old, schema, header=False, with_batch_date=False)))
    return changefeed.snapshot_changes(before, rows, key, attrs).withColumn("n_malformed", F.lit(bad.count()))


def q_s8_terminals_file(spark, d):
    """Terminal files of two days, written from the suppliers; lines of two fields are malformed."""
    names = schemas.TERMINALS_TXT.fieldNames()
    line = F.concat_ws(";", *names).alias("value")
    cut_off = td.load(spark, d, "supplier").where(F.col("s_acctbal") > td.CLOSED_BALANCE).select(F.concat(F.col("s_suppkey").cast("string"), F.lit(";POS")).alias("value"))
    old = scd2.current_view(td.terminals_hist_t0(spark, d)).select(line)
    new = td.terminal_snapshot(spark, d).select(line).unionByName(cut_off)
    return _file_changes(spark, schemas.TERMINALS_TXT, _written(spark, old), _written(spark, new), names[0], names[1:])


def q_s9_blacklist_file(spark, d):
    """Blacklist files of two days, written from the customers: cumulative, but for entries withdrawn; lines of one field are malformed."""
    names = schemas.BLACKLIST_TXT.fieldNames()
    line = F.concat_ws(";", *names).alias("value")
    listed = td.blacklist(spark, d)
    day = F.dayofmonth("entry_dt")
    old = listed.where(F.col("entry_dt") <= date_lit(td.REPORT_DAY)).select(line)
    new = listed.where(day != 13).select(line).unionByName(listed.where(day == 20).select(F.col("entry_dt").cast("string").alias("value")))
    return _file_changes(spark, schemas.BLACKLIST_TXT, _written(spark, old), _written(spark, new), names, ())


def _landed_file(spark, rows, folder, name):
    """One dated file, as a source drops it."""
    part = _scratch(spark)
    rows.coalesce(1).write.option("sep", ";").option("header", True).csv(part)
    p = spark._jvm.org.apache.hadoop.fs.Path(part)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(spark._jvm.org.apache.hadoop.fs.Path(folder))
    made = next(f.getPath() for f in fs.listStatus(p) if f.getPath().getName().startswith("part-"))
    fs.rename(made, spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}"))


def q_s11_landing_stream(spark, d):
    """All operations dropped as the files of two dates, picked up by two runs of the stream: what was loaded, and
    whether its file was archived."""
    folder, days = _scratch(spark), (td.REPORT_DAY_BEFORE, td.REPORT_DAY)
    cfg = batch.BatchConfig(f"{folder}/dwh", f"{folder}/landing", td.landing_sources(spark, d), archive=f"{folder}/archive")
    text, first = _staging_text(spark, d), F.col("transaction_date") < F.lit(td.REPORT_DAY)
    for day, part in zip(days, (first, ~first)):
        tag = "".join(reversed(day.split("-")))
        _landed_file(spark, text.where(part), cfg.landing, f"transactions_{tag}.txt")
        terminals = scd2.current_view(td.terminals_hist(spark, d)).select(*schemas.TERMINALS_TXT.fieldNames())
        _landed_file(spark, terminals, cfg.landing, f"terminals_{tag}.csv")
        _landed_file(spark, td.blacklist(spark, d).select(*schemas.BLACKLIST_TXT.fieldNames()), cfg.landing, f"passport_blacklist_{tag}.csv")
        query = landing_stream(spark, cfg, f"{folder}/checkpoint")
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
    wh = Warehouse(cfg.warehouse)
    there = [day for day in days if file_exists(spark, f"{cfg.archive}/transactions_{''.join(reversed(day.split('-')))}.txt")]
    loaded = publish.read_table(spark, wh, wh.fact("transactions"))
    return loaded.select("trans_id", "trans_date", "card_num", "oper_type", "amt", "oper_result", "terminal", "report_dt",
                         F.col("report_dt").cast("string").isin(there).alias("archived"))


QUERIES = {
    "s1_watermark_delta": q_s1_watermark_delta,
    "s5_key_snapshot": q_s5_key_snapshot,
    "a1_watermark_advance": q_a1_watermark_advance,
    "p4_null_safe_diff": q_p4_null_safe_diff,
    "j1_new_keys_anti": q_j1_new_keys_anti,
    "j5_deleted_keys": q_j5_deleted_keys,
    "d1_scd2_insert": q_d1_scd2_insert,
    "d2_scd2_close_changed": q_d2_scd2_close_changed,
    "d3_scd2_new_version": q_d3_scd2_new_version,
    "d4_scd2_tombstone": q_d4_scd2_tombstone,
    "d5_scd2_close_deleted": q_d5_scd2_close_deleted,
    "d_scd2_apply": q_d_scd2_apply,
    "d_scd2_versions": q_d_scd2_versions,
    "d_scd2_terminals": q_d_scd2_terminals,
    "p3_current_view": q_p3_current_view,
    "j2_new_fact_anti": q_j2_new_fact_anti,
    "j7_blacklist_existence": q_j7_blacklist_existence,
    "j8_enriched_tx": q_j8_enriched_tx,
    "j9_terminal_city": q_j9_terminal_city,
    "k1_typed_append": q_k1_typed_append,
    "k2_slice_append": q_k2_slice_append,
    "f_scalars": q_f_scalars,
    "n1_lead_pair": q_n1_lead_pair,
    "r1_passport": q_r1_passport,
    "r2_contract": q_r2_contract,
    "r3_city_hop": q_r3_city_hop,
    "u1_fraud_mart": q_u1_fraud_mart,
    "p5_day_report": q_p5_day_report,
    "s4_watermark_read": q_s4_watermark_read,
    "s7_landing_load": q_s7_landing_load,
    "w8_published_history": q_w8_published_history,
    "w8_crash_rerun": q_w8_crash_rerun,
    "j5_digest_deleted_keys": q_j5_digest_deleted_keys,
    "j2_bucketed_ids": q_j2_bucketed_ids,
    "w3_compact": q_w3_compact,
    "s8_terminals_file": q_s8_terminals_file,
    "s9_blacklist_file": q_s9_blacklist_file,
    "s11_landing_stream": q_s11_landing_stream,
}


# ---------------------------------------------------------------- SQL oracle

OPEN = "TIMESTAMP '9999-12-31 00:00:00'"
T0 = f"TIMESTAMP '{td.SCD_T0}'"
T1 = f"TIMESTAMP '{td.SCD_T1}'"
RUN = f"TIMESTAMP '{td.SCD_RUN_TS}'"
BASE = f"DATE '{td.BASE_DAY}'"
RDAY = f"DATE '{td.REPORT_DAY}'"

_DOMAIN = f"""
ops AS (
  SELECT event_id AS trans_id, date_trunc('second', ts) AS trans_date, user_id AS card_num,
         event_type AS oper_type, CAST(value AS DECIMAL(8,2)) AS amt,
         CASE WHEN event_type = 'error' THEN 'REJECT' ELSE 'SUCCESS' END AS oper_result,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS terminal
  FROM events),
term_hist AS (
  SELECT s_suppkey AS terminal_id, n_name AS terminal_city,
         TIMESTAMP '{td.TERMINAL_SWITCH}' AS effective_from, {OPEN} AS effective_to, 'N' AS deleted_flg
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  UNION ALL
  SELECT s_suppkey, r_name, TIMESTAMP '{td.DIM_START}',
         TIMESTAMP '{td.TERMINAL_SWITCH}' - INTERVAL 1 DAY, 'N'
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
term_cur AS (SELECT terminal_id, terminal_city FROM term_hist
             WHERE effective_to = {OPEN} AND deleted_flg = 'N'),
cards AS (SELECT c_custkey AS card_num, c_custkey AS account_num FROM customer),
accounts AS (SELECT c_custkey AS account_num,
                    {BASE} + CAST(floor(c_acctbal / 100) AS INTEGER) AS valid_to,
                    c_custkey AS client FROM customer),
clients AS (
  SELECT c_custkey AS client_id, c_name AS last_name, c_mktsegment AS first_name,
         CASE WHEN c_acctbal >= 0 THEN 'N' || CAST(c_nationkey AS VARCHAR) END AS patronymic,
         CAST(c_custkey AS VARCHAR) AS passport_num,
         {BASE} + c_nationkey * 7 AS passport_valid_to,
         '+7' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS phone
  FROM customer WHERE c_acctbal >= {td.DELETED_BALANCE}),
blacklist AS (
  SELECT CAST(c_custkey AS VARCHAR) AS passport_num,
         {BASE} + CAST(floor(-c_acctbal / 40) AS INTEGER) AS entry_dt
  FROM customer WHERE c_acctbal < 0),
enr AS (
  SELECT t.trans_id, t.trans_date, t.card_num, t.terminal, CAST(t.trans_date AS DATE) AS report_dt,
         a.valid_to, cl.passport_num, cl.passport_valid_to, cl.phone,
         concat(cl.last_name, ' ', cl.first_name, ' ', cl.patronymic) AS fio
  FROM ops t
  JOIN cards c ON c.card_num = t.card_num
  JOIN accounts a ON a.account_num = c.account_num
  JOIN clients cl ON cl.client_id = a.client),
pairs AS (
  SELECT e.*, tm.terminal_city,
         lead(e.trans_date) OVER w AS next_trans_date,
         lead(tm.terminal_city) OVER w AS next_terminal_city
  FROM enr e JOIN term_cur tm ON tm.terminal_id = e.terminal
  WINDOW w AS (PARTITION BY e.card_num, e.report_dt ORDER BY e.trans_date, e.trans_id))
"""

_R1 = """SELECT trans_date AS event_dt, passport_num AS passport, fio, phone,
       CAST(1 AS SMALLINT) AS event_type, report_dt FROM enr x
WHERE x.passport_valid_to < x.report_dt
   OR x.passport_num IN (SELECT b.passport_num FROM blacklist b WHERE b.entry_dt <= x.report_dt)"""
_R2 = """SELECT trans_date AS event_dt, passport_num AS passport, fio, phone,
       CAST(2 AS SMALLINT) AS event_type, report_dt FROM enr
WHERE trans_date > valid_to"""
_R3 = """SELECT next_trans_date AS event_dt, passport_num AS passport, fio, phone,
       CAST(3 AS SMALLINT) AS event_type, report_dt FROM pairs
WHERE next_trans_date IS NOT NULL
  AND extract(hour FROM next_trans_date - trans_date) = 0
  AND terminal_city <> next_terminal_city"""


def _distinct(a: str, b: str, cols) -> str:
    """Null-safe difference over the tracked attributes."""
    return "(" + " OR ".join(f"{a}.{c} IS DISTINCT FROM {b}.{c}" for c in cols) + ")"


def _diff(a: str, b: str) -> str:
    return _distinct(a, b, ATTRS)


_SCD = f"""
o0 AS (
  SELECT o_custkey, o_orderpriority, o_orderstatus, o_orderdate,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn_last,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn_first,
         count(*) OVER (PARTITION BY o_custkey) AS n,
         min(o_orderdate) OVER (PARTITION BY o_custkey) AS create_dt,
         max(o_orderdate) OVER (PARTITION BY o_custkey) AS last_dt
  FROM orders WHERE o_orderdate <= {T0}),
hist0 AS (
  SELECT o_custkey AS account_num, o_orderpriority AS priority, o_orderstatus AS status,
         CASE WHEN n > 1 THEN last_dt ELSE create_dt END AS effective_from,
         {OPEN} AS effective_to, 'N' AS deleted_flg
  FROM o0 WHERE rn_last = 1
  UNION ALL
  SELECT o_custkey, o_orderpriority, o_orderstatus, create_dt, last_dt - INTERVAL 1 DAY, 'N'
  FROM o0 WHERE rn_first = 1 AND n > 1),
o1 AS (
  SELECT o_custkey, o_orderpriority, o_orderstatus,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn_last,
         count(*) OVER (PARTITION BY o_custkey) AS n,
         min(o_orderdate) OVER (PARTITION BY o_custkey) AS create_dt,
         max(o_orderdate) OVER (PARTITION BY o_custkey) AS last_dt
  FROM orders WHERE o_orderdate <= {T1}),
src1 AS (
  SELECT o_custkey AS account_num, o_orderpriority AS priority, o_orderstatus AS status,
         create_dt, CASE WHEN n > 1 THEN last_dt END AS update_dt
  FROM o1 WHERE rn_last = 1),
stg AS (
  SELECT * FROM src1
  WHERE (update_dt IS NULL AND create_dt > {T0}) OR update_dt > {T0}),
live AS (
  SELECT DISTINCT o_custkey AS account_num FROM orders
  WHERE o_orderdate <= {T1} AND o_orderdate > {T1} - INTERVAL {td.ACTIVE_DAYS} DAY),
cur0 AS (SELECT * FROM hist0 WHERE effective_to = {OPEN} AND deleted_flg = 'N'),
rest0 AS (SELECT * FROM hist0 WHERE NOT (effective_to = {OPEN} AND deleted_flg = 'N')),
d1 AS (
  SELECT stg.account_num, stg.priority, stg.status,
         coalesce(stg.update_dt, stg.create_dt) AS effective_from,
         {OPEN} AS effective_to, 'N' AS deleted_flg
  FROM stg LEFT JOIN cur0 tgt ON stg.account_num = tgt.account_num
  WHERE tgt.account_num IS NULL),
chg AS (
  SELECT stg.account_num, stg.priority, stg.status,
         coalesce(stg.update_dt, stg.create_dt, {RUN}) AS change_dt,
         tgt.priority AS old_priority, tgt.status AS old_status, tgt.effective_from AS old_from
  FROM stg JOIN cur0 tgt ON stg.account_num = tgt.account_num
  WHERE {_diff('stg', 'tgt')}),
d2 AS (
  SELECT account_num, old_priority AS priority, old_status AS status, old_from AS effective_from,
         change_dt - INTERVAL 1 DAY AS effective_to, 'N' AS deleted_flg FROM chg),
d3 AS (
  SELECT account_num, priority, status, change_dt AS effective_from,
         {OPEN} AS effective_to, 'N' AS deleted_flg FROM chg),
cur_after AS (
  SELECT * FROM cur0 WHERE account_num NOT IN (SELECT account_num FROM chg)
  UNION ALL SELECT * FROM d1
  UNION ALL SELECT * FROM d3),
gone AS (
  SELECT * FROM cur_after
  WHERE account_num IN (SELECT t.account_num FROM cur_after t
                        LEFT JOIN live s ON s.account_num = t.account_num
                        WHERE s.account_num IS NULL)),
d4 AS (
  SELECT account_num, priority, status, {RUN} AS effective_from, {OPEN} AS effective_to,
         'Y' AS deleted_flg FROM gone),
d5 AS (
  SELECT account_num, priority, status, effective_from,
         {RUN} - INTERVAL 1 DAY AS effective_to, 'N' AS deleted_flg FROM gone),
hist1 AS (
  SELECT * FROM rest0
  UNION ALL SELECT * FROM d2
  UNION ALL SELECT * FROM cur_after WHERE account_num NOT IN (SELECT account_num FROM gone)
  UNION ALL SELECT * FROM d4
  UNION ALL SELECT * FROM d5)
"""


_TERM_DIFF = _distinct("s", "t", ("terminal_type", "terminal_city", "terminal_address"))
RDAY_TS = f"TIMESTAMP '{td.REPORT_DAY} 00:00:00'"

_TERM_SCD = f"""
base AS (
  SELECT * FROM supplier JOIN nation ON s_nationkey = n_nationkey
                        JOIN region ON n_regionkey = r_regionkey),
th0 AS (
  SELECT s_suppkey AS terminal_id, CASE WHEN s_acctbal < 0 THEN 'ATM' ELSE 'POS' END AS terminal_type,
         n_name AS terminal_city, s_name AS terminal_address,
         TIMESTAMP '{td.TERMINAL_SWITCH}' AS effective_from, {OPEN} AS effective_to, 'N' AS deleted_flg
  FROM base WHERE s_nationkey < {td.NEW_NATION} OR s_acctbal > {td.CLOSED_BALANCE}
  UNION ALL
  SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN 'ATM' ELSE 'POS' END, r_name, s_name,
         TIMESTAMP '{td.DIM_START}', TIMESTAMP '{td.TERMINAL_SWITCH}' - INTERVAL 1 DAY, 'N'
  FROM base WHERE s_nationkey < {td.NEW_NATION} OR s_acctbal > {td.CLOSED_BALANCE}),
tsnap AS (
  SELECT s_suppkey AS terminal_id,
         CASE WHEN s_acctbal < {td.ATM_BALANCE} THEN 'ATM' ELSE 'POS' END AS terminal_type,
         n_name AS terminal_city, s_name AS terminal_address
  FROM base WHERE s_acctbal <= {td.CLOSED_BALANCE}),
tcur0 AS (SELECT * FROM th0 WHERE effective_to = {OPEN} AND deleted_flg = 'N'),
trest0 AS (SELECT * FROM th0 WHERE NOT (effective_to = {OPEN} AND deleted_flg = 'N')),
t1 AS (
  SELECT s.*, {RDAY_TS} AS effective_from, {OPEN} AS effective_to, 'N' AS deleted_flg
  FROM tsnap s LEFT JOIN tcur0 t ON s.terminal_id = t.terminal_id WHERE t.terminal_id IS NULL),
tchg AS (
  SELECT s.terminal_id, s.terminal_type, s.terminal_city, s.terminal_address,
         t.terminal_type AS o_type, t.terminal_city AS o_city, t.terminal_address AS o_address,
         t.effective_from AS o_from
  FROM tsnap s JOIN tcur0 t ON s.terminal_id = t.terminal_id WHERE {_TERM_DIFF}),
t2 AS (
  SELECT terminal_id, o_type AS terminal_type, o_city AS terminal_city, o_address AS terminal_address,
         o_from AS effective_from, {RDAY_TS} - INTERVAL 1 DAY AS effective_to, 'N' AS deleted_flg
  FROM tchg),
t3 AS (
  SELECT terminal_id, terminal_type, terminal_city, terminal_address,
         {RDAY_TS} AS effective_from, {OPEN} AS effective_to, 'N' AS deleted_flg FROM tchg),
tafter AS (
  SELECT * FROM tcur0 WHERE terminal_id NOT IN (SELECT terminal_id FROM tchg)
  UNION ALL SELECT * FROM t1 UNION ALL SELECT * FROM t3),
tgone AS (SELECT * FROM tafter WHERE terminal_id NOT IN (SELECT terminal_id FROM tsnap)),
th1 AS (
  SELECT * FROM trest0
  UNION ALL SELECT * FROM t2
  UNION ALL SELECT * FROM tafter WHERE terminal_id IN (SELECT terminal_id FROM tsnap)
  UNION ALL SELECT terminal_id, terminal_type, terminal_city, terminal_address,
                   {RDAY_TS}, {OPEN}, 'Y' FROM tgone
  UNION ALL SELECT terminal_id, terminal_type, terminal_city, terminal_address,
                   effective_from, {RDAY_TS} - INTERVAL 1 DAY, 'N' FROM tgone)
"""


def _with(body: str, *blocks: str) -> str:
    return "WITH " + ",".join(b.strip() for b in blocks) + "\n" + body


_STAGING = """stg AS (
  SELECT lpad(CAST(event_id AS VARCHAR), 11, '0') AS transaction_id,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS transaction_date,
         replace(CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR), '.', ',') AS amount,
         CAST(user_id AS VARCHAR) AS card_num, event_type AS oper_type,
         CASE WHEN event_type = 'error' THEN 'REJECT' ELSE 'SUCCESS' END AS oper_result,
         json_extract_string(props, '$.k') AS terminal
  FROM events)"""
_TYPED = """stg.transaction_id AS trans_id,
       strptime(stg.transaction_date, '%Y-%m-%d %H:%M:%S') AS trans_date,
       stg.card_num, stg.oper_type,
       CAST(replace(stg.amount, ',', '.') AS DECIMAL(8,2)) AS amt,
       stg.oper_result, stg.terminal"""

ORACLE_SQL = {
    "s1_watermark_delta": f"""
SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus, o_orderdate FROM orders WHERE o_orderdate > {T0}""",
    "s5_key_snapshot": "SELECT DISTINCT o_custkey AS account_num FROM orders",
    "a1_watermark_advance": _with(f"""
SELECT m.schema_name, m.table_name,
       coalesce((SELECT max(update_dt) FROM stg), (SELECT max(create_dt) FROM stg), m.max_update_dt)
         AS max_update_dt
FROM (VALUES ('dwh', 'order_accounts', {T0})) m(schema_name, table_name, max_update_dt)
UNION ALL
SELECT * FROM (VALUES ('dwh', 'cards', {T0}), ('dwh', 'clients', {T0})) m(schema_name, table_name, max_update_dt)
""", _SCD),
    "p4_null_safe_diff": f"""
SELECT * FROM (
  SELECT c_custkey AS client_id,
         CASE WHEN c_acctbal < {td.KNOWN_BALANCE} THEN 'N' || c_nationkey END AS patronymic_old,
         CASE WHEN c_nationkey >= {td.OLD_NATION} THEN {BASE} + c_nationkey * 7 END AS passport_valid_to_old,
         CASE WHEN c_acctbal >= 0 THEN 'N' || c_nationkey END AS patronymic_new,
         CASE WHEN c_nationkey < {td.NEW_NATION} THEN {BASE} + c_nationkey * 7 END AS passport_valid_to_new
  FROM customer)
WHERE patronymic_old IS DISTINCT FROM patronymic_new OR passport_valid_to_old IS DISTINCT FROM passport_valid_to_new""",
    "j1_new_keys_anti": _with("""
SELECT stg.account_num, stg.priority, stg.status, stg.create_dt, stg.update_dt
FROM stg LEFT JOIN cur0 t ON stg.account_num = t.account_num WHERE t.account_num IS NULL""", _SCD),
    **dict.fromkeys(("j5_deleted_keys", "j5_digest_deleted_keys"), _with("""
SELECT t.account_num, t.priority, t.status, t.effective_from
FROM cur0 t LEFT JOIN live s ON s.account_num = t.account_num WHERE s.account_num IS NULL""", _SCD)),
    "d1_scd2_insert": _with("SELECT * FROM d1", _SCD),
    "d2_scd2_close_changed": _with("SELECT * FROM d2", _SCD),
    "d3_scd2_new_version": _with("SELECT * FROM d3", _SCD),
    "d4_scd2_tombstone": _with("SELECT * FROM d4", _SCD),
    "d5_scd2_close_deleted": _with("SELECT * FROM d5", _SCD),
    "d_scd2_apply": _with("SELECT * FROM hist1", _SCD),
    "d_scd2_terminals": _with("SELECT * FROM th1", _TERM_SCD),
    "d_scd2_versions": _with("""
SELECT * FROM d2
UNION ALL SELECT * FROM cur_after WHERE account_num NOT IN (SELECT account_num FROM gone)
UNION ALL SELECT * FROM d4
UNION ALL SELECT * FROM d5""", _SCD),
    "p3_current_view": _with(f"""
SELECT account_num, priority, status, effective_from FROM hist1
WHERE effective_to = {OPEN} AND deleted_flg = 'N'""", _SCD),
    **dict.fromkeys(("j2_new_fact_anti", "j2_bucketed_ids"), _with(f"""
SELECT s.* FROM ops s
LEFT JOIN (SELECT trans_id FROM ops WHERE trans_date < TIMESTAMP '{td.REPORT_DAY} 00:00:00') f
  ON s.trans_id = f.trans_id
WHERE f.trans_id IS NULL""", _DOMAIN)),
    "j7_blacklist_existence": _with(f"""
SELECT client_id, passport_num, passport_valid_to FROM clients
WHERE passport_valid_to < {RDAY}
   OR passport_num IN (SELECT passport_num FROM blacklist WHERE entry_dt <= {RDAY})""", _DOMAIN),
    "j8_enriched_tx": _with("""
SELECT e.trans_id, e.trans_date, e.card_num, e.report_dt, e.valid_to, e.passport_num,
       e.passport_valid_to, e.fio, e.phone,
       (SELECT min(b.entry_dt) FROM blacklist b WHERE b.passport_num = e.passport_num) AS listed_since
FROM enr e""", _DOMAIN),
    "j9_terminal_city": _with("""
SELECT o.terminal, o.trans_id, t.terminal_city FROM ops o JOIN term_cur t ON t.terminal_id = o.terminal""",
                              _DOMAIN),
    "k1_typed_append": f"""
WITH {_STAGING},
fact AS (SELECT transaction_id AS trans_id FROM stg WHERE transaction_date < '{td.REPORT_DAY}')
SELECT {_TYPED} FROM stg LEFT JOIN fact tgt ON stg.transaction_id = tgt.trans_id
WHERE tgt.trans_id IS NULL""",
    "s7_landing_load": f"WITH {_STAGING} SELECT {_TYPED} FROM stg",
    "s11_landing_stream": f"""
WITH {_STAGING}
SELECT {_TYPED}, CASE WHEN transaction_date < '{td.REPORT_DAY}' THEN DATE '{td.REPORT_DAY_BEFORE}' ELSE {RDAY} END AS report_dt, true AS archived
FROM stg""",
    "s8_terminals_file": _with(f"""
SELECT CAST(coalesce(n.terminal_id, o.terminal_id) AS VARCHAR) AS terminal_id, coalesce(n.terminal_type, o.terminal_type) AS terminal_type,
       coalesce(n.terminal_city, o.terminal_city) AS terminal_city, coalesce(n.terminal_address, o.terminal_address) AS terminal_address,
       CASE WHEN o.terminal_id IS NULL THEN 'added' WHEN n.terminal_id IS NULL THEN 'gone' ELSE 'changed' END AS change,
       (SELECT count(*) FROM supplier WHERE s_acctbal > {td.CLOSED_BALANCE}) AS n_malformed
FROM tsnap n FULL JOIN tcur0 o ON n.terminal_id = o.terminal_id
WHERE (n.terminal_type, n.terminal_city, n.terminal_address) IS DISTINCT FROM (o.terminal_type, o.terminal_city, o.terminal_address)""", _TERM_SCD),
    "s9_blacklist_file": _with(f"""
SELECT CAST(entry_dt AS VARCHAR) AS entry_dt, passport_num, CASE WHEN day(entry_dt) = 13 THEN 'gone' ELSE 'added' END AS change,
       (SELECT count(*) FROM blacklist WHERE day(entry_dt) = 20) AS n_malformed
FROM blacklist WHERE (day(entry_dt) = 13) = (entry_dt <= {RDAY})""", _DOMAIN),
    "s4_watermark_read": _with(f"""
SELECT s.account_num, s.priority, s.status, s.create_dt, s.update_dt, m.mark
FROM src1 s, (SELECT coalesce(max(CASE WHEN n > 1 THEN last_dt END), max(create_dt)) AS mark FROM o0 WHERE rn_last = 1) m
WHERE (s.update_dt IS NULL AND s.create_dt > m.mark) OR s.update_dt > m.mark""", _SCD),
    "w3_compact": _with(f"""
SELECT ops.*, CAST(trans_date AS DATE) AS op_day,
       CASE WHEN CAST(trans_date AS DATE) >= {RDAY} THEN CAST({RDAY} + INTERVAL 1 DAY AS DATE)
            WHEN oper_result = 'SUCCESS' THEN DATE '{td.REPORT_DAY_BEFORE}' ELSE {RDAY} END AS report_dt
FROM ops""", _DOMAIN),
    "w8_published_history": _with("SELECT * FROM hist1", _SCD),
    "w8_crash_rerun": _with("""
SELECT 'first' AS step, * FROM hist0 UNION ALL SELECT 'crash', * FROM hist0
UNION ALL SELECT 'second', * FROM hist1 UNION ALL SELECT 'crashed re-run', * FROM hist1""", _SCD),
    "k2_slice_append": _with(f"SELECT passport_num, entry_dt FROM blacklist WHERE entry_dt = {RDAY}",
                             _DOMAIN),
    "f_scalars": _with(f"""
SELECT trans_id,
       strftime(trans_date, '%Y-%m-%d %H:%M:%S') AS ts_text,
       'transactions_' || strftime(trans_date, '%d%m%Y') || '.txt' AS file_name,
       CAST(strptime(regexp_extract('transactions_' || strftime(trans_date, '%d%m%Y') || '.txt',
                                    '_(\\d{{8}})\\.', 1), '%d%m%Y') AS DATE) AS batch_dt,
       CAST(trans_date AS DATE) AS day,
       trans_date - INTERVAL 1 DAY AS day_before,
       CAST(extract(hour FROM TIMESTAMP '{RUN_FOR_SCALARS}' - trans_date) AS TINYINT) AS hours_field,
       CAST(replace(replace(CAST(amt AS VARCHAR), '.', ','), ',', '.') AS DECIMAL(8,2)) AS amt_parsed
FROM ops""", _DOMAIN),
    "n1_lead_pair": _with("""
SELECT trans_id, card_num, report_dt, trans_date, terminal_city, next_trans_date, next_terminal_city
FROM pairs""", _DOMAIN),
    "r1_passport": _with(_R1, _DOMAIN),
    "r2_contract": _with(_R2, _DOMAIN),
    "r3_city_hop": _with(_R3, _DOMAIN),
    "p5_day_report": _with(f"SELECT * FROM ({_R1}\nUNION ALL\n{_R2}\nUNION ALL\n{_R3}) WHERE report_dt = {RDAY}", _DOMAIN),
    "u1_fraud_mart": _with(f"{_R1}\nUNION ALL\n{_R2}\nUNION ALL\n{_R3}", _DOMAIN),
}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict:
    return dict(ORACLE_SQL)
