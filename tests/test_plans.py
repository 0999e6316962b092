"""Regression guards on physical plan shapes the scale design relies on."""

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def _final_plan(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    # the adaptive plan prints "== Final Plan ==" first, then "== Initial Plan =="
    return text.split("== Initial Plan ==")[0]


def test_sequence_shuffles_narrow_rows_once(spark):
    """Ordinary cards cross one exchange, and no profile column is in it."""
    from histmart.plans import catalog
    from histmart.sources import testdata as td

    for name in ("n1_lead_pair", "r3_city_hop", "u1_fraud_mart"):
        plan = _final_plan(entry.queries()[name](spark, SF))
        windows = [ln for ln in plan.splitlines() if " Window " in ln]
        assert len(windows) == 1, plan
        exchanges = [ln for ln in plan.splitlines() if "Exchange hashpartitioning(card_num" in ln]
        assert len(exchanges) == 1 and "report_dt" in exchanges[0], plan
        below = plan[plan.index("Window ["):]
        assert "fio" not in below.split("BroadcastExchange")[0], plan
    assert td.operations(spark, SF).count() and catalog.QUERIES


def test_size_probe_moves_no_rows(spark):
    from histmart.operators import joins

    side = spark.range(1000).selectExpr("id", "repeat('x', 10) AS s")
    fixed, aggs = joins._size_aggs(side)
    plan = _final_plan(side.agg(*aggs))
    assert "Limit" not in plan and plan.count("Exchange SinglePartition") == 1 and "partial_count" in plan


def test_hot_card_path_without_broadcast(spark):
    from histmart.operators import rules
    from histmart.plans import catalog
    from histmart.sources import testdata as td

    args = (td.operations(spark, SF), catalog._profile(spark, SF), td.terminals_hist(spark, SF))
    want = sorted(tuple(r) for r in rules.fraud_mart(*args).collect())
    spark.conf.set("histmart.broadcast.maxRows", "1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        mart = rules.fraud_mart(*args, hot_rows=2)
        assert sorted(tuple(r) for r in mart.collect()) == want
        plan = _final_plan(mart)
    finally:
        spark.conf.unset("histmart.broadcast.maxRows")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "64m")
    lines = [ln for ln in plan.splitlines() if "REPARTITION_BY_COL" in ln]
    assert lines and "__seq_bucket" in lines[0], plan
    assert "SortMergeJoin [card_num" in plan


def test_delta_scan_pushes_the_mark(spark):
    plan = _final_plan(entry.queries()["s1_watermark_delta"](spark, SF))
    scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln][0]
    assert "GreaterThan(o_orderdate,1996-01-01" in scan and "o_totalprice" not in scan


def test_delta_scan_reads_only_needed_columns(spark):
    df = entry.queries()["s5_key_snapshot"](spark, SF)
    plan = _final_plan(df)
    scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln][0]
    assert "[o_custkey" in scan and "o_totalprice" not in scan and "o_orderpriority" not in scan


def test_scd2_shuffles_each_input_once(spark, workdir):
    from pyspark.sql import functions as F

    from histmart.operators import scd2
    from histmart.schemas import ts_lit
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        spark.range(2000).select(F.col("id").cast("string").alias("k"), F.lit("a").alias("x"),
                                 ts_lit("2020-01-01 00:00:00").alias("effective_from"),
                                 ts_lit("9999-12-31 00:00:00").alias("effective_to"),
                                 F.lit("N").alias("deleted_flg")).write.parquet(f"{workdir}/h")
        spark.range(0, 3000, 3).select(F.col("id").cast("string").alias("k"), F.lit("b").alias("x"),
                                       ts_lit("2021-01-01 00:00:00").alias("create_dt"),
                                       ts_lit("2021-03-02 00:00:00").alias("update_dt")) \
            .write.parquet(f"{workdir}/d")
        spark.range(2500).select(F.col("id").cast("string").alias("k")).write.parquet(f"{workdir}/l")
        run = ts_lit("2021-03-03 03:27:00")
        ef, ec = scd2.dimension_times("create_dt", "update_dt", run)
        out = scd2.scd2_versions(spark.read.parquet(f"{workdir}/h"), spark.read.parquet(f"{workdir}/d"),
                                 spark.read.parquet(f"{workdir}/l"), key="k", attrs=["x"],
                                 eff_from=ef, eff_change=ec, delete_ts=run)
        plan = _final_plan(out)
    finally:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "64m")
    assert "FullOuter" in plan
    # current rows, delta and live keys: one exchange each (the live keys' one is reused)
    assert plan.count("Exchange hashpartitioning") - plan.count("ReusedExchange") == 3, plan
    assert "ReusedExchange" in plan
