"""Day-by-day reports equal the every-day report."""

from datetime import date, timedelta

from pyspark.sql import functions as F

from histmart.operators import rules
from histmart.plans import catalog
from histmart.sources import testdata as td

SF = "/root/testdata/sf0.001"


def test_each_day_equals_every_day_mart(spark):
    ops = td.operations(spark, SF)
    profile = catalog._profile(spark, SF)
    terms = td.terminals_hist(spark, SF)
    days = [r.d for r in ops.select(F.to_date("trans_date").alias("d")).distinct().collect()]
    assert len(days) >= 28
    per_day = None
    for d in sorted(days):
        m = rules.fraud_mart(ops, profile, terms, report_dt=d)
        per_day = m if per_day is None else per_day.unionByName(m)
    every = rules.fraud_mart(ops, profile, terms, report_dt=None)
    got = sorted(tuple(r) for r in per_day.collect())
    want = sorted(tuple(r) for r in every.collect())
    assert got == want and len(got) > 0


def test_single_day_mart_equals_its_rules(spark):
    ops = td.operations(spark, SF)
    profile = catalog._profile(spark, SF)
    terms = td.terminals_hist(spark, SF)
    d = date(2024, 1, 15)
    a = sorted(tuple(r) for r in rules.fraud_mart(ops, profile, terms, d).collect())
    e = rules.enriched_tx(ops, profile, d)
    by_rule = rules.rule_passport(e).unionByName(rules.rule_contract(e)) \
        .unionByName(rules.rule_city_hop(ops, profile, terms, d))
    assert a == sorted(tuple(r) for r in by_rule.collect())
    prev = d - timedelta(days=1)
    assert all(r[5] == d for r in a) and prev not in {r[5] for r in a}
