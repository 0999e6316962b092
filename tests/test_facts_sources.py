"""Fact loads, change capture and watermark golden cases."""

import os
import time
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from histmart.operators import facts, watermark
from histmart.schemas import TRANSACTIONS_TXT
from histmart.session import cut_lineage
from histmart.sources import extract, landing

WM = datetime(2021, 3, 2)
SRC_SCHEMA = "k string, create_dt timestamp_ntz, update_dt timestamp_ntz"


def test_delta_scan_boundaries(spark):
    src = spark.createDataFrame([
        ("a", datetime(2021, 3, 2), None),
        ("b", datetime(2021, 3, 2, 0, 0, 1), None),
        ("c", datetime(2021, 3, 2, 0, 0, 1), datetime(2021, 3, 2)),
        ("d", datetime(2020, 1, 1), datetime(2021, 3, 2, 0, 0, 1)),
        ("e", None, None),
    ], SRC_SCHEMA)
    got = sorted(r.k for r in extract.delta_scan(src, WM).collect())
    assert got == ["b", "d"]


def test_delta_scan_pushes_filter(spark, workdir):
    src = spark.createDataFrame([("a", datetime(2021, 3, 2), None)], SRC_SCHEMA)
    src.write.parquet(f"{workdir}/src")
    plan = extract.delta_scan(spark.read.parquet(f"{workdir}/src"), WM)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PushedFilters" in plan and "update_dt" in plan.split("PushedFilters")[1][:300]


def test_watermark_advance(spark):
    old = datetime(2021, 3, 1)
    d1 = spark.createDataFrame([("a", datetime(2021, 3, 5), datetime(2021, 3, 3)),
                                ("b", datetime(2021, 3, 1), None)], SRC_SCHEMA)
    assert watermark.advance_watermark(d1, old).head()[0] == datetime(2021, 3, 3)
    d2 = spark.createDataFrame([("a", datetime(2021, 3, 5), None)], SRC_SCHEMA)
    assert watermark.advance_watermark(d2, old).head()[0] == datetime(2021, 3, 5)
    d3 = spark.createDataFrame([], SRC_SCHEMA)
    assert watermark.advance_watermark(d3, old).head()[0] == old


def test_meta_update_and_read(spark):
    meta = extract.seed_meta(spark, ["accounts", "cards"])
    assert extract.read_watermark(meta, "dwh", "cards") == datetime(1900, 1, 1)
    d = spark.createDataFrame([("a", datetime(2021, 3, 5), datetime(2021, 3, 6))], SRC_SCHEMA)
    m2 = watermark.update_meta(meta, d, "dwh", "accounts")
    assert extract.read_watermark(m2, "dwh", "accounts") == datetime(2021, 3, 6)
    assert extract.read_watermark(m2, "dwh", "cards") == datetime(1900, 1, 1)


def test_key_snapshot_trims_and_drops_nulls(spark):
    src = spark.createDataFrame([("a  ",), ("a",), (None,), ("b",)], "account string")
    got = sorted(r.account_num for r in
                 extract.key_snapshot(src, "account_num", "account", trim=True).collect())
    assert got == ["a", "b"]


def _stg(spark, rows):
    return spark.createDataFrame(rows, TRANSACTIONS_TXT)


def test_typed_append_parsing_and_quarantine(spark):
    stg = _stg(spark, [
        ("00000000042", "2021-03-03 10:00:00", "1234,50", "card1", "PAYMENT", "SUCCESS", "T1"),
        ("00000000043", "2021-03-03 10:00:01", "0,005", "card1", "PAYMENT", "SUCCESS", "T1"),
        ("00000000044", "2021-03-03 10:00:02", "1000000", "card1", "PAYMENT", "SUCCESS", "T1"),
        ("00000000045", "03/03/2021 10:00", "1,00", "card1", "PAYMENT", "SUCCESS", "T1"),
        ("00000000046", "2021-03-03 10:00:03", "5,00", "card1", "PAYMENT", "SUCCESS", "T1"),
        ("00000000047", "2021-03-03 10:00:04", "6,00", "card1", "PAYMENT", "REJECT", "T1"),
        ("00000000047", "2021-03-03 10:00:04", "6,00", "card1", "PAYMENT", "REJECT", "T1"),
    ])
    fact = spark.createDataFrame([("00000000046",)], "trans_id string")
    good, bad = facts.append_new(stg, fact)
    g = {r.trans_id: r for r in good.collect()}
    assert sorted(g) == ["00000000042", "00000000043", "00000000047"]
    assert g["00000000042"].amt == Decimal("1234.50")
    assert g["00000000043"].amt == Decimal("0.01")
    assert g["00000000042"].trans_date == datetime(2021, 3, 3, 10)
    assert dict(good.dtypes)["amt"] == "decimal(8,2)"
    assert dict(good.dtypes)["trans_date"] == "timestamp_ntz"
    reasons = {r.trans_id: r.reason for r in bad.collect()}
    assert reasons == {"00000000044": "bad amount", "00000000045": "bad transaction_date"}


def test_blacklist_slice(spark):
    lst = spark.createDataFrame([("P1", date(2021, 3, 2)), ("P2", date(2021, 3, 3)),
                                 ("P3", date(2021, 3, 4))], "passport_num string, entry_dt date")
    got = [r.passport_num for r in facts.append_slice(lst, "entry_dt", date(2021, 3, 3)).collect()]
    assert got == ["P2"]
    loaded = lst.where("passport_num = 'P1'")
    caught = sorted(r.passport_num for r in
                    facts.append_slice(lst, "entry_dt", date(2021, 3, 3), loaded=loaded,
                                       catch_up=True).collect())
    assert caught == ["P2"]


def test_new_rows_prunes_fact_scan_to_batch_range(spark, workdir, capsys):
    fact = spark.createDataFrame([(f"{i:011d}",) for i in range(0, 1000)], "trans_id string")
    fact.repartition(4).sortWithinPartitions("trans_id").write.parquet(f"{workdir}/fact")
    batch = spark.createDataFrame([(f"{i:011d}",) for i in (998, 999, 1000, 1001)], "trans_id string")
    got = facts.new_rows(batch, spark.read.parquet(f"{workdir}/fact"), "trans_id", prune=True)
    assert sorted(r.trans_id for r in got.collect()) == ["00000001000", "00000001001"]
    capsys.readouterr()
    got.explain("formatted")
    pushed = [ln for ln in capsys.readouterr().out.splitlines() if ln.startswith("PushedFilters")]
    assert any("GreaterThanOrEqual(trans_id,00000000998)" in ln
               and "LessThanOrEqual(trans_id,00000001001)" in ln for ln in pushed), pushed
    assert facts.new_rows(batch.limit(0), batch, "trans_id", prune=True).count() == 0


def test_conflicting_ids_are_quarantined(spark):
    row = ("00000000004", "2024-01-02 10:00:00", "1,00", "c", "PAYMENT", "SUCCESS", "T")
    stg = _stg(spark, [row, row, ("00000000004", "2024-01-02 11:00:00", "9,00", "c", "PAYMENT", "SUCCESS", "T"),
                       ("00000000005", *row[1:]), ("00000000005", *row[1:])])
    good, bad = facts.append_new(stg, None)
    assert [r.trans_id for r in good.collect()] == ["00000000005"]
    assert [(r.trans_id, r.reason) for r in bad.collect()] == [("00000000004", facts.CONFLICT)] * 3


def test_append_takes_any_parser(spark):
    stg = spark.createDataFrame([("1", "a"), ("2", "b"), ("x", "c")], "id string, v string")

    def parse(df):
        n = F.expr("try_cast(id AS int)")
        return df.select(n.alias("id"), "v", F.when(n.isNull(), "bad id").alias("reason"))

    good, bad = facts.append_new(stg, spark.createDataFrame([(1,)], "id int"), key="id", parse=parse)
    assert [tuple(r) for r in good.collect()] == [(2, "b")] and [r.v for r in bad.collect()] == ["c"]


HEADER = "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal"


def _landed(spark, workdir, *lines):
    with open(f"{workdir}/transactions_02012024.txt", "w") as out:
        out.write("\n".join(lines) + "\n")
    return landing.read_landing(spark, f"{workdir}/transactions_02012024.txt", TRANSACTIONS_TXT, with_batch_date=False)


def test_short_and_long_lines_are_quarantined(spark, workdir):
    good_line = "1;2024-01-02 10:00:01;1,00;c;PAYMENT;SUCCESS;T  "
    stg = _landed(spark, workdir, HEADER, good_line, "2;2024-01-02 10:00:01;1,00;c", good_line.replace("1;", "3;", 1) + ";more")
    good, bad = facts.append_new(stg, None, stage=cut_lineage)
    assert [(r.trans_id, r.terminal) for r in good.collect()] == [("1", "T")]
    assert sorted((r.trans_id, r.reason) for r in bad.collect()) == [("2", "malformed line"), ("3", "malformed line")]


def test_reordered_header_fails(spark, workdir):
    names = HEADER.split(";")
    stg = _landed(spark, workdir, ";".join([names[2], names[1], names[0], *names[3:]]), "5,00;2024-01-02 10:00:01;77;c;PAYMENT;SUCCESS;T")
    with pytest.raises(Exception, match="header"):
        stg.collect()


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Tokyo"])
def test_zoned_source_times_keep_their_mark(spark, zone):
    """A zoned source column gives its UTC wall time, and the mark comes back unchanged, in any zone."""
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("create_dt", T.TimestampNTZType()),
                           T.StructField("update_dt", T.TimestampNTZType())])
    before, own = spark.conf.get("spark.sql.session.timeZone"), os.environ.get("TZ")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        os.environ["TZ"] = zone
        time.tzset()
        src = spark.sql("SELECT 'a' AS k, timestamp'2021-03-05 10:00:00Z' AS create_dt, timestamp'2021-03-06 10:00:00Z' AS update_dt, 1 AS more")
        assert dict(src.dtypes)["update_dt"] == "timestamp"
        with pytest.raises(TypeError):
            watermark.update_meta(extract.seed_meta(spark, ["t"]), src, "dwh", "t")
        typed = extract.conform(src, schema)
        meta = watermark.update_meta(extract.seed_meta(spark, ["t"]), typed, "dwh", "t")
        mark = extract.read_watermark(meta, "dwh", "t")
        assert mark == datetime(2021, 3, 6, 10)
        assert extract.delta_scan(typed, mark).count() == 0
        assert extract.delta_scan(typed, datetime(2021, 3, 6, 9, 59, 59)).count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
        os.environ.pop("TZ") if own is None else os.environ.update(TZ=own)
        time.tzset()


def test_source_columns_that_do_not_fit_raise(spark):
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("d", T.DateType())])
    assert extract.conform(spark.sql("SELECT 5 AS k, date'2020-01-01' AS d"), schema).dtypes == [("k", "string"), ("d", "date")]
    for sql in ("SELECT 'a' AS k", "SELECT 'a' AS k, 'text' AS d"):
        with pytest.raises(extract.SourceTypeError):
            extract.conform(spark.sql(sql), schema)


def test_char_padding_is_not_significant_in_the_batch(spark):
    """cards.account (char(20)) joins the accounts key after ingestion."""
    from histmart.plans.batch import _source_delta
    from histmart.schemas import ACCOUNTS, CARDS
    cards = spark.createDataFrame([("C1".ljust(20), "A1".ljust(20), datetime(2021, 3, 2), None)],
                                  "card_num string, account string, create_dt timestamp_ntz, update_dt timestamp_ntz")
    accts = spark.createDataFrame([("A1".ljust(20), date(2030, 1, 1), "K1", datetime(2021, 3, 2), None)],
                                  "account string, valid_to date, client string, create_dt timestamp_ntz, update_dt timestamp_ntz")
    dc, _ = _source_delta(cards, CARDS, datetime(2000, 1, 1))
    da, _ = _source_delta(accts, ACCOUNTS, datetime(2000, 1, 1))
    assert dc.join(da, "account_num").count() == 1
    assert dc.head().card_num == "C1"


def test_rows_are_compared_without_sorting_and_copies_of_staged_batches_collapse(spark):
    rows = cut_lineage(spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), ("c", 3), ("c", 4), (None, 5), (None, 5)], "k string, v int"))
    for staged in (False, True):
        good, differing = facts.one_per_key(rows, "k", staged)
        assert sorted(map(str, map(tuple, good.collect()))) == ["('a', 1)", "('b', 2)", "(None, 5)", "(None, 5)"]
        assert [r[0] for r in differing.collect()] == ["c"]
        assert "SortAggregate" not in good._jdf.queryExecution().executedPlan().toString()
    single = cut_lineage(rows.where("v in (2, 3)"))
    good, differing = facts.one_per_key(single, "k", staged=True)
    assert good.count() == 2 and differing.count() == 0
