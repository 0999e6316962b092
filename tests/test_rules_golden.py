"""Fraud rule golden cases (report day 2021-03-03), hand-computed."""

from datetime import date, datetime

import pytest

from histmart.operators import rules
from histmart.schemas import DIM_ACCOUNTS, DIM_CARDS, DIM_CLIENTS, DIM_TERMINALS

OPEN = datetime(9999, 12, 31)
START = datetime(2020, 1, 1)
RD = date(2021, 3, 3)
TX_SCHEMA = "trans_id string, trans_date timestamp_ntz, card_num string, terminal string"


def ts(h, m=0, s=0, day=3):
    return datetime(2021, 3, day, h, m, s)


class World:
    """Builds current card -> account -> client chains for the cases."""

    def __init__(self):
        self.cards, self.accounts, self.clients, self.tx = [], [], [], []
        self.n = 0

    def client(self, name, passport_valid_to=None, patronymic="P", valid_to=date(2030, 1, 1),
               card_flag=None):
        self.n += 1
        i = str(self.n)
        c, a, cl = f"card{i}", f"acc{i}", f"cl{i}"
        if card_flag == "closed":
            self.cards.append((c, a, START, datetime(2021, 1, 1), "N"))
        elif card_flag == "tomb":
            self.cards.append((c, a, START, OPEN, "Y"))
        else:
            self.cards.append((c, a, START, OPEN, "N"))
        self.accounts.append((a, valid_to, cl, START, OPEN, "N"))
        self.clients.append((cl, name, "Ann", patronymic, date(1990, 1, 1), f"PP{i}",
                             passport_valid_to, "+70000000000", START, OPEN, "N"))
        return c, f"PP{i}"

    def op(self, card, when, terminal="T1"):
        self.tx.append((f"tx{len(self.tx):04d}", when, card, terminal))

    def frames(self, spark):
        return (spark.createDataFrame(self.tx, TX_SCHEMA),
                spark.createDataFrame(self.cards, DIM_CARDS),
                spark.createDataFrame(self.accounts, DIM_ACCOUNTS),
                spark.createDataFrame(self.clients, DIM_CLIENTS))


def _mart(df):
    return sorted((r.event_dt, r.passport, r.event_type) for r in df.collect())


def test_r1_passport(spark):
    w = World()
    c1, _ = w.client("Eq", passport_valid_to=date(2021, 3, 3))
    c2, p2 = w.client("Exp", passport_valid_to=date(2021, 3, 2))
    c3, _ = w.client("NullNotListed")
    c4, p4 = w.client("NullListed")
    c5, _ = w.client("ListedLater")
    c6, p6 = w.client("ExpTwice", passport_valid_to=date(2021, 1, 1))
    c7, _ = w.client("ClosedCard", passport_valid_to=date(2021, 1, 1), card_flag="closed")
    c8, _ = w.client("TombCard", passport_valid_to=date(2021, 1, 1), card_flag="tomb")
    c9, _ = w.client("ExpYesterday", passport_valid_to=date(2021, 1, 1))
    for c in (c1, c2, c3, c4, c5, c6, c7, c8):
        w.op(c, ts(10))
    w.op(c6, ts(11))
    w.op(c9, ts(10, day=2))
    tx, cards, accounts, clients = w.frames(spark)
    bl = spark.createDataFrame([(p4, date(2021, 3, 3)), ("PP5", date(2021, 3, 4)),
                                (p6, date(2021, 2, 1)), (p6, date(2021, 2, 2))],
                               "passport_num string, entry_dt date")
    prof = rules.card_profile(cards, accounts, clients, bl)
    got = _mart(rules.rule_passport(rules.enriched_tx(tx, prof, RD)))
    assert got == sorted([(ts(10), p2, 1), (ts(10), p4, 1), (ts(10), p6, 1), (ts(11), p6, 1)])
    # every-day mode reports the same rows for that day
    every = rules.rule_passport(rules.enriched_tx(tx, prof, None)).where(f"report_dt = '{RD}'")
    assert _mart(every) == got


def test_fio_keeps_blanks_of_null_parts(spark):
    w = World()
    c, _ = w.client("Smith", passport_valid_to=date(2021, 1, 1), patronymic=None)
    w.op(c, ts(9))
    tx, cards, accounts, clients = w.frames(spark)
    prof = rules.card_profile(cards, accounts, clients)
    [row] = rules.rule_passport(rules.enriched_tx(tx, prof, RD)).collect()
    assert row.fio == "Smith Ann "
    assert row.event_type == 1 and row.report_dt == RD


def test_r2_contract_boundary(spark):
    w = World()
    c1, p1 = w.client("A", valid_to=date(2021, 3, 3))
    c2, p2 = w.client("B", valid_to=date(2021, 3, 3))
    c3, _ = w.client("C", valid_to=None)
    w.op(c1, ts(0, 0, 0))
    w.op(c2, ts(0, 0, 1))
    w.op(c3, ts(12))
    tx, cards, accounts, clients = w.frames(spark)
    prof = rules.card_profile(cards, accounts, clients)
    got = _mart(rules.rule_contract(rules.enriched_tx(tx, prof, RD)))
    assert got == [(ts(0, 0, 1), p2, 2)]


R3_CASES = [
    # (operations [(time, terminal)], expected event times)
    ([(ts(10), "TX"), (ts(10, 59, 59), "TY")], [ts(10, 59, 59)]),
    ([(ts(10), "TX"), (ts(11), "TY")], []),
    ([(ts(10), "TX"), (ts(10, 30), "TX")], []),
    ([(ts(10), "TX"), (ts(10, 20), "TX"), (ts(10, 50), "TY")], [ts(10, 50)]),
    ([(ts(10), "TX"), (ts(10, 30), "TY"), (ts(10, 50), "TX")], [ts(10, 30), ts(10, 50)]),
    ([(ts(10), "TX"), (ts(10, 10), "T??"), (ts(10, 20), "TY")], [ts(10, 20)]),
    ([(ts(23, 50, day=2), "TX"), (ts(0, 10), "TY")], []),
]


def _terminals(spark):
    return spark.createDataFrame([
        ("TX", "POS", "X", "a", START, OPEN, "N"),
        ("TY", "POS", "Y", "b", START, OPEN, "N"),
        ("TY", "POS", "X", "b", START, datetime(2019, 1, 1), "N"),
    ], DIM_TERMINALS)


@pytest.mark.parametrize("ops,expected", R3_CASES)
def test_r3_city_hop(spark, ops, expected):
    w = World()
    c, p = w.client("Hop")
    for when, term in ops:
        w.op(c, when, term)
    tx, cards, accounts, clients = w.frames(spark)
    prof = rules.card_profile(cards, accounts, clients)
    got = _mart(rules.rule_city_hop(tx, prof, _terminals(spark), RD))
    assert got == sorted((t, p, 3) for t in expected)


def test_r3_partition_is_the_card(spark):
    w = World()
    c1, _ = w.client("Two")
    w.op(c1, ts(10), "TX")
    w.accounts.append(("acc1b", date(2030, 1, 1), "cl1", START, OPEN, "N"))
    w.cards.append(("card1b", "acc1b", START, OPEN, "N"))
    w.op("card1b", ts(10, 20), "TY")
    tx, cards, accounts, clients = w.frames(spark)
    prof = rules.card_profile(cards, accounts, clients)
    assert rules.rule_city_hop(tx, prof, _terminals(spark), RD).count() == 0


def test_mart_union_and_one_pass_r1_r2(spark):
    w = World()
    c, p = w.client("Both", passport_valid_to=date(2021, 1, 1), valid_to=date(2021, 1, 1))
    w.op(c, ts(10), "TX")
    w.op(c, ts(10, 30), "TY")
    tx, cards, accounts, clients = w.frames(spark)
    prof = rules.card_profile(cards, accounts, clients)
    mart = rules.fraud_mart(tx, prof, _terminals(spark), RD)
    assert _mart(mart) == sorted([(ts(10), p, 1), (ts(10, 30), p, 1), (ts(10), p, 2),
                                  (ts(10, 30), p, 2), (ts(10, 30), p, 3)])
    assert mart.columns == rules.MART_COLUMNS
    assert dict(mart.dtypes)["event_type"] == "smallint"


def test_options_end_of_day_and_lookback(spark):
    """Q15: a contract holds through its last day. Q16: pairs across midnight count."""
    w = World()
    c, p = w.client("Opt", valid_to=RD)
    w.op(c, ts(23, 50, day=2), "TX")
    w.op(c, ts(0, 10), "TY")
    w.op(c, ts(12), "TY")
    tx, cards, accounts, clients = w.frames(spark)
    prof = rules.card_profile(cards, accounts, clients)
    args = (tx, prof, _terminals(spark), RD)
    assert _mart(rules.fraud_mart(*args)) == sorted([(ts(0, 10), p, 2), (ts(12), p, 2)])
    assert _mart(rules.fraud_mart(*args, through_day=True)) == []
    assert _mart(rules.fraud_mart(*args, through_day=True, lookback=True)) == [(ts(0, 10), p, 3)]
    with pytest.raises(ValueError):
        rules.rule_city_hop(tx, prof, _terminals(spark), lookback=True)
