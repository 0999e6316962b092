"""Fraud rules and the fraud mart.

Plan shape (one report day or many):

* the dimension side is joined first, once: current card -> current account
  -> current client, plus the earliest blacklist entry per passport. This is
  the *card profile*; it is much smaller than the fact and is shared by all
  rules, so the fact side is joined once (on ``card_num``) instead of three
  times;
* the fact side is pruned to the report day(s) by a range predicate that
  reaches the Parquet scan;
* the profile and the terminal list are broadcast only after their size has
  been measured (``joins.sized_broadcast``); otherwise the joins stay shuffle
  joins and AQE splits a skewed card partition;
* R1 and R2 are row predicates on the same enriched row and are emitted in
  one pass; R3 needs consecutive operations of a card within a day. Only the
  narrow operation columns and the city go through that shuffle
  (``operators.sequence``); the profile is joined to R3's hits alone.

With ``report_dt=None`` every day present in the fact is reported as the
daily batch of that day would report it (report_dt = day of the operation).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.predicates import expired_before, on_day
from ..functions.scalars import day_of, hour_component, null_skipping_concat
from ..schemas import RULE_CITY_HOP, RULE_CONTRACT, RULE_PASSPORT, date_lit
from .joins import sized_broadcast, sized_broadcasts
from .scd2 import current_view
from .sequence import HOT_ROWS, hot_groups, with_next

MART_COLUMNS = ["event_dt", "passport", "fio", "phone", "event_type", "report_dt"]


def blacklist_since(blacklist: DataFrame) -> DataFrame:
    """Earliest listing date per passport. ``passport in (select ... where
    entry_dt <= d)`` is ``listed_since <= d``; pre-aggregating also collapses
    a passport listed several times (one report row per operation)."""
    return (blacklist.where(F.col("passport_num").isNotNull())
            .groupBy("passport_num").agg(F.min("entry_dt").alias("listed_since")))


def card_profile(cards_hist: DataFrame, accounts_hist: DataFrame, clients_hist: DataFrame,
                 blacklist: DataFrame | None = None) -> DataFrame:
    """J8 on the dimension side: every current card with its current
    account's contract end and its current client's identity."""
    c = current_view(cards_hist).select("card_num", "account_num")
    a = current_view(accounts_hist).select("account_num", "valid_to", "client")
    cl = current_view(clients_hist).select(
        "client_id", "passport_num", "passport_valid_to", "phone",
        null_skipping_concat("last_name", "first_name", "patronymic").alias("fio"))
    p = (c.join(a, "account_num")
         .join(cl, F.col("client") == F.col("client_id"))
         .select("card_num", "valid_to", "passport_num", "passport_valid_to", "fio", "phone"))
    unlisted = F.lit(None).cast(T.DateType()).alias("listed_since")
    if blacklist is None:
        return p.select("*", unlisted)
    # null passports match nothing: kept out of the join, where they would share one task
    return (p.where(F.col("passport_num").isNotNull()).join(blacklist_since(blacklist), "passport_num", "left")
            .unionByName(p.where(F.col("passport_num").isNull()).select("*", unlisted)))


def _report_days(tx: DataFrame, report_dt) -> DataFrame:
    t = tx.select("trans_id", "trans_date", "card_num", "terminal")
    if report_dt is None:
        return t.withColumn("report_dt", day_of("trans_date"))
    d = date_lit(report_dt)
    return t.where(on_day("trans_date", d)).withColumn("report_dt", d)


def enriched_tx(tx: DataFrame, profile: DataFrame, report_dt=None) -> DataFrame:
    """P5 -> J8: operations of the report day(s) with their client profile."""
    return _report_days(tx, report_dt).join(sized_broadcast(profile), "card_num")


def _terminal_city(terminals_hist: DataFrame) -> DataFrame:
    """One city per current terminal id."""
    return current_view(terminals_hist).groupBy(F.col("terminal_id").alias("terminal")) \
        .agg(F.min("terminal_city").alias("terminal_city"))


def with_terminal_city(tx: DataFrame, terminals_hist: DataFrame) -> DataFrame:
    """Inner join to the current terminal; unknown terminals drop out."""
    return tx.join(sized_broadcast(_terminal_city(terminals_hist)), "terminal")


def _to_mart(df: DataFrame, event_dt: str, event_type) -> DataFrame:
    et = F.lit(event_type) if isinstance(event_type, int) else event_type
    return df.select(F.col(event_dt).alias("event_dt"), F.col("passport_num").alias("passport"),
                     "fio", "phone", et.cast(T.ShortType()).alias("event_type"), "report_dt")


def passport_bad():  # R1 predicate: expired (strict) or listed by the report day
    return (expired_before("passport_valid_to", F.col("report_dt"))
            | (F.col("listed_since") <= F.col("report_dt")))


def _contract_over(through_day: bool = False):
    """R2 predicate: operation after the start of the contract's last day, or
    with ``through_day`` (Q15) after that day."""
    if through_day:
        return day_of("trans_date") > F.col("valid_to")
    return F.col("trans_date") > F.col("valid_to").cast(T.TimestampNTZType())


def rule_passport(enriched: DataFrame) -> DataFrame:
    """Operation with an expired or blacklisted passport."""
    return _to_mart(enriched.where(passport_bad()), "trans_date", RULE_PASSPORT)


def rule_contract(enriched: DataFrame, through_day: bool = False) -> DataFrame:
    """R2: operation under an expired contract."""
    return _to_mart(enriched.where(_contract_over(through_day)), "trans_date", RULE_CONTRACT)


def _pairs(tx: DataFrame, cards: DataFrame, city: DataFrame, report_dt, hot_rows: int,
           bucket_minutes: int, lookback: bool = False) -> DataFrame:
    if lookback:  # Q16: the hour before the report day, as part of its sequences
        if report_dt is None:
            raise ValueError("lookback needs a report day")
        start = date_lit(report_dt).cast(T.TimestampNTZType())
        ops = tx.select("trans_id", "trans_date", "card_num", "terminal").where(
            (F.col("trans_date") >= start - F.expr("INTERVAL 1 HOUR")) & (F.col("trans_date") < start + F.expr("INTERVAL 1 DAY"))) \
            .withColumn("report_dt", date_lit(report_dt))
    else:
        ops = _report_days(tx, report_dt)
    hot = hot_groups(ops.where(F.col("card_num").isNotNull()), ["card_num", "report_dt"], hot_rows)
    known = ops.join(city, "terminal").join(cards, "card_num", "left_semi") \
        .select("trans_id", "trans_date", "card_num", "report_dt", "terminal_city")
    return with_next(known, ["card_num", "report_dt"], "trans_date", "trans_id",
                     ["trans_date", "terminal_city"], hot=hot, bucket_minutes=bucket_minutes)


def city_hop_pairs(tx: DataFrame, profile: DataFrame, terminals_hist: DataFrame, report_dt=None,
                   hot_rows: int = HOT_ROWS, bucket_minutes: int = 1) -> DataFrame:
    """Each operation of a known card at a known terminal with the next
    such operation of the card on the same day (ties broken by ``trans_id``)."""
    cards, city = sized_broadcasts((profile.select("card_num"), False), (_terminal_city(terminals_hist), False))
    return _pairs(tx, cards, city, report_dt, hot_rows, bucket_minutes)


def _city_hops(pairs: DataFrame, profile: DataFrame) -> DataFrame:
    hit = (F.col("next_trans_date").isNotNull()
           & (hour_component("next_trans_date", "trans_date") == 0)
           & (day_of("next_trans_date") == F.col("report_dt"))
           & (F.col("terminal_city") != F.col("next_terminal_city")))
    return _to_mart(pairs.where(hit).join(profile, "card_num"), "next_trans_date", RULE_CITY_HOP)


def rule_city_hop(tx: DataFrame, profile: DataFrame, terminals_hist: DataFrame, report_dt=None,
                  hot_rows: int = HOT_ROWS, bucket_minutes: int = 1, lookback: bool = False) -> DataFrame:
    """The next operation of the card is in another city less than an
    hour later (same day, or with ``lookback`` also across midnight); the
    event is the second operation."""
    profile, city = sized_broadcasts((profile, False), (_terminal_city(terminals_hist), False))
    pairs = _pairs(tx, profile.select("card_num"), city, report_dt, hot_rows, bucket_minutes, lookback)
    return _city_hops(pairs, profile)


def rules_passport_contract(enriched: DataFrame, through_day: bool = False) -> DataFrame:
    """R1 and R2 in one pass over the enriched rows."""
    codes = F.filter(F.array(F.when(passport_bad(), F.lit(RULE_PASSPORT)),
                             F.when(_contract_over(through_day), F.lit(RULE_CONTRACT))),
                     lambda c: c.isNotNull())
    return _to_mart(enriched.withColumn("__rule", F.explode(codes)), "trans_date", F.col("__rule"))


def fraud_mart(tx: DataFrame, profile: DataFrame, terminals_hist: DataFrame, report_dt=None,
               hot_rows: int = HOT_ROWS, bucket_minutes: int = 1, through_day: bool = False,
               lookback: bool = False) -> DataFrame:
    """The three rules appended into one mart relation. R1 and R2 come
    from the joined rows without any fact shuffle (with a broadcast profile),
    R3 from the narrow sequence; the sides are computed and measured once."""
    profile, city = sized_broadcasts((profile, False), (_terminal_city(terminals_hist), False))
    r12 = rules_passport_contract(_report_days(tx, report_dt).join(profile, "card_num"), through_day)
    pairs = _pairs(tx, profile.select("card_num"), city, report_dt, hot_rows, bucket_minutes, lookback)
    return r12.unionByName(_city_hops(pairs, profile))
