"""Build source extracts and daily landing files from the sf0.001 test tables
(test fixture: small files written through pandas)."""

from __future__ import annotations

import os
from datetime import date

from pyspark.sql import functions as F

from histmart.sources import testdata as td

SF = "/root/testdata/sf0.001"


def sources(spark, sf=SF, changed_clients=None):
    """accounts / cards / clients in the source layout (strings, create/update)."""
    c = spark.read.parquet(f"{sf}/customer.parquet")
    created = F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")
    none = F.lit(None).cast("timestamp_ntz")
    key = F.col("c_custkey").cast("string")
    accounts = c.select(key.alias("account"), td._day(F.floor(F.col("c_acctbal") / 100)).alias("valid_to"),
                        key.alias("client"), created.alias("create_dt"), none.alias("update_dt"))
    cards = c.select(key.alias("card_num"), key.alias("account"), created.alias("create_dt"),
                     none.alias("update_dt"))
    a = td._client_attrs(c.where(F.col("c_acctbal") >= td.DELETED_BALANCE))
    clients = a.select(F.col("client_id").cast("string").alias("client_id"), "last_name", "first_name",
                       "patronymic", "date_of_birth", "passport_num", "passport_valid_to", "phone",
                       created.alias("create_dt"), none.alias("update_dt"))
    if changed_clients is not None:
        ids, new_valid_to, upd = changed_clients
        hit = F.col("client_id").isin(ids)
        clients = clients.select(
            *[c2 for c2 in clients.columns if c2 not in ("passport_valid_to", "update_dt")],
            F.when(hit, F.lit(new_valid_to).cast("date")).otherwise(F.col("passport_valid_to"))
            .alias("passport_valid_to"),
            F.when(hit, F.lit(upd).cast("timestamp_ntz")).otherwise(F.col("update_dt")).alias("update_dt"))
    return {"accounts": accounts, "cards": cards, "clients": clients}


def write_day(spark, landing: str, d: date, sf=SF) -> None:
    os.makedirs(landing, exist_ok=True)
    tag = d.strftime("%d%m%Y")
    e = spark.read.parquet(f"{sf}/events.parquet").where(F.to_date("ts") == F.lit(d.isoformat()).cast("date"))
    tx = e.select(
        F.lpad(F.col("event_id").cast("string"), 11, "0").alias("transaction_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("transaction_date"),
        F.regexp_replace(F.col("value").cast("decimal(10,2)").cast("string"), r"\.", ",").alias("amount"),
        F.col("user_id").cast("string").alias("card_num"), F.col("event_type").alias("oper_type"),
        F.when(F.col("event_type") == "error", "REJECT").otherwise("SUCCESS").alias("oper_result"),
        F.get_json_object("props", "$.k").alias("terminal"))
    tx.toPandas().to_csv(f"{landing}/transactions_{tag}.txt", sep=";", index=False)
    t = td.terminals_hist(spark, sf).where(F.col("effective_to") == F.lit("9999-12-31").cast("timestamp_ntz"))
    t.select(F.col("terminal_id").cast("string"), "terminal_type", "terminal_city", "terminal_address") \
        .toPandas().to_csv(f"{landing}/terminals_{tag}.csv", sep=";", index=False)
    bl = td.blacklist(spark, sf).where(F.col("entry_dt") <= F.lit(d.isoformat()).cast("date"))
    bl.select(F.date_format("entry_dt", "yyyy-MM-dd").alias("entry_dt"), "passport_num") \
        .toPandas().to_csv(f"{landing}/passport_blacklist_{tag}.csv", sep=";", index=False)
