"""Domain schemas, sentinels and dimension specifications.

All timestamps are TIMESTAMP_NTZ (the warehouse stores timestamps without a
zone). Fixed-width ``char(n)`` source columns are modelled as strings and
right-trimmed at ingestion so that equality joins behave as in the source.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- fixed values of the warehouse model (must match for right results) ----
# open end of a version, live / tombstone flags, the gap between the end of a
# closed version and the start of its successor, rule codes of the mart.
OPEN_END_TEXT = "9999-12-31 00:00:00"
FLAG_LIVE = "N"
FLAG_DELETED = "Y"
CLOSE_GAP = "INTERVAL 1 DAY"
RULE_PASSPORT = 1
RULE_CONTRACT = 2
RULE_CITY_HOP = 3
WATERMARK_SEED_TEXT = "1900-01-01 00:00:00"
# ---------------------------------------------------------------------------

EFF_FROM = "effective_from"
EFF_TO = "effective_to"
DELETED = "deleted_flg"


def ts_lit(value) -> Column:
    """A TIMESTAMP_NTZ literal from a datetime/date/str (zone independent)."""
    if hasattr(value, "strftime"):
        fmt = "%Y-%m-%d %H:%M:%S" if hasattr(value, "hour") else "%Y-%m-%d 00:00:00"
        value = value.strftime(fmt)
    return F.lit(str(value)).cast(T.TimestampNTZType())


def date_lit(value) -> Column:
    if hasattr(value, "strftime"):
        value = value.strftime("%Y-%m-%d")
    return F.lit(str(value)[:10]).cast(T.DateType())


def open_end() -> Column:
    return ts_lit(OPEN_END_TEXT)


@dataclass(frozen=True)
class DimensionSpec:
    """What ``scd2_apply`` needs to know about one dimension."""

    name: str
    key: str
    attrs: tuple[str, ...]
    # source-side change-capture columns; None for snapshot dimensions
    created: str | None = "create_dt"
    updated: str | None = "update_dt"
    # source column name -> history column name
    renames: dict = field(default_factory=dict)
    # fixed-width char(n) columns (history names): padding is not significant
    char_columns: tuple[str, ...] = ()


def _ntz():
    return T.TimestampNTZType()


def _s(name, t=None):
    return T.StructField(name, t or T.StringType(), True)


HIST_TAIL = [_s(EFF_FROM, _ntz()), _s(EFF_TO, _ntz()), _s(DELETED)]

# ---- source extracts (change-captured relations) ----
ACCOUNTS_SRC = T.StructType([_s("account"), _s("valid_to", T.DateType()), _s("client"),
                             _s("create_dt", _ntz()), _s("update_dt", _ntz())])
CARDS_SRC = T.StructType([_s("card_num"), _s("account"),
                          _s("create_dt", _ntz()), _s("update_dt", _ntz())])
CLIENTS_SRC = T.StructType([_s("client_id"), _s("last_name"), _s("first_name"), _s("patronymic"),
                            _s("date_of_birth", T.DateType()), _s("passport_num"),
                            _s("passport_valid_to", T.DateType()), _s("phone"),
                            _s("create_dt", _ntz()), _s("update_dt", _ntz())])

# ---- landing files: every column read as text, typed afterwards ----
TRANSACTIONS_TXT = T.StructType([_s(c) for c in (
    "transaction_id", "transaction_date", "amount", "card_num",
    "oper_type", "oper_result", "terminal")])
TERMINALS_TXT = T.StructType([_s(c) for c in (
    "terminal_id", "terminal_type", "terminal_city", "terminal_address")])
BLACKLIST_TXT = T.StructType([_s("entry_dt"), _s("passport_num")])

# ---- warehouse tables ----
DIM_ACCOUNTS = T.StructType([_s("account_num"), _s("valid_to", T.DateType()), _s("client"), *HIST_TAIL])
DIM_CARDS = T.StructType([_s("card_num"), _s("account_num"), *HIST_TAIL])
DIM_CLIENTS = T.StructType([_s("client_id"), _s("last_name"), _s("first_name"), _s("patronymic"),
                            _s("date_of_birth", T.DateType()), _s("passport_num"),
                            _s("passport_valid_to", T.DateType()), _s("phone"), *HIST_TAIL])
DIM_TERMINALS = T.StructType([_s("terminal_id"), _s("terminal_type"), _s("terminal_city"),
                              _s("terminal_address"), *HIST_TAIL])
FACT_BLACKLIST = T.StructType([_s("passport_num"), _s("entry_dt", T.DateType())])
META = T.StructType([_s("schema_name"), _s("table_name"), _s("max_update_dt", _ntz())])

# ---- the four dimensions of the warehouse ----
ACCOUNTS = DimensionSpec("accounts", "account_num", ("valid_to", "client"),
                         renames={"account": "account_num"}, char_columns=("account_num",))
CARDS = DimensionSpec("cards", "card_num", ("account_num",), renames={"account": "account_num"},
                      char_columns=("card_num", "account_num"))
CLIENTS = DimensionSpec("clients", "client_id",
                        ("last_name", "first_name", "patronymic", "date_of_birth",
                         "passport_num", "passport_valid_to", "phone"),
                        char_columns=("phone", "passport_num"))
TERMINALS = DimensionSpec("terminals", "terminal_id",
                          ("terminal_type", "terminal_city", "terminal_address"),
                          created=None, updated=None)

