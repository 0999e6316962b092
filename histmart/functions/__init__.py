from .predicates import (attrs_differ, changed_since, expired_before, is_current,
                         not_current, on_day)
from .scalars import (batch_date_from_path, batch_text_to_date, day_of, decimal_comma_amount,
                      hour_component, minus_gap, null_skipping_concat,
                      rtrim_char, text_to_ts, trunc_to_second, ts_to_text)

__all__ = [
    "attrs_differ", "changed_since", "expired_before", "is_current", "not_current", "on_day",
    "batch_date_from_path", "batch_text_to_date", "day_of", "decimal_comma_amount",
    "hour_component", "minus_gap", "null_skipping_concat", "rtrim_char",
    "text_to_ts", "trunc_to_second", "ts_to_text",
]
