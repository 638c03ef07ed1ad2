from .parsing import (
    item_from_ad, item_of_click, parse_iso_ts, parse_order_time, parsed_once, raw_field, safe_double, safe_int, split_key_values,
    text_fields, typed_fields, unconvertible,
)
from .timing import closed_hours, epoch_us, from_epoch_us, micros, time_bucket
from .ratios import ratio

__all__ = [
    "closed_hours", "epoch_us", "from_epoch_us", "item_from_ad", "item_of_click", "micros",
    "parse_iso_ts", "parse_order_time", "parsed_once", "ratio", "raw_field", "safe_double", "safe_int",
    "split_key_values", "text_fields", "time_bucket", "typed_fields", "unconvertible",
]
