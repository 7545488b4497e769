"""Column helpers; every one is a built-in expression, so it stays inside codegen."""

from martlet.functions.dates import as_date, as_timestamp, hours_between, month_of
from martlet.functions.numbers import divide, money, outward, percent, to_long
from martlet.functions.text import (
    EMPTY_SHA256,
    digits,
    first_match,
    has_text,
    hash_json,
    hash_pii,
    json_decimal,
    json_long,
    json_text,
    mask_name,
    order_number,
    packed,
    query_param,
    trim_ws,
    unpacked,
)

__all__ = [
    "EMPTY_SHA256",
    "as_date",
    "as_timestamp",
    "digits",
    "divide",
    "first_match",
    "has_text",
    "hash_json",
    "hash_pii",
    "hours_between",
    "json_decimal",
    "json_long",
    "json_text",
    "mask_name",
    "money",
    "month_of",
    "order_number",
    "outward",
    "packed",
    "percent",
    "query_param",
    "to_long",
    "trim_ws",
    "unpacked",
]
