"""Column-level functions (JVM-side expressions only, no Python UDFs)."""

from stockroom.functions.json import json_fields, json_struct_fields, all_string_schema
from stockroom.functions.casts import (
    to_date, to_bool, decode, day_of, default_if_null, pad_open_end, flag_to_int,
    to_ts, ntz_lit, typed_lit,
)
from stockroom.functions.dates import day_array, days_between

__all__ = [
    "json_fields", "json_struct_fields", "all_string_schema",
    "to_date", "to_bool", "decode", "day_of", "default_if_null", "pad_open_end",
    "flag_to_int", "to_ts", "ntz_lit", "typed_lit", "day_array", "days_between",
]
