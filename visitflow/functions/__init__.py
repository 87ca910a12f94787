"""Column expressions used inside jobs (all JVM-side, no Python UDFs)."""

from .columns import (  # noqa: F401
    after, before, date_hour, day_before, run_date, date_hour_text, date_key, fill_two_digits, format_date,
    format_time, is_empty, is_not_empty, json_array_first, json_field, kv_get, kv_set,
    minute_key, parse_date_key, parse_time, ratio, round_half_up, seconds_between,
    trim_one_comma,
)
