from feedloom.functions.dates import (
    date_any,
    date_compact,
    date_slash,
    days_between,
    epoch_date,
    file_date_chain,
    utc_date,
)
from feedloom.functions.numbers import safe_int, safe_number, safe_smallint
from feedloom.functions.text import (
    basename,
    blank_to_null,
    capture,
    content_hash,
    differs,
    drop_float_tail,
    empty_to_null,
    json_text,
    name_without_code,
    joined_name,
    trailing_code,
    zip_code,
)

__all__ = [
    "basename", "blank_to_null", "capture", "content_hash", "date_any", "date_compact",
    "date_slash", "days_between", "differs", "drop_float_tail", "empty_to_null", "epoch_date",
    "file_date_chain", "joined_name", "json_text", "name_without_code", "safe_int",
    "safe_number", "safe_smallint", "trailing_code", "utc_date", "zip_code",
]
