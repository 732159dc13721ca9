"""Column builders: every function takes columns and returns a column."""

from tripmart.functions.casts import default_to, safe_cast, safe_int, strict_cast
from tripmart.functions.codec import (
    bad_messages,
    decode_json,
    encode_json,
    format_ride,
    good_messages,
    message_faults,
)
from tripmart.functions.keys import surrogate_key, vendor_name
from tripmart.functions.times import (
    as_text,
    epoch_ms,
    from_epoch_ms,
    month_start,
    parse_time,
    trip_duration_minutes,
    trip_hours,
)

__all__ = [
    "as_text",
    "bad_messages",
    "decode_json",
    "good_messages",
    "message_faults",
    "default_to",
    "encode_json",
    "epoch_ms",
    "format_ride",
    "from_epoch_ms",
    "month_start",
    "parse_time",
    "safe_cast",
    "safe_int",
    "strict_cast",
    "surrogate_key",
    "trip_duration_minutes",
    "trip_hours",
    "vendor_name",
]
