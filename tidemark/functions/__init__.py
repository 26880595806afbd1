"""Column-returning helpers."""

from tidemark.functions.nulls import decode_null, encode_null, or_default
from tidemark.functions.rows import stamp
from tidemark.functions.text import (
    camel_case,
    is_json,
    json_field,
    strict_from_json,
    strict_json,
    url_parts,
    words,
)
from tidemark.functions.times import (
    date_labels,
    day_range,
    epoch_millis,
    epoch_seconds,
    epoch_to_text,
    format_epoch,
    half_month,
    hour_labels,
    midnight_after,
    slot_start,
    text_to_epoch,
)

__all__ = [
    "camel_case", "date_labels", "day_range", "decode_null", "encode_null",
    "epoch_millis", "epoch_seconds", "epoch_to_text", "format_epoch", "half_month",
    "hour_labels", "is_json", "json_field", "midnight_after", "or_default",
    "slot_start", "stamp", "strict_from_json", "strict_json", "text_to_epoch", "url_parts", "words",
]
