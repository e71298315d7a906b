"""Column functions. Every one returns a Column built from JVM expressions; there are no UDFs."""

from pitchflow.functions.scalar import (
    blank_to_null,
    card_color,
    epoch_ms_to_ntz,
    event_id,
    event_time,
    full_name,
    join_ids,
    name_key,
    percent_to_number,
    side_label,
    to_ntz_seconds,
    try_to_number,
    utf8_text,
)
from pitchflow.functions.variant import (
    array_size,
    as_variant,
    decode_message,
    elements,
    field_path,
    is_object,
    jget,
    number,
    parsed,
    safe_path,
    try_jget,
    wrap_bad_json,
)

__all__ = [
    "array_size",
    "as_variant",
    "blank_to_null",
    "card_color",
    "decode_message",
    "elements",
    "epoch_ms_to_ntz",
    "event_id",
    "event_time",
    "field_path",
    "full_name",
    "is_object",
    "jget",
    "join_ids",
    "name_key",
    "number",
    "parsed",
    "percent_to_number",
    "safe_path",
    "side_label",
    "to_ntz_seconds",
    "try_jget",
    "try_to_number",
    "utf8_text",
    "wrap_bad_json",
]
