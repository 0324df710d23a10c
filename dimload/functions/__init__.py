from .scalars import (
    COMPACT_FORMAT,
    OPEN_BEGIN,
    OPEN_END,
    UNKNOWN_KEY,
    area_code,
    batch_number,
    blank_to_zero,
    constant,
    indicator,
    parse_compact,
    plus_days,
    text_to_long,
    text_to_timestamp,
    timestamp_literal,
    to_second,
    unknown_key,
    void_flag,
    zip4,
    zip5,
)

__all__ = [
    "COMPACT_FORMAT",
    "OPEN_BEGIN",
    "OPEN_END",
    "UNKNOWN_KEY",
    "area_code",
    "batch_number",
    "blank_to_zero",
    "constant",
    "indicator",
    "parse_compact",
    "plus_days",
    "text_to_long",
    "text_to_timestamp",
    "timestamp_literal",
    "to_second",
    "unknown_key",
    "void_flag",
    "zip4",
    "zip5",
]
