"""Column expressions that turn raw extract text into typed warehouse columns.

Every function takes column names or ``Column`` objects and returns a
``Column`` built from Spark's own expressions, so projections stay inside
whole-stage code generation and filters on plain columns still reach the scan.

No function reads the clock. The time of a load is always the argument
``batch_ts``, so every stage of a load agrees on it and a rerun repeats it.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Literals the target tables are loaded with.
UNKNOWN_KEY = 999999999999
OPEN_BEGIN = "1990-01-01 00:00:00"
OPEN_END = "2099-12-31 00:00:00"
COMPACT_FORMAT = "yyyyMMddHHmmss"

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def timestamp_literal(value: str | datetime, dtype: str = "timestamp") -> Column:
    """A timestamp constant, read in the session time zone."""
    if isinstance(value, datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(value).cast(dtype)


def constant(value, dtype: str) -> Column:
    """A typed constant column; ``None`` gives a typed NULL."""
    return F.lit(value).cast(dtype)


def unknown_key() -> Column:
    """The key stored where a foreign key is not known yet."""
    return F.lit(UNKNOWN_KEY).cast("bigint")


def _strict(c: Column, value: Column, kind: str) -> Column:
    """``value``, which must not be NULL where ``c`` is not. The check is in the plan, so
    bad text fails a load whatever ``spark.sql.ansi.enabled`` says."""
    message = F.concat(F.lit("not a "), F.lit(kind), F.lit(": "), c.cast("string"))
    return F.when(c.isNotNull() & value.isNull(), F.raise_error(message)).otherwise(value)


def text_to_long(c: ColumnOrName, strict: bool = True, allow_hex: bool = False) -> Column:
    """Text to bigint. Bad text fails the load, or gives NULL if not ``strict``.

    ``allow_hex`` also reads ``0x1A`` style text.
    """
    c = col(c)
    number = c.try_cast("bigint")
    if not allow_hex:
        return _strict(c, number, "number") if strict else number
    digits = F.regexp_extract(c, r"^\s*[+-]?0[xX]([0-9a-fA-F]+)\s*$", 1)
    magnitude = F.conv(digits, 16, 10).cast("bigint")
    signed = F.when(F.ltrim(c).startswith("-"), -magnitude).otherwise(magnitude)
    either = F.when(F.length(digits) > 0, signed).otherwise(number)
    return _strict(c, either, "number") if strict else either


def text_to_timestamp(c: ColumnOrName, strict: bool = True) -> Column:
    c = col(c)
    value = c.try_cast("timestamp")
    return _strict(c, value, "timestamp") if strict else value


def parse_compact(c: ColumnOrName, strict: bool = True) -> Column:
    """``20191105120203`` to a timestamp."""
    c = col(c)
    value = F.try_to_timestamp(c, F.lit(COMPACT_FORMAT))
    return _strict(c, value, "timestamp") if strict else value


def zip5(c: ColumnOrName) -> Column:
    return F.substring(col(c), 1, 5)


def zip4(c: ColumnOrName) -> Column:
    """What follows the first five characters; a hyphen is kept."""
    return F.substring(col(c), 6, 9)


def area_code(c: ColumnOrName, strict: bool = True) -> Column:
    """First three characters of a phone number as a number."""
    return text_to_long(F.substring(col(c), 1, 3), strict)


def blank_to_zero(c: ColumnOrName) -> Column:
    """Empty text is 0, NULL stays NULL, anything else is cast."""
    c = col(c)
    return F.when(F.length(c) == 0, F.lit(0).cast("bigint")).otherwise(text_to_long(c))


def indicator(c: ColumnOrName, true_value: str = "Y") -> Column:
    """1 where the flag equals ``true_value``, else 0, also for NULL."""
    return F.when(col(c) == true_value, 1).otherwise(0)


def batch_number(ts: ColumnOrName) -> Column:
    """A timestamp as the number ``yyyyMMddHHmmss``."""
    return F.date_format(col(ts), COMPACT_FORMAT).cast("bigint")


def to_second(ts: ColumnOrName) -> Column:
    return F.date_trunc("second", col(ts))


def plus_days(ts: ColumnOrName, days: int = 1) -> Column:
    return col(ts) + F.expr(f"INTERVAL {int(days)} DAY")


def void_flag(begin: ColumnOrName, end: ColumnOrName) -> Column:
    """1 for a version that ends before it begins."""
    return F.when(col(begin) > col(end), 1).otherwise(0)
