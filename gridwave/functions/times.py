"""Time conversions used by decode, encode and pairing (column expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridwave import constants as C


def micros_truncated(seconds: Column) -> Column:
    """Seconds (double) -> integer microseconds, truncating toward zero."""
    return (seconds * F.lit(1e6)).cast("bigint")


def sample_micros(start_us: Column, seconds: Column) -> Column:
    """Start (epoch us) plus fractional seconds, rounded to the microsecond."""
    return start_us + F.round(seconds * F.lit(1e6)).cast("bigint")


def to_timestamps(micros: Column) -> Column:
    """array<bigint epoch us> -> array<timestamp>, without a double detour."""
    return F.transform(micros, lambda x: F.timestamp_micros(x))


def trigger_time(start: Column, offset_ms: int = C.TRIGGER_OFFSET_MS) -> Column:
    return start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(offset_ms / 1000.0))


def within(t_left: Column, t_right: Column, tolerance: str) -> Column:
    """|t_left - t_right| <= tolerance, written as a two-sided range.

    The range form lets the streaming join derive state eviction from the
    watermarks; ``abs(a - b)`` does not.
    """
    interval = F.expr(f"INTERVAL {tolerance}")
    return (t_right >= t_left - interval) & (t_right <= t_left + interval)


def cfg_timestamp_text(ts: Column) -> Column:
    """Timestamp as written in a cfg file: ``dd/mm/yyyy,hh:mm:ss.ffffff``."""
    return F.date_format(ts, "dd/MM/yyyy,HH:mm:ss.SSSSSS")


# day/month/year with one or two digits, year of two or four, fraction of 0 to 9 digits
CFG_TIMESTAMP = (r"^\s*(\d{1,2})/(\d{1,2})/(\d{4}|\d{2})\s*,"
                 r"\s*(\d{1,2}):(\d{1,2}):(\d{1,2})(?:\.(\d{0,9}))?\s*$")
CENTURY_PIVOT = 70      # two-digit years from here on are 19yy, below 20yy


def parse_cfg_timestamp(text: Column) -> Column:
    """Inverse of :func:`cfg_timestamp_text` for every spelling the format allows.

    Digits beyond microseconds are cut off; text that is no time gives null.
    """
    fields = F.split(F.regexp_replace(text, CFG_TIMESTAMP, "$1,$2,$3,$4,$5,$6,$7"), ",")

    def made(f: Column) -> Column:
        year = F.get(f, 2).try_cast("int")
        full_year = F.when(F.length(F.get(f, 2)) == 4, year).when(year < CENTURY_PIVOT, year + 2000) \
            .otherwise(year + 1900)
        micros = F.substring(F.rpad(F.get(f, 6), 6, "0"), 1, 6).try_cast("int")
        seconds = F.get(f, 5).try_cast("int").cast("decimal(16,6)") + (micros / F.lit(1e6)).cast("decimal(16,6)")
        month, day, hour, minute = (F.get(f, i).try_cast("int") for i in (1, 0, 3, 4))
        return F.try_make_timestamp(full_year, month, day, hour, minute, seconds)

    # Through a lambda, so that the split is one value and not eight copies of its code.
    whole = F.array(F.when(text.rlike(CFG_TIMESTAMP), fields))
    return F.element_at(F.transform(whole, made), 1)
