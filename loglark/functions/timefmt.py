"""Time handling as native expressions (P2, P15; replaces the one Python UDF).

Log times look like ``[30/Jan/2019:00:00:21 +0800]``.  The text between the
first ``[`` and the last ``]`` is parsed as an instant and printed at minute
grain in an explicit output zone, so the result never depends on the session
or JVM zone.  Unparsable text gives NULL (the caller quarantines the row).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the source system's): the log time format, the
# minute format of ``formattime`` and the zone its examples are printed in.
LOG_TIME_PATTERN = "dd/MMM/yyyy:HH:mm:ss Z"
MINUTE_PATTERN = "yyyyMMddHHmm"
DEFAULT_ZONE = "+08:00"


def bracket_text(time_col: Column) -> Column:
    """Text from the first '[' to the last ']' (exclusive)."""
    return F.regexp_extract(time_col, r"\[(.*)\]", 1)


def parse_log_time(time_col: Column) -> Column:
    """Instant (TIMESTAMP) of a bracketed log time, NULL when malformed."""
    inner = bracket_text(time_col)
    return F.try_to_timestamp(F.nullif(inner, F.lit("")), F.lit(LOG_TIME_PATTERN))


def wall_clock(instant: Column, zone: str = DEFAULT_ZONE) -> Column:
    """TIMESTAMP_NTZ wall clock of an instant in ``zone`` (named or offset)."""
    utc_ntz = F.timestamp_add(
        "MICROSECOND", F.unix_micros(instant),
        F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_ntz)


def format_instant(instant: Column, zone: str = DEFAULT_ZONE) -> Column:
    """yyyyMMddHHmm of an instant in ``zone``."""
    return F.date_format(wall_clock(instant, zone), MINUTE_PATTERN)


def format_time(time_col: Column, zone: str = DEFAULT_ZONE) -> Column:
    """``formattime``: yyyyMMddHHmm of the log time in ``zone`` (M5)."""
    return format_instant(parse_log_time(time_col), zone)


def render_log_time(ts_ntz: Column, offset: str = "+0800") -> Column:
    """Inverse used by adapters and tests: wall clock -> ``[dd/MMM/yyyy:HH:mm:ss +0800]``."""
    return F.concat(F.lit("["), F.date_format(ts_ntz, "dd/MMM/yyyy:HH:mm:ss"), F.lit(" " + offset + "]"))


# Day / hour / minute of an order time ``yyyyMMddHHmmss`` (Spark is
# 1-based and takes a length).
def day_of(time_col: Column) -> Column:
    return F.substring(time_col, 1, 8)


def hour_of(time_col: Column) -> Column:
    return F.substring(time_col, 9, 2)


def minute_of(time_col: Column) -> Column:
    return F.substring(time_col, 11, 2)


def order_event_time(time_col: Column) -> Column:
    """Event time of an order (``yyyyMMddHHmm[ss]``) as TIMESTAMP_NTZ; NULL if
    the text is not 12 or 14 digits or not a calendar time.

    Built field by field so that no session zone is involved."""
    digits = time_col.rlike("^[0-9]{12}([0-9]{2})?$")
    part = lambda pos, n: F.substring(time_col, pos, n).try_cast("int")
    secs = F.when(F.length(time_col) == 14, part(13, 2)).otherwise(F.lit(0))
    ts = F.try_make_timestamp_ntz(part(1, 4), part(5, 2), part(7, 2), part(9, 2), part(11, 2),
                                  secs.cast("decimal(16,6)"))
    return F.when(digits, ts)


def ntz_as_utc_instant(ntz: Column) -> Column:
    """A wall clock read as UTC -> TIMESTAMP instant, whatever the session zone."""
    secs = (F.unix_date(ntz.cast("date")).cast("bigint") * 86400
            + F.hour(ntz) * 3600 + F.minute(ntz) * 60 + F.second(ntz))
    return F.timestamp_seconds(secs)
