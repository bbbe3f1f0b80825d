"""Time keys derived from epoch millis and ``yyyy-MM-dd HH:mm:ss`` strings.

All of these are plain Catalyst expressions, so they stay inside whole-stage codegen.
Dates and hours follow the session time zone (``spark.sql.session.timeZone``).
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

MS_PER_YEAR_NO_LEAP = 1000 * 60 * 60 * 24 * 365


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ms_to_ts(ms) -> Column:
    """Epoch millis (long) -> TIMESTAMP."""
    return F.timestamp_millis(_c(ms))


def ts_to_ms(ts) -> Column:
    """TIMESTAMP (or TIMESTAMP_NTZ read as wall clock in the session zone) -> epoch millis."""
    return F.unix_millis(_c(ts).cast("timestamp"))


def log_date(ms) -> Column:
    """Epoch millis -> ``yyyy-MM-dd``."""
    return F.date_format(ms_to_ts(ms), "yyyy-MM-dd")


def log_hour(ms) -> Column:
    """Epoch millis -> zero-padded hour ``HH``."""
    return F.date_format(ms_to_ts(ms), "HH")


def create_date(create_time) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` -> date part, split on the space (no parsing)."""
    return F.split(_c(create_time), " ").getItem(0)


def create_hour(create_time) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` -> hour part, split on space then on ``:``."""
    return F.split(F.split(_c(create_time), " ").getItem(1), ":").getItem(0)


def age_in_years(birthday, as_of) -> Column:
    """Whole years between a ``yyyy-MM-dd`` birthday and ``as_of`` (a timestamp column),
    counted as elapsed milliseconds divided by a 365-day year (leap days are ignored,
    which is the upstream rule)."""
    elapsed = ts_to_ms(as_of) - F.unix_millis(F.to_timestamp(_c(birthday), "yyyy-MM-dd"))
    # long division truncating toward zero, as the upstream integer arithmetic does
    return (elapsed / F.lit(MS_PER_YEAR_NO_LEAP)).cast("long").cast("int")


def floor_to(ms, step_ms: int) -> Column:
    """Largest multiple of ``step_ms`` not above ``ms`` (exact integer arithmetic)."""
    return _c(ms) - F.pmod(_c(ms), F.lit(step_ms).cast("long"))


def minute_bucket(ms) -> Column:
    """Epoch millis -> epoch minute (``ms div 60000``, floored)."""
    return (floor_to(ms, 60000) / F.lit(60000)).cast("long")
