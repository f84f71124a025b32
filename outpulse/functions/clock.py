"""Calendar and time-zone helpers.  Nothing here reads the wall clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from outpulse.functions.numeric import col


def moment(as_of: str) -> Column:
    return F.to_timestamp_ntz(F.lit(as_of))


def day(as_of: str) -> Column:
    return F.to_date(F.lit(as_of[:10]))


def monday_based(ts) -> Column:
    """0 = Monday ... 6 = Sunday (planning views)."""
    return F.weekday(col(ts))


def sunday_based(ts) -> Column:
    """1 = Sunday ... 7 = Saturday (layered tables)."""
    return F.dayofweek(col(ts))


def sunday_week(ts) -> Column:
    """Week of year 0..53, weeks starting on Sunday."""
    doy = F.dayofyear(col(ts))
    return F.floor((doy + 7 - F.dayofweek(col(ts))) / 7).cast("long")


def local(ts, tz) -> Column:
    """Wall-clock time in ``tz`` (a column or a literal) of a UTC instant."""
    zone = tz if isinstance(tz, Column) else F.lit(tz)
    return F.from_utc_timestamp(col(ts).cast("timestamp"), zone).cast("timestamp_ntz")


def to_utc(ts, tz) -> Column:
    zone = tz if isinstance(tz, Column) else F.lit(tz)
    return F.to_utc_timestamp(col(ts).cast("timestamp"), zone).cast("timestamp_ntz")


def days_between(later, earlier) -> Column:
    """Calendar days."""
    return F.datediff(col(later), col(earlier))


def whole_units(unit: str, earlier, later) -> Column:
    """Whole elapsed units (24-hour days for DAY)."""
    return F.timestamp_diff(unit, col(earlier), col(later))


def within_days(ts, as_of: str, days: int) -> Column:
    """as_of - days <= ts < as_of, as plain comparisons so scans can prune."""
    return (col(ts) >= F.expr(f"timestamp_ntz'{as_of}' - interval {days} days")) & (
        col(ts) < F.expr(f"timestamp_ntz'{as_of}'")
    )


def day_within(d, as_of: str, days: int) -> Column:
    return (col(d) >= F.expr(f"date'{as_of[:10]}' - {days}")) & (
        col(d) <= F.expr(f"date'{as_of[:10]}'")
    )


# Report time formats, tried in this order.
REPORT_FORMATS = (
    "MMM d, yyyy 'at' h:mm a",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "MM/dd/yyyy HH:mm",
    "MM/dd/yyyy",
    "yyyy-MM-dd",
)


def parse_report_time(text) -> Column:
    c = F.trim(col(text))
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in REPORT_FORMATS]).cast(
        "timestamp_ntz"
    )
