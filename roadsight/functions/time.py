"""Calendar features of the violation timestamp (all built-in expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekend day names as produced by the "E" pattern, and the width
# of the hour-of-day windows.
WEEKEND_DAYS = ["Sat", "Sun"]
HOUR_WINDOW_WIDTH = 3


def parse_timestamp(c: Column) -> Column:
    """Text -> wall-clock timestamp; malformed text gives null (never raises).

    The cast is straight to a timestamp without zone, so the wall clock equals
    the text in any session zone, hours that a zone skips included.
    """
    return c.try_cast("timestamp_ntz")


def hour_of(ts: Column) -> Column:
    return F.hour(ts)


def weekday_abbr(ts: Column) -> Column:
    """Three-letter English day name (Mon..Sun)."""
    return F.date_format(ts, "E")


def month_of(ts: Column) -> Column:
    return F.month(ts)


def year_of(ts: Column) -> Column:
    return F.year(ts)


def day_type(weekday: Column) -> Column:
    """Weekend / Weekday.  A null weekday is not in the weekend list, so it
    falls to Weekday, as the original rule does."""
    return F.when(weekday.isin(WEEKEND_DAYS), F.lit("Weekend")).otherwise(F.lit("Weekday"))


def hour_window(hour: Column) -> Column:
    """Start hour of the 3-hour window: trunc(hour / 3) * 3."""
    return (hour / F.lit(HOUR_WINDOW_WIDTH)).cast("int") * F.lit(HOUR_WINDOW_WIDTH)


def day_end_inclusive(d) -> Column:
    """Last instant the date filter keeps for end day ``d``: d + 1 day - 1 s."""
    return (F.lit(d).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")
            - F.expr("INTERVAL 1 SECOND"))
