"""Wall-clock timestamps and calendar columns.

Timestamps are local wall clock and stay ``timestamp_ntz`` throughout, so that
an hour skipped by a daylight-saving change in the session zone stays itself.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Day names in the order of ``weekday()``, which starts on Monday.
DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def day_name(date: Column) -> Column:
    """English day name from the date alone; ``date_format`` would go through the session zone.

    The condition keeps a null date null: Spark takes ``element_at`` of an array
    without nulls to be never null, whatever the index.
    """
    names = F.array(*[F.lit(d) for d in DAY_NAMES])
    return F.when(date.isNotNull(), F.element_at(names, F.weekday(date) + 1))


def parse_timestamp(text: Column) -> Column:
    """Text to wall-clock timestamp; null where it is not one."""
    return text.try_cast("timestamp_ntz")


def wall_clock(moment: datetime) -> Column:
    """Literal of a wall-clock time; a plain literal would pass through the zones of Python and session."""
    return F.lit(moment.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")


def with_calendar(df: DataFrame, timestamp: str = "timestamp") -> DataFrame:
    """Add date, year, month, day, hour and English day name."""
    ts = F.col(timestamp)
    return df.withColumns(
        {
            "date": ts.cast("date"),
            "year": F.year(ts),
            "month": F.month(ts),
            "day": F.dayofmonth(ts),
            "hour": F.hour(ts),
            "day_of_week": day_name(ts.cast("date")),
        }
    )
