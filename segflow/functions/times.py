"""Time stamps and calendar parts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_timestamp(year: Column, month: Column, day: Column, hour: Column) -> Column:
    """Time stamp of a count row; the year has two digits."""
    zero = F.lit(0)
    return F.make_timestamp(year + 2000, month, day, hour, zero, zero)


def epoch_seconds(text: Column) -> Column:
    """Text with a zone offset to seconds since 1970 in UTC; bad text is null."""
    return F.unix_seconds(F.try_to_timestamp(text))


def with_calendar(df: DataFrame, column: str = "measurement_tstamp") -> DataFrame:
    """Add year, month, day, hour and weekday (Monday 0), and turn the time
    stamp into epoch seconds. Rows without a time stamp are dropped."""
    ts = F.col(column)
    return df.where(ts.isNotNull()).withColumns(
        {
            "year": F.year(ts),
            "month": F.month(ts),
            "day": F.day(ts),
            "hour": F.hour(ts),
            "dayofweek": F.weekday(ts),
            column: F.unix_timestamp(ts),
        }
    )
