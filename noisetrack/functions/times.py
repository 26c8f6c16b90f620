"""Times on columns: UTC, seconds since 1970 as doubles or longs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NIGHT_START, NIGHT_END = 22, 6
RUSH_HOURS = (7, 8, 9, 17, 18, 19)


def time_features(df: DataFrame, column: str = "timestamp", tz: str | None = None) -> DataFrame:
    """hour, day_of_week (Monday 0), is_night, is_rush_hour and is_weekend of a timestamp, in UTC unless ``tz`` is given."""
    t = F.from_utc_timestamp(F.col(column), tz) if tz else F.col(column)
    hour, day = F.hour(t), F.weekday(t)
    return df.withColumns(
        {
            "hour": hour,
            "day_of_week": day,
            "is_night": ((hour >= NIGHT_START) | (hour < NIGHT_END)).cast("int"),
            "is_rush_hour": hour.isin(*RUSH_HOURS).cast("int"),
            "is_weekend": (day >= 5).cast("int"),
        }
    )


def parse_iso(text: Column) -> Column:
    """Z, +0000, +00:00 or none (UTC); what can't be read is null."""
    return F.try_to_timestamp(F.nullif(F.trim(text), F.lit("")))


def epoch_seconds(t: Column) -> Column:
    """With its fraction."""
    return F.unix_micros(t) / 1e6


def windows_of_day(day: Column, minutes: int, now: Column) -> Column:
    """Array of half-open windows [start, stop) of a day; none starts at or after ``now``, only the day's end cuts one off."""
    start = day.cast("timestamp")
    stop = F.timestamp_add("DAY", F.lit(1), start)
    starts = F.filter(F.sequence(start, stop, F.make_dt_interval(mins=F.lit(minutes))), lambda s: (s < stop) & (s < now))
    return F.transform(starts, lambda s: F.struct(s.alias("start"), F.least(F.timestamp_add("MINUTE", F.lit(minutes), s), stop).alias("stop")))


def days_back(end: Column, n: int) -> Column:
    """Array of ``n`` days up to and with ``end``, ascending."""
    return F.sequence(F.date_sub(end, n - 1), end)
