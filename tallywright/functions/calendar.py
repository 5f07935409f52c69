"""Calendar expressions: weeks start on Monday."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.functions import fixed


def month_key(c: Column) -> Column:
    """``yyyy-MM``, put together from numbers where the year has four digits: a formatter costs several times as much."""
    day = c.cast("date")
    plain = F.concat_ws("-", F.year(day).cast("string"), F.lpad(F.month(day).cast("string"), 2, "0"))
    return F.when(F.year(day).between(1000, 9999), plain).otherwise(F.date_format(c, "yyyy-MM"))


def week_start(c: Column) -> Column:
    """The Monday of the week, counted in days, without going through a timestamp."""
    day = c.cast("date")
    return F.date_sub(day, F.weekday(day))


def in_window(c: Column, start: str = fixed.WINDOW_START, end: str = fixed.WINDOW_END) -> Column:
    """False for null and for days outside ``start``..``end`` inclusive."""
    day = c.cast("date")
    return F.coalesce(day.between(F.lit(start).cast("date"), F.lit(end).cast("date")), F.lit(False))


def recent_flag(c: Column, end: str = fixed.WINDOW_END, days: int = fixed.RECENT_DAYS) -> Column:
    """True for the ``days`` days that end with the fixed day ``end``."""
    return c.cast("date") >= F.date_sub(F.lit(end).cast("date"), days - 1)


def period_label(recent: Column, recent_name: str = fixed.RECENT_PERIOD, earlier_name: str = fixed.EARLIER_PERIOD) -> Column:
    return F.when(recent, recent_name).otherwise(earlier_name)


def with_complete_week(
    df: DataFrame, date_col: str, week_col: str = "week_start", flag: str = "is_complete_week",
    span: DataFrame | None = None,
) -> DataFrame:
    """Flag rows of weeks that lie wholly inside the span of dates in ``df``, or in ``span``.

    The span is one min/max aggregate over the date column alone, read as a scalar
    subquery; no row is moved to compute the flag.
    """
    ends = F.struct(F.min(date_col).cast("date").alias("lo"), F.max(date_col).cast("date").alias("hi"))
    bounds = (df if span is None else span).agg(ends.alias("ends")).scalar()
    first, last = bounds["lo"], bounds["hi"]
    rolled = F.next_day(F.date_sub(first, 1), "Mon")
    week = F.col(week_col)
    return df.withColumn(flag, (week >= rolled) & (F.date_add(week, 6) <= last))


def calendar(df: DataFrame, date_col: str) -> DataFrame:
    """One row per date that occurs, with its calendar attributes."""
    day = F.col("date_key")
    return df.select(F.col(date_col).cast("date").alias("date_key")).where(day.isNotNull()).distinct().select(
        day,
        F.year(day).alias("calendar_year"),
        F.month(day).alias("calendar_month"),
        F.date_format(day, "MMMM").alias("month_name"),
        month_key(day).alias("year_month"),
        week_start(day).alias("week_start"),
        F.weekday(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
    )
