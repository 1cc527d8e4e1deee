"""Calendar series, day densification and date attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def day_series(start: Column, end: Column) -> Column:
    """All days from start to end, both included (empty when the start lies after the end)."""
    return F.when(start <= end, F.sequence(start, end, F.make_dt_interval(F.lit(1)))).otherwise(
        F.array().cast("array<date>")
    )


def calendar_spine(bounds: DataFrame, start: str, end: str, out: str = "report_date") -> DataFrame:
    """One row per day between the two date columns of a one-row frame."""
    return bounds.select(F.explode(day_series(F.col(start), F.col(end))).alias(out))


def days_inclusive(start: Column | str, end: Column | str) -> Column:
    return F.datediff(end, start) + 1


def fill_gap_days(daily: DataFrame, keys: list[str], date: str, measures: list[str]) -> DataFrame:
    """Add the missing days between the first and last day of every key, with measures 0. Days must not be NULL.

    Each row is stretched up to the day before the next one, so no calendar join is needed and the
    rows stay partitioned by key for the window that follows.
    """
    by_key = Window.partitionBy(*keys).orderBy(date)
    upto = F.coalesce(F.date_sub(F.lead(date).over(by_key), 1), F.col(date))
    stretched = daily.withColumn("_upto", upto).withColumn(
        "_day", F.explode(day_series(F.col(date), F.col("_upto")))
    )
    zeroed = {m: F.when(F.col("_day") == F.col(date), F.col(m)).otherwise(F.lit(0)) for m in measures}
    return stretched.withColumns(zeroed).withColumn(date, F.col("_day")).drop("_day", "_upto")


def date_attributes(day: Column | str) -> dict[str, Column]:
    """Year to weekend flag for a date dimension; ISO week numbers, Saturday and Sunday as weekend."""
    day = F.col(day) if isinstance(day, str) else day
    return {
        "year": F.year(day),
        "quarter_number": F.quarter(day),
        "quarter": F.concat(F.lit("Q"), F.quarter(day).cast("string")),
        "month_number": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "year_month": F.date_format(day, "yyyy-MM"),
        "day_of_month": F.dayofmonth(day),
        "day_name": F.date_format(day, "EEEE"),
        "week_number": F.weekofyear(day),
        "weekend_flag": F.when(F.dayofweek(day).isin(1, 7), 1).otherwise(0),
    }


def shift_hours(ts: Column | str, hours: Column) -> Column:
    """Move a timestamp by a fractional number of hours, to the microsecond."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    seconds = F.round(hours * F.lit(3600.0), 6).cast("decimal(18,6)")
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def wall_micros(ts: Column | str) -> Column:
    """Microseconds of the wall-clock time since 1970, whatever the session time zone."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60
    micros = (F.extract(F.lit("SECOND"), ts) * 1000000).cast("bigint")
    return (F.unix_date(F.to_date(ts)).cast("bigint") * 86400 + seconds) * 1000000 + micros
