"""Calendar columns of the stored table."""

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_columns(wall: Column) -> dict[str, Column]:
    """Nine integer columns of a timestamp; ISO week and weekday, calendar year.

    `time` is the second of the day, despite its name.
    """
    return {
        "year": F.year(wall),
        "month": F.month(wall),
        "week": F.weekofyear(wall),
        "day": F.dayofmonth(wall),
        "hour": F.hour(wall),
        "minute": F.minute(wall),
        "weekday": F.weekday(wall) + 1,
        "time": F.hour(wall) * 3600 + F.minute(wall) * 60 + F.second(wall),
        "day_minute": F.hour(wall) * 60 + F.minute(wall),
    }


def iso_year() -> Column:
    """ISO year of the calendar columns year, month and week."""
    year, month, week = F.col("year"), F.col("month"), F.col("week")
    return year + F.when((month == 12) & (week == 1), 1).when((month == 1) & (week > 51), -1).otherwise(0)


def week_begin(year: Column, week: Column) -> Column:
    """Monday of an ISO week, as a date; the fourth of January always lies in week 1."""
    first = F.trunc(F.make_date(year, F.lit(1), F.lit(4)), "week")
    return F.date_add(first, (week.cast("int") - 1) * 7)


def months_of_week(year: int, week: int) -> list[tuple[int, int]]:
    """Calendar years and months in which an ISO week lies, two at most; none if the year has no such week."""
    try:
        first = datetime.date.fromisocalendar(year, week, 1)
    except ValueError:
        return []
    last = first + datetime.timedelta(days=6)
    return sorted({(first.year, first.month), (last.year, last.month)})
