"""Day keys, hour stamps and weekday numbering (Sunday is 0)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY_FORMAT = "yyyyMMdd"


def parse_day(text: Column) -> Column:
    """``yyyyMMdd`` text to a timestamp without zone at midnight."""
    return F.to_timestamp_ntz(text, F.lit(DAY_FORMAT))


def day_key(stamp: Column) -> Column:
    return F.date_format(stamp, DAY_FORMAT)


def day_stamp(df: DataFrame, column: str = "fecha") -> Column:
    """The column as a midnight timestamp, whether it was loaded as text or as a timestamp."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return parse_day(F.col(column))
    return F.col(column).cast("timestamp_ntz")


def add_hours(stamp: Column, hours: Column) -> Column:
    zero = F.lit(0)
    return stamp + F.make_dt_interval(zero, hours, zero, zero.cast("decimal(18,6)"))


def day_of_week(stamp: Column) -> Column:
    return F.dayofweek(stamp) - F.lit(1)


def is_weekend(stamp: Column) -> Column:
    return day_of_week(stamp).isin(0, 6)


def weekday_name(number: Column) -> Column:
    """Lower-case English name of a Sunday-is-0 weekday number."""
    names = ["sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday"]
    return F.get(F.array(*map(F.lit, names)), number)


def date_parts(day: Column) -> list[Column]:
    """The three derived partition columns of every daily table."""
    return [
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
    ]


def day_text_parts(text: Column) -> list[Column]:
    """The same parts cut out of ``yyyyMMdd`` text."""
    return [
        F.substring(text, 1, 4).cast("int").alias("year"),
        F.substring(text, 5, 2).cast("int").alias("month"),
        F.substring(text, 7, 2).cast("int").alias("day"),
    ]
