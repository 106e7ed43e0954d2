"""Calendar columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(moment: Column) -> Column:
    """A date or timestamp as the integer yyyyMMdd."""
    day = F.to_date(moment)
    return F.year(day) * 10000 + F.month(day) * 100 + F.day(day)


def monday_based_weekday(day: Column) -> Column:
    """0 for Monday to 6 for Sunday."""
    return F.weekday(day).cast("short")


def day_name(day: Column) -> Column:
    return F.date_format(day, "EEEE")


def month_name(day: Column) -> Column:
    """The full English name; Spark's ``monthname`` gives the short one."""
    return F.date_format(day, "MMMM")


def event_time(text: Column, pattern: str, fractional: bool = False) -> Column:
    """Parse event text to a timestamp, null where it does not fit.

    Text with fractional seconds does not fit ``pattern``; ``fractional`` accepts it too.
    """
    parsed = F.try_to_timestamp(text, F.lit(pattern))
    if not fractional:
        return parsed
    return F.coalesce(parsed, F.try_to_timestamp(text, F.lit(pattern + "[.SSSSSS]")))


def iso_text(moment: Column) -> Column:
    """ISO-8601 text; six fractional digits, but only where the fraction is not zero."""
    whole = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(moment, "SSSSSS")
    return F.when(micros == "000000", whole).otherwise(F.concat_ws(".", whole, micros))
