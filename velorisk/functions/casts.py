"""Lenient casts, parsing and rounding. A bad value becomes null, never an error."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_cast(value: Column, type_name: str) -> Column:
    return value.try_cast(type_name)


def to_number(value: Column) -> Column:
    return value.try_cast("double")


def to_long(value: Column) -> Column:
    """Whole number from text such as ``17`` or ``17.0``; large ids keep every digit."""
    return F.coalesce(value.try_cast("bigint"), value.try_cast("double").try_cast("bigint"))


def round_half_up(value: Column, digits: int = 0) -> Column:
    """Half-up rounding of a non-negative double, spelt so that every engine agrees on it."""
    if digits == 0:
        return F.floor(value + F.lit(0.5)).cast("bigint")
    scale = F.lit(float(10**digits))
    return F.floor(value * scale + F.lit(0.5)) / scale


def iso_minute_timestamp(value: Column, also_day_first: bool = False) -> Column:
    """``2024-05-01 08:15`` as a timestamp.

    Feeds before 2018 wrote ``01/05/2024 08:15``. Those become null unless
    ``also_day_first`` is set.
    """
    parsed = F.try_to_timestamp(value, F.lit("yyyy-MM-dd HH:mm"))
    if also_day_first:
        parsed = F.coalesce(parsed, F.try_to_timestamp(value, F.lit("dd/MM/yyyy HH:mm")))
    return parsed


def day_first_date(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(
        F.try_to_timestamp(text, F.lit("d/M/yyyy")).cast("date"),
        text.try_cast("date"),
    )


def hour_of_clock(value: Column) -> Column:
    return F.hour(F.try_to_timestamp(value, F.lit("HH:mm"))).cast("bigint")


def clean_text(value: Column) -> Column:
    return F.trim(value)


def month_key(value: Column) -> Column:
    """Month key of a date: ``2024-05``."""
    return F.date_format(value, "yyyy-MM")
