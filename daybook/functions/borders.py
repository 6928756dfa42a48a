"""Values as relational databases export them, brought to Spark's types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZERO_DATE = "0000-00-00"
FIRST_DATE = "0001-01-01"
#: A day, with a time of day or without.
DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?)?\z"


def zero_date(text: Column, policy: str = "null") -> Column:
    """Date text (a time may follow) to DATE; the zero date becomes NULL, an error or the first day.

    Any other text is NULL.
    """
    well_formed = text.rlike(DAY)
    zero = well_formed & text.startswith(ZERO_DATE)
    if policy == "null":
        replacement = F.lit(None).cast("string")
    elif policy == "round":
        replacement = F.lit(FIRST_DATE)
    elif policy == "error":
        replacement = F.raise_error(F.lit("zero date")).cast("string")
    else:
        raise ValueError(f"unknown zero date policy {policy!r}")
    return F.try_to_date(F.when(zero, replacement).when(well_formed, F.substring_index(F.substring_index(text, " ", 1), "T", 1)), "yyyy-MM-dd")


def tinyint_bool(value: Column) -> Column:
    return value != 0


def year_date(value: Column) -> Column:
    """A YEAR number as its first day."""
    return F.make_date(value, F.lit(1), F.lit(1))


def to_instant(wall_clock: Column, zone: str) -> Column:
    """Wall-clock time in the connection's zone to UTC."""
    return F.to_utc_timestamp(wall_clock, zone)


def set_members(text: Column) -> Column:
    """SET text to an array; the empty set is an empty array."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ","))
