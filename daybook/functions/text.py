"""Accounting-specific column expressions, all evaluated in the JVM."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.schemas import MONEY

MONTH_FORMAT = "yyyy-MM"

# The words a bank description ends with and the sign they carry.
PAYMENT_WORD = "payment"
DEBIT, CREDIT = "debit", "credit"


# The characters counted as blank at the ends of a party or kind.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def _strip(value: Column) -> Column:
    return F.trim(value, F.lit(BLANKS))


def _last_word(description: Column) -> Column:
    return F.substring_index(description, " ", -1)


def description_party(description: Column) -> Column:
    """Everything left of the last space; '' when there is no space."""
    return _strip(F.left(description, F.length(description) - F.length(_last_word(description)) - 1))


def description_kind(description: Column) -> Column:
    """What follows the last space; the whole text when there is no space."""
    return _strip(_last_word(description))


def split_description(description: Column) -> Column:
    """Bank text as a struct of party and kind; NULL text gives NULL fields."""
    return F.struct(
        description_party(description).alias("party"),
        description_kind(description).alias("type"),
    )


def nature_of(description: Column) -> Column:
    """Side of the account a bank line posts to, judged by its last word."""
    is_payment = F.equal_null(description_kind(description), F.lit(PAYMENT_WORD))
    return F.when(is_payment, CREDIT).otherwise(DEBIT)


def month_bucket(day: Column) -> Column:
    return F.date_format(day, MONTH_FORMAT)


def parse_date(value: Column, dtype: T.DataType) -> Column:
    """ISO text to DATE, NULL when it is not one; typed dates pass through.

    The shape test lets the plain cast do the parsing: it returns NULL for an
    impossible day, where a format-driven parser raises and catches an exception
    for every bad row.
    """
    if isinstance(dtype, T.StringType):
        return F.when(value.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"), value.try_cast("date"))
    return value.cast("date")


def parse_amount(value: Column) -> Column:
    """Currency text such as ``₹1,23,456.50`` to DECIMAL(10,2), NULL when malformed."""
    # two searches for a substring: translate looks every character up in a map
    plain = value.cast("string")
    for sign in ("₹", ","):
        plain = F.replace(plain, F.lit(sign), F.lit(""))
    return plain.try_cast(MONEY)


def standardized(value: Column) -> Column:
    return F.initcap(F.trim(value))


def cutoff(as_of: date | str | None) -> Column:
    """The last admissible posting day."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
