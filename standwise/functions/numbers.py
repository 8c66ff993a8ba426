"""Numeric coercion and the two rounding rules, as native column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER_TEXT = r"(?U)^\s*([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)\s*$"
WHOLE_TEXT = r"(?U)^\s*([+-]?[0-9]+)\s*$"
FULL_DATE = r"^[0-9]{2}/[0-9]{2}/(?:19|2[0-9])[0-9]{2}\z"


def strip(text: Column) -> Column:
    """Text without leading and trailing whitespace of any kind."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def number(text: Column) -> Column:
    """Double value of a text; null when it is not a finite decimal number."""
    value = F.regexp_extract(text.cast("string"), NUMBER_TEXT, 1).try_cast("double")
    infinity = F.lit(float("inf"))
    return F.nullif(F.nullif(value, infinity), -infinity)


def whole_from_text(text: Column) -> Column:
    """Integer value of a text; null for anything but an optional sign and digits."""
    return F.regexp_extract(text, WHOLE_TEXT, 1).try_cast("int")


def rounded_down(text: Column) -> Column:
    """Integer part of a numeric text such as '3' or '3.0'; null when it is none."""
    text = text.cast("string")
    whole = text.try_cast("int")
    # A text that is just the digits of its integer needs no pattern.
    plain = F.when(text == whole.cast("string"), whole)
    any_number = F.regexp_extract(text, NUMBER_TEXT, 1).try_cast("double").try_cast("int")
    return F.coalesce(plain, any_number)


def whole_from_number(value: Column) -> Column:
    """Integer part of a number, cut toward zero; null when out of range."""
    return value.try_cast("int")


def day_first_date(text: Column) -> Column:
    """Date of a ``dd/MM/yyyy`` text; null when it names no calendar day."""
    text = text.cast("string")
    turned = F.concat_ws("-", text.substr(7, 4), text.substr(4, 2), text.substr(1, 2))
    # A date of two, two and four digits of the last centuries is read without a formatter.
    plain = F.when(text.rlike(FULL_DATE), turned.try_cast("timestamp").cast("date"))
    return F.coalesce(plain, F.try_to_date(strip(text), "d/M/yyyy"))


def half_even(value: Column, digits: int) -> Column:
    """Scale, round ties to even, scale back: the rule of array libraries."""
    scale = F.lit(float(10**digits))
    return F.rint(value * scale) / scale


def half_up(value: Column, digits: int) -> Column:
    """Decimal rounding with ties away from zero: the rule of SQL databases."""
    return F.round(value, digits)


def ratio(part: Column, whole: Column, factor: float = 100.0) -> Column:
    """``factor * part / whole`` as a double; null when ``whole`` is zero."""
    return F.try_divide(F.lit(factor) * part.cast("double"), whole.cast("double"))
