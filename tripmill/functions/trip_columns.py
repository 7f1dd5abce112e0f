"""Column expressions: the derived trip features.

Each function returns a ``Column`` made of built-in functions only, so it stays inside
whole-stage code generation. Divisions and parses give null where ANSI mode would raise.
The parses and the hour use the session time zone; pin it to UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATETIME_PATTERN = "yyyy-MM-dd HH:mm:ss"
PLAIN_DATETIME = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\z"


def parsed_datetime(text: str) -> Column:
    """The text under ``DATETIME_PATTERN``, null if malformed.

    Text in plain shape is cast, which gives the same moment at less than half the cost of a pattern
    parse; the pattern decides on everything else.
    """
    value = F.col(text)
    return F.when(value.rlike(PLAIN_DATETIME), value.try_cast("timestamp")).otherwise(
        F.try_to_timestamp(value, F.lit(DATETIME_PATTERN))
    )


def rounded(value: Column, digits: int) -> Column:
    """``F.round`` of a double: half up on its decimal text.

    Away from a half the nearest multiple is the same without that text, and the quotient of two whole numbers is
    the double next to it. Near a half, from a billion on, and for NaN and infinity, ``F.round`` decides.
    """
    unit = 10.0**digits
    scaled = value * unit
    clear = (F.abs(value) < 1e9) & (F.abs(scaled - F.floor(scaled) - 0.5) > 1e-4)
    return F.when(clear, F.floor(scaled + 0.5) / F.lit(unit)).otherwise(F.round(value, digits))


def duration_minutes(start: str, end: str) -> Column:
    seconds = F.unix_timestamp(F.col(end)) - F.unix_timestamp(F.col(start))
    return rounded(seconds / 60, 2)


def speed_mph(miles: str, minutes: str) -> Column:
    """Uses the rounded minutes; null when they are 0."""
    return rounded(F.try_divide(F.col(miles), F.col(minutes) / 60), 2)


def per_mile(amount: str, miles: str) -> Column:
    return rounded(F.try_divide(F.col(amount), F.col(miles)), 2)


def percent_of(part: str, whole: str) -> Column:
    return rounded(F.try_divide(F.col(part), F.col(whole)) * 100, 1)


def day_part(hour: str) -> Column:
    """A null hour counts as Night."""
    h = F.col(hour)
    # The hours and names of the parts of the day.
    return (
        F.when(h.between(6, 11), "Morning")
        .when(h.between(12, 16), "Afternoon")
        .when(h.between(17, 21), "Evening")
        .otherwise("Night")
    )


def falls_on_weekend(moment: str) -> Column:
    """False, not null, when the moment is unknown."""
    return F.coalesce(F.dayofweek(F.col(moment)).isin(1, 7), F.lit(False))


def day_name(moment: str) -> Column:
    return F.date_format(F.col(moment), "EEEE")


def day_type(is_weekend: str) -> Column:
    return F.when(F.col(is_weekend), "Weekend").otherwise("Weekday")


def month_label(year: str, month: str) -> Column:
    return F.date_format(F.make_date(F.col(year), F.col(month), F.lit(1)), "MMM yyyy")
