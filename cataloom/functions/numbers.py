"""Numbers: unit changes and numbers kept as text."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents_to_units(cents: Column) -> Column:
    return cents / F.lit(100.0)


def minutes_to_hours(minutes: Column) -> Column:
    return F.round(minutes / F.lit(60.0), 2)


def to_long(text: Column) -> Column:
    """Whole number from text such as ``12`` or ``12.0``; null for all else.

    The digits are taken as they stand, so no number is altered on the way.
    """
    whole = F.regexp_extract(text, r"^\s*([+-]?\d+)(?:\.0*)?\s*$", 1)
    return F.when(whole != "", whole.try_cast("bigint"))


def parse_range(text: Column) -> Column:
    """``"10,000 .. 20,000"`` as an array of its bounds; a bound that is no number is null."""
    return F.transform(
        F.split(text, F.lit(r" \.\. ")),
        lambda bound: F.replace(bound, F.lit(","), F.lit("")).try_cast("bigint"),
    )
