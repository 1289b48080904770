"""Labels, percentages and calendar helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "Unknown"
# Quarter of tiles whose date cannot be read.
UNDATED = "undated"


def city_label(name: Column, admin1: Column, cc: Column) -> Column:
    """``"name, admin1, cc"``; a missing name reads "Unknown", other missing parts stay empty."""
    return F.concat_ws(
        ", ",
        F.coalesce(name, F.lit(UNKNOWN)),
        F.coalesce(admin1, F.lit("")),
        F.coalesce(cc, F.lit("")),
    )


def place_preference(city: Column, town: Column, village: Column, state: Column, country: Column) -> Column:
    """The most local filled address part; empty text counts as missing, except a present but empty country."""
    filled = [F.when(part != "", part) for part in (city, town, village, state)]
    return F.coalesce(*filled, country, F.lit(UNKNOWN))


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole``, and 0 when ``whole`` is 0."""
    return F.when(whole > 0, part * 100.0 / whole).otherwise(F.lit(0.0))


def quarter_of(date: Column) -> Column:
    """``2019-q1`` for any date in January to March 2019."""
    return F.concat(F.year(date).cast("string"), F.lit("-q"), F.quarter(date).cast("string"))


def tile_quarter(tile: Column) -> Column:
    """Quarter of a ``YYYY-MM-DD_...`` tile."""
    day = F.substring(F.trim(tile), 1, 10)
    # a cast reads a day of this form as a date format does, without its parser
    date = F.when(day.rlike(r"^\d{4}-\d{2}-\d{2}\z"), day.try_cast("date"))
    return F.coalesce(quarter_of(date), F.lit(UNDATED))
