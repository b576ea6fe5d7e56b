"""Dates and the seasons they belong to."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A season runs from July to June.
FIRST_MONTH = 7


def season_name(day: Column) -> Column:
    """2020/2021 for a day from July 2020 to June 2021."""
    first = F.year(day) - F.when(F.month(day) < FIRST_MONTH, 1).otherwise(0)
    return F.concat_ws("/", first.cast("string"), (first + 1).cast("string"))


def season_code(day: Column) -> Column:
    """The first year of the season, counted from 2000."""
    return F.year(day) - F.when(F.month(day) >= FIRST_MONTH, 2000).otherwise(2001)


def season_codes_between(start: Column, end: Column) -> Column:
    """Codes of all seasons that share a day with [start, end]; a season ends as June 30 begins."""
    years = F.sequence(F.year(start) - 1, F.year(end) + 1)
    overlap = F.filter(years, lambda y: (F.make_date(y, F.lit(7), F.lit(1)) <= end) & (F.make_date(y + 1, F.lit(6), F.lit(30)) >= start))
    return F.transform(overlap, lambda y: y - 2000)


def season_codes(start: date, end: date) -> list[int]:
    return [y - 2000 for y in range(start.year - 1, end.year + 2) if date(y, 7, 1) <= end and date(y + 1, 6, 30) >= start]


def short_date(text: Column) -> Column:
    """A day written as dd-mm-yy, null if it isn't one; years from 69 on are of the 1900s."""
    day = F.try_to_timestamp(text, F.lit("dd-MM-yy")).cast("date")
    return F.when(F.year(day) >= 2069, F.add_months(day, -1200)).otherwise(day)


def utc(moment: Column) -> Column:
    """A time without a zone, taken as UTC (the session's zone is UTC)."""
    return moment.cast("timestamp")
