"""Season codes: one canonical form from the ways in which seasons are written."""

from __future__ import annotations

import calendar
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

_MONTHS = {m: i for i, m in enumerate(calendar.month_abbr) if m}


def spans_years(start_month: str, end_month: str) -> bool:
    """Whether a season from one month (like Aug) to another runs over New Year."""
    return _MONTHS[end_month] < _MONTHS[start_month]


def multi_year(leagues: Iterable[dict]) -> bool:
    """How the seasons of these leagues are coded: season_code ("multi-year", "single-year") where a league has one,
    else by its season_start and season_end; leagues that differ, or none, give multi-year codes."""
    kinds = {
        x["season_code"] == "multi-year" if "season_code" in x else spans_years(
            x.get("season_start", "Aug"), x.get("season_end", "May")
        ) for x in leagues
    }
    return kinds.pop() if len(kinds) == 1 else True


def parse_season(season: Column, multi: bool, current_year: int) -> Column:
    """The code of a season such as 1994, 94, 9495, 94-95, 94/95, 1994-95, 1994-1995 or 1994/1995.

    Multi-year codes are 9495, single-year codes 1994. Other forms are an error; null stays null. Two digits are of
    this century up to current_year. As a four-digit form, 9900 is read as the year 9900."""
    s = season.cast("string")
    first, last = F.substring(s, 1, 2), F.substring(s, -2, 2)
    following = F.lpad((last.try_cast("int") + 1).cast("string"), 2, "0")
    century = F.when(
        F.concat(F.lit("20"), first).try_cast("int") <= current_year, F.concat(F.lit("20"), first)
    ).otherwise(F.concat(F.lit("19"), first))
    forms = lambda pattern: s.rlike(pattern)
    four, two, long = forms("^[0-9]{4}$"), forms("^[0-9]{2}$"), forms("^[0-9]{4}[-/][0-9]{4}$")
    partial, short = forms("^[0-9]{4}-[0-9]{2}$"), forms("^[0-9]{2}[-/][0-9]{2}$")
    if multi:
        out = (
            F.when(four & (last.try_cast("int") == first.try_cast("int") + 1), s)
            .when((four | two) & (last == "99"), F.lit("9900"))
            .when(four | two, F.concat(last, following))
            .when(long | partial, F.concat(F.substring(s, 3, 2), last))
            .when(short, F.concat(first, last))
        )
    else:
        year = F.when(s.try_cast("int") <= current_year, F.concat(F.lit("20"), first)).otherwise(F.concat(F.lit("19"), first))
        out = (
            F.when(s == "1920", F.lit("1919"))
            .when(s == "2021", F.lit("2020"))
            .when(four & first.isin("19", "20"), s)
            .when(four, year)
            .when(two | short, century)
            .when(long | partial, F.substring(s, 1, 4))
        )
    return out.when(s.isNotNull(), F.raise_error(F.concat(F.lit("unknown season code: "), s)).cast("string"))


def latest_seasons(current_year: int, n: int = 6) -> list[str]:
    """The seasons read by default, the newest first."""
    return [f"{y}-{y + 1}" for y in range(current_year, current_year - n, -1)]
