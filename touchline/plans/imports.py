"""Roster import to its end: rows of new files into the table, then the files into the log."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..sources import html, rosters
from .catalog import Catalog

ROWS, LOG = "scraping.roster_raw", "scraping.scrape_log"


def pages(catalog: Catalog, found: DataFrame, teams: DataFrame, leagues: DataFrame, wanted: list[str] | None = None) -> None:
    """Imports pages(path, content) that the log doesn't have. Rows are stored before the log: an import that fails between
    is done again, and rows that are there stay as they are."""
    rows, files = rosters.from_pages(found, catalog.table(LOG), teams, leagues, wanted)
    catalog.append_new(ROWS, rows)
    catalog.append_new(LOG, files)


def folder(catalog: Catalog, path: str, teams: DataFrame, leagues: DataFrame, wanted: list[str] | None = None) -> None:
    pages(catalog, html.read(catalog.spark, path), teams, leagues, wanted)
