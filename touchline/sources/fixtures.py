"""Answers of a fixtures service as a data source, batch and stream.

    spark.dataSource.register(FixturesSource)
    spark.read.format("touchline_fixtures").load(folder).where("league = 39 and season = 2024")

A partition is a page of an answer. Filters by league and season choose the pages before any is fetched (where
spark.sql.python.filterPushdown.enabled is set; else Spark filters rows after). A stream's offset is, for each league and season, the
last page that was read. How pages are listed and fetched is the fetcher's affair: Landed reads what was fetched into a
folder; another class with the same three methods, named by the option fetcher as module:Class, can ask the service itself.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime
from importlib import import_module

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition

SCHEMA = "schedule_id bigint, date_time timestamp, home string, away string, league bigint, season int"
_ARROW = pa.schema([
    ("schedule_id", pa.int64()), ("date_time", pa.timestamp("us", "UTC")), ("home", pa.string()), ("away", pa.string()), ("league", pa.int64()),
    ("season", pa.int32())
])


@dataclass(frozen=True, order=True)
class Page(InputPartition):
    league: int
    season: int
    number: int


class Landed:
    """Pages as <folder>/league=<id>/season=<year>/page=<n>.json, in any file system that pyarrow opens."""

    _NAME = re.compile(r"league=(\d+)/season=(\d+)/page=(\d+)\.json$")

    def __init__(self, options: dict[str, str]) -> None:
        self.root = options["path"]

    def _open(self) -> tuple[fs.FileSystem, str]:
        if "://" in self.root or self.root.startswith("file:"):
            return fs.FileSystem.from_uri(self.root)
        return fs.LocalFileSystem(), self.root

    def pages(self) -> list[Page]:
        """All pages there are; no page is opened."""
        store, root = self._open()
        found = store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        return sorted(Page(*map(int, m.groups())) for f in found if (m := self._NAME.search(f.path)))

    def fetch(self, page: Page) -> bytes:
        store, root = self._open()
        with store.open_input_stream(f"{root.rstrip('/')}/league={page.league}/season={page.season}/page={page.number}.json") as f:
            return f.read()


def _fetcher(options: dict[str, str]):
    module, _, name = options.get("fetcher", "").partition(":")
    return (getattr(import_module(module), name) if module else Landed)(options)


def rows(page: Page, answer: bytes) -> pa.RecordBatch:
    """The fixtures of a page. League and season are the page's, as it was asked for by them; fields that an answer lacks are null."""
    found = json.loads(answer).get("response") or []
    part = lambda r, *path: part((r or {}).get(path[0]), *path[1:]) if path else r
    when = [part(r, "fixture", "date") for r in found]
    columns = [
        [part(r, "fixture", "id") for r in found], [datetime.fromisoformat(x) if x else None for x in when], [part(r, "teams", "home", "name") for r in found],
        [part(r, "teams", "away", "name") for r in found], [page.league] * len(found), [page.season] * len(found)
    ]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


class FixturesReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.options, self.wanted = options, {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes league and season, equal or among some; leaves all others to Spark."""
        for f in filters:
            if isinstance(f, EqualTo | In) and f.attribute in (("league",), ("season",)):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                name = f.attribute[0]
                self.wanted[name] = self.wanted[name] & values if name in self.wanted else values
            else:
                yield f

    def partitions(self) -> list[Page]:
        return [p for p in _fetcher(self.options).pages() if all(getattr(p, k) in v for k, v in self.wanted.items())]

    def read(self, page: Page) -> Iterator[pa.RecordBatch]:
        yield rows(page, _fetcher(self.options).fetch(page))


class FixturesStream(DataSourceStreamReader):
    """New pages of each league and season, by number: a page that lands must have a higher one than those before."""

    def __init__(self, options: dict[str, str]) -> None:
        self.options = options

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        last: dict[str, int] = {}
        for p in _fetcher(self.options).pages():
            last[f"{p.league}/{p.season}"] = max(p.number, last.get(f"{p.league}/{p.season}", p.number))
        return last

    def partitions(self, start: dict, end: dict) -> list[Page]:
        low = lambda p: start.get(f"{p.league}/{p.season}", -1)
        return [p for p in _fetcher(self.options).pages() if low(p) < p.number <= end.get(f"{p.league}/{p.season}", -1)]

    def read(self, page: Page) -> Iterator[pa.RecordBatch]:
        yield rows(page, _fetcher(self.options).fetch(page))

    def commit(self, end: dict) -> None:
        """Nothing is to be freed: pages stay where they landed."""


class FixturesSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "touchline_fixtures"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FixturesReader:
        return FixturesReader(dict(self.options))

    def streamReader(self, schema) -> FixturesStream:
        return FixturesStream(dict(self.options))
