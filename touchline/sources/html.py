"""Tables, links and options of HTML pages, by the standard library's parser in a mapInPandas step."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import blacklisted

#: A task hands its rows on when it has so many.
MOST_ROWS = 10_000
#: An a tag with its href, as it is written, and its content.
_LINK = r"""(?is)<a(?=\s)[^>]*?\shref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)[^>]*>(.*?)</a\s*>"""
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class _Page(HTMLParser):
    """Collects (kind, group, place, texts, value) rows: links, options of selects, and rows of tables."""

    def __init__(self) -> None:
        super().__init__()
        self.rows: list[tuple] = []
        self.open: list[tuple[str, dict]] = []
        self.link: list | None = None
        self.option: list | None = None
        self.cells: list[dict] | None = None
        self.sections = 0

    def path(self) -> str:
        return "/".join(f"{t}#{a['id']}" if a.get("id") else t for t, a in self.open)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        a = {k: v or "" for k, v in attrs}
        if tag == "option":
            self._end_option()
            select = next((x for t, x in reversed(self.open) if t == "select"), {})
            self.option = [select.get("id", ""), a.get("value", ""), ""]
        elif tag == "a" and "href" in a:
            self.link = [a["href"], ""]
            if self.cells:
                self.cells[-1]["href"] = self.cells[-1].get("href") or a["href"]
        elif tag == "tr":
            self._end_row()
            self.cells = []
        elif tag in ("td", "th") and self.cells is not None:
            self.cells.append({"text": "", "italic": "", "class": a.get("class", "")})
        elif tag == "div" and self.open and self.open[-1][1].get("id") == "missing-players":
            self.sections += 1
        if self.cells and tag not in ("td", "th") and a.get("title"):
            self.cells[-1]["title"] = self.cells[-1].get("title") or a["title"]
        if tag not in _VOID:
            self.open.append((tag, a))

    def handle_endtag(self, tag: str) -> None:
        if tag == "a" and self.link:
            self.rows.append(("link", self.path(), len(self.rows), [self.link[1].strip()], self.link[0]))
            self.link = None
        elif tag in ("option", "select"):
            self._end_option()
        elif tag in ("tr", "table"):
            self._end_row()
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                break

    def handle_data(self, data: str) -> None:
        if self.link:
            self.link[1] += data
        if self.option:
            self.option[2] += data
        if self.cells:
            cell = self.cells[-1]
            cell["text"] += data
            if any(t in ("i", "em") for t, _ in self.open):
                cell["italic"] += data

    def _end_option(self) -> None:
        if self.option:
            self.rows.append(("option", self.option[0], len(self.rows), [self.option[2].strip()], self.option[1]))
        self.option = None

    def _end_row(self) -> None:
        if self.cells:
            texts = [(c["italic"] or c["text"]).strip() for c in self.cells]
            extra = next((c["href"] for c in self.cells if c.get("href")), None)
            titles = [c.get("title") or "" for c in self.cells]
            self.rows.append(("row", f"{self.path()}|{self.sections}", len(self.rows), texts + titles, extra))
        self.cells = None


def parts(pages: DataFrame, key: str = "path", content: str = "content") -> DataFrame:
    """(key, kind, place, ordinal, texts, value) of pages(key string, content string): a row per link (value is the
    href), select option (place is the select's id, value the option's) and table row (place is the path of ids and tags
    with the section of a list of absent players; texts are the cells, italic text before other, then the cells'
    titles; value is the first href)."""

    names = ["key", "kind", "place", "ordinal", "texts", "value"]

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for k, text in zip(f[key], f[content]):
                page = _Page()
                page.feed(text or "")
                page.close()
                rows += [(k, *r) for r in page.rows]
                if len(rows) > MOST_ROWS:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
            yield pd.DataFrame(rows, columns=names)

    return pages.select(key, content).mapInPandas(parse, "key string, kind string, place string, ordinal int, texts array<string>, value string")


def read(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of HTML files, each one whole."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("content"))


def links(pages: DataFrame, forbidden: list[str] = (), key: str = "path", content: str = "content") -> DataFrame:
    """(key, ordinal, url, text) of all links without a forbidden part in their address, by built-in functions: the a tags
    that have an end and a href, outside of comments and scripts."""
    plain = F.regexp_replace(content, r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>", "")
    tags = F.regexp_extract_all(plain, F.lit(_LINK), F.lit(0))
    each = pages.select(F.col(key).alias("key"), F.posexplode(tags).alias("ordinal", "tag"))
    url = F.regexp_extract("tag", _LINK, 1)
    url = F.when(url.rlike("^[\"']"), F.substring(url, F.lit(2), F.length(url) - 2)).otherwise(url)
    text = F.regexp_replace(F.regexp_extract("tag", _LINK, 2), "<[^>]*>", "")
    found = each.select("key", "ordinal", _unescaped(url).alias("url"), F.btrim(_unescaped(text), F.lit(" \t\n\r\f\v")).alias("text"))
    return found.where(~blacklisted(F.col("url"), list(forbidden)))


def _unescaped(text: Column) -> Column:
    """The characters that HTML itself escapes."""
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", "\xa0"), ("&amp;", "&")):
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def options(pages: DataFrame, select_id: str, key: str = "path", content: str = "content") -> DataFrame:
    """(key, ordinal, value, text) of the options of selects whose id contains select_id."""
    found = parts(pages, key, content).where((F.col("kind") == "option") & F.contains("place", F.lit(select_id)))
    return found.select("key", "ordinal", "value", F.col("texts")[0].alias("text"))


def table_rows(pages: DataFrame, div_id: str, key: str = "path", content: str = "content") -> DataFrame:
    """(key, ordinal, cells) of the rows of tables inside a div."""
    inside = F.concat(F.lit("/"), F.col("place")).rlike(rf"/div#{div_id}(/|\|)")
    found = parts(pages, key, content).where((F.col("kind") == "row") & inside)
    return found.select("key", "ordinal", F.slice("texts", 1, (F.size("texts") / 2).cast("int")).alias("cells"))


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)
