"""Squad rosters from landed HTML pages, named <years>_<league>_..._<team>.html."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import resolve
from ..operators.dedup import keep_first
from . import html

COLUMNS = (
    "kit_number", "name", "nationality", "position", "height", "weight", "date_of_birth", "place_of_birth", "previous_club", "team", "league",
    "season"
)
#: Rows with fewer cells after the kit number are left out.
LEAST_CELLS = 8


def is_player_row(cells: Column) -> Column:
    """Whether a table row is one of a player: two cells at least, a number first, then something."""
    return (F.size(cells) >= 2) & F.coalesce(F.get(cells, F.lit(0)), F.lit("")).rlike("^[0-9]+$") & (
        F.coalesce(F.get(cells, F.lit(1)), F.lit("")) != ""
    )


def numbers(pages: DataFrame) -> DataFrame:
    """(key, kit_number, cells) of the tables inside div#main; of one kit number's rows the first holds. A page without
    that div is an error."""
    pages = pages.withColumn(
        "content",
        F.when(
            F.col("content").rlike("""<div[^>]*id=["']?main["' >]"""), F.col("content")
        ).otherwise(F.raise_error(F.concat(F.lit("no roster in "), F.col("path"))))
    )
    rows = html.table_rows(pages, "main").where(is_player_row(F.col("cells")))
    first = keep_first(rows.withColumn("kit_number", F.col("cells")[0]), ["key", "kit_number"], F.col("ordinal"))
    return first.select("key", "kit_number", F.slice("cells", 2, F.size("cells")).alias("cells"))


def name_parts(file: Column) -> Column:
    """struct(season, league, team) of a file name: the first part with / for -, the middle parts, the last part."""
    parts = F.split(F.regexp_replace(file, r"\.[^.]*$", ""), "_")
    return F.struct(
        F.replace(parts[0], F.lit("-"), F.lit("/")).alias("season"), F.array_join(F.slice(parts, 2, F.size(parts) - 2), "_").alias("league"),
        F.element_at(parts, -1).alias("team")
    )


def rosters(
    spark: SparkSession, path: str, done: DataFrame, teams: DataFrame, leagues: DataFrame, wanted: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rows, files): roster rows of the files that are not in done(file), and these files for the log.

    Team and league names come from aliases (alias, name); a file whose league, or team, has none gives no rows and is not
    logged. wanted keeps the files of some leagues."""
    return from_pages(html.read(spark, path), done, teams, leagues, wanted)


def from_pages(
    pages: DataFrame, done: DataFrame, teams: DataFrame, leagues: DataFrame, wanted: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """rosters of pages(path, content)."""
    pages = pages.withColumn("file", F.url_decode(html.file_name(F.col("path"))))
    named = pages.join(done.select("file"), "file", "left_anti").select(
        "path", "content", "file", name_parts(F.col("file")).alias("n")
    ).select("path", "content", "file", "n.*")
    named = resolve(resolve(named, "league", leagues, "null"), "team", teams, "null").where("league is not null and team is not null")
    named = named if wanted is None else named.where(F.col("league").isin(wanted))
    rows = numbers(named).where(F.size("cells") >= LEAST_CELLS).join(named.select(F.col("path").alias("key"), "team", "league", "season"), "key")
    cells = [F.col("cells")[i].alias(c) for i, c in enumerate(COLUMNS[1:9])]
    return rows.select(F.col("kit_number").cast("int").alias("kit_number"), *cells, "team", "league", "season"), named.select("file")
