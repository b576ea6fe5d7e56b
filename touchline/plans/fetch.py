"""What is to be fetched: the games of a date range whose documents aren't landed yet, and the command line for it."""

from __future__ import annotations

import argparse
import tomllib
from datetime import UTC, date, datetime, timedelta
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import season_codes
from ..operators.ratings import within


def date_range(start: str | None, end: str | None, back: int, forward: int, today: date) -> tuple[date, date]:
    """start and end where given, else back and forward days from today."""
    return date.fromisoformat(start) if start else today - timedelta(days=back), date.fromisoformat(end) if end else today + timedelta(days=forward)


def missing(schedule: DataFrame, landed: DataFrame, start: date, end: date) -> DataFrame:
    """Games of the days start to end without a document."""
    return within(
        schedule.withColumn("__day", F.to_date("date")), "__day", start, end
    ).drop("__day").join(landed.select("game_id"), "game_id", "left_anti")


def summary(games: DataFrame) -> DataFrame:
    """(games, first, last, leagues) of a schedule."""
    return games.agg(
        F.count("*").alias("games"), F.min("date").alias("first"), F.max("date").alias("last"), F.array_sort(F.collect_set("league")).alias("leagues")
    )


def landed(spark: SparkSession, folder: str) -> DataFrame:
    """(game_id) of the match documents under a folder, by their names alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").load(folder).select("path")
    return files.select(F.regexp_extract("path", r"(\d+)\.json$", 1).try_cast("long").alias("game_id")).where("game_id is not null")


def bad_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(path, text) of documents that don't parse, so that one bad file doesn't stop a run."""
    files = spark.read.text(
        folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json"
    ).select(F.input_file_name().alias("path"), F.col("value").alias("text"))
    return files.where(F.try_parse_json("text").isNull())


_DEFAULTS = {"config": None, "leagues": None, "days_back": 7, "days_forward": 0, "start": None, "end": None, "data_dir": "data", "dry_run": False}


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    """Options of the command line, else those of the config file, else the defaults."""
    p = argparse.ArgumentParser(description="List the games whose documents are to be fetched.", argument_default=argparse.SUPPRESS)
    p.add_argument("--config", type=Path)
    p.add_argument("--leagues", nargs="*")
    p.add_argument("--days-back", type=int)
    p.add_argument("--days-forward", type=int)
    p.add_argument("--start")
    p.add_argument("--end")
    p.add_argument("--data-dir")
    p.add_argument("--dry-run", action="store_true")
    given = vars(p.parse_args(argv))
    known = tomllib.loads(given["config"].read_text()) if "config" in given else {}
    return argparse.Namespace(**(_DEFAULTS | {k.replace("-", "_"): v for k, v in known.items()} | given))


def seasons_for(argv_range: tuple[date, date]) -> list[int]:
    return season_codes(*argv_range)


def run(schedule: DataFrame, options: argparse.Namespace, today: date) -> DataFrame:
    """The games of schedule(game_id, league, date, ...) to fetch, in the order of their dates: those of the wanted leagues
    and days that have no document below data_dir yet. With dry_run, all of them, landed or not."""
    start, end = date_range(options.start, options.end, options.days_back, options.days_forward, today)
    games = schedule if not options.leagues else schedule.where(F.col("league").isin(*options.leagues))
    spark = schedule.sparkSession
    none = spark.createDataFrame([], "game_id bigint")
    return missing(games, none if options.dry_run else landed(spark, f"{options.data_dir}/events"), start, end).orderBy("date", "game_id")


def main(argv: list[str] | None = None, today: date | None = None) -> None:
    """Prints the games to fetch, one a line, and a summary; the schedule is <data_dir>/schedule (Parquet)."""
    from ..session import session

    options = arguments(argv)
    spark = session("fetch")
    games = run(spark.read.parquet(f"{options.data_dir}/schedule"), options, today or datetime.now(UTC).date()).persist()
    for r in games.select("game_id", "league", "date").toLocalIterator():
        print(r["game_id"], r["league"], r["date"])
    r = summary(games).first()
    print(f"{r['games']} games, {r['first']} to {r['last']}, {', '.join(r['leagues'])}")
    games.unpersist()


if __name__ == "__main__":
    main()
