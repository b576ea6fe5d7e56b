"""Leagues, seasons, stages and fixtures from landed documents under one folder:

tiers.json; seasons/<league>.html; seasons/<league>_<season>.html; matches/<league>_<season>[_<stage_id>].html (a JSON
calendar); matches/<league>_<season>_<stage_id>_<month>.json; previews/<league>_<season>/<game_id>.html.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import game_name, resolve, url_ids, with_snake_case
from ..functions.seasons import latest_seasons, parse_season
from ..operators.dedup import keep_first, keep_last
from ..schemas import CALENDAR, FIXTURES, TIERS
from . import html


def registry(spark: SparkSession, builtin: dict[str, dict], custom: dict[str, dict] | None = None, selected: list[str] | None = None) -> DataFrame:
    """(league, source_name) of the leagues to read: the built-in ones, each replaced whole by a custom one of its name;
    all, or those selected. An unknown selected league is an error, one without a source name is left out of the result."""
    all_ = builtin | (custom or {})
    if unknown := sorted(set(selected or ()) - set(all_)):
        raise ValueError(f"unknown leagues: {', '.join(unknown)}")
    rows = [(k, v["source_name"]) for k, v in sorted(all_.items()) if "source_name" in v and (selected is None or k in selected)]
    return spark.createDataFrame(rows, "league string, source_name string")


def leagues(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """(league, region_id, region, league_id) of wanted(league, source_name); a wanted league that the file lacks is an error."""
    tiers = spark.read.schema(TIERS).option("multiLine", True).json(f"{folder}/tiers.json")
    each = tiers.select(F.col("id").alias("region_id"), F.col("name").alias("region"), F.explode("tournaments").alias("t"))
    named = each.select("region_id", "region", F.col("t.id").alias("league_id"), F.concat_ws(" - ", "region", "t.name").alias("source_name"))
    met = wanted.join(named, "source_name", "left")
    bad = F.raise_error(F.concat(F.lit("no such league: "), F.col("source_name"))).cast("bigint")
    return met.select("league", F.coalesce("region_id", bad).alias("region_id"), "region", "league_id")


def seasons(spark: SparkSession, folder: str, leagues_: DataFrame, wanted: DataFrame, multi: bool, current_year: int) -> DataFrame:
    """(league, season, region_id, league_id, season_id) of wanted(season) in the leagues' season lists."""
    pages = html.read(spark, f"{folder}/seasons/*.html").where(~html.file_name(F.col("path")).rlike("_[0-9]+\\.html$"))
    listed = html.options(pages, "seasons").withColumn("league", F.regexp_replace(F.url_decode(html.file_name(F.col("key"))), "\\.html$", ""))
    coded = listed.select(
        "league", parse_season(F.col("text"), multi, current_year).alias("season"), url_ids(F.col("value"))["season_id"].alias("season_id")
    )
    return coded.join(leagues_, "league").join(wanted, "season", "left_semi").select("league", "season", "region_id", "league_id", "season_id")


def wanted_seasons(spark: SparkSession, given: str | int | list | None, multi: bool, current_year: int) -> DataFrame:
    """(season) codes of one season or several, in any form that parse_season reads; by default the latest ones."""
    names = latest_seasons(current_year) if given is None else given if isinstance(given, list) else [given]
    rows = spark.createDataFrame([(str(n),) for n in names], "name string")
    return rows.select(parse_season(F.col("name"), multi, current_year).alias("season")).distinct()


def stages(spark: SparkSession, folder: str, seasons_: DataFrame) -> DataFrame:
    """seasons_ with stage_id and stage: the stage of the link named Fixtures (without a name) and those of the stage
    list; of equal stages the named one holds."""
    pages = html.read(spark, f"{folder}/seasons/*_*.html")
    found = html.parts(pages).withColumn("name", F.regexp_replace(F.url_decode(html.file_name(F.col("key"))), "\\.html$", ""))
    text, stage = F.col("texts")[0], url_ids(F.col("value"))["stage_id"]
    fixtures = keep_first(found.where((F.col("kind") == "link") & (text == "Fixtures")), ["name"], F.col("ordinal")).select(
        "name", stage.alias("stage_id"), F.lit(None).cast("string").alias("stage"), F.lit(-1).alias("ordinal")
    )
    listed = found.where(
        (F.col("kind") == "option") & F.contains("place", F.lit("stages"))
    ).select("name", stage.alias("stage_id"), text.alias("stage"), "ordinal")
    rows = seasons_.withColumn("name", F.concat_ws("_", "league", "season")).join(fixtures.unionByName(listed), "name").drop("name")
    return keep_last(rows, ["league", "season", "stage_id"], "ordinal").drop("ordinal")


def calendars(spark: SparkSession, folder: str) -> DataFrame:
    """(name, year, month) of all calendars."""
    pages = html.read(spark, f"{folder}/matches/*.html")
    mask = F.from_json("content", CALENDAR)["mask"]
    years = pages.select(
        F.regexp_replace(F.url_decode(html.file_name(F.col("path"))), "\\.html$", "").alias("name"), F.explode(mask).alias("year", "months")
    )
    return years.select("name", "year", F.explode(F.map_keys("months")).alias("month"))


def fixtures(spark: SparkSession, folder: str, stages_: DataFrame, aliases: DataFrame) -> DataFrame:
    """The schedule: league, season, game, stage, game_id, home_team, away_team, date (UTC) and the fixtures' other
    columns, in snake case.

    Files are those of the months in the stages' calendars; a game in several of them counts once, the first file by
    name holding. Team names are canonical where aliases(alias, name) has them."""
    with_name = stages_.withColumn(
        "calendar",
        F.when(F.col("stage").isNull(), F.concat_ws("_", "league", "season")).otherwise(
            F.concat_ws("_", "league", "season", F.col("stage_id").cast("string"))
        )
    )
    months = with_name.join(calendars(spark, folder).withColumnRenamed("name", "calendar"), "calendar")
    wanted = months.select(
        "league", "season", "stage",
        F.concat(F.concat_ws("_", "league", "season", F.col("stage_id").cast("string"), "month"), F.lit(".json")).alias("__file")
    ).distinct()
    files = spark.read.schema(FIXTURES).option("multiLine", True).json(f"{folder}/matches/*.json").withColumn(
        "__file", F.url_decode(html.file_name(F.input_file_name()))
    )
    games = files.join(wanted, "__file").select("__file", "league", "season", "stage", F.posexplode("tournaments").alias("__t", "t"))
    games = games.select(
        "__file", "league", "season", "stage", "__t", F.posexplode("t.matches").alias("__m", "m")
    ).select("__file", "__t", "__m", "league", "season", "stage", "m.*")
    once = keep_first(games, ["id"], F.col("__file"), F.col("__t"), F.col("__m")).drop("__file", "__t", "__m")
    named = resolve(resolve(once, "homeTeamName", aliases), "awayTeamName", aliases)
    named = named.withColumnsRenamed(
        {"homeTeamName": "home_team", "awayTeamName": "away_team", "id": "game_id", "startTimeUtc": "date"}
    ).withColumn("date", F.to_timestamp("date"))
    return with_snake_case(named.withColumn("game", game_name(F.col("home_team"), F.col("away_team"), F.col("date"))))


def absent_players(spark: SparkSession, folder: str, schedule: DataFrame) -> DataFrame:
    """(league, season, game, game_id, team, player, player_id, reason, status) of who is injured or suspended."""
    pages = html.read(spark, f"{folder}/previews/*/*.html")
    rows = html.parts(pages).where((F.col("kind") == "row") & F.contains("place", F.lit("div#missing-players")) & F.col("value").isNotNull())
    half = (F.size("texts") / 2).cast("int")
    cell = lambda i: F.get("texts", F.lit(i))
    title = F.filter(F.slice("texts", half + 1, half), lambda t: t != "")
    section = F.regexp_extract("place", r"\|(\d+)$", 1).cast("int")
    each = rows.select(
        F.regexp_extract("key", r"(\d+)\.html$", 1).cast("long").alias("game_id"), section.alias("section"), cell(0).alias("player"),
        F.get(F.split("value", "/"), F.lit(2)).try_cast("long").alias("player_id"), F.get(title, F.lit(0)).alias("reason"),
        F.get("texts", half - 1).alias("status")
    )
    each = each.where("section in (2, 3)").join(schedule.select("league", "season", "game", "game_id", "home_team", "away_team"), "game_id")
    team = F.when(F.col("section") == 2, F.col("home_team")).otherwise(F.col("away_team"))
    return each.select("league", "season", "game", "game_id", team.alias("team"), "player", "player_id", "reason", "status")
