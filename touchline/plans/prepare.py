"""Metadata of new games: teams, players, birthdays and squads, as joins over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import season_name, short_date
from ..operators import ratings, squads
from ..sources import matches
from .catalog import Catalog


def player_info(docs: DataFrame, games: DataFrame) -> DataFrame:
    """(game_id, day, league, player_id, player_name, team_id, team_name, home, starter, kit_number) of all line-ups;
    games(game_id, day, league)."""
    teams = matches.teams(docs)
    rows = matches.lineups(docs).join(teams, ["game_id", "team_id"]).join(games.select("game_id", "day", "league"), "game_id")
    return rows.select(
        "game_id", "day", "league", "player_id", "player_name", "team_id", "team_name", F.col("is_home").cast("int").alias("home"),
        F.col("is_starter").cast("int").alias("starter"), F.col("jersey_number").alias("kit_number")
    )


def birthdays(players: DataFrame, rosters: DataFrame) -> DataFrame:
    """(player_id, birthday) of player_info rows by team, season and kit number in rosters; the earliest of several. Dates
    are written as dd-mm-yy or in full."""
    born = F.coalesce(short_date(F.col("date_of_birth")), F.try_to_date("date_of_birth", "yyyy-MM-dd"))
    known = rosters.groupBy(F.col("team").alias("team_name"), "season", "kit_number").agg(F.min(born).alias("birthday"))
    met = players.withColumn("season", season_name(F.col("day"))).join(known, ["team_name", "season", "kit_number"])
    return met.groupBy("player_id").agg(F.min("birthday").alias("birthday"))


def sync(catalog: Catalog, docs: DataFrame, games: DataFrame) -> None:
    """Adds teams and players that are new, sets birthdays that are missing, and brings squads up to date."""
    info = player_info(docs, games).persist()
    try:
        catalog.append_new("basis.teams", info.select(F.col("team_id").alias("id"), F.col("team_name").alias("name")))
        named = info.groupBy(F.col("player_id").alias("id")).agg(F.max_by("player_name", F.struct("day", "game_id")).alias("name"))
        catalog.append_new(
            "basis.player", named.select("id", "name", F.lit(None).cast("date").alias("birthday"), F.lit(None).cast("bigint").alias("fapi_id"))
        )
        without = catalog.table("basis.player").where("birthday is null").select("id")
        found = birthdays(info, catalog.table("scraping.roster_raw")).withColumnRenamed("player_id", "id").join(without, "id", "left_semi")
        catalog.update("basis.player", found, ["birthday"])
        seen = info.where("kit_number is not null").select("player_id", "kit_number", "team_id", "day", F.col("game_id").alias("seq"))
        catalog.overwrite("basis.squads", squads.sync(catalog.table("basis.squads"), seen))
    finally:
        info.unpersist()


def training_flags(docs: DataFrame, games: DataFrame, catalog: Catalog, day) -> DataFrame:
    """(game_id, valid_for_training) of each game, by how many of its players are known and have entries."""
    rows = matches.lineups(docs).select("game_id", F.col("player_id").alias("id"))
    known = catalog.table("basis.player").select("id", F.lit(True).alias("exists"))
    entries = ratings.recent(catalog.table("basis.games"), day).select(F.col("player_id").alias("id"), "entries")
    seen = rows.join(known, "id", "left").join(entries, "id", "left").withColumn("exists", F.coalesce("exists", F.lit(False)))
    return ratings.valid_for_training(seen, "game_id")
