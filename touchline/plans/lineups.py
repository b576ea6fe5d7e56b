"""Announced line-ups of the fixtures about to start, with each starter's latest rating."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import resolve
from ..operators import ratings, squads

AHEAD = timedelta(minutes=30)


def due(schedule: DataFrame, now: datetime, ahead: timedelta = AHEAD) -> DataFrame:
    return ratings.within(schedule, "date_time", now, now + ahead)


def rated(
    lineups: DataFrame, schedule: DataFrame, players: DataFrame, squad: DataFrame, teams: DataFrame, aliases: DataFrame, base_metric: DataFrame,
    version: float
) -> DataFrame:
    """(fixture_id, team_name, kit_number, player_id, elo) of lineups(fixture_id, team_name, fapi_id, kit_number).

    A player is found by the service's id, else by team, kit number and the fixture's day in the squads; who isn't found
    has neither player_id nor elo."""
    day = schedule.select(F.col("schedule_id").alias("fixture_id"), F.to_date("date_time").alias("day"))
    rows = resolve(lineups, "team_name", aliases).join(day, "fixture_id")
    by_squad = squads.match(rows, squad, teams, F.col("day")).withColumnRenamed("player_id", "by_squad")
    by_id = players.where("fapi_id is not null").groupBy("fapi_id").agg(F.min("id").alias("by_id"))
    found = by_squad.join(by_id, "fapi_id", "left").withColumn("player_id", F.coalesce("by_id", "by_squad"))
    elo = ratings.latest(base_metric, version).withColumnRenamed("metric_value", "elo")
    return found.join(elo, "player_id", "left").select("fixture_id", "team_name", "kit_number", "player_id", "elo")


def schedule_refresh(catalog, fixtures: DataFrame) -> None:
    """The schedule table becomes what the service's answers hold."""
    catalog.overwrite("basis.schedule", fixtures)
