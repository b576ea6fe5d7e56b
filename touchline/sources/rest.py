"""Landed answers of a fixtures service, and the addresses to fetch them from; fetching itself is not the engine's work."""

from __future__ import annotations

from urllib.parse import urlencode

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import REST_LINEUP, REST_ODDS, REST_SCHEDULE


def address(base: str, what: str, **params: object) -> str:
    """The address of fixtures, fixtures/lineups or odds with the given parameters."""
    return f"{base.rstrip('/')}/{what}?{urlencode(params)}"


def schedule(spark: SparkSession, path: str) -> DataFrame:
    """(schedule_id, date_time, home, away, league), one row per fixture."""
    each = spark.read.schema(REST_SCHEDULE).option("multiLine", True).json(path).select(F.explode("response").alias("r"))
    return each.select(
        F.col("r.fixture.id").alias("schedule_id"), F.to_timestamp("r.fixture.date").alias("date_time"), F.col("r.teams.home.name").alias("home"),
        F.col("r.teams.away.name").alias("away"), F.col("r.league.id").alias("league")
    ).dropDuplicates(["schedule_id"])


def lineups(spark: SparkSession, path: str) -> DataFrame:
    """(fixture_id, team_name, fapi_id, player_name, kit_number) of files named <fixture_id>.json."""
    docs = spark.read.schema(REST_LINEUP).option("multiLine", True).json(path).withColumn(
        "fixture_id", F.regexp_extract(F.input_file_name(), r"(\d+)\.json$", 1).cast("long")
    )
    each = docs.select("fixture_id", F.explode("response").alias("r")).select("fixture_id", "r.team.name", F.explode("r.startXI").alias("p"))
    return each.select(
        "fixture_id", F.col("name").alias("team_name"), F.col("p.player.id").alias("fapi_id"), F.col("p.player.name").alias("player_name"),
        F.col("p.player.number").alias("kit_number")
    )


def odds(spark: SparkSession, path: str, bet: str = "Match Winner") -> DataFrame:
    """(fixture_id, bookmaker, outcome, odd) of one kind of bet."""
    each = spark.read.schema(REST_ODDS).option("multiLine", True).json(path).select(F.explode("response").alias("r"))
    makers = each.select(F.col("r.fixture.id").alias("fixture_id"), F.explode("r.bookmakers").alias("b"))
    bets = makers.select("fixture_id", F.col("b.name").alias("bookmaker"), F.explode("b.bets").alias("bet")).where(F.col("bet.name") == bet)
    return bets.select("fixture_id", "bookmaker", F.explode("bet.values").alias("v")).select(
        "fixture_id", "bookmaker", F.col("v.value").alias("outcome"), F.col("v.odd").cast("double").alias("odd")
    )


def club_elo(ratings: DataFrame, team: str) -> DataFrame:
    """(elo) of a team in ratings(rank, team, league, elo): its first row by rank; an unknown team is an error."""
    found = ratings.where(F.col("team") == team).agg(F.min_by("elo", "rank").alias("elo"))
    return found.select(F.coalesce("elo", F.raise_error(F.lit(f"no rating of {team}")).cast("double")).alias("elo"))


def league_elo(ratings: DataFrame) -> DataFrame:
    """(league, elo): the mean rating of each league."""
    return ratings.groupBy("league").agg(F.avg("elo").alias("elo"))
