"""Predictions of coming games: an interval of the margin from both sides' ratings, stored and read back."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import elo
from .catalog import Catalog

TABLE = "basis.prediction"


def sides(schedule: DataFrame, ratings: DataFrame) -> DataFrame:
    """(game_id, home_elo, away_elo) of schedule(game_id, home_team, away_team); ratings(team_id, elo), null without one."""
    r = ratings.groupBy("team_id").agg(F.avg("elo").alias("elo"))
    home = schedule.join(r.withColumnsRenamed({"team_id": "home_team", "elo": "home_elo"}), "home_team", "left")
    return home.join(r.withColumnsRenamed({"team_id": "away_team", "elo": "away_elo"}), "away_team", "left").select("game_id", "home_elo", "away_elo")


def by_quartiles(games: DataFrame, seen: DataFrame, width: float = 100.0) -> DataFrame:
    """(game_id, home_elo, away_elo, prediction_low, prediction_high): the quartiles of margin among seen(elo_diff, margin)
    games with a difference of ratings of the same width; null where none was seen, or a rating is missing."""
    table = elo.margin_quartiles(seen, F.floor(F.col("elo_diff") / width))
    bucket = F.floor((F.col("home_elo") - F.col("away_elo")) / width)
    met = games.withColumn("bucket", bucket).join(table, "bucket", "left")
    return met.select("game_id", "home_elo", "away_elo", F.col("low").alias("prediction_low"), F.col("high").alias("prediction_high"))


def by_models(games: DataFrame, models: tuple[PipelineModel, PipelineModel]) -> DataFrame:
    """The same from fitted margin models, for games with both ratings; the home side's view, nobody missing."""
    known = games.where("home_elo is not null and away_elo is not null")
    rows = known.withColumns({"home": F.lit(1.0), "elo_diff": F.col("home_elo") - F.col("away_elo"), "minutes_missed": F.lit(0.0)})
    got = elo.margin_interval(rows, models)
    return got.select("game_id", "home_elo", "away_elo", F.col("low").alias("prediction_low"), F.col("high").alias("prediction_high"))


def store(catalog: Catalog, predictions: DataFrame) -> None:
    """Predictions replace those of the same games; results that are known stay."""
    known = catalog.table(TABLE).select("game_id", "result")
    catalog.upsert(TABLE, predictions.join(known, "game_id", "left"))


def settle(catalog: Catalog, results: DataFrame) -> None:
    """Sets the results(game_id, result) of games that were predicted."""
    catalog.update(TABLE, results, ["result"])
