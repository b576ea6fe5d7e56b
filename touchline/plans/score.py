"""Scoring: the four metrics of all new games in one job."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import actions, actionvalue, goals, minutes, threat
from ..operators.dedup import unprocessed
from ..sources import matches
from .catalog import Catalog

METRICS = "metrics.player_game_metric"


def facts(docs: DataFrame, strict: bool = True) -> dict[str, DataFrame]:
    """What the metrics are made of, from match documents: events, lineups, teams, home, actions and on_pitch."""
    events, lineups = matches.events(docs), matches.lineups(docs)
    home = matches.home_teams(docs)
    on_pitch, stream = minutes.intervals(lineups, events, strict), actions.from_events(events, home)
    return {"events": events, "lineups": lineups, "teams": matches.teams(docs), "home": home, "actions": stream, "on_pitch": on_pitch}


def metrics(f: dict[str, DataFrame], grid: DataFrame | list[float] | None = None, models: actionvalue.Models | None = None) -> DataFrame:
    """(player_id, game_id, metric, value): minutes, goals, xt and vaep; without a model its metric has no rows."""
    scored = goals.on_pitch_goals(f["on_pitch"], goals.goals(f["events"], f["teams"]))
    both = {"minutes": F.col("minute_off") - F.col("minute_on"), "goals": F.col("goals_for") - F.col("goals_against")}
    parts = [
        minutes.as_metrics(scored, both), threat.xt_metric(f["on_pitch"], f["actions"], grid),
        actionvalue.vaep_metric(f["on_pitch"], f["actions"], models)
    ]
    return reduce(DataFrame.unionByName, parts)


def player_games(f: dict[str, DataFrame]) -> DataFrame:
    """Rows of basis.player_game."""
    scored = goals.on_pitch_goals(f["on_pitch"], goals.goals(f["events"], f["teams"]))
    kit = f["lineups"].groupBy("game_id", "player_id").agg(F.max("jersey_number").alias("kit_number"), F.max("is_starter").alias("starter"))
    home = f["home"]
    rows = scored.join(kit, ["game_id", "player_id"], "left").join(home, "game_id", "left")
    return rows.selectExpr(
        "player_id", "game_id", "team_id", "minute_off - minute_on as minutes", "cast(coalesce(starter, false) as int) as starter",
        "cast(goals_for as int) as goals_for", "cast(goals_against as int) as goals_against", "kit_number",
        "cast(team_id = home_team_id as int) as is_home"
    )


def run(catalog: Catalog, docs: DataFrame, grid: DataFrame | None = None, models=None, strict: bool = True) -> None:
    """Scores the documents of games that have no metric yet, and stores metrics and player games.

    The metrics of a batch are one upsert, so a game is there with all of them or not at all."""
    new = unprocessed(docs, catalog.table(METRICS).select("game_id").distinct(), "game_id").persist()
    try:
        f = facts(new, strict)
        catalog.upsert("basis.player_game", player_games(f))
        catalog.upsert(METRICS, metrics(f, grid, models))
    finally:
        new.unpersist()
