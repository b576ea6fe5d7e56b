"""Goals for and against while a player is on the pitch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import opposition, own_goal
from .minutes import as_metric


def goals(events: DataFrame, teams: DataFrame, every: bool = False) -> DataFrame:
    """(game_id, expanded_minute, goal_team_id); own goals count for the other of the game's teams(game_id, team_id).

    Of several goals in one expanded minute only the last in document order is kept; every=True keeps all of them."""
    pair = teams.groupBy("game_id").agg(F.min("team_id").alias("one"), F.max("team_id").alias("other"))
    scored = events.where("is_goal").select("game_id", "event_ordinal", "expanded_minute", "team_id", own_goal(F.col("qualifiers")).alias("own"))
    if not every:
        scored = scored.groupBy("game_id", "expanded_minute").agg(
            F.max_by("team_id", "event_ordinal").alias("team_id"), F.max_by("own", "event_ordinal").alias("own")
        )
    team = F.when(F.col("own"), opposition(F.col("team_id"), F.col("one"), F.col("other"))).otherwise(F.col("team_id"))
    return scored.join(pair, "game_id", "left").select("game_id", "expanded_minute", team.alias("goal_team_id"))


def on_pitch_goals(on_pitch: DataFrame, scored: DataFrame) -> DataFrame:
    """on_pitch with goals_for and goals_against: goals strictly between minute_on and minute_off, by team.

    A game's goals are a list on the row of the game, one entry for each minute and team with their number, so players meet
    them in one join on the game, nothing is multiplied or grouped again, and the list is no longer than a game has minutes."""
    each = scored.groupBy("game_id", F.col("expanded_minute").alias("minute"), F.col("goal_team_id").alias("team")).agg(F.count("*").alias("n"))
    games = each.groupBy("game_id").agg(F.collect_list(F.struct("minute", "team", "n")).alias("goals"))
    return _counted(on_pitch.join(games, "game_id", "left"), lambda which: f"aggregate(goals, 0L, (s, g) -> if({_INSIDE} and g.team {which} team_id, s + g.n, s))")


_INSIDE = "g.minute > minute_on and g.minute < minute_off"


def counted(on_pitch: DataFrame) -> DataFrame:
    """on_pitch with goals, a list of (minute, team) or null, as goals_for and goals_against."""
    return _counted(on_pitch, lambda which: f"cast(size(filter(goals, g -> {_INSIDE} and g.team {which} team_id)) as long)")


def _counted(on_pitch: DataFrame, count: Callable[[str], str]) -> DataFrame:
    keep = [c for c in on_pitch.columns if c != "goals"]
    none = "if(goals is null, 0L, {})"
    return on_pitch.selectExpr(*keep, none.format(count("=")) + " as goals_for", none.format(count("<>")) + " as goals_against")


def goals_metric(counted: DataFrame) -> DataFrame:
    return as_metric(counted, F.col("goals_for") - F.col("goals_against"), "goals")
