"""On-pitch intervals and minutes played, all games in one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import opposition, own_goal

SENT_OFF = ("SecondYellow", "Red")
#: off of a player who has not left the pitch.
STAYS = -1
#: Beyond any place in a document: substitutions on are seen after the line-up, those off after these.
_LATER = 1 << 40
_KEYS = ("cast(player_id as long) as player_id", "cast(game_id as long) as game_id")


def is_red_card() -> Column:
    return (F.col("type") == "Card") & F.col("card_type").isin(*SENT_OFF)


def is_full_time() -> Column:
    return (F.col("type") == "End") & (F.col("period") == "SecondHalf")


def end_of_game(events: DataFrame, strict: bool = True) -> DataFrame:
    """(game_id, end_of_game): the minute of the first full-time event in document order, or of the game's first red
    card if that comes earlier: it ends the game for all. Extra time doesn't count.

    A game without a full-time event is an error, or with strict off has no row."""
    marked = events.select("game_id", "expanded_minute", "event_ordinal", is_full_time().alias("full"), is_red_card().alias("red"))
    games = marked.groupBy("game_id").agg(
        F.expr("min_by(if(full, expanded_minute, null), if(full, event_ordinal, null)) as full_time"),
        F.expr("min(if(red, expanded_minute, null)) as red"),
    )
    return _ended(games, strict).select("game_id", "end_of_game")


def _ended(games: DataFrame, strict: bool) -> DataFrame:
    """games(game_id, full_time, red, ...) with end_of_game."""
    if not strict:
        games = games.where("full_time is not null")
    missing = "cast(raise_error(concat('no full-time event in game ', cast(game_id as string))) as int)"
    return games.withColumn("end_of_game", F.expr(f"least(coalesce(full_time, {missing}), red)"))


def game_facts(events: DataFrame, teams: DataFrame | None = None, strict: bool = True) -> DataFrame:
    """(game_id, end_of_game, goals array<struct<minute, team>>): what end_of_game and goals.goals give, from one pass.

    Of several goals in one expanded minute the last holds, so goals has an entry for each minute at most. The two sides
    come from teams(game_id, team_id), or else from the events."""
    marked = events.select(
        "game_id", "expanded_minute", "event_ordinal", "team_id", is_full_time().alias("full"), is_red_card().alias("red"),
        F.expr("if(is_goal, event_ordinal, null) as goal_at"), own_goal(F.col("qualifiers")).alias("own"),
    )
    aggregates = (
        "min(if(full, event_ordinal, null)) as full_at", "max(red) as red", "max(goal_at) as goal_at", "min(team_id) as one", "max(team_id) as other",
        "max_by(team_id, goal_at) as team", "max_by(own, goal_at) as own",
    )
    minutes = marked.groupBy("game_id", "expanded_minute").agg(*map(F.expr, aggregates))
    aggregates = (
        "min_by(expanded_minute, full_at) as full_time", "min(if(red, expanded_minute, null)) as red", "min(one) as one", "max(other) as other",
        "collect_list(if(goal_at is null, null, struct(expanded_minute as minute, team, own))) as goals",
    )
    games = minutes.groupBy("game_id").agg(*map(F.expr, aggregates))
    if teams is not None:
        pair = teams.groupBy("game_id").agg(F.min("team_id").alias("one"), F.max("team_id").alias("other"))
        games = games.drop("one", "other").join(pair, "game_id", "left")
    credited = F.transform(
        "goals",
        lambda g: F.struct(
            g["minute"].alias("minute"), F.when(g["own"], opposition(g["team"], F.col("one"), F.col("other"))).otherwise(g["team"]).alias("team")
        )
    )
    return _ended(games, strict).select("game_id", "end_of_game", credited.alias("goals"))


def entries(lineups: DataFrame, events: DataFrame) -> DataFrame:
    """(game_id, player_id, team_id, minute_on, minute_off, seen): starters, then substitutions in document order."""
    sub_on, sub_off = F.col("type") == "SubstitutionOn", F.col("type") == "SubstitutionOff"
    start = lineups.where("is_starter").select(
        "game_id", "player_id", "team_id", F.lit(0).alias("minute_on"), F.lit(STAYS).alias("minute_off"), F.lit(0).cast("long").alias("seen")
    )
    subs = events.where(sub_on | sub_off).select(
        "game_id", "player_id", "team_id", F.when(sub_on, F.col("expanded_minute")).otherwise(0).alias("minute_on"),
        F.when(sub_off, F.col("expanded_minute")).otherwise(STAYS).alias("minute_off"),
        (F.when(sub_on, _LATER).otherwise(2 * _LATER) + F.col("event_ordinal")).alias("seen"),
    )
    return start.unionByName(subs)


def intervals(lineups: DataFrame, events: DataFrame, strict: bool = True) -> DataFrame:
    """(game_id, player_id, team_id, minute_on, minute_off, end_of_game) of each player who was on the pitch.

    lineups(game_id, player_id, team_id, is_starter); events(game_id, event_ordinal, type, period, expanded_minute,
    player_id, team_id, card_type). Of several entries of a player the largest minutes hold, so who leaves and returns
    has minute_off before minute_on. Player 0 and null are left out, and who enters after the end. The team is the
    first one seen: line-up, then substitutions in document order."""
    return spells(entries(lineups, events), end_of_game(events, strict))


def spells(entries_: DataFrame, games: DataFrame) -> DataFrame:
    """The last step of intervals: from entries and games(game_id, end_of_game, ...), whose further columns stay."""
    largest = ("min_by(team_id, seen) as team_id", "max(minute_on) as minute_on", "max(minute_off) as minute_off")
    players = entries_.where("player_id <> 0").groupBy("game_id", "player_id").agg(*map(F.expr, largest))
    rest = [c for c in games.columns if c not in ("game_id", "end_of_game")]
    off = f"if(minute_off = {STAYS} or minute_off > end_of_game, end_of_game, minute_off) as minute_off"
    on = players.join(games, "game_id").where("minute_on <= end_of_game")
    return on.selectExpr("game_id", "player_id", "team_id", "minute_on", off, "end_of_game", *rest)


def minutes_metric(on_pitch: DataFrame) -> DataFrame:
    return as_metric(on_pitch, F.col("minute_off") - F.col("minute_on"), "minutes")


def as_metrics(rows: DataFrame, values: dict[str, Column]) -> DataFrame:
    """as_metric for several metrics of the same rows, which are read once."""
    each = F.inline(F.array(*(F.struct(F.lit(k).alias("metric"), v.cast("double").alias("value")) for k, v in values.items())))
    return rows.select(*map(F.expr, _KEYS), each)


def as_metric(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """(player_id, game_id, metric, value) of one row per player and game."""
    return rows.select(*map(F.expr, _KEYS), F.lit(name).alias("metric"), value.cast("double").alias("value"))
