"""Latest, as-of and average ratings, and the wide player tables made of them.

base_metric(player_id, game_id, game_date, version, metric, metric_value); games(game_id, player_id, minutes, game_date,
team_id, league, version, ...); squads(player_id, kit_number, team_id, valid_from, valid_to); players(id, ...).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A club's or league's average looks back so far; a club needs so many entries to have one.
AVERAGE_WEEKS, LEAST_ENTRIES, RECENT_DAYS = 24, 50, 90


def ranked(base_metric: DataFrame) -> DataFrame:
    """player_id, metric, metric_value, game_date and rank 1 for the latest date of each player and metric; ties share it."""
    w = Window.partitionBy("player_id", "metric").orderBy(F.col("game_date").desc())
    return base_metric.select("player_id", "metric", "metric_value", "game_date", F.rank().over(w).alias("rank"))


def latest(base_metric: DataFrame, version: float, metric: str | None = "elo") -> DataFrame:
    """(player_id, metric_value) of each player's latest game, the largest game_id deciding ties."""
    rows = base_metric.where(F.col("version") == version)
    rows = rows if metric is None else rows.where(F.col("metric") == metric)
    return rows.groupBy("player_id").agg(F.max_by("metric_value", F.struct("game_date", "game_id")).alias("metric_value"))


def as_of(base_metric: DataFrame, when: DataFrame, version: float, metric: str) -> DataFrame:
    """A row for each row of when(player_id, at) with the metric's latest value strictly before at, null without one.

    Both sides are one table in the order of their dates, and a window takes the last value seen: each row is read once,
    however many days a player is asked for. Of equal dates, what is asked comes before what is known."""
    m = base_metric.where((F.col("version") == version) & (F.col("metric") == metric))
    known = m.select("player_id", F.col("game_date").alias("at"), "game_id", F.struct("metric_value").alias("seen"))
    asked = when.select("player_id", "at", F.lit(None).cast("long").alias("game_id"), F.lit(None).cast(known.schema["seen"].dataType).alias("seen"))
    before = Window.partitionBy("player_id").orderBy("at", F.col("seen").isNotNull(), "game_id").rowsBetween(Window.unboundedPreceding, 0)
    both = known.withColumn("known", F.lit(True)).unionByName(asked.withColumn("known", F.lit(False)))
    return both.withColumn("last", F.last("seen", ignorenulls=True).over(before)).where("not known").select(
        "player_id", "at", F.col("last.metric_value").alias("metric_value")
    )


def recent(games: DataFrame, day: date, days: int = RECENT_DAYS, bounded: bool = False) -> DataFrame:
    """(player_id, entries, total_minutes) of games from so many days before day on; bounded leaves out later ones."""
    rows = games.where(F.col("game_date") >= F.date_sub(F.lit(day), days))
    rows = rows.where(F.col("game_date") <= F.lit(day)) if bounded else rows
    return rows.groupBy("player_id").agg(F.count("*").alias("entries"), F.sum("minutes").alias("total_minutes"))


def averages(games: DataFrame, base_metric: DataFrame, by: str, day: date, version: float, as_of_day: bool = False) -> DataFrame:
    """(by, average, entries) per club (team_id) or league: the mean Elo of its players in their latest game for it.

    Entries of any version count if they fall on that date and not over AVERAGE_WEEKS before day; as_of_day leaves out
    what lies after day."""
    return _averages(games, base_metric, [[by]], day, version, as_of_day).select(by, "average", "entries")


def _averages(games: DataFrame, base_metric: DataFrame, sets: list[list[str]], day: date, version: float, as_of_day: bool = False) -> DataFrame:
    """averages for several groupings at once: all their columns, null where a row's grouping leaves them out."""
    own = games.where(F.col("version") == version)
    own = own.where(F.col("game_date") <= F.lit(day)) if as_of_day else own
    keys = sorted({c for s in sets for c in s})
    finest = own.groupBy(*keys, "player_id").agg(F.max("game_date").alias("game_date"), F.count("*").alias("n"))
    kinds = {c: finest.schema[c].dataType for c in keys}
    each = [F.struct(*((F.col(c) if c in s else F.lit(None).cast(kinds[c])).alias(c) for c in keys)) for s in sets]
    spread = finest.select("player_id", "game_date", "n", F.inline(F.array(*each)))
    newest = spread.groupBy(*keys, "player_id").agg(F.max("game_date").alias("game_date"), F.sum("n").alias("n")) if len(sets) > 1 else finest
    elo = base_metric.where(
        (F.col("metric") == "elo") & (F.col("game_date") >= F.date_sub(F.lit(day), 7 * AVERAGE_WEEKS))
    ).select("player_id", "game_date", "metric_value")
    met = newest.join(
        elo.groupBy("player_id", "game_date").agg(F.sum("metric_value").alias("s"), F.count("metric_value").alias("c")), ["player_id", "game_date"],
        "left"
    )
    return met.groupBy(*keys).agg(F.try_divide(F.sum("s"), F.sum("c")).alias("average"), F.sum("n").alias("entries"))


def club_or_league(games: DataFrame, base_metric: DataFrame, day: date, version: float) -> DataFrame:
    """(team_id, league, average): the club's average where it has LEAST_ENTRIES entries, else its league's."""
    both = _averages(games, base_metric, [["team_id"], ["league"]], day, version)
    club = both.where("team_id is not null").select("team_id", F.when(F.col("entries") >= LEAST_ENTRIES, F.col("average")).alias("club"))
    league = both.where("league is not null").select("league", F.col("average").alias("of_league"))
    teams = games.select("team_id", "league").distinct()
    return teams.join(club, "team_id", "left").join(league, "league", "left").select(
        "team_id", "league", F.coalesce("club", "of_league").alias("average")
    )


def players_per_league(games: DataFrame, version: float) -> DataFrame:
    return games.where(F.col("version") == version).groupBy("league").agg(F.countDistinct("player_id").alias("n_players"))


def squad_on(squads: DataFrame, day: Column) -> DataFrame:
    """Squad rows valid on a day, both ends included (so two rows on the day of a change)."""
    return squads.where(day.between(F.col("valid_from"), F.col("valid_to"))).select("player_id", "kit_number", "team_id")


def basic_info(ids: DataFrame, players: DataFrame, games: DataFrame, squads: DataFrame, day: date) -> DataFrame:
    """Each requested id with exists, player columns, kit number and team on the day, and recent entries and minutes."""
    found = players.withColumn("exists", F.lit(True)).join(squad_on(squads, F.lit(day)).withColumnRenamed("player_id", "id"), "id", "left")
    found = found.join(recent(games, day).withColumnRenamed("player_id", "id"), "id", "left")
    return ids.select("id").distinct().join(found, "id", "left").withColumn("exists", F.coalesce("exists", F.lit(False))).distinct()


def overall_info(
    ids: DataFrame, players: DataFrame, base_metric: DataFrame, games: DataFrame, squads: DataFrame, day: date, metrics: list[str]
) -> DataFrame:
    """basic_info of the players that have some metric, with a column of the latest value per metric (the largest game_id
    deciding ties); players without any count as not existing, as all their columns are null."""
    best = Window.partitionBy("player_id", "metric").orderBy(F.col("game_date").desc(), F.col("game_id").desc())
    top = base_metric.withColumn("__rank", F.row_number().over(best)).where("__rank = 1")
    wide = top.groupBy(F.col("player_id").alias("id")).pivot("metric", metrics).agg(F.first("metric_value"))
    with_metric = players.join(wide, "id")
    return basic_info(ids, with_metric, games, squads, day)


def games_for_training(games: DataFrame, version: float, last: int = -1) -> DataFrame:
    """Valid games of a version, or the latest so many games of any."""
    return games.where((F.col("version") == version) & (F.col("valid") == 1)) if last < 0 else games.orderBy(
        F.col("game_date").desc(), F.col("game_id").desc(), F.col("player_id")
    ).limit(last)


def within(schedule: DataFrame, column: str, start, end) -> DataFrame:
    """Rows with start <= column <= end."""
    return schedule.where(F.col(column).between(F.lit(start), F.lit(end)))


def valid_for_training(players: DataFrame, by: str, share: float = 0.2) -> DataFrame:
    """(by, valid_for_training): 0 if over a fifth of players(exists, entries) don't exist, or have under 5 entries."""
    unknown = F.avg((~F.col("exists")).cast("double"))
    few = F.avg(F.coalesce((F.col("entries") < 5).cast("double"), F.lit(0.0)))
    return players.groupBy(by).agg(F.when((unknown > share) | (few > share), 0).otherwise(1).alias("valid_for_training"))


def commonest_result(games: DataFrame) -> DataFrame:
    """(game_id, team_id, result): the most frequent result of each game and team, the smallest of equals."""
    return _sides(games).select("game_id", "team_id", "result")


def _sides(games: DataFrame) -> DataFrame:
    """(game_id, team_id, result, elo, home): commonest_result with the mean Elo and home, from one pass."""
    extra = [c for c in ("elo", "home") if c in games.columns]
    sums = {"elo": [F.sum("elo").alias("s"), F.count("elo").alias("c")], "home": [F.max("home").alias("home")]}
    n = games.groupBy("game_id", "team_id", "result").agg(F.count("*").alias("n"), *(a for c in extra for a in sums[c]))
    best = F.min_by("result", F.struct((-F.col("n")).alias("n"), "result")).alias("result")
    totals = {"elo": F.try_divide(F.sum("s"), F.sum("c")).alias("elo"), "home": F.max("home").alias("home")}
    return n.groupBy("game_id", "team_id").agg(best, *(totals[c] for c in extra))


def team_pairs(games: DataFrame) -> DataFrame:
    """(game_id, home_team, away_team, result, home_elo, away_elo): the two sides of each game with their mean Elo."""
    both = _sides(games).groupBy("game_id").agg(F.collect_list(F.struct("team_id", "home", "result", "elo")).alias("sides"))  # two a game
    home = both.select("game_id", "sides", F.explode(F.filter("sides", lambda s: s["home"] == 1)).alias("h"))
    pairs = home.select("game_id", "h", F.explode(F.filter("sides", lambda s: s["team_id"] != F.col("h.team_id"))).alias("a"))
    return pairs.select(
        "game_id", F.col("h.team_id").alias("home_team"), F.col("a.team_id").alias("away_team"), "h.result", F.col("h.elo").alias("home_elo"),
        F.col("a.elo").alias("away_elo")
    )
