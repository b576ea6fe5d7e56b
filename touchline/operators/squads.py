"""Squad membership over time: rows valid from a day to a day, both included."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ALWAYS, FOREVER = date(1900, 1, 1), date(2099, 12, 31)


def history(entries: DataFrame) -> DataFrame:
    """Squad rows from entries(player_id, kit_number, team_id, day): each is valid until the player's next one."""
    w = Window.partitionBy("player_id").orderBy("day", "team_id", "kit_number")
    return entries.select(
        "player_id", "kit_number", "team_id", F.col("day").alias("valid_from"), F.coalesce(F.lead("day").over(w), F.lit(FOREVER)).alias("valid_to")
    )


#: What an event of a log is: a player enters, a player changes, or a number is taken by nobody known.
ENTER, CHANGE, TAKE = "enter", "change", "take"


def replay(squads: DataFrame, log: DataFrame) -> DataFrame:
    """squads after the events of log(kind, player_id, kit_number, team_id, day) one after another, by day, then by seq if log
    has it, then by player, team and number.

    Each event ends the row that is valid on its day with its team and number; a change also ends the player's open rows.
    Then ENTER makes a row that is valid always, CHANGE one from its day on, TAKE none. As events are in order, no state
    has to be carried: a row ends on the day of the next event of its number or, if it is open, of its player's next change,
    whichever is first. So old rows and events make one table, and two windows look ahead, by number and by player.
    Events without a day are left out; a null number, team or player is nobody's."""
    seq = F.col("seq").cast("long") if "seq" in log.columns else F.lit(0).cast("long")
    events = log.where("day is not null").select(
        "player_id", "kit_number", "team_id", F.when(F.col("kind") == ENTER, F.lit(ALWAYS)).otherwise(F.col("day")).alias("valid_from"),
        F.lit(FOREVER).alias("valid_to"), F.lit(1).alias("__event"), "kind", F.col("day").alias("__day"), seq.alias("__seq")
    )
    rows = squads.select(
        "player_id", "kit_number", "team_id", "valid_from", "valid_to", F.lit(0).alias("__event"), F.lit(None).cast("string").alias("kind"),
        F.col("valid_from").alias("__day"), F.lit(0).cast("long").alias("__seq")
    ).unionByName(events)
    last_first = [F.desc(c) for c in ("__day", "__event", "__seq", "player_id", "team_id", "kit_number", "kind")]
    later = lambda *keys, by: Window.partitionBy(*keys).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    taken = F.min(F.when(F.col("__event") == 1, F.col("__day"))).over(later("team_id", "kit_number", by=last_first))
    # an open row ends by its player's change even if that is dated before the row begins
    moved = F.min(F.when(F.col("kind") == CHANGE, F.col("__day"))).over(later("player_id", by=[F.desc("__event"), *last_first]))
    numbered, known = F.col("team_id").isNotNull() & F.col("kit_number").isNotNull(), F.col("player_id").isNotNull()
    ends = F.least("valid_to", F.when(numbered, taken), F.when(known & (F.col("valid_to") == F.lit(FOREVER)), moved))
    done = rows.withColumn("__ends", ends).where(f"__event = 0 or kind <> '{TAKE}'")
    return done.select("player_id", "kit_number", "team_id", "valid_from", F.col("__ends").alias("valid_to"))


def close_number(squads: DataFrame, changes: DataFrame) -> DataFrame:
    """squads after the numbers in changes(team_id, kit_number, day) were taken."""
    return replay(squads, changes.select(F.lit(TAKE).alias("kind"), F.lit(None).cast("long").alias("player_id"), "kit_number", "team_id", "day"))


def enter(squads: DataFrame, new: DataFrame) -> DataFrame:
    """squads after new(player_id, kit_number, team_id, day) players without a row entered, valid always."""
    return replay(squads, new.withColumn("kind", F.lit(ENTER)))


def change(squads: DataFrame, changes: DataFrame) -> DataFrame:
    """squads after changes(player_id, kit_number, team_id, day): who had the number gives it up, the player's open
    row ends, and a new one begins. A batch may hold several changes of a player, and a number that goes from hand to hand."""
    return replay(squads, changes.withColumn("kind", F.lit(CHANGE)))


def events_of(squads: DataFrame, seen: DataFrame) -> DataFrame:
    """The log that line-ups seen(player_id, kit_number, team_id, day; seq) amount to: of a player without a row the first is an
    ENTER, every other one a CHANGE, unless the player's open row says the same.

    It does if the sighting before it of the player and that of the number are the same one, open rows counting as the
    first sightings. That holds for squads in which no player has two open rows and no number two players. Sightings with
    a null are left out; those that repeat change nothing."""
    seq = F.col("seq").cast("long") if "seq" in seen.columns else F.lit(0).cast("long")
    key = ["player_id", "kit_number", "team_id"]
    new = seen.select(*key, "day", seq.alias("seq")).dropna()
    open_ = squads.where(F.col("valid_to") == F.lit(FOREVER)).select(*key, F.lit(None).cast("date").alias("day"), F.lit(None).cast("long").alias("seq"))
    rows = open_.unionByName(new)
    order = [F.asc_nulls_first("day"), F.asc_nulls_first("seq"), "player_id", "team_id", "kit_number"]
    mine, same = Window.partitionBy("player_id").orderBy(*order), Window.partitionBy("team_id", "kit_number").orderBy(*order)
    before = F.lag(F.struct("team_id", "kit_number")).over(mine)
    stays = before.eqNullSafe(F.struct("team_id", "kit_number")) & F.lag("player_id").over(same).eqNullSafe(F.col("player_id"))
    marked = rows.withColumns({"__stays": stays, "__nth": F.row_number().over(mine)}).where("day is not null and not __stays")
    known = squads.where("player_id is not null").select("player_id", F.lit(True).alias("__known")).distinct()
    first = (F.col("__nth") == 1) & F.col("__known").isNull()
    return marked.join(known, "player_id", "left").select(F.when(first, ENTER).otherwise(CHANGE).alias("kind"), *key, "day", "seq")


def sync(squads: DataFrame, seen: DataFrame) -> DataFrame:
    """squads brought up to date with line-ups seen(player_id, kit_number, team_id, day; seq), in order: players without a row
    enter, those whose open row differs change, those whose open row is the same stay as they are."""
    return replay(squads, events_of(squads, seen))


def match(lineups: DataFrame, squads: DataFrame, teams: DataFrame, day: Column) -> DataFrame:
    """lineups(team_name, kit_number, ...) with the player_id of the squad row with that team and number on the day:
    the one with the latest valid_from, null without one. Rows that repeat keep their number."""
    names = teams.select(F.col("id").alias("__team"), F.col("name").alias("team_name"))
    named = lineups.join(names, "team_name", "left").withColumn("__day", day)
    asked = named.select("__team", "kit_number", "__day").distinct()
    s = squads.select(F.col("team_id").alias("__team"), "kit_number", F.col("player_id").alias("__player"), "valid_from", "valid_to")
    met = asked.join(s, ["__team", "kit_number"]).where(F.col("__day").between(F.col("valid_from"), F.col("valid_to")))
    best = met.groupBy("__team", "kit_number", "__day").agg(F.max_by("__player", F.struct("valid_from", "__player")).alias("player_id"))
    return named.join(best, ["__team", "kit_number", "__day"], "left").select(*lineups.columns, "player_id")
