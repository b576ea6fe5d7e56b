"""Match documents: one JSON file per game, in events/<league>_<season>/<game_id>.json.

A document of very many events may come in parts, rows with the place of their first event in first_event (0 in one part of each
game). A part names the players of its events; each player of the line-up is in one part. Documents without first_event are whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import EVENT, EVENT_COLUMNS, MATCH


def read(spark: SparkSession, path: str, games: DataFrame | None = None, missing: str = "error") -> DataFrame:
    """(game_id, the document's fields) of the files under path, or of those of games(game_id).

    missing says what an unknown game does: error, or skip."""
    docs = spark.read.schema(MATCH).option("multiLine", True).option("recursiveFileLookup", True).json(path)
    docs = docs.withColumn("game_id", F.regexp_extract(F.input_file_name(), r"(\d+)\.json$", 1).cast("long"))
    if games is None:
        return docs
    if missing == "error":
        wanted = games.select(F.col("game_id").cast("long").alias("game_id")).join(docs.withColumn("__there", F.lit(True)), "game_id", "left")
        bad = F.raise_error(F.concat(F.lit("no document of game "), F.col("game_id").cast("string"))).cast("boolean")
        return wanted.where(F.coalesce("__there", bad)).drop("__there").select(*docs.columns)
    return docs.join(games.select("game_id"), "game_id", "left_semi")


def _event(e: str = "e") -> dict[str, Column]:
    c = lambda name: F.col(f"{e}.{name}")
    number = lambda name: F.coalesce(c(name), F.lit(-1))
    flag = lambda name: F.coalesce(c(name), F.lit(False))
    label = lambda name: c(f"{name}.displayName")
    return {
        "period": label("period"), "minute": number("minute"), "second": number("second").cast("int"), "expanded_minute": number("expandedMinute"),
        "type": label("type"), "outcome_type": label("outcomeType"),
        "team_id": c("teamId"), "player_id": c("playerId"), "x": c("x"), "y": c("y"), "end_x": c("endX"), "end_y": c("endY"),
        "goal_mouth_y": c("goalMouthY"), "goal_mouth_z": c("goalMouthZ"),
        "blocked_x": c("blockedX"), "blocked_y": c("blockedY"),
        "qualifiers": F.coalesce(c("qualifiers"), F.array().cast("array<struct<type: struct<value: int, displayName: string>, value: string>>")),
        "is_touch": flag("isTouch"), "is_shot": flag("isShot"), "is_goal": flag("isGoal"), "card_type": label("cardType"),
        "related_event_id": c("relatedEventId"), "related_player_id": c("relatedPlayerId"),
    }


FIRST = "first_event"


def _once(docs: DataFrame) -> DataFrame:
    """One row per document, which may come in parts."""
    return docs.where(F.col(FIRST) == 0) if FIRST in docs.columns else docs


def events(docs: DataFrame, feed_id: bool = False) -> DataFrame:
    """One row per event: game_id, event_ordinal (its place in the document) and the event columns, labels as their
    names. Names of players and teams come from the document's own maps, so no join is needed; an id without a name is
    its own name. With feed_id also that: the feed's number of the event."""
    first = [FIRST] if FIRST in docs.columns else []
    each = docs.select(
        "game_id", *first, "playerIdNameDictionary", F.col("home.teamId").alias("__home"), F.col("home.name").alias("__home_name"),
        F.col("away.teamId").alias("__away"), F.col("away.name").alias("__away_name"), F.posexplode("events").alias("event_ordinal", "e")
    )
    cols = _event()
    player = F.col("e.playerId").cast("string")
    cols["player"] = F.coalesce(F.try_element_at("playerIdNameDictionary", player), player)
    team = F.col("e.teamId")
    cols["team"] = F.when(
        team == F.col("__home"), F.col("__home_name")
    ).when(team == F.col("__away"), F.col("__away_name")).otherwise(team.cast("string"))
    ordinal = F.col("event_ordinal") + F.col(FIRST) if first else F.col("event_ordinal")
    own = [F.col("e.id").cast("long").alias("feed_id")] if feed_id else []
    return each.select("game_id", ordinal.alias("event_ordinal"), *own, *(cols[c].alias(c) for c in EVENT_COLUMNS))


def raw(docs: DataFrame) -> DataFrame:
    """(game_id, events): the events as the documents, or their parts, have them."""
    return docs.select("game_id", "events")


def lineups(docs: DataFrame) -> DataFrame:
    """(game_id, team_id, player_id, player_name, is_starter, jersey_number)."""
    sides = F.array(*(F.struct(F.col(f"{s}.teamId").alias("team_id"), F.col(f"{s}.players").alias("players")) for s in ("home", "away")))
    each = docs.select("game_id", F.explode(sides).alias("s")).select("game_id", "s.team_id", F.explode("s.players").alias("p"))
    return each.select(
        "game_id", "team_id", F.col("p.playerId").alias("player_id"), F.col("p.name").alias("player_name"),
        F.coalesce("p.isFirstEleven", F.lit(False)).alias("is_starter"), F.col("p.shirtNo").alias("jersey_number")
    )


def teams(docs: DataFrame) -> DataFrame:
    """(game_id, team_id, team_name, is_home)."""
    sides = F.array(
        *(
            F.struct(
                F.col(f"{s}.teamId").alias("team_id"), F.col(f"{s}.name").alias("team_name"), F.lit(s == "home").alias("is_home")
            ) for s in ("home", "away")
        )
    )
    return _once(docs).select("game_id", F.explode(sides).alias("s")).select("game_id", "s.*")


def home_teams(docs: DataFrame) -> DataFrame:
    """(game_id, home_team_id), 0 where the document has none."""
    return _once(docs).select("game_id", F.coalesce("home.teamId", F.lit(0)).alias("home_team_id"))


def team_ids(schedule: DataFrame, docs: DataFrame) -> DataFrame:
    """(home_team, team_id): the id that each home side of the schedule has in its first game's document."""
    first = schedule.groupBy("home_team").agg(F.min_by("game_id", F.struct("date", "game_id")).alias("game_id"))
    return first.join(home_teams(docs), "game_id").select("home_team", F.col("home_team_id").alias("team_id"))


def raw_events(spark: SparkSession, path: str) -> DataFrame:
    """(game_id, event_ordinal, event variant): events as they are in the documents under path, with all their fields, those too that
    EVENT doesn't know. Documents without events give no rows."""
    docs = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(path, wholetext=True)
    docs = docs.select(F.regexp_extract(F.input_file_name(), r"(\d+)\.json$", 1).cast("long").alias("game_id"), F.parse_json("value").alias("d"))
    return split_events(docs)


def split_events(docs: DataFrame) -> DataFrame:
    """raw_events of docs(game_id, d variant)."""
    each = docs.select("game_id", F.variant_get("d", "$.events", "array<variant>").alias("events"))
    return each.select("game_id", F.posexplode("events").alias("event_ordinal", "event"))


def field(event: Column, path: str, kind: str) -> Column:
    """A typed value out of a raw event; null where it is absent or of another kind."""
    return F.try_variant_get(event, path, kind)


def unknown_fields(raw: DataFrame) -> DataFrame:
    """(path, kind, events): the fields of raw_events that EVENT doesn't name, and in how many events each kind of them occurs: what a feed
    has added."""
    known = StructType.fromDDL(f"event {EVENT}")["event"].dataType.names
    each = raw.select(F.explode(F.variant_get("event", "$", "map<string, variant>")).alias("path", "v")).where(~F.col("path").isin(*known))
    return each.groupBy("path", F.schema_of_variant("v").alias("kind")).agg(F.count("*").alias("events"))
