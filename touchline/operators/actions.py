"""Match events as a stream of actions with the ball, after the published definition of the action language for players:
(game_id, period_id, action_id, time_seconds, team_id, player_id, start_x, start_y, end_x, end_y, type_name, result_name,
bodypart_name), on a pitch of 105 by 68 metres, the home side playing from left to right."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PITCH_X, PITCH_Y = 105.0, 68.0
# The types, results and body parts of the published definition.
PASSES = ("pass", "cross", "throw_in", "freekick_crossed", "freekick_short", "corner_crossed", "corner_short", "goalkick")
SHOTS = ("shot", "shot_penalty", "shot_freekick")
KEEPER = ("keeper_save", "keeper_claim", "keeper_punch", "keeper_pick_up")
TYPES = (*PASSES, "take_on", "foul", "tackle", "interception", *SHOTS, *KEEPER, "clearance", "bad_touch", "dribble")
RESULTS = ("success", "fail", "offside", "owngoal", "yellow_card", "red_card")
BODY_PARTS = ("foot", "head", "other")
#: Where the ball was out of play before.
RESTARTS = ("throw_in", "goalkick", "corner_crossed", "corner_short")
#: A dribble is what lies between two actions of a team so many metres and less than so many seconds apart.
DRIBBLE_METRES, DRIBBLE_SECONDS = (3.0, 60.0), 10.0
_PERIODS = ("FirstHalf", "SecondHalf", "FirstPeriodOfExtraTime", "SecondPeriodOfExtraTime")
_PLAIN = {
    "TakeOn": "take_on", "Tackle": "tackle", "Interception": "interception", "BlockedPass": "interception", "Save": "keeper_save",
    "Claim": "keeper_claim", "Punch": "keeper_punch",
    "KeeperPickup": "keeper_pick_up", "Clearance": "clearance",
}
_COLUMNS = ("time_seconds", "team_id", "player_id", "start_x", "start_y", "end_x", "end_y", "type_name", "result_name", "bodypart_name")


def has(qualifier: str) -> Column:
    return F.coalesce(F.exists("qualifiers", lambda q: q["type"]["displayName"] == qualifier), F.lit(False))


def type_name() -> Column:
    """The action that an event is, null for none. Who commits a foul acts, not who is fouled; a touch is one if it fails."""
    kind, good = F.col("type"), F.coalesce(F.col("outcome_type") == "Successful", F.lit(False))
    free = has("FreekickTaken") | has("IndirectFreekickTaken")
    passed = (
        F.when(has("ThrowIn"), "throw_in").when(has("GoalKick"), "goalkick")
        .when(has("CornerTaken"), F.when(has("Cross"), "corner_crossed").otherwise("corner_short"))
        .when(free, F.when(has("Cross") | has("Chipped"), "freekick_crossed").otherwise("freekick_short"))
        .when(has("Cross"), "cross").otherwise("pass")
    )
    shot = F.when(has("Penalty"), "shot_penalty").when(has("DirectFreekick"), "shot_freekick").otherwise("shot")
    out = F.when(kind.isin("Pass", "OffsidePass"), passed).when(kind.isin("MissedShots", "ShotOnPost", "SavedShot", "Goal"), shot)
    out = out.when((kind == "Foul") & ~good, "foul").when((kind == "BallTouch") & ~good, "bad_touch")
    return reduce(lambda c, kv: c.when(kind == kv[0], kv[1]), _PLAIN.items(), out)


def result_name(name: Column) -> Column:
    good = F.col("outcome_type") == "Successful"
    shot = F.when(has("OwnGoal"), "owngoal").when(F.col("type") == "Goal", "success").otherwise("fail")
    return F.when(
        F.col("type") == "OffsidePass", "offside"
    ).when(name.isin(*SHOTS), shot).when(name == "foul", "fail").when(has("OwnGoal"), "owngoal").when(good, "success").otherwise("fail")


def bodypart_name(name: Column) -> Column:
    other = name.isin("throw_in", *KEEPER) | has("OtherBodyPart")
    return F.when(has("Head"), "head").when(other, "other").otherwise("foot")


def from_events(events: DataFrame, home: DataFrame, dribbles: bool = True) -> DataFrame:
    """The action stream of events, as matches.events gives them; home(game_id, home_team_id).

    Events that are no action with the ball are left out. Passes end where the feed says; shots where they were blocked,
    else in the goal's mouth; a clearance ends where the next action begins, as does any action without an end. Between
    actions of one team that lie apart a dribble is put in, by who acts next. action_id counts from 0 in each game, in
    document order. All of it is one shuffle by game."""
    name = type_name()
    period = reduce(lambda c, kv: c.when(F.col("period") == kv[1], kv[0] + 1), enumerate(_PERIODS), F)
    shot, pass_ = F.col("type_name").isin(*SHOTS), F.col("type_name").isin(*PASSES)
    rows = events.withColumns({"type_name": name, "period_id": period}).where(
        "type_name is not null and period_id is not null"
    ).join(home, "game_id", "left")
    rows = rows.withColumns({"result_name": result_name(F.col("type_name")), "bodypart_name": bodypart_name(F.col("type_name"))})
    to_x = F.when(shot, F.coalesce("blocked_x", F.when(F.col("goal_mouth_y").isNotNull(), F.lit(100.0)))).when(pass_, F.col("end_x"))
    to_y = F.when(shot, F.coalesce("blocked_y", "goal_mouth_y")).when(pass_, F.col("end_y"))
    place = lambda c, size: F.when(F.col("team_id") == F.col("home_team_id"), c / 100 * size).otherwise(size - c / 100 * size)
    placed = rows.select(
        "game_id", "period_id", "event_ordinal",
        (F.col("expanded_minute") * 60 + F.coalesce(F.greatest("second", F.lit(0)), F.lit(0))).cast("double").alias("time_seconds"), "team_id",
        "player_id",
        place(F.col("x"), PITCH_X).alias("start_x"), place(F.col("y"), PITCH_Y).alias("start_y"), place(to_x, PITCH_X).alias("to_x"),
        place(to_y, PITCH_Y).alias("to_y"), "type_name", "result_name", "bodypart_name",
    )
    game = Window.partitionBy("game_id").orderBy("period_id", "event_ordinal")
    following = F.struct("period_id", "team_id", "player_id", "time_seconds", "start_x", "start_y", "type_name")
    met = placed.withColumn("next", F.lead(following).over(game)).withColumn(
        "next", F.when(F.col("next.period_id") == F.col("period_id"), F.col("next"))
    )
    open_end = F.col("type_name") == "clearance"
    ends = {c: F.coalesce(F.when(~open_end, F.col(f"to_{c}")), F.when(open_end, F.col(f"next.start_{c}")), F.col(f"start_{c}")) for c in "xy"}
    met = met.withColumns({"end_x": ends["x"], "end_y": ends["y"]})
    own = F.struct(F.lit(0).alias("step"), *_COLUMNS)
    gap = F.hypot(F.col("next.start_x") - F.col("end_x"), F.col("next.start_y") - F.col("end_y"))
    soon = F.col("next.time_seconds") - F.col("time_seconds") < DRIBBLE_SECONDS
    carried = (F.col("next.team_id") == F.col("team_id")) & soon & gap.between(*DRIBBLE_METRES) & ~F.col("next.type_name").isin(*RESTARTS)
    between = F.struct(
        F.lit(1).alias("step"), ((F.col("time_seconds") + F.col("next.time_seconds")) / 2).alias("time_seconds"), "team_id",
        F.col("next.player_id").alias("player_id"), F.col("end_x").alias("start_x"),
        F.col("end_y").alias("start_y"), F.col("next.start_x").alias("end_x"), F.col("next.start_y").alias("end_y"),
        F.lit("dribble").alias("type_name"), F.lit("success").alias("result_name"), F.lit("foot").alias("bodypart_name"),
    )
    parts = F.when(carried, F.array(own, between)).otherwise(F.array(own)) if dribbles else F.array(own)
    each = met.select("game_id", "period_id", "event_ordinal", F.inline(parts))
    number = F.row_number().over(Window.partitionBy("game_id").orderBy("period_id", "event_ordinal", "step")) - 1
    return each.withColumn("action_id", number).select("game_id", "period_id", "action_id", *_COLUMNS)


def atomic(actions: DataFrame) -> DataFrame:
    """Actions as atomic ones: place and movement (x, y, dx, dy), with what comes of an action as one of its own half a step
    later, at its end: the receival of a successful pass (by who acts next, if of the same team), the interception of a
    failed one by the other side, offside, out where play begins anew, goals and own goals, and cards."""
    moved = actions.select(
        "game_id", "period_id", F.col("action_id").cast("double").alias("action_id"), "time_seconds", "team_id", "player_id",
        F.col("start_x").alias("x"), F.col("start_y").alias("y"),
        (F.col("end_x") - F.col("start_x")).alias("dx"), (F.col("end_y") - F.col("start_y")).alias("dy"), "type_name", "result_name",
    )
    order = Window.partitionBy("game_id", "period_id").orderBy("action_id")
    met = moved.withColumn("next", F.lead(F.struct("team_id", "player_id", "type_name")).over(order))
    kind, result, follows = F.col("type_name"), F.col("result_name"), F.col("next.type_name")
    passed, shot = kind.isin(*PASSES), kind.isin(*SHOTS)
    mine = F.coalesce(F.col("next.team_id") == F.col("team_id"), F.lit(False))
    restart = F.coalesce(follows.isin(*RESTARTS), F.lit(False))
    taken = ~mine & follows.isNotNull() & ~follows.isin("interception", "tackle", *KEEPER)
    after = (
        F.when(
            result.isin("yellow_card", "red_card"), result
        ).when(passed & (result == "offside"), "offside").when(passed & (result == "success"), "receival")
        .when(shot & (result == "success"), "goal").when(result == "owngoal", "owngoal").when(
            (passed | shot) & (result == "fail") & restart, "out"
        ).when(passed & (result == "fail") & taken, "interception")
    )
    met = met.withColumn("after", after)
    who = lambda c: F.when(F.col("after") == "interception", F.col(f"next.{c}")).when(
        F.col("after") == "receival", F.when(mine, F.col(f"next.{c}"))
    ).otherwise(F.col(c))
    still = [F.lit(0.0).alias("dx"), F.lit(0.0).alias("dy")]
    own = F.struct(F.lit(0.0).alias("step"), "team_id", "player_id", "type_name", "x", "y", "dx", "dy")
    team = F.when(F.col("after") == "receival", F.col("team_id")).otherwise(who("team_id"))
    come = F.struct(
        F.lit(0.5).alias("step"), team.alias("team_id"), who("player_id").alias("player_id"), F.col("after").alias("type_name"),
        (F.col("x") + F.col("dx")).alias("x"), (F.col("y") + F.col("dy")).alias("y"), *still
    )
    parts = F.when(F.col("after").isNotNull(), F.array(own, come)).otherwise(F.array(own))
    each = met.select("game_id", "period_id", "action_id", "time_seconds", F.explode(parts).alias("p"))
    return each.select(
        "game_id", "period_id", (F.col("action_id") + F.col("p.step")).alias("action_id"), "time_seconds", "p.team_id", "p.player_id", "p.x", "p.y",
        "p.dx", "p.dy", "p.type_name"
    )
