"""Match, rating and squad tables made of the driver's tables, so that operators and SQL can be held against each other.

events gives 30 games of a day each; orders with customers give games, ratings and squads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .schemas import EVENT

LAST_MINUTE = 94
#: Numbers of events that one part of a document spans.
PART = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_EVENT_TYPE = """case event_type when 'signup' then 'SubstitutionOn' when 'error' then 'SubstitutionOff' when 'purchase' then if(k % 4 = 0, 'Goal', 'Pass')
when 'click' then if(k = 0, 'Card', 'Pass') else 'Pass' end as type"""
_OWN_GOAL = """case when k < 5 then array(named_struct('type', named_struct('value', 28, 'displayName', 'OwnGoal'), 'value', cast(null as string))) end
as qualifiers"""


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event rows with the columns that the operators read, without full-time events."""
    e = table(spark, sf_dir, "events")
    e = e.selectExpr("event_id", "ts", "user_id", "event_type", "value", "cast(get_json_object(props, '$.k') as int) as k")
    return e.selectExpr(
        "cast(year(ts) * 10000 + month(ts) * 100 + day(ts) as long) as game_id", "event_id as event_ordinal", _EVENT_TYPE, "'SecondHalf' as period",
        "cast(floor((hour(ts) * 60 + minute(ts)) * 95 / 1440) as int) as expanded_minute", "user_id as player_id", "user_id % 2 + 1 as team_id",
        "if(event_type = 'click' and k = 0, 'Red', null) as card_type", "event_type = 'purchase' and k % 4 = 0 as is_goal", _OWN_GOAL,
        "k", "value", "event_type", "ts",
    )


def match_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event rows, and one full-time event for each game."""
    rows = event_rows(spark, sf_dir)
    full = {
        "game_id": "game_id", "period": "'SecondHalf'", "event_ordinal": "-1L", "type": "'End'", "expanded_minute": str(LAST_MINUTE), "is_goal": "false"
    }
    end = [f"{full.get(f.name, f'cast(null as {f.dataType.simpleString()})')} as {f.name}" for f in rows.schema.fields]
    return rows.unionAll(rows.select("game_id").distinct().selectExpr(*end))


def lineups(events: DataFrame) -> DataFrame:
    """Everyone seen in a game starts it; a row per event, since entries of a player may repeat."""
    return events.where("player_id is not null").select("game_id", "player_id", "team_id", F.lit(True).alias("is_starter"))


def entries(events: DataFrame) -> DataFrame:
    """minutes.entries of lineups(events) and events in one pass: as all start, an event row is its player's line-up and
    substitution at once."""
    return events.where("player_id is not null").selectExpr(
        "game_id", "player_id", "team_id", "if(type = 'SubstitutionOn', expanded_minute, 0) as minute_on",
        "if(type = 'SubstitutionOff', expanded_minute, -1) as minute_off", "0L as seen",
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A match document for each day of events, with the fields that sources.matches.read gives, in parts of PART events: a
    day has as many events as the table brings, and no row, list or map of names grows with them."""
    number = F.coalesce(F.floor(F.col("event_ordinal") / PART), F.lit(-(1 << 62)))
    e, k = event_rows(spark, sf_dir).where("player_id is not null").withColumn("part", number), F.col("k")
    label = lambda c: F.struct(F.lit(1).alias("value"), c.alias("displayName"))
    kind = F.col("event_type")
    name = F.when(F.col("type") == "Goal", "Goal").when(kind == "purchase", "MissedShots")
    name = name.when((kind == "click") & (k != 0), "TakeOn").when((kind == "click") & (k == 0), "Card").when(
        (kind == "view") & (k % 9 == 0), "Clearance"
    ).when(kind == "view", "Pass").otherwise(F.col("type"))
    given = {"Cross": k % 10 == 7, "ThrowIn": k % 10 == 8, "CornerTaken": k % 20 == 3, "Head": k % 6 == 1, "Penalty": k % 8 == 0, "OwnGoal": k < 5}
    qualifiers = F.filter(F.array(*(F.when(c, F.struct(label(F.lit(q)).alias("type"))) for q, c in given.items())), lambda q: q.isNotNull())
    shot = F.col("is_goal") | (name == "MissedShots")
    event = F.struct(
        F.col("event_ordinal").alias("id"), label(name).alias("type"), label(F.lit("SecondHalf")).alias("period"),
        F.col("expanded_minute").alias("expandedMinute"), F.col("expanded_minute").alias("minute"),
        (F.col("event_ordinal") % 60).cast("double").alias("second"), F.col("team_id").alias("teamId"), F.col("player_id").alias("playerId"),
        label(F.when(k % 3 != 0, "Successful").otherwise("Unsuccessful")).alias("outcomeType"),
        F.when(F.col("card_type").isNotNull(), label(F.col("card_type"))).alias("cardType"), qualifiers.alias("qualifiers"),
        F.when(F.col("is_goal"), F.lit(True)).alias("isGoal"), k.cast("double").alias("x"),
        (F.col("event_ordinal") % 100).cast("double").alias("y"), F.when(~shot, (k * 13 % 100).cast("double")).alias("endX"),
        F.when(~shot, (k * 7 % 100).cast("double")).alias("endY"), F.when(shot, (k % 50 + 25).cast("double")).alias("goalMouthY"),
    )
    end = F.lit(f'{{"type": {{"displayName": "End"}}, "period": {{"displayName": "SecondHalf"}}, "expandedMinute": {LAST_MINUTE}}}')
    player = F.col("player_id")
    side = lambda t, n: F.struct(
        F.lit(t).cast("long").alias("teamId"), F.lit(n).alias("name"),
        F.transform(
            F.filter("players", lambda p: p % 2 + 1 == t),
            lambda p: F.struct(
                p.alias("playerId"), F.concat(F.lit("P"), p.cast("string")).alias("name"), (p % 99).cast("int").alias("shirtNo"),
                F.lit(True).alias("isFirstEleven")
            )
        ).alias("players"),
    )
    parts = e.groupBy("game_id", "part").agg(
        F.array_sort(F.collect_list(F.struct(F.col("event_ordinal").alias("o"), F.to_json(event).alias("e")))).alias("events"),
        F.array_sort(F.collect_set("player_id")).alias("named")
    )
    before = Window.partitionBy("game_id").orderBy("part")
    places = e.groupBy("game_id", "part").agg(F.count("*").alias("n")).select(
        "game_id", "part", F.coalesce(F.sum("n").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first_event"),
        F.lead("part").over(before).isNull().alias("last")
    )
    # who starts is in the line-up of the part that sees the player first
    starters = e.groupBy("game_id", "player_id").agg(F.min("part").alias("part")).groupBy("game_id", "part").agg(
        F.array_sort(F.collect_list("player_id")).alias("players")
    )
    for more in (places, starters):
        more = more.withColumnsRenamed({"game_id": "__game", "part": "__part"})
        parts = parts.join(more, F.col("game_id").eqNullSafe(F.col("__game")) & (F.col("part") == F.col("__part")), "left").drop("__game", "__part")
    games = parts.withColumn("players", F.coalesce("players", F.array().cast("array<long>")))
    # names of every other player, so that the rest keep their numbers
    named = F.map_from_entries(
        F.transform(
            F.filter("named", lambda p: p % 4 < 2),
            lambda p: F.struct(p.cast("string").alias("key"), F.concat(F.lit("P"), p.cast("string")).alias("value"))
        )
    )
    ended = F.when(F.col("last"), F.array(end)).otherwise(F.array().cast("array<string>"))
    events = F.transform(F.concat(F.transform("events", lambda x: x["e"]), ended), lambda x: F.from_json(x, EVENT))
    return games.select(
        "game_id", "first_event", named.alias("playerIdNameDictionary"), side(1, "One").alias("home"), side(2, "Two").alias("away"), events.alias("events")
    )


def roster_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, content) of a roster page for each nation: a row per customer, some without a number, some numbers twice."""
    c = table(spark, sf_dir, "customer")
    number = F.when(F.col("c_custkey") % 7 == 0, "x").otherwise((F.col("c_custkey") % 40).cast("string"))
    cell = lambda x: F.concat(F.lit("<td>"), x, F.lit("</td>"))
    name = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("see <i>"), F.col("c_name"), F.lit("</i>"))).otherwise(F.col("c_name"))
    row = F.concat(F.lit("<tr>"), cell(number), cell(name), cell(F.col("c_mktsegment")), F.lit("</tr>"))
    rows = c.groupBy("c_nationkey").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", row.alias("row")))), lambda x: x["row"]), "").alias("rows")
    )
    content = F.concat(F.lit('<html><div id="main"><table><tr><th>No</th><th>Name</th></tr>'), "rows", F.lit("</table></div></html>"))
    return rows.select(
        F.concat(F.lit("2001-2002_land_part_team"), F.col("c_nationkey").cast("string"), F.lit(".html")).alias("path"), content.alias("content")
    )


_ACTION_TYPE = """case when is_goal or event_type = 'purchase' then 'shot' when type = 'Pass' and event_type = 'view' then 'pass'
when event_type = 'click' then 'dribble' else 'tackle' end as type_name"""


def actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An action stream: places from k and the event's number, kinds from the event's type."""
    return event_rows(spark, sf_dir).selectExpr(
        "game_id", "2 as period_id", "event_ordinal as action_id", "cast(expanded_minute * 60 + event_ordinal % 60 as double) as time_seconds",
        "team_id", "player_id", "k * 1.05D as start_x", "cast(event_ordinal % 68 as double) as start_y",
        "if(k % 7 <> 6, cast(k * 13 % 100 as double), null) as end_x", "cast(k * 7 % 68 as double) as end_y", _ACTION_TYPE,
        "case when is_goal then if(k < 5, 'owngoal', 'success') when k % 3 = 0 then 'fail' else 'success' end as result_name", "k",
    )


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One player's game per order."""
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey"))
    return o.selectExpr(
        "o_orderkey as game_id", "o_custkey as player_id", "to_date(o_orderdate) as game_date", "cast(c_nationkey as long) as team_id",
        "c_mktsegment as league", "cast(o_orderkey % 95 as int) as minutes", "o_totalprice as elo", "if(o_orderkey % 10 = 0, 0.1D, 0.2D) as version",
        "if(o_orderkey % 3 <> 0, 1, 0) as valid", "concat_ws('-', o_orderkey % 5, o_custkey % 4) as result", "cast(o_orderkey % 2 as int) as home",
    )


def base_metric(games_: DataFrame) -> DataFrame:
    kind = "if(game_id % 2 = 0, 'elo', 'pm') as metric"
    return games_.selectExpr("player_id", "game_id", "game_date", "version", kind, "elo as metric_value")


def squad_entries(games_: DataFrame) -> DataFrame:
    """(player_id, kit_number, team_id, day): the number a player has from each game on, one per player and day."""
    w = Window.partitionBy("player_id", "game_date").orderBy("game_id")
    first = games_.withColumn("rn", F.row_number().over(w)).where("rn = 1")
    return first.selectExpr("player_id", "cast(game_id % 30 as int) as kit_number", "team_id", "game_date as day")


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr("c_custkey as id", "c_name as name")


def paired_games(games_: DataFrame) -> DataFrame:
    """Games that two sides share, several rows each."""
    return games_.selectExpr("game_id % 997 as game_id", "team_id % 2 as team_id", "result", "elo", "cast(team_id % 2 as int) as home")


#: The same tables in DuckDB's SQL.
EV = """ev as (select event_id, cast(strftime(ts, '%Y%m%d') as bigint) as game_id, cast(floor((extract(hour from ts) * 60 + extract(minute
from ts)) * 95 / 1440) as int) as minute,
 user_id as player_id, user_id % 2 + 1 as team_id, value, event_type, ts, cast(json_extract(props, '$.k') as int) as k,
 case when event_type = 'signup' then 'SubstitutionOn' when event_type = 'error' then 'SubstitutionOff' when event_type = 'purchase'
and cast(json_extract(props, '$.k') as int) % 4 = 0 then 'Goal'
      when event_type = 'click' and cast(json_extract(props, '$.k') as int) = 0 then 'Card' else 'Pass' end as type from events)"""
PITCH = f"""{EV},
eog as (select game_id, cast(least({LAST_MINUTE}, coalesce(min(case when type = 'Card' then minute end), {LAST_MINUTE})) as int) as eo from ev
group by game_id),
st as (select game_id, player_id, max(team_id) as team_id, max(case when type = 'SubstitutionOn' then minute else 0 end) as p_on, max(case
when type = 'SubstitutionOff' then minute else -1 end) as p_off
       from ev where player_id <> 0 group by game_id, player_id),
pl as (select st.game_id as game_id, player_id, team_id, cast(p_on as int) as p_on, cast(case when p_off = -1 or p_off > eo then eo
else p_off end as int) as p_off from st join eog on st.game_id = eog.game_id where p_on <= eo),
gl as (select game_id, minute, case when k < 5 then 3 - team_id else team_id end as goal_team
       from (select *, row_number() over (partition by game_id, minute order by event_id desc) as rn from ev where type = 'Goal') as x where rn = 1),
gd as (select pl.game_id as game_id, pl.player_id as player_id, max(p_off - p_on) as mins, count(case when goal_team = team_id then 1 end) as gf,
count(case when goal_team <> team_id then 1 end) as ga
       from pl left join gl on pl.game_id = gl.game_id and gl.minute > p_on and gl.minute < p_off group by pl.game_id, pl.player_id)"""
ACTIONS = f"""{EV},
ac as (select game_id, event_id as action_id, minute * 60.0 + event_id % 60 as secs, team_id, player_id, k, k * 1.05 as sx,
cast(event_id % 68 as double) as sy,
 case when k % 7 <> 6 then cast(k * 13 % 100 as double) end as ex, cast(k * 7 % 68 as double) as ey,
 case when type = 'Goal' then 'shot' when type = 'Pass' and event_type = 'purchase' then 'shot' when event_type = 'view' then 'pass'
when event_type = 'click' then 'dribble' else 'tackle' end as tn,
 case when type = 'Goal' then case when k < 5 then 'owngoal' else 'success' end when k % 3 = 0 then 'fail' else 'success' end as rn from ev),
pc as (select *, cast(least(floor(sx / 105.0 * 16), 15) * 12 + least(floor(sy / 68.0 * 12), 11) as int) as c0, cast(least(floor(ex / 105.0 * 16),
15) * 12 + least(floor(ey / 68.0 * 12), 11) as int) as c1
       from ac where ex is not null)"""
GM = """gm as (select o_orderkey as game_id, o_custkey as player_id, cast(o_orderdate as date) as game_date, cast(c_nationkey as bigint) as team_id,
c_mktsegment as league, cast(o_orderkey % 95 as int) as minutes_,
 o_totalprice as elo, case when o_orderkey % 10 = 0 then 0.1 else 0.2 end as version, case when o_orderkey % 3 <> 0 then 1 else 0 end as valid,
(o_orderkey % 5) || '-' || (o_custkey % 4) as result, cast(o_orderkey % 2 as int) as home
 from orders join customer on o_custkey = c_custkey),
bm as (select player_id, game_id, game_date, version, case when game_id % 2 = 0 then 'elo' else 'pm' end as metric, elo as metric_value from gm),
se as (select player_id, cast(game_id % 30 as int) as kit_number, team_id, game_date as day_ from (select *, row_number() over (partition by player_id,
game_date order by game_id) as rn from gm) as x where rn = 1),
sq as (select player_id, kit_number, team_id, day_ as valid_from, coalesce(lead(day_) over (partition by player_id order by day_),
date '2099-12-31') as valid_to from se)"""
#: The action stream of documents, before dribbles are put in.
STREAM = f"""{EV},
sv as (select game_id, event_id, minute, team_id, player_id, k, case when type = 'Goal' then 'Goal' when event_type = 'purchase' then 'MissedShots'
when event_type = 'click' and k <> 0 then 'TakeOn'
 when event_type = 'click' then 'Card' when event_type = 'view' and k % 9 = 0 then 'Clearance' when event_type = 'view' then 'Pass' else type end as t
from ev where player_id is not null),
sn as (select *, case when t = 'Pass' then case when k % 10 = 8 then 'throw_in' when k % 20 = 3 then 'corner_short' when k % 10 = 7 then 'cross'
else 'pass' end
 when t in ('Goal', 'MissedShots') then case when k % 8 = 0 then 'shot_penalty' else 'shot' end when t = 'TakeOn' then 'take_on'
when t = 'Clearance' then 'clearance' end as tn from sv),
sp as (select *, minute * 60.0 + event_id % 60 as secs, case when t in ('Goal', 'MissedShots') then case when k < 5 then 'owngoal'
when t = 'Goal' then 'success' else 'fail' end when k < 5 then 'owngoal'
 when k % 3 <> 0 then 'success' else 'fail' end as rn, case when k % 6 = 1 then 'head' when tn = 'throw_in' then 'other' else 'foot' end as bp,
 case when team_id = 1 then k / 100.0 * 105 else 105 - k / 100.0 * 105 end as sx, case when team_id = 1 then event_id % 100 / 100.0 * 68
else 68 - event_id % 100 / 100.0 * 68 end as sy,
 case when t in ('Goal', 'MissedShots') then 100.0 else k * 13 % 100 end as px, case when t in ('Goal', 'MissedShots') then k % 50 + 25
else k * 7 % 100 end as py from sn where tn is not null),
sl as (select *, lead(team_id) over w as n_team, lead(player_id) over w as n_player, lead(secs) over w as n_secs, lead(sx) over w as n_sx,
lead(sy) over w as n_sy, lead(tn) over w as n_tn
 from sp window w as (partition by game_id order by event_id)),
se as (select *, case when tn = 'clearance' then coalesce(n_sx, sx) when tn = 'take_on' then sx when team_id = 1 then px / 100.0 * 105
else 105 - px / 100.0 * 105 end as ex,
 case when tn = 'clearance' then coalesce(n_sy, sy) when tn = 'take_on' then sy when team_id = 1 then py / 100.0 * 68
else 68 - py / 100.0 * 68 end as ey from sl),
sd as (select game_id, event_id, 0 as step, secs, team_id, player_id, sx, sy, ex, ey, tn, rn, bp from se union all
 select game_id, event_id, 1, (secs + n_secs) / 2, team_id, n_player, ex, ey, n_sx, n_sy, 'dribble', 'success', 'foot' from se
 where n_team = team_id and n_secs - secs < 10 and sqrt(pow(n_sx - ex, 2) + pow(n_sy - ey, 2)) between 3 and 60 and n_tn not in ('throw_in',
'goalkick',
'corner_crossed', 'corner_short'))"""
