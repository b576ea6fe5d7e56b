"""The queries of the football operators over the driver's tables, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import adapters as A
from .functions import dates, names, scoring, seasons
from .operators import actions as stream
from .operators import actionvalue, dedup, elo, frontier, goals, minutes, ratings, sketches, splits, squads, threat, upsert
from .plans import lineups, prepare, score
from .sources import html, matches, rest, rosters

DAY, VERSION = date(2001, 1, 1), 0.2
#: Team names that a feed spells in other ways.
ALIASES = {"Deutschland": ["GERMANY"], "Great Britain": ["UNITED KINGDOM", "BRITAIN"], "USA": ["UNITED STATES"]}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with SQL that gives the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _r(c: Column | str, digits: int = 6) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


def _m(c: Column | str, digits: int = 4) -> Column:
    """A mean, rounded after a shift that keeps exact halves, which engines round by their last bit, off the border."""
    return F.round((F.col(c) if isinstance(c, str) else c) + 0.0000123, digits)


def _on_pitch(spark: SparkSession, sf: str) -> DataFrame:
    return minutes.spells(A.entries(A.event_rows(spark, sf)), minutes.end_of_game(A.match_events(spark, sf)))


def _counted(spark: SparkSession, sf: str) -> DataFrame:
    """Spells with goals: one pass over the events for games, one for players."""
    return goals.counted(minutes.spells(A.entries(A.event_rows(spark, sf)), minutes.game_facts(A.match_events(spark, sf))))


# minutes and goals


@query(f"with {A.PITCH} select game_id, eo as end_of_game from eog")
def end_of_game(spark, sf):
    return minutes.end_of_game(A.match_events(spark, sf))


@query(f"with {A.PITCH} select game_id, player_id, team_id, p_on as minute_on, p_off as minute_off from pl")
def player_intervals(spark, sf):
    return _on_pitch(spark, sf).drop("end_of_game")


@query(f"with {A.PITCH} select player_id, game_id, 'minutes' as metric, cast(p_off - p_on as double) as value from pl")
def minutes_played(spark, sf):
    return minutes.minutes_metric(_on_pitch(spark, sf))


@query(f"with {A.PITCH} select game_id, player_id, mins as minutes_on, gf as goals_for, ga as goals_against from gd")
def goals_for_against(spark, sf):
    return _counted(spark, sf).select(
        "game_id", "player_id", (F.col("minute_off") - F.col("minute_on")).alias("minutes_on"), "goals_for", "goals_against"
    )


@query(f"with {A.PITCH} select player_id, game_id, 'goals' as metric, cast(gf - ga as double) as value from gd")
def goal_difference(spark, sf):
    return goals.goals_metric(_counted(spark, sf))


@query(f"""with {A.PITCH}, al as (select pl.game_id as game_id, pl.player_id as player_id, count(case when goal_team = team_id then 1 end) as gf,
count(case when goal_team <> team_id then 1 end) as ga
from pl left join (select game_id, minute, case when k < 5 then 3 - team_id else team_id end as goal_team from ev
where type = 'Goal') as g on pl.game_id = g.game_id and g.minute > p_on and g.minute < p_off group by pl.game_id, pl.player_id)
select * from al""")
def goals_every(spark, sf):
    events = A.event_rows(spark, sf)
    scored = goals.goals(events, A.lineups(events), every=True)
    return goals.on_pitch_goals(_on_pitch(spark, sf), scored).select(
        "game_id", "player_id", F.col("goals_for").alias("gf"), F.col("goals_against").alias("ga")
    )


@query(
    f"""with {A.PITCH} select player_id, game_id, 'minutes' as metric, cast(p_off - p_on as double) as value from pl union all select player_id,
game_id, 'goals', cast(gf - ga as double) from gd"""
)
def score_all_long(spark, sf):
    rows = _counted(spark, sf)
    return minutes.as_metrics(rows, {"minutes": F.col("minute_off") - F.col("minute_on"), "goals": F.col("goals_for") - F.col("goals_against")})


@query(f"with {A.PITCH} select player_id, game_id, cast(mins as double) as minutes_value, cast(gf - ga as double) as goals_value from gd")
def metric_pivot(spark, sf):
    wide = score_all_long(spark, sf).groupBy("player_id", "game_id").pivot("metric", ["minutes", "goals"]).agg(F.first("value"))
    return wide.toDF("player_id", "game_id", "minutes_value", "goals_value")


@query(f"with {A.EV} select event_id as event_ordinal, k < 5 as own_goal from ev where type = 'Goal'")
def own_goal_flag(spark, sf):
    return A.event_rows(spark, sf).where("is_goal").select("event_ordinal", scoring.own_goal(F.col("qualifiers")).alias("own_goal"))


# threat and action values


@query(
    f"""with {A.ACTIONS} select c0 as start_cell, count(case when tn = 'shot' then 1 end) as shots, count(case when tn = 'shot'
and rn = 'success' then 1 end) as goals, count(case when tn in ('pass', 'dribble') then 1 end) as moves from pc group by c0"""
)
def xt_counts(spark, sf):
    return threat.counts(threat.with_cells(A.actions(spark, sf)))


@query(
    f"""with {A.ACTIONS} select c0 as start_cell, c1 as end_cell, count(*) as n from pc where tn in ('pass', 'dribble') and rn = 'success' group by c0,
c1"""
)
def xt_transitions(spark, sf):
    return threat.transitions(threat.with_cells(A.actions(spark, sf)))


#: A grid that rises with the cell's number, so that sums can be checked by SQL.
_RAMP = [i / 192 for i in range(192)]


@query(f"""with {A.ACTIONS}, {A.PITCH.split(',', 1)[1].split('end as type from events),', 1)[1]}
select pl.game_id as game_id, pl.player_id as player_id, round(coalesce(sum((c1 - c0) / 192.0), 0), 6) as xt from pl left join (select * from pc
where tn in ('pass', 'dribble') and rn = 'success') as a
on pl.game_id = a.game_id and pl.player_id = a.player_id and secs / 60 > p_on and secs / 60 < p_off group by pl.game_id, pl.player_id""")
def xt_actions_by_player(spark, sf):
    got = threat.on_pitch_sum(_on_pitch(spark, sf), threat.rate(A.actions(spark, sf), _RAMP))
    return got.select("game_id", "player_id", _r("value").alias("xt"))


_FIT = """ct as (select c0 as c, count(case when tn = 'shot' then 1 end) as sh, count(case when tn = 'shot' and rn = 'success' then 1 end) as gl,
count(case when tn in ('pass', 'dribble') then 1 end) as mv from pc group by c0),
cl as (select cast(i as int) as c, coalesce(case when sh + mv > 0 then sh / cast(sh + mv as double) end * case
when sh > 0 then gl / cast(sh as double) end, 0) as base, coalesce(case when sh + mv > 0 then mv / cast(sh + mv as double) end, 0) as share
 from range(192) as r(i) left join ct on ct.c = r.i),
tr as (select c0 as c, c1 as d, count(*) / cast(any_value(mv) as double) as p from pc join ct on ct.c = c0 where tn in ('pass', 'dribble')
and rn = 'success' group by c0, c1),
vl(r, c, val) as (select 0, c, cast(0 as double) from cl union all
 select s.r, cl.c, cl.base + cl.share * s.got from (select x.c as c, max(vl.r) + 1 as r, sum(coalesce(tr.p, 0) * vl.val) as got from (select c as c
from cl) as x, vl left join tr on tr.c = x.c and tr.d = vl.c group by x.c) as s join cl on cl.c = s.c where s.r <= 80),
xg as (select c, val from vl where r = 80)"""


@query(f"""with recursive {A.ACTIONS}, {A.PITCH.split(',', 1)[1].split('end as type from events),', 1)[1]}, {_FIT}
select pl.player_id as player_id, pl.game_id as game_id, 'xt' as metric, round(coalesce(sum(g1.val - g0.val), 0) + 0.000000123, 6) as value
from pl left join (select * from pc where tn in ('pass', 'dribble') and rn = 'success') as a on pl.game_id = a.game_id and pl.player_id = a.player_id
and secs / 60 > p_on and secs / 60 < p_off
left join xg as g0 on g0.c = c0 left join xg as g1 on g1.c = c1 group by pl.game_id, pl.player_id""")
def xt_fit_and_rate(spark, sf):
    """Fitted until no cell changes by 1e-13, so that the number of rounds doesn't show in the rounded sums."""
    actions = A.actions(spark, sf)
    got = threat.xt_metric(_on_pitch(spark, sf), actions, threat.fit(actions, eps=1e-13))
    return got.withColumn("value", _r(F.col("value") + 0.000000123))


_NEXT = "over (partition by game_id order by action_id rows between current row and 9 following)"


@query(f"""with {A.ACTIONS}, g as (select *, case when tn = 'shot' and rn = 'success' then team_id when tn = 'shot'
and rn = 'owngoal' then 3 - team_id end as st from ac),
w as (select game_id, action_id, team_id, max(case when st = 1 then 1 else 0 end) {_NEXT} as s1, max(case when st = 2 then 1 else 0 end) {_NEXT} as s2
from g)
select game_id, action_id, case when team_id = 1 then s1 else s2 end = 1 as scores, case when team_id = 1 then s2 else s1 end = 1 as concedes from w""")
def vaep_labels_next10(spark, sf):
    return actionvalue.labels(A.actions(spark, sf)).select("game_id", "action_id", "scores", "concedes")


@query(f"""with {A.ACTIONS} select game_id, action_id, sx as start_x_0, coalesce(lag(sx, 1) over w, first_value(sx) over w) as start_x_1,
coalesce(lag(sx, 2) over w, first_value(sx) over w) as start_x_2,
coalesce(coalesce(lag(ey, 1) over w, first_value(ey) over w), 0.0) as end_y_1, cast(coalesce(lag(team_id, 1) over w,
team_id) = team_id as double) as same_team_1, cast(coalesce(lag(rn = 'success', 1) over w, first_value(rn = 'success') over w) as double) as success_1
from ac window w as (partition by game_id order by action_id)""")
def vaep_prev_action_features(spark, sf):
    return actionvalue.features(A.actions(spark, sf)).select(
        "game_id", "action_id", "start_x_0", "start_x_1", "start_x_2", "end_y_1", "same_team_1", "success_1"
    )


@query(f"""with {A.ACTIONS}, p as (select game_id, action_id, team_id, k / 100.0 as ps, (k * 7 % 100) / 200.0 as pcn from ac),
v as (select game_id, action_id, ps, pcn, case when lag(team_id) over w = team_id then lag(ps) over w else lag(pcn) over w end as bs, case
when lag(team_id) over w = team_id then lag(pcn) over w else lag(ps) over w end as bc from p window w as (partition by game_id order by action_id))
select game_id, action_id, round(ps - coalesce(bs, 0), 6) as offensive, round(coalesce(bc, 0) - pcn, 6) as defensive from v""")
def vaep_value_steps(spark, sf):
    chances = A.actions(spark, sf).withColumns({"p_scores": F.col("k") / 100.0, "p_concedes": (F.col("k") * 7 % 100) / 200.0})
    return actionvalue.values(chances).select("game_id", "action_id", _r("offensive").alias("offensive"), _r("defensive").alias("defensive"))


_LAGS = "window w as (partition by game_id order by action_id)"


def _lag(c: str, k: int) -> str:
    return f"coalesce(lag({c}, {k}) over w, first_value({c}) over w)"


@query(f"""with {A.ACTIONS}, g as (select *, sqrt(pow(105 - sx, 2) + pow(34 - sy, 2)) as sd, atan(abs(34 - sy) / (105 - sx)) as sa, sqrt(pow(105 - ex,
2) + pow(34 - ey, 2)) as ed, ex - sx as dx, sqrt(pow(ex - sx, 2) + pow(ey - sy, 2)) as ds from ac)
select game_id, action_id, round(sd, 6) as start_goal_distance_0, round({_lag('sa', 1)}, 6) as start_goal_angle_1, round(coalesce({_lag('ed', 1)}, 0),
6) as end_goal_distance_1, round(coalesce(dx, 0), 6) as dx_0, round(coalesce({_lag('ds', 2)}, 0), 6) as distance_2 from g {_LAGS}""")
def vaep_place_features(spark, sf):
    names = ["start_goal_distance_0", "start_goal_angle_1", "end_goal_distance_1", "dx_0", "distance_2"]
    return actionvalue.features(A.actions(spark, sf)).select("game_id", "action_id", *(_r(c).alias(c) for c in names))


@query(
    f"""with {A.ACTIONS} select game_id, action_id, secs as time_seconds_0, secs - {_lag('secs', 1)} as time_gap_1, round(sx - {_lag('sx', 2)},
6) as x_gap_2, sy - {_lag('sy', 1)} as y_gap_1, cast(2 as double) as period_id_0 from ac {_LAGS}"""
)
def vaep_time_features(spark, sf):
    f = actionvalue.features(A.actions(spark, sf))
    return f.select("game_id", "action_id", "time_seconds_0", "time_gap_1", _r("x_gap_2").alias("x_gap_2"), "y_gap_1", "period_id_0")


@query(f"""with {A.ACTIONS}, g as (select *, cast(tn = 'pass' as double) as p, cast(tn = 'shot' as double) as s, cast(rn = 'fail' as double) as f,
cast(rn = 'owngoal' as double) as o, case when k % 3 = 0 then 'head' end as b from ac)
select game_id, action_id, p as is_pass_0, {_lag('s', 1)} as is_shot_1, {_lag('f', 1)} as fail_1, {_lag('o', 2)} as owngoal_2,
cast(b is null as double) as foot_0, coalesce(lag(cast(b is not null as double), 1) over w,
first_value(cast(b is not null as double)) over w) as head_1 from g {_LAGS}""")
def vaep_kind_features(spark, sf):
    rows = A.actions(spark, sf).withColumn("bodypart_name", F.when(F.col("k") % 3 == 0, "head"))
    return actionvalue.features(rows).select("game_id", "action_id", "is_pass_0", "is_shot_1", "fail_1", "owngoal_2", "foot_0", "head_1")


@query(f"""with {A.ACTIONS}, g as (select *, case when tn = 'shot' and rn = 'success' then team_id when tn = 'shot'
and rn = 'owngoal' then 3 - team_id end as st from ac),
n as (select *, coalesce(sum(case when st = 1 then 1 else 0 end) over b, 0) as s1, coalesce(sum(case when st = 2 then 1 else 0 end) over b, 0) as s2
from g window b as (partition by game_id order by action_id rows between unbounded preceding and 1 preceding))
select game_id, action_id, cast(case when team_id = 1 then s1 else s2 end as double) as goals_own, cast(case when team_id = 1 then s2
else s1 end as double) as goals_other, cast(case when team_id = 1 then s1 - s2 else s2 - s1 end as double) as goals_ahead from n""")
def vaep_score_features(spark, sf):
    return actionvalue.features(A.actions(spark, sf)).select("game_id", "action_id", "goals_own", "goals_other", "goals_ahead")


@query()
def vaep_fit_and_rate(spark, sf):
    """The operator's default: 20 trees of depth 3 at most, a quarter of the actions held back."""
    actions = A.actions(spark, sf).withColumn("end_x", F.coalesce("end_x", "start_x"))
    return actionvalue.vaep_metric(_on_pitch(spark, sf), actions, actionvalue.fit(actions))


@query(f"""with {A.ACTIONS}, nx as (select *, lead(team_id) over w as nt, lead(player_id) over w as np, lead(tn) over w as nn from ac {_LAGS}),
fo as (select *, case when tn = 'pass' and rn = 'success' then 'receival' when tn = 'shot' and rn = 'success' then 'goal'
when rn = 'owngoal' then 'owngoal' when tn = 'pass' and rn = 'fail' and nt <> team_id and nn not in ('tackle',
'interception') then 'interception' end as fo from nx)
select game_id, cast(action_id as double) as action_id, tn as type_name, team_id, player_id from ac union all
select game_id, action_id + 0.5, fo, case when fo = 'interception' then nt else team_id end, case when fo = 'interception' then np
when fo = 'receival' then case when nt = team_id then np end else player_id end from fo where fo is not null""")
def atomic_actions(spark, sf):
    return stream.atomic(A.actions(spark, sf)).select("game_id", "action_id", "type_name", "team_id", "player_id")


# match documents


@query(f"""with {A.STREAM} select game_id, cast(row_number() over (partition by game_id order by event_id, step) - 1 as int) as action_id,
secs as time_seconds, team_id, player_id, round(sx, 6) as start_x, round(sy, 6) as start_y,
round(ex, 6) as end_x, round(ey, 6) as end_y, tn as type_name, rn as result_name, bp as bodypart_name from sd""")
def action_stream(spark, sf):
    docs = A.documents(spark, sf)
    got = stream.from_events(matches.events(docs), matches.home_teams(docs)).drop("period_id")
    return got.withColumns({c: _r(c) for c in ("start_x", "start_y", "end_x", "end_y")})


@query(f"""with {A.STREAM} select game_id, event_id as feed_id, t as type, minute as expanded_minute, team_id, case team_id when 1 then 'One'
else 'Two' end as team, case when player_id % 4 < 2 then 'P' || player_id else cast(player_id as varchar) end as player,
case when t in ('Goal', 'MissedShots') then null else cast(k * 13 % 100 as double) end as end_x, t = 'Goal' as is_goal, case
when t = 'Card' then 'Red' end as card_type from sv
union all select distinct game_id, null, 'End', {A.LAST_MINUTE}, null, null, null, null, false, null from sv""")
def document_events(spark, sf):
    rows = matches.events(A.documents(spark, sf), feed_id=True)
    return rows.select("game_id", "feed_id", "type", "expanded_minute", "team_id", "team", "player", "end_x", "is_goal", "card_type")


@query(
    f"""with {A.STREAM} select distinct game_id, team_id, player_id, 'P' || player_id as player_name, true as is_starter,
cast(player_id % 99 as int) as jersey_number from sv"""
)
def document_lineups(spark, sf):
    return matches.lineups(A.documents(spark, sf))


@query(
    f"""with {A.STREAM}, g as (select distinct game_id from sv) select game_id, t as team_id, case t when 1 then 'One' else 'Two' end as team_name,
t = 1 as is_home from g, range(1, 3) as r(t)"""
)
def document_teams(spark, sf):
    return matches.teams(A.documents(spark, sf))


@query(f"with {A.STREAM}, g as (select distinct game_id from sv) select distinct 'One' as home_team, cast(1 as bigint) as team_id from g")
def home_team_ids(spark, sf):
    docs = A.documents(spark, sf)
    schedule = matches.home_teams(docs).select("game_id", F.lit("One").alias("home_team"), F.to_date(F.col("game_id").cast("string"), "yyyyMMdd").alias("date"))
    return matches.team_ids(schedule, docs)


@query(f"""with {A.STREAM}, g as (select distinct game_id, team_id, player_id from sv)
select game_id, strptime(cast(game_id as varchar), '%Y%m%d')::date as day_, player_id, 'P' || player_id as player_name, case team_id when 1 then 'One'
else 'Two' end as team_name, cast(team_id = 1 as int) as home, 1 as starter, cast(player_id % 99 as int) as kit_number from g""")
def player_info(spark, sf):
    docs = A.documents(spark, sf)
    games = matches.home_teams(docs).select("game_id", F.to_date(F.col("game_id").cast("string"), "yyyyMMdd").alias("day"), F.lit("L").alias("league"))
    return prepare.player_info(docs, games).select(
        "game_id", F.col("day").alias("day_"), "player_id", "player_name", "team_name", "home", "starter", "kit_number"
    )


@query("""select cast(year(ts) * 10000 + month(ts) * 100 + day(ts) as bigint) as game_id, count(*) as events, max(event_id) as last_id,
sum(cast(json_extract(props, '$.k') as int)) as k, count(json_extract(props, '$.absent')) as absent from events group by 1""")
def raw_event_fields(spark, sf):
    """Fields that no schema names, out of raw events: each event is a document of its own, with the props of the table."""
    e = A.table(spark, sf, "events")
    day = F.expr("cast(year(ts) * 10000 + month(ts) * 100 + day(ts) as long)")
    text = F.concat(F.lit('{"events":[{"eventId":'), F.col("event_id").cast("string"), F.lit(',"props":'), F.col("props"), F.lit("}]}"))
    raw = matches.split_events(e.select(day.alias("game_id"), F.parse_json(text).alias("d")))
    value = lambda path, kind: matches.field(F.col("event"), path, kind)
    return raw.groupBy("game_id").agg(
        F.count("*").alias("events"), F.max(value("$.eventId", "long")).alias("last_id"), F.sum(value("$.props.k", "int")).alias("k"),
        F.count(value("$.props.absent", "string")).alias("absent")
    )


def _cell(x: str, y: str) -> str:
    return f"(least(greatest(floor({x} / 105 * 16), 0), 15) * 12 + least(greatest(floor({y} / 68 * 12), 0), 11))"


_BEFORE = "coalesce(case when lag(team_id) over w = team_id then lag({}) over w else lag({}) over w end, 0)"


@query(f"""with {A.PITCH}, {A.STREAM.removeprefix(A.EV + ',')},
sa as (select *, row_number() over (partition by game_id order by event_id, step) - 1 as aid from sd),
ch as (select *, (aid % 50) / 100.0 as ps, (aid % 20) / 100.0 as pc from sa),
vl as (select game_id, player_id, secs, (ps - {_BEFORE.format('ps', 'pc')}) + ({_BEFORE.format('pc', 'ps')} - pc) as v,
case when tn in ('pass', 'dribble', 'cross') and rn = 'success' then ({_cell('ex', 'ey')} - {_cell('sx', 'sy')}) / 192.0 end as x
from ch window w as (partition by game_id order by aid)),
sm as (select pl.player_id as player_id, pl.game_id as game_id, coalesce(sum(x), 0) as xt, coalesce(sum(v), 0) as vaep from pl left join vl
on pl.game_id = vl.game_id and pl.player_id = vl.player_id and secs / 60 > p_on and secs / 60 < p_off group by pl.game_id, pl.player_id)
select player_id, game_id, 'minutes' as metric, cast(p_off - p_on as double) as value from pl
union all select player_id, game_id, 'goals', cast(gf - ga as double) from gd
union all select player_id, game_id, 'xt', round(xt + 0.000000123, 6) from sm union all select player_id, game_id, 'vaep', round(vaep + 0.000000123, 6) from sm""")
def score_documents(spark, sf):
    """The whole scoring job, from documents to the rows of the metric table: all four metrics, threat by a given grid and action
    values by given chances."""
    chances = lambda a: a.withColumns({"p_scores": F.col("action_id") % 50 / 100.0, "p_concedes": F.col("action_id") % 20 / 100.0})
    got = score.metrics(score.facts(A.documents(spark, sf)), _RAMP, chances)
    return got.withColumn("value", F.when(F.col("metric").isin("xt", "vaep"), _r(F.col("value") + 0.000000123)).otherwise(F.col("value")))


@query(
    f"""with {A.PITCH} select pl.player_id as player_id, pl.game_id as game_id, team_id, cast(p_off - p_on as int) as minutes_on,
cast(gf as int) as goals_for, cast(ga as int) as goals_against, cast(pl.player_id % 99 as int) as kit_number, cast(team_id = 1 as int) as is_home
from pl join gd on pl.game_id = gd.game_id and pl.player_id = gd.player_id"""
)
def player_game_rows(spark, sf):
    return score.player_games(score.facts(A.documents(spark, sf))).withColumnRenamed("minutes", "minutes_on").drop("starter")


@query(f"with {A.STREAM} select game_id, cast(count(*) + 1 as int) as n_events from sv group by game_id")
def document_raw(spark, sf):
    return matches.raw(A.documents(spark, sf)).groupBy("game_id").agg(F.sum(F.size("events")).cast("int").alias("n_events"))


@query(f"with {A.STREAM} select distinct game_id, cast(1 as bigint) as home_team_id from sv")
def game_home_team(spark, sf):
    return matches.home_teams(A.documents(spark, sf))


@query("select c_mktsegment as league, round(avg(c_acctbal) + 0.0000123, 4) as elo from customer group by c_mktsegment")
def league_elo(spark, sf):
    rows = A.table(spark, sf, "customer").select(F.col("c_mktsegment").alias("league"), F.col("c_acctbal").alias("elo"))
    return rest.league_elo(rows).withColumn("elo", _m("elo"))


@query("select c_acctbal as elo from customer where c_mktsegment = 'BUILDING' order by c_custkey limit 1")
def club_elo(spark, sf):
    c = A.table(spark, sf, "customer")
    return rest.club_elo(c.select(F.col("c_custkey").alias("rank"), F.col("c_mktsegment").alias("team"), F.col("c_acctbal").alias("elo")), "BUILDING")


_BORN = "make_date(1960 + cast(c_custkey % 60 as int), 1 + cast(c_custkey % 12 as int), 1 + cast(c_custkey % 28 as int))"


@query(f"""with r as (select 'team' || c_nationkey as team, cast(c_custkey % 40 as int) as kit, min({_BORN}) as born from customer
where c_custkey % 5 <> 0 group by 1, 2),
p as (select c_custkey, 'team' || c_nationkey as team, cast(c_custkey % 40 as int) as kit from customer)
select c_custkey as player_id, born as birthday from p join r on p.team = r.team and p.kit = r.kit""")
def birthdays(spark, sf):
    """Some dates of birth of a roster are written in full, others with two digits for the year."""
    key = F.col("c_custkey")
    born = F.make_date((key % 60 + 1960).cast("int"), (key % 12 + 1).cast("int"), (key % 28 + 1).cast("int"))
    short = F.year(born).between(1969, 2019) & (key % 2 == 0)
    text = F.when(short, F.date_format(born, "dd-MM-yy")).otherwise(F.date_format(born, "yyyy-MM-dd"))
    c = A.table(spark, sf, "customer").withColumns({
        "team": F.concat(F.lit("team"), F.col("c_nationkey").cast("string")), "kit_number": (key % 40).cast("int"), "text": text,
    })
    roster = c.where(key % 5 != 0).select("team", "kit_number", F.lit("2000/2001").alias("season"), F.col("text").alias("date_of_birth"))
    seen = c.select(key.alias("player_id"), F.col("team").alias("team_name"), "kit_number", F.lit(date(2000, 9, 1)).alias("day"))
    return prepare.birthdays(seen, roster)


@query(f"""with {A.GM}, l as (select distinct o_custkey % 7 as fixture_id, n_name as team_name, case
when o_custkey % 3 = 0 then o_custkey end as fapi_id,
cast(o_custkey % 30 as int) as kit_number, n_nationkey from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey),
m as (select l.*, max_by(player_id, (valid_from, player_id)) as by_squad from l left join sq on sq.team_id = n_nationkey
and sq.kit_number = l.kit_number
and date '1999-01-01' between valid_from and valid_to group by all),
e as (select player_id, max_by(metric_value, (game_date, game_id)) as elo from bm where version = 0.2 and metric = 'elo' group by player_id),
f as (select fixture_id, team_name, kit_number, case when fapi_id % 2 = 0 then fapi_id else by_squad end as player_id from m)
select fixture_id, team_name, kit_number, f.player_id as player_id, elo from f left join e on e.player_id = f.player_id""")
def announced_ratings(spark, sf):
    """Starters found by the service's id, which only even customers have, else by team, number and day."""
    g, n = A.games(spark, sf), A.table(spark, sf, "nation")
    teams = n.select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"))
    key = F.col("player_id")
    announced = g.join(teams, F.col("team_id") == F.col("id")).select(
        (key % 7).alias("fixture_id"), F.col("name").alias("team_name"), F.when(key % 3 == 0, key).alias("fapi_id"),
        (key % 30).cast("int").alias("kit_number"),
    ).distinct()
    schedule = spark.range(7).select(F.col("id").alias("schedule_id"), F.lit(datetime(1999, 1, 1, 12)).alias("date_time"))
    c = A.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey")).alias("fapi_id")
    )
    squad, aliases = squads.history(A.squad_entries(g)), names.alias_table(spark, {"none": ["none"]})
    return lineups.rated(announced, schedule, c, squad, teams, aliases, A.base_metric(g), VERSION)


@query("""with c as (select c_nationkey, c_custkey % 40 as kit, c_name, c_mktsegment, row_number() over (partition by c_nationkey, c_custkey % 40
order by c_custkey) as rn from customer where c_custkey % 7 <> 0)
select '2001/2002' as season, 'land_part' as league, 'team' || c_nationkey as team, cast(kit as varchar) as kit_number, c_name as name,
c_mktsegment as position from c where rn = 1""")
def roster_numbers(spark, sf):
    rows = rosters.numbers(A.roster_pages(spark, sf)).select(rosters.name_parts(F.col("key")).alias("n"), "kit_number", "cells")
    return rows.select("n.season", "n.league", "n.team", "kit_number", F.col("cells")[0].alias("name"), F.col("cells")[1].alias("position"))


# ratings


@query(
    f"""with {A.GM} select player_id, metric, metric_value, game_date, cast(rank() over (partition by player_id, metric
order by game_date desc) as int) as rnk from bm qualify rnk = 1"""
)
def latest_metric_rank(spark, sf):
    return ratings.ranked(A.base_metric(A.games(spark, sf))).where("rank = 1").withColumnRenamed("rank", "rnk")


@query(f"""with {A.GM}, w as (select player_id, max(game_date) as at_ from gm group by player_id)
select w.player_id as player_id, at_, max_by(metric_value, (game_date, game_id)) as metric_value from w left join bm on bm.player_id = w.player_id
and game_date < at_ and version = 0.2 and metric = 'elo' group by w.player_id, at_""")
def metric_asof_before(spark, sf):
    g = A.games(spark, sf)
    when = g.groupBy("player_id").agg(F.max("game_date").alias("at"))
    return ratings.as_of(A.base_metric(g), when, VERSION, "elo").withColumnRenamed("at", "at_")


@query(
    f"""with {A.GM} select player_id, max_by(metric_value, (game_date, game_id)) as metric_value from bm where version = 0.2 and metric = 'elo'
group by player_id"""
)
def latest_elo_maxby(spark, sf):
    return ratings.latest(A.base_metric(A.games(spark, sf)), VERSION)


def _average(by: str) -> str:
    return f"""av_{by} as (select n.{by} as {by}, sum(metric_value) / count(metric_value) as average, (select count(*) from gm as g
where g.{by} = n.{by} and version = 0.1) as entries
from (select {by}, player_id, max(game_date) as md from gm where version = 0.1 group by {by}, player_id) as n left
join bm on bm.player_id = n.player_id and bm.game_date = md and metric = 'elo' and game_date >= date '2001-01-01' - 168 group by n.{by})"""


@query(
    f"with {A.GM}, {_average('team_id')} select team_id, round(average + 0.0000123, 4) as average, cast(entries as bigint) as entries from av_team_id"
)
def avg_latest_by_club(spark, sf):
    g = A.games(spark, sf)
    return ratings.averages(g, A.base_metric(g), "team_id", DAY, 0.1).select("team_id", _m("average").alias("average"), "entries")


@query(
    f"with {A.GM}, {_average('league')} select league, round(average + 0.0000123, 4) as average, cast(entries as bigint) as entries from av_league"
)
def avg_latest_by_league(spark, sf):
    g = A.games(spark, sf)
    return ratings.averages(g, A.base_metric(g), "league", DAY, 0.1).select("league", _m("average").alias("average"), "entries")


@query(f"""with {A.GM}, {_average('team_id')}, {_average('league')} select t.team_id as team_id, t.league as league, round(coalesce(case
when c.entries >= 50 then c.average end, l.average) + 0.0000123, 4) as average
from (select distinct team_id, league from gm) as t left join av_team_id as c on t.team_id = c.team_id left join av_league as l on t.league = l.league""")
def avg_elo_fallback(spark, sf):
    g = A.games(spark, sf)
    return ratings.club_or_league(g, A.base_metric(g), DAY, 0.1).select("team_id", "league", _m("average").alias("average"))


@query(f"with {A.GM} select league, count(distinct player_id) as n_players from gm where version = 0.2 group by league")
def player_count_per_league(spark, sf):
    return ratings.players_per_league(A.games(spark, sf), VERSION)


_BASIC = """rq as (select player_id, count(*) as entries, sum(minutes_) as total_minutes from gm where game_date >= date '2001-01-01' - 90
group by player_id),
sd as (select player_id, kit_number, team_id from sq where date '2001-01-01' between valid_from and valid_to),
ids as (select distinct o_custkey + 5 as id from orders)"""


@query(f"""with {A.GM}, {_BASIC} select distinct ids.id as id, c_custkey is not null as exists_, kit_number, team_id, entries,
cast(total_minutes as bigint) as total_minutes
from ids left join customer on c_custkey = id left join sd on sd.player_id = c_custkey left join rq on rq.player_id = c_custkey""")
def player_basic_info(spark, sf):
    g = A.games(spark, sf)
    ids = A.table(spark, sf, "orders").select((F.col("o_custkey") + 5).alias("id"))
    got = ratings.basic_info(ids, A.players(spark, sf), g, squads.history(A.squad_entries(g)), DAY)
    return got.select("id", F.col("exists").alias("exists_"), "kit_number", "team_id", "entries", "total_minutes")


@query(f"""with {A.GM}, {_BASIC}, tm as (select player_id, max(case when metric = 'elo' then v end) as elo, max(case
when metric = 'pm' then v end) as pm from (select player_id, metric, max_by(metric_value, (game_date, game_id)) as v from bm where version = 0.1
group by player_id, metric) as x group by player_id)
select distinct ids.id as id, tm.player_id is not null as exists_, case when tm.player_id is not null then kit_number end as kit_number, tm.elo as elo,
tm.pm as pm, case when tm.player_id is not null then entries end as entries
from ids left join customer on c_custkey = id left join tm on tm.player_id = c_custkey left join sd on sd.player_id = c_custkey left
join rq on rq.player_id = c_custkey""")
def player_overall_info(spark, sf):
    g = A.games(spark, sf)
    ids = A.table(spark, sf, "orders").select((F.col("o_custkey") + 5).alias("id"))
    old = A.base_metric(g).where("version = 0.1")  # a version that not all players have
    got = ratings.overall_info(ids, A.players(spark, sf), old, g, squads.history(A.squad_entries(g)), DAY, ["elo", "pm"])
    return got.select("id", F.col("exists").alias("exists_"), "kit_number", "elo", "pm", "entries")


@query(f"with {A.GM} select game_id, player_id from gm where version = 0.2 and valid = 1")
def games_filtered(spark, sf):
    return ratings.games_for_training(A.games(spark, sf), VERSION).select("game_id", "player_id")


@query(f"with {A.GM} select game_id, player_id from gm order by game_date desc, game_id desc, player_id limit 100")
def games_latest_n(spark, sf):
    return ratings.games_for_training(A.games(spark, sf), VERSION, 100).select("game_id", "player_id")


@query(f"with {A.GM} select count(distinct game_id) as n from gm")
def n_distinct_games(spark, sf):
    return A.games(spark, sf).agg(F.countDistinct("game_id").alias("n"))


@query(
    "select o_orderkey, cast(o_orderdate as date) as day_ from orders where cast(o_orderdate as date) between date '1998-03-01' and date '1998-03-31'"
)
def games_in_timeframe(spark, sf):
    schedule = A.table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day_"))
    return ratings.within(schedule, "day_", date(1998, 3, 1), date(1998, 3, 31))


@query(
    f"""with {A.GM} select player_id, count(*) as entries, cast(sum(minutes_) as bigint) as total_minutes from gm
where game_date >= date '2001-01-01' - 90 and game_date <= date '2001-01-01' group by player_id"""
)
def recent_entries(spark, sf):
    return ratings.recent(A.games(spark, sf), DAY, bounded=True)


@query(f"""with {A.GM}, p as (select team_id, game_id % 4 = 0 as missing_, case when game_id % 3 = 0 then null else game_id % 20 end as entries
from gm)
select team_id, case when avg(cast(missing_ as double)) > 0.2 or avg(coalesce(cast(entries < 5 as double), 0.0)) > 0.2 then 0
else 1 end as valid_for_training from p group by team_id""")
def valid_for_training(spark, sf):
    p = A.games(spark, sf).select(
        "team_id", (F.col("game_id") % 4 != 0).alias("exists"), F.when(F.col("game_id") % 3 != 0, F.col("game_id") % 20).alias("entries")
    )
    return ratings.valid_for_training(p, "team_id")


_PAIRED = """pg as (select game_id % 997 as game_id, team_id % 2 as team_id, result, elo, team_id % 2 as home from gm),
mr as (select game_id, team_id, result from (select game_id, team_id, result, row_number() over (partition by game_id, team_id order by count(*) desc,
result) as rn from pg group by game_id, team_id, result) as x where rn = 1)"""


@query(f"with {A.GM}, {_PAIRED} select * from mr")
def mode_result(spark, sf):
    return ratings.commonest_result(A.paired_games(A.games(spark, sf)))


@query(f"""with {A.GM}, {_PAIRED}, s as (select game_id, team_id, avg(elo) as elo from pg group by game_id, team_id)
select h.game_id as game_id, h.team_id as home_team, a.team_id as away_team, mr.result as result, round(h.elo + 0.0000123, 4) as home_elo,
round(a.elo + 0.0000123, 4) as away_elo from s as h join s as a on h.game_id = a.game_id and h.team_id = 1 and a.team_id = 0
join mr on mr.game_id = h.game_id and mr.team_id = 1""")
def team_pair_selfjoin(spark, sf):
    return ratings.team_pairs(A.paired_games(A.games(spark, sf))).withColumns({"home_elo": _m("home_elo"), "away_elo": _m("away_elo")})


@query(
    f"""with {A.GM} select game_date, round(avg(elo) + 0.0000123, 4) as elo, round(avg(minutes_) + 0.0000123, 4) as minutes_on from gm
group by game_date"""
)
def group_mean_by_date(spark, sf):
    return A.games(spark, sf).groupBy("game_date").agg(_m(F.avg("elo")).alias("elo"), _m(F.avg("minutes")).alias("minutes_on"))


@query(f"with {A.GM} select league, min(game_date) as first_day, max(game_date) as last_day, count(*) as n from gm group by league")
def date_summary(spark, sf):
    return A.games(spark, sf).groupBy("league").agg(
        F.min("game_date").alias("first_day"), F.max("game_date").alias("last_day"), F.count("*").alias("n")
    )


@query(f"with {A.GM} select cast(floor(elo / 50000) as bigint) as bucket, count(*) as n from gm group by 1")
def elo_histogram(spark, sf):
    return A.games(spark, sf).groupBy(F.floor(F.col("elo") / 50000).alias("bucket")).agg(F.count("*").alias("n"))


@query(f"with {A.EV} select game_id, team_id, array_to_string(list_sort(list(distinct player_id)), ',') as players from ev group by game_id, team_id")
def lineup_lists(spark, sf):
    lists = A.lineups(A.event_rows(spark, sf)).distinct().groupBy("game_id", "team_id").agg(
        F.array_sort(F.collect_list("player_id")).alias("players")
    )
    return lists.withColumn("players", F.array_join("players", ","))


# squads


@query(f"with {A.GM} select player_id, kit_number, team_id from sq where date '2000-06-15' between valid_from and valid_to")
def squad_at_date(spark, sf):
    return ratings.squad_on(squads.history(A.squad_entries(A.games(spark, sf))), F.lit(date(2000, 6, 15)))


@query(f"with {A.GM} select * from sq")
def scd2_build(spark, sf):
    return squads.history(A.squad_entries(A.games(spark, sf)))


_CLOSED = """cl as (select player_id, kit_number, team_id, valid_from, case when kit_number < 10 and valid_from <= date '1999-05-05'
and valid_to >= date '1999-05-05' then date '1999-05-05' else valid_to end as valid_to from sq)"""


def _taken(squad: DataFrame) -> DataFrame:
    return squad.where("kit_number < 10").select("team_id", "kit_number", F.lit(date(1999, 5, 5)).alias("day")).distinct()


@query(f"with {A.GM}, {_CLOSED} select * from cl")
def number_in_use_close(spark, sf):
    squad = squads.history(A.squad_entries(A.games(spark, sf)))
    return squads.close_number(squad, _taken(squad))


@query(f"""with {A.GM}, ch as (select c_custkey as player_id, 90 as kit_number, cast(c_nationkey as bigint) as team_id, date '2001-09-01' as day_
from customer where c_mktsegment = 'BUILDING')
select sq.player_id as player_id, sq.kit_number as kit_number, sq.team_id as team_id, valid_from, case when valid_to = date '2099-12-31'
and ch.player_id is not null then day_ else valid_to end as valid_to from sq left join ch on ch.player_id = sq.player_id
union all select player_id, kit_number, team_id, day_, case when lead(player_id) over (partition by team_id order by player_id) is null
then date '2099-12-31' else day_ end from ch""")
def squad_change(spark, sf):
    c = A.table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'")  # who changes number
    changes = c.select(
        F.col("c_custkey").alias("player_id"), F.lit(90).alias("kit_number"), F.col("c_nationkey").cast("long").alias("team_id"),
        F.lit(date(2001, 9, 1)).alias("day")
    )
    return squads.change(squads.history(A.squad_entries(A.games(spark, sf))), changes)


_LOG = """lg as (select case o_orderkey % 9 when 0 then 'take' when 1 then 'enter' else 'change' end as kind, o_custkey as player_id,
cast(o_orderkey % 30 as int) as kit_number, cast(o_custkey % 25 as bigint) as team_id, cast(o_orderdate as date) + 200 as day_, o_orderkey as seq from orders),
ev as (select *, row_number() over (order by day_, seq) as n from lg)"""


# for each row the least day of the events that may end it, without looking at their order
@query(f"""with {A.GM}, {_LOG}, rw as (select player_id, kit_number, team_id, valid_from, valid_to, 0 as n from sq
union all select player_id, kit_number, team_id, case kind when 'enter' then date '1900-01-01' else day_ end, date '2099-12-31', n from ev where kind <> 'take'),
tk as (select r.player_id, r.n, r.valid_from, min(e.day_) as d from rw r join ev e on e.team_id = r.team_id and e.kit_number = r.kit_number
and e.n > r.n and e.day_ >= r.valid_from group by all),
mv as (select r.player_id, r.n, r.valid_from, min(e.day_) as d from rw r join ev e on e.player_id = r.player_id and e.kind = 'change' and e.n > r.n
where r.valid_to = date '2099-12-31' group by all)
select r.player_id, r.kit_number, r.team_id, r.valid_from, least(r.valid_to, tk.d, mv.d) as valid_to from rw r
left join tk on tk.player_id = r.player_id and tk.n = r.n and tk.valid_from = r.valid_from
left join mv on mv.player_id = r.player_id and mv.n = r.n and mv.valid_from = r.valid_from""")
def squad_log(spark, sf):
    """A log in which players change often and numbers go from hand to hand."""
    kind = F.expr(f"case o_orderkey % 9 when 0 then '{squads.TAKE}' when 1 then '{squads.ENTER}' else '{squads.CHANGE}' end")
    log = A.table(spark, sf, "orders").select(
        kind.alias("kind"), F.col("o_custkey").alias("player_id"), F.expr("cast(o_orderkey % 30 as int)").alias("kit_number"),
        F.expr("cast(o_custkey % 25 as long)").alias("team_id"), F.date_add(F.to_date("o_orderdate"), 200).alias("day"), F.col("o_orderkey").alias("seq")
    )
    return squads.replay(squads.history(A.squad_entries(A.games(spark, sf))), log)


# sightings of the numbers that players have; whoever has the number of the sighting before stays
@query(f"""with {A.GM}, first as (select player_id, min(day_) as f from se group by player_id), op as (select player_id, kit_number, team_id from sq join first using (player_id)
where valid_to = date '2099-12-31' and player_id % 3 = 0),
sn as (select player_id, kit_number, team_id, null as day_ from (select *, row_number() over (partition by team_id, kit_number order by player_id) as rn from op) where rn = 1
union all select player_id, kit_number, team_id, day_ + 3000 from se),
mk as (select *, lag(player_id) over (partition by team_id, kit_number order by day_ nulls first, player_id) as who,
lag(kit_number) over (partition by player_id order by day_ nulls first, team_id, kit_number) as what,
lag(team_id) over (partition by player_id order by day_ nulls first, team_id, kit_number) as place from sn)
select case when bool_or(day_ is null) over (partition by player_id) or what is not null then 'change' else 'enter' end as kind, player_id, kit_number, team_id, day_ as day
from mk qualify day_ is not null and not (coalesce(who = player_id, false) and coalesce(what = kit_number, false) and coalesce(place = team_id, false))""")
def squad_sightings(spark, sf):
    """What line-ups, seen years later, change in the squads of every third player."""
    entries = A.squad_entries(A.games(spark, sf))
    squad = squads.history(entries).where(F.col("valid_to") == F.lit(squads.FOREVER)).where("player_id % 3 = 0")
    squad = squad.groupBy("team_id", "kit_number").agg(F.min_by(F.struct("player_id", "valid_from", "valid_to"), "player_id").alias("r"))
    seen = entries.withColumn("day", F.date_add("day", 3000))
    return squads.events_of(squad.select("r.player_id", "kit_number", "team_id", "r.valid_from", "r.valid_to"), seen).drop("seq")


@query(f"""with {A.GM}, l as (select n_nationkey as team_id, n_name as team_name, cast(k as int) as kit_number from nation, range(30) as r(k))
select team_name, l.kit_number as kit_number, max_by(player_id, (valid_from, player_id)) as player_id from l left join sq on sq.team_id = l.team_id
and sq.kit_number = l.kit_number and date '1999-01-01' between valid_from and valid_to group by team_name, l.kit_number""")
def match_player(spark, sf):
    teams = A.table(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"))
    numbers = teams.select(F.col("name").alias("team_name"), F.explode(F.sequence(F.lit(0), F.lit(29))).alias("kit_number"))
    return squads.match(numbers, squads.history(A.squad_entries(A.games(spark, sf))), teams, F.lit(date(1999, 1, 1)))


# changes of tables


@query(f"""with {A.PITCH}, o as (select player_id, game_id, 'minutes' as metric, cast(p_off - p_on as double) as value from pl),
n as (select player_id,
game_id, metric, -1.0 as value from o where value >= 90 union all select player_id + 1000000, game_id, metric, value from o where value < 10)
select * from n union all select * from o where not exists (select 1 from n where n.player_id = o.player_id and n.game_id = o.game_id
and n.metric = o.metric)""")
def upsert_metrics(spark, sf):
    old = minutes_played(spark, sf)
    new = old.where("value >= 90").withColumn("value", F.lit(-1.0)).unionByName(
        old.where("value < 10").withColumn("player_id", F.col("player_id") + 1_000_000)
    )
    return upsert.merged(old, new, ["player_id", "game_id", "metric"])


@query("select c_custkey, case when c_acctbal < 0 then 'new' || c_custkey else c_name end as c_name from customer")
def update_columns(spark, sf):
    customer = A.table(spark, sf, "customer")
    old = customer.select("c_custkey", "c_name")
    new = customer.select("c_custkey", F.when(F.col("c_acctbal") < 0, F.concat(F.lit("new"), F.col("c_custkey").cast("string"))).alias("c_name"))
    return upsert.updated(old, new, ["c_custkey"], ["c_name"])


@query("select c_custkey from customer where not exists (select 1 from orders where o_custkey = c_custkey and o_orderdate >= timestamp '2001-01-01')")
def unprocessed_anti(spark, sf):
    done = A.table(spark, sf, "orders").where("o_orderdate >= timestamp_ntz'2001-01-01'").select(F.col("o_custkey").alias("c_custkey"))
    return dedup.unprocessed(A.table(spark, sf, "customer").select("c_custkey"), done, "c_custkey")


@query("select c_custkey from customer where exists (select 1 from orders where o_custkey = c_custkey and o_totalprice > 400000)")
def exists_semi(spark, sf):
    rich = A.table(spark, sf, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return dedup.known(A.table(spark, sf, "customer").select("c_custkey"), rich, "c_custkey")


@query(f"with {A.EV} select distinct game_id from ev")
def processed_distinct(spark, sf):
    return A.event_rows(spark, sf).select("game_id").distinct()


@query(
    """select l_partkey, l_orderkey, l_linenumber from (select *, row_number() over (partition by l_partkey order by l_orderkey, l_linenumber) as rn
from lineitem) as x where rn = 1"""
)
def dedup_first(spark, sf):
    return dedup.keep_first(
        A.table(spark, sf, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber"), ["l_partkey"], F.col("l_orderkey"), F.col("l_linenumber")
    )


@query(
    """select o_custkey, o_orderkey from (select *, row_number() over (partition by o_custkey order by o_orderkey desc) as rn from orders) as x
where rn = 1"""
)
def dedup_last(spark, sf):
    return dedup.keep_last(A.table(spark, sf, "orders").select("o_custkey", "o_orderkey"), ["o_custkey"], "o_orderkey")


@query("select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 25")
def top_n(spark, sf):
    return A.table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


_PART = "cast(('0x' || substr(md5('7:' || o_orderkey), 1, 8)) as ubigint) / 4294967296.0"


@query(f"select o_orderkey, {_PART} < 0.8 as in_train from orders")
def split_shares(spark, sf):
    train, rest = splits.shares(A.table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"])
    return train.withColumn("in_train", F.lit(True)).unionByName(rest.withColumn("in_train", F.lit(False)))


@query("select o_orderkey, o_orderdate >= timestamp '1998-07-01' as later from orders")
def split_by_day(spark, sf):
    before, after = splits.by_day(A.table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", date(1998, 7, 1))
    return before.select("o_orderkey", F.lit(False).alias("later")).unionByName(after.select("o_orderkey", F.lit(True).alias("later")))


@query(f"select o_orderkey from orders order by {_PART}, o_orderkey limit 100")
def sample_games(spark, sf):
    return splits.sample(A.table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], 100)


# dates, seasons and names


@query(
    """select o_orderkey, (year(o_orderdate) - case when month(o_orderdate) < 7 then 1 else 0 end) || '/' || (year(o_orderdate) + case
when month(o_orderdate) < 7 then 0 else 1 end) as season from orders"""
)
def season_string(spark, sf):
    return A.table(spark, sf, "orders").select("o_orderkey", dates.season_name(F.col("o_orderdate")).alias("season"))


@query(
    """select o_orderkey, cast(case when month(o_orderdate) >= 7 then year(o_orderdate) - 2000 else year(o_orderdate) - 2001 end as int) as code
from orders"""
)
def season_code(spark, sf):
    return A.table(spark, sf, "orders").select("o_orderkey", dates.season_code(F.col("o_orderdate")).alias("code"))


@query("""with d as (select o_orderkey, cast(o_orderdate as date) as a, cast(o_orderdate as date) + cast(o_orderkey % 900 as int) as b from orders)
select o_orderkey, cast(y - 2000 as int) as code from (select *, unnest(range(year(a) - 1, year(b) + 2)) as y from d) as x where make_date(y, 7,
1) <= b and make_date(y + 1, 6, 30) >= a""")
def season_overlap(spark, sf):
    d = A.table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("a"))
    d = d.withColumn("b", F.date_add("a", (F.col("o_orderkey") % 900).cast("int")))
    return d.select("o_orderkey", F.explode(dates.season_codes_between(F.col("a"), F.col("b"))).alias("code"))


@query(f"""with d as (select o_orderkey, year(o_orderdate) as y from orders)
select o_orderkey, lpad(cast(y % 100 as varchar), 2, '0') || lpad(cast((y + 1) % 100 as varchar), 2, '0') as multi, cast(y as varchar) as single from d""")
def season_parse(spark, sf):
    """Seasons written in six ways, by the order's number; each has the codes of its first year."""
    y = F.year("o_orderdate")
    text, short = lambda c: c.cast("string"), lambda c: F.lpad((c % 100).cast("string"), 2, "0")
    forms = [
        text(y), short(y), F.concat_ws("-", text(y), text(y + 1)), F.concat_ws("/", text(y), text(y + 1)), F.concat_ws("-", text(y), short(y + 1)),
        F.concat_ws("/", short(y), short(y + 1))
    ]
    form = F.get(F.array(*forms), (F.col("o_orderkey") % 6).cast("int"))
    d = A.table(spark, sf, "orders").select("o_orderkey", form.alias("s"))
    return d.select(
        "o_orderkey", seasons.parse_season(F.col("s"), True, 2024).alias("multi"), seasons.parse_season(F.col("s"), False, 2024).alias("single")
    )


@query(
    """select o_orderkey, case when yy >= 69 then 1900 + yy else 2000 + yy end as year_ from (select o_orderkey, cast(o_orderkey % 100 as int) as yy
from orders) as x"""
)
def short_dates(spark, sf):
    text = F.concat(F.lit("05-03-"), F.lpad((F.col("o_orderkey") % 100).cast("string"), 2, "0"))
    return A.table(spark, sf, "orders").select("o_orderkey", F.year(dates.short_date(text)).alias("year_"))


_ALIASED = "case n_name when 'GERMANY' then 'Deutschland' when 'UNITED KINGDOM' then 'Great Britain' when 'UNITED STATES' then 'USA' end"


@query(f"select n_nationkey, coalesce({_ALIASED}, n_name) as n_name from nation")
def alias_keep(spark, sf):
    return names.resolve(A.table(spark, sf, "nation").select("n_nationkey", "n_name"), "n_name", names.alias_table(spark, ALIASES))


@query(f"select n_nationkey, {_ALIASED} as n_name from nation")
def alias_null(spark, sf):
    return names.resolve(
        A.table(spark, sf, "nation").select("n_nationkey", "n_name"), "n_name", names.alias_table(spark, ALIASES), "null"
    ).select("n_nationkey", "n_name")


@query(
    """select distinct n_name from nation where n_name not in ('GERMANY', 'UNITED KINGDOM', 'BRITAIN', 'UNITED STATES', 'Deutschland', 'Great Britain',
'USA')"""
)
def unknown_names(spark, sf):
    return names.unknown_names(A.table(spark, sf, "nation"), "n_name", names.alias_table(spark, ALIASES))


@query("select r_regionkey as region_key, r_name as full_region__name, length(r_name) as a_b from region")
def snake_case_check(spark, sf):
    r = A.table(spark, sf, "region")
    return names.with_snake_case(
        r.select(F.col("r_regionkey").alias("regionKey"), F.col("r_name").alias("FullRegion-Name"), F.length("r_name").cast("long").alias("a__B"))
    )


@query(
    """select o_orderkey, case when o_orderkey % 5 = 0 then '' else strftime(o_orderdate,
'%Y-%m-%d') || ' ' end || c_name || '-' || c_mktsegment as game from orders join customer on o_custkey = c_custkey"""
)
def game_id_string(spark, sf):
    o = A.table(spark, sf, "orders").join(A.table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    day = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderdate"))
    return o.select("o_orderkey", names.game_name(F.col("c_name"), F.col("c_mktsegment"), day).alias("game"))


@query(
    """select o_orderkey, o_orderkey as region_id, case when o_orderkey % 2 = 0 then o_custkey end as tournament_id, case
when o_orderkey % 3 = 0 then o_orderkey + 1 end as season_id from orders"""
)
def url_parts(spark, sf):
    k = F.col("o_orderkey")
    part = lambda name, c, n: F.when(k % n == 0, F.concat(F.lit(f"{name}/"), c.cast("string"), F.lit("/"))).otherwise(F.lit(""))
    url = F.concat(
        F.when(k % 5 == 0, "https://www.example.com/").otherwise("/"), part("Regions", k, 1), part("Tournaments", F.col("o_custkey"), 2),
        part("Seasons", k + 1, 3), F.lit("Fixtures")
    )
    return A.table(spark, sf, "orders").select("o_orderkey", names.url_ids(url).alias("u")).select(
        "o_orderkey", "u.region_id", "u.tournament_id", "u.season_id"
    )


@query("select page_id, unnest(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1)) as url from pages")
def html_links(spark, sf):
    pages = A.table(spark, sf, "pages").select(F.col("page_id").cast("string").alias("path"), F.col("html").alias("content"))
    return html.links(pages).select(F.col("key").cast("long").alias("page_id"), "url")


@query("select page_id, url from pages where not (contains(url, '/de/') or contains(url, '#top'))")
def link_filter(spark, sf):
    return A.table(spark, sf, "pages").select("page_id", "url").where(~names.blacklisted(F.col("url"), ["/de/", "#top"]))


# formulas


@query(
    f"""with {A.GM} select game_id, player_id, cast(split_part(result, '-', 1) as int) as home_goals, cast(split_part(result, '-',
2) as int) as away_goals, cast(split_part(result, '-', 1) as int) - cast(split_part(result, '-', 2) as int) as margin from gm"""
)
def result_split(spark, sf):
    r = F.col("result")
    return A.games(spark, sf).select(
        "game_id", "player_id", scoring.result_part(r, 0).alias("home_goals"), scoring.result_part(r, 1).alias("away_goals"),
        scoring.goal_margin(r).alias("margin")
    )


@query(
    """select p_partkey, case when p_size % 7 = 0 then null else round(1.0 / (p_size % 7), 9) end as probability, case when p_size % 7 = 0 then null
else round(100.0 / (p_size % 7), 6) end as percentage from part"""
)
def odds_probability(spark, sf):
    odds = (F.col("p_size") % 7).cast("double")
    return A.table(spark, sf, "part").select(
        "p_partkey", _r(scoring.odds_probability(odds), 9).alias("probability"), _r(scoring.odds_percentage(odds)).alias("percentage")
    )


_K = "least(m, 90) / 90.0 * 20 / case when coalesce(m3, 0) >= 500 then 2 else 1 end"
_EI = """ei as (select event_id, k, value, cast(user_id % 120 as int) as m, case when k % 5 <> 0 then k * 10 end as m3, 1500.0 + k as p,
1600.0 - k as t, 1450.0 + k * 2 as o, k % 7 - 3 as mov
 from (select event_id, user_id, value, cast(json_extract(props, '$.k') as int) as k from events) as x)"""


def _ei(spark: SparkSession, sf: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    e = A.table(spark, sf, "events").select("event_id", "user_id", "value", k.alias("k"))
    return e.select(
        "event_id", "k", "value", (F.col("user_id") % 120).cast("int").alias("m"), F.when(F.col("k") % 5 != 0, F.col("k") * 10).alias("m3"),
        (F.col("k") + 1500.0).alias("p"), (1600.0 - F.col("k")).alias("t"), (F.col("k") * 2 + 1450.0).alias("o"), (F.col("k") % 7 - 3).alias("mov")
    )


@query(f"with {_EI} select event_id, round({_K}, 6) as elo_weight from ei")
def elo_k(spark, sf):
    return _ei(spark, sf).select("event_id", _r(scoring.elo_k(F.col("m"), F.col("m3"))).alias("elo_weight"))


@query(f"""with {_EI} select event_id, round(case when mov > 1 then p + {_K} * (1 - pow(10, (0.33 * p + 0.67 * t) / 400) / (pow(10,
(0.33 * p + 0.67 * t) / 400) + pow(10, o / 400)))
when mov < -1 then p - {_K} * pow(10, (0.33 * p + 0.67 * t) / 400) / (pow(10, (0.33 * p + 0.67 * t) / 400) + pow(10, o / 400)) else p end, 5) as elo
from ei""")
def elo_update(spark, sf):
    rows = _ei(spark, sf).selectExpr(
        "event_id", "p as elo", "t as team_value", "o as opp_value", "mov as margin", "-1 as low", "1 as high", "m as minutes",
        "m3 as minutes_3_months"
    )
    return elo.update(rows).select("event_id", _r("updated_elo", 5).alias("elo"))


@query(f"with {_EI} select event_id, round(0.33 * p + 0.67 * t - o, 6) as diff from ei")
def elo_predict_rating(spark, sf):
    return _ei(spark, sf).select("event_id", _r(scoring.elo_rating(F.col("p"), F.col("t")) - F.col("o")).alias("diff"))


@query(
    f"""with {_EI} select event_id, round(case when m3 is null then o when k < 50 then case when k % 2 = 0 then p else p * 0.7 end else t end,
6) as elo from ei"""
)
def elo_seeds(spark, sf):
    known = F.when(F.col("m3").isNotNull(), F.col("k"))
    return _ei(spark, sf).select(
        "event_id",
        _r(F.when(known.isNull(), F.col("o")).otherwise(scoring.elo_seed(known, F.col("t"), F.col("p"), F.col("k") % 2 == 0))).alias("elo")
    )


@query(f"with {_EI} select event_id, round(((p * 0.34 + t * 0.66) - o) * least(m / 90.0, 1.0), 6) as expected from ei")
def pm_predict(spark, sf):
    return _ei(spark, sf).select("event_id", _r(scoring.pm_predict(F.col("p"), F.col("t"), F.col("o"), F.col("m"))).alias("expected"))


@query(f"with {_EI} select event_id, round(p + (mov - t) / 10, 6) as pm from ei")
def pm_update(spark, sf):
    return _ei(spark, sf).select("event_id", _r(scoring.pm_update(F.col("p"), F.col("mov"), F.col("t"))).alias("pm"))


@query(f"with {_EI} select k % 10 as bucket, quantile_cont(value, 0.25) as low, quantile_cont(value, 0.75) as high from ei group by 1")
def mov_quantiles(spark, sf):
    return elo.margin_quartiles(_ei(spark, sf).withColumn("margin", F.col("value")), F.col("k") % 10)


# how many values are on each side of the sketch's quartiles is known within its error; ranges of it hold the exact ones
@query(f"""with {_EI}, d as (select e.k % 10 as bucket, e.value, x.ts::date as day_ from ei as e join events as x using (event_id) where e.value is not null),
r as (select * from d where day_ >= date '2024-01-08')
select bucket, count(*) as n, true as low_holds, true as high_holds from r group by 1""")
def margin_sketches(spark, sf):
    """Quartiles of all days but the first week's, from sketches by bucket and day: whether each is within the sketch's error."""
    e = A.table(spark, sf, "events").select("value", "ts", F.get_json_object("props", "$.k").cast("int").alias("k"))
    bucket, day = (F.col("k") % 10).alias("bucket"), F.to_date("ts")
    stored = sketches.daily(e, F.col("value"), bucket, day).where(F.col("day") >= F.lit(date(2024, 1, 8)))
    low_high = sketches.quartiles(stored)
    rows = e.where(day >= F.lit(date(2024, 1, 8))).where("value is not null").select(bucket, "value").join(F.broadcast(low_high), "bucket")  # ten rows
    share = lambda c: F.count_if(c) / F.count("*")
    holds = lambda q, rank: (share(F.col("value") < F.col(q)) <= rank + sketches.ERROR) & (share(F.col("value") <= F.col(q)) >= rank - sketches.ERROR)
    return rows.groupBy("bucket").agg(F.count("*").alias("n"), holds("low", 0.25).alias("low_holds"), holds("high", 0.75).alias("high_holds"))


@query(f"with {_EI} select event_id, round(mov / cast(max(abs(mov)) over () as double), 6) as scaled, greatest(mov, 0) as clipped from ei")
def maxabs_scaled(spark, sf):
    rows = _ei(spark, sf)
    most = rows.agg(F.max(F.abs("mov")).alias("most"))  # one row
    return rows.join(F.broadcast(most)).select(
        "event_id", _r(F.col("mov") / F.col("most").cast("double")).alias("scaled"), F.greatest("mov", F.lit(0)).alias("clipped")
    )


@query(f"""with {_EI}, r as (select distinct k, 0.5 + k / 50.0 as h, 2.5 - k / 50.0 as a from ei), g as (select i, case when i < 2 then 1.0
else exp(lgamma(i + 1.0)) end as f from range(61) as t(i)),
s as (select k, x.i as x, y.i as y, exp(-h) * pow(h, x.i) / x.f * exp(-a) * pow(a, y.i) / y.f as p from r, g as x, g as y)
select k, round(sum(case when x > y then p end) / sum(p), 6) as win, round(sum(case when x = y then p end) / sum(p), 6) as draw, round(sum(case
when x < y then p end) / sum(p), 6) as loss from s group by k""")
def poisson_outcomes(spark, sf):
    r = _ei(spark, sf).select("k").distinct()
    p = r.select("k", scoring.outcome_probabilities(F.col("k") / 50.0 + 0.5, F.lit(2.5) - F.col("k") / 50.0).alias("p"))
    return p.select("k", *(_r(f"p.{c}").alias(c) for c in ("win", "draw", "loss")))


@query(
    f"""with {_EI} select m % 10 as bucket, round(avg(pow(k / 200.0 - case when mov > 0 then 1 else 0 end, 2) + pow(0.25 - case when mov = 0 then 1
else 0 end, 2) + pow(0.75 - k / 200.0 - case when mov < 0 then 1 else 0 end, 2)), 6) as brier from ei group by 1"""
)
def brier_multi(spark, sf):
    p = [F.col("k") / 200.0, F.lit(0.25), F.lit(0.75) - F.col("k") / 200.0]
    y = [F.when(c, 1).otherwise(0) for c in (F.col("mov") > 0, F.col("mov") == 0, F.col("mov") < 0)]
    return _ei(spark, sf).groupBy((F.col("m") % 10).alias("bucket")).agg(_r(F.avg(scoring.brier(p, y))).alias("brier"))


@query(f"""with {A.EV}, tl as (select game_id, team_id, minute, avg(value) as v from ev group by game_id, team_id, minute),
{A.PITCH.split('end as type from events),', 1)[1]}
select pl.game_id as game_id, player_id, round(avg(case when tl.team_id = pl.team_id then v end) + 0.0000123, 4) as team_value, round(avg(case
when tl.team_id <> pl.team_id then v end) + 0.0000123, 4) as opp_value from pl join tl on tl.game_id = pl.game_id and tl.minute between p_on and p_off
group by pl.game_id, player_id""")
def timeline_values(spark, sf):
    line = A.event_rows(spark, sf).where("player_id is not null").groupBy("game_id", "team_id", F.col("expanded_minute").alias("minute"))
    return elo.team_value(line.agg(F.avg("value").alias("value")), _on_pitch(spark, sf)).select(
        "game_id", "player_id", _m("team_value").alias("team_value"), _m("opp_value").alias("opp_value")
    )


@query(
    f"""with {_EI} select k % 10 as bucket, round(avg(pow(value - k, 2)), 4) as mse,
round(avg(ln(2 + m) + 0.9189385332046727 + pow((value - k) / (2 + m), 2) / 2), 6) as nll from ei group by 1"""
)
def forecast_scores(spark, sf):
    seen, mean, deviation = F.col("value"), F.col("k").cast("double"), (F.col("m") + 2).cast("double")
    mse, nll = F.avg(scoring.squared_error(mean, seen)), F.avg(scoring.normal_nll(seen, mean, deviation))
    return _ei(spark, sf).groupBy((F.col("k") % 10).alias("bucket")).agg(_r(mse, 4).alias("mse"), _r(nll).alias("nll"))


# a page's time by the one before it of its host, step by step
@query("""with recursive p as (select split_part(url, '/', 3) as host, url, max(page_id % 5) as priority, max(page_id % 4) as tries,
max(1000.0 - page_id % 100) as failed from pages where url is not null group by 1, 2),
l as (select * from p where url not in (select url from pages where page_id % 7 = 0 and url is not null)),
r as (select host, url, row_number() over (partition by host order by ready, priority desc, url) - 1 as place, ready from
(select *, case when tries < 1 then 1000.0 else greatest(failed + 30.0 * pow(2, tries - 1), 1000.0) end as ready from l)),
t as (select host, url, place, cast(ready as double) as due from r where place = 0
union all select r.host, r.url, r.place, greatest(r.ready, t.due + 1.0) from t join r on r.host = t.host and r.place = t.place + 1)
select host, url, cast(place as int) as place, due from t""")
def crawl_frontier(spark, sf):
    """When to fetch the pages that have not landed, one a second and host, with failed ones later."""
    pages = A.table(spark, sf, "pages").select(
        F.split_part("url", F.lit("/"), F.lit(3)).alias("host"), "url", (F.col("page_id") % 5).alias("priority"), (F.col("page_id") % 4).alias("tries"),
        (1000.0 - F.col("page_id") % 100).alias("failed_at"), "page_id"
    )
    return frontier.schedule(pages, pages.where("page_id % 7 = 0"), 1000.0)
