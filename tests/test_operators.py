import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from touchline.operators import actions as stream
from touchline.operators import actionvalue, elo, ratings, splits, squads, threat, upsert

ACTION = "game_id long, period_id int, action_id int, time_seconds double, team_id long, player_id long, start_x double, start_y double, end_x double, end_y double, type_name string, result_name string"


def actions(spark, rows):
    return spark.createDataFrame(rows, ACTION)


def act(i, kind="pass", result="success", team=1, player=7, x0=10.0, x1=10.0, t=60.0, period=1):
    return (1, period, i, t, team, player, x0, 10.0, x1, None if x1 is None else 10.0, kind, result)


def test_threat_solved_by_hand(spark):
    """Two cells: from the left every move succeeds into the right; on the right every action is a shot, half of them goals."""
    rows = [act(i, x0=10.0, x1=90.0) for i in range(4)] + [act(10, "shot", "success", x0=90.0, x1=100.0), act(11, "shot", "fail", x0=90.0, x1=100.0)]
    grid = threat.fit(actions(spark, rows), 2, 1)
    assert [r.threat for r in grid.orderBy("cell").collect()] == pytest.approx([0.5, 0.5])
    more = rows + [act(20, "pass", "fail", x0=10.0, x1=90.0) for _ in range(4)]
    assert [r.threat for r in threat.fit(actions(spark, more), 2, 1).orderBy("cell").collect()] == pytest.approx([0.25, 0.5])


def test_rating_and_sum(spark):
    grid = threat.grid(spark, [0.1, 0.4])
    rows = [
        act(1, x0=10.0, x1=90.0, t=600.0), act(2, x0=90.0, x1=10.0, t=5400.0), act(3, "pass", "fail", x0=10.0, x1=90.0),
        act(4, "tackle", x0=10.0, x1=90.0), act(5, x1=None), act(6, x0=10.0, x1=90.0, t=0.0), act(7, x0=10.0, x1=90.0, t=900.0, player=9)
    ]
    rated = threat.rate(actions(spark, rows), grid, 2, 1)
    assert {r.action_id: r.value for r in rated.collect()} == {
        1: pytest.approx(0.3), 2: pytest.approx(-0.3), 3: None, 4: None, 6: pytest.approx(0.3), 7: pytest.approx(0.3)
    }
    pitch = spark.createDataFrame(
        [(1, 7, 1, 0, 90), (1, 8, 1, 0, 90), (1, 9, 1, 15, 90)], "game_id long, player_id long, team_id long, minute_on int, minute_off int"
    )
    got = {r.player_id: r.value for r in threat.on_pitch_sum(pitch, rated).collect()}
    assert got == {7: pytest.approx(0.3), 8: 0.0, 9: 0.0}  # actions at the minutes on and off don't count
    late = {r.player_id: r.value for r in threat.on_pitch_sum(pitch, rated.withColumn("period_id", F.lit(2)), "match").collect()}
    assert late[9] == pytest.approx(0.3)
    assert threat.xt_metric(pitch, None, grid).collect() == [] == threat.xt_metric(pitch, rated, None).collect()


def test_labels(spark):
    rows = [act(i, team=1 + i % 2) for i in range(12)] + [act(12, "shot", "success", team=1), act(13, "shot", "owngoal", team=1)]
    got = {r.action_id: (r.scores, r.concedes) for r in actionvalue.labels(actions(spark, rows)).collect()}
    assert got[2] == (False, False) and got[3] == (False, True) and got[4] == (True, True) and got[12] == (True, True) and got[13] == (False, True)


def test_value_steps(spark):
    df = actions(spark, [act(1), act(2), act(3, team=2)]).withColumns({"p_scores": F.col("action_id") / 10, "p_concedes": F.lit(0.02)})
    got = {r.action_id: (round(r.offensive, 9), round(r.defensive, 9)) for r in actionvalue.values(df).collect()}
    assert got == {1: (0.1, -0.02), 2: (0.1, 0.0), 3: (0.28, 0.18)}


def test_action_value_models(spark):
    rows = [act(i, "shot" if i % 5 == 0 else "pass", "success" if i % 10 == 0 else "fail", team=1 + i % 2, x0=float(i % 100)) for i in range(200)]
    rated = actionvalue.rate(actions(spark, rows), actionvalue.fit(actions(spark, rows), maxIter=2, maxDepth=2))
    assert rated.count() == 200 and rated.where("value is null").count() == 0
    names = {r.type_name for r in stream.atomic(actions(spark, rows)).collect()}
    assert names == {"shot", "pass", "goal", "interception"}


def games(spark):
    rows = [(g, p, date(2020, 1, d), 90, 10 + p % 2, "L", 0.2, 1) for g, p, d in [(1, 1, 1), (2, 1, 5), (3, 1, 5), (4, 2, 3), (5, 3, 9)]]
    return spark.createDataFrame(
        rows, "game_id long, player_id long, game_date date, minutes int, team_id long, league string, version double, valid int"
    )


def test_ratings(spark):
    g = games(spark)
    m = g.select("player_id", "game_id", "game_date", "version", F.lit("elo").alias("metric"), (F.col("game_id") * 100.0).alias("metric_value"))
    assert [r["rank"] for r in ratings.ranked(m).where("player_id = 1").orderBy("game_id" if False else "metric_value").collect()] == [3, 1, 1]
    assert {r.player_id: r.metric_value for r in ratings.latest(m, 0.2).collect()} == {1: 300.0, 2: 400.0, 3: 500.0}
    when = spark.createDataFrame([(1, date(2020, 1, 5)), (1, date(2020, 1, 1)), (2, date(2021, 1, 1))], "player_id long, at date")
    assert sorted(
        map(str, ((r.player_id, r.metric_value) for r in ratings.as_of(m, when, 0.2, "elo").collect()))
    ) == ["(1, 100.0)", "(1, None)", "(2, 400.0)"]
    s = squads.history(
        spark.createDataFrame([(1, 9, 10, date(2020, 1, 1)), (1, 8, 11, date(2020, 1, 5))], "player_id long, kit_number int, team_id long, day date")
    )
    assert ratings.squad_on(s, F.lit(date(2020, 1, 5))).count() == 2  # both ends are included
    ids = spark.createDataFrame([(1,), (9,), (1,)], "id long")
    players = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    info = {r.id: r for r in ratings.basic_info(ids, players, g, s, date(2020, 1, 6)).collect()}
    assert info[1].exists and info[1].entries == 3 and not info[9].exists and info[9].name is None
    assert {
        r.id: (r.exists, r.elo, r.pm) for r in ratings.overall_info(
            players.select("id"), players, m.where("player_id = 1"), g, s, date(2020, 1, 6), ["elo", "pm"]
        ).collect()
    } == {1: (True, 300.0, None), 2: (False, None, None)}


def test_squads(spark):
    kind = "player_id long, kit_number int, team_id long, day date"
    day = date(2020, 5, 1)
    start = squads.enter(
        spark.createDataFrame([], "player_id long, kit_number int, team_id long, valid_from date, valid_to date"),
        spark.createDataFrame([(1, 9, 10, day), (2, 8, 10, day)], kind)
    )
    moved = squads.change(start, spark.createDataFrame([(2, 9, 10, day)], kind))
    got = sorted((r.player_id, r.kit_number, r.valid_from, r.valid_to) for r in moved.collect())
    assert got == [(1, 9, squads.ALWAYS, day), (2, 8, squads.ALWAYS, day), (2, 9, day, squads.FOREVER)]
    seen = spark.createDataFrame([(2, 9, 10, date(2020, 6, 1)), (3, 4, 10, date(2020, 6, 1)), (1, 7, 11, date(2020, 6, 1))], kind)
    once = squads.sync(moved, seen)
    assert once.count() == 5 and once.where("player_id = 3").first().valid_from == squads.ALWAYS
    assert sorted(map(str, squads.sync(once, seen).collect())) == sorted(map(str, once.collect()))
    teams = spark.createDataFrame([(10, "T")], "id long, name string")
    lineup = spark.createDataFrame([("T", 9), ("T", 99), ("?", 9)], "team_name string, kit_number int")
    assert sorted(str(r.player_id) for r in squads.match(lineup, once, teams, F.lit(date(2020, 6, 2))).collect()) == ["2", "None", "None"]


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    once = upsert.merged(old, new, ["k"])
    assert sorted(map(tuple, once.collect())) == [(1, "a"), (2, "c"), (3, "d")]
    assert sorted(map(tuple, upsert.merged(once, new, ["k"]).collect())) == sorted(map(tuple, once.collect()))
    assert sorted(map(tuple, upsert.appended(old, new.unionByName(new), ["k"]).collect())) == [(3, "d")]


def test_elo_season(spark, tmp_path):
    rows = [
        (date(2020, 1, d), g, p, t, m, -0.5, 0.5, 90) for d, g, p, t,
        m in [(1, 1, 1, 10, 2), (1, 1, 2, 20, -2), (8, 2, 1, 10, -1), (8, 2, 2, 20, 1), (15, 3, 1, 10, 0), (15, 3, 2, 20, 0)]
    ]
    entries = spark.createDataFrame(
        rows, "match_day date, game_id long, player_id long, team_id long, margin int, low double, high double, minutes int"
    )
    got = {(r.player_id, r.game_id): r.elo for r in elo.season(entries, 1500.0, str(tmp_path)).collect()}
    assert got[1, 1] == 1510.0 and got[2, 1] == 1490.0
    expected = 10 ** (1510 / 400) / (10 ** (1510 / 400) + 10 ** (1490 / 400))
    assert got[1, 2] == pytest.approx(1510 - 20 * expected) and got[1, 3] == got[1, 2]
    assert elo.season(entries.limit(0), 1500.0, str(tmp_path)).collect() == []


def test_elo_rounds_equal_days(spark, tmp_path, monkeypatch):
    """Leagues with different days, a player who moves, a game without opponents, and folding: as if played day by day."""
    monkeypatch.setattr(elo, "FOLD", 2)
    r = random.Random(6)
    rows, game = [], 0
    for day in range(1, 13):
        for league in (0, 1):
            if r.random() < 0.7:
                game += 1
                side = lambda k: [100 * league + 10 * k + i for i in r.sample(range(6), 3)]  # noqa: B023, E731
                home, away = (r.sample([0, 1, 2], 2))
                for team, m in ((home, 2), (away, -2)):
                    rows += [(date(2020, 1, day), game, p, 100 * league + team, m, -0.5, 0.5, r.choice([30, 90])) for p in side(team)]
    rows += [
        (date(2020, 1, 6), 99, 500, 9, 2, -0.5, 0.5, 90), (date(2020, 1, 20), 100, 500, 9, 2, -0.5, 0.5, 90),
        (date(2020, 1, 20), 100, 0, 0, -2, -0.5, 0.5, 90)
    ]
    entries = spark.createDataFrame(
        rows, "match_day date, game_id long, player_id long, team_id long, margin int, low double, high double, minutes int"
    )
    got = {(x.player_id, x.game_id): x.elo for x in elo.season(entries, 1500.0, str(tmp_path)).collect()}
    rating, want, past = {}, {}, {}
    for g in sorted({(d, g) for d, g, *_ in rows}):
        mine = [x for x in rows if (x[0], x[1]) == g]
        sides = {}
        for _, _, p, t, *_ in mine:
            sides.setdefault(t, []).append(rating.get(p, 1500.0))
        mean = {t: sum(v) / len(v) for t, v in sides.items()}
        new = {}
        for d, game, p, t, m, _, _, mins in mine:
            if len(mean) > 1:
                opp = next(v for k, v in mean.items() if k != t)
                own = 0.33 * rating.get(p, 1500.0) + 0.67 * mean[t]
                k = min(mins, 90) / 90 * 20 / (2 if sum(n for e, n in past.get(p, []) if 1 <= (d - e).days <= 90) >= 500 else 1)
                new[p] = want[p, game] = rating.get(p, 1500.0) + k * ((m > 0) - 10 ** (own / 400) / (10 ** (own / 400) + 10 ** (opp / 400)))
            past.setdefault(p, []).append((d, mins))
        rating |= new
    assert got == pytest.approx(want)


def test_as_of_reads_each_row_once(spark):
    m = spark.range(200).selectExpr(
        "id % 5 as player_id", "id as game_id", "date_add(date'2020-01-01', cast(id % 50 as int)) as game_date", "0.2D as version", "'elo' as metric",
        "double(id) as metric_value"
    )
    when = spark.range(100).selectExpr("id % 7 as player_id", "date_add(date'2019-12-30', cast(id % 60 as int)) as at")
    got = sorted(map(str, map(tuple, ratings.as_of(m, when, 0.2, "elo").collect())))
    known = [tuple(r) for r in m.select("player_id", "game_date", "game_id", "metric_value").collect()]
    want = [(p, at, max(((d, g, v) for q, d, g, v in known if q == p and d < at), default=(0, 0, None))[2]) for p, at in map(tuple, when.collect())]
    assert got == sorted(map(str, want))
    assert "Join" not in ratings.as_of(m, when, 0.2, "elo")._jdf.queryExecution().executedPlan().toString()


def test_margin_models(spark):
    rows = [(float(i % 2), float(i % 50 - 25), float(i % 10), float(i % 2 + (i % 50 - 25) / 10 + (i % 3 - 1))) for i in range(300)]
    g = spark.createDataFrame(rows, "home double, elo_diff double, minutes_missed double, margin double")
    got = elo.margin_interval(g, elo.fit_margin(g, maxIter=5)).selectExpr(
        "avg(cast(margin between low and high as double)) as inside", "min(high - low) as width"
    ).first()
    assert 0.25 < got.inside < 0.75 and got.width > 0
    goals_ = g.withColumn("goals", F.greatest(F.round("margin"), F.lit(0.0)))
    assert elo.fit_goal_rates(goals_).transform(goals_).where("prediction <= 0").count() == 0


def test_margin_models_on_held_out_games(spark):
    r = random.Random(2)
    rows = [(i, float(i % 2), r.uniform(-200, 200), 0.0) for i in range(400)]
    rows = [(*x, x[2] / 100 + r.gauss(0, 1)) for x in rows]
    g = spark.createDataFrame(rows, "game_id long, home double, elo_diff double, minutes_missed double, margin double")
    train, rest = splits.shares(g, ["game_id"])
    assert 250 < train.count() < 370 and train.count() + rest.count() == 400
    s = elo.margin_scores(rest, elo.fit_margin(train, maxIter=5)).first()
    assert s.games == rest.count() and 0.5 < s.mse < 3 and 1 < s.nll < 3
    early, late = splits.by_day(spark.createDataFrame([(date(2021, 6, 30),), (date(2021, 7, 1),), (None,)], "d date"), "d", date(2021, 7, 1))
    assert early.count() == late.count() == 1 and splits.sample(g, ["game_id"], 5).collect() == splits.sample(g.repartition(3), ["game_id"], 5).collect()


def test_threat_that_does_not_settle(spark):
    rows = [act(i, x0=10.0, x1=90.0) for i in range(4)] + [act(10, "shot", "success", x0=90.0, x1=100.0), act(11, "pass", x0=90.0, x1=10.0)]
    with pytest.warns(UserWarning, match="after 2 rounds"):
        threat.fit(actions(spark, rows), 2, 1, most=2)


def test_action_stream_by_hand(spark):
    """Free kicks, corners, blocked shots, cards' fouls and dribbles, for both sides."""
    kind = "struct<type: struct<displayName: string>>"
    schema = f"""game_id long, event_ordinal int, period string, expanded_minute int, second int, type string, outcome_type string, team_id long, player_id long,
    x double, y double, end_x double, end_y double, goal_mouth_y double, blocked_x double, blocked_y double, qualifiers array<{kind}>"""
    q = lambda *names: [((n,),) for n in names]
    ev = lambda i, t, ok="Successful", team=1, at=(50.0, 50.0), to=(60.0, 50.0), mouth=None, blocked=(None, None), marks=(), second=None: (
        1, i, "FirstHalf", 10, 20 * i if second is None else second, t, ok, team, team * 100, *at, *to, mouth, *blocked, q(*marks))
    rows = [
        ev(0, "Pass", marks=("FreekickTaken", "Chipped"), second=0), ev(1, "Pass", at=(70.0, 50.0), second=4), ev(2, "Foul", "Unsuccessful", 2),
        ev(3, "Foul", "Successful", 1), ev(4, "Pass", marks=("CornerTaken", "Cross")),
        ev(5, "SavedShot", blocked=(95.0, 48.0), marks=("Head",)),
        ev(6, "Save", team=2), ev(7, "OffsidePass", team=2, at=(20.0, 10.0), to=(40.0, 10.0)), ev(8, "BallTouch", "Unsuccessful"), ev(9, "BallTouch"),
        ev(10, "Pass", marks=("GoalKick",)), ev(11, "Card"), ev(12, "MissedShots", mouth=30.0, marks=("DirectFreekick",)),
    ]
    home = spark.createDataFrame([(1, 1)], "game_id long, home_team_id long")
    got = stream.from_events(spark.createDataFrame(rows, schema), home).orderBy("action_id").collect()
    assert [(r.type_name, r.result_name, r.bodypart_name) for r in got] == [
        ("freekick_crossed", "success", "foot"), ("dribble", "success", "foot"), ("pass", "success", "foot"), ("foul", "fail", "foot"),
        ("corner_crossed", "success", "foot"), ("shot", "fail", "head"), ("keeper_save", "success", "other"), ("pass", "offside", "foot"),
        ("bad_touch", "fail", "foot"), ("goalkick", "success", "foot"), ("shot_freekick", "fail", "foot"),
    ]
    assert [r.action_id for r in got] == list(range(11)) and (got[1].start_x, got[1].end_x, got[1].time_seconds) == (63.0, 73.5, 602.0)
    assert (got[5].end_x, round(got[5].end_y, 6)) == (99.75, 32.64) and (round(got[10].end_x, 6), round(got[10].end_y, 6)) == (105.0, 20.4)
    assert (got[7].start_x, round(got[7].end_x, 6)) == (84.0, 63.0)  # the away side plays the other way
    kinds = [r.type_name for r in stream.atomic(spark.createDataFrame(got)).orderBy("action_id").collect()]
    assert kinds.count("offside") == 1 and kinds[:2] == ["freekick_crossed", "receival"]


def test_schedule_frame(spark):
    rows = [(1, datetime(2020, 1, 1, 12)), (2, datetime(2020, 1, 1, 12, 30)), (3, datetime(2020, 1, 1, 12, 31))]
    s = spark.createDataFrame(rows, "schedule_id long, date_time timestamp")
    assert ratings.within(s, "date_time", datetime(2020, 1, 1, 12), datetime(2020, 1, 1, 12, 30)).count() == 2
