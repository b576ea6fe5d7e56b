import time

import pytest

from touchline.operators import goals

OWN = [{"type": {"value": 28, "displayName": "OwnGoal"}, "value": None}]
PITCH = "game_id long, player_id long, team_id long, minute_on int, minute_off int"


def count(spark, players, scored):
    p = spark.createDataFrame([(1, *x) for x in players], PITCH)
    g = spark.createDataFrame([(1, *x) for x in scored], "game_id long, expanded_minute int, goal_team_id long")
    return {r.player_id: (r.goals_for, r.goals_against) for r in goals.on_pitch_goals(p, g).collect()}


@pytest.mark.parametrize(
    "players, scored, want",
    [
        ([(1, 10, 0, 90), (2, 20, 0, 90)], [(30, 10), (50, 20)], {1: (1, 1), 2: (1, 1)}),
        ([(1, 10, 0, 90)], [(10, 10), (20, 10), (30, 10)], {1: (3, 0)}),
        ([(1, 10, 0, 90)], [(15, 20), (75, 20)], {1: (0, 2)}),
        ([(1, 10, 0, 90), (2, 10, 60, 90)], [(45, 10), (70, 10), (85, 10)], {1: (3, 0), 2: (2, 0)}),
        ([(1, 10, 30, 90)], [(30, 10), (31, 10)], {1: (1, 0)}),
        ([(1, 10, 0, 80)], [(79, 10), (80, 10), (81, 10)], {1: (1, 0)}),
        ([(1, 10, 0, 90)], [], {1: (0, 0)}),
        ([(1, 10, 0, 90), (2, 10, 0, 90), (3, 20, 0, 90)], [(25, 10)], {1: (1, 0), 2: (1, 0), 3: (0, 1)}),
        ([(1, 10, 0, 0)], [(25, 10)], {1: (0, 0)}),
        ([(1, 10, 60, 30)], [(45, 10)], {1: (0, 0)}),
    ],
)
def test_cases(spark, players, scored, want):
    assert count(spark, players, scored) == want


def test_goals_of_events(spark):
    kind = "game_id long, event_ordinal int, expanded_minute int, team_id long, is_goal boolean, qualifiers array<struct<type: struct<value: int, displayName: string>, value: string>>"
    rows = [
        (1, 0, 5, 10, True, None), (1, 1, 7, 10, True, OWN), (1, 2, 9, 10, True, []), (1, 3, 9, 20, True, OWN), (1, 4, 11, 10, True, []),
        (1, 5, 11, 20, True, []), (1, 6, 12, 20, None, []), (1, 7, 13, 10, False, [])
    ]
    teams = spark.createDataFrame([(1, 10), (1, 20)], "game_id long, team_id long")
    events = spark.createDataFrame(rows, kind)
    last = {(r.expanded_minute, r.goal_team_id) for r in goals.goals(events, teams).collect()}
    assert last == {(5, 10), (7, 20), (9, 10), (11, 20)}
    assert len(goals.goals(events, teams, every=True).collect()) == 6


def test_metric_is_the_difference(spark):
    rows = spark.createDataFrame([(42, 1, 2, 1), (42, 2, 0, 3)], "game_id long, player_id long, goals_for long, goals_against long")
    assert sorted(map(tuple, goals.goals_metric(rows).collect())) == [(1, 42, "goals", 1.0), (2, 42, "goals", -3.0)]
    assert goals.goals_metric(rows.limit(0)).collect() == []


def test_many_goals_and_players_of_a_game(spark):
    """Goals of a minute and team are counted before players meet them: a list of them all took hours."""
    p = spark.range(20_000).selectExpr("1L as game_id", "id as player_id", "id % 2 + 1 as team_id", "cast(id % 10 as int) as minute_on", "90 as minute_off")
    g = spark.range(200_000).selectExpr("1L as game_id", "cast(id % 95 as int) as expanded_minute", "if(id % 7 = 0, null, id % 2 + 1) as goal_team_id")
    start = time.monotonic()
    got = {(r.team_id, r.minute_on): (r.goals_for, r.goals_against) for r in goals.on_pitch_goals(p, g).distinct().collect()}
    assert time.monotonic() - start < 30
    of = [(i % 95, i % 2 + 1) for i in range(200_000) if i % 7]
    for (team, on), (mine, other) in got.items():
        inside = [t for m, t in of if on < m < 90]
        assert (mine, other) == (inside.count(team), len(inside) - inside.count(team))
