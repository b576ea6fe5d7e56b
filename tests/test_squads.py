"""Squads after whole batches of changes, against one change after another."""

import random
from datetime import date, timedelta

import pytest

from touchline.operators import squads as S

ROW = "player_id long, kit_number int, team_id long, valid_from date, valid_to date"
LOG = "kind string, player_id long, kit_number int, team_id long, day date, seq long"


def one_after_another(rows, log):
    """The table as a list of rows that each event updates."""
    table = [list(r) for r in rows]
    for kind, player, number, team, day, _ in sorted((e for e in log if e[4] is not None), key=order):
        for r in table:
            if r[1:3] == [number, team] and None not in (number, team) and r[3] <= day <= r[4]:
                r[4] = day
        if kind == S.CHANGE:
            for r in table:
                if r[0] == player and player is not None and r[4] == S.FOREVER:
                    r[4] = day
        if kind != S.TAKE:
            table.append([player, number, team, S.ALWAYS if kind == S.ENTER else day, S.FOREVER])
    return sorted((tuple(r) for r in table), key=str)


def order(e):
    low = lambda x: (x is not None, x or 0)
    return e[4], low(e[5]), low(e[1]), low(e[3]), low(e[2]), e[0]


def day(n):
    return date(2020, 1, 1) + timedelta(n)


@pytest.mark.parametrize("seed", range(4))
def test_replay(spark, seed):
    r = random.Random(seed)
    # few players and numbers: many changes a player, numbers handed on and back, rows of later than some events, days that tie
    rows = [(r.randrange(8), r.randrange(5), r.randrange(2), a, r.choice([S.FOREVER, a + timedelta(r.randrange(30))])) for a in (day(r.randrange(60)) for _ in range(25))]
    log = [
        (r.choice([S.ENTER, S.CHANGE, S.CHANGE, S.TAKE]), r.choice([None, *range(12)]), r.choice([None, *range(5)]), r.randrange(2), r.choice([None, *map(day, range(50))]), i)
        for i in range(150)
    ]
    got = S.replay(spark.createDataFrame(rows, ROW), spark.createDataFrame(log, LOG).repartition(5))
    assert sorted(map(tuple, got.collect()), key=str) == one_after_another(rows, log)


@pytest.mark.parametrize("seed", range(3))
def test_sync_follows_each_sighting(spark, seed):
    r = random.Random(seed)
    rows = [(i, i, 1, S.ALWAYS, S.FOREVER) for i in range(4)] + [(9, 3, 1, S.ALWAYS, day(-5))]
    seen = [(r.randrange(9), r.randrange(6), 1, day(r.randrange(25)), i) for i in range(120)]
    seen += [(7, 20, 2, day(40), 1)] * 3
    table = [list(x) for x in rows]
    for player, number, team, on, _ in sorted(seen, key=lambda x: (x[3], x[4])):
        if any(x[:3] == [player, number, team] and x[4] == S.FOREVER for x in table):
            continue
        kind = S.CHANGE if any(x[0] == player for x in table) else S.ENTER
        table = [list(x) for x in one_after_another(table, [(kind, player, number, team, on, 0)])]
    got = S.sync(spark.createDataFrame(rows, ROW), spark.createDataFrame(seen, "player_id long, kit_number int, team_id long, day date, seq long"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, table), key=str)


def test_batch_of_one_player_and_a_number_handed_on(spark):
    start = spark.createDataFrame([(1, 9, 5, S.ALWAYS, S.FOREVER)], ROW)
    log = [(1, 10, 5, date(2021, 1, 1)), (1, 11, 5, date(2022, 1, 1)), (2, 10, 5, date(2021, 6, 1)), (3, 11, 5, date(2023, 1, 1))]
    got = S.change(start, spark.createDataFrame(log, "player_id long, kit_number int, team_id long, day date"))
    assert sorted(map(tuple, got.collect()), key=str) == [
        (1, 10, 5, date(2021, 1, 1), date(2021, 6, 1)), (1, 11, 5, date(2022, 1, 1), date(2023, 1, 1)), (1, 9, 5, S.ALWAYS, date(2021, 1, 1)),
        (2, 10, 5, date(2021, 6, 1), S.FOREVER), (3, 11, 5, date(2023, 1, 1), S.FOREVER)
    ]


def test_empty_tables(spark):
    none, no_log = spark.createDataFrame([], ROW), spark.createDataFrame([], LOG)
    assert S.replay(none, no_log).count() == 0 and S.replay(none, no_log).columns == ["player_id", "kit_number", "team_id", "valid_from", "valid_to"]
    assert S.sync(none, no_log.drop("kind")).count() == 0
