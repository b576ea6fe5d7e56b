import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from touchline.operators import minutes

EVENT = "game_id long, event_ordinal int, type string, period string, expanded_minute int, player_id long, team_id long, card_type string"
END = ("End", "SecondHalf", 90)


def run(spark, starters, events, strict=True):
    lineup = spark.createDataFrame([(1, p, t, s) for p, t, s in starters], "game_id long, player_id long, team_id long, is_starter boolean")
    rows = [(1, i, *(list(e) + [None] * (6 - len(e)))) for i, e in enumerate(events)]
    got = minutes.intervals(lineup, spark.createDataFrame(rows, EVENT), strict).collect()
    return {r.player_id: (r.minute_on, r.minute_off) for r in got}, {r.end_of_game for r in got}


TWO = [(1, 10, True), (2, 20, True)]


def on(m, p, t=10):
    return ("SubstitutionOn", "SecondHalf", m, p, t)


def off(m, p, t=10):
    return ("SubstitutionOff", "SecondHalf", m, p, t)


def card(m, kind="Red"):
    return ("Card", "SecondHalf", m, 99, 10, kind)


@pytest.mark.parametrize(
    "starters, events, want",
    [
        (TWO, [END], {1: (0, 90), 2: (0, 90)}),
        (TWO, [off(60, 1), on(60, 11), END], {1: (0, 60), 11: (60, 90), 2: (0, 90)}),
        (TWO, [off(45, 1), on(45, 11), off(70, 2, 20), on(70, 12, 20), END], {1: (0, 45), 11: (45, 90), 2: (0, 70), 12: (70, 90)}),
        ([(0, 10, True), *TWO], [END], {1: (0, 90), 2: (0, 90)}),
        ([(None, 10, True), *TWO], [END], {1: (0, 90), 2: (0, 90)}),
        (TWO, [card(75), END], {1: (0, 75), 2: (0, 75)}),
        (TWO, [card(75, "SecondYellow"), END], {1: (0, 75), 2: (0, 75)}),
        (TWO, [card(75, "Yellow"), END], {1: (0, 90), 2: (0, 90)}),
        (TWO, [card(80), card(70), END], {1: (0, 70), 2: (0, 70)}),
        (TWO, [card(70), on(80, 11), off(80, 1), END], {1: (0, 70), 2: (0, 70)}),
        (TWO, [card(70), on(70, 11), END], {1: (0, 70), 2: (0, 70), 11: (70, 70)}),
        (TWO, [off(30, 1), on(60, 1), END], {1: (60, 30), 2: (0, 90)}),
        (TWO, [("End", "FirstHalf", 45), END], {1: (0, 90), 2: (0, 90)}),
        (TWO, [("End", "SecondHalf", 93), END], {1: (0, 93), 2: (0, 93)}),
        (TWO, [END, ("End", "SecondPeriodOfExtraTime", 120)], {1: (0, 90), 2: (0, 90)}),
        ([*TWO, (3, 10, False)], [END], {1: (0, 90), 2: (0, 90)}),
        (TWO, [on(90, 11), END], {1: (0, 90), 2: (0, 90), 11: (90, 90)}),
    ],
)
def test_cases(spark, starters, events, want):
    assert run(spark, starters, events)[0] == want


def test_without_full_time(spark):
    with pytest.raises(Exception, match="no full-time event"):
        run(spark, TWO, [("End", "FirstHalf", 45)])
    assert run(spark, TWO, [("End", "FirstHalf", 45)], strict=False)[0] == {}


def test_metric_rows(spark):
    rows = spark.createDataFrame(
        [(42, 1, 10, 0, 90, 90), (42, 2, 10, 60, 85, 90)],
        "game_id long, player_id long, team_id long, minute_on int, minute_off int, end_of_game int"
    )
    assert sorted(map(tuple, minutes.minutes_metric(rows).collect())) == [(1, 42, "minutes", 90.0), (2, 42, "minutes", 25.0)]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["on", "off", "card", "pass"]), st.integers(0, 95), st.integers(1, 5)), max_size=8))
def test_bounds(spark, moves):
    events = [
        {"on": on, "off": off, "pass": lambda m, p: ("Pass", "SecondHalf", m, p, 10), "card": lambda m, p: card(m)}[k](m, p) for k, m, p in moves
    ] + [END]
    got, ends = run(spark, TWO, events)
    end = min([90, *(m for k, m, _ in moves if k == "card")])
    assert ends <= {end} and all(o <= end and f <= end for o, f in got.values())
