from datetime import date

import pytest
from pyspark.sql import functions as F

from touchline.functions import dates, names, scoring, seasons


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


MULTI = {
    "1994": "9495", "2021": "2021", "9495": "9495", "1999": "9900", "94": "9495", "99": "9900", "1994-1995": "9495", "1994/1995": "9495",
    "1994-95": "9495", "94-95": "9495", "94/95": "9495", "2000": "0001", "9900": "0001", "1920": "1920"
}
SINGLE = {
    "1994": "1994", "1920": "1919", "2021": "2020", "9495": "1994", "0910": "2009", "94": "1994", "07": "2007", "1994-1995": "1994",
    "1994/1995": "1994", "1994-95": "1994", "94-95": "1994", "07/08": "2007"
}


@pytest.mark.parametrize("multi, table", [(True, MULTI), (False, SINGLE)])
def test_season_codes(spark, multi, table):
    df = spark.createDataFrame(list(table.items()), "s string, want string")
    wrong = df.withColumn("got", seasons.parse_season(F.col("s"), multi, 2024)).where("got <> want").collect()
    assert wrong == []


def test_other_seasons(spark):
    assert one(spark, seasons.parse_season(F.lit(None).cast("string"), True, 2024)) == (None,)
    for text in ("199", "1994-5", "x", "1994_95"):
        with pytest.raises(Exception, match="unknown season"):
            one(spark, seasons.parse_season(F.lit(text), True, 2024))
    assert seasons.multi_year(
        [{"season_start": "Aug", "season_end": "May"}]
    ) and not seasons.multi_year([{"season_start": "Mar", "season_end": "Nov"}])
    assert seasons.multi_year(
        [{"season_code": "single-year"}, {"season_code": "multi-year"}]
    ) and not seasons.multi_year([{"season_code": "single-year"}])
    assert len(seasons.latest_seasons(2024)) == 6


def test_dates(spark):
    d = lambda *x: F.lit(date(*x))
    assert one(
        spark, dates.season_name(d(2021, 6, 30)), dates.season_name(d(2021, 7, 1)), dates.season_code(d(2021, 6, 30)),
        dates.season_code(d(2021, 7, 1))
    ) == ("2020/2021", "2021/2022", 20, 21)
    assert one(
        spark, dates.season_codes_between(d(2021, 6, 30), d(2021, 7, 1))
    )[0] == [20, 21] == dates.season_codes(date(2021, 6, 30), date(2021, 7, 1))
    got = one(spark, *(dates.short_date(F.lit(t)) for t in ("05-03-69", "05-03-68", "05-03-99", "31-02-99", "x")))
    assert got == (date(1969, 3, 5), date(2068, 3, 5), date(1999, 3, 5), None, None)


def test_names(spark):
    assert [
        names.snake_case(x) for x in ("startTimeUtc", "homeTeamName", "matchIsOpta", "Start-Time Utc", "aTTACKid", "id")
    ] == ["start_time_utc", "home_team_name", "match_is_opta", "start__time_utc", "a_ttac_kid", "id"]
    assert one(
        spark, names.game_name(F.lit("A"), F.lit("B"), F.lit(date(2020, 9, 1))), names.game_name(F.lit("A"), F.lit("B"))
    ) == ("2020-09-01 A-B", "A-B")
    ids = lambda u: one(spark, names.url_ids(F.lit(u)))[0]
    assert tuple(ids("https://www.example.com/Regions/252/Tournaments/2/Seasons/8618/Stages/19793/Fixtures")) == (252, 2, 8618, 19793, None)
    assert tuple(ids("/Matches/5/Live")) == (None, None, None, None, 5) and ids("Regions/1/") is None


def test_aliases(spark):
    table = names.alias_table(spark, {"One": ["1", "uno"], "Two": ["2"]})
    df = spark.createDataFrame([("uno",), ("x",), (None,), ("Two",)], "n string")
    got = lambda how: sorted(map(str, (r.n for r in names.resolve(df, "n", table, how).collect())))
    assert got("keep") == ["None", "One", "Two", "x"] and got("null") == ["None", "None", "None", "One"]
    with pytest.raises(Exception, match="no name for"):
        got("raise")
    assert [r.n for r in names.unknown_names(df, "n", table).collect()] == ["x"]


def test_formulas(spark):
    lit = F.lit
    p = one(
        spark, scoring.elo_expectation(lit(1500), lit(1500)), scoring.elo_k(lit(45), lit(None).cast("int")), scoring.elo_k(lit(120), lit(500)),
        scoring.odds_probability(lit(4.0)), scoring.odds_probability(lit(0.0)), scoring.opposition(lit(3), lit(1), lit(2))
    )
    assert p == (0.5, 10.0, 10.0, 0.25, None, 3)
    up = lambda m: one(spark, scoring.elo_update(lit(1500.0), lit(1500.0), lit(1500.0), lit(m), lit(-1), lit(1), lit(90), lit(0)))[0]
    assert (up(0), up(1), up(2), up(-2)) == (1500.0, 1500.0, 1510.0, 1490.0)
    assert one(spark, scoring.pm_predict(lit(100.0), lit(100.0), lit(40.0), lit(45)), scoring.pm_update(lit(5.0), lit(2), lit(1.0))) == (30.0, 5.1)
    w, d, l = one(spark, scoring.outcome_probabilities(lit(1.5), lit(1.5)))[0]
    assert abs(w - l) < 1e-12 and abs(w + d + l - 1) < 1e-12 and 0.2 < d < 0.3
    assert one(spark, scoring.brier([lit(0.5), lit(0.25), lit(0.25)], [lit(1), lit(0), lit(0)])) == (0.375,)
    q = F.from_json(F.lit('[{"type":{"displayName":"OwnGoal"}}]'), "array<struct<type: struct<value: int, displayName: string>, value: string>>")
    assert one(spark, scoring.own_goal(q), scoring.own_goal(F.slice(q, 1, 0)), scoring.own_goal(F.nullif(q, q))) == (True, False, False)
