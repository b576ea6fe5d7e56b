import json

import pytest
from pyspark.sql import functions as F

from touchline.functions.names import alias_table
from touchline.sources import html, matches, rest, rosters, schedule


def label(name):
    return {"value": 1, "displayName": name}


def match_doc(home=10, away=20):
    ev = lambda minute, kind, team=home, player=1, **x: {
        "minute": minute, "expandedMinute": minute, "type": label(kind), "period": label("SecondHalf"), "teamId": team, "playerId": player, **x
    }
    return {
        "playerIdNameDictionary": {"1": "Ann", "2": "Bo"},
        "home": {
            "teamId": home, "name": "Home",
            "players": [{"playerId": 1, "name": "Ann", "shirtNo": 9, "isFirstEleven": True}, {"playerId": 3, "name": "Cy", "shirtNo": 7}]
        },
        "away": {"teamId": away, "name": "Away", "players": [{"playerId": 2, "name": "Bo", "shirtNo": 1, "isFirstEleven": True}]},
        "events": [
            ev(10, "Pass", outcomeType=label("Successful"), x=50.0, y=50.0, endX=80.0, endY=50.0, second=30.0, isTouch=True),
            ev(30, "Goal", isGoal=True, isShot=True, x=90.0, y=50.0, qualifiers=[{"type": label("Penalty")}]),
            ev(40, "Goal", away, 2, isGoal=True, qualifiers=[{"type": label("OwnGoal")}]),
            ev(60, "SubstitutionOff"), ev(60, "SubstitutionOn", player=3),
            ev(90, "End", player=None),
        ],
    }


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("landing")
    (d / "events" / "L_2021").mkdir(parents=True)
    (d / "events" / "L_2021" / "100.json").write_text(json.dumps(match_doc()))
    (d / "events" / "L_2021" / "101.json").write_text(json.dumps(match_doc(20, 10)))
    return d


def test_events(spark, folder):
    docs = matches.read(spark, str(folder / "events"))
    rows = {(r.game_id, r.event_ordinal): r for r in matches.events(docs).collect()}
    assert len(rows) == 12 and rows[100, 0].player == "Ann" and rows[100, 0].team == "Home" and rows[100, 4].player == "3"
    first = rows[100, 0]
    assert (
        first.type, first.outcome_type, first.second, first.end_x, first.is_touch, first.is_goal, first.qualifiers, first.card_type
    ) == ("Pass", "Successful", 30, 80.0, True, False, [], None)
    assert rows[100, 1].second == -1 and rows[100, 5].player is None
    assert {(r.game_id, r.player_id, r.is_starter) for r in matches.lineups(docs).collect()} >= {(100, 1, True), (100, 3, False), (101, 2, True)}
    assert {(r.game_id, r.home_team_id) for r in matches.home_teams(docs).collect()} == {(100, 10), (101, 20)}
    assert len(matches.raw(docs).first().events) == 6


def test_games_by_id(spark, folder):
    ids = spark.createDataFrame([(100,), (999,)], "game_id long")
    assert [r.game_id for r in matches.read(spark, str(folder / "events"), ids, "skip").collect()] == [100]
    with pytest.raises(Exception, match="no document of game 999"):
        matches.read(spark, str(folder / "events"), ids).collect()


PAGE = """<html><div id="main"><table><tr><th>No</th><th>Name</th><th>Pos</th></tr>
<tr><td>11</td><td>x <i>Ital Name</i></td><td>MF</td></tr><tr><td>11</td><td>Second</td><td>MF</td></tr><tr><td>7</td><td>Plain</td><td>GK<br></td></tr><tr><td>x</td><td>No</td></tr><tr><td>8</td><td></td></tr></table></div>
<table><tr><td>5</td><td>Outside</td></tr></table><a href="/a/keep">Keep</a><a href="/a/drop.htm">Drop</a>"""


def test_tables_and_links(spark):
    pages = spark.createDataFrame([("p", PAGE)], "path string, content string")
    got = {r.kit_number: r.cells for r in rosters.numbers(pages).collect()}
    assert got == {"11": ["Ital Name", "MF"], "7": ["Plain", "GK"]}
    assert [(r.url, r.text) for r in html.links(pages, ["drop"]).collect()] == [("/a/keep", "Keep")]
    assert len(html.links(pages, []).collect()) == 2
    big = "<div id=main><table>" + "".join(f"<tr><td>{i}<td>N{i}</tr>" for i in range(1, 35)) + "</table></div>"
    assert rosters.numbers(spark.createDataFrame([("b", big)], "path string, content string")).count() == 34
    with pytest.raises(Exception, match="no roster in"):
        rosters.numbers(spark.createDataFrame([("c", "<div id=other></div>")], "path string, content string")).collect()
    null = spark.createDataFrame([("n", None)], "path string, content string")
    assert html.parts(null).collect() == [] == html.links(null).collect()


def test_row_validation(spark):
    rows = spark.createDataFrame(
        [(["1", "a"], True), (["1"], False), (["x", "a"], False), (["1", ""], False), ([], False), (None, False)], "c array<string>, ok boolean"
    )
    assert rows.where(F.coalesce(rosters.is_player_row(F.col("c")), F.lit(False)) != F.col("ok")).count() == 0


def test_file_names(spark):
    got = spark.range(1).select(rosters.name_parts(F.lit("1987-1988_nor_land_west_otters.html")).alias("n")).first().n
    assert tuple(got) == ("1987/1988", "nor_land_west", "otters")


def test_rosters(spark, tmp_path):
    cells = "".join(f"<td>c{i}</td>" for i in range(8))
    page = f'<div id="main"><table><tr><td>4</td>{cells}</tr><tr><td>5</td><td>short</td></tr></table></div>'
    for name in ("2020-2021_eng_one.html", "2020-2021_eng_two.html", "2020-2021_xx_one.html"):
        (tmp_path / name).write_text(page)
    done = spark.createDataFrame([("2020-2021_eng_two.html",)], "file string")
    rows, files = rosters.rosters(
        spark, str(tmp_path), done, alias_table(spark, {"One FC": ["one"], "Two FC": ["two"]}), alias_table(spark, {"England": ["eng"]})
    )
    got = rows.collect()
    assert [
        (r.kit_number, r["name"], r.previous_club, r.team, r.league, r.season) for r in got
    ] == [(4, "c0", "c7", "One FC", "England", "2020/2021")]
    assert rows.columns == list(rosters.COLUMNS) and [r.file for r in files.collect()] == ["2020-2021_eng_one.html"]


@pytest.fixture(scope="module")
def site(tmp_path_factory):
    d = tmp_path_factory.mktemp("site")
    for sub in ("seasons", "matches", "previews/ENG-Premier League_2021"):
        (d / sub).mkdir(parents=True)
    (d / "tiers.json").write_text(
        json.dumps([{"id": 252, "name": "England", "tournaments": [{"id": 2, "name": "Premier League"}, {"id": 3, "name": "Cup"}]}])
    )
    lg = "ENG-Premier League"
    (d / f"seasons/{lg}.html").write_text(
        '<select id="seasons"><option value="/Regions/252/Tournaments/2/Seasons/8618/x">2020/2021</option><option value="/Regions/252/Tournaments/2/Seasons/7/x">2019/2020</option></select>'
    )
    (d / f"seasons/{lg}_2021.html").write_text(
        '<a href="/Regions/252/Tournaments/2/Seasons/8618/Stages/55/Fixtures">Fixtures</a><select id="stages"><option value="/Regions/252/Tournaments/2/Seasons/8618/Stages/55/x">Main</option><option value="/Regions/252/Tournaments/2/Seasons/8618/Stages/56/x">Final</option></select>'
    )
    for stage in (55, 56):
        (d / f"matches/{lg}_2021_{stage}.html").write_text(json.dumps({"mask": {"2020": {"8": {"12": 1}}, "2021": {"0": {"2": 1}}}}))
        for month in (8, 0):
            game = {"id": 100 + month, "homeTeamName": "Man Utd", "awayTeamName": "B", "startTimeUtc": "2020-09-12T14:00:00Z", "homeScore": 1}
            (d / f"matches/{lg}_2021_{stage}_{month}.json").write_text(json.dumps({"tournaments": [{"tournamentId": 2, "matches": [game, game]}]}))
    row = lambda who, i: f'<tr><td class="pn"><a href="/Players/{i}/Show/{who}">{who}</a></td><td class="reason"><span title="injured"></span></td><td class="confirmed">Out</td></tr>'
    (d / f"previews/{lg}_2021/108.html").write_text(
        f'<div id="missing-players"><div>t</div><div><table><tbody>{row("Ann", 5)}</tbody></table></div><div><table><tbody>{row("Bo", 6)}</tbody></table></div></div>'
    )
    return d


def test_schedule(spark, site):
    root = str(site)
    wanted = schedule.registry(spark, {"ENG-Premier League": {"source_name": "England - Premier League"}, "X": {"other": 1}})
    lg = schedule.leagues(spark, root, wanted)
    assert [tuple(r) for r in lg.collect()] == [("ENG-Premier League", 252, "England", 2)]
    with pytest.raises(ValueError):
        schedule.registry(spark, {}, None, ["nope"])
    with pytest.raises(Exception, match="no such league"):
        schedule.leagues(spark, root, schedule.registry(spark, {"Y": {"source_name": "Y - Y"}})).collect()
    se = schedule.seasons(spark, root, lg, spark.createDataFrame([("2021",)], "season string"), True, 2024)
    assert [(r.season, r.season_id) for r in se.collect()] == [("2021", 8618)]
    st = schedule.stages(spark, root, se)
    assert sorted((r.stage_id, r.stage) for r in st.collect()) == [(55, "Main"), (56, "Final")]
    games = schedule.fixtures(spark, root, st, alias_table(spark, {"Manchester United": ["Man Utd"]}))
    got = sorted((r.game_id, r.game, r.home_team, r.stage, r.home_score) for r in games.collect())
    assert got == [
        (100, "2020-09-12 Manchester United-B", "Manchester United", "Main", 1),
        (108, "2020-09-12 Manchester United-B", "Manchester United", "Main", 1)
    ]
    out = sorted((r.team, r.player, r.player_id, r.reason, r.status) for r in schedule.absent_players(spark, root, games).collect())
    assert out == [("B", "Bo", 6, "injured", "Out"), ("Manchester United", "Ann", 5, "injured", "Out")]


def test_rest(spark, tmp_path):
    (tmp_path / "s.json").write_text(
        json.dumps(
            {"response": [{"fixture": {"id": 1, "date": "2024-08-16T19:00:00+00:00"}, "teams": {"home": {"name": "A"}, "away": {"name": "B"}}}]}
        )
    )
    assert [
        (r.schedule_id, r.home, r.away, r.date_time.hour) for r in rest.schedule(spark, str(tmp_path / "s.json")).collect()
    ] == [(1, "A", "B", 19)]
    (tmp_path / "77.json").write_text(
        json.dumps({"response": [{"team": {"name": "A"}, "startXI": [{"player": {"id": 5, "name": "Ann", "number": 9}}]}]})
    )
    assert [tuple(r) for r in rest.lineups(spark, str(tmp_path / "77.json")).collect()] == [(77, "A", 5, "Ann", 9)]
    (tmp_path / "o.json").write_text(
        json.dumps(
            {
                "response": [
                    {
                        "fixture": {"id": 1},
                        "bookmakers": [{"name": "b", "bets": [{"name": "Match Winner", "values": [{"value": "Home", "odd": "1.50"}]}]}]
                    }
                ]
            }
        )
    )
    assert [tuple(r) for r in rest.odds(spark, str(tmp_path / "o.json")).collect()] == [(1, "b", "Home", 1.5)]
    assert rest.address("https://api.example.com/", "fixtures", league=39, season=2024) == "https://api.example.com/fixtures?league=39&season=2024"
    clubs = spark.createDataFrame(
        [(1, "A", "L", 1800.0), (2, "B", "L", 1750.0), (3, "A", "M", 1.0)], "rank int, team string, league string, elo double"
    )
    assert rest.club_elo(clubs, "A").first().elo == 1800.0
    assert {r.league: r.elo for r in rest.league_elo(clubs).collect()} == {"L": 1775.0, "M": 1.0}
    with pytest.raises(Exception, match="no rating of Z"):
        rest.club_elo(clubs, "Z").collect()


def test_wanted_seasons(spark):
    codes = lambda *a: sorted(r.season for r in schedule.wanted_seasons(spark, *a).collect())
    assert codes("2020-21", True, 2024) == ["2021"] and codes([1999, "99-00"], True, 2024) == ["9900"] and codes(2020, False, 2024) == ["2020"]
    assert codes(None, True, 2024) == ["1920", "2021", "2122", "2223", "2324", "2425"]


def test_links_by_functions(spark):
    page = """<A class=x HREF='/a?b=1&amp;c=2'>One &lt;b&gt;</A><a name="n">none</a><!-- <a href="/no">x</a> --><script>"<a href='/js'>y</a>"</script>
    <a href=/bare>Two <i>parts</i></a><a\nhref="/n">\n N \n</a>"""
    got = html.links(spark.createDataFrame([("p", page), ("q", None), ("r", "")], "path string, content string"))
    assert [(r.key, r.url, r.text) for r in got.orderBy("ordinal").collect()] == [
        ("p", "/a?b=1&c=2", "One <b>"), ("p", "/bare", "Two parts"), ("p", "/n", "N")
    ]


def test_documents_in_parts(spark, tmp_path):
    """A day of very many events makes no row that grows with them, and its parts read as one document."""
    from touchline import adapters
    from touchline.sources import matches

    n = 5000
    rows = spark.range(n).selectExpr(
        "id as event_id", "timestamp'2024-01-01 10:00:00' as ts", "id % 900 as user_id", "if(id % 3 = 0, 'purchase', 'view') as event_type", "1D as value",
        """concat('{"k": ', id % 100, '}') as props"""
    )
    rows.write.parquet(f"{tmp_path}/events.parquet")
    docs = adapters.documents(spark, str(tmp_path)).persist()
    most = docs.selectExpr("max(size(events)) as e", "max(size(playerIdNameDictionary)) as p", "max(size(home.players) + size(away.players)) as l").first()
    assert most.e <= adapters.PART + 1 and most.p <= adapters.PART and most.l <= adapters.PART
    got = matches.events(docs, feed_id=True).orderBy("event_ordinal").collect()
    assert [r.event_ordinal for r in got] == list(range(n + 1)) and [r.feed_id for r in got] == [*range(n), None] and got[-1].type == "End"
    assert all(r.player == (f"P{r.player_id}" if r.player_id % 4 < 2 else str(r.player_id)) for r in got[:-1])
    assert sorted(r.player_id for r in matches.lineups(docs).collect()) == list(range(900))
    assert matches.teams(docs).count() == 2 and matches.home_teams(docs).count() == 1
    docs.unpersist()
