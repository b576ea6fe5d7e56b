import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from test_sources import match_doc

from touchline.functions.names import alias_table
from touchline.operators import elo, squads, threat
from touchline.plans import catalog, fetch, imports, lineups, models, predict, prepare, score
from touchline.plans.catalog import Catalog
from touchline.schemas import TABLES
from touchline.sources import matches
from touchline.streaming import incremental


@pytest.fixture
def landing(tmp_path):
    d = tmp_path / "events" / "L_2021"
    d.mkdir(parents=True)
    (d / "100.json").write_text(json.dumps(match_doc()))
    return d


def metrics(catalog):
    return {(r.game_id, r.player_id, r.metric): r.value for r in catalog.table(score.METRICS).collect()}


def test_tables(spark, tmp_path):
    c = Catalog(spark, str(tmp_path / "db"))
    c.create()
    for name, (columns, keys) in TABLES.items():
        t = c.table(name)
        assert t.count() == 0 and set(keys) <= set(t.columns) and len(t.columns) == columns.count(",") + 1
    row = lambda *x: spark.createDataFrame([x], TABLES[score.METRICS][0])
    c.upsert(score.METRICS, row(1, 2, "goals", 1.0))
    c.upsert(score.METRICS, row(1, 2, "goals", 3.0).unionByName(row(1, 9, "goals", 2.0)))
    c.upsert(score.METRICS, row(1, 2, "goals", 3.0))
    assert metrics(c) == {(2, 1, "goals"): 3.0, (9, 1, "goals"): 2.0}
    twice = spark.createDataFrame([(5, "a", 1), (5, "b", 2)], "id long, name string, at int")
    c.upsert("basis.teams", twice, "at")
    c.append_new("basis.teams", spark.createDataFrame([(5, "z"), (6, "c")], "id long, name string"))
    assert sorted(map(tuple, c.table("basis.teams").collect())) == [(5, "b"), (6, "c")]
    c.update("basis.teams", spark.createDataFrame([(6, "d"), (5, None)], "id long, name string"), ["name"])
    c.register()
    assert [r.name for r in spark.sql("select name from basis_teams order by id").collect()] == ["b", "d"]
    c.clear()
    assert c.table("basis.teams").count() == 0 and metrics(c) == {}


def test_a_crash_leaves_the_table(spark, tmp_path, monkeypatch):
    """Whatever step of a write fails, the table is as it was, and the next write works."""
    c = Catalog(spark, str(tmp_path / "db"))
    rows = lambda n, v: spark.range(n).selectExpr("id as player_id", "id % 10 as game_id", "'goals' as metric", f"double({v}) as value")
    c.upsert(score.METRICS, rows(50, 1))
    before = metrics(c)
    for step in ("_commit", "_write", "_read"):
        with monkeypatch.context() as m:
            real, calls = getattr(Catalog, step), []

            def fail(self, *a, real=real, calls=calls, last={"_commit": 0, "_write": 1, "_read": 2}[step], **k):
                calls.append(a)
                if len(calls) > last:
                    raise RuntimeError("crash")
                return real(self, *a, **k)

            m.setattr(Catalog, step, fail)
            with pytest.raises(RuntimeError, match="crash"):
                c.upsert(score.METRICS, rows(80, 2))
        assert metrics(c) == before
    c.upsert(score.METRICS, rows(80, 3))
    assert set(metrics(c).values()) == {3.0} and c.table(score.METRICS).count() == 80


def test_parts_grow_and_untouched_ones_stay(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "PART_ROWS", 20)
    c = Catalog(spark, str(tmp_path / "db"))
    rows = lambda a, b: spark.range(a, b).selectExpr("id as player_id", "id as game_id", "'goals' as metric", "double(id) as value")
    c.upsert(score.METRICS, rows(0, 100))
    state = c._state(score.METRICS)
    assert state["parts"] == 4 and state["rows"] == 100
    c.upsert(score.METRICS, rows(100, 130))  # new games only: nothing is written anew
    after = c._state(score.METRICS)
    assert after["rows"] == 130 and set(state["folders"]) < set(after["folders"]) and len(after["folders"]) == 2
    c.upsert(score.METRICS, spark.createDataFrame([(5, 5, "goals", -1.0)], TABLES[score.METRICS][0]))
    last = c._state(score.METRICS)
    assert last["rows"] == 130 and c.table(score.METRICS).count() == 130 and metrics(c)[5, 5, "goals"] == -1.0
    assert sum(len(v) for v in last["folders"].values()) <= sum(len(v) for v in after["folders"].values())
    monkeypatch.setattr(catalog, "MOST_FOLDERS", 3)
    for i in range(4):
        c.upsert(score.METRICS, rows(200 + i, 201 + i))
        c.append_new("basis.teams", spark.createDataFrame([(i, "t")], "id long, name string"))
    assert c.table(score.METRICS).count() == 134 and c.table("basis.teams").count() == 4
    assert len(c._state("basis.teams")["folders"]) <= 3
    data = {p.name for p in (tmp_path / "db" / "metrics" / "player_game_metric" / "data").iterdir()}
    versions = c._versions(score.METRICS)
    assert len(versions) == 2 and data == {f for n in versions for f in c._version(score.METRICS, n)["folders"]}


def test_roster_import_as_batch_and_stream(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    cells = lambda x: "".join(f"<td>{x}{i}</td>" for i in range(8))
    page = lambda x: f'<div id="main"><table><tr><td>4</td>{cells(x)}</tr><tr><td>5</td><td>short</td></tr></table></div>'
    (land / "2001-2002_nor_otters.html").write_text(page("a"))
    teams, leagues = alias_table(spark, {"Otters": ["otters"], "Herons": ["herons"]}), alias_table(spark, {"North": ["nor"]})
    batch, stream = Catalog(spark, str(tmp_path / "a")), Catalog(spark, str(tmp_path / "b"))
    for _ in range(2):
        imports.folder(batch, str(land), teams, leagues)
        incremental.import_new_rosters(stream, str(land), str(tmp_path / "checkpoint"), teams, leagues).awaitTermination()
    (land / "2001-2002_nor_herons.html").write_text(page("b"))
    imports.folder(batch, str(land), teams, leagues)
    incremental.import_new_rosters(stream, str(land), str(tmp_path / "checkpoint"), teams, leagues).awaitTermination()
    for c in (batch, stream):
        assert sorted(
            (r.kit_number, r.name, r.team, r.season) for r in c.table(imports.ROWS).collect()
        ) == [(4, "a0", "Otters", "2001/2002"), (4, "b0", "Herons", "2001/2002")]
        assert sorted(r.file for r in c.table(imports.LOG).collect()) == ["2001-2002_nor_herons.html", "2001-2002_nor_otters.html"]


def test_predictions(spark, tmp_path):
    c = Catalog(spark, str(tmp_path / "db"))
    schedule = spark.createDataFrame([(1, 10, 20), (2, 20, 30)], "game_id long, home_team long, away_team long")
    ratings = spark.createDataFrame([(10, 1600.0), (10, 1500.0), (20, 1400.0)], "team_id long, elo double")
    games = predict.sides(schedule, ratings)
    seen = spark.createDataFrame([(120.0, float(m)) for m in range(5)], "elo_diff double, margin double")
    predict.store(c, predict.by_quartiles(games, seen))
    got = {r.game_id: tuple(r)[1:] for r in c.table(predict.TABLE).collect()}
    assert got == {1: (1550.0, 1400.0, 1.0, 3.0, None), 2: (1400.0, None, None, None, None)}
    predict.settle(c, spark.createDataFrame([(1, "2-0")], "game_id long, result string"))
    predict.store(c, predict.by_quartiles(games.where("game_id = 1"), seen))
    assert {r.game_id: r.result for r in c.table(predict.TABLE).collect()} == {1: "2-0", 2: None}


def test_models_are_saved_and_loaded(spark, tmp_path):
    rows = [(float(i % 2), float(i % 50 - 25), float(i % 10), float(i % 2 + (i % 50 - 25) / 10)) for i in range(100)]
    games = spark.createDataFrame(rows, "home double, elo_diff double, minutes_missed double, margin double")
    fitted = elo.fit_margin(games, maxIter=1)
    folder = str(tmp_path / "models")
    assert models.newest(spark, folder, "xt") is None
    a = models.save(spark, folder, "xt", {"grid": threat.grid(spark, [0.5])}, {"n": 1})
    b = models.save(spark, folder, "xt", {"grid": threat.grid(spark, [0.7])}, {"n": 2})
    m = models.save(spark, folder, "margin", {"mean": fitted[0], "error": fitted[1]}, {"games": 100})
    assert models.newest(spark, folder, "xt").endswith(b.rsplit("/", 1)[-1]) and a < b
    parts, made = models.load(spark, models.newest(spark, folder, "xt"))
    assert [r.threat for r in parts["grid"].collect()] == [0.7] and made["n"] == 2
    parts, _ = models.load(spark, m)
    same = elo.margin_interval(games, (parts["mean"], parts["error"])).selectExpr("sum(low) as s").first().s
    assert same == pytest.approx(elo.margin_interval(games, fitted).selectExpr("sum(low) as s").first().s)
    known = spark.createDataFrame([(7, 1500.0, 1490.0), (8, None, 1.0)], "game_id long, home_elo double, away_elo double")
    assert [(r.game_id, r.prediction_low < r.prediction_high) for r in predict.by_models(known, fitted).collect()] == [(7, True)]


def test_scoring_new_games_once(spark, tmp_path, landing):
    c = Catalog(spark, str(tmp_path / "db"))
    root = str(tmp_path / "events")
    score.run(c, matches.read(spark, root), threat.grid(spark, [i / 192 for i in range(192)]))
    got = metrics(c)
    assert got[100, 1, "minutes"] == 60.0 and got[100, 3, "minutes"] == 30.0 and got[100, 2, "minutes"] == 90.0
    assert got[100, 1, "goals"] == 2.0 and got[100, 2, "goals"] == -2.0  # a goal, and an own goal of the others
    assert got[100, 1, "xt"] > 0 and got[100, 2, "xt"] == 0.0 and not any(m == "vaep" for *_, m in got)
    pg = {r.player_id: r for r in c.table("basis.player_game").collect()}
    assert (pg[1].goals_for, pg[1].goals_against, pg[1].starter, pg[1].kit_number, pg[1].is_home, pg[3].starter) == (2, 0, 1, 9, 1, 0)
    doc = match_doc()
    doc["events"][1]["type"] = {"value": 1, "displayName": "Pass"}
    (landing / "100.json").write_text(json.dumps(doc))
    (landing / "101.json").write_text(json.dumps(match_doc(30, 40)))
    score.run(c, matches.read(spark, root))
    again = metrics(c)
    assert {k: v for k, v in again.items() if k[0] == 100} == got and (101, 1, "goals") in again


def test_stream_equals_batch(spark, tmp_path, landing):
    (landing / "101.json").write_text(json.dumps(match_doc(30, 40)))
    batch, stream = Catalog(spark, str(tmp_path / "a")), Catalog(spark, str(tmp_path / "b"))
    score.run(batch, matches.read(spark, str(tmp_path / "events")))
    for _ in range(2):
        incremental.score_new_games(stream, str(tmp_path / "events"), str(tmp_path / "checkpoint")).awaitTermination()
    assert metrics(stream) == metrics(batch) != {}
    (landing / "102.json").write_text(json.dumps(match_doc(50, 60)))
    incremental.score_new_games(stream, str(tmp_path / "events"), str(tmp_path / "checkpoint")).awaitTermination()
    assert {k[0] for k in metrics(stream)} == {100, 101, 102}


def test_live_windows(spark, tmp_path):
    rows = [(datetime(2024, 1, 1, 12, m), 1, m, m % 4 == 0) for m in range(20)]
    spark.createDataFrame(rows, "ts timestamp, game_id long, expanded_minute int, is_goal boolean").write.parquet(str(tmp_path / "in"))
    events = spark.readStream.schema("ts timestamp, game_id long, expanded_minute int, is_goal boolean").parquet(str(tmp_path / "in"))
    q = incremental.live_minutes(events).writeStream.format("memory").queryName("live").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r.goals, r.last_minute) for r in spark.table("live").collect()) == [(2, 19), (3, 9)]


def test_sync(spark, tmp_path, landing):
    c = Catalog(spark, str(tmp_path / "db"))
    c.create()
    docs = matches.read(spark, str(tmp_path / "events"))
    games = spark.createDataFrame([(100, date(2020, 9, 12), "L")], "game_id long, day date, league string")
    roster = spark.createDataFrame(
        [(9, "Ann", "05-03-69", "Home", "2020/2021"), (9, "Old", "05-03-68", "Home", "2019/2020")],
        "kit_number int, name string, date_of_birth string, team string, season string"
    )
    full = roster.select(*(F.col(x) if x in roster.columns else F.lit(None).cast("string").alias(x) for x in c.table("scraping.roster_raw").columns))
    c.overwrite("scraping.roster_raw", full)
    for _ in range(2):
        prepare.sync(c, docs, games)
    assert {r.id: r.birthday for r in c.table("basis.player").collect()} == {1: date(1969, 3, 5), 2: None, 3: None}
    assert {r.id for r in c.table("basis.teams").collect()} == {10, 20}
    assert sorted(
        (r.player_id, r.kit_number, r.valid_to) for r in c.table("basis.squads").collect()
    ) == [(1, 9, squads.FOREVER), (2, 1, squads.FOREVER), (3, 7, squads.FOREVER)]
    flags = prepare.training_flags(docs, games, c, date(2020, 9, 12)).collect()
    assert [tuple(r) for r in flags] == [(100, 1)]


def test_lineups(spark):
    now = datetime(2024, 8, 16, 18, 45)
    s = spark.createDataFrame([(1, datetime(2024, 8, 16, 19)), (2, datetime(2024, 8, 16, 20))], "schedule_id long, date_time timestamp")
    assert [r.schedule_id for r in lineups.due(s, now).collect()] == [1]
    announced = spark.createDataFrame(
        [(1, "T", 500, 9), (1, "T", 501, 8), (1, "T", 502, 77)], "fixture_id long, team_name string, fapi_id long, kit_number int"
    )
    players = spark.createDataFrame([(1, "a", 500), (2, "b", None)], "id long, name string, fapi_id long")
    squad = spark.createDataFrame(
        [(2, 8, 10, date(2020, 1, 1), date(2099, 12, 31))], "player_id long, kit_number int, team_id long, valid_from date, valid_to date"
    )
    m = spark.createDataFrame(
        [(1, 1, date(2024, 1, 1), 0.2, "elo", 1500.0), (2, 1, date(2024, 1, 1), 0.2, "elo", 1400.0)],
        "player_id long, game_id long, game_date date, version double, metric string, metric_value double"
    )
    got = lineups.rated(
        announced, s, players, squad, spark.createDataFrame([(10, "Team")], "id long, name string"), alias_table(spark, {"Team": ["T"]}), m, 0.2
    )
    assert sorted(((r.kit_number, r.player_id, r.elo) for r in got.collect())) == [(8, 2, 1400.0), (9, 1, 1500.0), (77, None, None)]


def test_fetch(spark, tmp_path, landing):
    assert fetch.date_range(None, "2024-02-01", 7, 0, date(2024, 1, 10)) == (date(2024, 1, 3), date(2024, 2, 1))
    (landing / "bad.json").write_text("{")
    here = fetch.landed(spark, str(tmp_path / "events"))
    assert [r.game_id for r in here.collect()] == [100]
    assert [r.path[-8:] for r in fetch.bad_documents(spark, str(tmp_path / "events")).collect()] == ["bad.json"]
    s = spark.createDataFrame(
        [(100, datetime(2024, 1, 5), "L"), (101, datetime(2024, 1, 5, 23), "L"), (102, datetime(2024, 1, 6), "L")],
        "game_id long, date timestamp, league string"
    )
    assert [r.game_id for r in fetch.missing(s, here, date(2024, 1, 5), date(2024, 1, 5)).collect()] == [101]
    assert fetch.summary(s).first().games == 3
    (tmp_path / "c.toml").write_text('leagues = ["L"]\ndays_back = 9\ndays_forward = 2\ndata_dir = "elsewhere"\n')
    args = fetch.arguments(["--config", str(tmp_path / "c.toml"), "--days-back", "3", "--data-dir", str(tmp_path)])
    assert (args.leagues, args.days_back, args.days_forward, args.data_dir, args.dry_run, args.start) == (["L"], 3, 2, str(tmp_path), False, None)
    assert fetch.arguments([]).days_back == 7
    assert [r.game_id for r in fetch.run(s, args, date(2024, 1, 6)).collect()] == [101, 102]
    args.dry_run, args.leagues = True, ["other"]
    assert fetch.run(s, args, date(2024, 1, 6)).collect() == []
    assert fetch.seasons_for((date(2021, 6, 1), date(2021, 8, 1))) == [20, 21]
