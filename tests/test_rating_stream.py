"""Ratings as a stream, against the batch over the same games."""

import random
from datetime import date, timedelta

import pytest

from touchline.operators import elo
from touchline.streaming import ratings as R

ENTRY = "match_day date, game_id long, player_id long, team_id long, margin int, low double, high double, minutes int"


@pytest.fixture(scope="module")
def entries(spark):
    r, rows = random.Random(2), []
    for g in range(4):
        day, players = date(2020, 1, 1) + timedelta(20 * (g // 2)), r.sample(range(8), 4)
        margin = r.choice([-3, -1, 0, 1, 3])
        for i, p in enumerate(players):
            rows.append((day, g, p, 100 + i % 2, margin if i % 2 else -margin, -0.5, 0.5, r.choice([30, 90])))
    rows.append((date(2020, 1, 1), 50, 7, 3, 1, -0.5, 0.5, 90))  # a game without an opponent
    return spark.createDataFrame(rows, ENTRY).cache()


@pytest.fixture
def stream_conf(spark):
    R.state_store(spark)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def rows(df):
    return sorted((r.player_id, r.game_id, str(r.match_day), round(r.elo, 9)) for r in df.collect())


def land(entries, folder, where):
    R.with_players(entries).where(where).coalesce(1).write.mode("append").parquet(folder)


def test_stream_equals_season(spark, entries, tmp_path, stream_conf):
    """Two landings; the second starts a new query from the checkpoint of the first."""
    landed, results, check = (str(tmp_path / x) for x in ("landed", "results", "check"))
    want = rows(elo.season(entries, 1500.0, str(tmp_path / "season")))
    land(entries, landed, "match_day < '2020-01-15'")
    assert R.drain(spark, landed, results, check, 1500.0) > 1
    first = rows(R.ratings(spark, results))
    assert first == [r for r in want if r[2] < "2020-01-15"]
    land(entries, landed, "match_day >= '2020-01-15'")
    R.drain(spark, landed, results, check, 1500.0)
    assert rows(R.ratings(spark, results)) == want


def test_stream_takes_over_from_the_batch(spark, entries, tmp_path, stream_conf):
    landed, results, check = (str(tmp_path / x) for x in ("landed", "results", "check"))
    want = rows(elo.season(entries, 1500.0, str(tmp_path / "season")))
    day = date(2020, 1, 15)
    old = elo.season(entries.where("match_day < '2020-01-15'"), 1500.0, str(tmp_path / "old"))
    land(entries, landed, "match_day >= '2020-01-15'")
    R.drain(spark, landed, results, check, 1500.0, R.player_state(entries, old, day))
    assert rows(R.ratings(spark, results)) == [r for r in want if r[2] >= "2020-01-15"]
