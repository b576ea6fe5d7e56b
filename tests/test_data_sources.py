"""The fixtures service and the SQL store as data sources."""

import json
import sqlite3
from contextlib import closing
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from touchline.sources import rest
from touchline.sources.fixtures import FixturesSource, FixturesStream, Page
from touchline.sources.sqlstore import SqlStore


def answer(league, season, ids):
    return json.dumps({
        "paging": {"current": 1, "total": 1}, "response": [
            {"fixture": {"id": i, "date": f"{season}-08-1{i % 9}T18:30:00+02:00", "extra": [1]}, "league": {"id": league, "season": season},
             "teams": {"home": {"name": f"H{i}"}, "away": {"name": f"A{i}"}}} for i in ids]
    })


def land(root, league, season, number, ids, text=None):
    path = root / f"league={league}/season={season}/page={number}.json"
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text or answer(league, season, ids))


#: A fetcher of one's own, which leaves a mark for each page that it fetches.
COUNTING = """
from touchline.sources.fixtures import Landed

class Counting(Landed):
    def fetch(self, page):
        with open(f"{self.root}/fetched", "a") as f:
            f.write(f"{page.league}/{page.season}/{page.number}\\n")
        return super().fetch(page)
"""


@pytest.fixture
def fixtures(spark, tmp_path):
    spark.dataSource.register(FixturesSource)
    for league in (39, 78):
        for season in (2023, 2024):
            for number in (1, 2):
                land(tmp_path, league, season, number, [league * 1000 + season * 10 + number * 3 + k for k in range(3)])
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    yield tmp_path
    spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_fixtures_equal_the_json_reader(spark, fixtures):
    got = spark.read.format("touchline_fixtures").load(str(fixtures))
    want = rest.schedule(spark, f"{fixtures}/league=*/season=*/*.json")
    assert sorted(map(tuple, got.drop("season").collect())) == sorted(map(tuple, want.collect())) and got.count() == 24


@pytest.mark.parametrize("where, pages", [
    ("league = 39 and season = 2024", {"39/2024/1", "39/2024/2"}), ("season in (2023, 2030) and home <> 'x'", {f"{x}/2023/{n}" for x in (39, 78) for n in (1, 2)}),
    ("league = 39 and league in (78)", set()),
])
def test_pruned_pages_are_not_fetched(spark, fixtures, where, pages, tmp_path_factory):
    own = tmp_path_factory.mktemp("own") / "own_fetcher.py"
    own.write_text(COUNTING)
    spark.sparkContext.addPyFile(str(own))
    reader = spark.read.format("touchline_fixtures").option("fetcher", "own_fetcher:Counting")
    got = reader.load(str(fixtures)).where(where)
    want = spark.read.format("touchline_fixtures").load(str(fixtures)).collect()
    assert got.count() == sum(f"{r.league}/{r.season}" in {p.rpartition("/")[0] for p in pages} for r in want)
    assert set((fixtures / "fetched").read_text().split() if pages else []) == pages


def test_answers_that_lack_fields(spark, fixtures):
    land(fixtures, 1, 2020, 1, [], '{"response": [{"fixture": {"id": 5, "date": null}}, {"fixture": {"id": 6}, "teams": null}]}')
    land(fixtures, 1, 2020, 2, [], '{"errors": ["limit"]}')
    got = spark.read.format("touchline_fixtures").load(str(fixtures)).where("league = 1").orderBy("schedule_id").collect()
    assert [tuple(r) for r in got] == [(5, None, None, None, 1, 2020), (6, None, None, None, 1, 2020)]


def test_stream_reads_each_page_once(spark, fixtures, tmp_path_factory):
    out, check = (str(tmp_path_factory.mktemp(x)) for x in ("out", "check"))

    def run():
        stream = spark.readStream.format("touchline_fixtures").load(str(fixtures))
        stream.writeStream.format("parquet").option("checkpointLocation", check).trigger(availableNow=True).start(out).awaitTermination()
        return spark.read.parquet(out).count()

    assert run() == 24 and run() == 24
    land(fixtures, 39, 2024, 3, [1, 2])
    assert run() == 26
    stream = FixturesStream({"path": str(fixtures)})
    assert stream.partitions({"39/2024": 2}, {"39/2024": 3, "78/2023": 1}) == [Page(39, 2024, 3), Page(78, 2023, 1)]


ROWS = [(i, f"n'{i}\"é" if i % 3 else None, date(2020, 1, 1 + i % 28), datetime(2020, 1, 1, 5, i % 60), i / 3, i % 2 == 0) for i in range(1000)]
KIND = "id long, name string, day date, at timestamp, value double, flag boolean"


@pytest.fixture
def store(spark, tmp_path):
    spark.dataSource.register(SqlStore)
    return str(tmp_path / "store.db")


def put(df, path, mode="append", **options):
    df.write.format("touchline_sql").options(path=path, table="games", **options).mode(mode).save()


def get(spark, path, **options):
    return spark.read.format("touchline_sql").options(path=path, table="games", **options).load()


def tables(path):
    with closing(sqlite3.connect(path)) as c:
        return {x for (x,) in c.execute("SELECT name FROM sqlite_master WHERE type = 'table'")}


def test_round_trip_and_ranges(spark, store):
    rows = [*ROWS, (None, "no key", None, None, None, None), (5, "key again", None, None, None, None)]
    put(spark.createDataFrame(rows, KIND).repartition(6), store)
    key = lambda r: str(tuple(r))
    for options in ({"key": "id", "partitions": 7}, {"key": "id", "partitions": 1}, {"key": "id", "partitions": 50}, {}):
        got = get(spark, store, **options)
        assert sorted(map(tuple, got.collect()), key=key) == sorted(rows, key=key)
    sizes = [r["count"] for r in get(spark, store, key="id", partitions=7).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 7 and max(sizes) < 160
    assert tables(store) == {"games"}


def test_modes_and_keys(spark, store):
    put(spark.createDataFrame(ROWS, KIND), store)
    put(spark.createDataFrame(ROWS[:3], KIND), store)
    assert get(spark, store).count() == 1003
    put(spark.createDataFrame(ROWS, KIND), store, "overwrite")
    assert get(spark, store).count() == 1000
    new = spark.createDataFrame([(0, "new", None, None, 1.0, True), (0, "new", None, None, 1.0, True), (7000, "other", None, None, 2.0, False)], KIND)
    put(new.repartition(3), store, keys="id")
    got = {r.id: r.name for r in get(spark, store).collect()}
    assert get(spark, store).count() == 1001 and got[0] == "new" and got[7000] == "other" and got[1] == ROWS[1][1]
    put(spark.createDataFrame([], KIND), store, "overwrite")
    assert get(spark, store).count() == 0


def test_a_task_that_fails_leaves_the_store_as_it_was(spark, store):
    put(spark.createDataFrame(ROWS, KIND), store)
    bad = spark.createDataFrame(ROWS, KIND).repartition(4).withColumn("id", F.when(F.col("id") == 777, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("id") + 5000))
    for mode in ("append", "overwrite"):
        with pytest.raises(Exception, match="broken"):
            put(bad, store, mode)
        assert get(spark, store).count() == 1000 and get(spark, store).agg(F.max("id")).first()[0] == 999
        assert tables(store) == {"games"}


def test_unknown_table(spark, store):
    with pytest.raises(Exception, match="no table"):
        get(spark, store).count()
