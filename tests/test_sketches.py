"""Sketches against exact ranks, and raw events."""

import json
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchline.operators import elo, sketches
from touchline.sources import matches


def test_merged_sketches_are_within_the_error(spark):
    """A skewed column, of which one bucket and one day hold most; ranges are merged from days."""
    r = np.random.default_rng(1)
    n = 60_000
    days = np.where(r.random(n) < 0.5, 0, r.integers(0, 40, n))
    rows = [(int(b), date(2020, 1, 1) + timedelta(int(d)), float(v)) for b, d, v in zip(r.random(n) < 0.2, days, np.exp(3 * r.normal(size=n)))]
    df = spark.createDataFrame([*rows, (1, date(2020, 1, 1), None)], "b int, day date, v double").repartition(7)
    stored = sketches.daily(df, F.col("v"), F.col("b"), F.col("day")).cache()
    assert stored.count() == 80 and stored.agg(F.max(F.length("sketch"))).first()[0] < 20_000
    ranks = [0.01, 0.25, 0.5, 0.75, 0.99]
    for until in (0, 20, 40):
        last = date(2020, 1, 1) + timedelta(until)
        for x in sketches.quantiles(stored.where(F.col("day") <= F.lit(last)), ranks).collect():
            own = np.sort([v for b, d, v in rows if b == x.bucket and d <= last])
            assert x.n == len(own)
            for rank, q in zip(ranks, x.q):
                low, high = np.searchsorted(own, q, "left") / len(own), np.searchsorted(own, q, "right") / len(own)
                assert low - sketches.ERROR <= rank <= high + sketches.ERROR
    exact = {x.bucket: (x.low, x.high) for x in elo.margin_quartiles(df.withColumnRenamed("v", "margin"), F.col("b")).collect()}
    for x in sketches.quartiles(stored).collect():
        assert (x.low, x.high) == pytest.approx(exact[x.bucket], rel=0.1)
    assert {x.bucket: round(x.rank, 1) for x in sketches.rank_of(stored, 1.0).collect()} == {0: 0.5, 1: 0.5}


def test_raw_events_keep_what_no_schema_knows(spark, tmp_path):
    events = [{"eventId": 1, "minute": 3, "type": {"displayName": "Pass", "value": 1}, "newField": {"deep": [1, {"x": "y"}]}}, {"eventId": 2, "isGoal": True}]
    (tmp_path / "7.json").write_text(json.dumps({"events": events, "home": {"teamId": 5}}, indent=1))
    (tmp_path / "8.json").write_text(json.dumps({"home": {"teamId": 6}}))
    (tmp_path / "9.json").write_text(json.dumps({"events": []}))
    got = matches.raw_events(spark, str(tmp_path)).cache()
    back = [(r.game_id, r.event_ordinal, json.loads(r.j)) for r in got.selectExpr("*", "to_json(event) as j").orderBy("event_ordinal").collect()]
    assert back == [(7, 0, events[0]), (7, 1, events[1])]
    deep = matches.field(F.col("event"), "$.newField.deep[1].x", "string")
    assert [r[0] for r in got.orderBy("event_ordinal").select(deep).collect()] == ["y", None]
    kinds = matches.field(F.col("event"), "$.isGoal", "boolean"), matches.field(F.col("event"), "$.minute", "int"), matches.field(F.col("event"), "$.type", "int")
    assert [tuple(r) for r in got.orderBy("event_ordinal").select(*kinds).collect()] == [(None, 3, None), (True, None, None)]
    paths = {(r.path, r.kind, r.events) for r in matches.unknown_fields(got).collect()}
    assert paths == {("newField", "OBJECT<deep: ARRAY<VARIANT>>", 1)}
