"""Every football query against its SQL on the smallest tables."""

import datetime
import decimal
import math
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from touchline.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events pages".split():
        c.execute(f"create view {t} as from '{SF}/{t}.parquet'")
    return c


def norm(v):
    if isinstance(v, (float, decimal.Decimal)):
        return None if math.isnan(v) else str(round(float(v), 6) + 0.0)
    if isinstance(v, datetime.datetime) and v.time() == datetime.time(0):
        v = v.date()
    return str(v)


def rows(names, data):
    order = [names.index(n) for n in sorted(names)]
    return sorted(tuple(norm(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF)
    if name not in ORACLES:
        assert got.columns == ["player_id", "game_id", "metric", "value"] and got.count() > 0
        return
    q = duck.execute(ORACLES[name])
    names = [d[0] for d in q.description]
    assert sorted(names) == sorted(got.columns)
    assert rows(got.columns, map(tuple, got.collect())) == rows(names, q.fetchall())


def test_entry_and_registry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["player_id", "game_id", "metric", "value"]
    assert set(QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())


def test_entry_without_an_optional_module():
    """The football queries are there whatever the other package lacks, itself included."""
    code = """import sys, warnings
sys.modules.update({name: None for name in sys.argv[1:]})
import __spark_entry__ as e
from touchline.queries import ORACLES, QUERIES
warnings.simplefilter("ignore")
assert set(QUERIES) <= set(e.queries()) and set(ORACLES) <= set(e.oracle_sql())
assert "op9_secrets" not in e.queries() and "pipeline" not in e.queries()"""
    for lost in ("ahocorasick", "touchline.llm", "tokenizers"):
        subprocess.run([sys.executable, "-c", code, lost], cwd=Path(__file__).parent.parent, check=True)
