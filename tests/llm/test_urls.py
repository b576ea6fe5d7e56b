from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from touchline.llm import urls as U

URLS = [
    None, "", "no scheme", "http://", "http://A.ORG", "http://A.ORG/", "https://www.Example.org/es/x?q=1", "https://example.org/es",
    "http://example.org/en/12#t",
    "http://notexample.org/es/x", "http://x.com/fr/1", "http://x.com/de/1?a", "http://com/de/", "http://x.com?/de/", "http://x.com#/fr/",
    "http://a.net/p://q/", "x://Ä.net/É\n/z",
    "http://host.net:80/a", "http://a.net/listed", "HTTP://A.net/listed?x#y", "http://a.net/listed",
]


def plain(url, listed):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fit = [(h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, verdict = max(fit, key=lambda x: len(x[0])) if fit else (None, "block" if host + path and host + path in listed else "allow")
    return host, path, rule, verdict


@pytest.mark.parametrize("bits", [U.MAX_BITS, 4096])
def test_against_brute_force(spark, bits):
    """Also with so few bits for a plan that the keys need several segments."""
    urls = URLS + [f"http://h{i % 7}.net/p{i}" for i in range(3000)]
    listed = {"a.net/listed", "", "elsewhere.net/x"} | {f"h{i % 7}.net/p{i}" for i in range(0, 3000, 3)}
    pages = spark.createDataFrame([(i // 2, u, "k", True) for i, u in enumerate(urls)], "page_id long, url string, key string, listed boolean")
    keys = spark.createDataFrame([(k, 1) for k in [*listed, None, "a.net/listed"]], "key string, host int")
    judged = U.judge(pages, keys, max_bits=bits)
    want = [(i // 2, *plain(u, listed)) for i, u in enumerate(urls)]
    assert sorted(map(str, map(tuple, judged.collect()))) == sorted(map(str, want))
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan
    assert len(judged.inputFiles()) > 3 or bits == U.MAX_BITS


def test_no_joins_and_bounded_literals(spark, monkeypatch):
    """No job of any segment joins, and none has more bits in its plan than it may."""
    monkeypatch.setattr(U, "expected_bits", lambda *n: 1)  # too low a guess, so that segments are split
    monkeypatch.setattr(U, "TOGETHER", 1)  # their levels are told apart by their order
    sizes, plans, level, writer = [], [], U._level, type(spark.range(1).write).parquet
    monkeypatch.setattr(U, "_level", lambda keys, i, bits, probes: sizes.append((i, bits)) or level(keys, i, bits, probes))
    monkeypatch.setattr(
        type(spark.range(1).write), "parquet", lambda self,
        path: plans.append(self._df._jdf.queryExecution().executedPlan().toString()) or writer(self, path)
    )
    pages = spark.range(600).selectExpr("id as page_id", "concat('http://h.net/', id) as url")
    got = U.judge(pages, pages.selectExpr("concat('h.net/', page_id) as key").where("page_id % 2 = 0"), max_bits=1024)
    assert {(r.page_id % 2 == 0, r.verdict) for r in got.collect()} == {(True, "block"), (False, "allow")}
    assert not any("Join" in p for p in plans) and len(plans) > 4
    at, most = 0, 0
    for i, bits in sizes:
        at = bits if i == 0 else at + bits
        most = max(most, at)
    assert 0 < most <= 1024 + max(b for _, b in sizes)


def test_many_segments_with_a_hot_url_and_few_files(spark, monkeypatch):
    """Many segments; a third of all pages have one url; a folder has few files however many tasks write."""
    folders = []
    monkeypatch.setattr(U, "new_folder", lambda s, name, new=U.new_folder: folders.append(new(s, name)) or folders[-1])
    urls = "concat('http://', if(id % 3 = 0, 'hot.net/x', concat('h', id % 5, '.net/', id))) as url"
    pages = spark.range(600).selectExpr("id as page_id", urls).repartition(20)
    listed = spark.range(600).selectExpr("concat('h', id % 5, '.net/', id) as key").where("id % 2 = 0").unionByName(spark.createDataFrame([("hot.net/x",)], "key string"))
    got = {r.page_id: r.verdict for r in U.judge(pages, listed, max_bits=256).collect()}
    assert got == {i: "block" if i % 3 == 0 or i % 2 == 0 else "allow" for i in range(600)}
    parts = next(Path(f) for f in folders if "url-pages" in f)
    files = [len(list(d.glob("*.parquet"))) for d in parts.iterdir() if d.is_dir()]
    assert len(files) > 5 and max(files) <= U.FILES


def test_empty(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x")], "page_id long, url string")
    none = spark.createDataFrame([], "key string")
    assert [r.verdict for r in U.judge(pages, none).collect()] == ["allow"]
    assert U.judge(pages.limit(0), pages.select(F.col("url").alias("key"))).collect() == []


def test_plan_is_native_and_reads_two_columns(spark):
    plan = U.op3_bloom_cascade(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Join" not in plan and "Exchange" not in plan and "html" not in plan


def test_sql(spark):
    sf = "/root/testdata/sf0.01"
    c = duckdb.connect()
    c.execute(f"create view pages as from '{sf}/pages.parquet'")
    want = sorted(map(str, c.execute(f"select page_id, host, path, rule, verdict from ({U.ORACLE})").fetchall()))
    assert sorted(str(tuple(r)) for r in U.op3_bloom_cascade(spark, sf).collect()) == want
