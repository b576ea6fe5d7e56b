import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from touchline.llm import common as C


def session(master, folder=None):
    conf = {"spark.checkpoint.dir": folder} if folder else {}
    return SimpleNamespace(conf=SimpleNamespace(get=conf.get), sparkContext=SimpleNamespace(master=master))


def test_a_cluster_needs_a_shared_folder():
    assert C.shared_folder(session("spark://host:7077", "s3a://bucket/x/")) == "s3a://bucket/x"
    assert os.path.isdir(C.shared_folder(session("local[4]")))
    for master in ("spark://host:7077", "yarn", "k8s://https://host"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            C.shared_folder(session(master))


def test_scratch_is_deleted(spark):
    with C.scratch(spark) as folder:
        with C.scratch(spark, "inner") as inner:
            assert C.staged(spark.range(3), "t").count() == 3 and inner.startswith(folder) and os.listdir(inner)
        assert not os.path.exists(inner)
        kept = C.staged(spark.range(4), "u")
        assert kept.count() == 4
    assert not os.path.exists(folder) and C.staged(spark.range(5), "v").count() == 5
    with pytest.raises(ZeroDivisionError):
        with C.scratch(spark) as folder:
            C.staged(spark.range(3), "t")
            raise ZeroDivisionError
    assert not os.path.exists(folder)


@pytest.mark.parametrize("share", [1, 3, 10_000])
def test_met_joins_hot_and_rare_keys_alike(spark, monkeypatch, share):
    monkeypatch.setattr(C, "SHARE", share)
    rows = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 40 + 10).alias("k"), (F.col("id") % 2).alias("j"), F.col("id").alias("v")
    )
    sides = C.staged(rows.groupBy("k").agg(F.count("*").alias("n")).withColumn("name", F.col("k") * 2).where("k <> 11"), "sides")
    got = C.met(rows, sides, "k", "n")
    assert got.columns == ["k", "j", "v", "name"]
    assert sorted(map(tuple, got.collect())) == sorted((r.k, r.j, r.v, r.k * 2) for r in rows.collect() if r.k != 11)
    pairs = C.staged(rows.groupBy("k", "j").agg(F.count("*").alias("n")), "pairs")
    assert C.met(rows, pairs, ["k", "j"], "n").count() == 300
    assert C.met(rows.limit(0), sides, "k", "n").collect() == [] == C.met(rows, sides.limit(0), "k", "n").collect()
