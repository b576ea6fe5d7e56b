"""Models on disk: a folder for each, named by kind and time, with its parts and what is known of its making."""

from __future__ import annotations

import json
from datetime import UTC, datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def save(spark: SparkSession, folder: str, kind: str, parts: dict[str, DataFrame | PipelineModel], made: dict) -> str:
    """Writes tables (like a grid) and fitted pipelines (like the two of action values, or of margins) and returns the
    model's folder. The facts of its making come last, so a model without them is one whose writing failed."""
    name = f"{folder.rstrip('/')}/{kind}_{datetime.now(UTC):%Y%m%d_%H%M%S_%f}"
    for part, value in parts.items():
        if isinstance(value, DataFrame):
            value.write.parquet(f"{name}/{part}.table")
        else:
            value.write().save(f"{name}/{part}.pipeline")
    facts = json.dumps({"kind": kind, "parts": sorted(parts)} | made, sort_keys=True, default=str)
    spark.createDataFrame([(facts,)], "value string").coalesce(1).write.text(f"{name}/made")
    return name


def newest(spark: SparkSession, folder: str, kind: str) -> str | None:
    """The last whole model of a kind by its name, by Spark's own file system wherever the folder is; None without one."""
    fs, p = _fs(spark, folder)
    names = [f.getPath().toString() for f in fs.listStatus(p)] if fs.exists(p) else []
    mine = [n for n in names if n.rsplit("/", 1)[-1].startswith(f"{kind}_") and fs.exists(_fs(spark, f"{n}/made/_SUCCESS")[1])]
    return max(mine, default=None)


def load(spark: SparkSession, name: str) -> tuple[dict[str, DataFrame | PipelineModel], dict]:
    """The parts of a model and the facts of its making."""
    made = json.loads(spark.read.text(f"{name}/made").first()[0])
    fs, parts = _fs(spark, name)[0], {}
    for part in made["parts"]:
        table = f"{name}/{part}.table"
        parts[part] = spark.read.parquet(table) if fs.exists(_fs(spark, table)[1]) else PipelineModel.load(f"{name}/{part}.pipeline")
    return parts, made
