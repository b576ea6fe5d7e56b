"""Upserts into Parquet tables, which have no MERGE."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def merged(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old with the rows of new: new rows replace old ones with their keys, others are added. Keys occur once in new."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new.select(*old.columns))


def newest(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each key, for batches in which keys repeat."""
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return rows.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


def appended(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of new whose keys old doesn't have, each key once."""
    return new.dropDuplicates(keys).join(old.select(*keys), keys, "left_anti")


def updated(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """old with columns taken from new where it has the key and the value isn't null."""
    fresh = new.select(*keys, *(F.col(c).alias(f"__{c}") for c in columns))
    cols = {c: F.coalesce(f"__{c}", c) for c in columns}
    return reduce(lambda d, c: d.drop(f"__{c}"), columns, old.join(fresh, keys, "left").withColumns(cols)).select(*old.columns)
