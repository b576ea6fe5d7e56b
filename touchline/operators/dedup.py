"""Keep one row per key by an explicit order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The row of each key that comes first in the order."""
    ranked = df.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("__rank = 1").drop("__rank")


def keep_last(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    return keep_first(df, keys, F.col(order).desc())


def unprocessed(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among those done. Unlike NOT IN, a null among these changes nothing."""
    return rows.join(done.select(key), key, "left_anti")


def known(rows: DataFrame, among: DataFrame, key: str) -> DataFrame:
    return rows.join(among.select(key), key, "left_semi")
