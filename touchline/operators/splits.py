"""Samples and splits that are the same for a row wherever and whenever it is computed, as random numbers of a task are not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fraction(*key: Column, seed: int = 7) -> Column:
    """A number from 0 to below 1 for a row's key, from the MD5 of seed and key."""
    text = F.concat_ws(":", F.lit(str(seed)), *(F.coalesce(k.cast("string"), F.lit("")) for k in key))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / float(1 << 32)


def shares(rows: DataFrame, key: list[str], train: float = 0.8, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """rows in two parts, the first with about the share train. Rows of one key go together."""
    first = fraction(*map(F.col, key), seed=seed) < train
    return rows.where(first), rows.where(~first)


def by_day(rows: DataFrame, column: str, day) -> tuple[DataFrame, DataFrame]:
    """rows before a day, and from it on; rows without a day are in neither."""
    return rows.where(F.col(column) < F.lit(day)), rows.where(F.col(column) >= F.lit(day))


def sample(rows: DataFrame, key: list[str], n: int, seed: int = 7) -> DataFrame:
    """n rows, the same ones each time: those with the smallest fractions, ties by key."""
    return rows.withColumn("__at", fraction(*map(F.col, key), seed=seed)).orderBy("__at", *key).limit(n).drop("__at")
