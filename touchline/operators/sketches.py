"""Quartiles of margins at any size: mergeable sketches by bucket and day, kept as a table and merged for any range of days.

A sketch has a few kilobytes whatever it has seen. What is read from it is the value of a rank within ERROR of the rank asked for,
with 99 % confidence, of all values together: merging sketches doesn't make that worse. New days are new rows; no old
row is read again until a range is asked for, and then a task merges sketches, not values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of a sketch, and the error of a rank (two-sided) that goes with it.
SIZE, ERROR = 400, 0.007


def daily(rows: DataFrame, value: Column, bucket: Column, day: Column) -> DataFrame:
    """(bucket, day, n, sketch) of the values that are there: a row for each bucket and day. Values are folded into sketches before any
    shuffle, so that a bucket or a day may hold any share of the rows."""
    known = rows.select(bucket.alias("bucket"), day.alias("day"), value.cast("double").alias("v")).where("v is not null")
    return known.groupBy("bucket", "day").agg(F.count("*").alias("n"), F.kll_sketch_agg_double("v", SIZE).alias("sketch"))


def quantiles(sketches: DataFrame, ranks: list[float]) -> DataFrame:
    """(bucket, n, q array<double>) of daily() rows, those of any range of days: the values of the ranks, by bucket."""
    merged = sketches.groupBy("bucket").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", SIZE).alias("sketch"))
    return merged.select("bucket", "n", F.kll_sketch_get_quantile_double("sketch", F.array(*map(F.lit, ranks))).alias("q"))


def quartiles(sketches: DataFrame) -> DataFrame:
    """(bucket, low, high), as elo.margin_quartiles gives them exactly."""
    return quantiles(sketches, [0.25, 0.75]).select("bucket", F.col("q")[0].alias("low"), F.col("q")[1].alias("high"))


def rank_of(sketches: DataFrame, value: float) -> DataFrame:
    """(bucket, rank): the share of a bucket's values that are not above a value."""
    merged = sketches.groupBy("bucket").agg(F.kll_merge_agg_double("sketch", SIZE).alias("sketch"))
    return merged.select("bucket", F.kll_sketch_get_rank_double("sketch", F.lit(value)).alias("rank"))
