"""Expected threat: a grid of values learned from moves and shots, and what players' moves add to it."""

from __future__ import annotations

import warnings

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .actions import PITCH_X, PITCH_Y, SHOTS
from .minutes import as_metric

LENGTH, WIDTH, EPS = 16, 12, 1e-5
MOVES = ("pass", "dribble", "cross")


def cell(x: Column, y: Column, length: int = LENGTH, width: int = WIDTH) -> Column:
    """The number of the grid cell of a position; positions off the pitch count to its edge."""
    i = F.least(F.greatest(F.floor(x / PITCH_X * length), F.lit(0)), F.lit(length - 1))
    j = F.least(F.greatest(F.floor(y / PITCH_Y * width), F.lit(0)), F.lit(width - 1))
    return (i * width + j).cast("int")


def with_cells(actions: DataFrame, length: int = LENGTH, width: int = WIDTH) -> DataFrame:
    """Actions with an end position, with start_cell and end_cell."""
    known = actions.where("end_x is not null and end_y is not null")
    return known.withColumns(
        {"start_cell": cell(F.col("start_x"), F.col("start_y"), length, width), "end_cell": cell(F.col("end_x"), F.col("end_y"), length, width)}
    )


def counts(actions: DataFrame) -> DataFrame:
    """(start_cell, shots, goals, moves) of actions with cells."""
    shot, good = F.col("type_name").isin(*SHOTS), F.col("result_name") == "success"
    return actions.groupBy("start_cell").agg(
        F.count_if(shot).alias("shots"), F.count_if(shot & good).alias("goals"), F.count_if(F.col("type_name").isin(*MOVES)).alias("moves")
    )


def transitions(actions: DataFrame) -> DataFrame:
    """(start_cell, end_cell, n) of successful moves."""
    return actions.where(
        F.col("type_name").isin(*MOVES) & (F.col("result_name") == "success")
    ).groupBy("start_cell", "end_cell").agg(F.count("*").alias("n"))


def fit(actions: DataFrame, length: int = LENGTH, width: int = WIDTH, eps: float = EPS, most: int = 1000) -> DataFrame:
    """(cell, threat): xT = P(shot) P(goal | shot) + P(move) sum over cells of P(arrive) xT, iterated until no cell
    changes by eps, or for most rounds, which a warning tells. Spark counts the actions; at most one row a cell and pair of
    cells reaches the driver."""
    n = length * width
    placed = with_cells(actions, length, width)
    shots, scored, moves, t = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros((n, n))
    for r in counts(placed).collect():
        shots[r["start_cell"]], scored[r["start_cell"]], moves[r["start_cell"]] = r["shots"], r["goals"], r["moves"]
    for r in transitions(placed).collect():
        t[r["start_cell"], r["end_cell"]] = r["n"]
    div = lambda a, b: np.divide(a, b, out=np.zeros_like(a), where=b > 0)
    t = div(t, np.repeat(moves[:, None], n, 1))
    base, move = div(shots, shots + moves) * div(scored, shots), div(moves, shots + moves)
    value = np.zeros(n)
    for _ in range(most):
        new = base + move * (t @ value)
        done, value = np.abs(new - value).max() < eps, new
        if done:
            break
    else:
        warnings.warn(f"the grid still changes after {most} rounds", stacklevel=2)
    return grid(actions.sparkSession, value)


def grid(spark: SparkSession, values) -> DataFrame:
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "cell int, threat double")


def rate(actions: DataFrame, values: DataFrame | list[float], length: int = LENGTH, width: int = WIDTH) -> DataFrame:
    """Actions with an end position, with value = threat at the end less threat at the start of a successful move, else
    null. The grid (as grid makes it, or a list by cell), a number for each of a few hundred cells, is a literal of the plan; a cell without one has no value."""
    known = {r["cell"]: r["threat"] for r in values.select("cell", "threat").collect()} if isinstance(values, DataFrame) else dict(enumerate(values))
    numbers = ["cast(null as double)" if known.get(i) is None else f"{known[i]!r}D" for i in range(length * width)]
    table = F.expr(f"array({', '.join(numbers)})")
    moved = F.col("type_name").isin(*MOVES) & (F.col("result_name") == "success")
    gain = F.get(table, F.col("end_cell")) - F.get(table, F.col("start_cell"))
    return with_cells(actions, length, width).withColumn("value", F.when(moved, gain))


def on_pitch_sum(on_pitch: DataFrame, rated: DataFrame, clock: str = "as_given") -> DataFrame:
    """(game_id, player_id, value): the sum of the player's own action values strictly between minute_on and
    minute_off; 0 without any, nulls left out.

    The minute is time_seconds / 60 as given; clock="match" adds 45 minutes in the second period, for action tables
    whose seconds restart."""
    minute = F.col("time_seconds") / 60
    if clock == "match":
        minute = minute + F.when(F.col("period_id") == 2, 45).otherwise(0)
    a = rated.where("value is not null").select("game_id", "player_id", minute.alias("minute"), "value").alias("a")
    p = on_pitch.select("game_id", "player_id", "minute_on", "minute_off").alias("p")
    inside = (F.col("a.game_id") == F.col("p.game_id")) & (
        F.col("a.player_id") == F.col("p.player_id")
    ) & (F.col("a.minute") > F.col("p.minute_on")) & (F.col("a.minute") < F.col("p.minute_off"))
    met = p.join(a, inside, "left").select("p.game_id", "p.player_id", "a.value")
    return met.groupBy("game_id", "player_id").agg(F.coalesce(F.sum("value"), F.lit(0.0)).alias("value"))


def xt_metric(on_pitch: DataFrame, actions: DataFrame | None, values: DataFrame | None) -> DataFrame:
    """The metric's rows; without actions or without a grid there are none (rather than zeros)."""
    if actions is None or values is None:
        return no_metric(on_pitch)
    return as_metric(on_pitch_sum(on_pitch, rate(actions, values)), F.col("value"), "xt")


def no_metric(on_pitch: DataFrame) -> DataFrame:
    return as_metric(on_pitch.where(F.lit(False)), F.lit(0.0), "")
