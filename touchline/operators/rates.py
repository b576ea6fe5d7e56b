"""Goal rates with their uncertainty: Bayesian Poisson regression by Laplace's approximation, and what it says of outcomes.

Goals are Poisson with the rate exp(b . x); b has a normal prior. Newton's steps go to the posterior's mode, each by one
aggregate over the games (gradient and curvature, a few numbers however many games); the posterior is taken as normal there. Draws
from it come from hashes of seed, draw and coefficient, so they are the same wherever and in how many parts they are made.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import outcome_probabilities

#: Deviation of the prior of each coefficient, Newton steps at most, and the change of a coefficient at which they end.
PRIOR, STEPS, EPS = 10.0, 50, 1e-9
DRAWS = 200


@dataclass
class Rates:
    """The intercept comes first, then the features."""

    features: list[str]
    mean: np.ndarray
    covariance: np.ndarray


def _terms(features: list[str]) -> list[Column]:
    return [F.lit(1.0), *(F.col(c).cast("double") for c in features)]


def _rate(terms: list[Column], b) -> Column:
    total = F.lit(0.0)
    for x, w in zip(terms, b):
        total = total + x * (w if isinstance(w, Column) else F.lit(float(w)))
    return F.exp(F.least(total, F.lit(30.0)))


def fit(games: DataFrame, features: list[str], prior: float = PRIOR) -> Rates:
    """The posterior of games(goals, features); rows with a null in one of these teach nothing, and without rows it is the prior.

    A step that makes the posterior less likely is halved, so that it is reached from any start."""
    rows = games.select("goals", *features).dropna()
    x, d = _terms(features), len(features) + 1
    pairs = [(i, j) for i in range(d) for j in range(i, d)]

    def at(b: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Log posterior but for a constant, its gradient, and minus its second derivatives."""
        rate = _rate(x, b)
        sums = [F.sum(F.col("goals") * F.log(rate) - rate), *(F.sum((F.col("goals") - rate) * v) for v in x), *(F.sum(rate * x[i] * x[j]) for i, j in pairs)]
        got = [v or 0.0 for v in rows.agg(*(s.alias(f"s{i}") for i, s in enumerate(sums))).first()]
        curvature = np.zeros((d, d))
        for (i, j), v in zip(pairs, got[1 + d :]):
            curvature[i, j] = curvature[j, i] = v
        return got[0] - b @ b / (2 * prior**2), np.array(got[1 : 1 + d]) - b / prior**2, curvature + np.eye(d) / prior**2

    b = np.zeros(d)
    value, gradient, curvature = at(b)
    for _ in range(STEPS):
        step = np.linalg.solve(curvature, gradient)
        while True:
            new = at(b + step)
            if new[0] >= value - 1e-9 * abs(value) or np.abs(step).max() < EPS:
                break
            step = step / 2
        b, (value, gradient, curvature) = b + step, new
        if np.abs(step).max() < EPS:
            break
    return Rates(features, b, np.linalg.inv(curvature))


def _uniform(*key: Column) -> Column:
    """In (0, 1), by a hash of the key."""
    return (F.shiftrightunsigned(F.xxhash64(*key), 11) + F.lit(0.5)) / float(1 << 53)


def draws(spark, model: Rates, n: int = DRAWS, seed: int = 7) -> DataFrame:
    """(draw, coefficients array<double>): n draws of the posterior. Each number is a normal made of two hashes, so a draw is the same
    in any plan."""
    d = len(model.mean)
    root = np.linalg.cholesky(model.covariance)
    # two uniforms make a normal
    z = [
        F.sqrt(-2 * F.log(_uniform(F.lit(seed), F.col("draw"), F.lit(2 * k)))) * F.cos(2 * math.pi * _uniform(F.lit(seed), F.col("draw"), F.lit(2 * k + 1)))
        for k in range(d)
    ]
    rows = spark.range(n).select(F.col("id").alias("draw")).select("draw", *(v.alias(f"z{k}") for k, v in enumerate(z)))
    each = []
    for i in range(d):
        total = F.lit(float(model.mean[i]))
        for k in range(i + 1):
            total = total + F.lit(float(root[i, k])) * F.col(f"z{k}")
        each.append(total)
    return rows.select("draw", F.array(*each).alias("coefficients"))


def outcomes(games: DataFrame, model: Rates, home: dict[str, str], away: dict[str, str], n: int = DRAWS, seed: int = 7) -> DataFrame:
    """games with win, draw and loss: chances of the home side, the mean over n draws of the posterior.

    home and away say which column holds each feature for a side. The draws, n rows of a few numbers, are a literal of the plan:
    games are neither joined nor multiplied."""
    drawn = [r["coefficients"] for r in draws(games.sparkSession, model, n, seed).orderBy("draw").collect()]
    table = F.array(*(F.array(*map(F.lit, b)) for b in drawn))
    side = lambda of: _terms([of[c] for c in model.features])

    def chances(b: Column) -> Column:
        w = [b[i] for i in range(len(model.mean))]
        return outcome_probabilities(_rate(side(home), w), _rate(side(away), w))

    each = F.transform(table, chances)
    total = lambda k: F.aggregate("__each", F.lit(0.0), lambda a, x: a + x[k]) / n
    return games.withColumn("__each", each).withColumns({k: total(k) for k in ("win", "draw", "loss")}).drop("__each")
