"""Bayesian goal rates against numpy, and their draws."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchline.functions.scoring import outcome_probabilities
from touchline.operators import rates

KIND = "goals int, home double, diff double"
PRIOR = 2.0


@pytest.fixture(scope="module")
def rows():
    r = np.random.default_rng(3)
    home, diff = r.integers(0, 2, 800), r.normal(0, 1, 800)
    return [(int(g), float(h), float(d)) for g, h, d in zip(r.poisson(np.exp(0.2 + 0.3 * home + 0.4 * diff)), home, diff)]


@pytest.fixture(scope="module")
def model(spark, rows):
    return rates.fit(spark.createDataFrame([*rows, (None, 1.0, 1.0), (3, None, 1.0)], KIND), ["home", "diff"], PRIOR)


def test_posterior_equals_a_plain_solve(rows, model):
    x, y, b = np.array([(1, h, d) for _, h, d in rows]), np.array([g for g, *_ in rows]), np.zeros(3)
    for _ in range(100):
        rate = np.exp(x @ b)
        curvature = x.T @ (rate[:, None] * x) + np.eye(3) / PRIOR**2
        b = b + np.linalg.solve(curvature, x.T @ (y - rate) - b / PRIOR**2)
    assert model.mean == pytest.approx(b, abs=1e-8) and model.covariance == pytest.approx(np.linalg.inv(curvature), rel=1e-6)


def test_prior_holds_without_games(spark):
    got = rates.fit(spark.createDataFrame([], KIND), ["home"], 3.0)
    assert got.mean == pytest.approx([0, 0]) and got.covariance == pytest.approx(np.eye(2) * 9)


def test_draws_depend_on_no_partition(spark, model):
    some = rates.draws(spark, model, 4000).collect()
    again = rates.draws(spark, model, 4000).repartition(13).orderBy("draw").collect()
    assert sorted(some) == again and rates.draws(spark, model, 4000, seed=8).orderBy("draw").collect() != again
    got = np.array([r.coefficients for r in again])
    assert got.mean(axis=0) == pytest.approx(model.mean, abs=4 * math.sqrt(model.covariance.max() / 4000))
    assert np.cov(got.T) == pytest.approx(model.covariance, rel=0.15, abs=2e-4)


def test_outcomes_are_means_over_draws(spark, model):
    games = spark.createDataFrame([(1, 0.5, -0.5), (2, -1.0, 2.0), (3, 0.0, 0.0)], "id int, home_diff double, away_diff double").selectExpr("*", "1 as one", "0 as zero")
    sides = {"home": "one", "diff": "home_diff"}, {"home": "zero", "diff": "away_diff"}
    got = {r.id: r for r in rates.outcomes(games.repartition(3), model, *sides, n=40).collect()}
    b = np.array([r.coefficients for r in rates.draws(spark, model, 40).orderBy("draw").collect()])
    pmf = lambda rate: np.array([math.exp(-rate) * rate**k / math.factorial(k) for k in range(60)])
    for i, hd, ad in ((1, 0.5, -0.5), (2, -1.0, 2.0), (3, 0.0, 0.0)):
        p = np.mean([np.outer(pmf(math.exp(x @ (1, 1, hd))), pmf(math.exp(x @ (1, 0, ad)))) for x in b], axis=0)
        assert (got[i].win, got[i].draw, got[i].loss) == pytest.approx((np.tril(p, -1).sum(), np.trace(p), np.triu(p, 1).sum()), abs=1e-9)


@pytest.mark.parametrize("home, away", [(0.1, 3.0), (2.5, 2.5), (20.0, 15.0)])
def test_outcomes_leave_no_tail(spark, home, away):
    w, d, l = spark.range(1).select(outcome_probabilities(F.lit(home), F.lit(away)).alias("p")).first().p
    assert w + d + l == pytest.approx(1, abs=1e-11) and (w > l) == (home > away)
