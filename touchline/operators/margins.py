"""The margin to expect as a distribution: mean and spread learned together by natural-gradient boosting.

A margin is normal with a mean and a deviation that both depend on the game. Each stage takes the gradient of the negative log
likelihood by mean and by log deviation, scales it by the inverse of the Fisher information (so that a step doesn't
depend on how the two are measured, nor on the present spread), fits a regression tree to each and goes along both
by the step that suits the likelihood best. Trees and sums are Spark's; the driver holds the trees.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import normal_nll
from .elo import MARGIN_FEATURES, QUARTILE

STAGES, DEPTH, RATE = 30, 3, 0.2
#: Steps that are tried at each stage, in units of RATE; the best one is taken, or none if all make it worse.
STEPS = (4.0, 2.0, 1.0, 0.5, 0.25)
#: The least deviation, so that games that repeat don't make the likelihood infinite.
LEAST = 1e-3


@dataclass
class Margins:
    """mean and log deviation: a constant, and (step, tree, tree) of each stage; losses are those of the games fitted on."""

    features: list[str]
    mean: float
    log_deviation: float
    stages: list[tuple[float, DecisionTreeRegressionModel, DecisionTreeRegressionModel]] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)


def natural_gradient(margin: Column, mean: Column, log_deviation: Column) -> tuple[Column, Column]:
    """By mean and by log deviation: the gradient (m - y) / d^2 and 1 - (y - m)^2 / d^2 times the inverse information d^2 and 1 / 2."""
    return mean - margin, (1 - F.pow((margin - mean) / F.exp(log_deviation), 2)) / 2


def fit(games: DataFrame, folder: str, features: list[str] | None = None, stages: int = STAGES, depth: int = DEPTH, rate: float = RATE, seed: int = 7) -> Margins:
    """Fits games(margin, features): those with a null in one of these columns teach nothing. Each stage's present parameters are a
    table in folder, so that its plan is one scan, and a lost executor costs no earlier stage. Without games there is nothing
    to fit, which is an error."""
    features = features or MARGIN_FEATURES
    spark, run = games.sparkSession, f"{folder.rstrip('/')}/margins-{uuid.uuid4().hex}"
    known = games.select(F.col("margin").cast("double").alias("margin"), *(F.col(c).cast("double").alias(c) for c in features)).dropna()
    n, mean, deviation = known.agg(F.count("*"), F.avg("margin"), F.stddev_pop("margin")).first()
    if not n:
        raise ValueError("no games to fit margins to")
    model = Margins(features, mean, math.log(max(deviation, LEAST)))
    assembled = VectorAssembler(inputCols=features, outputCol="__features").transform(known)
    now = assembled.select("__features", "margin", F.lit(model.mean).alias("mean"), F.lit(model.log_deviation).alias("log_deviation"))
    loss = lambda m, s: F.avg(normal_nll(F.col("margin"), m, F.exp(s)))
    for stage in range(stages):
        path = f"{run}/{stage}"
        by_mean, by_deviation = natural_gradient(F.col("margin"), F.col("mean"), F.col("log_deviation"))
        now.withColumns({"g0": by_mean, "g1": by_deviation}).write.parquet(path)
        data = spark.read.parquet(path)
        trees = [
            DecisionTreeRegressor(featuresCol="__features", labelCol=f"g{i}", predictionCol=f"t{i}", maxDepth=depth, seed=seed + stage).fit(data) for i in (0, 1)
        ]
        moved = trees[1].transform(trees[0].transform(data))
        to = lambda by: (F.col("mean") - by * F.col("t0"), F.greatest(F.col("log_deviation") - by * F.col("t1"), F.lit(math.log(LEAST))))
        tried = [0.0, *(rate * s for s in STEPS)]
        found = list(moved.agg(*(loss(*to(by)).alias(str(i)) for i, by in enumerate(tried))).first())
        best = min(range(len(tried)), key=found.__getitem__)
        model.losses.append(found[best])
        if not best:
            break
        model.stages.append((tried[best], *trees))
        after = to(tried[best])
        now = moved.select("__features", "margin", after[0].alias("mean"), after[1].alias("log_deviation"))
    return model


def predict(games: DataFrame, model: Margins) -> DataFrame:
    """games with mean and deviation of the margin; null where a feature is null."""
    whole = F.lit(True)
    for c in model.features:
        whole = whole & F.col(c).isNotNull()
    filled = games.withColumns({f"__{c}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in model.features})
    rows = VectorAssembler(inputCols=[f"__{c}" for c in model.features], outputCol="__features").transform(filled)
    mean, log_deviation = F.lit(model.mean), F.lit(model.log_deviation)
    for i, (step, *trees) in enumerate(model.stages):
        for k, tree in enumerate(trees):
            rows = tree.copy().setFeaturesCol("__features").setPredictionCol(f"__t{k}_{i}").transform(rows)
        mean = mean - step * F.col(f"__t0_{i}")
        log_deviation = F.greatest(log_deviation - step * F.col(f"__t1_{i}"), F.lit(math.log(LEAST)))
    return rows.select(*(F.col(c) for c in games.columns), F.when(whole, mean).alias("mean"), F.when(whole, F.exp(log_deviation)).alias("deviation"))


def interval(games: DataFrame, model: Margins) -> DataFrame:
    """games with low and high, the quartiles of the margin, as elo.margin_interval has them."""
    rows = predict(games, model)
    both = {"low": F.col("mean") - QUARTILE * F.col("deviation"), "high": F.col("mean") + QUARTILE * F.col("deviation")}
    return rows.withColumns(both).drop("mean", "deviation")


def scores(games: DataFrame, model: Margins) -> DataFrame:
    """(games, nll, inside): how likely other games' margins are, and the share of them between the quartiles."""
    rows = predict(games, model)
    nll = normal_nll(F.col("margin"), F.col("mean"), F.col("deviation"))
    inside = (F.abs(F.col("margin") - F.col("mean")) <= QUARTILE * F.col("deviation")).cast("double")
    return rows.agg(F.count("mean").alias("games"), F.avg(nll).alias("nll"), F.avg(inside).alias("inside"))
