"""Ratings over time: margins to expect, one day's updates, and a season of them in order."""

from __future__ import annotations

import uuid
from datetime import date
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scoring import elo_rating, elo_update, normal_nll, squared_error

MARGIN_FEATURES = ["home", "elo_diff", "minutes_missed"]
#: The 75th percentile of the standard normal distribution.
QUARTILE = 0.6744897501960817


def fit_margin(games: DataFrame, seed: int = 7, **params) -> tuple[PipelineModel, PipelineModel]:
    """Models of the mean and of the absolute error of margin given home, elo_diff and minutes_missed."""
    tree = lambda label: Pipeline(
        stages=[
            VectorAssembler(inputCols=MARGIN_FEATURES, outputCol="features"),
            GBTRegressor(labelCol=label, seed=seed, **({"maxIter": 20, "maxDepth": 3} | params))
        ]
    )
    mean = tree("margin").fit(games)
    errors = mean.transform(games).withColumn("error", F.abs(F.col("margin") - F.col("prediction"))).drop("features", "prediction")
    return mean, tree("error").fit(errors)


def margin_interval(games: DataFrame, models: tuple[PipelineModel, PipelineModel]) -> DataFrame:
    """games with low and high, the quartiles of a normal margin: a mean absolute error is sqrt(2 / pi) deviations."""
    mean = models[0].transform(games).withColumnRenamed("prediction", "__mean").drop("features")
    both = models[1].transform(mean).drop("features")
    spread = F.greatest(F.col("prediction"), F.lit(1e-6)) * 1.2533141373155003 * QUARTILE
    return both.withColumns({"low": F.col("__mean") - spread, "high": F.col("__mean") + spread}).drop("__mean", "prediction")


def margin_scores(games: DataFrame, models: tuple[PipelineModel, PipelineModel]) -> DataFrame:
    """(games, mse, nll): how well margin models do on games that they were not fitted on, such as the second part of
    splits.shares(games, ["game_id"])."""
    got = margin_interval(games, models)
    mean, deviation = (F.col("low") + F.col("high")) / 2, (F.col("high") - F.col("low")) / (2 * QUARTILE)
    mse, nll = F.avg(squared_error(mean, F.col("margin"))), F.avg(normal_nll(F.col("margin"), mean, deviation))
    return got.agg(F.count("*").alias("games"), mse.alias("mse"), nll.alias("nll"))


def margin_quartiles(games: DataFrame, bucket: Column) -> DataFrame:
    """(bucket, low, high): the exact quartiles of margin seen in each bucket; a task holds a bucket's distinct margins."""
    q = games.groupBy(bucket.alias("bucket")).agg(F.percentile("margin", F.array(F.lit(0.25), F.lit(0.75))).alias("q"))
    return q.select("bucket", F.col("q")[0].alias("low"), F.col("q")[1].alias("high"))


def fit_goal_rates(games: DataFrame) -> PipelineModel:
    """Poisson regression of goals on home and elo_diff: the rate that outcome_probabilities needs."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=["home", "elo_diff"], outputCol="features"),
            GeneralizedLinearRegression(family="poisson", link="log", labelCol="goals", regParam=1e-3)
        ]
    ).fit(games)


def team_value(timeline: DataFrame, on_pitch: DataFrame) -> DataFrame:
    """(game_id, player_id, team_value, opp_value): the mean rating of each side over the minutes from minute_on to
    minute_off (both included). timeline(game_id, team_id, minute, value).

    A sweep line: running sums of ratings by minute, of the game and of the side, are read before a spell's first minute
    and at its last, and the opponents' are what the side's leave of the game's. So a spell is two rows, however long, and
    both sums share one shuffle by game. Spells that end before they begin, or without a rated minute, give no row."""
    counted = [F.col("value").cast("double").alias("value"), F.col("value").isNotNull().cast("long").alias("n")]
    points = timeline.select("game_id", "team_id", "minute", *counted, F.lit(None).cast("long").alias("player_id"), F.lit(0).alias("sign"))
    edge = F.explode(F.array(
        F.struct((F.col("minute_on") - 1).alias("minute"), F.lit(-1).alias("sign")), F.struct(F.col("minute_off").alias("minute"), F.lit(1).alias("sign"))
    ))
    spells = on_pitch.where("minute_on <= minute_off").select("game_id", "team_id", "player_id", edge.alias("e")).select(
        "game_id", "team_id", "e.minute", F.lit(None).cast("double").alias("value"), F.lit(0).cast("long").alias("n"), "player_id", "e.sign"
    )
    order = ["minute", F.col("sign") != 0]  # a reading sees all ratings of its minute
    running = lambda *keys: Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    whole, own = running("game_id"), running("game_id", "team_id")
    summed = points.unionByName(spells).withColumns({
        "all": F.coalesce(F.sum("value").over(whole), F.lit(0.0)), "all_n": F.sum("n").over(whole), "rows": F.sum((F.col("sign") == 0).cast("long")).over(whole)
    }).withColumns({"own": F.coalesce(F.sum("value").over(own), F.lit(0.0)), "own_n": F.sum("n").over(own)})
    part = lambda c: F.sum(F.col("sign") * F.col(c)).alias(c)
    per = summed.where("sign <> 0").groupBy("game_id", "player_id").agg(*map(part, ("all", "all_n", "own", "own_n", "rows"))).where("rows > 0")
    mean = lambda total, n: F.when(n > 0, total / n)
    return per.select(
        "game_id", "player_id", mean(F.col("own"), F.col("own_n")).alias("team_value"),
        mean(F.col("all") - F.col("own"), F.col("all_n") - F.col("own_n")).alias("opp_value")
    )


def update(rows: DataFrame) -> DataFrame:
    """rows(elo, team_value, opp_value, margin, low, high, minutes, minutes_3_months) with updated_elo."""
    rating = elo_rating(F.col("elo"), F.col("team_value"))
    cols = [F.col(c) for c in ("margin", "low", "high", "minutes", "minutes_3_months")]
    return rows.withColumn("updated_elo", elo_update(F.col("elo"), rating, F.col("opp_value"), *cols))


#: After so many rounds the changed ratings are folded into the table of all.
FOLD = 16


def season(entries: DataFrame, first: float, folder: str) -> DataFrame:
    """(player_id, game_id, match_day, elo): each player's rating after each game, round by round.

    entries(match_day, game_id, player_id, team_id, margin, low, high, minutes). A round holds, of all leagues at once, the
    games that are the next one for everyone in them: a season has about as many rounds as a side has games, not as there
    are days. A round's games start from the ratings after its players' earlier ones (by day, then game_id); a player
    without one has first, and sides are rated by the mean of their players. Games without an opponent change nothing and
    give no rows. minutes_3_months are the minutes of the 90 days before. Only ratings that change are written, to folder;
    the latest of a player holds."""
    spark, run = entries.sparkSession, f"{folder.rstrip('/')}/elo-{uuid.uuid4().hex}"
    days = Window.partitionBy("player_id").orderBy(F.datediff("match_day", F.lit(date(1970, 1, 1))))
    recent = F.coalesce(F.sum("minutes").over(days.rangeBetween(-90, -1)), F.lit(0))
    number = F.row_number().over(Window.partitionBy("player_id").orderBy("match_day", "game_id"))
    rows = entries.withColumns({"minutes_3_months": recent, "nth": number})
    rows = rows.withColumn("players", F.count("*").over(Window.partitionBy("game_id")))
    rows.write.partitionBy("nth").parquet(f"{run}/entries")
    rows = spark.read.schema(rows.schema).parquet(f"{run}/entries")
    state = "player_id bigint, nth int, elo double"
    base, changed, history, n = spark.createDataFrame([], state), [], [], 0
    result_kind = "player_id bigint, game_id bigint, match_day date, nth int, elo double"
    while True:
        # of each player the last game and the last rating, which a game without an opponent leaves null
        latest = reduce(DataFrame.unionByName, [spark.read.schema(state).parquet(p) for p in changed], base).groupBy("player_id")
        latest = latest.agg(F.max("nth").alias("last"), F.max_by("elo", F.when(F.col("elo").isNotNull(), F.col("nth"))).alias("elo"))
        ahead = rows.where(F.col("nth") <= n + 1).join(latest, "player_id", "left").where(F.col("nth") > F.coalesce("last", F.lit(0)))
        # a game that some player meets only later has fewer of its players here than in all
        next_ = ahead.where(F.col("nth") == F.coalesce("last", F.lit(0)) + 1)
        ready = next_.groupBy("game_id").agg(F.count("*").alias("here"), F.max("players").alias("all")).where("here = all").select("game_id")
        now = next_.join(ready, "game_id", "left_semi").withColumn("elo", F.coalesce("elo", F.lit(first)))
        side = now.groupBy("game_id", "team_id").agg(F.avg("elo").alias("value"))
        met = now.join(side.withColumnRenamed("value", "team_value"), ["game_id", "team_id"])
        other = side.select("game_id", F.col("team_id").alias("__other"), F.col("value").alias("opp_value"))
        met = met.join(other, (met["game_id"] == other["game_id"]) & (met["team_id"] != other["__other"]), "left").drop(other["game_id"])
        new = update(met).withColumn("updated_elo", F.when(F.col("opp_value").isNotNull(), F.col("updated_elo")))
        new.select("player_id", "game_id", "match_day", "nth", F.col("updated_elo").alias("elo")).write.parquet(f"{run}/rounds/{n}")
        got = spark.read.schema(result_kind).parquet(f"{run}/rounds/{n}")
        if got.isEmpty():
            break
        history.append(f"{run}/rounds/{n}")
        changed.append(history[-1])
        n += 1
        if n % FOLD == 0:
            folded = reduce(DataFrame.unionByName, [spark.read.schema(state).parquet(p) for p in changed], base).groupBy("player_id")
            folded = folded.agg(F.max("nth").alias("nth"), F.max_by("elo", F.when(F.col("elo").isNotNull(), F.col("nth"))).alias("elo"))
            folded.write.parquet(f"{run}/ratings/{n}")
            base, changed = spark.read.schema(state).parquet(f"{run}/ratings/{n}"), []
    made = spark.read.schema(result_kind).parquet(*history) if history else spark.createDataFrame([], result_kind)
    return made.where("elo is not null").select("player_id", "game_id", "match_day", "elo")
