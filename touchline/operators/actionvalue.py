"""Action values: how much an action changes the chances to score and to concede soon after."""

from __future__ import annotations

from collections.abc import Callable

import math

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .actions import BODY_PARTS, PITCH_X, PITCH_Y, RESULTS, SHOTS, TYPES
from .minutes import as_metric
from .splits import fraction
from .threat import no_metric, on_pitch_sum

PREVIOUS, AHEAD, VALIDATION = 3, 10, 0.25
_PLACE = (
    "start_x", "start_y", "end_x", "end_y", "dx", "dy", "distance", "start_goal_distance", "start_goal_angle", "end_goal_distance", "end_goal_angle"
)
_KEPT = (*_PLACE, "period_id", "time_seconds", *(f"is_{t}" for t in TYPES), *RESULTS[:4], *BODY_PARTS)
_SINCE = ("same_team", "time_gap", "x_gap", "y_gap")
_SCORE = ("goals_own", "goals_other", "goals_ahead")


def _order():
    return Window.partitionBy("game_id", "period_id").orderBy("action_id")


def _goal(own: bool) -> Column:
    scored = F.col("type_name").isin(*SHOTS) & (F.col("result_name") == ("owngoal" if own else "success"))
    return F.coalesce(scored, F.lit(False))


def labels(actions: DataFrame, ahead: int = AHEAD) -> DataFrame:
    """Actions with scores and concedes: whether this action's team gets, or lets in, a goal by this action or one of
    the ahead - 1 that follow in the same period. Own goals count for the other side. A period has two teams."""
    w = _order().rowsBetween(Window.currentRow, ahead - 1)
    one = F.min("team_id").over(Window.partitionBy("game_id", "period_id"))
    is_one = F.col("team_id") == F.col("__one")
    goal = lambda mine: F.max((mine & _goal(False)) | (~mine & _goal(True))).over(w)
    seen = actions.withColumn("__one", one).withColumns({"__for_one": goal(is_one), "__for_other": goal(~is_one)})
    scores, concedes = F.when(is_one, F.col("__for_one")).otherwise(F.col("__for_other")), F.when(is_one, F.col("__for_other")).otherwise(F.col("__for_one"))
    return seen.withColumns({"scores": scores, "concedes": concedes}).drop("__one", "__for_one", "__for_other")


def _to_goal(end: str) -> dict[str, str]:
    """Distance from the middle of the goal on the right, and the angle to it off the pitch's axis."""
    dx, dy = f"({PITCH_X}D - {end}_x)", f"abs({PITCH_Y / 2}D - {end}_y)"
    return {f"{end}_goal_distance": f"hypot({dx}, {dy})", f"{end}_goal_angle": f"if({dx} = 0, {math.pi / 2!r}D, atan(try_divide({dy}, {dx})))"}


def features(actions: DataFrame, previous: int = PREVIOUS) -> DataFrame:
    """Actions with what the models see, of themselves (_0) and of the actions before them in the period (_1, ...): place,
    movement, distance and angle to the goal, period and time, type, result, body part (foot where actions have none);
    of the earlier ones also whether the same team acted and how far off in time and place they began. Of actions before
    the first, the first stands in. Besides, the goals of both sides in the game so far. Missing numbers are 0.

    One shuffle, by game and period, and one by game for the score."""
    part = "coalesce(bodypart_name, 'foot')" if "bodypart_name" in actions.columns else "'foot'"
    base = {
        "dx": "end_x - start_x", "dy": "end_y - start_y", "distance": "hypot(end_x - start_x, end_y - start_y)"
    } | _to_goal("start") | _to_goal("end")
    base |= {f"is_{t}": f"cast(type_name = '{t}' as int)" for t in TYPES} | {r: f"cast(result_name = '{r}' as int)" for r in RESULTS[:4]}
    base |= {b: f"cast({part} = '{b}' as int)" for b in BODY_PARTS}
    out = _with_score(actions).selectExpr("*", *(f"{v} as __{k}" for k, v in base.items()))
    w, cols = "over (partition by game_id, period_id order by action_id)", {}
    for k in range(previous):
        at = lambda c: c if k == 0 else f"coalesce(lag({c}, {k}) {w}, first({c}) {w})"  # noqa: B023, E731
        for c in _KEPT:
            cols[f"{c}_{k}"] = at(f"__{c}" if c in base else c)
        if k:
            cols[f"same_team_{k}"] = f"coalesce(lag(team_id, {k}) {w}, team_id) = team_id"
            for name, c in (("time_gap", "time_seconds"), ("x_gap", "start_x"), ("y_gap", "start_y")):
                cols[f"{name}_{k}"] = f"{c} - {at(c)}"
    made = (f"coalesce(cast({v} as double), 0D) as {k}" for k, v in cols.items())
    return out.selectExpr(*actions.columns, *_SCORE, *made)


def _with_score(actions: DataFrame) -> DataFrame:
    """Actions with goals_own, goals_other and goals_ahead: the score of the game before the action, as its team sees it."""
    before = Window.partitionBy("game_id").orderBy("period_id", "action_id").rowsBetween(Window.unboundedPreceding, -1)
    seen = actions.withColumn("__one", F.min("team_id").over(Window.partitionBy("game_id")))
    is_one = F.col("team_id") == F.col("__one")
    goals = lambda mine: F.coalesce(F.sum(((mine & _goal(False)) | (~mine & _goal(True))).cast("int")).over(before), F.lit(0))
    seen = seen.withColumns({"__for_one": goals(is_one), "__for_other": goals(~is_one)})
    own = F.when(is_one, F.col("__for_one")).otherwise(F.col("__for_other"))
    other = F.when(is_one, F.col("__for_other")).otherwise(F.col("__for_one"))
    cols = {"goals_own": own, "goals_other": other, "goals_ahead": own - other}
    return seen.withColumns({k: F.coalesce(v.cast("double"), F.lit(0.0)) for k, v in cols.items()}).drop("__one", "__for_one", "__for_other")


def feature_names(previous: int = PREVIOUS) -> list[str]:
    return [*_SCORE, *(f"{c}_{k}" for k in range(previous) for c in (*_KEPT, *(_SINCE if k else ())))]


def fit(actions: DataFrame, seed: int = 7, validation: float = VALIDATION, **params) -> tuple[PipelineModel, PipelineModel]:
    """Two boosted-tree models, for scores and for concedes, trained by Spark ML: 20 trees of depth 3, or fewer where more
    don't make the share validation of the actions, which is held back for that, any better (0 holds back none)."""
    labelled = labels(actions)
    data = features(labelled).withColumns({c: F.col(c).cast("double") for c in ("scores", "concedes")})
    more = {"maxIter": 20, "maxDepth": 3} | params
    if validation:
        data = data.withColumn("held_back", fraction(F.col("game_id"), F.col("period_id"), F.col("action_id"), seed=seed) < validation)
        more |= {"validationIndicatorCol": "held_back"}
    assembler = VectorAssembler(inputCols=feature_names(), outputCol="features")
    data = assembler.transform(data).select("scores", "concedes", *(["held_back"] if validation else []), "features")
    # read a few times for each model, which keeps its own form of it in memory
    data = data.persist(StorageLevel.DISK_ONLY)
    try:
        return tuple(PipelineModel([assembler, GBTClassifier(labelCol=label, seed=seed, **more).fit(data)]) for label in ("scores", "concedes"))
    finally:
        data.unpersist()


#: Two models, or a function that gives actions their p_scores and p_concedes.
Models = tuple[PipelineModel, PipelineModel] | Callable[[DataFrame], DataFrame]


def rate(actions: DataFrame, models: Models) -> DataFrame:
    """Actions with offensive, defensive and value: the change of the chance to score, minus that of the chance to
    concede, and their sum. Chances before are those after the previous action of the period, swapped if the other
    team had it; before the first action they are 0."""
    if callable(models):
        return values(models(actions))
    data = features(actions)
    for name, model in zip(("p_scores", "p_concedes"), models):
        done = model.transform(data)
        data = done.withColumn(name, vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")
    return values(data.drop(*feature_names()))


def values(actions: DataFrame) -> DataFrame:
    """The last step of rate: offensive, defensive and value of actions with p_scores and p_concedes."""
    w = _order()
    same = F.lag("team_id").over(w) == F.col("team_id")
    before = lambda mine, other: F.coalesce(F.when(same, F.lag(mine).over(w)).otherwise(F.lag(other).over(w)), F.lit(0.0))
    offensive = F.col("p_scores") - before("p_scores", "p_concedes")
    defensive = before("p_concedes", "p_scores") - F.col("p_concedes")
    return actions.withColumns({"offensive": offensive, "defensive": defensive, "value": offensive + defensive})


def vaep_metric(on_pitch: DataFrame, actions: DataFrame | None, models: Models | None) -> DataFrame:
    if actions is None or models is None:
        return no_metric(on_pitch)
    return as_metric(on_pitch_sum(on_pitch, rate(actions, models)), F.col("value"), "vaep")
