"""vaep_fit_and_rate against a plain computation from the models it fits."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from touchline import adapters, queries
from touchline.operators import actionvalue

SF = "/root/testdata/sf0.001"


def test_value_sums_of_the_default_models(spark, monkeypatch):
    fit, made = actionvalue.fit, []
    monkeypatch.setattr(actionvalue, "fit", lambda actions, **params: made.append(fit(actions, **params)) or made[-1])
    rows = queries.QUERIES["vaep_fit_and_rate"](spark, SF).collect()
    got = {(r.game_id, r.player_id): r.value for r in rows}
    (models,) = made
    assert all(0 < m.stages[-1].getNumTrees <= 20 for m in models)
    assert all(m.stages[-1].getOrDefault("validationIndicatorCol") == "held_back" for m in models)
    assert {m.stages[-1].getOrDefault("maxDepth") for m in models} == {3}
    data = actionvalue.features(adapters.actions(spark, SF).withColumn("end_x", F.coalesce("end_x", "start_x")))
    chance = []
    for m in models:
        p = m.transform(data).select("game_id", "period_id", "action_id", vector_to_array("probability")[1].alias("p"))
        chance.append({tuple(r)[:3]: r.p for r in p.collect()})
    spells, before = {}, None
    for r in queries._on_pitch(spark, SF).collect():
        spells.setdefault((r.game_id, r.player_id), []).append((r.minute_on, r.minute_off))
    want = dict.fromkeys(spells, 0.0)
    for r in sorted(data.collect(), key=lambda r: (r.game_id, r.period_id, r.action_id)):
        scores, concedes = (c[r.game_id, r.period_id, r.action_id] for c in chance)
        scored, conceded = 0.0, 0.0
        if before and before[:2] == (r.game_id, r.period_id):
            scored, conceded = before[3:] if before[2] == r.team_id else before[:2:-1]
        before = (r.game_id, r.period_id, r.team_id, scores, concedes)
        for on, off in spells.get((r.game_id, r.player_id), []):
            if on < r.time_seconds / 60 < off:
                want[r.game_id, r.player_id] += scores - scored + conceded - concedes
    assert len(rows) == len(got) == len(want) and any(want.values())
    assert got == pytest.approx(want, abs=1e-9)


def test_both_models_read_vectors_made_once_and_kept_on_disk(spark, monkeypatch):
    seen = []

    class Trees:
        def __init__(self, **params):
            self.label = params["labelCol"]

        def fit(self, data):
            seen.append((self.label, data.columns, data.storageLevel.useMemory, data.storageLevel.useDisk, data.count()))
            return self

    monkeypatch.setattr(actionvalue, "GBTClassifier", Trees)
    actions = adapters.actions(spark, SF)
    actionvalue.fit(actions)
    columns = ["scores", "concedes", "held_back", "features"]
    assert seen == [(label, columns, False, True, actions.count()) for label in ("scores", "concedes")]
