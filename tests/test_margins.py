"""Distributions of margins, on games whose spread is uneven, and the sweep line of ratings by minute."""

import math
import random

import numpy as np
import pytest

from touchline.operators import elo, margins

KIND = "home int, elo_diff double, minutes_missed double, margin double"


def games(n, seed):
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        home, diff, missed = r.randrange(2), r.uniform(-300, 300), r.uniform(0, 90)
        rows.append((home, diff, missed, diff / 100 + 0.4 * home + r.gauss(0, 0.3 + 3 * (missed > 45))))
    return rows


@pytest.fixture(scope="module")
def fitted(spark, tmp_path_factory):
    train = spark.createDataFrame(games(3000, 1), KIND).cache()
    return train, margins.fit(train, str(tmp_path_factory.mktemp("margins")), stages=12)


def test_likelier_than_two_point_models(spark, fitted):
    train, model = fitted
    other = spark.createDataFrame(games(2000, 2), KIND).cache()
    got, plain = margins.scores(other, model).first(), elo.margin_scores(other, elo.fit_margin(train)).first()
    assert got.games == 2000 and got.nll < plain.nll - 0.02 and 0.44 < got.inside < 0.56
    assert model.losses == sorted(model.losses, reverse=True)
    rows = margins.interval(other, model).collect()
    wide = lambda far: np.mean([r.high - r.low for r in rows if (r.minutes_missed > 45) == far])
    assert wide(True) > 3 * wide(False) and rows[0].low < rows[0].high


def test_gradient_is_scaled_by_the_information(spark):
    """Against numeric derivatives of the negative log likelihood, times the inverse of its mean curvature."""
    y, m, s = 1.7, 0.4, -0.3
    nll = lambda m, s: s + (y - m) ** 2 / (2 * math.exp(2 * s))
    e = 1e-6
    slope = (nll(m + e, s) - nll(m - e, s)) / (2 * e), (nll(m, s + e) - nll(m, s - e)) / (2 * e)
    df = spark.createDataFrame([(y, m, s)], "y double, m double, s double")
    got = df.select(*margins.natural_gradient(df.y, df.m, df.s)).first()
    assert tuple(got) == pytest.approx((slope[0] * math.exp(2 * s), slope[1] / 2), rel=1e-6)


def test_nulls_constant_margins_and_no_games(spark, fitted, tmp_path):
    _, model = fitted
    odd = spark.createDataFrame([(1, None, 5.0, 1.0), (1, 20.0, 5.0, None)], KIND)
    got = margins.predict(odd, model).collect()
    assert got[0]["mean"] is None and got[0].deviation is None and got[1]["mean"] is not None
    same = margins.fit(spark.createDataFrame([(1, 1.0, 1.0, 2.0)] * 5, KIND), str(tmp_path), stages=3)
    assert margins.predict(odd, same).collect()[1]["mean"] == pytest.approx(2.0)
    with pytest.raises(ValueError, match="no games"):
        margins.fit(odd.limit(0), str(tmp_path))


def test_team_value_equals_means_over_minutes(spark):
    r = random.Random(4)
    line = [(g, t, m, r.choice([None, r.uniform(1000, 2000)])) for g in range(4) for t in (1, 2) for m in r.sample(range(95), 60)]
    spells = [(r.randrange(5), r.choice([1, 2]), p, a, a + r.randrange(-3, 60)) for p in range(40) for a in [r.randrange(90)]]
    got = elo.team_value(
        spark.createDataFrame(line, "game_id long, team_id long, minute int, value double"),
        spark.createDataFrame(spells, "game_id long, team_id long, player_id long, minute_on int, minute_off int")
    )
    want = {}
    for g, t, p, a, b in spells:
        if met := [(x, v) for k, x, m, v in line if k == g and a <= m <= b]:
            mean = lambda v: sum(v) / len(v) if v else None
            want[g, p] = tuple(mean([v for x, v in met if (x == t) == own and v is not None]) for own in (True, False))
    rows = {(r.game_id, r.player_id): (r.team_value, r.opp_value) for r in got.collect()}
    assert rows.keys() == want.keys() and len(rows) > 20
    for k, v in want.items():
        assert [x is None for x in rows[k]] == [x is None for x in v] and [x or 0 for x in rows[k]] == pytest.approx([x or 0 for x in v])
