"""Goals, results, odds and ratings as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def own_goal(qualifiers: Column) -> Column:
    """Whether some qualifier is OwnGoal; no qualifiers, or null, is no own goal."""
    return F.coalesce(F.exists(qualifiers, lambda q: q["type"]["displayName"] == "OwnGoal"), F.lit(False))


def opposition(team: Column, one: Column, other: Column) -> Column:
    """The other of a game's two teams; a third team stays."""
    return F.when(team == one, other).when(team == other, one).otherwise(team)


def result_part(result: Column, i: int) -> Column:
    """Goals of the home (0) or away (1) side in a result such as 2-1."""
    return F.get(F.split(result, "-"), F.lit(i)).try_cast("int")


def goal_margin(result: Column) -> Column:
    return result_part(result, 0) - result_part(result, 1)


def odds_probability(odds: Column) -> Column:
    """The probability that decimal odds imply; null for zero."""
    return F.try_divide(F.lit(1.0), odds)


def odds_percentage(odds: Column) -> Column:
    return F.try_divide(F.lit(100.0), odds)


def elo_expectation(rating: Column, other: Column) -> Column:
    """The expected score of a rating against another, 400 points being ten to one."""
    return F.pow(F.lit(10.0), rating / 400) / (F.pow(F.lit(10.0), rating / 400) + F.pow(F.lit(10.0), other / 400))


def elo_rating(player: Column, team: Column) -> Column:
    return F.lit(0.33) * player + F.lit(0.67) * team


def elo_k(minutes: Column, minutes_3_months: Column, most: float = 20.0) -> Column:
    """The weight of a game: in proportion to minutes up to 90, half for players with 500 minutes in three months."""
    k = F.least(minutes, F.lit(90)) / 90 * most
    return F.when(F.coalesce(minutes_3_months, F.lit(0)) >= 500, k / 2).otherwise(k)


def elo_update(
    elo: Column, rating: Column, other: Column, margin: Column, low: Column, high: Column, minutes: Column, minutes_3_months: Column
) -> Column:
    """The rating after a game: unchanged if the margin is within [low, high], else moved towards a win or a loss."""
    score = F.when(margin > high, 1.0).when(margin < low, 0.0)
    moved = elo + elo_k(minutes, minutes_3_months) * (score - elo_expectation(rating, other))
    return F.when(score.isNull(), elo).otherwise(moved)


def pm_predict(player: Column, team: Column, other: Column, minute: Column) -> Column:
    return ((player * 0.34 + team * 0.66) - other) * F.least(minute / 90, F.lit(1.0))


def pm_update(player: Column, score: Column, expected: Column) -> Column:
    return player + (score - expected) / 10


def elo_seed(players_in_league: Column, club_average: Column, external: Column, starter: Column) -> Column:
    """A first rating: the club's or league's average, or for a league with under 50 players an external one, of which
    those who don't start get 0.7."""
    return F.when(players_in_league < 50, F.when(starter, external).otherwise(external * 0.7)).otherwise(club_average)


def poisson(k: int, rate: Column) -> Column:
    return F.exp(-rate) * F.pow(rate, F.lit(k)) / float(_factorial(k))


def _factorial(k: int) -> int:
    return 1 if k < 2 else k * _factorial(k - 1)


def outcome_probabilities(home_rate: Column, away_rate: Column, most: int = 60) -> Column:
    """struct(win, draw, loss) of the home side when both sides' goals are independent Poisson numbers.

    One walk over the number of goals carries each side's probability of it and of fewer. It ends at most goals, beyond
    which there is under 1e-12 for rates up to 20; what win, draw and loss leave of 1 is what it leaves out."""
    zero = F.lit(0.0)
    start = F.struct(
        F.exp(-home_rate).alias("h"), F.exp(-away_rate).alias("a"), zero.alias("h_less"), zero.alias("a_less"), zero.alias("win"), zero.alias("draw"),
        zero.alias("loss")
    )

    def add(s: Column, k: Column) -> Column:
        h, a, h_less, a_less = s["h"], s["a"], s["h_less"], s["a_less"]
        return F.struct(
            (h * home_rate / (k + 1)).alias("h"), (a * away_rate / (k + 1)).alias("a"), (h_less + h).alias("h_less"), (a_less + a).alias("a_less"),
            (s["win"] + h * a_less).alias("win"), (s["draw"] + h * a).alias("draw"), (s["loss"] + a * h_less).alias("loss")
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(most)), start, add, lambda s: F.struct(s["win"], s["draw"], s["loss"]))


def squared_error(predicted: Column, seen: Column) -> Column:
    """Its mean is the mean squared error of predictions."""
    return F.pow(predicted - seen, F.lit(2))


def normal_nll(seen: Column, mean: Column, deviation: Column) -> Column:
    """The negative logarithm of a normal density; its mean is the likelihood score of forecasts of a distribution."""
    return F.log(deviation) + 0.9189385332046727 + F.pow((seen - mean) / deviation, F.lit(2)) / 2


def brier(probabilities: list[Column], happened: list[Column]) -> Column:
    """The squared distance of a forecast from what happened (0 or 1 each); its mean is the score of forecasts."""
    return sum((F.pow(p - y, F.lit(2)) for p, y in zip(probabilities, happened)), F.lit(0.0))


