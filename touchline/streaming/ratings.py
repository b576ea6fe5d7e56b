"""Ratings as a stream: entries land, games are rated as soon as everyone in them has a rating from their game before.

Two stateful operators follow each other. The first is keyed by player and keeps the rating, the minutes of the last 90 days and the
entries that wait; it lets one game of a player go on at a time, the earliest. The second is keyed by game and
keeps its rows until all are there. What it rates is written, and the same query reads it again as its other source: that is
what frees each player's next game. So a micro-batch does one round of operators.elo.season, over all leagues at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date, timedelta

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators.elo import update

DAYS = 90
#: Entries as they land: players is how many rows the game has in all.
ENTRY = "match_day date, game_id long, player_id long, team_id long, margin double, low double, high double, minutes long, players long"
RATED = "match_day date, game_id long, player_id long, elo double"
_ROUND = "player_id long, game_id long, match_day date, team_id long, margin double, low double, high double, minutes long, players long, elo double, minutes_3_months long"
_SIDED = "player_id long, game_id long, match_day date, margin double, low double, high double, minutes long, minutes_3_months long, elo double, team_value double, opp_value double"
_VALUES = [x.split()[0] for x in _ROUND.split(", ")]


class Players(StatefulProcessor):
    """Lets the earliest waiting game of a player go on when no other one is under way."""

    def __init__(self, first: float) -> None:
        self.first = first

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rating = handle.getValueState("rating", "elo double")
        self.open = handle.getValueState("open", "game_id long")
        self.recent = handle.getMapState("recent", "match_day date", "minutes long")
        self.waiting = handle.getMapState("waiting", "match_day date, game_id long", "team_id long, margin double, low double, high double, minutes long, players long")

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        self.rating.update((initialState.elo,))
        for day, minutes in zip(initialState.days or [], initialState.minutes or []):
            self.recent.updateValue((date(1970, 1, 1) + timedelta(int(day)),), (int(minutes),))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        open_ = self.open.get()[0] if self.open.exists() else None
        for r in rows:
            if not r.rated:
                self.waiting.updateValue((r.match_day, r.game_id), (r.team_id, r.margin, r.low, r.high, r.minutes, r.players))
            elif r.game_id == open_:  # a result that comes twice frees nothing
                open_ = None
                if r.elo is not None:
                    self.rating.update((r.elo,))
        if open_ is None and (day_game := min((tuple(k) for k in self.waiting.keys()), default=None)):
            day, open_ = day_game
            team, margin, low, high, minutes, players = self.waiting.getValue(day_game)
            self.waiting.removeKey(day_game)
            before = {k[0]: v[0] for k, v in self.recent.iterator()}
            for old in [d for d in before if d < day - timedelta(DAYS)]:
                self.recent.removeKey((old,))
            self.recent.updateValue((day,), (before.get(day, 0) + (minutes or 0),))
            recent = sum(m for d, m in before.items() if day - timedelta(DAYS) <= d < day)
            elo = self.rating.get()[0] if self.rating.exists() else self.first
            yield Row(**dict(zip(_VALUES, (key[0], open_, day, team, margin, low, high, minutes, players, elo, recent))))
        if open_ is None:
            self.open.clear()
        else:
            self.open.update((open_,))

    def close(self) -> None:
        pass


class Games(StatefulProcessor):
    """Holds the rows of a game until all are there, then gives each the mean ratings of both sides."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rows = handle.getListState("rows", _ROUND)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        own = [tuple(r) for r in self.rows.get()] + [tuple(r[c] for c in _VALUES) for r in rows]
        if len(own) < own[0][_VALUES.index("players")]:
            self.rows.put(own)
            return
        self.rows.clear()
        made = [dict(zip(_VALUES, r)) for r in own]
        sides: dict[int, list[float]] = {}
        for r in made:
            sides.setdefault(r["team_id"], []).append(r["elo"])
        value = {t: sum(x) / len(x) for t, x in sides.items()}
        for r in made:
            other = next((v for t, v in value.items() if t != r["team_id"]), None)
            yield Row(
                player_id=r["player_id"], game_id=key[0], match_day=r["match_day"], margin=r["margin"], low=r["low"], high=r["high"],
                minutes=r["minutes"], minutes_3_months=r["minutes_3_months"], elo=r["elo"], team_value=value[r["team_id"]], opp_value=other
            )

    def close(self) -> None:
        pass


def player_state(entries: DataFrame, rated: DataFrame, day: date) -> DataFrame:
    """(player_id, elo, days, minutes): what a stream that takes over on a day starts from: the last rating of each player in
    rated(player_id, game_id, match_day, elo), and the minutes of each day (since 1970) of the DAYS before in entries."""
    old = rated.where((F.col("match_day") < F.lit(day)) & F.col("elo").isNotNull())
    last = old.groupBy("player_id").agg(F.max_by("elo", F.struct("match_day", "game_id")).alias("elo"))
    near = entries.where(F.col("match_day").between(F.date_sub(F.lit(day), DAYS), F.date_sub(F.lit(day), 1)))
    by_day = near.groupBy("player_id", "match_day").agg(F.sum("minutes").cast("long").alias("minutes"))
    each = by_day.groupBy("player_id").agg(F.collect_list(F.struct(F.datediff("match_day", F.lit(date(1970, 1, 1))).alias("d"), "minutes")).alias("r"))
    return last.join(each, "player_id", "left").select("player_id", "elo", F.col("r.d").alias("days"), F.col("r.minutes").alias("minutes"))


def with_players(entries: DataFrame) -> DataFrame:
    """entries as they may land: with the number of the game's rows."""
    counted = entries.withColumn("players", F.count("*").over(Window.partitionBy("game_id")))
    return counted.select(*(F.col(c).cast(t).alias(c) for c, t in (x.split() for x in ENTRY.split(", "))))


def rate(spark: SparkSession, landed: str, results: str, checkpoint: str, first: float, initial: DataFrame | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Rates entries (Parquet files of ENTRY in the folder landed) into Parquet folders under results, one a micro-batch.

    All rows of a game land together, and games in the order of their days; an entry that comes after a later game of its player was
    rated is rated next. A game without an opponent has a null rating and changes nothing. A batch that is repeated after a
    failure overwrites its own folder, and a result that is read twice frees nothing, so each game counts once. initial is a
    table of player_state(). By default the query ends when what is there has passed, which is one round; with
    {"processingTime": ...} it goes on. The session must keep its state in RocksDB (see state_store())."""
    spark.createDataFrame([], RATED).write.mode("append").parquet(f"{results}/batch=-1")
    read = lambda schema, path: spark.readStream.schema(schema).parquet(path)
    new = read(ENTRY, landed).select(F.lit(False).alias("rated"), *[x.split()[0] for x in ENTRY.split(", ")], F.lit(None).cast("double").alias("elo"))
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (x.split() for x in ENTRY.split(", ")) if c not in ("match_day", "game_id", "player_id")]
    back = read(RATED, f"{results}/batch=*").select(F.lit(True).alias("rated"), "match_day", "game_id", "player_id", *nothing, "elo")
    start = initial.groupBy("player_id") if initial is not None else None
    going = new.unionByName(back).groupBy("player_id").transformWithState(Players(first), _ROUND, "append", "none", start)
    sided = going.groupBy("game_id").transformWithState(Games(), _SIDED, "append", "none")
    made = update(sided).select(
        "match_day", "game_id", "player_id", F.when(F.col("opp_value").isNotNull(), F.col("updated_elo")).alias("elo")
    )

    def batch(rows: DataFrame, n: int) -> None:
        rows.write.mode("overwrite").parquet(f"{results}/batch={n}")

    return made.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def drain(spark: SparkSession, landed: str, results: str, checkpoint: str, first: float, initial: DataFrame | None = None) -> int:
    """Rounds of rate() until one rates nothing; how many there were. The next call goes on from the checkpoint."""
    rounds, before = 0, -1
    while (now := spark.read.schema(RATED).parquet(results).count() if rounds else 0) != before:
        before = now
        rate(spark, landed, results, checkpoint, first, initial).awaitTermination()
        rounds += 1
    return rounds


def state_store(spark: SparkSession) -> None:
    """Sets the state store that the operators need for the session's queries that start from now on."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def ratings(spark: SparkSession, results: str) -> DataFrame:
    """(player_id, game_id, match_day, elo) of all games rated so far, as operators.elo.season gives them."""
    rows = spark.read.schema(RATED).parquet(results)
    return rows.where("elo is not null").select("player_id", "game_id", "match_day", "elo")
