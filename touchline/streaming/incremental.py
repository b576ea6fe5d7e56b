"""Scoring and roster import as streams over landing folders: the checkpoint knows what was processed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans import imports, score
from ..plans.catalog import Catalog
from ..schemas import MATCH


def match_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """New match documents, as sources.matches.read gives them."""
    files = spark.readStream.schema(MATCH).option("multiLine", True).option("recursiveFileLookup", True)
    docs = files.option("maxFilesPerTrigger", files_per_batch).json(folder)
    return docs.withColumn("game_id", F.regexp_extract(F.input_file_name(), r"(\d+)\.json$", 1).cast("long"))


def score_new_games(catalog: Catalog, folder: str, checkpoint: str, grid: DataFrame | None = None, models=None) -> StreamingQuery:
    """Scores what has landed since the last run and ends. A batch that is repeated after a failure upserts the same
    rows."""

    def batch(docs: DataFrame, _: int) -> None:
        score.run(catalog, docs, grid, models)

    return match_stream(catalog.spark, folder).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def import_new_rosters(catalog: Catalog, folder: str, checkpoint: str, teams: DataFrame, leagues: DataFrame) -> StreamingQuery:
    """Imports the roster pages that have landed since the last run and ends; a batch that is repeated changes nothing."""
    pages = catalog.spark.readStream.option("wholetext", True).text(folder).select(F.input_file_name().alias("path"), F.col("value").alias("content"))

    def batch(found: DataFrame, _: int) -> None:
        imports.pages(catalog, found, teams, leagues)

    return pages.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def live_minutes(events: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """(game_id, window, goals, last_minute) of a live event stream(ts, game_id, expanded_minute, is_goal), by game and
    ten minutes; events that come later than delay after the window are dropped."""
    seen = events.withWatermark("ts", delay).groupBy("game_id", F.window("ts", "10 minutes").alias("window"))
    return seen.agg(F.count_if("is_goal").alias("goals"), F.max("expanded_minute").alias("last_minute"))
