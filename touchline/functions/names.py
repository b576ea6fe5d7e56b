"""Names: columns, games, addresses and aliases."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (ids of an address, in their order); each part may be missing.
URL_PARTS = ("region", "tournament", "season", "stage", "match")
_SEGMENTS = ("Regions", "Tournaments", "Seasons", "Stages", "Matches")


def snake_case(name: str) -> str:
    """startTimeUtc to start_time_utc: a capital begins a word before a small letter, and after a small letter or digit;
    hyphens become underscores, blanks go. Two underscores before a capital that begins no word become one."""
    name = re.sub(r"(?<!^)(?<!_)(?=[A-Z][a-z])|(?<=[a-z0-9])(?=[A-Z])", "_", name)
    return re.sub("__(?=[A-Z](?![a-z]))", "_", name).lower().replace("-", "_").replace(" ", "")


def with_snake_case(df: DataFrame) -> DataFrame:
    return df.toDF(*map(snake_case, df.columns))


def game_name(home: Column, away: Column, day: Column | None = None) -> Column:
    """2020-09-12 Home-Away; without a day, or where it is null, Home-Away."""
    teams = F.concat(home, F.lit("-"), away)
    return teams if day is None else F.concat_ws(" ", F.date_format(day, "yyyy-MM-dd"), teams)


def url_ids(url: Column) -> Column:
    """struct(region_id, ...) of an address such as https://host/Regions/1/Tournaments/2/Seasons/3/Stages/4/Matches/5/;
    missing parts are null, and a part counts only if all that stands before it has its place. Anything that isn't an
    address or an absolute path is null as a whole. The pattern is matched once, into a list of the parts."""
    pattern = "(?s)^(?:https://[^/]+)?/" + "".join(rf"(?:{s}/(\d+)/)?" for s in _SEGMENTS) + ".*$"
    parts = F.regexp_replace(url, pattern, "," + ",".join(f"${i + 1}" for i in range(len(_SEGMENTS))))
    part = lambda i: F.nullif(F.get(F.split(parts, ","), F.lit(i)), F.lit(""))
    # a text that begins like an address but doesn't match is left as it is, and begins with no comma
    valid = (F.startswith(url, F.lit("/")) | F.startswith(url, F.lit("https://"))) & F.startswith(parts, F.lit(","))
    return F.when(valid, F.struct(*(part(i + 1).cast("long").alias(f"{n}_id") for i, n in enumerate(URL_PARTS))))


def alias_table(spark, canonical: dict[str, list[str]]) -> DataFrame:
    """(alias, name) of a map from each canonical name to its aliases; of an alias with two names, the last holds."""
    rows = {a: name for name, aliases in canonical.items() for a in aliases}
    return spark.createDataFrame(sorted(rows.items()), "alias string, name string")


def resolve(df: DataFrame, column: str, aliases: DataFrame, unknown: str = "keep", out: str | None = None) -> DataFrame:
    """df with column replaced by its canonical name, from aliases(alias, name).

    unknown says what happens to a name that is no alias: keep it, make it null, or raise an error. Spark broadcasts
    the aliases where they are small. Rows keep their number if no alias occurs twice."""
    found = aliases.select(F.col("alias").alias("__alias"), F.col("name").alias("__name"))
    joined = df.join(found, F.col(column) == F.col("__alias"), "left")
    name = {
        "keep": F.coalesce("__name", column),
        "null": F.col("__name"),
        "raise": F.coalesce(
            "__name", F.when(F.col(column).isNotNull(), F.raise_error(F.concat(F.lit("no name for "), F.col(column))).cast("string"))
        ),
    }[unknown]
    return joined.withColumn(out or column, name).drop("__alias", "__name")


def unknown_names(df: DataFrame, column: str, aliases: DataFrame) -> DataFrame:
    """Distinct names that are neither alias nor canonical: what a data check would report."""
    known = aliases.select(F.col("alias").alias(column)).unionByName(aliases.select(F.col("name").alias(column)))
    return df.select(column).where(F.col(column).isNotNull()).subtract(known)


def blacklisted(text: Column, parts: list[str]) -> Column:
    """Whether any of the parts occurs in the text."""
    out = F.lit(False)
    for p in parts:
        out = out | F.contains(text, F.lit(p))
    return out
