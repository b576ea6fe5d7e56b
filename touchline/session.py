"""A session with the settings that the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "touchline", **conf: str) -> SparkSession:
    """Times are UTC and plans adapt to the sizes met at run time; conf overrides and adds."""
    base = {
        "spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic"
    }
    return SparkSession.builder.appName(name).config(map=base | conf).getOrCreate()
