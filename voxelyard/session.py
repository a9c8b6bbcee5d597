"""A session with the settings that the library's plans expect."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "voxelyard", **settings: str) -> SparkSession:
    """UTC, ANSI errors instead of silent nulls, adaptive execution with skew-join splitting."""
    builder = SparkSession.builder.appName(app)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    return builder.config(map=defaults | settings).getOrCreate()
