"""Spark sessions with the settings the engine is meant for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(name: str = "kinlink", master: str | None = None, **settings: str) -> SparkSession:
    """A session with adaptive execution and Arrow; ``settings`` add to or replace its configuration (dots as ``__``)."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    } | {k.replace("__", "."): v for k, v in settings.items()}
    return builder.config(map=conf).getOrCreate()
