"""A session with the settings the plans are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "tidemark", master: str | None = None, **settings: str) -> SparkSession:
    """Adaptive execution with skew handling, UTC, checkpoints that go when they are no longer used.

    ``settings`` (with ``__`` for dots) are added or override.
    """
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    for key, value in {**defaults, **{k.replace("__", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
