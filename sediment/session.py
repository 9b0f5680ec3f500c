"""Session settings the lake relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Re-plan joins by measured sizes, merge small shuffle partitions, split hot ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "sediment", **extra: str) -> SparkSession:
    """A session with the lake's settings; ``extra`` overrides use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
