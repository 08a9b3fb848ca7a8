"""Session settings that the engine's semantics rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Instants are compared in UTC everywhere; AQE re-plans skewed joins and tiny partitions.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def session(master: str | None = None, **conf: str) -> SparkSession:
    """A session with DEFAULTS; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName("gustloom")
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
