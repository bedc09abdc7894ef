"""Session settings for jobs that start their own Spark.

No operator depends on these settings for its results: they hold under ANSI
on or off and in any session time zone. A session handed in from outside is
used as it is.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app_name: str = "hitloom", master: str | None = None, **conf: str) -> SparkSession:
    """Start (or get) a session. ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
