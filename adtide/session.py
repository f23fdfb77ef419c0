"""Spark session set-up shared by the bench, the tests and scripts."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app_name: str = "adtide", **conf: str) -> SparkSession:
    """Session with the settings the operators rely on; cluster sizing is left to the submitter.

    Keys of ``conf`` are Spark settings with ``__`` for each dot, e.g. ``spark__master``.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # the JVM never compiles a longer method; Spark then splits the expressions into short ones
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
