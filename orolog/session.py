"""Session defaults; every value can be overridden by the cluster's own configuration."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", app: str = "orolog", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks. On a cluster use the session it provides."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # call sites cost more than building a plan
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
