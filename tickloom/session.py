"""Session set-up shared by jobs, tests and the bench."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def use_utc(spark: SparkSession) -> SparkSession:
    """Event times are UTC; pin the session to it so casts and date parts agree everywhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def build_session(app_name: str = "tickloom", master: str | None = None, **conf: str) -> SparkSession:
    """Build a session. On a cluster leave ``master`` unset and let spark-submit decide."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        # Recording the Python call site of every column expression costs more than building the plan.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return use_utc(builder.getOrCreate())


def local_session(cores: int | None = None, **conf: str) -> SparkSession:
    """Local session for tests and the bench: few shuffle partitions, one JVM."""
    cores = cores or os.cpu_count() or 4
    return build_session(
        "tickloom-local",
        f"local[{cores}]",
        **{
            "spark.sql.shuffle.partitions": str(cores),
            "spark.driver.memory": "8g",
            "spark.sql.files.openCostInBytes": str(1 << 20),
            **conf,
        },
    )
