"""A session with the settings that the operators are written for."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(app: str = "ledgerlift", **conf: str) -> SparkSession:
    """Local unless a master is configured; cluster settings given by spark-submit take precedence over none of `conf`."""
    builder = SparkSession.builder.appName(app)
    if "spark.master" not in conf and "MASTER" not in os.environ:
        builder = builder.master("local[*]")
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    return builder.config(map=defaults | conf).getOrCreate()
