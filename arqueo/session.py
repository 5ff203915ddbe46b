"""Spark sessions with the settings that the operators assume."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(app: str = "arqueo", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """UTC, ANSI, adaptive execution; partition counts are left to the cluster unless given."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", os.environ.get("SPARK_UI", "false"))
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()
