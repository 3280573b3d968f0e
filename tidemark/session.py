"""Session settings the library expects."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(
    app_name: str = "tidemark",
    master: str | None = None,
    shuffle_partitions: int | None = None,
) -> SparkSession:
    """UTC days, ANSI casts, adaptive plans. Master and sizes come from the cluster if unset."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = (
                builder.config("spark.driver.memory", os.environ.get("TIDEMARK_MEMORY", "12g"))
                .config("spark.ui.enabled", "false")
                .config("spark.ui.showConsoleProgress", "false")
            )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()
