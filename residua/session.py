"""Session defaults for local runs. On a cluster the caller brings a configured session."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app_name: str = "residua", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    session = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session
