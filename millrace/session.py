"""A local session for tests and benchmarks; on a cluster the caller brings the session."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, **settings: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("millrace")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
