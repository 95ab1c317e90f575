"""Local Spark session of the tests."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def session(cores: str = "8") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("vintora")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="vintora-test-"))
    return spark
