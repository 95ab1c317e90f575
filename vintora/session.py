"""Session settings for large books."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType

TARGET_PARTITION = 128 * 1024 * 1024
WIDTHS = {"boolean": 1, "integer": 4, "date": 4, "long": 8, "double": 8, "timestamp": 8}  #: others count 16 bytes


def builder(app: str = "vintora") -> SparkSession.Builder:
    """Settings every run relies on; anything else is left to the cluster."""
    return (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )


def size_shuffles(spark: SparkSession, text_bytes: int, limit: int = 100_000) -> int:
    """Start shuffles with a partition for each ``TARGET_PARTITION`` of text; AQE merges small ones.

    The bytes are those of the uncompressed rows: stored Parquet of a book is some thirty times smaller, and AQE splits no
    window or aggregate partition afterwards. ``limit`` is what the shuffle service takes; raise it with the service.
    """
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    partitions = max(min(text_bytes // TARGET_PARTITION + 1, limit), current)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions))
    return partitions


def row_bytes(df: DataFrame) -> int:
    """Rows of a stored table, from its footers, by the width of its columns."""
    return df.count() * sum(_width(f.dataType) for f in df.schema)


def _width(kind: DataType) -> int:
    return WIDTHS.get(kind.typeName(), 16)
