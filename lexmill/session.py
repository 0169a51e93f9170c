"""A Spark session with the settings these jobs want."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str | None = None, *, shuffle_partitions: int | None = None, split_bytes: int | str = "128m", **settings: str) -> SparkSession:
    """Get or create a session.

    Input splits are ``split_bytes`` and small files are packed into them. AQE coalesces
    shuffle partitions and splits skewed ones. ``settings`` are Spark settings
    with ``__`` for the dots.
    """
    builder = (
        SparkSession.builder.appName("lexmill")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.files.maxPartitionBytes", str(split_bytes))
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()
