"""Retention of day partitions (R5): which days are past their retention (bronze 90, silver 180 days) and which
are cold (older than 30 days). Dropping is explicit and off by default."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Retention and cold-storage ages in days
RETENTION_DAYS = {"bronze": 90, "silver": 180}
COLD_AFTER_DAYS = 30


def partition_ages(days: DataFrame, today: Column | None = None, layer: str = "silver",
                   dt: str = "dt") -> DataFrame:
    """(dt, age_days, tier) for each distinct day; tier is expired / cold / hot.

    ``today=None`` means the newest day present, taken over the distinct days (one row per day, a small frame)
    rather than by a second pass over the data behind ``days``."""
    keep = RETENTION_DAYS[layer]
    d = days.select(dt).where(F.col(dt).isNotNull()).distinct()
    if today is None:
        today = F.max(dt).over(Window.partitionBy())
    age = F.datediff(today, F.col(dt))
    return d.select(dt, age.alias("age_days")).withColumn(
        "tier", F.when(F.col("age_days") > keep, F.lit("expired"))
        .when(F.col("age_days") > COLD_AFTER_DAYS, F.lit("cold")).otherwise(F.lit("hot")))


def expired_partitions(days: DataFrame, today: Column | None = None, layer: str = "silver",
                       dt: str = "dt") -> DataFrame:
    return partition_ages(days, today, layer, dt).where(F.col("tier") == "expired")


def drop_partitions(spark, path: str, expired: list[str], enabled: bool = False) -> list[str]:
    """Delete the folders of expired days through the Hadoop FileSystem of ``path`` (any shared store), only
    when ``enabled``; returns what was (or would be) removed. ``expired`` is the short list of day values."""
    targets = [f"{path.rstrip('/')}/dt={d}" for d in expired]
    if enabled:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for t in targets:
            p = jvm.org.apache.hadoop.fs.Path(t)
            p.getFileSystem(conf).delete(p, True)
    return targets
