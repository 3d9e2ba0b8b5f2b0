"""Ensemble severity: how many methods agree on a ticker within 30 seconds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickloom.functions.scalar import bucket


def severity(anomalies: DataFrame, seconds: int = 30) -> DataFrame:
    return anomalies.groupBy("ticker", bucket("ts", seconds).alias("bucket")).agg(F.count_distinct("detection_method").alias("ensemble_severity"))


def highest(anomalies: DataFrame, seconds: int = 30) -> DataFrame:
    """The largest severity of all buckets; null without anomalies."""
    return severity(anomalies, seconds).agg(F.max("ensemble_severity").alias("max_severity"))


def feed(anomalies: DataFrame, seconds: int = 30, limit: int | None = 100) -> DataFrame:
    """The latest anomalies with their bucket's severity."""
    a = anomalies.withColumn("bucket", bucket("ts", seconds))
    out = a.join(severity(anomalies, seconds), ["ticker", "bucket"], "left")
    return out.orderBy(F.col("ts").desc(), "ticker", "detection_method").limit(limit) if limit else out
