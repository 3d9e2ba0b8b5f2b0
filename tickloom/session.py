"""Session defaults: UTC, adaptive execution, RocksDB state."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def get_session(app: str = "tickloom", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for k, v in {**DEFAULTS, **conf}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
