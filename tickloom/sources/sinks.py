"""Sinks: topics with keyed records, Kafka, the JSON lines archive, the cloud handler's batch."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.functions import scalar
from tickloom.operators import validate as V
from tickloom.sources import ticks as S

DAY_MS = 86_400_000
#: Topic: partitions and milliseconds of retention (fixed values).
TOPICS = {
    "ticks.raw": (12, DAY_MS),
    "ticks.clean": (12, DAY_MS),
    "bars.1m": (6, 7 * DAY_MS),
    "bars.5m": (6, 30 * DAY_MS),
    "bars.15m": (3, 90 * DAY_MS),
    "bars.session": (3, 7 * DAY_MS),
    "bars.late": (1, 7 * DAY_MS),
    "anomalies": (3, 30 * DAY_MS),
}
#: Kafka producer: idempotent, in batches.
PRODUCER = {"kafka.enable.idempotence": "true", "kafka.acks": "all", "kafka.linger.ms": "25", "kafka.batch.size": "524288", "kafka.compression.type": "lz4"}


def ensure_topics(spark: SparkSession, root: str) -> list[str]:
    """Makes the folders of all topics under ``root`` with what they promise beside them; the names of new ones."""
    jvm, made = spark._jvm, []
    for name, (partitions, retention) in TOPICS.items():
        path = jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            fs.mkdirs(path)
            out = fs.create(jvm.org.apache.hadoop.fs.Path(path, "_topic.json"))
            out.write(json.dumps({"partitions": partitions, "retention_ms": retention}).encode())
            out.close()
            made.append(name)
    return made


def records(df: DataFrame, value: Column | None = None, key: str = "ticker", ts: str = "ts") -> DataFrame:
    """Keyed records: the value (by default the row as compact JSON) with the event time as the record's."""
    body = F.to_json(F.struct("*")).cast("binary") if value is None else value
    return df.select(F.col(key).cast("binary").alias("key"), body.cast("binary").alias("value"), F.col(ts).alias("timestamp"))


def produce(df: DataFrame, root: str, topic: str, value: Column | None = None, key: str = "ticker", ts: str = "ts") -> None:
    """Appends records to a topic's folder; a key's records stand in one file, by time."""
    partitions = TOPICS.get(topic, (1, 0))[0]
    records(df, value, key, ts).repartition(partitions, "key").sortWithinPartitions("timestamp").write.mode("append").parquet(f"{root}/{topic}")


def retain(spark: SparkSession, root: str, topic: str, as_of: Column) -> DataFrame:
    """A topic's records that are within its retention."""
    return S.topic_drain(spark, f"{root}/{topic}").where(F.unix_millis("timestamp") >= F.unix_millis(as_of) - TOPICS[topic][1])


def kafka(df: DataFrame, servers: str, topic: str, value: Column | None = None, key: str = "ticker", ts: str = "ts"):
    """The writer of keyed records to Kafka: ``.save()`` in batch, ``.option("checkpointLocation", ...).start()`` on a stream."""
    out = records(df, value, key, ts)
    writer = out.writeStream if out.isStreaming else out.write
    return writer.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).options(**PRODUCER)


def archive(ticks: DataFrame, root: str, request: str) -> None:
    """Accepted ticks as JSON lines under ``raw/date=.../``, a folder of its own for each request."""
    ticks.withColumn("date", F.to_date("received_at")).withColumn("request", F.lit(request)).drop("received_at").write.mode("append").partitionBy("date", "request").json(f"{root}/raw")


def handle(event: DataFrame, dim: DataFrame, root: str, request: str, now: Column, data: str = "data") -> DataFrame:
    """The cloud handler: base64 records to validated, enriched ticks in the archive; counts of valid and rejected.

    A record that is no base64, no JSON object, or lacks a required field is rejected, and so is one whose numbers can't
    be read.  The last prices are ``dashboards.last_price`` of what the archive holds.
    """
    checked = V.reduced(event.select(S.kinesis_payload(F.col(data)).alias("value")), dim)
    good = checked.where("reject IS NULL").select("ticker", F.col("event_ts").alias("timestamp_ist"), "price", "volume", "side", "sector", now.alias("received_at"))
    archive(good, root, request)
    return checked.agg(F.count_if(F.col("reject").isNull()).alias("valid"), F.count_if(F.col("reject").isNotNull()).alias("rejected"))


def to_frame(schema_id: int = 1) -> Column:
    """The row of a tick as a framed protobuf message, in Arrow batches."""
    from tickloom.functions import wire

    return wire.frame_from_tick(schema_id, "ticker", scalar.iso_utc("ts"), "price", "volume", "side", "exchange", "session_id", "seq")
