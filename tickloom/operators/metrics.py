"""Counter rates and alert rules over metric samples (metric, labels, ts, value); labels are JSON text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def increase(samples: DataFrame, seconds: int) -> DataFrame:
    """``samples`` with the counter's increase over the last ``seconds`` (what came at their very start is before them); a
    fall is a reset that starts from zero."""
    by = W.partitionBy("metric", "labels").orderBy(F.unix_seconds("ts"))
    before = F.lag("value").over(by)
    delta = F.when(before.isNull(), 0.0).when(F.col("value") < before, F.col("value")).otherwise(F.col("value") - before)
    return samples.withColumn("delta", delta).withColumn("increase", F.sum("delta").over(by.rangeBetween(1 - seconds, 0))).drop("delta")


def rate(samples: DataFrame, seconds: int) -> DataFrame:
    return increase(samples, seconds).withColumn("rate", F.col("increase") / seconds).drop("increase")


def held(df: DataFrame, condition: str, seconds: int) -> DataFrame:
    """``df`` with ``firing``: the condition held over the last ``seconds``, and the series is that long."""
    by = W.partitionBy("metric", "labels").orderBy(F.unix_seconds("ts"))
    ok = F.min(F.coalesce(F.expr(condition), F.lit(False)).cast("int")).over(by.rangeBetween(-seconds, 0)) == 1
    old = F.unix_seconds("ts") - F.min(F.unix_seconds("ts")).over(W.partitionBy("metric", "labels")) >= seconds
    return df.withColumn("firing", ok & old)


def _of(samples: DataFrame, metric: str) -> DataFrame:
    return samples.where(F.col("metric") == metric)


def _sum(df: DataFrame, value: Column, labels: Column | None = None) -> DataFrame:
    """One series: the sum at each time, by ``labels`` or over all."""
    return df.groupBy("metric", (F.lit("{}") if labels is None else labels).alias("labels"), "ts").agg(F.sum(value).alias("value"))


def _read(metric: str) -> Callable[[DataFrame], DataFrame]:
    return lambda s: _of(s, metric)


def _lag_by_group(s: DataFrame) -> DataFrame:
    return _sum(_of(s, "consumer_lag"), F.col("value"), F.to_json(F.struct(F.get_json_object("labels", "$.group").alias("group"))))


def _increase_of(metric: str, seconds: int) -> Callable[[DataFrame], DataFrame]:
    return lambda s: increase(_of(s, metric), seconds).withColumn("value", F.col("increase"))


def _stalled(s: DataFrame) -> DataFrame:
    """The producer's rate over a minute, null while the producer is down."""
    up = _of(s, "up").where((F.get_json_object("labels", "$.job") == "generator") & (F.col("value") == 1)).select("ts").distinct()
    return rate(_of(s, "produced"), 60).withColumn("value", F.col("rate")).join(up.withColumn("up", F.lit(True)), "ts", "left").withColumn("value", F.when(F.col("up"), F.col("value")))


def _rejects_without_anomalies(s: DataFrame) -> DataFrame:
    """The rejects of five minutes over all series, null while anomalies are being injected."""
    rejected = _sum(increase(_of(s, "rejects"), 300), F.col("increase"))
    injected = _sum(rate(_of(s, "injected"), 300), F.col("rate")).select("ts", F.col("value").alias("injected"))
    return rejected.join(injected, "ts", "left").withColumn("value", F.when(F.col("injected") == 0, F.col("value")))


def _mean_query_time(s: DataFrame) -> DataFrame:
    """Microseconds for a query: the ratio of the two counters."""
    n = _of(s, "queries").select("labels", "ts", F.col("value").alias("n"))
    return _of(s, "query_microseconds").join(n, ["labels", "ts"]).withColumn("value", F.try_divide("value", "n"))


#: rule: its series, the condition on ``value``, the seconds it must hold.
RULES = {
    "BrokerDown": (lambda s: _of(s, "up").where(F.get_json_object("labels", "$.job") == "broker"), "value = 0", 60),
    "StreamsDown": (lambda s: _of(s, "up").where(F.get_json_object("labels", "$.job") == "streams"), "value = 0", 60),
    "StorageDown": (lambda s: _of(s, "up").where(F.get_json_object("labels", "$.job") == "storage"), "value = 0", 60),
    "ConsumerLagHigh": (_lag_by_group, "value > 10000", 120),
    "CheckpointFailing": (_increase_of("failed_checkpoints", 300), "value > 0", 0),
    "JobRestarting": (_increase_of("restarts", 600), "value > 2", 0),
    "ProducerStalled": (_stalled, "value = 0", 30),
    "RejectSpike": (_rejects_without_anomalies, "value > 1000", 300),
    "QueriesSlow": (_mean_query_time, "value > 1000000", 300),
    "CheckpointSlow": (_read("checkpoint_ms"), "value > 30000", 300),
}


def alerts(samples: DataFrame, rules: dict = RULES) -> DataFrame:
    """(rule, labels, ts) where a rule fires."""
    out = None
    for name, (series, condition, hold) in rules.items():
        fired = held(series(samples), condition, hold).where("firing").select(F.lit(name).alias("rule"), "labels", "ts")
        out = fired if out is None else out.unionByName(fired)
    return out


def progress_samples(spark, query) -> DataFrame:
    """A stream's progress as samples: rows read, duration of each batch, rows dropped as late."""
    rows = []
    for p in query.recentProgress:
        labels = f'{{"job":"{p.name or p.id}"}}'
        late = sum(o.numRowsDroppedByWatermark for o in p.stateOperators)
        rows += [(m, labels, p.timestamp, float(v)) for m, v in (("input_rows", p.numInputRows), ("checkpoint_ms", p.batchDuration), ("late_rows", late))]
    return spark.createDataFrame(rows, "metric string, labels string, ts string, value double").withColumn("ts", F.to_timestamp("ts"))
